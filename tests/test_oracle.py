"""Every query against its SQL in DuckDB."""

import hashlib
import math
import os

import duckdb
import pytest

from variantflow.catalog import ORACLES, QUERIES

SF_DIR = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.01")
TABLES = "documents embeddings labels conversations pages benchmark".split()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_DIR}/{t}.parquet')")
    return con


def cell(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value)
    if isinstance(value, str) and len(value) > 64:
        return hashlib.md5(value.encode("utf-8", "surrogatepass")).hexdigest()
    return repr(value)


def canonical(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(tuple(cell(r[i]) for i in order) for r in rows)


KIND = {"bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE", "boolean": "BOOLEAN"}


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, duck, name):
    result = QUERIES[name](spark, SF_DIR)
    expected = duck.sql(ORACLES[name])
    kinds = {f.name: KIND[f.dataType.simpleString()] for f in result.schema.fields}
    assert kinds == dict(zip(expected.columns, map(str, expected.types)))
    want = canonical(expected.columns, expected.fetchall())
    got = canonical(result.columns, [tuple(r) for r in result.collect()])
    assert len(got) == len(want) > 0
    wrong = [(g, w) for g, w in zip(got, want) if g != w]
    assert not wrong, wrong[:3]
