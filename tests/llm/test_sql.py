import duckdb
import pytest

from variantflow.llm.queries import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"
KIND = {"bigint": "BIGINT", "string": "VARCHAR", "boolean": "BOOLEAN"}


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "benchmark", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    want, got = con.sql(ORACLES[name]), QUERIES[name](spark, SF)
    assert {f.name: KIND[f.dataType.simpleString()] for f in got.schema} == dict(zip(want.columns, map(str, want.types)))
    assert sorted(map(tuple, got.select(*want.columns).collect()), key=repr) == sorted(want.fetchall(), key=repr)
