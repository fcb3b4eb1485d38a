"""Tables that are published together: folders of buckets, and a list of them written last.

``<out>/versions/<n>.json`` names, for each table, the folder that holds each
bucket of keys.  It gets its name by a rename when all of its folders are
written, and the highest one counts: a run that stops at any point leaves the
tables of the version before.  A version writes the buckets that it touches and
names the folders of older versions for all others.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from variantflow.sources.scratch import qualified

#: how many folders the keys are dealt to; a version writes whole ones
BUCKETS = 64
#: versions that are kept for readers that have begun
KEPT = 2
_VERSION, _BUCKET = "_version", "_bucket"


@dataclass(frozen=True)
class Version:
    """What one list says."""

    number: int
    buckets: int
    #: table -> its schema as JSON, and bucket -> number of the version that wrote it
    tables: Mapping[str, dict]
    #: what the publisher notes for the next one
    note: dict


def bucket_of(key: Column, buckets: int = BUCKETS) -> Column:
    """Bucket of a key; NULL keys share one."""
    return F.pmod(F.xxhash64(key.cast("long")), F.lit(buckets)).cast("int")


def _store(spark: SparkSession, path: str):
    """Hadoop's file system of a path, and a maker of its paths."""
    jvm = spark._jvm.org.apache.hadoop.fs.Path
    return jvm(path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), jvm


def _numbers(spark: SparkSession, out: str) -> list[int]:
    system, path = _store(spark, out)
    folder = path(f"{out}/versions")
    if not system.exists(folder):
        return []
    names = [s.getPath().getName() for s in system.listStatus(folder)]
    return sorted(int(m[1]) for m in (re.fullmatch(r"(\d+)\.json", n) for n in names) if m)


def _version(spark: SparkSession, out: str, number: int) -> Version:
    text = spark.read.text(f"{out}/versions/{number}.json", wholetext=True).first()["value"]
    return Version(**json.loads(text))


def current_version(spark: SparkSession, out: str) -> Version | None:
    """The last version that is whole, or None."""
    out = qualified(spark, out.rstrip("/"))
    numbers = _numbers(spark, out)
    return _version(spark, out, numbers[-1]) if numbers else None


def read_published(spark: SparkSession, path: str) -> DataFrame | None:
    """The table ``<out>/<name>`` of the last version; None where nothing of that name is published."""
    out, _, name = qualified(spark, path.rstrip("/")).rpartition("/")
    last = current_version(spark, out)
    if last is None or name not in last.tables:
        return None
    table = last.tables[name]
    schema = T.StructType.fromJson(table["schema"])
    root = f"{out}/versions/{name}"
    folders = [f"{root}/{_VERSION}={v}/{_BUCKET}={b}" for b, v in sorted(table["written"].items())]
    if not folders:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("basePath", root).parquet(*folders).drop(_VERSION, _BUCKET)


def publish_tables(
    spark: SparkSession,
    out: str,
    tables: Mapping[str, tuple[DataFrame, Sequence[str]]],
    key: str | Mapping[str, str],
    *,
    touched: Iterable[int] | None = None,
    buckets: int = BUCKETS,
    note: dict | None = None,
) -> Version:
    """Publish tables (rows, columns to route by) as the next version.

    With ``touched`` only those buckets are written, and a table's rows of other
    buckets stay those of the version before; it needs one with as many buckets.
    Rows of a bucket are dealt to as many tasks as their size asks for.
    """
    out = qualified(spark, out.rstrip("/"))
    numbers = _numbers(spark, out)
    last = _version(spark, out, numbers[-1]) if numbers else None
    if touched is not None:
        if last is None or last.buckets != buckets or set(last.tables) != set(tables):
            raise ValueError("only some buckets can be published where a version with the same tables and buckets is there")
        touched = sorted(touched)
    number = numbers[-1] + 1 if numbers else 1
    found = {}
    for name, (rows, routed) in tables.items():
        own = F.col(key if isinstance(key, str) else key[name])
        dealt = rows.withColumn(_BUCKET, bucket_of(own, buckets))
        if touched is not None:
            dealt = dealt.where(F.col(_BUCKET).isin(touched))
        folder = f"{out}/versions/{name}/{_VERSION}={number}"
        # what a run that stopped has left there is in no list
        dealt.hint("rebalance", _BUCKET).write.mode("overwrite").partitionBy(_BUCKET, *routed).parquet(folder)
        system, path = _store(spark, folder)
        names = [s.getPath().getName() for s in system.listStatus(path(folder))]
        written = {n.removeprefix(f"{_BUCKET}="): number for n in names if n.startswith(f"{_BUCKET}=")}
        if touched is not None:
            done = set(map(str, touched))
            written |= {b: v for b, v in last.tables[name]["written"].items() if b not in done}
        found[name] = {"schema": json.loads(rows.schema.json()), "written": written}
    made = Version(number, buckets, found, note or {})
    _write_list(spark, out, made)
    _clear(spark, out, [*numbers, number])
    return made


def _write_list(spark: SparkSession, out: str, version: Version) -> None:
    """The list under a name of its own, then under its number; a number is given once."""
    system, path = _store(spark, out)
    aside, target = (path(f"{out}/versions/{name}") for name in (f"_{version.number}.json", f"{version.number}.json"))
    stream = system.create(aside, True)
    try:
        stream.write(bytearray(json.dumps(vars(version)).encode()))
    finally:
        stream.close()
    if system.exists(target) or not system.rename(aside, target):
        raise RuntimeError(f"version {version.number} of {out} has been published by another run")


def _clear(spark: SparkSession, out: str, numbers: list[int]) -> None:
    """Delete the lists before the last ``KEPT``, and the folders that no list names any more."""
    system, path = _store(spark, out)
    kept = [_version(spark, out, n) for n in numbers[-KEPT:]]
    for n in numbers[:-KEPT]:
        system.delete(path(f"{out}/versions/{n}.json"), False)
    for name in kept[-1].tables:
        named = {(str(v), b) for k in kept for b, v in k.tables.get(name, {"written": {}})["written"].items()}
        for version in system.listStatus(path(f"{out}/versions/{name}")):
            n = version.getPath().getName().removeprefix(f"{_VERSION}=")
            # a higher one is being written by another run
            if not n.isdigit() or int(n) > numbers[-1]:
                continue
            for s in system.listStatus(version.getPath()):
                bucket = s.getPath().getName()
                if bucket.startswith(f"{_BUCKET}=") and (n, bucket.removeprefix(f"{_BUCKET}=")) not in named:
                    system.delete(s.getPath(), True)
