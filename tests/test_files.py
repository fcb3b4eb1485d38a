"""Sources and sinks on small hand-written files."""

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from variantflow.catalog.png import png_bytes
from variantflow.operators.variants import fan_out
from variantflow.schemas import SLUGS, VARIANTS
from variantflow.sources.artifacts import (
    artifact_manifest,
    image_scan,
    probe_artifacts,
    write_artifacts,
)
from variantflow.sources.csv import BAD, csv_export, csv_scan, encoding_fallback_scan, file_encodings
from variantflow.sources.state import (
    load_or_init,
    load_state,
    read_routed,
    save_variant_tables,
    write_routed,
)

TEXTS = "id long, text string"


def rows(df):
    return sorted(map(tuple, df.collect()))


def test_csv_quoting_survives_a_round_trip(spark, tmp_path):
    texts = ["line\nbreak", 'said "yes", twice ""', " blanks around ", "comma, comma", "back\\slash", "\r\nmix\r", "ends\\"]
    df = spark.createDataFrame(list(enumerate(texts)), TEXTS)
    csv_export(df, str(tmp_path / "out"))
    assert rows(csv_scan(spark, str(tmp_path / "out"), df.schema)) == list(enumerate(texts))


def test_csv_reads_a_file_of_another_writer(spark, tmp_path):
    path = tmp_path / "in.csv"
    path.write_text('id,text,score\n1,"a ""b""\nc",0.5\n2,,\n3,plain,2\n')
    assert rows(csv_scan(spark, str(path))) == [(1, 'a "b"\nc', 0.5), (2, None, None), (3, "plain", 2.0)]


def test_missing_markers_become_null(spark, tmp_path):
    path = tmp_path / "in.csv"
    path.write_text("id,text\n1,NA\n2,null\n3,None\n4,\n5,x\n6,nan\n7,NAN\n")
    got = dict(rows(csv_scan(spark, str(path), spark.createDataFrame([], TEXTS).schema)))
    assert got == {1: None, 2: None, 3: None, 4: None, 5: "x", 6: None, 7: "NAN"}


def test_nan_and_null_are_empty_fields(spark, tmp_path):
    df = spark.createDataFrame([(1, float("nan")), (2, None), (3, 0.5)], "id long, score double")
    csv_export(df.coalesce(1), str(tmp_path / "out"))
    (part,) = (tmp_path / "out").glob("part-*")
    assert part.read_text().splitlines() == ["id,score", "1,", "2,", "3,0.5"]


def test_csv_files_are_bounded(spark, tmp_path):
    csv_export(spark.range(10).coalesce(1), str(tmp_path / "out"), max_records_per_file=4)
    assert len(list((tmp_path / "out").glob("part-*"))) == 3


def test_each_file_is_read_in_its_own_encoding(spark, tmp_path):
    body = 'id,text\n1,"ação\nünder"\n2,ça\n'
    (tmp_path / "utf8.csv").write_bytes(body.encode("utf-8"))
    (tmp_path / "latin.csv").write_bytes(body.encode("latin-1"))
    (tmp_path / "ascii.csv").write_bytes(b"id,text\n3,plain\n")
    schema = spark.createDataFrame([], TEXTS).schema
    flags = {r["file"].rsplit("/", 1)[1]: r["is_utf8"] for r in file_encodings(spark, str(tmp_path)).collect()}
    assert flags == {"utf8.csv": True, "latin.csv": False, "ascii.csv": True}
    twice = [(1, "ação\nünder"), (2, "ça")]
    assert rows(encoding_fallback_scan(spark, str(tmp_path), schema)) == sorted(twice * 2 + [(3, "plain")])


def test_line_ends_of_other_systems(spark, tmp_path):
    body = 'id,text\r\n1,"a\r\nb"\r\n2,"c\nd"\r\n3,NA\r\n'
    (tmp_path / "crlf.csv").write_bytes(body.encode())
    want = [(1, "a\r\nb"), (2, "c\nd"), (3, None)]
    schema = spark.createDataFrame([], TEXTS).schema
    assert sorted(map(tuple, csv_scan(spark, str(tmp_path / "crlf.csv")).collect())) == want
    assert sorted(map(tuple, encoding_fallback_scan(spark, str(tmp_path), schema).collect())) == want
    (tmp_path / "plain.csv").write_bytes(b"id,text\r\n1,x\r\n2,y\r\n")
    got = csv_scan(spark, str(tmp_path / "plain.csv"), multi_line=False)
    assert rows(got) == [(1, "x"), (2, "y")]
    assert rows(encoding_fallback_scan(spark, str(tmp_path / "plain.csv"), multi_line=False)) == [(1, "x"), (2, "y")]


@pytest.mark.parametrize("typed", [True, False])
def test_missing_markers_in_numbers(spark, tmp_path, typed):
    (tmp_path / "in.csv").write_text("id,score\n1,0.5\n2,NA\n3,None\n4,NaN\n5,\n")
    schema = spark.createDataFrame([], "id int, score double").schema
    got = csv_scan(spark, str(tmp_path / "in.csv"), schema if typed else None)
    assert got.schema["score"].dataType.simpleString() == "double"
    assert dict(map(tuple, got.collect())) == {1: 0.5, 2: None, 3: None, 4: None, 5: None}


def test_bad_rows_stop_the_scan_or_are_kept(spark, tmp_path):
    (tmp_path / "in.csv").write_text("id,text,n\n1,a,1\n2,b,2,more\n3,c,many\n4\n5,e,5,\n")
    schema = spark.createDataFrame([], "id int, text string, n int").schema
    for scan in (csv_scan, encoding_fallback_scan):
        with pytest.raises(Exception, match="too many fields|n: many"):
            scan(spark, str(tmp_path / "in.csv"), schema).collect()
        kept = {r["id"]: (r["text"], r["n"], r[BAD]) for r in scan(spark, str(tmp_path / "in.csv"), schema, on_bad="keep").collect()}
        assert kept == {1: ("a", 1, None), 2: ("b", 2, "too many fields"), 3: ("c", None, "n: many"),
                        4: (None, None, None), 5: ("e", 5, None)}  # an empty field too many holds nothing


def test_a_missing_file_is_an_error(spark, tmp_path):
    from pyspark.errors import AnalysisException

    schema = spark.createDataFrame([], TEXTS).schema
    with pytest.raises(AnalysisException):
        encoding_fallback_scan(spark, str(tmp_path / "none.csv"), schema).collect()


def some_state(spark, variants):
    data = [(v, f"text {i}", f"{v} {i}") for v in variants for i in range(2)]
    return spark.createDataFrame(data, "variant string, original_text string, reply string")


def test_load_or_init_reads_all_tables(spark, tmp_path):
    save_variant_tables(some_state(spark, VARIANTS), str(tmp_path / "s"))
    tables = load_or_init(spark, str(tmp_path / "s"))
    assert tables["very negative"].columns == ["description_original", "description_very_negative"]
    assert rows(tables["very negative"]) == [("text 0", "very negative 0"), ("text 1", "very negative 1")]


def test_load_or_init_starts_empty_if_one_table_is_missing(spark, tmp_path):
    save_variant_tables(some_state(spark, VARIANTS[:3]), str(tmp_path / "s"), VARIANTS[:3])
    tables = load_or_init(spark, str(tmp_path / "s"))
    assert list(tables) == list(VARIANTS)
    assert all(t.isEmpty() for t in tables.values())
    assert tables["positive"].columns == ["description_original", "description_positive"]


def test_a_variant_without_rows_is_not_missing(spark, tmp_path):
    save_variant_tables(some_state(spark, VARIANTS[:3]), str(tmp_path / "s"))
    tables = load_or_init(spark, str(tmp_path / "s"))
    assert [t.count() for t in tables.values()] == [2, 2, 2, 0]


def test_a_text_is_stored_once_for_its_variants(spark, tmp_path):
    from pathlib import Path

    def size(folder):
        return sum(p.stat().st_size for p in Path(folder).rglob("*.parquet"))

    def noise(*salt):
        return F.concat(*[F.sha2(F.concat_ws(":", "id", F.lit(str(i)), *salt), 256) for i in range(20)])

    texts = spark.range(500).select("id", noise().alias("original_text"))
    texts.select("original_text").write.option("compression", "zstd").parquet(str(tmp_path / "once"))
    # replies that share nothing
    state = fan_out(texts).select("variant", "original_text", noise("variant").alias("reply"))
    save_variant_tables(state, str(tmp_path / "s"))
    # one text and four replies; eight where each variant stores the text
    assert size(tmp_path / "s") < 6 * size(tmp_path / "once")
    tables = load_or_init(spark, str(tmp_path / "s"))
    for v in VARIANTS:
        assert rows(tables[v]) == rows(state.where(F.col("variant") == v).select("original_text", "reply"))


def test_tables_with_folders_of_their_own_are_read_and_added_to(spark, tmp_path):
    root = str(tmp_path / "s")
    state = some_state(spark, [*VARIANTS, None])
    write_routed(
        state.select(F.col("original_text").alias("description_original"), "reply", F.replace("variant", F.lit(" "), F.lit("_")).alias("slug")),
        root,
    )
    assert [t.count() for t in load_or_init(spark, root).values()] == [2] * 4
    with pytest.raises(Exception, match="ALREADY_EXISTS|already exists"):
        save_variant_tables(state, root)
    save_variant_tables(state, root, VARIANTS[:3], mode="append")
    # the fourth is not named, but has rows
    assert [t.count() for t in load_or_init(spark, root).values()] == [4] * 4
    save_variant_tables(state, root, mode="overwrite")
    assert [t.count() for t in load_or_init(spark, root).values()] == [2] * 4


def test_long_state_starts_empty(spark, tmp_path):
    assert load_state(spark, str(tmp_path / "none")).isEmpty()


def test_routed_sink_makes_one_folder_for_each_variant(spark, tmp_path):
    df = spark.createDataFrame([(i, s) for i in range(3) for s in SLUGS], "row_idx long, slug string")
    write_routed(df, str(tmp_path / "out"))
    assert {p.name for p in (tmp_path / "out").iterdir() if p.is_dir()} == {f"slug={s}" for s in SLUGS}
    assert rows(read_routed(spark, str(tmp_path / "out"), df.schema)) == rows(df)


def test_routed_rows_are_written_as_they_come(spark, tmp_path):
    from pathlib import Path
    from time import monotonic, sleep

    import pyarrow as pa

    out, name = str(tmp_path / "out"), "spark.sql.maxConcurrentOutputFileWriters"
    before = spark.conf.get(name)

    def rows_of(batches):
        for _ in batches:
            pass
        # more than what lies in the pipe between Python and Spark
        for slug in SLUGS * 4:
            yield pa.RecordBatch.from_pydict({"text": [f"{slug} " * 20_000], "slug": [slug], "early": [False]})
        # a sort would take in the last row before the first file is there
        end, found = monotonic() + 20, False
        while not found and monotonic() < end:
            sleep(0.1)
            found = any(Path(out).rglob("slug=*/part-*"))
        yield pa.RecordBatch.from_pydict({"text": ["last"], "slug": [SLUGS[0]], "early": [found]})

    df = spark.range(1, numPartitions=1).mapInArrow(rows_of, "text string, slug string, early boolean")
    write_routed(df, out)
    back = read_routed(spark, out, df.schema)
    assert back.where("text = 'last'").first()["early"]
    assert back.count() == 17
    assert spark.conf.get(name) == before


def test_manifest_and_probe_agree(spark, tmp_path):
    root = str(tmp_path / "art")
    files = spark.createDataFrame(
        [(f"{root}/a/1.png", bytearray(b"xy")), (f"{root}/b/2.png", bytearray(b"z"))],
        "path string, content binary",
    )
    assert rows(write_artifacts(files, "path", "content")) == [(f"{root}/a/1.png", 2), (f"{root}/b/2.png", 1)]
    assert rows(artifact_manifest(spark, root)) == [(f"{root}/a/1.png", 2), (f"{root}/b/2.png", 1)]
    asked = [f"{root}/a/1.png", f"file:{root}/b/2.png", f"{root}/c/3.png", "", None]
    df = spark.createDataFrame([(i, p) for i, p in enumerate(asked)], "i int, generated_filename string")
    for parts in (1, 5):
        got = dict(probe_artifacts(df.repartition(parts)).select("i", "present").collect())
        assert got == {0: True, 1: True, 2: False, 3: False, 4: False}


def test_stores_are_opened_once(monkeypatch):
    from pyarrow import fs

    from variantflow.sources.artifacts import _Stores

    opened = []

    def from_uri(uri):
        opened.append(uri)
        return "s3", "bucket"

    monkeypatch.setattr(fs, "FileSystem", type("FileSystem", (), {"from_uri": staticmethod(from_uri)}))
    stores = _Stores()
    assert stores.locate("s3a://bucket/a/1.png") == ("s3://bucket", "s3", "bucket/a/1.png")
    assert stores.locate("s3://bucket/b/2.png")[2] == "bucket/b/2.png"
    assert opened == ["s3://bucket/"]
    for path in ("/a/b", "file:/a/b", "file:///a/b"):
        store, system, inside = stores.locate(path)
        assert store == "" and isinstance(system, fs.LocalFileSystem) and inside == "/a/b"


def test_images_become_rgb_and_bad_files_become_null(spark, tmp_path):
    rgb = bytes([1, 2, 3, 40, 50, 60])
    good = png_bytes(rgb, 2, 1, 3)
    (tmp_path / "rgb.png").write_bytes(good)
    (tmp_path / "grey.png").write_bytes(png_bytes(bytes([7, 9]), 2, 1, 1))
    (tmp_path / "rgba.png").write_bytes(png_bytes(bytes([1, 2, 3, 255, 40, 50, 60, 0]), 2, 1, 4))
    (tmp_path / "cut.png").write_bytes(good[: len(good) // 2])
    (tmp_path / "text.png").write_bytes(b"no image")
    got = {
        r["path"].rsplit("/", 1)[1]: (r["height"], r["width"], r["channels"], r["rgb"] and bytes(r["rgb"]))
        for r in image_scan(spark, str(tmp_path)).collect()
    }
    assert got == {
        "rgb.png": (1, 2, 3, rgb),
        "grey.png": (1, 2, 1, bytes([7, 7, 7, 9, 9, 9])),
        "rgba.png": (1, 2, 4, rgb),
        "cut.png": (None, None, None, None),
        "text.png": (None, None, None, None),
    }


def test_scratch_folder_comes_from_the_session(spark):
    from variantflow.sources.scratch import new_folder, qualified, scratch_root, written

    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    assert scratch_root(spark) == qualified(spark, root or scratch_root(spark)).rstrip("/")
    assert new_folder(spark, "x") != new_folder(spark, "x")
    table = written(spark.range(5).withColumn("t", F.lit("a")))
    assert table.count() == 5 and isinstance(table.schema["t"].dataType, T.StringType)


def test_a_folder_without_a_store_is_in_the_default_one(spark):
    from variantflow.sources.scratch import qualified

    assert qualified(spark, "/shared/ck") == "file:/shared/ck"
    assert qualified(spark, "hdfs://nn:8020/ck") == "hdfs://nn:8020/ck"
    hadoop = spark.sparkContext._jsc.hadoopConfiguration()
    hadoop.set("fs.defaultFS", "viewfs://store/")
    hadoop.set("fs.viewfs.mounttable.store.link./shared", "file:///tmp")
    try:
        assert qualified(spark, "/shared/ck") == "viewfs://store/shared/ck"
    finally:
        hadoop.unset("fs.defaultFS")


def test_a_killed_write_leaves_no_artifact(spark, tmp_path):
    """What was begun has another name, which listings leave out; a second write replaces the first."""
    from pyarrow import fs

    from variantflow.sources import artifacts

    path = str(tmp_path / "art" / "a.png")
    for data in (b"first", b"second"):
        df = spark.createDataFrame([(path, data)], "path string, content binary")
        assert write_artifacts(df, "path", "content").first()["length"] == len(data)
    assert (tmp_path / "art" / "a.png").read_bytes() == b"second"
    assert [p.name for p in (tmp_path / "art").iterdir() if not p.name.startswith(".")] == ["a.png"]
    (tmp_path / "art" / "_begun").write_bytes(b"cut")
    assert artifact_manifest(spark, str(tmp_path / "art")).count() == 1

    class Strict:
        """A store that renames to free names only."""

        def __init__(self):
            self.inner, self.refused = fs.LocalFileSystem(), 0

        def move(self, source, target):
            if self.inner.get_file_info(target).type != fs.FileType.NotFound:
                self.refused += 1
                raise OSError("exists")
            self.inner.move(source, target)

        def delete_file(self, path):
            self.inner.delete_file(path)

    store = Strict()
    artifacts._replace(store, str(tmp_path / "art" / "_begun"), path)
    assert store.refused == 1 and (tmp_path / "art" / "a.png").read_bytes() == b"cut"


INFERRED = {
    "yes\nno\ny": "string", "1d\n2f": "string", "12345678901234567890123\n12345678901234567890124": "string",
    "true\nFALSE\nTrue": "boolean", "true\n1": "string", "1\n-2\n+3": "int", "1\n3000000000": "bigint",
    "1\n2.5\n.5\n1e3\n-7.": "double", "9007199254740993\n0.5": "string", "9007199254740992\n0.5": "double",
    "0.1234567890123456789\n1.0": "string", "0.00000000000000000000012345": "double", "inf\n-Infinity\n1": "double",
    "NA\n\nnull": "string", "t\nf": "string", "2024-01-01": "string", "1 \n2": "string", "0x1F": "string",
    "1_000": "string", "infinite": "string", "1e": "string", ".": "string",
}


@pytest.mark.parametrize("scan", [csv_scan, encoding_fallback_scan])
def test_inferred_types_keep_every_value(spark, tmp_path, scan):
    """Each text of a column is still told apart after the types are found."""
    for i, (values, kind) in enumerate(INFERRED.items()):
        path = tmp_path / f"{i}.csv"
        # a second column, so that an empty field is no empty line
        path.write_text("v,w\n" + "".join(f"{v},x\n" for v in values.split("\n")))
        got = scan(spark, str(path))
        assert dict(got.dtypes)["v"] == kind, values
        given = [v for v in values.split("\n") if v not in ("", "NA", "null")]
        found = [r["v"] for r in got.collect() if r["v"] is not None]
        assert len(set(found)) == len(set(given)) or kind == "boolean"
        if kind == "string":
            assert sorted(found) == sorted(given)


@pytest.mark.parametrize("scan", [csv_scan, encoding_fallback_scan])
def test_given_types_take_no_other_texts(spark, tmp_path, scan):
    path = tmp_path / "in.csv"
    path.write_text("b,i,d\nyes,1,1\ntrue,1d,1\ntrue,1,2f\nfalse,7,1e3\ntrue,8,nan\n")
    schema = T.StructType([T.StructField("b", T.BooleanType()), T.StructField("i", T.IntegerType()), T.StructField("d", T.DoubleType())])
    got = scan(spark, str(path), schema, on_bad="keep", na_tokens=False).orderBy("i", "d").collect()
    assert sorted(filter(None, (r["_bad_row"] for r in got))) == ["b: yes", "d: 2f", "i: 1d"]
    assert [tuple(r)[:3] for r in got if r["_bad_row"] is None] == [(False, 7, 1000.0), (True, 8, None)]


@pytest.mark.parametrize("scan", [csv_scan, encoding_fallback_scan])
def test_a_file_without_a_header_is_told(spark, tmp_path, scan):
    path = tmp_path / "empty.csv"
    path.write_text("")
    with pytest.raises(ValueError, match="no header"):
        scan(spark, str(path))
    path.write_text("a,b\n")
    assert scan(spark, str(path)).columns == ["a", "b"] and scan(spark, str(path)).count() == 0
