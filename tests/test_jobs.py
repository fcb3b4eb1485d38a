"""The three jobs one after another, from a CSV file to scored tables."""

import json

import pytest
from pyspark.sql import functions as F

from variantflow.__main__ import arguments, main
from variantflow.catalog.base import FAST, no_sleep, stub_service
from variantflow.operators.keyed import text_id
from variantflow.operators.variants import fan_out
from variantflow.plans import jobs
from variantflow.schemas import SCORE_COLUMNS, SLUGS, VARIANTS
from variantflow.sources.csv import csv_scan, numbered
from variantflow.sources.published import current_version, read_published

STUB = {"policy": FAST, "sleep": no_sleep}
TEXTS = ["first\nline", 'a "quoted" one', "third", "NA", "fifth, last", *[f"t{i}" for i in range(20)]]


@pytest.fixture
def source(tmp_path):
    import csv

    path = tmp_path / "in.csv"
    with path.open("w", newline="") as out:
        lines = csv.writer(out, lineterminator="\n")
        lines.writerow(["Description", "extra"])
        lines.writerows([[t, i] for i, t in enumerate(TEXTS)])
    return str(path)


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_csv_rows_are_numbered_in_file_order(spark, source, tmp_path):
    got = numbered(csv_scan(spark, source, position=True))
    assert rows(got.select("row_idx", "extra")) == sorted([(i, i) for i in range(len(TEXTS))], key=repr)
    many = tmp_path / "many"
    many.mkdir()
    for name, values in (("b", range(3, 5)), ("a", range(3))):
        (many / f"{name}.csv").write_text("v\n" + "".join(f"{v}\n" for v in values))
    got = numbered(csv_scan(spark, str(many), position=True))
    assert rows(got.select("row_idx", "v")) == [(i, i) for i in range(5)]


def test_jobs_from_csv_to_scores(spark, source, tmp_path):
    out = str(tmp_path / "rewritten")
    counters = jobs.rewrite_job(spark, source, out, stub_service, **STUB)
    counts = {}
    for r in counters.collect():
        counts[r["outcome"]] = counts.get(r["outcome"], 0) + r["n_rows"]
    assert sum(counts.values()) == 4 * len(TEXTS) and counts["null_input"] == 4
    wide = read_published(spark, f"{out}/wide")
    assert wide.count() == len(TEXTS) and {"Description", "extra"} < set(wide.columns)
    state = read_published(spark, f"{out}/state")
    assert state.count() == counts["ok"]
    dead = read_published(spark, f"{out}/dead")
    assert dead.count() == counts.get("failed", 0) + 4
    for r in state.collect():
        assert r["reply"] == f"[{r['variant']}] {TEXTS[r['row_idx']]}"

    # a second run with the same state repeats no finished pair
    before = spark.read.parquet(f"{out}/log").count()
    jobs.rewrite_job(spark, source, out, stub_service, **STUB)
    log = spark.read.parquet(f"{out}/log")
    redone = log.groupBy("row_idx", "variant").agg(F.count_if(F.col("outcome") == "ok").alias("n"))
    assert log.count() > before and redone.agg(F.max("n")).first()[0] == 1

    # unless it is told to; then the newer reply is the one that counts
    def shouting():
        return lambda request, attempt: (200, request["original_text"].upper())

    jobs.rewrite_job(spark, source, str(tmp_path / "again"), stub_service, **STUB)
    jobs.rewrite_job(spark, source, str(tmp_path / "again"), shouting, redo=True, **STUB)
    loud = read_published(spark, str(tmp_path / "again" / "state"))
    assert loud.count() == 4 * (len(TEXTS) - 1)
    assert all(r["reply"] == r["original_text"].upper() for r in loud.collect())

    art = tmp_path / "art"
    jobs.generate_job(spark, f"{out}/wide", str(tmp_path / "manifest"), str(art))
    manifest = spark.read.parquet(str(tmp_path / "manifest"))
    assert manifest.count() == 4 * len(TEXTS)
    made = [r["generated_filename"] for r in manifest.filter("row_idx < 3").collect()]
    for path in made:
        file = art / path.removeprefix(str(art) + "/")
        file.parent.mkdir(parents=True, exist_ok=True)
        file.write_bytes(b"image")
    vectors = fan_out(spark.range(5).withColumnRenamed("id", "row_idx")).withColumn(
        "features", F.array(F.col("row_idx").cast("double"), F.lit(1.0))
    )
    vectors.write.parquet(str(tmp_path / "features"))
    weights = {name: {"w": [1.0, i], "b": 0.5} for i, name in enumerate(SCORE_COLUMNS)}
    weights["Mood"] = None
    (tmp_path / "heads.json").write_text(json.dumps(weights))
    heads = jobs.read_heads(str(tmp_path / "heads.json"), spark)
    target = str(tmp_path / "scored.csv")
    jobs.score_job(spark, str(tmp_path / "manifest"), target, str(tmp_path / "features"), heads)
    assert {p.name for p in (tmp_path / "scored.csv").glob("slug=*")} == {f"slug={s}" for s in SLUGS}
    scored = csv_scan(spark, target)
    assert set(SCORE_COLUMNS) < set(scored.columns) and scored.count() == 4 * len(TEXTS)
    for r in scored.collect():
        if r["row_idx"] < 3:
            assert r["Theme and logic"] == r["row_idx"] + 1.5
            assert r["Total aesthetic score"] == 10 * (r["row_idx"] + 0.5)
        else:
            assert r["Theme and logic"] is None and r["Total aesthetic score"] is None
        assert r["Mood"] is None


def test_incremental_job(spark, tmp_path):
    source, out = str(tmp_path / "in"), str(tmp_path / "out")

    def add(lo, hi):
        spark.range(lo, hi).select(
            F.col("id").alias("row_idx"), F.concat(F.lit("t"), F.col("id").cast("string")).alias("Description")
        ).coalesce(1).write.mode("append").parquet(source)

    add(0, 15)
    jobs.incremental_rewrite_job(spark, source, out, stub_service, **STUB)
    add(15, 30)
    jobs.incremental_rewrite_job(spark, source, out, stub_service, **STUB)
    other = str(tmp_path / "batch")
    jobs.rewrite_job(spark, source, other, stub_service, **STUB)
    # both ran every pair once more after a failure
    assert rows(read_published(spark, f"{out}/wide")) == rows(read_published(spark, f"{other}/wide"))


def test_incremental_job_of_csv_files(spark, tmp_path):
    """Rows keep the numbers that they got when their file was first seen, also after a restart or a lost checkpoint."""
    source, out = tmp_path / "in.csv", str(tmp_path / "out")
    source.mkdir()
    calls = spark.sparkContext.accumulator(0)

    def client():
        def call(request, attempt):
            calls.add(1)
            return 200, request["original_text"].upper()

        return call

    def add(name, texts, head="Description,n"):
        (source / name).write_text(head + "\n" + "".join(f'"{t}",{i}\n' for i, t in enumerate(texts)))

    def run():
        before = calls.value
        jobs.incremental_rewrite_job(spark, str(source), out, client, **STUB)
        got = {r["row_idx"]: (r["Description"], r["n"], r["description_positive"]) for r in read_published(spark, f"{out}/wide").collect()}
        return got, calls.value - before

    add("c+d %20.csv", ["three"])
    assert run() == ({0: ("three", 0, "THREE")}, 4)
    add("b 1.csv", ["one", "two\nlines"])
    first, made = run()
    assert sorted(first.values()) == [("one", 0, "ONE"), ("three", 0, "THREE"), ("two\nlines", 1, "TWO\nLINES")]
    assert sorted(first) == [0, 1, 2] and first[0][0] == "three" and made == 8
    assert run() == (first, 0)
    add("a.csv", ["zero", "one"])  # before the others by its name
    second, made = run()
    assert {k: v for k, v in second.items() if k in first} == first and made == 8
    assert {k: v[0] for k, v in second.items() if k not in first} == {3: "zero", 4: "one"}
    (tmp_path / "out" / "checkpoint").rename(tmp_path / "lost")
    assert run() == (second, 0)
    add("e.csv", ["x"], head="n,Description")
    with pytest.raises(Exception, match="columns of new files"):
        run()
    assert {r["row_idx"] for r in read_published(spark, f"{out}/wide").collect()} == set(second)


def test_a_publication_writes_touched_buckets_and_shows_whole_versions_only(spark, tmp_path, monkeypatch):
    from variantflow.sources import published as P

    source, out = str(tmp_path / "in"), str(tmp_path / "out")

    def add(lo, hi):
        spark.range(lo, hi).select(
            F.col("id").alias("row_idx"), F.concat(F.lit("t"), F.col("id").cast("string")).alias("Description")
        ).coalesce(1).write.mode("append").parquet(source)

    def client():
        return lambda request, attempt: (200, request["original_text"].upper())

    def run():
        return jobs.incremental_rewrite_job(spark, source, out, client, **STUB)

    def shown():
        return {t: rows(read_published(spark, f"{out}/{t}")) for t in ("wide", "state", "dead")}

    add(0, 200)
    run()
    before = shown()
    add(200, 201)
    # the run stops between any two tables, and before its list has its name
    write, stopped = P._write_list, RuntimeError("stopped")

    def stop(*args):
        raise stopped

    monkeypatch.setattr(P, "_write_list", stop)
    with pytest.raises(RuntimeError, match="stopped"):
        run()
    assert shown() == before and current_version(spark, out).number == 1
    monkeypatch.setattr(P, "_write_list", write)
    counters = run()
    assert sum(r["n_rows"] for r in counters.collect()) == 4 * 201
    after = shown()
    assert len(after["wide"]) == 201 and len(after["state"]) == 804 and set(before["wide"]) < set(after["wide"])
    version = current_version(spark, out)
    for table in ("wide", "state"):
        assert [n for n in version.tables[table]["written"].values()].count(2) == 1
    # rows that are read from the version before stay readable; what no kept version names is deleted
    held = read_published(spark, f"{out}/wide")
    add(201, 202)
    run()
    assert held.count() == 201 and len(shown()["wide"]) == 202
    add(202, 400)
    run()
    run()
    assert sorted(p.name for p in (tmp_path / "out" / "versions").glob("*.json")) == ["4.json", "5.json"]
    assert len(shown()["wide"]) == 400
    named = {(v, b) for n in (4, 5) for b, v in P._version(spark, out, n).tables["wide"]["written"].items()}
    there = {tuple(p.name.partition("=")[2] for p in (f.parent, f)) for f in (tmp_path / "out/versions/wide").glob("*/_bucket=*")}
    assert {(int(v), b) for v, b in there} == named
    # a run over all rows of another source publishes everything
    spark.createDataFrame([(7, "other")], "row_idx long, Description string").write.parquet(str(tmp_path / "small"))
    jobs.rewrite_job(spark, str(tmp_path / "small"), out, client, **STUB)
    assert [r[:3] for r in shown()["wide"]] == [(7, "other", "OTHER")]


def test_arguments_and_clients():
    args = arguments(["rewrite", "in.csv", "out", "--client", "http://service/", "--in-flight", "8"])
    assert (args.stage, args.in_flight, args.pause, args.redo) == ("rewrite", 8, 1.0, False)
    assert jobs.client_of("variantflow.catalog.base:stub_service") is stub_service
    with pytest.raises(SystemExit):
        main(["unknown"])
    assert len(VARIANTS) == 4


def test_csv_manifests_go_in_and_scored_csv_comes_out(spark, tmp_path):
    from variantflow.catalog.png import png_bytes

    wide = spark.createDataFrame(
        [(i, f"t{i}", *[f"{s} ação {i}" for s in SLUGS]) for i in range(3)],
        "row_idx long, Description string, " + ", ".join(f"description_{s} string" for s in SLUGS),
    )
    wide.write.parquet(str(tmp_path / "wide"))
    art, manifest, out = tmp_path / "art", str(tmp_path / "manifest.csv"), str(tmp_path / "scored.csv")
    totals = jobs.generate_job(spark, str(tmp_path / "wide"), manifest, str(art)).first()
    assert totals["rows"] == totals["prompts"] == 12 and totals["seconds"] > 0
    found = jobs.read_manifest(spark, manifest).collect()
    assert {(r["variant"], r["reply"]) for r in found if r["row_idx"] == 1} == {
        (v, f"{v.replace(' ', '_')} ação 1") for v in VARIANTS
    }
    assert all(r["reply"] in r["prompt"] for r in found)
    image = png_bytes(bytes(12), 2, 2, 3)
    for r in found:
        file = art / r["generated_filename"].removeprefix(str(art) + "/")
        file.parent.mkdir(parents=True, exist_ok=True)
        file.write_bytes(image if r["row_idx"] else image[:30])  # those of row 0 are truncated
    vectors = spark.range(3).select(F.col("id").alias("row_idx"), F.array(F.lit(1.0)).alias("features"))
    vectors.write.parquet(str(tmp_path / "features"))
    (tmp_path / "heads.json").write_text(json.dumps({n: {"w": [1.0]} for n in SCORE_COLUMNS}))
    heads = jobs.read_heads(str(tmp_path / "heads.json"), spark)
    told = jobs.score_job(
        spark, manifest, out, str(tmp_path / "features"), heads, feature_key=("row_idx",), images=str(art)
    ).first()
    assert (told["rows"], told["scored"]) == (12, 8)
    for r in csv_scan(spark, out).collect():
        assert (r["Mood"] is None) == (r["row_idx"] == 0) and r["generated_filename"]


def test_published_state_is_read_by_load_or_init(spark, source, tmp_path):
    from variantflow.sources.state import load_or_init

    jobs.rewrite_job(spark, source, str(tmp_path / "out"), lambda: lambda request, attempt: (200, "reply"), **STUB)
    tables = load_or_init(spark, str(tmp_path / "out" / "state"))
    got = tables["positive"].collect()
    assert len(got) == len(TEXTS) - 1 and all(r["description_original"] in TEXTS for r in got)


def test_score_keeps_every_row_once(spark):
    from variantflow.operators.scoring import heads_from_weights
    from variantflow.plans.score import score

    rows_ = spark.createDataFrame(
        [(1, "a", "/x"), (1, "a", "/x"), (None, "a", "/x"), (2, "a", None)], "row_idx long, variant string, generated_filename string"
    )
    vectors = spark.createDataFrame([(1, "a", [1.0])], "row_idx long, variant string, features array<double>")
    twice = spark.createDataFrame([("/x",), ("file:/x",)], "path string")
    heads = heads_from_weights({n: ([1.0], 0.0) for n in SCORE_COLUMNS})
    got = score(rows_, vectors, heads, manifest=twice)
    assert got.columns[:3] == rows_.columns
    assert sorted((str(r[0]), r["mood"]) for r in got.collect()) == [("1", 1.0), ("1", 1.0), ("2", None), ("None", None)]


def test_rows_that_share_a_key_get_their_own_replies(spark, tmp_path):
    """Also NULL keys; equal rows are called once, and a second run calls nothing."""
    source, out = str(tmp_path / "in"), str(tmp_path / "out")
    given = [(1, "aaa"), (1, "bbb"), (None, "ccc"), (None, "ddd"), (2, "eee"), (1, "aaa"), (None, None), (3, "")]
    spark.createDataFrame(given, "row_idx long, Description string").write.parquet(source)
    calls = spark.sparkContext.accumulator(0)

    def client():
        def call(request, attempt):
            calls.add(1)
            return 200, f"{request['variant']}:{request['original_text']}"

        return call

    for slice_rows in (3, 3, None):
        jobs.rewrite_job(spark, source, out, client, slice_rows=slice_rows, **STUB)
        wide = read_published(spark, f"{out}/wide")
        assert wide.count() == len(given)
        for r in wide.collect():
            told = None if r["Description"] is None else [f"{v}:{r['Description']}" for v in VARIANTS]
            got = [r[f"description_{s}"] for s in SLUGS]
            assert got == (told or [None] * 4)
        # (3, ""), too, is a text, and (1, aaa) is called once for both rows
        assert calls.value == 4 * 6
    runs = sorted(map(tuple, spark.read.json(f"{out}-runs").select("rows", "calls", "ok", "null_input").collect()))
    # a NULL text is no call, and is finished
    assert runs == [(8, 0, 0, 0), (8, 0, 0, 0), (8, 24, 24, 4)]


def test_a_text_that_changes_under_its_key_is_new_work(spark, tmp_path):
    out = str(tmp_path / "out")
    for n, text in enumerate(["old", "new"]):
        source = str(tmp_path / f"in{n}")
        spark.createDataFrame([(1, text), (2, "same")], "row_idx long, Description string").write.parquet(source)
        jobs.rewrite_job(spark, source, out, lambda: lambda request, attempt: (200, request["original_text"].upper()), **STUB)
    wide = {r["row_idx"]: r["description_positive"] for r in read_published(spark, f"{out}/wide").collect()}
    assert wide == {1: "NEW", 2: "SAME"}
    state = read_published(spark, f"{out}/state")
    assert sorted((r["row_idx"], r["reply"]) for r in state.collect()) == [(1, "NEW")] * 4 + [(2, "SAME")] * 4
    assert spark.read.parquet(f"{out}/log").count() == 12


def test_a_run_that_stops_repeats_only_its_open_slice(spark, tmp_path):
    """The client dies at the row that is called last; all slices before are in the log."""
    source, out = str(tmp_path / "in"), str(tmp_path / "out")
    texts = spark.range(20).select(F.col("id").alias("row_idx"), F.concat(F.lit("t"), "id").alias("Description"))
    texts.coalesce(1).write.parquet(source)
    calls = spark.sparkContext.accumulator(0)
    flag = tmp_path / "healed"
    dealt = F.pmod(F.xxhash64("row_idx", text_id(F.col("Description"))), F.lit(5))
    fatal = texts.orderBy(dealt.desc(), F.desc("row_idx")).first()["Description"]

    def client():
        def call(request, attempt):
            calls.add(1)
            import os

            if request["original_text"] == fatal and not os.path.exists(flag):
                raise RuntimeError("the client dies")
            return 200, request["original_text"].upper()

        return call

    with pytest.raises(Exception, match="the client dies"):
        jobs.rewrite_job(spark, source, out, client, slice_rows=4, spread_to=1, **STUB)
    kept = spark.read.parquet(f"{out}/log").count()
    flag.touch()
    before = calls.value
    counters = jobs.rewrite_job(spark, source, out, client, slice_rows=4, spread_to=1, **STUB)
    # what the log held is not called again
    assert calls.value - before == 80 - kept
    assert 40 <= kept < 80 and kept % 4 == 0
    assert sum(r["n_rows"] for r in counters.collect() if r["outcome"] == "ok") == 80
