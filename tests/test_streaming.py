"""Incremental runs equal one batch run and repeat nothing."""

from pyspark.sql import functions as F

from variantflow.catalog.base import FAST, STUB_SENDS, no_sleep, stub_service
from variantflow.operators.variants import fan_out
from variantflow.plans.rewrite import call_service, rewrite
from variantflow.schemas import LOG_SCHEMA
from variantflow.streaming.progress import compact, current_state, incremental_progress, read_log

SCHEMA = "row_idx long, original_text string"
STUB = {"policy": FAST, "sends": STUB_SENDS, "sleep": no_sleep}


def docs(spark, lo, hi):
    return spark.range(lo, hi).select(
        F.col("id").alias("row_idx"), F.concat(F.lit("t"), F.col("id").cast("string")).alias("original_text")
    )


def run(spark, tmp_path, work, **options):
    from pyspark.sql.types import _parse_datatype_string

    query = incremental_progress(
        spark, str(tmp_path / "in"), _parse_datatype_string(SCHEMA), work, str(tmp_path / "log"),
        str(tmp_path / "cp"), **options,
    )
    query.awaitTermination()
    return query


def counted(spark):
    calls = spark.sparkContext.accumulator(0)

    def factory():
        client = stub_service()

        def call(request, attempt):
            if attempt == 1:
                calls.add(1)
            return client(request, attempt)

        return call

    return calls, lambda batch: call_service(fan_out(batch), factory, **STUB)


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_stream_equals_batch_and_restart_adds_nothing(spark, tmp_path):
    for i in range(5):
        docs(spark, i * 10, i * 10 + 10).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    calls, work = counted(spark)
    run(spark, tmp_path, work, max_files=2)
    assert len(list((tmp_path / "log").glob("run=*/batch=*"))) == 3
    assert calls.value == 200
    batch = rewrite(docs(spark, 0, 50), stub_service, text="original_text", **STUB)
    state = current_state(spark, str(tmp_path / "log"))
    assert rows(state) == rows(batch.first.select(*state.columns))

    run(spark, tmp_path, work, max_files=2)
    assert calls.value == 200 and read_log(spark, str(tmp_path / "log")).count() == 200

    docs(spark, 50, 60).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    run(spark, tmp_path, work)
    assert calls.value == 240
    assert current_state(spark, str(tmp_path / "log")).count() == 240


def test_a_repeated_micro_batch_replaces_itself(spark, tmp_path):
    docs(spark, 0, 10).coalesce(1).write.parquet(str(tmp_path / "in"))
    _, work = counted(spark)
    run(spark, tmp_path, work)
    # the commit of the batch is lost, as after a crash between write and commit
    lost = sorted(p for p in (tmp_path / "cp" / "commits").iterdir() if not p.name.startswith("."))[-1]
    lost.unlink()
    (lost.parent / f".{lost.name}.crc").unlink(missing_ok=True)
    run(spark, tmp_path, work)
    assert read_log(spark, str(tmp_path / "log")).count() == 40


def test_an_accepted_reply_is_kept_over_a_later_failure(spark, tmp_path):
    log = [
        (1, "positive", "t", 1, "good", 1, 0.0, "ok", 10),
        (1, "positive", "t", 2, None, 5, 62.0, "failed", 20),
        (2, "positive", "t", 1, None, 5, 62.0, "failed", 10),
        (2, "positive", "t", 2, "late", 1, 0.0, "ok", 20),
        # called again on purpose: the first pass of a later run is newer
        (3, "positive", "t", 2, "old", 1, 0.0, "ok", 20),
        (3, "positive", "t", 1, "new", 1, 0.0, "ok", 30),
    ]
    spark.createDataFrame(log, LOG_SCHEMA).write.parquet(str(tmp_path / "log" / "run=a" / "batch=0"))
    got = compact(spark, str(tmp_path / "log"), str(tmp_path / "state"))
    assert [(r[0], r[4]) for r in rows(got)] == [(1, "good"), (2, "late"), (3, "new")]


def test_a_new_checkpoint_at_the_same_place_keeps_old_replies(spark, tmp_path):
    docs(spark, 0, 5).coalesce(1).write.parquet(str(tmp_path / "in"))
    _, work = counted(spark)
    run(spark, tmp_path, work)
    (tmp_path / "cp").rename(tmp_path / "lost")
    (tmp_path / "in").rename(tmp_path / "done")
    docs(spark, 5, 8).coalesce(1).write.parquet(str(tmp_path / "in"))
    run(spark, tmp_path, work)
    kept = {r["row_idx"] for r in read_log(spark, str(tmp_path / "log")).collect()}
    assert kept == set(range(8))


def test_a_reply_without_a_body_is_empty(spark):
    rows_ = call_service(fan_out(docs(spark, 0, 1)), lambda: lambda request, attempt: (200, None), policy=FAST, sleep=no_sleep)
    assert {(r["outcome"], r["reply"]) for r in rows_.collect()} == {("empty", "")}


def test_only_superseded_results_are_joined_to_the_log(spark, tmp_path, monkeypatch):
    from variantflow.streaming import progress

    def plan(df):
        return df._jdf.queryExecution().executedPlan().toString().replace("BroadcastExchange", "")

    def write(batch, *log):
        spark.createDataFrame(log, LOG_SCHEMA).write.parquet(str(tmp_path / "log" / "run=a" / f"batch={batch}"))

    first = [(i, "positive", "t", 1, f"r{i}", 1, 0.0, "ok", 10) for i in range(4)]
    write(0, *first, (None, "positive", "t", 1, "none", 1, 0.0, "ok", 10))
    state = current_state(spark, str(tmp_path / "log"))
    assert "Exchange" not in plan(state) and "Join" not in plan(state) and state.count() == 5

    # a later reply, a row that is there twice, and one without a key that is written again
    write(1, (1, "positive", "t", 1, "new", 1, 0.0, "ok", 20), *first[:1], (None, "positive", "t", 1, "later", 1, 0.0, "ok", 20))
    replies = ["later", "new", "r0", "r2", "r3"]
    state = current_state(spark, str(tmp_path / "log"))
    assert "Exchange" not in plan(state) and sorted(r["reply"] for r in state.collect()) == replies
    # other texts that a key of the source had are left out
    now = spark.createDataFrame([(2, "other")], "row_idx long, text_id string")
    state = current_state(spark, str(tmp_path / "log"), source=now)
    assert sorted(r["reply"] for r in state.collect()) == ["later", "new", "r0", "r3"]

    monkeypatch.setattr(progress, "BROADCAST_ROWS", 0)
    state = current_state(spark, str(tmp_path / "log"))
    assert sorted(r["reply"] for r in state.collect()) == replies
