"""Shapes of the physical plans that matter at scale."""

import re

import pytest
from pyspark.sql import functions as F

from __spark_entry__ import oracle_sql, queries
from variantflow.catalog import ORACLES, QUERIES
from variantflow.operators.keyed import pending
from variantflow.catalog.base import HEADS
from variantflow.operators.keyed import keyed_upsert, row_index
from variantflow.operators.manifest import manifest_join
from variantflow.operators.scoring import score_long, score_wide, scores_to_wide
from variantflow.operators.variants import assemble_wide, fan_out

SF = "/root/testdata/sf0.001"
# one row in, at most a fixed number of rows out: nothing moves between tasks
NARROW = [
    "project_columns", "optional_column", "add_or_replace_columns", "variant_fanout", "variant_union",
    "prompt_template", "request_payload_json", "chat_render", "artifact_path", "accept_reply", "dead_letter",
    "dispatch_by_variant", "classify_response", "guided_combine", "weighted_draw", "mask_pair", "dequantize",
    "axis_permute_grid", "head_cross_join", "linear_head_score", "conditional_rescale", "head_lookup_default",
    "csv_scan", "csv_export", "load_or_init", "variant_routed_sink", "generate_stage", "image_scan",
]


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def exchanges(df):
    return len(re.findall(r"(?<!Broadcast)Exchange ", plan(df)))


@pytest.fixture
def no_broadcast(spark):
    key = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(key)
    spark.conf.set(key, "-1")
    yield
    spark.conf.set(key, before)


@pytest.mark.parametrize("name", NARROW)
def test_narrow_queries_do_not_shuffle(spark, name):
    text = plan(queries()[name](spark, SF))
    assert "Exchange" not in text


@pytest.mark.parametrize("name", sorted(queries()))
def test_no_query_multiplies_two_tables_or_gathers_in_one_task(spark, name):
    text = plan(queries()[name](spark, SF))
    assert "CartesianProduct" not in text and "NestedLoopJoin" not in text
    assert "Window" not in text and "SinglePartition" not in text


@pytest.mark.parametrize(
    "name",
    ["row_index", "keyed_upsert", "append_recovered", "assemble_wide", "run_counters", "manifest_join",
     "weighted_draw", "score_stage", "scored_dataset"],
)
def test_partition_counts_change_no_result(spark, name):
    key = "spark.sql.shuffle.partitions"
    before = spark.conf.get(key)
    results = []
    try:
        for n in ("1", "5", "16"):
            spark.conf.set(key, n)
            results.append(sorted(map(repr, queries()[name](spark, SF).collect())))
    finally:
        spark.conf.set(key, before)
    assert results[0] == results[1] == results[2]


def test_every_query_has_its_sql():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(queries()) and set(ORACLES) <= set(oracle_sql())
    assert len(QUERIES) >= 42


def test_filters_and_columns_reach_the_scan(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    text = plan(fan_out(docs).filter("doc_id > 10").select("doc_id", "slug"))
    assert "PushedFilters: [IsNotNull(doc_id), GreaterThan(doc_id,10)]" in text
    assert "ReadSchema: struct<doc_id:bigint>" in text


def test_manifest_listing_reads_no_content(spark, tmp_path):
    from variantflow.sources.artifacts import artifact_manifest

    (tmp_path / "a.png").write_bytes(b"x")
    text = plan(artifact_manifest(spark, str(tmp_path)))
    assert "content" not in text.split("ReadSchema")[1]


def embeddings(spark):
    return spark.read.parquet(f"{SF}/embeddings.parquet").select("vec_id", F.col("embedding").alias("features"))


def test_wide_scores_need_one_python_step_and_no_shuffle(spark):
    text = plan(score_wide(embeddings(spark), HEADS))
    assert text.count("ArrowEvalPython") == 1 and "pythonUDF1" not in text and "Exchange" not in text


def test_pivots_shuffle_once_after_a_partial_step(spark):
    scores = scores_to_wide(score_long(embeddings(spark), HEADS), ["vec_id"])
    docs = spark.read.parquet(f"{SF}/documents.parquet").select(F.col("doc_id").alias("row_idx"), "text")
    wide = assemble_wide(fan_out(docs).withColumnRenamed("text", "reply"))
    for df in (scores, wide):
        text = plan(df)
        assert exchanges(df) == 1
        # plans print the last operator first
        assert text.index("partial_max") > text.index("Exchange ")


def test_upsert_combines_before_its_only_shuffle(spark):
    log = spark.range(9).select(
        F.col("id").alias("row_idx"), F.lit("a").alias("variant"), F.lit("r").alias("reply"), F.lit(1).alias("pass")
    )
    df = keyed_upsert(log, log)
    assert exchanges(df) == 1 and "partial_max" in plan(df)


def test_row_index_moves_the_wide_rows_once(spark, no_broadcast):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    text = plan(row_index(docs, ["doc_id"]))
    assert text.count("hashpartitioning(doc_id") == 2  # the rows and the index
    assert "rangepartitioning" not in text  # the sorted keys are already written


def test_a_path_shared_by_many_rows_is_split(spark, no_broadcast):
    shared = F.when(F.col("id") % 3 == 0, "/a/0").otherwise(F.concat(F.lit("/a/"), F.col("id").cast("string")))
    left = spark.range(200_000).select(
        F.col("id").alias("row_idx"), shared.alias("generated_filename"), F.sha2(F.col("id").cast("string"), 256).alias("payload")
    )
    listing = spark.range(50_000).select(F.concat(F.lit("/a/"), F.col("id").cast("string")).alias("path"))
    sizes = {
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64k",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    }
    for k, v in sizes.items():
        spark.conf.set(k, v)
    try:
        joined = manifest_join(left, listing)
        joined.write.format("noop").mode("overwrite").save()
        assert joined.filter("present").count() == 66_667 + 33_333
        counted = joined.select("payload", "present")
        rows = counted.collect()
        assert len(rows) == 200_000
        assert "skew=true" in plan(counted)
    finally:
        for k in sizes:
            spark.conf.unset(k)


def test_rows_without_a_path_are_spread(spark, no_broadcast):
    left = spark.range(8000).select(F.col("id").alias("row_idx"), F.lit(None).cast("string").alias("generated_filename"))
    listing = spark.createDataFrame([("/a/0",)], "path string")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        joined = manifest_join(left, listing).withColumn("part", F.spark_partition_id())
        sizes = [r["count"] for r in joined.groupBy("part").count().collect()]
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert len(sizes) == 8 and max(sizes) < 2 * min(sizes)


def test_unfinished_pairs_are_found_without_reading_texts(spark, tmp_path):
    from variantflow.schemas import LOG_SCHEMA
    from variantflow.streaming.progress import current_outcomes

    row = (1, "positive", "t", 1, "r", 1, 0.0, "ok", 10)
    spark.createDataFrame([row], LOG_SCHEMA).write.parquet(str(tmp_path / "log" / "run=a" / "batch=0"))
    finished = current_outcomes(spark, str(tmp_path / "log")).filter("outcome <> 'failed'")
    docs = spark.range(3).select(F.col("id").alias("row_idx"), F.lit("x").alias("original_text"))
    text = plan(pending(docs, finished))
    scan = [line for line in text.splitlines() if "ReadSchema" in line]
    assert len(scan) == 1 and "reply" not in scan[0] and "original_text" not in scan[0]


def test_calls_stay_spread_on_resume(spark):
    docs = spark.range(40).select(F.col("id").alias("row_idx"), F.lit("x").alias("original_text"))
    state = spark.range(4).select(F.col("id").alias("row_idx"), F.lit("positive").alias("variant"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        tasks = pending(docs, state, spread_to=16).select(F.spark_partition_id()).distinct().count()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert tasks > 8


def test_failed_pairs_of_a_first_pass_that_was_dealt_out_are_not_dealt_again(spark):
    import pyarrow.parquet as pq

    from variantflow.catalog.base import FAST, no_sleep, stub_service
    from variantflow.plans.rewrite import retry_pass, rewrite

    calls = {"policy": FAST, "sends": ("row_idx", "variant", "original_text"), "sleep": no_sleep}
    docs = spark.range(100, numPartitions=1).select(F.col("id").alias("row_idx"), F.lit("x").alias("description"))
    result = rewrite(docs, stub_service, spread_to=8, **calls)
    kept = retry_pass(result.first, stub_service, spread_to=8, **calls)
    assert "Exchange" not in plan(kept)
    few = retry_pass(result.first, stub_service, spread_to=64, **calls)
    assert "hashpartitioning(row_idx" in plan(few)
    parts = [r[0] for r in result.second.select(F.input_file_name()).distinct().collect()]
    assert len(parts) > 4
    codec = pq.ParquetFile(parts[0].removeprefix("file://")).metadata.row_group(0).column(2).compression
    assert codec == "ZSTD"
    again = [{tuple(r) for r in df.select("row_idx", "variant", "reply").collect()} for df in (kept, few, result.second)]
    assert again[0] == again[1] == again[2] and again[0]


def test_csv_rows_are_numbered_without_a_shuffle(spark, tmp_path):
    from variantflow.sources.csv import csv_scan, numbered

    folder = tmp_path / "in"
    folder.mkdir()
    lines = [f'{i},"a\nb {i}"\n' for i in range(3000)]
    for k in range(3):
        (folder / f"part-{k}.csv").write_text("i,t\n" + "".join(lines[k * 1000 : (k + 1) * 1000]))
    df = numbered(csv_scan(spark, str(folder), position=True))
    text = plan(df)
    assert "Sort" not in text and text.count("Exchange") == text.count("BroadcastExchange")
    assert {(r["i"], r["row_idx"]) for r in df.collect()} == {(i, i) for i in range(3000)}
    # files that are split into many ranges, or put together in one
    plain = tmp_path / "plain.csv"
    plain.write_text("i\n" + "".join(f"{i}\n" for i in range(20_000)))
    for size in ("8k", "1m"):
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
        try:
            rows = numbered(csv_scan(spark, str(plain), multi_line=False, position=True)).collect()
        finally:
            spark.conf.unset("spark.sql.files.maxPartitionBytes")
        assert {(r["i"], r["row_idx"]) for r in rows} == {(i, i) for i in range(20_000)}
