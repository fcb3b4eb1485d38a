"""Row identity, keyed state, variants, manifests and replies."""

import itertools
import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from variantflow.operators.columns import optional_column
from variantflow.operators.counters import observed, run_counters
from variantflow.operators.keyed import (
    append_recovered,
    keyed_upsert,
    pending,
    row_index,
)
from variantflow.operators.manifest import align_results, manifest_join, missing_artifact_null
from variantflow.operators.replies import accept_reply, classify_response, dead_letter, reply_outcome
from variantflow.operators.variants import (
    assemble_wide,
    dispatch_by_variant,
    fan_out,
    split_wide,
    union_variants,
    variant_tables,
)
from variantflow.schemas import VARIANTS

STATE = "row_idx long, variant string, original_text string, reply string, pass int"


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def row_index_single_task(df, key, name="row_idx"):
    return df.withColumn(name, F.row_number().over(Window.orderBy(*key)).cast("long") - 1)


def test_row_index_refuses_keys_that_do_not_tell_rows_apart(spark):
    df = spark.createDataFrame([(1, "a"), (1, "b"), (None, "c"), (2, "d")], "id long, text string")
    with pytest.raises(ValueError, match="1 keys are NULL and 1 are repeated"):
        row_index(df, ["id"])


def test_the_last_write_wins_also_where_the_order_is_equal(spark):
    old = spark.createDataFrame([(1, "a", "t", "zzz older", 1)], STATE)
    new = spark.createDataFrame([(1, "a", "t", "aaa newer", 1)], STATE)
    assert rows(keyed_upsert(old, new)) == [(1, "a", "t", "aaa newer", 1)]


@pytest.mark.parametrize("parts", [1, 4, 16])
def test_row_index_is_contiguous_for_any_partitioning(spark, parts):
    keys = list(range(0, 3000, 3))
    random.Random(1).shuffle(keys)
    # one group holds most rows
    df = spark.createDataFrame([("en" if k % 10 else "de", k) for k in keys], "lang string, id long")
    df = df.repartition(parts)
    got = rows(row_index(df, ["lang", "id"], partitions=parts).select("lang", "id", "row_idx"))
    assert got == rows(row_index_single_task(df, ["lang", "id"]).select("lang", "id", "row_idx"))
    assert sorted(r[2] for r in got) == list(range(1000))


def test_row_index_of_no_rows(spark):
    assert row_index(spark.createDataFrame([], "id long"), ["id"]).isEmpty()


@pytest.mark.parametrize("order", list(itertools.permutations(range(3)))[:4])
def test_upsert_keeps_the_newest_in_any_order(spark, order):
    versions = [(1, "a", "t", f"v{p}", p) for p in range(3)] + [(2, "a", "t", "only", 0)]
    log = [versions[i] for i in order] + versions[3:]
    df = spark.createDataFrame(log, STATE)
    empty = spark.createDataFrame([], STATE)
    once = keyed_upsert(empty, df)
    assert rows(once) == [(1, "a", "t", "v2", 2), (2, "a", "t", "only", 0)]
    assert rows(keyed_upsert(once, df)) == rows(once)


def test_upsert_of_one_hot_key(spark):
    hot = spark.range(5000).select(
        F.lit(1).cast("long").alias("row_idx"), F.lit("a").alias("variant"), F.lit("t").alias("original_text"),
        F.col("id").cast("string").alias("reply"), F.col("id").cast("int").alias("pass"),
    )
    assert rows(keyed_upsert(spark.createDataFrame([], STATE), hot)) == [(1, "a", "t", "4999", 4999)]


def test_recovered_rows_replace_nothing(spark):
    # key 2 fails at first; by position it would land on a row that is in use
    state = spark.createDataFrame([(k, "positive", f"t{k}", f"r{k}", 1) for k in (0, 1, 3, 4)], STATE)
    again = spark.createDataFrame([(2, "positive", "t2", "r2", 2)], STATE)
    got = append_recovered(state, again)
    assert [(r[0], r[3]) for r in rows(got)] == [(k, f"r{k}") for k in range(5)]


def test_equal_texts_stay_apart(spark):
    state = spark.createDataFrame([(0, "positive", "same", "ok", 1)], STATE)
    again = spark.createDataFrame([(1, "positive", "same", "late", 2)], STATE)
    assert [r[3] for r in rows(append_recovered(state, again))] == ["ok", "late"]


def test_rows_that_are_alone_under_their_key_are_not_shuffled(spark, monkeypatch):
    from variantflow.operators import keyed

    def plan(df):
        return df._jdf.queryExecution().executedPlan().toString()

    state = spark.createDataFrame([(1, "a", "t", "one", 1), (None, "a", "t", "none", 1)], STATE)
    again = spark.createDataFrame([(2, "a", "t", "two", 2)], STATE)
    both = append_recovered(state, again)
    assert "Exchange" not in plan(both)
    assert [r[3] for r in rows(both)] == ["one", "two", "none"]

    again = spark.createDataFrame([(2, "a", "t", "two", 2), (1, "a", "t", "newer", 2), (None, "a", "t", "same", 1)], STATE)
    few = rows(append_recovered(state, again))
    assert [r[3] for r in few] == ["newer", "two", "same"]
    monkeypatch.setattr(keyed, "BROADCAST_KEYS", 0)
    assert rows(append_recovered(state, again)) == few


def test_pending_skips_finished_pairs(spark):
    source = spark.createDataFrame([(i, f"t{i}") for i in range(5)], "row_idx long, text string")
    done = [(i, v, f"t{i}", "r", 1) for i in (0, 2, 3, 4) for v in VARIANTS] + [(1, "positive", "t1", "r", 1)]
    state = spark.createDataFrame(done, STATE)
    got = rows(pending(source, state).select("row_idx", "variant"))
    assert got == sorted([(1, v) for v in VARIANTS[1:]], key=repr)
    assert pending(source, state, redo=True).count() == 20
    assert pending(source, None).count() == 20
    assert pending(source, state, variants=["positive"]).isEmpty()


def test_fan_out_counts_and_names(spark):
    got = fan_out(spark.range(3))
    assert got.count() == 12
    slugs = {r["slug"] for r in got.filter(F.col("variant") == "very positive").collect()}
    assert slugs == {"very_positive"}


def test_pivot_and_its_inverse(spark):
    long = fan_out(spark.range(4).withColumnRenamed("id", "row_idx")).withColumn(
        "reply", F.when((F.col("row_idx") != 2) | (F.col("slug") != "negative"), F.concat("slug", F.lit("!")))
    )
    wide = assemble_wide(long)
    assert wide.columns[1:] == [f"description_{s}" for s in ("positive", "very_positive", "negative", "very_negative")]
    back = split_wide(wide).select("row_idx", "variant", "slug", "reply")
    assert rows(back) == rows(long.select("row_idx", "variant", "slug", "reply"))


def test_pivot_takes_the_newest_version(spark):
    log = [(1, "positive", "old", 1), (1, "positive", "new", 2), (1, "negative", "n", 1)]
    df = spark.createDataFrame(log, "row_idx long, variant string, reply string, pass int")
    assert rows(assemble_wide(df, order="pass")) == [(1, "new", None, "n", None)]


def test_union_of_variants_fills_missing_columns(spark):
    a = spark.createDataFrame([(1, "x")], "id long, extra string")
    b = spark.createDataFrame([(2,)], "id long")
    got = union_variants({"positive": a, "very negative": b})
    assert rows(got) == [(1, "x", "positive", "positive"), (2, None, "very negative", "very_negative")]


def test_dispatch_ignores_unknown_variants(spark):
    df = spark.createDataFrame([(1, "very positive"), (2, "neutral"), (3, None)], "row_idx long, variant string")
    assert rows(dispatch_by_variant(df)) == [(1, "very positive", "dataset_very_positive")]
    assert variant_tables(df)["very positive"].count() == 1
    assert variant_tables(df)["negative"].isEmpty()


def test_reply_kinds(spark):
    data = [(0, "v", "t", None, 5), (1, "v", "t", "", 1), (2, "v", "t", " ", 1), (3, "v", "t", "ok", 1), (4, "v", None, None, 0)]
    df = spark.createDataFrame(data, "row_idx long, variant string, original_text string, reply string, attempts int")
    assert [r[0] for r in rows(accept_reply(df))] == [2, 3]
    assert rows(dead_letter(df)) == [(0, "v", "t", "no_reply", 5), (4, "v", None, "null_input", 0)]
    outcomes = df.withColumn("outcome", reply_outcome(F.col("original_text"), F.col("reply")))
    assert [r["outcome"] for r in outcomes.orderBy("row_idx").collect()] == ["failed", "empty", "ok", "ok", "null_input"]
    assert {r[1]: r[2] for r in run_counters(outcomes).collect()} == {"failed": 1, "empty": 1, "ok": 2, "null_input": 1}
    watched, watch = observed(outcomes)
    watched.write.format("noop").mode("overwrite").save()
    assert watch.get == {"rows": 5, "ok": 2, "empty": 1, "failed": 1, "null_input": 1}


def test_responses(spark):
    data = [(200, None), (429, None), (500, None), (None, "request"), (None, "other"), (None, None)]
    df = spark.createDataFrame(data, "status int, error string")
    got = [r[0] for r in df.select(classify_response(F.col("status"), F.col("error"))).collect()]
    assert got == ["ok", "retry", "retry", "retry", "fatal", "retry"]


def test_optional_column(spark):
    df = spark.createDataFrame([(1, "p")], "id long, Generated_Filename string")
    assert df.select(optional_column(df, "generated_filename")).first()[0] == "p"
    assert df.select(optional_column(df, "other", "double")).schema["other"].dataType.simpleString() == "double"


def test_paths(spark):
    data = [(0, "/a/0"), (1, "/a/1"), (2, None), (3, ""), (4, "file:///a/0")]
    df = spark.createDataFrame(data, "row_idx long, generated_filename string")
    listing = spark.createDataFrame([("file:/a/0", 9)], "path string, length long")
    got = manifest_join(df, listing, carry=["length"])
    scored = got.withColumn("score", missing_artifact_null(F.col("present"), F.lit(1.5)))
    table = {r["row_idx"]: (r["present"], r["length"], r["score"]) for r in scored.collect()}
    assert table == {0: (True, 9, 1.5), 1: (False, None, None), 2: (False, None, None), 3: (False, None, None), 4: (True, 9, 1.5)}


def test_a_repeated_manifest_repeats_no_rows(spark):
    df = spark.createDataFrame([(0, "/a/0"), (1, "/a/1")], "row_idx long, generated_filename string")
    twice = spark.createDataFrame([("/a/0", 1), ("/a/0", 2)], "path string, length long")
    got = manifest_join(df, twice, carry=["length"], distinct=False)
    assert rows(got.select("row_idx", "present", "length")) == [(0, True, 2), (1, False, None)]
    assert manifest_join(df, twice, distinct=False).count() == 2


def test_results_are_aligned_by_key(spark):
    left = spark.createDataFrame([(0, "a", "x"), (1, "a", "y")], "row_idx long, variant string, text string")
    right = spark.createDataFrame([(1, "a", "p1"), (0, "a", "p0")], "row_idx long, variant string, path string")
    assert rows(align_results(left, right)) == [(0, "a", "x", "p0"), (1, "a", "y", "p1")]
