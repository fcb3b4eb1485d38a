"""Array operators and scoring against plain numpy."""

import math

import numpy as np
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from variantflow.functions.arrays import (
    channels_last,
    dequantize,
    grid_cells,
    guided_combine,
    mask_pair,
    softmax,
    weighted_draw,
    weighted_draw_batch,
)
from variantflow.functions.text import key_uniform
from variantflow.operators.scoring import (
    Head,
    export_names,
    head_lookup_default,
    heads_from_weights,
    score_long,
    score_long_builtin,
    score_wide,
    scores_map,
    scores_to_wide,
)
from variantflow.schemas import SCORE_COLUMNS, SCORE_FIELDS

numbers = st.floats(-30, 30, allow_nan=False)
quick = settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])


def vectors(spark, data):
    return spark.createDataFrame([(i, v) for i, v in enumerate(data)], "id long, f array<double>")


def values(df, column):
    return [r[0] for r in df.orderBy("id").select(column).collect()]


def test_guided_combine(spark):
    df = spark.createDataFrame([([1.0, 2.0], [0.5, 4.0])], "c array<double>, u array<double>")
    assert df.select(guided_combine(F.col("c"), F.col("u"))).first()[0] == [3.0, -6.0]


@quick
@given(st.lists(st.lists(numbers, min_size=1, max_size=9), min_size=1, max_size=6), st.floats(0.2, 3))
def test_softmax_and_draw(spark, data, temperature):
    df = vectors(spark, data).withColumn("u", key_uniform(F.col("id"), F.lit("t")))
    probs = values(df, softmax(F.col("f"), temperature))
    draws = values(df, weighted_draw(F.col("f"), F.col("u"), temperature))
    batch = values(df, weighted_draw_batch(temperature)(F.col("f"), F.col("u")))
    chance = values(df, F.col("u"))
    assert draws == batch
    for p, d, u in zip(probs, draws, chance):
        assert math.isclose(sum(p), 1.0, abs_tol=1e-9)
        assert 0 <= d < len(p)
        assert sum(p[:d]) <= u + 1e-9 and u <= sum(p[: d + 1]) + 1e-9


def test_draw_edges(spark):
    data = [[0.0] * 4, [0.0, 1000.0, 0.0], [2.5], [], None]
    df = vectors(spark, data).withColumn("u", F.lit(0.999))
    for column in (weighted_draw(F.col("f"), F.col("u")), weighted_draw_batch()(F.col("f"), F.col("u"))):
        assert values(df, column) == [3, 1, 0, None, None]


def test_draw_follows_the_probabilities(spark):
    df = spark.range(20000).select(
        weighted_draw_batch()(
            F.array(F.lit(0.0), F.log(F.lit(3.0))), key_uniform(F.col("id"), F.lit("freq"))
        ).alias("token")
    )
    assert abs(df.filter("token = 1").count() / 20000 - 0.75) < 0.015


def test_draw_does_not_depend_on_partitions(spark):
    df = vectors(spark, np.random.default_rng(0).normal(size=(50, 7)).tolist())
    column = weighted_draw_batch()(F.col("f"), key_uniform(F.col("id")))
    assert values(df.repartition(1), column) == values(df.repartition(9), column)


def test_mask_pair(spark):
    df = spark.createDataFrame([(0, [5, 6, 7, 8]), (1, [5, 6]), (2, [5]), (3, [])], "id long, t array<int>")
    got = {(r["id"], r["kind"]): r["tokens"] for r in df.select("id", F.inline(mask_pair(F.col("t"), 9))).collect()}
    assert [got[i, "masked"] for i in range(4)] == [[5, 9, 9, 8], [5, 6], [5], []]
    assert [got[i, "full"] for i in range(4)] == [[5, 6, 7, 8], [5, 6], [5], []]


@quick
@given(st.lists(st.floats(-3, 3), min_size=1, max_size=8))
def test_dequantize(spark, data):
    want = np.clip((np.array(data) + 1) / 2 * 255, 0, 255).astype(np.uint8).tolist()
    assert values(vectors(spark, [data]), dequantize(F.col("f"))) == [want]


def test_dequantize_edges(spark):
    data = [[-1.0, 1.0, 0.0, -7.0, 7.0, float("nan"), None]]
    assert values(vectors(spark, data), dequantize(F.col("f"))) == [[0, 255, 127, 0, 255, None, None]]


def test_axes_and_grid(spark):
    flat = np.arange(24.0)
    df = vectors(spark, [flat.tolist()])
    want = flat.reshape(2, 3, 4).transpose(1, 2, 0).ravel().tolist()
    assert values(df, channels_last(F.col("f"), 2, 3, 4)) == [want]
    cells = df.select(F.inline(grid_cells(F.col("f"), 6))).collect()
    assert [[r["value"] for r in cells if r["row"] == i] for i in range(4)] == flat.reshape(4, 6).tolist()


def registry(missing=(), width=5, seed=3):
    rng = np.random.default_rng(seed)
    weights = {n: (rng.normal(size=width).tolist(), float(rng.normal())) for n in SCORE_COLUMNS}
    return weights, heads_from_weights({n: None if n in missing else w for n, w in weights.items()})


def test_all_scoring_paths_agree(spark):
    weights, heads = registry(missing=("Mood",))
    data = np.random.default_rng(4).normal(size=(30, 5)).tolist()
    broken = [None, data[0][:3], [None, *data[0][1:]], [float("nan"), *data[0][1:]]]
    df = vectors(spark, data + broken)
    wide = {r["id"]: r for r in score_wide(df, heads, "f").collect()}
    pivots = [
        {r["id"]: r for r in scores_to_wide(score(df, heads, "f"), ["id"]).collect()}
        for score in (score_long, score_long_builtin)
    ]
    maps = {r["id"]: r for r in head_lookup_default(scores_map(df, heads, "f")).collect()}
    for i, vector in enumerate(data + broken):
        for name, field in zip(SCORE_COLUMNS, SCORE_FIELDS):
            got = [t[i][field] for t in (wide, *pivots, maps)]
            if i >= len(data) or name == "Mood":
                assert got == [None] * 4
            else:
                w, b = weights[name]
                want = (np.dot(vector, w) + b) * (10 if name == "Total aesthetic score" else 1)
                assert np.allclose(got, want, atol=1e-9)


def test_only_the_total_is_rescaled(spark):
    same = ((1.0, 2.0), 0.5)
    heads = heads_from_weights({"Total aesthetic score": same, "Color": same})
    row = score_wide(vectors(spark, [[1.0, 1.0]]), heads, "f").first()
    assert (row["total_aesthetic_score"], row["color"], row["mood"]) == (35.0, 3.5, None)


def test_heads_of_another_width_fail_alone(spark):
    heads = [Head("a", (1.0, 1.0)), Head("b", (1.0, 1.0, 1.0))]
    df = score_long(vectors(spark, [[1.0, 2.0], [1.0, 2.0, 3.0]]), heads, "f")
    assert sorted(map(tuple, df.collect())) == sorted([(0, "a", 3.0), (0, "b", None), (1, "a", None), (1, "b", 6.0)], key=repr)


def test_missing_artifacts_have_no_scores(spark):
    _, heads = registry()
    df = vectors(spark, [[1.0] * 5, [1.0] * 5]).withColumn("present", F.col("id") == 0)
    got = {r["id"]: r["color"] for r in score_wide(df, heads, "f", present="present").collect()}
    assert got[0] is not None and got[1] is None


def test_absent_head_in_a_map_is_null(spark):
    df = spark.createDataFrame([({"Color": 1.0},)], "scores map<string,double>")
    row = head_lookup_default(df).first()
    assert row["color"] == 1.0 and row["mood"] is None


def test_export_uses_published_names(spark):
    _, heads = registry()
    df = export_names(score_wide(vectors(spark, [[1.0] * 5]), heads, "f").drop("f"))
    assert df.columns == ["id", *SCORE_COLUMNS]
