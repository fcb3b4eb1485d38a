"""Quality rules and robust multivariate outliers, with DataFrame functions only.

Each document becomes a vector of transformed statistics.  For each language and
source, the minimum-covariance-determinant estimate of location and scatter is
found by concentration steps: take the rows closest to the present estimate, a
fixed share of the group, and estimate again from those.  Several starts make
``FIRST_STEPS`` steps each, and the one with the least determinant goes on to
``STEPS``.  The scatter of a core is widened to that of a whole normal group.  A row whose
Mahalanobis distance is beyond the cutoff is rejected.

The statistics are written once; every step is a grouped aggregate over that
narrow table, combined before the shuffle, so a group of any size is never in
one place.  Estimates are one row a group, and are broadcast after their number
is checked.  Matrices are written out as columns, factored by Cholesky.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from variantflow.llm.batches import quoted
from variantflow.sources.scratch import written

#: words are ``[^\x20\x09-\x0D]+``
BLANKS = "[\\x20\\x09-\\x0D]+"
BLANK_CHARS = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"
WINDOW = 8
#: share of a group that an estimate is made of
CORE = 0.75
STEPS, FIRST_STEPS = 5, 2
#: beyond so many groups (about 200 bytes each) their estimates are joined by a shuffle
BROADCAST_GROUPS = 100_000
#: squared distance that one in a thousand rows of a normal group of four statistics exceeds
CUTOFF = 18.47
#: groups of fewer rows take the estimate of their language, then of all rows
LEAST_ROWS = 50
#: added to each variance against rounding, far below any spread that decides
LEAST_SPREAD = {"s_length": 1e-4, "s_word": 1e-4, "s_symbols": 1e-4, "s_lines": 1e-4}
#: an estimated standard deviation below this, given the earlier statistics, is taken as this:
#: a core without any symbol says nothing on how few are too many
FLOOR = {"s_length": 0.1, "s_word": 0.05, "s_symbols": 0.05, "s_lines": 0.05}
STATS = tuple(LEAST_SPREAD)


def let(value: Column, body) -> Column:
    """``body(value)`` with the value computed once for a row."""
    return F.transform(F.array(value), body)[0]


def words_of(text: Column) -> Column:
    """Words of a text as an array."""
    trimmed = F.btrim(text, F.lit(BLANK_CHARS))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, BLANKS, -1))


def repeated_words(words: Column) -> Column:
    """Words in windows of eight that are found twice or more, the first time included."""
    n = F.size(words) - (WINDOW - 1)

    def covered(marked: Column) -> Column:
        # (hash, position) in order of the hash: equal neighbours are found twice
        at = F.filter(
            marked,
            lambda x, i: (F.when(i > 0, F.get(marked, i - 1)["h"]) == x["h"])
            | (F.get(marked, i + 1)["h"] == x["h"]),
        )
        return let(
            F.array_sort(F.transform(at, lambda x: x["i"])),
            lambda p: F.aggregate(
                F.transform(p, lambda x, i: F.least(F.lit(WINDOW), F.coalesce(F.get(p, i + 1) - x, F.lit(WINDOW)))),
                F.lit(0).cast("long"),
                lambda total, x: total + x,
            ),
        )

    def by_hash(hashes: Column) -> Column:
        twice = F.size(F.array_distinct(hashes)) < F.size(hashes)
        marked = F.array_sort(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        return F.when(twice, let(marked, covered)).otherwise(F.lit(0).cast("long"))

    windows = let(
        words,
        lambda w: F.transform(F.sequence(F.lit(1), n), lambda i: F.xxhash64(F.slice(w, i, WINDOW))),
    )
    return F.when(n > 1, let(windows, by_hash)).otherwise(F.lit(0).cast("long"))


def base_statistics(docs: DataFrame, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words and n_lines of each whole text; NULL has none."""
    keep = [] if keep is None else keep
    t = F.coalesce(F.col(quoted(text)), F.lit(""))
    lines = F.filter(F.split(t, "\n", -1), lambda x: F.length(F.translate(x, BLANK_CHARS, "")) > 0)
    split = docs.select(*[docs[quoted(c)] for c in keep], t.alias("t"), words_of(t).alias("w"), lines.alias("l"))
    w = F.col("w")
    return split.select(
        *keep,
        F.size(w).cast("long").alias("n_words"),
        F.length(F.translate("t", BLANK_CHARS, "")).cast("long").alias("word_chars"),
        (F.length("t") - F.length(F.translate("t", SYMBOLS, ""))).cast("long").alias("n_symbols"),
        (F.size("l") - F.size(F.array_distinct("l"))).cast("long").alias("n_dup_lines"),
        repeated_words(w).alias("n_repeat_words"),
        F.size("l").cast("long").alias("n_lines"),
    )


def base_failed(n_words: Column, n_repeat_words: Column) -> Column:
    return (n_words < 20) | (100 * n_repeat_words > 30 * n_words)


def transformed() -> list[Column]:
    """The vector of a row: length, word length, symbols and repeated lines, on scales that are near normal."""
    n = F.greatest(F.col("n_words"), F.lit(1)).cast("double")
    return [
        F.ln(n).alias("s_length"),
        F.ln(F.greatest(F.col("word_chars") / n, F.lit(0.5))).alias("s_word"),
        F.asin(F.sqrt(F.least(F.col("n_symbols") / F.greatest("word_chars", F.lit(1)), F.lit(1.0)))).alias("s_symbols"),
        F.asin(F.sqrt(F.col("n_dup_lines") / F.greatest("n_lines", F.lit(1)))).alias("s_lines"),
    ]


# --- minimum covariance determinant -----------------------------------------
GROUP = ("g_lang", "g_source")
PAIRS = [(a, b) for i, a in enumerate(STATS) for b in STATS[: i + 1]]


def _moments() -> list[Column]:
    """Sums over one middle value, so that they do not cancel."""
    out = [F.count("*").alias("m_n")]
    out += [F.avg(a).alias(f"m_{a}") for a in STATS]
    return out + [F.covar_pop(a, b).alias(f"c_{a}_{b}") for a, b in PAIRS]


def consistency(core: float) -> float:
    """What the covariance of the inner ``core`` of a normal group of four statistics is multiplied by to be the group's."""
    if core >= 1:
        return 1.0
    # the chi-square distribution of four degrees is 1 - exp(-h) (1 + h) at 2h, that of six has h * h / 2 more
    low, high = 0.0, 700.0
    for _ in range(100):
        h = (low + high) / 2
        low, high = (h, high) if 1 - math.exp(-h) * (1 + h) < core else (low, h)
    return core / (1 - math.exp(-h) * (1 + h + h * h / 2))


def _cholesky(widen: float) -> dict[str, Column]:
    """Entries of the lower factor of the covariance times ``widen``, none below its floor, by earlier entries."""
    out: dict[str, Column] = {}
    for i, a in enumerate(STATS):
        for j, b in enumerate(STATS[: i + 1]):
            value = F.col(f"c_{a}_{b}") * widen
            for k in range(j):
                value = value - F.col(f"l_{i}_{k}") * F.col(f"l_{j}_{k}")
            if i == j:
                out[f"l_{i}_{j}"] = F.sqrt(F.greatest(value + LEAST_SPREAD[a] ** 2, F.lit(FLOOR[a] ** 2)))
            else:
                out[f"l_{i}_{j}"] = value / F.col(f"l_{j}_{j}")
    return out


def _factored(estimates: DataFrame, widen: float = 1.0) -> DataFrame:
    """Estimates with their factors; one projection for each entry's inputs."""
    for name, value in _cholesky(widen).items():
        estimates = estimates.withColumn(name, value)
    return estimates.drop(*[f"c_{a}_{b}" for a, b in PAIRS])


def _distance(rows: DataFrame, estimates: DataFrame, on: tuple[str, ...]) -> DataFrame:
    """Rows with their squared distance ``d2``, by forward substitution."""
    joined = rows.join(estimates, list(on), "left") if on else rows.join(estimates)
    for i, a in enumerate(STATS):
        value = F.col(a) - F.col(f"m_{a}")
        for k in range(i):
            value = value - F.col(f"l_{i}_{k}") * F.col(f"z_{k}")
        joined = joined.withColumn(f"z_{i}", value / F.col(f"l_{i}_{i}"))
    total = sum((F.col(f"z_{i}") * F.col(f"z_{i}") for i in range(1, len(STATS))), F.col("z_0") * F.col("z_0"))
    return joined.withColumn("d2", total)


START = "start"


def _small(rows: DataFrame, groups: int) -> DataFrame:
    """One row a group, marked for a broadcast if they are few."""
    return F.broadcast(rows) if groups <= BROADCAST_GROUPS else rows


def _starts(rows: DataFrame, on: tuple[str, ...], groups: int) -> DataFrame:
    """Three factored estimates of each group, all at the medians: the statistics' own spreads without correlation, with
    that of their hyperbolic tangents, and with that of the directions from the median.

    Quantiles are approximate to one in ten thousand.
    """
    medians = rows.groupBy(*on).agg(*[F.percentile_approx(a, 0.5, 10_000).alias(f"m_{a}") for a in STATS])
    spread = [
        F.percentile_approx(F.abs(F.col(a) - F.col(f"m_{a}")), 0.5, 10_000).alias(f"d_{a}") for a in STATS
    ]
    middle = [f"m_{a}" for a in STATS]
    near = rows.join(_small(medians, groups), list(on))
    spreads = written(near.groupBy(*on, *middle).agg(*spread), "quality-spreads")
    scaled = rows.join(_small(spreads, groups), list(on)).withColumns(
        {f"z_{a}": (F.col(a) - F.col(f"m_{a}")) / F.greatest(1.4826 * F.col(f"d_{a}"), F.lit(FLOOR[a])) for a in STATS}
    )
    length = F.sqrt(sum((F.col(f"z_{a}") * F.col(f"z_{a}") for a in STATS[1:]), F.col(f"z_{STATS[0]}") * F.col(f"z_{STATS[0]}")))
    scaled = scaled.withColumn("far", F.greatest(length, F.lit(1e-9)))
    kinds = {1: lambda a: F.tanh(f"z_{a}"), 2: lambda a: F.col(f"z_{a}") / F.col("far")}
    related = scaled.groupBy(*on, *middle, *[f"d_{a}" for a in STATS]).agg(
        *[F.covar_pop(kind(a), kind(b)).alias(f"r{k}_{a}_{b}") for k, kind in kinds.items() for a, b in PAIRS]
    )

    def entry(k: int, a: str, b: str) -> Column:
        size = 1.4826 * F.col(f"d_{a}") * 1.4826 * F.col(f"d_{b}")
        if a == b:
            return size
        # a statistic without spread is related to nothing
        if not k:
            return F.lit(0.0)
        spread = F.nullif(F.sqrt(F.col(f"r{k}_{a}_{a}") * F.col(f"r{k}_{b}_{b}")), F.lit(0.0))
        return size * F.coalesce(F.col(f"r{k}_{a}_{b}") / spread, F.lit(0.0))

    made = [
        F.struct(F.lit(k).alias(START), *[entry(k, a, b).alias(f"c_{a}_{b}") for a, b in PAIRS]) for k in (0, *kinds)
    ]
    starts = related.select(*on, *middle, F.explode(F.array(*made)).alias("made"))
    return _factored(starts.select(*on, *middle, "made.*"))


def _step(rows: DataFrame, estimates: DataFrame, on: tuple[str, ...], core: float, groups: int) -> DataFrame:
    """Estimates of the rows that are closest to the present ones."""
    near = _distance(rows, _small(estimates, groups), on)
    near = near.select(*on, *STATS, "d2")
    limit = near.groupBy(*on).agg(F.percentile_approx("d2", core, 10_000).alias("limit"))
    inner = near.join(_small(limit, groups), list(on)).where("d2 <= limit")
    return _factored(written(inner.groupBy(*on).agg(*_moments()), "quality-estimates"), consistency(core))


def log_determinant() -> Column:
    """Log of the determinant of a factored scatter."""
    return 2 * sum((F.ln(f"l_{i}_{i}") for i in range(1, len(STATS))), F.ln("l_0_0"))


def core_estimates(rows: DataFrame, on: tuple[str, ...] = GROUP, core: float = CORE, steps: int = STEPS) -> DataFrame:
    """Location and factored scatter of the most compact ``core`` of each group of ``rows``.

    Every start makes ``FIRST_STEPS`` steps; that with the least determinant, the
    first of equals, makes the rest.  Rows at the limit of a core are all in it.
    """
    groups = rows.select(*on).distinct().count()
    estimates = _starts(rows, on, groups)
    first = min(steps, FIRST_STEPS)
    each = rows.withColumn(START, F.explode(F.array(*[F.lit(k) for k in range(3)])))
    for _ in range(first):
        estimates = _step(each, estimates, (*on, START), core, 3 * groups)
    held = [c for c in estimates.columns if c not in (*on, START)]
    best = F.min_by(F.struct(*held), F.struct(log_determinant(), F.col(START))).alias("best")
    estimates = estimates.groupBy(*on).agg(best).select(*on, "best.*")
    for _ in range(steps - first):
        estimates = _step(rows, estimates, on, core, groups)
    return estimates


def judge(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    lang: str = "lang",
    source: str = "source",
    cutoff: float = CUTOFF,
) -> DataFrame:
    """Base statistics, base_failed, the squared distance and kept, for each row of ``docs``.

    Rows that fail the base rules are not kept, and take no part in the estimates.
    A NULL language or source is a group of its own.  Groups of fewer than
    ``LEAST_ROWS`` rows are judged by the estimate of their language, and by that
    of all rows if those are few too.  Repeated rows count each.  A NULL text has
    no words, so it fails.  The distance is NULL where it was not needed.
    """
    none = F.lit("\x00")  # a name that no language or source has
    narrow = docs.select(
        F.col(quoted(key)).alias("key"), F.col(quoted(text)).alias("text"),
        F.coalesce(F.col(quoted(lang)).cast("string"), none).alias("g_lang"),
        F.coalesce(F.col(quoted(source)).cast("string"), none).alias("g_source"),
    )
    stats = base_statistics(narrow, "text", ["key", *GROUP])
    stats = stats.withColumn("base_failed", base_failed(F.col("n_words"), F.col("n_repeat_words")))
    stats = written(stats.select("*", *transformed()), "quality-statistics")
    good = stats.where("NOT base_failed").select(*GROUP, *STATS)
    sizes = good.groupBy(*GROUP).agg(F.count("*").alias("rows_of_group"))
    by_lang = sizes.groupBy("g_lang").agg(F.sum("rows_of_group").alias("rows_of_lang"))
    levels = written(
        sizes.join(by_lang, "g_lang").select(
            *GROUP,
            F.when(F.col("rows_of_group") >= LEAST_ROWS, F.concat_ws("\x01", *GROUP))
            .when(F.col("rows_of_lang") >= LEAST_ROWS, F.concat(F.lit("\x02"), F.col("g_lang")))
            .otherwise(F.lit("\x03")).alias("judged_by"),
        ),
        "quality-levels",
    )
    # each row takes part in its group, its language and all rows, where those judge any group
    named = F.array(F.concat_ws("\x01", *GROUP), F.concat(F.lit("\x02"), F.col("g_lang")), F.lit("\x03"))
    groups = levels.count()
    asked = levels.select("judged_by").distinct()
    taking = good.select(F.explode(named).alias("judged_by"), *STATS).join(_small(asked, groups), "judged_by")
    taking = written(taking, "quality-vectors")
    estimates = core_estimates(taking, ("judged_by",))
    placed = stats.where("NOT base_failed").join(_small(levels, groups), list(GROUP))
    judged = _distance(placed, _small(estimates, groups), ("judged_by",))
    columns = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]
    passed = judged.select("key", *columns, F.col("d2").alias("distance2"), (F.col("d2") <= cutoff).alias("kept"))
    failed = stats.where("base_failed").select(
        "key", *columns, F.lit(None).cast("double").alias("distance2"), F.lit(False).alias("kept")
    )
    return passed.unionByName(failed).withColumnRenamed("key", key)
