"""Row identity and keyed state."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from variantflow.schemas import VARIANTS
from variantflow.sources.scratch import written

_POSITION_BITS = 33  # monotonically_increasing_id keeps the position in these bits

KEY = ("row_idx", "variant")
#: keys of several rows that are broadcast; with more, all rows are shuffled
BROADCAST_KEYS = 100_000


def row_index(
    df: DataFrame, key: Sequence[str], name: str = "row_idx", partitions: int | None = None
) -> DataFrame:
    """Contiguous 0-based row number in the order of a unique, non-NULL key.

    Only the key columns are range-sorted and written, so that positions cannot
    move between jobs.  The start of each partition comes from one count for
    each partition; the wide rows are shuffled once, by the join on the key.
    Keys that are NULL or occur twice have no row number: they raise.
    """
    spark = df.sparkSession
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    tagged = (
        df.select(*key)
        .repartitionByRange(n, *key)
        .sortWithinPartitions(*key)
        .select(*key, F.monotonically_increasing_id().alias("_ri_id"))
    )
    placed = written(tagged, "row-index").select(
        *key,
        F.shiftright("_ri_id", _POSITION_BITS).cast("int").alias("_ri_part"),
        F.col("_ri_id").bitwiseAND(F.lit((1 << _POSITION_BITS) - 1)).alias("_ri_pos"),
    )
    starts, total = [], 0
    # at most n rows, one for each partition
    null = reduce(or_, [F.col(c).isNull() for c in key])
    counts = placed.groupBy("_ri_part").agg(
        F.count("*").alias("rows"), F.count_if(null).alias("nulls"), F.count_distinct(F.struct(*key)).alias("keys")
    )
    found = counts.collect()
    nulls, repeated = sum(r["nulls"] for r in found), sum(r["rows"] - r["keys"] for r in found)
    if nulls or repeated:
        raise ValueError(f"{nulls} keys are NULL and {repeated} are repeated in {list(key)}")
    for r in sorted(found, key=lambda r: r["_ri_part"]):
        starts.append((r["_ri_part"], total))
        total += r["rows"]
    offsets = spark.createDataFrame(starts, "_ri_part int, _ri_start long")
    index = placed.join(F.broadcast(offsets), "_ri_part").select(
        *key, (F.col("_ri_start") + F.col("_ri_pos")).alias(name)
    )
    return df.join(index, list(key))


def keyed_upsert(
    state: DataFrame,
    updates: DataFrame,
    key: Sequence[str] = KEY,
    order: str | Sequence[str] = "pass",
) -> DataFrame:
    """State after the updates: for each key the row that comes last by ``order``.

    An update wins over a stored row of the same order, as the last write does.

    Keys are counted first, without the other columns, and those of several rows are
    written.  Where they are at most ``BROADCAST_KEYS``, only their rows are shuffled.
    Both tables are read twice: write first what must run once, such as calls.
    """
    turn = "_turn"
    both = state.withColumn(turn, F.lit(0)).unionByName(updates.withColumn(turn, F.lit(1)))
    counted = both.groupBy(*key).agg(F.count("*").alias("_n")).where("_n > 1")
    many = written(counted.select(*[F.col(c).alias(f"_many_{c}") for c in key]), "contested-keys")
    contested = many.count()
    if not contested:
        return both.drop(turn)
    if contested > BROADCAST_KEYS:
        return latest(both, key, [*_listed(order), turn]).drop(turn)
    same = reduce(and_, [both[c].eqNullSafe(many[f"_many_{c}"]) for c in key])
    alone = both.join(F.broadcast(many), same, "left_anti")
    shared = both.join(F.broadcast(many), same, "left_semi")
    return alone.unionByName(latest(shared, key, [*_listed(order), turn])).drop(turn)


def _listed(order: str | Sequence[str]) -> list[str]:
    return [order] if isinstance(order, str) else list(order)


def latest(
    log: DataFrame, key: Sequence[str] = KEY, order: str | Sequence[str] = "pass"
) -> DataFrame:
    """The newest row of each key of an append-only log.

    ``order`` is a sequence that grows with each write.  Rows that are equal in it
    cannot be told apart by age; a hash of their columns decides between them, the
    same way each time.  The aggregate combines before the shuffle, so a key with
    very many versions leaves each task as one row.
    """
    order = _listed(order)
    rest = [c for c in log.columns if c not in key]
    newest = F.max_by(F.struct(*rest), F.struct(*order, F.xxhash64(*rest))).alias("_n")
    return (
        log.groupBy(*key)
        .agg(newest)
        .select(*[c if c in key else F.col("_n")[c].alias(c) for c in log.columns])
    )


def append_recovered(
    state: DataFrame,
    recovered: DataFrame,
    key: Sequence[str] = KEY,
    order: str | Sequence[str] = "pass",
) -> DataFrame:
    """Merge recovered rows under their own key, so that no kept row is lost."""
    return keyed_upsert(state, recovered.select(*state.columns), key, order)


def text_id(text: Column) -> Column:
    """Name of a text, which equal texts share; that of a NULL text is empty."""
    return F.coalesce(F.md5(text.cast("binary")), F.lit(""))


def once_each(rows: DataFrame, key: str = "row_idx", text: str = "original_text") -> DataFrame:
    """Rows without repetitions of a key with the same text.

    A key is no row's own where it occurs twice or is NULL; key and text are.
    Keys and names of texts are counted, which combines before the shuffle; only
    the texts of rows that repeat are shuffled, and none where no row does.
    """
    named = rows.select(F.col(key).alias("_key"), text_id(F.col(text)).alias("_text_id"))
    many = named.groupBy("_key", "_text_id").agg(F.count("*").alias("n")).where("n > 1").drop("n")
    many = written(many, "repeated-rows")
    if many.isEmpty():
        return rows
    same = rows[key].eqNullSafe(many["_key"]) & (text_id(rows[text]) == many["_text_id"])
    again = rows.join(many, same, "left_semi").dropDuplicates([key, text])
    return rows.join(many, same, "left_anti").unionByName(again)


def unfinished(
    rows: DataFrame,
    state: DataFrame | None,
    key: str = "row_idx",
    variants: Sequence[str] = VARIANTS,
    text: str = "original_text",
) -> DataFrame:
    """Rows with an unfinished variant, and the names of the finished ones in ``_finished``.

    A state with a ``text_id`` tells rows by key and text, any other by the key
    alone.  NULL keys are compared like others.
    """
    none = F.lit(None).cast("array<string>")
    if state is None:
        return rows.withColumn("_finished", none)
    by_text = "text_id" in state.columns and text in rows.columns
    names = [F.col(key).alias("_key"), *([F.col("text_id").alias("_text_id")] if by_text else [])]
    finished = (
        state.filter(F.col("variant").isin(*variants))
        .select(*names, "variant")
        .groupBy(*["_key", "_text_id"][: len(names)])
        .agg(F.collect_set("variant").alias("_finished"))
    )
    same = rows[key].eqNullSafe(finished["_key"])
    if by_text:
        same = same & (text_id(rows[text]) == finished["_text_id"])
    joined = rows.join(finished, same, "left").select(*[rows[c] for c in rows.columns], "_finished")
    return joined.filter(F.col("_finished").isNull() | (F.size("_finished") < len(variants)))


def pending(
    rows: DataFrame,
    state: DataFrame | None,
    key: str = "row_idx",
    variants: Sequence[str] = VARIANTS,
    redo: bool = False,
    spread_to: int | None = None,
    text: str = "original_text",
) -> DataFrame:
    """Long (row, variant) work list without the pairs that are already in the state.

    The finished variants of a row, at most ``len(variants)`` names, are joined
    before the fan-out: a text is shuffled once, not once for each variant.
    ``spread_to`` deals the rows out to so many tasks after that join, whose own
    shuffle the adaptive planner may coalesce.
    """
    from variantflow.operators.variants import fan_out

    if redo or state is None:
        return fan_out(rows.repartition(spread_to) if spread_to else rows, variants)
    todo = unfinished(rows, state, key, variants, text)
    return unfinished_pairs(todo.repartition(spread_to) if spread_to else todo, variants)


def unfinished_pairs(todo: DataFrame, variants: Sequence[str] = VARIANTS) -> DataFrame:
    """The unfinished (row, variant) pairs of :func:`unfinished`."""
    from variantflow.operators.variants import fan_out

    left = F.col("_finished").isNull() | ~F.array_contains("_finished", F.col("variant"))
    return fan_out(todo, variants).filter(left).drop("_finished")
