"""Near-duplicate classes of documents from an LSH forest of MinHash signatures.

A document is the set of its distinct word shingles; equal sets are one class
with one signature.  A tree of the forest is the order of all classes by a label
of eight signature values of its own.  Classes whose labels share a prefix are
neighbours in that order.  A region, the classes of one prefix, is as deep as it
has to be: four values where few classes meet, more where many do.  Members of
crowded regions are put in further orders as well, since a longer prefix is
shared less often; what is crowded at the full depth is a candidate as a whole.

Inside a region signatures are compared, and what could reach the threshold is
joined.  The connected candidates form blocks, in which links are confirmed by
counting the shingles that whole sets have in common: the member with most
candidates is compared with all others, and whoever it does not link asks for
itself.  Blocks of more than ``block_shingles`` are searched in chunks.  Nothing
is capped.

Two documents at the threshold 0.8 meet in a tree with probability 0.8**4 = 0.41,
so 20 trees miss one link in 40,000; links above it are missed less.  Sets, and
shingles, are told apart by 64-bit hashes.
"""

from __future__ import annotations

from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from variantflow.llm.batches import BLANK, ODD, U, by_group, mix, quoted, slices_of_words
from variantflow.llm.components import components
from variantflow.llm.jaccard_join import set_id, shingle_sets
from variantflow.sources.scratch import written

#: orders of the forest, and values of a label
TREES = 20
DEPTH = 8
#: values that neighbours share at least
LEAST_DEPTH = 4
#: further orders for classes of crowded regions; all need the full depth
EXTRA_TREES = 60
#: classes of a region that are compared in one task
REGION = 500
#: standard deviations below the threshold at which signatures still make candidates
SLACK = 5.5
#: shingles of a block that one task holds
BLOCK_SHINGLES = 1_000_000
#: rows of a table that is broadcast; larger ones are joined by a shuffle
BROADCAST_ROWS = 1_000_000

VALUES = TREES * DEPTH
_MULTIPLIERS = (mix(np.arange(1, VALUES + 1, dtype=U) * ODD) >> U(32)).astype(np.uint32) | np.uint32(1)


def signatures(sets: list[np.ndarray]) -> np.ndarray:
    """A row of ``VALUES`` 16-bit MinHash values for each set; zeros for the empty set."""
    out = np.zeros((len(sets), VALUES), ">u2")
    filled = [i for i, s in enumerate(sets) if len(s)]
    if not filled:
        return out
    # the order of 32-bit numbers under odd factors
    flat = (np.concatenate([sets[i] for i in filled]) >> U(32)).astype(np.uint32)
    flat ^= flat >> np.uint32(15)
    starts = np.cumsum([0] + [len(sets[i]) for i in filled[:-1]])
    product = np.empty_like(flat)
    for value, factor in enumerate(_MULTIPLIERS):
        np.multiply(flat, factor, out=product)
        least = np.minimum.reduceat(product, starts)
        out[filled, value] = (mix(least.astype(U) + U(value)) >> U(48)).astype(np.uint16)
    return out


def _binary(rows: np.ndarray) -> pa.Array:
    width = rows.dtype.itemsize * rows.shape[1]
    offsets = np.arange(len(rows) + 1, dtype=np.int32) * width
    return pa.Array.from_buffers(
        pa.binary(), len(rows), [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(rows))]
    )


SET_SCHEMA = "doc_id long, n long, sid long, sig binary"


def _set_batches(size: int):
    def run(batches):
        for batch in batches:
            ids, texts = batch.column(0), batch.column(1)
            for row, end, words in slices_of_words(texts, BLANK):
                sets = list(shingle_sets(words, size))
                yield pa.RecordBatch.from_arrays(
                    [
                        ids.slice(row, end - row).cast(pa.int64()),
                        pa.array([len(s) for s in sets], pa.int64()),
                        pa.array(np.array([set_id(s) for s in sets], U).view(np.int64)),
                        _binary(signatures(sets)),
                    ],
                    names=["doc_id", "n", "sid", "sig"],
                )

    return run


def _small(df: DataFrame) -> DataFrame:
    """Marked for a broadcast where the number of its rows allows it."""
    return F.broadcast(df) if df.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS else df


def _labels(classes: DataFrame) -> DataFrame:
    """(tree, sid, label): the place of each class in each order."""
    tree = F.explode(F.sequence(F.lit(0), F.lit(TREES - 1)))
    label = F.substring("sig", F.col("tree") * 2 * DEPTH + 1, F.lit(2 * DEPTH))
    return classes.select("sid", "sig", tree.alias("tree")).select("tree", "sid", label.alias("label"))


def _more_labels(classes: DataFrame) -> DataFrame:
    """The same for the further orders, which take the values of the signature in other combinations."""
    rng = np.random.default_rng(11)
    picks = [rng.choice(VALUES, DEPTH, replace=False).tolist() for _ in range(EXTRA_TREES)]
    labels = [F.concat(*[F.substring("sig", 2 * v + 1, 2) for v in pick]) for pick in picks]
    exploded = classes.select("sid", F.posexplode(F.array(*labels)).alias("tree", "label"))
    return exploded.withColumn("tree", F.col("tree") + TREES)


def _region(depth) -> F.Column:
    """64-bit name of a region: its order and its prefix of ``depth`` values."""
    return F.xxhash64("tree", F.lit(depth), F.substring("label", F.lit(1), F.lit(2) * F.lit(depth)))


def _regions(classes: DataFrame) -> tuple[DataFrame, DataFrame | None]:
    """(region, sid) of regions of two to ``REGION`` classes, and (a, b) links of what is crowded at full depth."""
    placed = _labels(classes).select(_region(LEAST_DEPTH).alias("region"), "sid")
    met = placed.groupBy("region").agg(F.count("*").alias("members")).where("members > 1")
    met = written(met, "forest-regions")
    few = placed.join(met.where(F.col("members") <= REGION).select("region"), "region", "left_semi")
    crowded = met.where(F.col("members") > REGION).select("region")
    if crowded.isEmpty():
        return few, None
    held = _labels(classes).withColumn("region", _region(LEAST_DEPTH)).join(_small(crowded), "region", "left_semi")
    held = written(held.select("tree", "sid", "label"), "forest-crowded")
    more = _more_labels(classes.join(_small(held.select("sid").distinct()), "sid", "left_semi"))
    looked = held.select("tree", "sid", "label", F.explode(F.sequence(F.lit(LEAST_DEPTH + 1), F.lit(DEPTH))).alias("d"))
    looked = written(looked.unionByName(more.withColumn("d", F.lit(DEPTH))).select(
        "tree", "sid", "d",
        F.xxhash64("tree", "d", F.substring("label", F.lit(1), F.col("d") * 2)).alias("region"),
    ), "forest-deeper")
    sizes = looked.groupBy("region").agg(F.count("*").alias("members"), F.min("sid").alias("least"))
    sizes = written(sizes.where("members > 1"), "forest-deeper-regions")
    over = _small(sizes.where(F.col("members") > REGION).select("region", "least"))
    dense = looked.where(F.col("d") == DEPTH).join(over, "region")
    links = dense.where("sid <> least").select(F.col("sid").alias("a"), F.col("least").alias("b"))
    # a member's region is the first that is not crowded
    through = looked.join(over.drop("least"), "region", "left_semi").groupBy("tree", "sid").agg((F.max("d") + 1).alias("first"))
    own = looked.join(through, ["tree", "sid"], "left")
    first = F.coalesce("first", F.when(F.col("tree") < TREES, LEAST_DEPTH + 1).otherwise(DEPTH))
    deeper = own.where(F.col("d") == first).select("region", "sid")
    deeper = deeper.join(sizes.where(F.col("members") <= REGION).select("region"), "region", "left_semi")
    return few.unionByName(deeper), links


def candidate_tree(sig: np.ndarray, least: int) -> Iterator[tuple[int, int]]:
    """Pairs that connect the rows which agree in at least ``least`` values, as far as they are connected."""
    left = np.arange(len(sig))
    while len(left) > 1:
        reached, left = [left[0]], left[1:]
        while reached and len(left):
            at = reached.pop()
            near = (sig[left] == sig[at]).sum(axis=1) >= least
            for other in left[near].tolist():
                yield at, other
                reached.append(other)
            left = left[~near]


EDGE_SCHEMA = "a long, b long"


def _edges(pairs: list[tuple[int, int]]) -> pa.RecordBatch:
    a, b = zip(*pairs) if pairs else ((), ())
    return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])


def _candidate_batches(least: int):
    def run(batches):
        seen: set[tuple[int, int]] = set()
        for group in by_group(batches, ["region"]):
            sids = group.column("sid").to_pylist()
            sig = np.frombuffer(b"".join(group.column("sig").to_pylist()), np.uint8).reshape(len(sids), VALUES)
            seen.update((sids[max(x, y)], sids[min(x, y)]) for x, y in candidate_tree(sig, least))
            if len(seen) > 50_000:
                yield _edges(list(seen))
                seen.clear()
        yield _edges(list(seen))

    return run


def _candidates(classes: DataFrame, threshold: Fraction, partitions: int) -> DataFrame:
    """(a, b): edges that connect all classes which may be similar."""
    t = float(threshold)
    least = int(VALUES * t - SLACK * np.sqrt(VALUES * t * (1 - t)))
    regions, links = _regions(classes)
    low = F.concat(*[F.substring("sig", 2 * v + 2, 1) for v in range(VALUES)])
    rows = regions.join(classes.select("sid", low.alias("sig")), "sid")
    dealt = rows.repartition(partitions, "region").sortWithinPartitions("region", "sid")
    found = dealt.mapInArrow(_candidate_batches(least), EDGE_SCHEMA)
    return found.unionByName(links) if links is not None else found


class Index:
    """For each shingle of some sets, the numbers of the sets that have it."""

    def __init__(self, sets: list[np.ndarray]):
        tokens = np.concatenate(sets)
        order = np.argsort(tokens, kind="stable")
        self.owner = np.repeat(np.arange(len(sets), dtype=np.int32), [len(s) for s in sets])[order]
        self.tokens, self.at = np.unique(tokens[order], return_index=True)
        self.at = np.append(self.at, len(tokens))
        self.sizes = np.array([len(s) for s in sets], np.int64)

    def similar(self, shingles: np.ndarray, t: Fraction) -> np.ndarray:
        """Numbers of the sets whose similarity to a set is at least ``t``."""
        where = np.searchsorted(self.tokens, shingles)
        where = where[where < len(self.tokens)]
        where = where[self.tokens[where] == shingles[: len(where)]] if len(where) else where
        length = self.at[where + 1] - self.at[where]
        # positions of all entries of the lists
        ends = np.cumsum(length)
        flat = np.arange(ends[-1] if len(ends) else 0) - np.repeat(ends - length, length) + np.repeat(self.at[where], length)
        overlap = np.bincount(self.owner[flat], minlength=len(self.sizes))
        union = self.sizes + len(shingles) - overlap
        return np.flatnonzero((overlap > 0) & (overlap * t.denominator >= t.numerator * union))


def link_block(sets: list[np.ndarray], hub: int, t: Fraction) -> list[int]:
    """For each set of a block, the least number in its connected component."""
    index = Index(sets)
    label = np.arange(len(sets))
    for x in [hub, *(y for y in range(len(sets)) if y != hub)]:
        # who hangs on the hub need not ask: the other end of a link that is new does
        if x == hub or label[x] != label[hub]:
            joined = np.unique(label[index.similar(sets[x], t)])
            if len(joined) > 1:
                label[np.isin(label, joined)] = joined[0]
    return label.tolist()


def _sets(group: pa.Table, size: int, column: str = "text") -> list[np.ndarray]:
    return [s for _, _, words in slices_of_words(group.column(column), BLANK) for s in shingle_sets(words, size)]


def _own(group, sets: list[np.ndarray]) -> list[int]:
    """Rows whose text has the set they stand for: a key may be that of other texts as well."""
    found = np.array([set_id(s) for s in sets], U).view(np.int64).tolist()
    return [i for i, sid in enumerate(group.column("sid").to_pylist()) if found[i] == sid]


def _own_batches(size: int):
    def run(batches):
        for batch in batches:
            yield batch.take(pa.array(_own(batch, _sets(batch, size)), pa.int64()))

    return run


def _block_batches(size: int, t: Fraction):
    """Sorted rows (block, hub, sid, text) to edges."""

    def run(batches):
        pairs: list[tuple[int, int]] = []
        for group in by_group(batches, ["block"]):
            sets = _sets(group, size)
            sids = group.column("sid").to_pylist()
            # each set once
            own = list({sids[i]: i for i in _own(group, sets)}.values())
            if len(own) > 1:
                hub = group.column("hub")[0].as_py()
                at = next((x for x, i in enumerate(own) if sids[i] == hub), 0)
                labels = link_block([sets[i] for i in own], at, t)
                pairs += [(sids[own[x]], sids[own[y]]) for x, y in enumerate(labels) if x != y]
            if len(pairs) > 10_000:
                yield _edges(pairs)
                pairs = []
        yield _edges(pairs)

    return run


def _hub_batches(size: int, t: Fraction):
    """Rows (block, hub, sid, n, text, hub_text) to (block, hub, sid, n, linked)."""

    def run(batches):
        for batch in batches:
            linked = []
            for a, b in zip(_sets(batch, size), _sets(batch, size, "hub_text")):
                common = len(np.intersect1d(a, b, assume_unique=True))
                linked.append(common * t.denominator >= t.numerator * (len(a) + len(b) - common))
            kept = [batch.column(c) for c in ("block", "hub", "sid", "n")]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(linked, pa.bool_())], names=["block", "hub", "sid", "n", "linked"])

    return run


def _chunk_batches(size: int, t: Fraction):
    """Sorted rows (block, i, j, asks, sid, text): those that ask against the others of a chunk."""

    def run(batches):
        for group in by_group(batches, ["block", "i", "j"]):
            sets, sids = _sets(group, size), group.column("sid").to_pylist()
            asks = group.column("asks").to_pylist()
            told = [i for i, a in enumerate(asks) if not a]
            pairs = []
            if told:
                index = Index([sets[i] for i in told])
                for x in (i for i, a in enumerate(asks) if a):
                    pairs += [(sids[x], sids[told[y]]) for y in index.similar(sets[x], t).tolist()]
            yield _edges(pairs)

    return run


def _confirmed(docs, members, size: int, t: Fraction, block_shingles: int, partitions: int) -> tuple[DataFrame, bool]:
    """Edges between similar classes of a block, and whether they are stars already.

    docs: (doc_id, text); members: (block, hub, sid, least, n).
    """
    weight = members.groupBy("block").agg(F.sum("n").alias("weight"))
    large = written(weight.where(F.col("weight") > block_shingles), "forest-large")

    def texts(of: DataFrame) -> DataFrame:
        return docs.join(_small(of), docs["doc_id"].eqNullSafe(of["least"])).drop("doc_id", "least")

    if large.isEmpty():
        small = texts(members)
    else:
        small = texts(members.join(_small(large.select("block")), "block", "left_anti"))
    dealt = small.select("block", "hub", "sid", "text").repartition(partitions, "block").sortWithinPartitions("block")
    edges = dealt.mapInArrow(_block_batches(size, t), EDGE_SCHEMA)
    if large.isEmpty():
        return edges, True
    crowd = texts(members.join(_small(large), "block"))
    crowd = crowd.select("block", "hub", "sid", "n", "weight", "text")
    crowd = written(crowd.mapInArrow(_own_batches(size), crowd.schema), "forest-crowd")
    hubs = crowd.where("sid = hub").select("block", F.col("text").alias("hub_text")).dropDuplicates(["block"])
    compared = crowd.join(_small(hubs), "block").select("block", "hub", "sid", "n", "text", "hub_text")
    schema = "block long, hub long, sid long, n long, linked boolean"
    compared = written(compared.mapInArrow(_hub_batches(size, t), schema), "forest-compared")
    stars = compared.where("linked AND sid <> hub").select(F.col("sid").alias("a"), F.col("hub").alias("b"))
    asking = compared.where("NOT linked").select("block", "sid").distinct()
    rest = compared.where("NOT linked").groupBy("block").agg(F.ceil(F.sum("n") / block_shingles).alias("rest"))
    rows = crowd.join(_small(rest), "block").withColumn("chunks", F.ceil(F.col("weight") / block_shingles))
    spread = F.xxhash64(F.lit("chunk"), "sid")

    def chunks(count: str):
        return F.explode(F.sequence(F.lit(0).cast("long"), F.col(count) - 1))

    told = rows.select(
        "block", chunks("rest").alias("i"), F.pmod(spread, "chunks").alias("j"), F.lit(False).alias("asks"), "sid", "text"
    )
    asks = rows.join(asking, ["block", "sid"], "left_semi").select(
        "block", F.pmod(spread, "rest").alias("i"), chunks("chunks").alias("j"), F.lit(True).alias("asks"), "sid", "text"
    )
    pairs = told.unionByName(asks).repartition(partitions, "block", "i", "j").sortWithinPartitions("block", "i", "j")
    return edges.unionByName(stars).unionByName(pairs.mapInArrow(_chunk_batches(size, t), EDGE_SCHEMA)), False


def near_duplicates(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    size: int = 5,
    threshold: Fraction | str = Fraction(8, 10),
    block_shingles: int = BLOCK_SHINGLES,
) -> DataFrame:
    """(key, n_shingles, component_id, kept) of every row of ``docs``.

    ``component_id`` is the smallest key that links reach, the row's own included;
    ``kept`` tells that it is the row's own.  The key is a whole number; another
    one raises TypeError.  NULL
    texts and texts without words have no shingles, are linked with nothing and
    kept.  Equal texts and repeated rows are one class, and rows that repeat the
    smallest key are all kept.  A NULL key is never the smallest; where a class
    or component has NULL keys only, its component is NULL and its rows are kept.
    Other columns are ignored.
    """
    t = Fraction(threshold)
    spark = docs.sparkSession
    if not isinstance(docs.schema[key].dataType, T.IntegralType):
        raise TypeError(f"{key} is no whole number; number the rows first, as with row_index")
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    narrow = docs.select(F.col(quoted(key)).cast("long").alias("doc_id"), F.col(quoted(text)).cast("string").alias("text"))
    rows = written(narrow.mapInArrow(_set_batches(size), SET_SCHEMA), "forest-sets")
    classes = rows.where("n > 0").groupBy("sid").agg(
        F.first("sig").alias("sig"), F.max("n").alias("n"), F.min("doc_id").alias("least"), F.count("*").alias("rows")
    )
    classes = written(classes, "forest-classes")
    edges = written(_candidates(classes, t, partitions).distinct(), "forest-candidates")
    blocks = components(edges).select(F.col("component").alias("block"), F.col("node").alias("sid"))
    ends = edges.select(F.explode(F.array("a", "b")).alias("sid")).groupBy("sid").agg(F.count("*").alias("degree"))
    members = blocks.join(ends, "sid").join(classes.select("sid", "least", "n"), "sid")
    hubs = members.groupBy("block").agg(F.max_by("sid", F.struct("degree", "sid")).alias("hub"))
    members = written(members.join(_small(hubs), "block").select("block", "hub", "sid", "least", "n"), "forest-members")
    found, stars = _confirmed(narrow, members, size, t, block_shingles, partitions)
    found = written(found, "forest-links")
    if stars:
        ends = found.select("b").distinct()
        linked = found.select(F.col("a").alias("sid"), F.col("b").alias("component"))
        linked = linked.unionByName(ends.select(F.col("b").alias("sid"), F.col("b").alias("component")))
    else:
        linked = components(found).withColumnRenamed("node", "sid")
    linked = linked.join(classes.select("sid", "least"), "sid")
    smallest = linked.groupBy("component").agg(F.min("least").alias("smallest"))
    linked = linked.join(smallest, "component").select("sid", "smallest")
    # the rest are classes of one row, whose component is that row
    several = classes.where("rows > 1").select("sid", "least").join(linked, "sid", "full")
    several = written(several.select("sid", F.coalesce("smallest", "least").alias("smallest")), "forest-smallest")
    told = rows.select("doc_id", "n", "sid").join(_small(several), "sid", "left")
    component = F.when(F.col("n") > 0, F.coalesce("smallest", "doc_id")).otherwise(F.col("doc_id"))
    return told.select(
        F.col("doc_id").alias(key),
        F.col("n").alias("n_shingles"),
        component.alias("component_id"),
        F.col("doc_id").eqNullSafe(component).alias("kept"),
    )
