"""Jaccard join of documents on word shingles, exact, with classes as result.

A document is the set of its distinct shingles.  Equal sets become one class.
Classes that could be similar meet in blocks by a pigeonhole rule: sets whose
Jaccard similarity is at least t differ in at most k shingles, so when the
shingle space is cut into k + 1 parts by hash, one part is the same in both.
The hash of each part is a signature; classes that share one go to the block of
the most connected class of that signature, the hub.

Inside a block the links are found by T-occurrence search over the inverted
lists of its shingles (DivideSkip): the short lists of a class are merged, the
long ones are probed by binary search, and classes that reach the required
overlap are linked.  What the hub links already needs no query of its
own, because only the connected components are returned.  A block of more than
``block_shingles`` is split: what its hub does not link is searched in chunks
against chunks of the whole block.

Nothing is capped.  Sets are told apart by 64-bit hashes.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator
from dataclasses import dataclass
from fractions import Fraction
from math import ceil, exp, floor, sqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from variantflow.llm.batches import BLANK, ODD, U, by_group, free_name, map_texts, memory_back, mix, quoted, slices_of_words
from variantflow.llm.components import components
from variantflow.llm.hash_arrays import Hashed, write_hashed
from variantflow.sources.scratch import new_folder, written

#: sizes grow by this factor from one band to the next
BAND = 1.35
#: shingles of a block that one task indexes at once
BLOCK_SHINGLES = 1_000_000
#: a set with many empty parts is cut anew, so often
LEVELS = 6


def distinct(x: np.ndarray) -> np.ndarray:
    """``np.unique`` of 64-bit numbers, by one sort."""
    x = np.sort(x)
    new = np.ones(len(x), bool)
    np.not_equal(x[1:], x[:-1], out=new[1:])
    return x[new]


def shingle_sets(words, size: int) -> Iterator[np.ndarray]:
    """Sorted distinct shingle hashes of each document of a slice."""
    h = words.hashes()
    factors = [mix(np.array([i + 1], U) * ODD)[0] | U(1) for i in range(size + 1)]
    if len(h) >= size:
        long = np.zeros(len(h) - size + 1, U)
        for i in range(size):
            long += h[i : len(h) - size + 1 + i] * factors[i]
        long = mix(long)
    for first, last in zip(words.first[:-1], words.first[1:]):
        n = last - first
        if n >= size:
            yield distinct(long[first : last - size + 1])
        elif n:
            parts = np.append(h[first:last] * np.array(factors[:n], U), np.array([n], U) * factors[size])
            yield mix(np.array([parts.sum()], U))
        else:
            yield np.empty(0, U)


def set_id(shingles: np.ndarray) -> np.uint64:
    """64-bit identity of a set; 0 for the empty set."""
    if not len(shingles):
        return U(0)
    # sums of arrays wrap around silently, those of scalars warn
    size = np.array([len(shingles)], U) * ODD
    return mix(mix(shingles).sum(keepdims=True) + size)[0] | U(1)


def set_ids(sets: list[np.ndarray]) -> np.ndarray:
    """``set_id`` of each set."""
    sizes = np.array([len(s) for s in sets], np.int64)
    sums = np.zeros(len(sets), U)
    filled = sizes > 0
    if filled.any():
        sums[filled] = np.add.reduceat(mix(np.concatenate(sets)), (np.cumsum(sizes) - sizes)[filled])
    return np.where(filled, mix(sums + sizes.astype(U) * ODD) | U(1), U(0))


class Signatures:
    """Part hashes such that similar sets of different content share at least one.

    Sets are cut into k + 1 + m parts, so similar ones have m + 1 equal parts at
    least.  Parts without shingles give no signature; a set with more than m of
    them is cut anew by another hash, and so is any similar set that shares only
    empty parts with it.
    """

    def __init__(self, threshold: Fraction):
        self.t = threshold
        #: of the shingles of both, the share that may be in one only
        self.share = (1 - threshold) / (1 + threshold)
        self.edges = [1]
        self.plans: dict[int, tuple[int, int]] = {}
        self.cuts: dict[tuple[int, int], tuple[np.ndarray, np.ndarray]] = {}

    def differing(self, largest: int) -> int:
        """Most shingles by which similar sets differ when the larger has ``largest``."""
        return floor(2 * largest * self.share)

    def band(self, n: int) -> int:
        while self.edges[-1] <= n:
            self.edges.append(max(self.edges[-1] + 1, ceil(self.edges[-1] * BAND)))
        return bisect_left(self.edges, n + 1) - 1

    def plan(self, band: int) -> tuple[int, int]:
        """(parts, empty parts that are allowed) for pairs whose larger set is of this band."""
        if band not in self.plans:
            self.band(self.edges[band])
            k = self.differing(self.edges[band + 1] - 1)
            empty = (k + 1) * exp(-float(self.edges[band] * self.t) / (k + 1))
            spare = 0 if empty < 0.05 else ceil(empty + 3 * sqrt(empty) + 1)
            self.plans[band] = (k + 1 + spare, spare) if k else (0, 0)
        return self.plans[band]

    def cut(self, parts: int, band: int, level: int) -> tuple[np.ndarray, np.ndarray]:
        """Least hash of each part, and the seeds of the parts' signatures."""
        if (band, level) not in self.cuts:
            # part i has the hashes whose upper half times parts is at least i * 2**32
            least = ((np.arange(parts, dtype=U) << U(32)) + U(parts - 1)) // U(parts)
            path = mix(np.array([band * (LEVELS + 1) + level + 1], U))
            self.cuts[band, level] = least << U(32), mix(path + np.arange(1, parts + 1, dtype=U))
        return self.cuts[band, level]

    def of(self, shingles: np.ndarray) -> np.ndarray:
        """Signatures of a sorted set: of its own size band, and of the next if partners reach it."""
        n = len(shingles)
        out = []
        if n:
            sums = sums_of(shingles)
            for band in range(self.band(n), self.band(floor(n / self.t)) + 1):
                parts, spare = self.plan(band)
                if parts:
                    self._parts(shingles, sums, parts, spare, band, 0, out)
        return np.concatenate(out) if out else np.empty(0, U)

    def _parts(self, shingles, sums, parts, spare, band, level, out) -> None:
        least, seeds = self.cut(parts, band, level)
        a = shingles
        if level:
            a = np.sort(mix(shingles ^ mix(np.array([level], U))))
            sums = sums_of(a)
        at = np.append(np.searchsorted(a, least), len(a))
        found = mix(seeds ^ (sums[at[1:]] - sums[at[:-1]]))
        filled = at[1:] > at[:-1]
        if level < LEVELS:
            out.append(found[filled])
            if parts - np.count_nonzero(filled) > spare:
                self._parts(shingles, sums, parts, spare, band, level + 1, out)
        else:
            out.append(found)


def sums_of(a: np.ndarray) -> np.ndarray:
    """Prefix sums of the mixed members of a sorted set."""
    sums = np.zeros(len(a) + 1, U)
    np.cumsum(mix(a ^ ODD), out=sums[1:])
    return sums


SET_SCHEMA = "doc_id long, n long, sid long, signatures array<long>"


def _set_batches(size: int, threshold: Fraction):
    def run(batches):
        signatures = Signatures(threshold)
        for batch in batches:
            ids, texts = batch.column(0), batch.column(1)
            for row, end, words in slices_of_words(texts, BLANK):
                sets = list(shingle_sets(words, size))
                found = [signatures.of(s) for s in sets]
                lengths = np.cumsum([0] + [len(f) for f in found])
                flat = np.concatenate(found) if found else np.empty(0, U)
                yield pa.RecordBatch.from_arrays(
                    [
                        ids.slice(row, end - row).cast(pa.int64()),
                        pa.array([len(s) for s in sets], pa.int64()),
                        pa.array(set_ids(sets).view(np.int64)),
                        pa.ListArray.from_arrays(pa.array(lengths, pa.int32()), pa.array(flat.view(np.int64))),
                    ],
                    names=["doc_id", "n", "sid", "signatures"],
                )

    return run


def _sids(words, size: int) -> np.ndarray:
    return set_ids(list(shingle_sets(words, size)))


def _text_batches(size: int, wanted: Hashed):
    """(doc_id, text) to (sid, text) of wanted sets, each set once for a task."""

    def run(batches):
        seen: set[int] = set()
        for batch in batches:
            texts = batch.column(1)
            for row, end, words in slices_of_words(texts, BLANK):
                sids = _sids(words, size)
                found, _ = wanted.look_up(sids)
                sids = sids.view(np.int64)
                new = [i for i in np.flatnonzero(found).tolist() if not (sids[i] in seen or seen.add(sids[i]))]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(sids[new]), texts.slice(row, end - row).take(pa.array(new, pa.int64()))],
                    names=["sid", "text"],
                )

    return run


class Links:
    """Union-find over the classes of a block."""

    def __init__(self, n: int):
        self.parent = list(range(n))

    def root(self, x: int) -> int:
        while self.parent[x] != x:
            self.parent[x] = self.parent[self.parent[x]]
            x = self.parent[x]
        return x

    def join(self, x: int, y: int) -> None:
        x, y = self.root(x), self.root(y)
        if x != y:
            self.parent[max(x, y)] = min(x, y)


class InvertedLists:
    """For each shingle of a block, the sorted numbers of the classes that have it."""

    def __init__(self, sets: list[np.ndarray]):
        self.sizes = np.array([len(s) for s in sets], np.int64)
        tokens = np.concatenate(sets)
        owner = np.repeat(np.arange(len(sets)), self.sizes)
        order = np.argsort(tokens, kind="stable")
        tokens = tokens[order]
        self.owner = owner[order]
        new = np.ones(len(tokens), bool)
        np.not_equal(tokens[1:], tokens[:-1], out=new[1:])
        first = np.flatnonzero(new)
        self.tokens, self.at = tokens[first], np.append(first, len(tokens))
        number = np.cumsum(new) - 1
        #: all lists one after the other as sorted numbers, so a binary search finds a class in any list
        self.entries = number * len(sets) + self.owner
        self.number = np.empty_like(number)
        self.number[order] = number
        self.ends = np.cumsum(self.sizes)

    def lists(self, shingles: np.ndarray) -> Lists:
        """The lists of a set's shingles, shortest first; unknown shingles have none."""
        where = np.searchsorted(self.tokens, shingles)
        where = where[where < len(self.tokens)]
        return self._ordered(where[self.tokens[where] == shingles[: len(where)]])

    def lists_of(self, cls: int) -> Lists:
        """The lists of the shingles of a class of the block, shortest first."""
        return self._ordered(self.number[self.ends[cls] - self.sizes[cls] : self.ends[cls]])

    def _ordered(self, where: np.ndarray) -> Lists:
        length = self.at[where + 1] - self.at[where]
        order = np.argsort(length, kind="stable")
        return Lists(self, where[order], length[order])


@dataclass
class Lists:
    """Some lists of a block, shortest first, by their numbers."""

    index: InvertedLists
    numbers: np.ndarray
    length: np.ndarray

    def merged(self, count: int) -> tuple[np.ndarray, np.ndarray]:
        """Sorted classes of the first ``count`` lists, and in how many of these each is."""
        length = self.length[:count]
        ends = np.cumsum(length)
        total = int(ends[-1]) if len(ends) else 0
        shift = np.repeat(self.index.at[self.numbers[:count]] - (ends - length), length)
        owner = self.index.owner[shift + np.arange(total)]
        if 4 * total < len(self.index.sizes):
            return np.unique(owner, return_counts=True)
        counts = np.bincount(owner, minlength=len(self.index.sizes))
        classes = np.flatnonzero(counts)
        return classes, counts[classes]

    def probed(self, first: int, last: int, classes: np.ndarray) -> np.ndarray:
        """In how many of the lists from ``first`` to ``last`` each class is, by binary search."""
        entries = self.index.entries
        wanted = self.numbers[first:last, None] * len(self.index.sizes) + classes
        at = np.minimum(np.searchsorted(entries, wanted), len(entries) - 1)
        return (entries[at] == wanted).sum(axis=0)


def similar(overlap: int, n: int, m: int, t: Fraction) -> bool:
    return overlap * t.denominator >= t.numerator * (n + m - overlap)


#: lists that are probed at once, and classes that are
PROBED_LISTS, PROBED_CLASSES = 64, 4096


def divide_skip(lists: Lists, n: int, sizes: np.ndarray, t: Fraction, skip) -> list[tuple[int, int]]:
    """Classes whose similarity to a set of ``n`` shingles is at least t, with their overlap.

    ``lists``: the inverted lists of the set's shingles, shortest first.  A
    similar class is in at least T of the n lists, hence in one of the first
    n - T + 1, however the other lists look.  Those are merged; each class that
    comes up (and that ``skip`` lets through) is probed in the long lists, until
    too few lists are left for it.
    """
    need, most = ceil(t * n), floor(n / t)
    end = len(lists.numbers)
    short = max(0, end - (need - 1))
    classes, counts = lists.merged(short)
    fits = (sizes[classes] >= need) & (sizes[classes] <= most)
    classes, counts = classes[fits], counts[fits]
    of_size, place = np.unique(sizes[classes], return_inverse=True)
    required = np.array([ceil(t * (n + m) / (1 + t)) for m in of_size.tolist()], np.int64)[place]
    fits = counts + (end - short) >= required
    fits[fits] = [not skip(cls) for cls in classes[fits].tolist()]
    found = []
    for part in np.array_split(np.flatnonzero(fits), -(-int(fits.sum()) // PROBED_CLASSES) or 1):
        left, count, least = classes[part], counts[part], required[part]
        for at in range(short, end, PROBED_LISTS):
            if not len(left):
                break
            count = count + lists.probed(at, min(at + PROBED_LISTS, end), left)
            hopeful = count + max(0, end - at - PROBED_LISTS) >= least
            left, count, least = left[hopeful], count[hopeful], least[hopeful]
        found += zip(left.tolist(), count.tolist())
    return found


def link_block(sets: list[np.ndarray], hub: int, t: Fraction) -> Links:
    """Connected components of the similar sets of a block."""
    links = Links(len(sets))
    if len(sets) == 1:
        return links
    if len(sets) == 2:
        if similar(len(np.intersect1d(*sets, assume_unique=True)), len(sets[0]), len(sets[1]), t):
            links.join(0, 1)
        return links
    index = InvertedLists(sets)
    near = index.lists_of(hub)
    for y, overlap in zip(*(x.tolist() for x in near.merged(len(near.numbers)))):
        if similar(overlap, len(sets[hub]), len(sets[y]), t):
            links.join(hub, y)
    for x in range(len(sets)):
        # two classes that both hang on the hub are connected; all others ask for themselves
        if links.root(x) != links.root(hub):
            skip = lambda y, x=x: links.root(y) == links.root(x)
            for y, _ in divide_skip(index.lists_of(x), len(sets[x]), index.sizes, t, skip):
                links.join(x, y)
    return links


def link_chunks(queries: list[np.ndarray], members: list[np.ndarray], t: Fraction) -> list[tuple[int, int]]:
    """(query, member) pairs of similar sets that connect all that is connected."""
    index = InvertedLists(members)
    links = Links(len(members) + len(queries))
    out = []
    for x, shingles in enumerate(queries):
        node = len(members) + x
        skip = lambda y, node=node: links.root(y) == links.root(node)
        for y, _ in divide_skip(index.lists(shingles), len(shingles), index.sizes, t, skip):
            links.join(node, y)
            out.append((x, y))
    return out


def sets_of_texts(texts, size: int) -> list[np.ndarray]:
    return [s for _, _, words in slices_of_words(texts, BLANK) for s in shingle_sets(words, size)]


EDGE_SCHEMA = "a long, b long"


def _edge_batch(pairs) -> pa.RecordBatch:
    a, b = zip(*pairs) if pairs else ((), ())
    return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])


def _block_batches(size: int, t: Fraction):
    """Sorted rows (hub, i, j, query, sid, text) to edges between classes.

    A block with i < 0 is whole; others are chunk i of the queries against chunk j of the rest.
    """

    def run(batches):
        pairs: list[tuple[int, int]] = []
        for group in by_group(batches, ["hub", "i", "j"]):
            sids = group.column("sid").to_pylist()
            sets = sets_of_texts(group.column("text"), size)
            if group.column("i")[0].as_py() < 0:
                links = link_block(sets, sids.index(group.column("hub")[0].as_py()), t)
                pairs += [(sids[x], sids[links.root(x)]) for x in range(len(sids)) if links.root(x) != x]
            else:
                query = group.column("query").to_numpy()
                asks, members = np.flatnonzero(query), np.flatnonzero(~query)
                if len(asks) and len(members):
                    found = link_chunks([sets[x] for x in asks], [sets[y] for y in members], t)
                    pairs += [(sids[asks[x]], sids[members[y]]) for x, y in found]
            if len(pairs) > 10_000:
                yield _edge_batch(pairs)
                pairs = []
        yield _edge_batch(pairs)

    return run


def _hub_batches(size: int, t: Fraction):
    """(hub, sid, n, text, hub_text) to the same with the verdict ``linked`` instead of the hub's text."""

    def run(batches):
        for batch in batches:
            sets = sets_of_texts(batch.column("text"), size)
            hubs = sets_of_texts(batch.column("hub_text"), size)
            linked = [
                similar(len(np.intersect1d(a, b, assume_unique=True)), len(a), len(b), t)
                for a, b in zip(sets, hubs)
            ]
            kept = [batch.column(c) for c in ("hub", "sid", "n", "text")]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(linked, pa.bool_())], names=["hub", "sid", "n", "text", "linked"])

    return run


def _edges_of_blocks(members, texts, size: int, t: Fraction, block_shingles: int) -> DataFrame:
    """Edges between similar classes of the same block.

    members: (hub, sid, n); texts: (sid, text).
    """
    spark = members.sparkSession
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    totals = members.groupBy("hub").agg(F.ceil(F.sum("n") / block_shingles).alias("chunks"))
    large = written(totals.where("chunks > 1"), "jaccard-large")
    rows = members.join(texts, "sid")

    def searched(df: DataFrame) -> DataFrame:
        df = df.select("hub", "i", "j", "query", "sid", "text")
        dealt = df.repartition(partitions, "hub", "i", "j").sortWithinPartitions("hub", "i", "j")
        return dealt.mapInArrow(memory_back(_block_batches(size, t)), EDGE_SCHEMA)

    if large.isEmpty():
        whole = F.lit(-1).cast("long")
        return searched(rows.withColumns({"i": whole, "j": whole, "query": F.lit(False)}))
    whole = F.lit(-1).cast("long")
    small = rows.join(large, "hub", "left_anti").withColumns({"i": whole, "j": whole, "query": F.lit(False)})
    hubs = texts.select(F.col("sid").alias("hub"), F.col("text").alias("hub_text")).join(large.select("hub"), "hub", "left_semi")
    split = rows.join(hubs, "hub").select("hub", "sid", "n", "text", "hub_text")
    schema = "hub long, sid long, n long, text string, linked boolean"
    split = written(split.mapInArrow(_hub_batches(size, t), schema), "jaccard-hubs")
    rest = split.where("NOT linked").groupBy("hub").agg(F.ceil(F.sum("n") / block_shingles).alias("rest"))
    chunked = split.join(rest.join(large, "hub"), "hub")
    spread = F.xxhash64(F.lit("chunk"), "sid")

    def chunks(count: str):
        return F.explode(F.sequence(F.lit(0).cast("long"), F.col(count) - 1))

    asks = chunked.where("NOT linked").select(
        "hub", F.pmod(spread, "rest").alias("i"), chunks("chunks").alias("j"), F.lit(True).alias("query"), "sid", "text"
    )
    told = chunked.select(
        "hub", chunks("rest").alias("i"), F.pmod(spread, "chunks").alias("j"), F.lit(False).alias("query"), "sid", "text"
    )
    stars = split.where("linked AND sid <> hub").select(F.col("sid").alias("a"), F.col("hub").alias("b"))
    return searched(small).unionByName(searched(asks.unionByName(told))).unionByName(stars)


def _labels(docs: DataFrame, key: str, text: str, size: int, t: Fraction, block_shingles: int):
    """(rows (doc_id, n, sid), labels (sid, least, smallest)): each class with the smallest keys of it and of its component."""
    spark = docs.sparkSession
    if not isinstance(docs.schema[key].dataType, T.IntegralType):
        raise TypeError(f"{key} is no whole number; number the rows first, as with row_index")
    narrow = docs.select(F.col(quoted(key)).cast("long").alias("doc_id"), F.col(quoted(text)).alias("text"))
    rows = written(narrow.mapInArrow(memory_back(_set_batches(size, t)), SET_SCHEMA), "jaccard-sets")
    filled = rows.where("n > 0")
    postings = (
        filled.groupBy("sid").agg(F.first("signatures").alias("signatures"))
        .select("sid", F.explode("signatures").alias("signature"))
    )
    sharing = F.count("*").over(Window.partitionBy("signature"))
    postings = written(postings.withColumn("members", sharing).where("members > 1"), "jaccard-postings")
    weight = postings.groupBy("sid").agg(F.sum("members").alias("weight"))
    hubs = (
        postings.join(weight, "sid").groupBy("signature")
        .agg(F.max_by("sid", F.struct("weight", "sid")).alias("hub"))
    )
    members = postings.join(hubs, "signature").select("hub", "sid").distinct()
    sizes = filled.groupBy("sid").agg(F.max("n").alias("n"))
    members = written(members.join(sizes, "sid"), "jaccard-members")
    # every hub is a member of its own block; classes without a partner need no text
    wanted = write_hashed(members.select("sid").distinct(), new_folder(spark, "jaccard-wanted"), "sid", [])
    texts = narrow.mapInArrow(memory_back(_text_batches(size, wanted)), "sid long, text string").dropDuplicates(["sid"])
    found = components(_edges_of_blocks(members, texts, size, t, block_shingles))
    least = filled.groupBy("sid").agg(F.min("doc_id").alias("least"))
    least = least.join(found.withColumnRenamed("node", "sid"), "sid", "left")
    least = least.withColumn("component", F.coalesce("component", "sid"))
    smallest = least.groupBy("component").agg(F.min("least").alias("smallest"))
    return rows, least.join(smallest, "component").select("sid", "least", "smallest", "component")


def jaccard_classes(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    size: int = 5,
    threshold: Fraction | str = Fraction(8, 10),
    block_shingles: int = BLOCK_SHINGLES,
) -> DataFrame:
    """(key, n_shingles, component_id) of every row of ``docs``.

    ``component_id`` is the smallest key that links reach, the row's own
    included.  The key is a whole number; another one raises TypeError.  NULL texts and texts without words have no shingles and are
    linked with nothing.  Repeated rows and equal texts are one class.  A NULL
    key is never the smallest; a class of NULL keys alone has a NULL component.
    Other columns of ``docs`` are ignored.
    """
    rows, labels = _labels(docs, key, text, size, Fraction(threshold), block_shingles)
    return rows.select("doc_id", "n", "sid").join(labels, "sid", "left").select(
        F.col("doc_id").alias(key),
        F.col("n").alias("n_shingles"),
        F.when(F.col("n") > 0, F.col("smallest")).otherwise(F.col("doc_id")).alias("component_id"),
    )


def _stay_job(size: int, stay: Hashed):
    def job():
        def work(keys: pa.Array, texts: pa.Array):
            sids = np.concatenate([_sids(words, size) for _, _, words in slices_of_words(texts, BLANK)] or [np.empty(0, U)])
            found, columns = stay.look_up(sids)
            null = np.array(keys.is_null().to_numpy(zero_copy_only=False), bool)
            same = np.where(columns["no_key"] == 1, null, ~null & (keys.fill_null(0).to_numpy() == columns["least"]))
            kept = (sids == 0) | (found & same)
            again = kept & found & (columns["again"] == 1)
            return [pa.array(kept), pa.array(sids.view(np.int64), mask=~again)]

        return work

    return job


def one_of_each(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    size: int = 5,
    threshold: Fraction | str = Fraction(8, 10),
    block_shingles: int = BLOCK_SHINGLES,
) -> DataFrame:
    """The rows of ``docs`` that stay when one document of each component stays, that of the smallest key.

    The key is a whole number; another one raises TypeError.  Of repeated rows one stays.  Documents without words are linked with nothing
    and all stay.  Where a component has NULL keys only, one of its rows stays.
    All columns are kept; no text is shuffled for it, as each task looks up its
    own rows in a sorted array of the classes that stay.
    """
    spark = docs.sparkSession
    rows, labels = _labels(docs, key, text, size, Fraction(threshold), block_shingles)
    # the class that holds the smallest key, or where there is none the component's own
    stay = labels.groupBy("component").agg(
        F.min_by(F.struct("sid", "least"), F.struct(F.col("least").isNull(), "least", "sid")).alias("c")
    ).select("c.*")
    often = rows.where("n > 0").groupBy("sid", F.col("doc_id").alias("least")).agg(F.count("*").alias("rows"))
    stay = stay.withColumnRenamed("sid", "s").withColumnRenamed("least", "l")
    stay = stay.join(often, (F.col("s") == F.col("sid")) & F.col("l").eqNullSafe(F.col("least")))
    stay = written(stay.select(
        "sid", F.coalesce("least", F.lit(0)).alias("least"), F.col("least").isNull().cast("long").alias("no_key"),
        (F.col("rows") > 1).cast("long").alias("again"),
    ), "jaccard-stay")
    arrays = write_hashed(stay, new_folder(spark, "jaccard-stay"), "sid", ["least", "no_key", "again"])
    stays, own = free_name(docs, "stays"), free_name(docs, "own_class")
    marked = map_texts(
        docs, text, docs.columns, [(stays, "boolean"), (own, "bigint")], _stay_job(size, arrays), [key]
    ).where(F.col(stays))
    if stay.where("again = 1").isEmpty():
        return marked.drop(stays, own)
    once = marked.where(F.col(own).isNull())
    return once.unionByName(marked.where(F.col(own).isNotNull()).dropDuplicates([own])).drop(stays, own)
