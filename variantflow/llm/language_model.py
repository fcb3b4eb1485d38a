"""Perplexity by an interpolated modified Kneser-Ney model of any order from two.

Words and pairs are counted by Spark jobs: each task adds up the counts of its
documents in arrays, cuts them by ranges of keys and sends one row for each range;
the task of a range merges what comes, and writes it as sorted arrays to the
shared folder.  Words are sorted 64-bit hashes with counts, and a word's number is
its place among them; pairs are sorted 64-bit numbers made of the numbers of both
words, with counts; what a context needs is a dense array over the words.

Scoring tasks map the arrays into memory and look up the distinct words and pairs
of each slice of texts by binary search.  The model is never loaded as a whole by
the driver nor by a task, and there is no shuffle of tokens.

    p(w | v) = max(c(vw) - D(c(vw)), 0) / c(v.) + g(v) p1(w)
    p1(w)    = max(a(w) - E(a(w)), 0) / A + g / (V + 1)

c counts pairs, a(w) the different words before w, A all different pairs; D and E
are the three modified discounts, g what they take away.  Every document starts
with a start mark and ends with an end token.

Higher orders work alike, each on top of the one below, with discounts of its own.
Only the top order has counts of the text; a shorter sequence counts the different
words before it, or its own occurrences if it begins with the start mark.  Sequences
of three words and more are dealt by a 64-bit hash of their context and kept as
sorted contexts, how many words each one has, the words and their counts.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from variantflow.llm.batches import BLANK, U, Words, by_group, map_texts, mix, quoted, slices_of_words
from variantflow.llm.hash_arrays import (
    Counting, Shards, find, first_id, hash_shard, id_shard, merge_counts, runs,
)
from variantflow.sources.scratch import new_folder, shuffles_dropped, written

#: hash of the end token
END = mix(np.array([0x5EED], U))[0]
#: tokens or distinct words for each range of keys
SHARD_TOKENS = 2_000_000
LEAST_SHARDS = 64
#: bytes of texts whose words are looked up together
SLICE = 2 << 20
#: distinct sequences that a counting task holds
GRAMS_HELD = 2_000_000
BLOCK = "shard int, high binary, low binary, counts binary"


def _packed(numbers: np.ndarray) -> bytes:
    """32-bit numbers with the first bytes of all before the second, which leaves little of the high ones."""
    planes = np.ascontiguousarray(numbers, np.uint32).view(np.uint8).reshape(-1, 4).T
    return len(numbers).to_bytes(8, "little") + pa.compress(planes.tobytes(), "zstd", asbytes=True)


def _unpacked(data: bytes) -> np.ndarray:
    size = int.from_bytes(data[:8], "little")
    planes = np.frombuffer(pa.decompress(data[8:], 4 * size, "zstd"), np.uint8)
    return np.ascontiguousarray(planes.reshape(4, size).T).view(np.uint32).reshape(-1)


def _steps(numbers: np.ndarray) -> np.ndarray:
    """Sorted 32-bit numbers as differences."""
    return np.diff(numbers, prepend=np.uint32(0))


def _block(shard: int, keys: np.ndarray, counts: np.ndarray) -> tuple:
    """One row of counts; the halves of sorted keys are kept apart, the upper ones as steps."""
    halves = keys.view(np.uint32).reshape(-1, 2)
    return shard, _packed(_steps(halves[:, 1])), _packed(halves[:, 0]), _packed(counts)


def _blocks(rows: list[tuple]) -> pa.RecordBatch:
    columns = zip(*rows) if rows else ([], [], [], [])
    types = [pa.int32(), pa.binary(), pa.binary(), pa.binary()]
    return pa.RecordBatch.from_arrays(
        [pa.array(list(c), t) for c, t in zip(columns, types)], names=["shard", "high", "low", "counts"]
    )


def _unblock(group: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    keys, counts = [], []
    for high, low, n in zip(*(group.column(c).to_pylist() for c in ("high", "low", "counts"))):
        low = _unpacked(low)
        both = np.empty((len(low), 2), np.uint32)
        both[:, 1], both[:, 0] = np.cumsum(_unpacked(high), dtype=np.uint32), low
        keys.append(both.reshape(-1).view(U))
        counts.append(_unpacked(n).astype(np.int64))
    return merge_counts(keys, counts)


def _dealt(df: DataFrame, shards: int) -> DataFrame:
    return df.repartition(shards, "shard").sortWithinPartitions("shard")


class Vocabulary:
    """Numbers and counts of words, by their hashes."""

    def __init__(self, folder: str, sizes: list[int]):
        self.keys = Shards(folder, "words", U)
        self.counts = Shards(folder, "counts", np.int64)
        self.first = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)
        self.shards = len(sizes)

    @property
    def size(self) -> int:
        return int(self.first[-1])

    def look_up(self, sorted_hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(number or -1, count) of each hash."""
        shards = hash_shard(sorted_hashes, self.shards)
        at = find(self.keys, shards, sorted_hashes)
        counts = np.zeros(len(at), np.int64)
        for shard, a, b in runs(shards):
            known = np.flatnonzero(at[a:b] >= 0) + a
            if len(known):
                counts[known] = self.counts[shard][at[known]]
        return np.where(at >= 0, at + self.first[shards], -1), counts


def _tokens(words: Words) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all tokens, an end after each document, and the first token of each document."""
    n = words.counts()
    first = words.first + np.arange(len(words.first))
    out = np.full(int(first[-1]), END, U)
    inside = np.ones(len(out), bool)
    inside[first[1:] - 1] = False
    out[inside] = words.hashes()
    assert len(n) == len(first) - 1
    return out, first


def _numbers(vocabulary: Vocabulary, tokens: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(number or -1, count) of each token."""
    distinct, back = np.unique(tokens, return_inverse=True)
    ids, counts = vocabulary.look_up(distinct)
    return ids[back], counts[back]


def _before(ids: np.ndarray, first: np.ndarray, start: int) -> np.ndarray:
    """The token before each token; the start mark before the first of a document."""
    out = np.empty(len(ids), np.int64)
    out[1:] = ids[:-1]
    out[first[:-1]] = start
    return out


def _pairs(before: np.ndarray, ids: np.ndarray) -> np.ndarray:
    return (before.astype(U) << U(32)) | ids.astype(U)


def _count_batches(keys_of, shard_of, job):
    """Texts to blocks of counted keys."""

    def run(batches) -> Iterator[pa.RecordBatch]:
        state = job()
        counting = Counting()

        def blocks():
            keys, counts = counting.take()
            return _blocks([_block(s, keys[a:b], counts[a:b]) for s, a, b in runs(shard_of(keys))])

        for batch in batches:
            for _, _, words in slices_of_words(batch.column(0), BLANK, SLICE):
                if counting.add(keys_of(state, words)):
                    yield blocks()
        yield blocks()

    return run


def _count_words(docs: DataFrame, folder: str, shards: int) -> tuple[list[int], int]:
    """Write the vocabulary; (words of each shard, tokens)."""
    job = _count_batches(lambda _, w: _tokens(w)[0], lambda keys: hash_shard(keys, shards), lambda: None)

    def merge(batches):
        keys, counts = Shards(folder, "words", U), Shards(folder, "counts", np.int64)
        for group in by_group(batches, ["shard"]):
            shard = group.column("shard")[0].as_py()
            k, c = _unblock(group)
            keys.save(shard, k)
            counts.save(shard, c)
            yield pa.RecordBatch.from_pydict({"shard": pa.array([shard], pa.int32()), "n": [len(k)], "total": [int(c.sum())]})

    found = _dealt(docs.mapInArrow(job, BLOCK), shards).mapInArrow(merge, "shard int, n long, total long").collect()
    sizes = [0] * shards
    for r in found:
        sizes[r.shard] = r.n
    return sizes, sum(r.total for r in found)


def _write_empty(folder: str, name: str, dtype, shards) -> None:
    for shard in shards:
        Shards(folder, name, dtype).save(shard, np.empty(0, dtype))


def discounts(n: list[int]) -> list[float]:
    """The modified discounts of counts 1, 2 and more, from how many have count 1, 2, 3, 4.

    Where too few are counted, a discount falls back to half a count.
    """
    if not n[0] or not n[1]:
        return [0.5, 0.5, 0.5]
    y = n[0] / (n[0] + 2 * n[1])
    out = []
    for k in (1, 2, 3):
        d = k - (k + 1) * y * n[k] / n[k - 1] if n[k - 1] else 0.5
        out.append(d if 0 < d <= k else 0.5)
    return out


def _count_of_counts(counts: np.ndarray) -> list[int]:
    return [int((counts == k).sum()) for k in (1, 2, 3, 4)]


def _discount(counts: np.ndarray, d: list[float]) -> np.ndarray:
    return np.array([0.0, *d])[np.minimum(counts, 3)]


def _context_hash(contexts: np.ndarray) -> np.ndarray:
    """Hash of each row of word numbers."""
    out = np.zeros(len(contexts), U)
    for column in contexts.T:
        out = mix(out ^ (column.astype(U) + U(1)))
    return out


def _sums(counts: np.ndarray, heads: np.ndarray) -> np.ndarray:
    """(total, how many are 1, 2, more) of the counts from each head to the next."""
    kinds = (counts, counts == 1, counts == 2, counts >= 3)
    return np.stack([np.add.reduceat(x.astype(np.int64), heads) for x in kinds], axis=1)


def _merge_grams(grams: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct rows with their summed counts."""
    ids, c = np.concatenate(grams), np.concatenate(counts)
    if not len(ids):
        return ids, c
    # the place of the words so far among all such, and the next word, are one number
    place = ids[:, 0]
    for column in ids.T[1:-1]:
        place = np.unique(_pairs(place, column), return_inverse=True)[1]
    key = _pairs(place, ids[:, -1])
    order = np.argsort(key)
    key = key[order]
    first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
    return ids[order[first]], np.add.reduceat(c[order], first)


GRAMS = "shard int, ids binary, counts binary"


def _gram_blocks(ids: np.ndarray, counts: np.ndarray, shards: int) -> pa.RecordBatch:
    """A row for each shard of sorted grams; columns apart and the first one as steps, as that compresses well."""
    of = hash_shard(_context_hash(ids[:, :-1]), shards)
    order = np.argsort(of, kind="stable")
    rows = []
    for shard, a, b in runs(of[order]):
        columns = ids[order[a:b]].T.copy()
        columns[0] = _steps(columns[0])
        rows.append((shard, _packed(columns.reshape(-1)), _packed(counts[order[a:b]])))
    columns = zip(*rows) if rows else ([], [], [])
    return pa.RecordBatch.from_arrays(
        [pa.array(list(c), t) for c, t in zip(columns, [pa.int32(), pa.binary(), pa.binary()])],
        names=["shard", "ids", "counts"],
    )


def _grams(group: pa.Table, k: int) -> tuple[np.ndarray, np.ndarray]:
    ids, counts = [], []
    for columns, n in zip(group.column("ids").to_pylist(), group.column("counts").to_pylist()):
        columns = _unpacked(columns).reshape(k, -1)
        columns[0] = np.cumsum(columns[0], dtype=np.uint32)
        ids.append(columns.T)
        counts.append(_unpacked(n).astype(np.int64))
    return _merge_grams(ids, counts)


#: contexts for each stored place of the words after them
STEP = 16
#: words after a context from which their counts are stored added up
WIDE = 16
LEVEL = {"contexts": U, "starts": np.int64, "sizes": np.uint8, "wide": np.int64, "widths": np.int64, "wide-sums": np.int64,
         "next": np.uint32, "next-counts": np.uint8, "next-many": np.int64, "next-often": np.int64, "told": np.int64}


class Level:
    """Arrays of the sequences of ``k`` words, three or more."""

    def __init__(self, folder: str, k: int, shards: int):
        self.shards = shards
        self.arrays = {name: Shards(folder, f"{name}-of-{k}", dtype) for name, dtype in LEVEL.items()}

    def save(self, shard: int, ids: np.ndarray, counts: np.ndarray) -> None:
        context, word = _context_hash(ids[:, :-1]), ids[:, -1]
        order = np.lexsort((word, context))
        context, word, c = context[order], word[order], counts[order]
        contexts, starts, sizes = np.unique(context, return_index=True, return_counts=True)
        wide, large = np.flatnonzero(sizes >= WIDE), np.flatnonzero(c >= 255)
        padded = np.append(np.minimum(sizes, 255), np.zeros(-len(sizes) % STEP, np.int64))
        for name, array in zip(LEVEL, [
            contexts, starts[::STEP], padded, wide, sizes[wide], _sums(c, starts)[wide].reshape(-1), word,
            np.minimum(c, 255), large, c[large], np.array(_count_of_counts(c)),
        ]):
            self.arrays[name].save(shard, array)

    def told(self) -> list[int]:
        """How many sequences have count 1, 2, 3, 4."""
        return np.sum([self.arrays["told"][shard] for shard in range(self.shards)], axis=0).tolist()

    def _counts(self, shard: int, at: np.ndarray) -> np.ndarray:
        counts = self.arrays["next-counts"][shard][at].astype(np.int64)
        large = np.flatnonzero(counts == 255)
        if len(large):
            counts[large] = self.arrays["next-often"][shard][np.searchsorted(self.arrays["next-many"][shard], at[large])]
        return counts

    def _bounds(self, shard: int, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where the words after the contexts at these places start, and how many they are."""
        step, place = np.divmod(at, STEP)
        sizes = np.asarray(self.arrays["sizes"][shard]).reshape(-1, STEP)[step].astype(np.int64)
        row, column = np.nonzero(sizes == 255)
        if len(row):
            wide = np.searchsorted(self.arrays["wide"][shard], step[row] * STEP + column)
            sizes[row, column] = self.arrays["widths"][shard][wide]
        ends = np.cumsum(sizes, axis=1)
        rows = np.arange(len(at))
        size = sizes[rows, place]
        return self.arrays["starts"][shard][step] + ends[rows, place] - size, size

    def look_up(self, contexts: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Count of each word after its context, and the context's (total, counts of 1, of 2, of more)."""
        count, stats = np.zeros(len(ids), np.int64), np.zeros((len(ids), 4), np.int64)
        known = np.flatnonzero((contexts >= 0).all(axis=1))
        hashes, back = np.unique(_context_hash(contexts[known]), return_inverse=True)
        of = hash_shard(hashes, self.shards)
        at = find(self.arrays["contexts"], of, hashes)
        order = np.argsort(back, kind="stable")
        for shard, a, b in runs(of[back[order]]):
            rows, place = known[order[a:b]], at[back[order[a:b]]]
            rows, place = rows[place >= 0], place[place >= 0]
            if not len(rows):
                continue
            words = np.asarray(self.arrays["next"][shard])
            distinct, of_row = np.unique(place, return_inverse=True)
            starts, size = self._bounds(shard, distinct)
            wide = size >= WIDE
            sums = np.empty((len(distinct), 4), np.int64)
            at_wide = np.searchsorted(self.arrays["wide"][shard], distinct[wide])
            sums[wide] = self.arrays["wide-sums"][shard].reshape(-1, 4)[at_wide]
            few = size[~wide]
            heads = np.cumsum(few) - few
            c = self._counts(shard, np.repeat(starts[~wide] - heads, few) + np.arange(few.sum()))
            sums[~wide] = _sums(c, heads)
            stats[rows] = sums[of_row]
            # binary search of each word between its context's bounds
            low = starts[of_row]
            end = low + size[of_row]
            high = end.copy()
            while (open_ := low < high).any():
                middle = (low + high) // 2
                less = open_ & (words[np.minimum(middle, len(words) - 1)] < ids[rows])
                low, high = np.where(less, middle + 1, low), np.where(open_ & ~less, middle, high)
            found = (low < end) & (words[np.minimum(low, len(words) - 1)] == ids[rows])
            count[rows[found]] = self._counts(shard, low[found])
        return count, stats


def _count_grams(docs: DataFrame, folder: str, sizes: list[int], order: int, shards: int) -> DataFrame:
    """Blocks of counted sequences of ``order`` words; as many start marks stand before a document as they need."""
    start = sum(sizes)

    def run(batches) -> Iterator[pa.RecordBatch]:
        vocabulary = Vocabulary(folder, sizes)
        grams, counts, held, merged = [], [], 0, 0
        for batch in batches:
            for _, _, words in slices_of_words(batch.column(0), BLANK, SLICE):
                hashes, first = _tokens(words)
                columns = [_numbers(vocabulary, hashes)[0]]
                for _ in range(order - 1):
                    columns.insert(0, _before(columns[0], first, start))
                rows = np.stack(columns, axis=1).astype(np.uint32)
                k, c = _merge_grams([rows], [np.ones(len(rows), np.int64)])
                grams.append(k)
                counts.append(c)
                held += len(k)
                if held - merged > GRAMS_HELD:
                    k, c = _merge_grams(grams, counts)
                    grams, counts, held, merged = [k], [c], len(k), len(k)
                    if merged > GRAMS_HELD:
                        yield _gram_blocks(k, c, shards)
                        grams, counts, held, merged = [], [], 0, 0
        if grams:
            yield _gram_blocks(*_merge_grams(grams, counts), shards)

    return docs.mapInArrow(run, GRAMS)


def _keep_grams(blocks: DataFrame, folder: str, k: int, n: int, shards: int) -> DataFrame:
    """Write the sequences of ``k`` words as their blocks are read; blocks of those one shorter."""
    level, nothing = Level(folder, k, shards), np.empty((0, k), np.uint32)
    for shard in range(shards):
        level.save(shard, nothing, np.empty(0, np.int64))

    def merge(batches) -> Iterator[pa.RecordBatch]:
        level = Level(folder, k, shards)
        for group in by_group(batches, ["shard"]):
            ids, c = _grams(group, k)
            # a second start mark is no word before: the shorter sequence begins the document
            begins = (ids[:, 0] == n - 1) & (ids[:, 1] == n - 1)
            level.save(group.column("shard")[0].as_py(), ids[~begins], c[~begins])
            shorter, c = _merge_grams([ids[:, 1:]], [np.where(begins, c, 1)])
            if k > 3:
                yield _gram_blocks(shorter, c, shards)
            else:
                keys = _pairs(shorter[:, 0], shorter[:, 1])
                yield _blocks([_block(s, keys[a:b], c[a:b]) for s, a, b in runs(id_shard(keys >> U(32), n, shards))])

    return _dealt(blocks, shards).mapInArrow(merge, GRAMS if k > 3 else BLOCK)


@dataclass
class Model:
    """Where the arrays lie, and the few numbers that hold for all of them."""

    folder: str
    sizes: list[int]  # words of each range of hashes
    tokens: int
    shards: int  # ranges of word numbers
    pair_discounts: list[float]
    word_discounts: list[float]
    different_pairs: int
    taken: float  # what the discounts leave for unseen words, as a share
    gram_discounts: list[list[float]] = field(default_factory=list)  # of three words, four, ...

    @property
    def words(self) -> int:
        return sum(self.sizes)


def _count_pairs(docs: DataFrame, folder: str, sizes: list[int], tokens: int, order: int):
    n = sum(sizes) + 1  # the start mark is the last number
    shards = max(LEAST_SHARDS, -(-tokens // SHARD_TOKENS))

    def keys_of(vocabulary, words):
        hashes, first = _tokens(words)
        ids, _ = _numbers(vocabulary, hashes)
        return _pairs(_before(ids, first, n - 1), ids)

    job = _count_batches(keys_of, lambda keys: id_shard(keys >> U(32), n, shards), lambda: Vocabulary(folder, sizes))

    def merge(batches):
        pairs, counts = Shards(folder, "pairs", U), Shards(folder, "pair-counts", np.uint8)
        many, often = Shards(folder, "many", np.int64), Shards(folder, "often", np.int64)
        contexts = Shards(folder, "contexts", np.int64)
        for group in by_group(batches, ["shard"]):
            shard = group.column("shard")[0].as_py()
            k, c = _unblock(group)
            pairs.save(shard, k)
            counts.save(shard, np.minimum(c, 255))
            large = np.flatnonzero(c >= 255)
            many.save(shard, large)
            often.save(shard, c[large])
            low = first_id(shard, n, shards)
            width = first_id(shard + 1, n, shards) - low
            v = (k >> U(32)).astype(np.int64) - low
            stats = [np.bincount(v, c, width)] + [np.bincount(v[m], minlength=width) for m in (c == 1, c == 2, c >= 3)]
            contexts.save(shard, np.stack(stats, axis=1).astype(np.int64).reshape(-1))
            ids, before = np.unique(k & U(0xFFFFFFFF), return_counts=True)
            rows = [_block(s, ids[a:b], before[a:b]) for s, a, b in runs(id_shard(ids, n, shards))]
            yield pa.RecordBatch.from_arrays(
                [*_blocks(rows).columns, pa.array([[0] * 5] * len(rows), pa.list_(pa.int64()))], names=names
            )
            told = _blocks([(-1 - shard, b"", b"", b"")])
            yield pa.RecordBatch.from_arrays(
                [*told.columns, pa.array([[len(k), *_count_of_counts(c)]], pa.list_(pa.int64()))], names=names
            )

    names = ["shard", "high", "low", "counts", "told"]
    if order == 2:
        counted = docs.mapInArrow(job, BLOCK)
    else:
        counted = _count_grams(docs, folder, sizes, order, shards)
        for k in range(order, 2, -1):
            # the blocks of the longer sequences are dropped before the shorter ones are dealt out
            counted = written(_keep_grams(counted, folder, k, n, shards), "lm-blocks", compression="uncompressed")
    made = _dealt(counted, shards).mapInArrow(merge, f"{BLOCK}, told array<long>")
    made = written(made, "lm-before")
    told = [r.told for r in made.where("shard < 0").select("told").collect()]
    present = {-1 - r.shard for r in made.where("shard < 0").select("shard").collect()}
    missing = set(range(shards)) - present
    for name, dtype in (("pairs", U), ("pair-counts", np.uint8), ("many", np.int64), ("often", np.int64)):
        _write_empty(folder, name, dtype, missing)
    for shard in missing:
        width = first_id(shard + 1, n, shards) - first_id(shard, n, shards)
        Shards(folder, "contexts", np.int64).save(shard, np.zeros(4 * width, np.int64))
    return shards, made.where("shard >= 0").drop("told"), [sum(x) for x in zip(*told)] or [0] * 5


def _count_before(blocks: DataFrame, folder: str, n: int, shards: int) -> list[int]:
    """Write how many different words stand before each word; how many have 1, 2, 3, 4 or more."""

    def merge(batches):
        befores = Shards(folder, "before", np.int64)
        for group in by_group(batches, ["shard"]):
            shard = group.column("shard")[0].as_py()
            ids, counts = _unblock(group)
            low = first_id(shard, n, shards)
            dense = np.zeros(first_id(shard + 1, n, shards) - low, np.int64)
            dense[ids.astype(np.int64) - low] = counts
            befores.save(shard, dense)
            told = [*_count_of_counts(counts), int((counts >= 3).sum())]
            yield pa.RecordBatch.from_pydict({"shard": pa.array([shard], pa.int32()), "told": pa.array([told], pa.list_(pa.int64()))})

    found = _dealt(blocks, shards).mapInArrow(merge, "shard int, told array<long>").collect()
    for shard in set(range(shards)) - {r.shard for r in found}:
        width = first_id(shard + 1, n, shards) - first_id(shard, n, shards)
        Shards(folder, "before", np.int64).save(shard, np.zeros(width, np.int64))
    return [sum(x) for x in zip(*(r.told for r in found))] or [0] * 5


def fit_language_model(docs: DataFrame, text: str = "text", order: int = 2) -> Model:
    """Count the whole texts of ``docs`` and write the arrays of a model of sequences up to ``order`` words to the shared folder.

    NULL texts are empty: they are an end token.  No rows make a model that
    knows no word.
    """
    if order < 2:
        raise ValueError("a model has order two or more")
    with shuffles_dropped(docs.sparkSession):
        return _fit(docs.select(F.col(quoted(text)).cast("string").alias("text")), order)


def _fit(texts: DataFrame, order: int) -> Model:
    folder = new_folder(texts.sparkSession, "language-model")
    size = texts.agg(F.sum(F.octet_length("text")).alias("bytes")).first().bytes or 0
    # a token takes six bytes or so; the ranges of words grow with the corpus
    shards = max(LEAST_SHARDS, size // (6 * SHARD_TOKENS))
    sizes, tokens = _count_words(texts, folder, shards)
    for shard, size in enumerate(sizes):
        if not size:
            _write_empty(folder, "words", U, [shard])
            _write_empty(folder, "counts", np.int64, [shard])
    ranges, blocks, (different, *pair_counts) = _count_pairs(texts, folder, sizes, tokens, order)
    n = sum(sizes) + 1
    *word_counts, three = _count_before(blocks, folder, n, ranges)
    d, e = discounts(pair_counts), discounts(word_counts)
    taken = (e[0] * word_counts[0] + e[1] * word_counts[1] + e[2] * three) / different if different else 1.0
    longer = [discounts(Level(folder, k, ranges).told()) for k in range(3, order + 1)]
    return Model(folder, sizes, tokens, ranges, d, e, different, taken, longer)


class Scorer:
    """Looks up a model's arrays."""

    def __init__(self, model: Model):
        self.m = model
        self.vocabulary = Vocabulary(model.folder, model.sizes)
        self.pairs = Shards(model.folder, "pairs", U)
        self.counts = Shards(model.folder, "pair-counts", np.uint8)
        self.many = Shards(model.folder, "many", np.int64)
        self.often = Shards(model.folder, "often", np.int64)
        self.contexts = Shards(model.folder, "contexts", np.int64)
        self.befores = Shards(model.folder, "before", np.int64)
        self.n = model.words + 1
        self.levels = [Level(model.folder, k, model.shards) for k, _ in enumerate(model.gram_discounts, 3)]

    def _dense(self, arrays: Shards, ids: np.ndarray, columns: int) -> np.ndarray:
        """Rows of sorted numbers in a dense array; zero for -1."""
        out = np.zeros((len(ids), columns), np.int64)
        known = np.flatnonzero(ids >= 0)
        for shard, a, b in runs(id_shard(ids[known], self.n, self.m.shards)):
            rows = known[a:b]
            table = arrays[shard].reshape(-1, columns)
            out[rows] = table[ids[rows] - first_id(shard, self.n, self.m.shards)]
        return out

    def _pair_counts(self, keys: np.ndarray) -> np.ndarray:
        """Counts of sorted pairs."""
        shards = id_shard(keys >> U(32), self.n, self.m.shards)
        at = find(self.pairs, shards, keys)
        out = np.zeros(len(keys), np.int64)
        for shard, a, b in runs(shards):
            rows = np.flatnonzero(at[a:b] >= 0) + a
            counts = self.counts[shard][at[rows]].astype(np.int64)
            large = np.flatnonzero(counts == 255)
            if len(large):
                counts[large] = self.often[shard][np.searchsorted(self.many[shard], at[rows[large]])]
            out[rows] = counts
        return out

    def words(self, ids: np.ndarray) -> np.ndarray:
        """p1 of words by number; -1 is an unknown word."""
        if not self.m.different_pairs:
            return np.full(len(ids), 1.0)
        distinct, back = np.unique(ids, return_inverse=True)
        a = self._dense(self.befores, distinct, 1)[:, 0]
        seen = np.maximum(a - _discount(a, self.m.word_discounts), 0) / self.m.different_pairs
        return (seen + self.m.taken / self.n)[back]

    def log10(self, first: np.ndarray, ids: np.ndarray) -> np.ndarray:
        """log10 p of each token given those before in its document; by number, -1 if unknown."""
        before = _before(ids, first, self.n - 1)
        p1 = self.words(ids)
        if not self.m.different_pairs:
            return np.log10(p1)
        contexts, back = np.unique(before, return_inverse=True)
        total, *n = self._dense(self.contexts, contexts, 4)[back].T
        d = self.m.pair_discounts
        counts = np.zeros(len(ids), np.int64)
        known = np.flatnonzero((before >= 0) & (ids >= 0))
        keys, place = np.unique(_pairs(before[known], ids[known]), return_inverse=True)
        counts[known] = self._pair_counts(keys)[place]
        seen = np.maximum(counts - _discount(counts, d), 0)
        left = d[0] * n[0] + d[1] * n[1] + d[2] * n[2]
        size = np.maximum(total, 1)
        p = np.where(total > 0, seen / size + left / size * p1, p1)
        contexts = before[:, None]
        for level, d in zip(self.levels, self.m.gram_discounts):
            contexts = np.column_stack([_before(contexts[:, 0], first, self.n - 1), contexts])
            counts, stats = level.look_up(contexts, ids)
            seen = np.maximum(counts - _discount(counts, d), 0)
            size = np.maximum(stats[:, 0], 1)
            # no matrix product: its threads would keep cores busy that belong to other tasks
            left = d[0] * stats[:, 1] + d[1] * stats[:, 2] + d[2] * stats[:, 3]
            p = np.where(stats[:, 0] > 0, seen / size + left / size * p, p)
        return np.log10(p)


FIELDS = [
    ("n_tokens", "bigint"), ("n_known", "bigint"), ("train_tokens", "bigint"),
    ("base_score", "double"), ("score", "double"),
]


def _score_job(model: Model):
    def job():
        scorer = Scorer(model)

        def work(texts: pa.Array):
            columns = [[] for _ in range(4)]
            for _, _, words in slices_of_words(texts, BLANK, SLICE):
                hashes, first = _tokens(words)
                ids, counts = _numbers(scorer.vocabulary, hashes)
                base = np.log10((counts + 1) / (model.tokens + model.words + 1))
                score = scorer.log10(first, ids)
                heads = first[:-1]
                columns[0].append(np.diff(first))
                columns[1].append(np.add.reduceat((counts > 0).astype(np.int64), heads))
                columns[2].append(np.add.reduceat(base, heads))
                columns[3].append(np.add.reduceat(score, heads))
            n, known, base, score = (np.concatenate(c) for c in columns)
            return [pa.array(n), pa.array(known), pa.array(np.full(len(n), model.tokens)), pa.array(base), pa.array(score)]

        return work

    return job


def score_texts(docs: DataFrame, model: Model, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """``docs`` with n_tokens, n_known, train_tokens, base_score and score of each whole text.

    ``score`` is the model's log10 probability of the text with its end token,
    ``base_score`` that of the words alone with one added to every count.  A NULL
    text is empty: an end token.
    """
    keep = docs.columns if keep is None else keep
    return map_texts(docs, text, keep, FIELDS, _score_job(model), limit=SLICE)


def perplexity(score: str = "score", n_tokens: str = "n_tokens") -> Column:
    return F.pow(F.lit(10.0), -F.col(score) / F.col(n_tokens))
