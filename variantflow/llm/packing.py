"""Packing of tokenised documents into windows by minimum bin slack.

Each task tokenises its documents and cuts whole windows off them.  What remains
of a document is shorter than a window.  The lengths that remain are a multiset;
for each window the longest one is taken and the rest of the window is filled
from the others by subset-sum dynamic programming on bitsets: bit s of a layer
says that the lengths so far can fill s, and walking the layers back gives how
often each length is used.  The filling that comes closest to the capacity is
used as often as the counts allow.

Documents may be cut, so where the best filling leaves a gap, the longest piece
that remains is cut to fill it.  What is left at the end of a group is cut into
sequences whose lengths are powers of two, which need no padding.

There is no shuffle.  A task packs groups of ``group`` remaining pieces, tokenises
parts of ``PART_BYTES`` and hands out its rows in batches of ``OUT_BYTES``, which
bounds its memory.
"""

from __future__ import annotations

from collections import defaultdict, deque
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from variantflow.llm.batches import EXACT, U, Words, memory_back, quoted, text_slices

CAPACITY = 2048
END_ID = 1
GROUP = 20_000
#: tokenised pieces of text that a task remembers
CACHE = 400_000
#: bytes of texts that are looked up at once, and of new pieces that are tokenised at once; a text or piece is never cut
PART_BYTES = 1 << 18
#: bytes of ids in a batch of rows
OUT_BYTES = 1 << 22
#: sequences are numbered within their task
TASK_BITS = 40


# --- minimum bin slack ------------------------------------------------------
def fill(counts: dict[int, int], order: list[int], space: int) -> dict[int, int]:
    """How often to take each length so that the sum comes closest to ``space``.

    ``order``: the lengths to use, all at most ``space``.  Lengths are added until
    the space can be filled exactly.
    """
    layers = [1]
    within = (1 << (space + 1)) - 1
    for length in order:
        reach = layers[-1]
        for _ in range(min(counts[length], space // length)):
            more = (reach | (layers[-1] | reach) << length) & within
            if more == reach:
                break
            reach = more
        layers.append(reach)
        if reach >> space & 1:
            break
    best = layers[-1].bit_length() - 1
    taken: dict[int, int] = {}
    for k in range(len(layers) - 1, 0, -1):
        length = order[k - 1]
        while not layers[k - 1] >> best & 1:
            taken[length] = taken.get(length, 0) + 1
            best -= length
    return taken


def windows(counts: dict[int, int], capacity: int) -> Iterator[tuple[dict[int, int], int]]:
    """(lengths of a window with their counts, how many such windows), until nothing is left."""
    counts = dict(counts)
    lengths = sorted(counts, reverse=True)
    while lengths:
        first = lengths[0]
        counts[first] -= 1
        rest = [x for x in lengths if counts[x] and x <= capacity - first]
        pattern = fill(counts, rest, capacity - first)
        counts[first] += 1
        pattern[first] = pattern.get(first, 0) + 1
        times = min(counts[x] // n for x, n in pattern.items())
        for x, n in pattern.items():
            counts[x] -= n * times
        lengths = [x for x in lengths if counts[x]]
        yield pattern, times


def pack_group(pieces: list[tuple[int, int]], capacity: int) -> Iterator[list[tuple[int, int, int]]]:
    """Sequences of (piece, start in the piece, length) for pieces (number, length) below ``capacity``.

    Every sequence but the last few of the group is full; the last lengths are powers of two.
    """
    waiting: dict[int, deque] = defaultdict(deque)
    for number, length in pieces:
        waiting[length].append((number, 0, length))
    counts = {length: len(found) for length, found in waiting.items()}
    open_: list[list[tuple[int, int, int]]] = []
    for pattern, times in windows(counts, capacity):
        for _ in range(times):
            took = [waiting[x].popleft() for x, n in sorted(pattern.items(), reverse=True) for _ in range(n)]
            if sum(x[2] for x in took) == capacity:
                yield took
            else:
                open_.append(took)
    # the fillings that leave a gap, in one row, cut at each full window and then at powers of two
    row = [x for took in open_ for x in took]
    left = sum(x[2] for x in row)
    while row:
        space = capacity if left >= capacity else 1 << (left.bit_length() - 1)
        left -= space
        sequence = []
        while space:
            number, start, length = row[0]
            part = min(length, space)
            sequence.append((number, start, part))
            space -= part
            if part == length:
                row.pop(0)
            else:
                row[0] = (number, start + part, length - part)
        yield sequence


# --- tokens -----------------------------------------------------------------
def _parts(numbers: np.ndarray, sizes: np.ndarray) -> Iterator[np.ndarray]:
    """``numbers`` of pieces in parts of about ``PART_BYTES``."""
    at = np.cumsum(sizes[numbers]) // PART_BYTES
    cuts = np.flatnonzero(np.diff(at)) + 1
    yield from (part for part in np.split(numbers, cuts) if len(part))


class Tokens:
    """Token ids of texts, each distinct piece between blanks tokenised once.

    A byte-level tokenizer of this kind never joins what stands before a blank
    with the blank, so a text can be cut in front of each blank that follows no
    white space.  The pieces are told apart by 64-bit hashes; those not seen
    before are tokenised in one call.
    """

    def __init__(self, path: str, cache: int = CACHE, special_is_text: bool = False):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        if special_is_text:
            self.tokenizer.encode_special_tokens = True
        vocabulary = self.tokenizer.get_vocab()
        self.n_bytes = np.zeros(max(vocabulary.values()) + 1, np.int64)
        for token, i in vocabulary.items():
            self.n_bytes[i] = len(token)
        added = self.tokenizer.get_added_tokens_decoder()
        for i, token in added.items():
            self.n_bytes[i] = len(token.content.encode())
        #: added tokens that reach over blanks, or look at what is beside them, leave no place to cut
        self.whole = any(t.lstrip or t.rstrip or t.single_word or t.content.split() != [t.content] for t in added.values())
        self.cache = cache
        self._forget()

    def _forget(self) -> None:
        self.keys = np.empty(0, U)
        self.at = np.empty(0, np.int64)
        self.size = np.empty(0, np.int64)
        self.store = np.empty(0, np.int32)

    def pieces(self, buf: np.ndarray, offsets: np.ndarray) -> Words:
        """The texts of a slice cut in front of blanks that follow no white space."""
        cut = np.zeros(len(buf), bool)
        if len(buf) > 1 and not self.whole:
            before = buf[:-1]
            cut[1:] = (buf[1:] == 0x20) & (before > 0x20) & (before != 0x7F)
            wide = np.flatnonzero(cut[1:] & (before >= 0x80))
            if len(wide):
                # a blank of several bytes starts with one of these
                odd = buf[np.maximum(wide - 1, 0)] == 0xC2
                odd |= np.isin(buf[np.maximum(wide - 2, 0)], (0xE1, 0xE2, 0xE3))
                cut[wide[odd] + 1] = False
        starts = offsets[:-1][offsets[:-1] < offsets[1:]]
        cut[starts] = True
        start = np.flatnonzero(cut)
        return Words(buf, offsets, start, np.append(start[1:], len(buf)), np.searchsorted(start, offsets))

    def _learn(self, buf, start, end, alone, keys) -> None:
        """Tokenise new pieces; those that may stand alone only, one by one."""
        inner = np.flatnonzero(~alone)
        sizes = np.zeros(len(keys), np.int64)
        found: list[np.ndarray] = []
        for part in _parts(inner, end - start):
            size = end[part] - start[part]
            ends = np.cumsum(size)
            where = np.repeat(start[part] - (ends - size), size) + np.arange(ends[-1])
            ids = np.array(self._encode([buf[where].tobytes().decode()])[0], np.int32)
            reached = np.cumsum(self.n_bytes[ids])
            last = np.searchsorted(reached, ends, side="left") + 1
            sizes[part] = np.diff(last, prepend=0)
            found.append(ids)
        single = np.flatnonzero(alone)
        for part in _parts(single, end - start):
            texts = [buf[a:b].tobytes().decode() for a, b in zip(start[part], end[part])]
            for i, out in zip(part.tolist(), self._encode(texts)):
                sizes[i] = len(out)
                found.append(np.array(out, np.int32))
        order = np.concatenate([inner, single])
        at = np.empty(len(keys), np.int64)
        at[order] = len(self.store) + np.cumsum(sizes[order]) - sizes[order]
        self.store = np.concatenate([self.store, *found])
        keys = np.concatenate([self.keys, keys])
        rank = np.argsort(keys, kind="stable")
        self.keys = keys[rank]
        self.at = np.concatenate([self.at, at])[rank]
        self.size = np.concatenate([self.size, sizes])[rank]

    def _encode(self, texts: list[str]) -> list[list[int]]:
        return [x.ids for x in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def __call__(self, buf: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts of a slice in one row, and the first id of each text therein."""
        if not len(buf):
            return np.empty(0, np.int32), np.zeros(len(offsets), np.int64)
        pieces = self.pieces(buf, offsets)
        h = pieces.hashes(EXACT)
        keys, first, back = np.unique(h, return_index=True, return_inverse=True)
        if len(self.keys) + len(keys) > self.cache:
            self._forget()
        at = np.searchsorted(self.keys, keys)
        known = np.zeros(len(keys), bool)
        inside = at < len(self.keys)
        known[inside] = self.keys[at[inside]] == keys[inside]
        new = np.flatnonzero(~known)
        if len(new):
            # the first piece of a text has no blank in front, the last may end in white space
            alone = np.zeros(len(h), bool)
            filled = pieces.first[:-1] < pieces.first[1:]
            alone[pieces.first[:-1][filled]] = True
            alone[pieces.first[1:][filled] - 1] = True
            i = first[new]
            self._learn(buf, pieces.start[i], pieces.end[i], alone[i], keys[new])
        at = np.searchsorted(self.keys, keys)
        size = self.size[at][back]
        ends = np.concatenate([np.zeros(1, np.int64), np.cumsum(size)])
        where = np.repeat(self.at[at][back] - ends[:-1], size) + np.arange(ends[-1])
        return self.store[where], ends[pieces.first]


@lru_cache(maxsize=1)
def tokens_of(path: str, special_is_text: bool) -> Tokens:
    """The tokenizer and the pieces that a worker knows from its earlier tasks; their number is bounded by ``CACHE``."""
    return Tokens(path, special_is_text=special_is_text)


# --- the operator -----------------------------------------------------------
class _Output:
    def __init__(self):
        self.rows: list[tuple] = []
        self.bytes = 0

    def add(self, key, start, ids, total, sequence, offset) -> None:
        self.rows.append((key, start, len(ids), ids.astype("<u4").tobytes(), total, sequence, offset))
        self.bytes += 4 * len(ids)

    def batch(self, key_type, names) -> pa.RecordBatch:
        types = [key_type, pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int64()]
        columns = zip(*self.rows) if self.rows else [[]] * len(types)
        out = pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(columns, types)], names=names)
        self.rows, self.bytes = [], 0
        return out


NAMES = ["key", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"]


def _pack_batches(tokenizer: str, capacity: int, end_id: int, group: int, special_is_text: bool):
    def run(batches):
        context = TaskContext.get()
        sequence = (context.partitionId() if context else 0) << TASK_BITS
        tokens = tokens_of(tokenizer, special_is_text)
        out = _Output()
        key_type = None
        rest: list[tuple] = []  # (key, start, ids, tokens of the document)
        narrow = np.result_type(np.min_scalar_type(len(tokens.n_bytes) - 1), np.min_scalar_type(end_id))

        def packed(sequence):
            for took in pack_group([(i, len(x[2])) for i, x in enumerate(rest)], capacity):
                offset = 0
                for i, start, length in took:
                    key, begins, ids, total = rest[i]
                    out.add(key, begins + start, ids[start : start + length], total, sequence, offset)
                    offset += length
                sequence += 1
                if out.bytes > OUT_BYTES:
                    yield out.batch(key_type, NAMES)
            rest.clear()
            return sequence

        for batch in batches:
            key_type = batch.column(0).type
            keys = batch.column(0).to_pylist()
            for row, end, buf, offsets in text_slices(batch.column(1), PART_BYTES):
                ids, first = tokens(buf, offsets)
                for i in range(end - row):
                    own = np.append(ids[first[i] : first[i + 1]], np.int32(end_id))
                    whole = len(own) // capacity * capacity
                    for start in range(0, whole, capacity):
                        out.add(keys[row + i], start, own[start : start + capacity], len(own), sequence, 0)
                        sequence += 1
                        if out.bytes > OUT_BYTES:
                            yield out.batch(key_type, NAMES)
                    if whole < len(own):
                        rest.append((keys[row + i], whole, own[whole:].astype(narrow), len(own)))
                    if len(rest) >= group:
                        sequence = yield from packed(sequence)
        if key_type is not None:
            yield from packed(sequence)
            yield out.batch(key_type, NAMES)

    return run


def pack(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    tokenizer: str | None = None,
    capacity: int = CAPACITY,
    end_id: int = END_ID,
    group: int = GROUP,
    special_is_text: bool = False,
) -> DataFrame:
    """Pieces of documents with their place in sequences of at most ``capacity`` ids.

    Columns: the key, start (ids of the document before the piece), length, ids
    (little-endian unsigned 32-bit), doc_tokens, sequence_id, offset.  A document's
    ids are those of its text and then ``end_id``; a NULL text is empty, so such a
    document is the end id alone.  A document of several pieces may have them in
    any sequences.  NULL keys and repeated rows are packed like all others; other
    columns are ignored.  ``tokenizer``: a byte-level tokenizer file that every
    executor can read.  The strings of its special tokens are those tokens, as
    the tokenizer has it by itself; ``special_is_text`` makes them ordinary text.
    """
    if tokenizer is None:
        import public_tokenizers

        tokenizer = public_tokenizers.path("byte_bpe_50k.json")
    narrow = docs.select(F.col(quoted(key)).alias("key"), F.col(quoted(text)).alias("text"))
    kind = narrow.schema["key"].dataType.simpleString()
    schema = f"key {kind}, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long"
    packed = memory_back(_pack_batches(tokenizer, capacity, end_id, group, special_is_text))
    return narrow.mapInArrow(packed, schema).withColumnRenamed("key", key)
