"""Words of whole Arrow text columns as numpy arrays.

All texts of a slice are handled at once: their bytes are classified, cut into
words and hashed by prefix sums, so the cost is a few array passes for each byte
and no Python call for each word.  Slices are cut between documents at about
``SLICE_BYTES``, which bounds the memory; texts are never cut.
"""

from __future__ import annotations

import ctypes
import gc
import pickle
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

SLICE_BYTES = 1 << 20
U = np.uint64
ODD = U(0x9E3779B97F4A7C15)
MULTIPLIER = 0xD1342543DE82EF95


_MIX = U(30), U(0xBF58476D1CE4E5B9), U(27), U(0x94D049BB133111EB), U(31)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    first, by, second, again, third = _MIX
    x = x ^ (x >> first)
    x *= by
    x ^= x >> second
    x *= again
    x ^= x >> third
    return x


def _lower() -> np.ndarray:
    table = np.arange(256, dtype=np.uint8)
    table[65:91] += 32
    return table


LOWER = _lower()
#: a 64-bit value for each byte, and the same with A-Z as a-z
EXACT = mix((np.arange(256, dtype=U) + U(1)) * ODD)
FOLDED = EXACT[LOWER]


def separators(*ranges: tuple[int, int]) -> np.ndarray:
    """Lookup table: True for bytes of the inclusive ranges."""
    table = np.zeros(256, bool)
    for first, last in ranges:
        table[first : last + 1] = True
    return table


#: words are ``[^\x20\x09-\x0D]+``
BLANK = separators((0x20, 0x20), (0x09, 0x0D))

_powers: list[np.ndarray] = []


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the multiplier and of its inverse modulo 2**64, at least ``n`` of each."""
    if not _powers or len(_powers[0]) < n:
        size = max(n, SLICE_BYTES + 1)
        found = []
        for base in (MULTIPLIER, pow(MULTIPLIER, -1, 1 << 64)):
            out = np.full(size, base, U)
            out[0] = 1
            with np.errstate(over="ignore"):
                np.multiply.accumulate(out, out=out)
            found.append(out)
        _powers[:] = found
    return _powers[0], _powers[1]


@dataclass
class Words:
    """Words of consecutive documents; document d has words first[d] to first[d + 1]."""

    buf: np.ndarray  # the slice's bytes
    offsets: np.ndarray  # of documents in buf
    start: np.ndarray
    end: np.ndarray
    first: np.ndarray

    def hashes(self, values_of: np.ndarray = FOLDED) -> np.ndarray:
        """64-bit hash of each word's bytes, by default with A-Z as a-z."""
        if not len(self.start):
            return np.empty(0, U)
        up, down = powers(len(self.buf))
        sums = np.empty(len(self.buf) + 1, U)
        sums[0] = 0
        values = values_of[self.buf]
        values *= up[: len(values)]
        np.cumsum(values, out=sums[1:])
        h = (sums[self.end] - sums[self.start]) * down[self.start]
        return mix(h + (self.end - self.start).astype(U) * ODD)

    def counts(self) -> np.ndarray:
        return np.diff(self.first)


def cut_words(buf: np.ndarray, offsets: np.ndarray, sep: np.ndarray) -> Words:
    inside = ~sep[buf]
    start, end = inside.copy(), inside.copy()
    if len(buf):
        start[1:] &= ~inside[:-1]
        end[:-1] &= ~inside[1:]
        bounds = offsets[1:-1]
        bounds = bounds[(bounds > 0) & (bounds < len(buf))]
        start[bounds] = inside[bounds]
        end[bounds - 1] = inside[bounds - 1]
    first_bytes = np.flatnonzero(start)
    return Words(
        buf, offsets, first_bytes, np.flatnonzero(end) + 1, np.searchsorted(first_bytes, offsets)
    )


def text_slices(col: pa.Array, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, offsets) of slices of a text column; NULL is empty."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    col = pc.fill_null(col, "")
    wide = pa.types.is_large_string(col.type)
    raw = np.frombuffer(col.buffers()[1], np.int64 if wide else np.int32) if len(col) else np.zeros(1, np.int64)
    offsets = raw[col.offset : col.offset + len(col) + 1].astype(np.int64)
    data = col.buffers()[2] if len(col) else None
    data = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
    row = 0
    while row < len(col):
        end = int(np.searchsorted(offsets, offsets[row] + limit, side="right")) - 1
        end = min(max(end, row + 1), len(col))
        yield row, end, data[offsets[row] : offsets[end]], offsets[row : end + 1] - offsets[row]
        row = end


def slices_of_words(col: pa.Array, sep: np.ndarray, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int, Words]]:
    for row, end, buf, offsets in text_slices(col, limit):
        yield row, end, cut_words(buf, offsets, sep)


def slice_texts(col: pa.Array) -> Iterator[tuple[int, int, pa.Array]]:
    """The same slices as texts."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    for row, end, _, _ in text_slices(col):
        yield row, end, pc.fill_null(col.slice(row, end - row), "")


def by_group(batches, keys: list[str]) -> Iterator[pa.Table]:
    """Tables of the runs of equal keys in sorted batches."""
    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        columns = np.stack([batch.column(k).to_numpy(zero_copy_only=False) for k in keys])
        changes = np.flatnonzero((columns[:, 1:] != columns[:, :-1]).any(axis=0)) + 1
        cuts = [0, *changes.tolist(), batch.num_rows]
        for start, end in zip(cuts[:-1], cuts[1:]):
            key = tuple(columns[:, start])
            if held and key != last:
                yield pa.Table.from_batches(held)
                held = []
            held.append(batch.slice(start, end - start))
            last = key
    if held:
        yield pa.Table.from_batches(held)


def memory_back(run: Callable) -> Callable:
    """``run`` of a task, after which its worker gives freed memory back to the machine.

    Workers live on from task to task, beside those of other stages.
    """

    def task(batches):
        try:
            yield from run(batches)
        finally:
            gc.collect()
            pa.default_memory_pool().release_unused()
            trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
            if trim:
                trim(0)

    return task


def free_name(docs: DataFrame, name: str) -> str:
    """``name``, with underscores in front until no column is called so."""
    taken = {c.lower() for c in docs.columns}
    while name.lower() in taken:
        name = "_" + name
    return name


def map_texts(
    docs: DataFrame,
    text: str,
    keep: list[str],
    fields: list[tuple[str, str]],
    job: Callable,
    keys: Sequence[str] = (),
    limit: int = SLICE_BYTES,
) -> DataFrame:
    """Columns ``keep`` of ``docs`` with new columns made from the text column.

    ``job()`` runs once for each task and returns a function from the texts of a
    slice of about ``limit`` bytes to the arrays of the new ``fields`` (name, type).
    The long columns ``keys`` are given to it before the texts.  Inside, columns are
    told apart by position, so no name clashes.
    """
    kept = [docs[quoted(c)].alias(f"k{i}") for i, c in enumerate(keep)]
    given = [docs[quoted(k)].cast("long").alias(f"g{i}") for i, k in enumerate(keys)]
    inner = docs.select(*kept, *given, docs[quoted(text)].cast("string").alias("text"))
    width = len(keep) + len(keys)
    types = [docs.schema[c].dataType for c in keep]
    schema = T.StructType(
        [T.StructField(f"k{i}", t) for i, t in enumerate(types)]
        + [T.StructField(f"f{i}", T._parse_datatype_string(t)) for i, (_, t) in enumerate(fields)]
    )
    names = schema.names

    def run(batches):
        work = job()
        for batch in batches:
            for row, end, _, _ in text_slices(batch.column(width), limit):
                found = work(*[batch.column(i).slice(row, end - row) for i in range(len(keep), width + 1)])
                cells = [batch.column(i).slice(row, end - row) for i in range(len(keep))]
                yield pa.RecordBatch.from_arrays([*cells, *found], names=names)

    mapped = inner.mapInArrow(memory_back(run), schema)
    return mapped.toDF(*keep, *[name for name, _ in fields])


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def fitted_to_sample(values: DataFrame, column: str, sample: int, fit: Callable):
    """``fit`` of at most ``sample`` different whole values of a column, the same whatever the partitions.

    A hash picks about three times as many in the tasks, and one task takes the
    first of them, so what it holds does not grow with the table.  As with
    :func:`fitted`, ``fit`` gives plain values.
    """
    parts = 1 << 31
    h = F.xxhash64(column)
    n = values.agg(F.approx_count_distinct(h).alias("n")).first()["n"]
    share = min(parts, 3 * sample * parts // max(n, 1))
    picked = values.select(h.alias("h"), column).where(F.pmod("h", F.lit(parts)) < share).distinct()
    return fitted(picked, lambda rows: fit([value for _, value in sorted(rows)[:sample]]))


def fitted(sample: DataFrame, fit: Callable):
    """``fit`` of the rows (as tuples) of a bounded sample, run in one task; the driver gets the result only.

    ``fit`` gives plain values (arrays, tuples, dicts), as a task may know its classes by another name.
    """

    def run(batches):
        rows = [tuple(row.values()) for batch in batches for row in batch.to_pylist()]
        yield pa.RecordBatch.from_pydict({"model": pa.array([pickle.dumps(fit(rows))], pa.binary())})

    made = sample.repartition(1).mapInArrow(memory_back(run), "model binary").first()
    # a plan that is known to be empty has no task
    return pickle.loads(made["model"]) if made else fit([])


def fold(key: str, parts: int, left_out: int) -> Column:
    """True for rows of the fold that is left out: crc32 of the key as text, modulo ``parts``.

    A NULL key is in no fold, so it is not left out.
    """
    crc = F.crc32(F.col(key).cast("string").cast("binary"))
    return F.coalesce(crc % parts == left_out, F.lit(False))
