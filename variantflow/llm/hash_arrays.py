"""Sorted arrays of numbers as files in the shared folder, memory-mapped by workers.

An array is cut into shards by ranges of its keys.  Tasks write a shard under a
name of their own and rename it, so a task that runs again replaces its file with
the same content.  Workers map the files where the shared folder is a file
system of the machine; from other stores they read a shard into memory when it is
first used.
"""

from __future__ import annotations

import os
import uuid
from urllib.parse import unquote, urlparse

import numpy as np

U = np.uint64


def local_path(uri: str) -> str | None:
    """The path of a ``file:`` URI or plain path; None for other stores."""
    parsed = urlparse(uri)
    if parsed.scheme in ("", "file"):
        return unquote(parsed.path) if parsed.scheme else uri
    return None


def save_bytes(uri: str, data) -> None:
    """Write a file under a name of its own, then rename it."""
    path = local_path(uri)
    if path is not None:
        os.makedirs(os.path.dirname(path), exist_ok=True)
        own = f"{path}.{uuid.uuid4().hex}"
        with open(own, "wb") as out:
            out.write(data)
        os.replace(own, path)
        return
    from pyarrow import fs

    store, path = fs.FileSystem.from_uri(uri)
    store.create_dir(os.path.dirname(path), recursive=True)
    own = f"{path}.{uuid.uuid4().hex}"
    with store.open_output_stream(own) as out:
        out.write(data)
    store.move(own, path)


def save(uri: str, array: np.ndarray) -> None:
    save_bytes(uri, np.ascontiguousarray(array).data)


def load(uri: str, dtype) -> np.ndarray:
    path = local_path(uri)
    if path is not None:
        if not os.path.getsize(path):
            return np.empty(0, dtype)
        return np.memmap(path, dtype, "r")
    from pyarrow import fs

    store, path = fs.FileSystem.from_uri(uri)
    with store.open_input_file(path) as source:
        return np.frombuffer(source.read_buffer(), dtype)


class Shards:
    """Arrays of one name in a folder, one file for each shard; opened when used."""

    def __init__(self, folder: str, name: str, dtype):
        self.folder, self.name, self.dtype = folder, name, dtype
        self.open: dict[int, np.ndarray] = {}

    def __getitem__(self, shard: int) -> np.ndarray:
        if shard not in self.open:
            self.open[shard] = load(f"{self.folder}/{self.name}-{shard}", self.dtype)
        return self.open[shard]

    def save(self, shard: int, array: np.ndarray) -> None:
        save(f"{self.folder}/{self.name}-{shard}", array.astype(self.dtype, copy=False))


def hash_shard(keys: np.ndarray, shards: int) -> np.ndarray:
    """Shard of each hash: ranges of equal width."""
    return (((keys >> U(32)) * U(shards)) >> U(32)).astype(np.int64)


def id_shard(ids: np.ndarray, n: int, shards: int) -> np.ndarray:
    """Shard of each number below ``n``: ranges of equal width."""
    return ids.astype(np.int64) * shards // max(n, 1)


def first_id(shard: int, n: int, shards: int) -> int:
    """Smallest number of a shard."""
    return -(-shard * max(n, 1) // shards)


def runs(sorted_shards: np.ndarray):
    """(shard, start, end) of each run."""
    if len(sorted_shards):
        cuts = np.flatnonzero(np.diff(sorted_shards)) + 1
        bounds = [0, *cuts.tolist(), len(sorted_shards)]
        for a, b in zip(bounds[:-1], bounds[1:]):
            yield int(sorted_shards[a]), a, b


def find(keys: Shards, shards: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """Position of each wanted key in its shard, or -1; ``wanted`` is sorted, and so are its shards."""
    out = np.full(len(wanted), -1, np.int64)
    for shard, a, b in runs(shards):
        have = keys[shard]
        if len(have):
            at = np.minimum(np.searchsorted(have, wanted[a:b]), len(have) - 1)
            out[a:b] = np.where(have[at] == wanted[a:b], at, -1)
    return out


def merge_counts(keys: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct keys with their summed counts."""
    if not keys:
        return np.empty(0, U), np.empty(0, np.int64)
    k = np.concatenate(keys)
    order = np.argsort(k, kind="stable")
    k = k[order]
    first = np.flatnonzero(np.concatenate([np.ones(min(1, len(k)), bool), k[1:] != k[:-1]]))
    c = np.concatenate(counts)[order]
    return k[first], np.add.reduceat(c, first) if len(first) else c


class Counting:
    """Counts of keys that come in pieces; adds up what is held when it grows too long."""

    def __init__(self, limit: int = 2_000_000):
        self.limit = limit
        self._clear()

    def _clear(self) -> None:
        self.keys: list[np.ndarray] = []
        self.counts: list[np.ndarray] = []
        self.held = 0
        self.merged = 0

    def add(self, keys: np.ndarray) -> bool:
        """True if so many distinct keys are held that they should be taken away."""
        k, c = np.unique(keys, return_counts=True)
        self.keys.append(k)
        self.counts.append(c)
        self.held += len(k)
        if self.held - self.merged > self.limit:
            k, c = merge_counts(self.keys, self.counts)
            self.keys, self.counts = [k], [c]
            self.held = self.merged = len(k)
        return self.merged > self.limit

    def take(self) -> tuple[np.ndarray, np.ndarray]:
        out = merge_counts(self.keys, self.counts)
        self._clear()
        return out


def write_hashed(df, folder: str, key: str, others: list[str], rows_of_shard: int = 1_000_000) -> "Hashed":
    """Write a table by its 64-bit hash column ``key`` (distinct, not NULL) with other long columns.

    Returns what opens the arrays in a task.
    """
    from pyspark.sql import functions as F

    from variantflow.llm.batches import by_group

    shards = max(1, -(-df.count() // rows_of_shard))
    # the hash as an unsigned number, in ranges of equal width
    high = F.shiftrightunsigned(key, 32)
    dealt = df.select(
        F.shiftrightunsigned(high * shards, 32).cast("int").alias("shard"), F.col(key).alias("key"), *others
    )
    dealt = dealt.repartition(shards, "shard").sortWithinPartitions("shard")

    def run(batches):
        import pyarrow as pa

        for group in by_group(batches, ["shard"]):
            shard = group.column("shard")[0].as_py()
            keys = group.column("key").to_numpy().view(U)
            order = np.argsort(keys)
            Shards(folder, "keys", U).save(shard, keys[order])
            for name in others:
                Shards(folder, name, np.int64).save(shard, group.column(name).to_numpy()[order])
            yield pa.RecordBatch.from_pydict({"shard": pa.array([shard], pa.int32())})

    present = {r.shard for r in dealt.mapInArrow(run, "shard int").collect()}
    for shard in set(range(shards)) - present:
        for name in ("keys", *others):
            Shards(folder, name, np.int64).save(shard, np.empty(0, np.int64))
    return Hashed(folder, shards, tuple(others))


class Hashed:
    """Arrays that ``write_hashed`` wrote."""

    def __init__(self, folder: str, shards: int, others: tuple[str, ...]):
        self.folder, self.shards, self.names = folder, shards, others
        self.keys = Shards(folder, "keys", U)
        self.others = {name: Shards(folder, name, np.int64) for name in others}

    def __reduce__(self):
        return Hashed, (self.folder, self.shards, self.names)

    def look_up(self, wanted: np.ndarray) -> tuple[np.ndarray, dict[str, np.ndarray]]:
        """Which hashes are there, and the other columns of those (0 for the rest)."""
        order = np.argsort(wanted)
        ordered = wanted[order]
        shards = hash_shard(ordered, self.shards)
        at = np.empty(len(wanted), np.int64)
        at[order] = find(self.keys, shards, ordered)
        out = {}
        of = hash_shard(wanted, self.shards)
        for name, arrays in self.others.items():
            values = np.zeros(len(wanted), np.int64)
            for shard in np.unique(of[at >= 0]).tolist():
                rows = np.flatnonzero((of == shard) & (at >= 0))
                values[rows] = arrays[shard][at[rows]]
            out[name] = values
        return at >= 0, out
