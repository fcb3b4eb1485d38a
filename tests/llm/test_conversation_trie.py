import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from variantflow.llm import conversation_trie as ct
from variantflow.llm.conversation_trie import prefix_trie, turn_sequences
from variantflow.llm.queries import rebuilt

SCHEMA = "conv_id long, turn long, role string, text string, ids string, sizes string, top string, n long"


def conversations(spark, rows):
    return spark.createDataFrame([(*r, "x", "y", "z", 7) for r in rows], SCHEMA)


def ordered(rows):
    own = {}
    for c, turn, role, text in rows:
        if c is not None:
            own.setdefault(c, []).append((turn is not None, turn or 0, role or "", text or ""))
    return {c: [t[2:] for t in sorted(ts)] for c, ts in own.items()}


def rebuild(own):
    out = {}
    for c, ts in own.items():
        h = zlib.crc32(str(c).encode()) % 9
        out[c] = own.get(c - c % 5, [])[:h] + ts[h:]
    return out


def brute(seqs):
    members = {}
    for c, ts in seqs.items():
        for d in range(len(ts) + 1):
            members.setdefault(tuple(ts[:d]), []).append(c)
    out = []
    for p, cs in members.items():
        below = [q for q in members if q[: len(p)] == p]
        children = [q for q in below if len(q) == len(p) + 1]
        leaves = sum(1 for q in below if not any(r[: len(q)] == q and len(r) > len(q) for r in below))
        saved = sum((len(members[q]) - 1) * len(q[-1][1].encode()) for q in below if q)
        ends = ",".join(map(str, sorted(c for c in cs if len(seqs[c]) == len(p))))
        parent = min(members[p[:-1]]) if p else None
        out.append((min(cs), len(p), parent, len(cs), len(children), leaves, saved, hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=repr)


def found(df):
    return sorted(map(tuple, df.collect()), key=repr)


def drawn(rng, n):
    rows = []
    for c in range(n):
        hot = rng.random() < 0.4
        for turn in range(rng.choice([1, 2, 3, 9, 14])):
            text = f"hot {turn}" if hot else rng.choice(["", None, "a", "bé", f"t{turn}"])
            rows.append((c, rng.choice([turn, turn, None]) if turn == 0 else turn, "user" if turn % 2 == 0 else None, text))
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("limit, broadcast", [(20_000, 1000), (40, 1000), (3, 0)])
def test_nodes_are_those_of_all_prefixes(spark, monkeypatch, limit, broadcast):
    """Also where containers burst many rounds deep and heads are joined by a shuffle."""
    monkeypatch.setattr(ct, "BROADCAST_HEADS", broadcast)
    rows = drawn(random.Random(limit), 90)
    sequences = rebuilt(conversations(spark, rows))
    assert found(prefix_trie(sequences, container_turns=limit)) == brute(rebuild(ordered(rows)))


def test_a_large_group_of_copies_is_cut_anywhere(spark, monkeypatch):
    """The hash of its keys does not tell into how many parts it was cut."""
    monkeypatch.setattr(ct, "CHUNK_KEYS", 7)
    rows = [(c, t, "user", f"same {t}") for c in range(1500) for t in range(3)]
    rows += [(c, 0, "user", f"own {c // 2}") for c in range(1500, 1540)]
    sequences = turn_sequences(conversations(spark, rows).repartition(5))
    assert found(prefix_trie(sequences, container_turns=1)) == brute(ordered(rows))


def test_parts_of_a_group_that_fills_a_task():
    """A group in the middle of a task is given out when it grows too long."""
    import pyarrow as pa

    ids = [[1]] * 3 + [[2]] * 500 + [[3]] * 2
    batch = pa.RecordBatch.from_pydict(
        {"ids": pa.array(ids, ct.LONGS), "sizes": pa.array(ids, ct.LONGS), "key": pa.array(range(505), pa.int64())}
    )
    old, ct.CHUNK_KEYS = ct.CHUNK_KEYS, 3
    try:
        out = pa.Table.from_batches(ct._collect_copies([batch])).to_pylist()
    finally:
        ct.CHUNK_KEYS = old
    parts = [r for r in out if r["part"] is not None]
    assert {tuple(r["ids"]) for r in parts} == {(1,), (2,), (3,)}
    assert ",".join(r["part"] for r in parts if r["ids"] == [2]) == ",".join(map(str, range(3, 503)))


def test_awkward_rows(spark):
    rows = [
        (1, 0, None, None), (1, 0, None, None), (1, None, "user", "x" * 300_000), (2, 0, "", ""), (None, 0, "user", "lost"),
        (5, 1, "user", "a"), (6, 1, "user", "a"), (-7, 0, "user", "a"), (3, 0, "userx", ""), (4, 0, "user", "x"),
    ]
    df = conversations(spark, rows)
    assert found(prefix_trie(turn_sequences(df))) == brute(ordered(rows))
    assert prefix_trie(turn_sequences(df.limit(0))).collect() == []
    turnless = turn_sequences(df).where("conv_id = 2").withColumn("turns", F.lit(None).cast("array<struct<id:long,size:long>>"))
    assert found(prefix_trie(turnless)) == brute({2: []})
