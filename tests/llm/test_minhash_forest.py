import random

import numpy as np
import pytest
from helpers import awkward, docs, empty, words

from variantflow.llm import minhash_forest as mf
from variantflow.llm.minhash_forest import candidate_tree, near_duplicates, signatures


def shingles(text, size):
    w = words(text)
    return {tuple(w[i : i + size]) for i in range(max(len(w) - size, 0) + 1)} if w else set()


def brute(rows, size, percent):
    """(doc_id, n, component, kept) of rows with distinct ids, from all pairs."""
    sets = {i: shingles(t, size) for i, t in rows}
    label = {i: i for i in sets}

    def root(x):
        while label[x] != x:
            x = label[x]
        return x

    ids = sorted(sets)
    for i, x in enumerate(ids):
        for y in ids[i + 1 :]:
            common = len(sets[x] & sets[y])
            if common and 100 * common >= percent * (len(sets[x]) + len(sets[y]) - common):
                label[max(root(x), root(y))] = min(root(x), root(y))
    return sorted((i, len(sets[i]), root(i), root(i) == i) for i in ids)


def near_copies(rng, families, copies):
    """Texts with copies that differ in some words, and copies of copies."""
    out = []
    for f in range(families):
        base = [f"w{rng.randrange(400)}" for _ in range(rng.randrange(3, 90))]
        for _ in range(rng.randrange(copies) + 1):
            text = list(base)
            for _ in range(rng.randrange(4)):
                text[rng.randrange(len(text))] = f"x{rng.randrange(1000)}"
            out.append(" ".join(text))
            if rng.random() < 0.5:
                base = text
    rng.shuffle(out)
    return list(enumerate(out))


def found(df):
    return sorted(map(tuple, df.collect()))


@pytest.mark.parametrize("region, block, extra", [(500, 1_000_000, 60), (2, 300, 60)])
def test_classes_are_those_of_all_pairs(spark, monkeypatch, region, block, extra):
    """Also where every region is crowded and every block is searched in chunks."""
    monkeypatch.setattr(mf, "REGION", region)
    monkeypatch.setattr(mf, "BROADCAST_ROWS", 5 if region == 2 else 1_000_000)
    rows = near_copies(random.Random(5), 60, 12)
    df = docs(spark, [(i, t, None, None) for i, t in rows])
    assert found(near_duplicates(df, size=3, block_shingles=block)) == brute(rows, 3, 80)


def test_a_large_group_of_near_copies(spark, monkeypatch):
    monkeypatch.setattr(mf, "REGION", 20)
    rng = random.Random(6)
    base = [f"w{i}" for i in range(120)]
    rows = []
    for i in range(300):
        text = list(base)
        text[rng.randrange(120)] = f"x{i}"
        rows.append((i, " ".join(text)))
    df = docs(spark, [(i, t, None, None) for i, t in rows])
    assert {r[2] for r in found(near_duplicates(df, block_shingles=2000))} == {0}


def test_awkward_rows(spark):
    rows = {}
    for r in near_duplicates(awkward(spark)).collect():
        rows.setdefault(r.doc_id, []).append(tuple(r)[1:])
    assert rows[1] == [(18, 1, True)] * 2  # a repeated row
    assert rows[13] == [(18, 1, False)]
    assert [rows[i] for i in (2, 3, 4)] == [[(0, i, True)] for i in (2, 3, 4)]
    assert rows[7][0][1:] == (6, False) and rows[12] == [(1, 12, True)]
    assert sorted(rows[None]) == [(0, None, True), (16, 8, False)]
    assert near_duplicates(empty(spark)).collect() == []


def test_keys_that_stand_for_several_texts(spark):
    """A key is no reason to take another text for the one that was asked for."""
    a, b = " ".join(f"a{i}" for i in range(40)), " ".join(f"b{i}" for i in range(40))
    rows = [(1, a, None, None), (1, b, None, None), (2, a + " z", None, None), (3, b + " z", None, None), (4, "c d", None, None)]
    for block in (1_000_000, 10):
        got = found(near_duplicates(docs(spark, rows), block_shingles=block))
        assert [(r[0], r[2]) for r in got] == [(1, 1), (1, 1), (2, 1), (3, 1), (4, 4)]


def test_signatures_agree_as_sets_do():
    rng = np.random.default_rng(1)
    shared, agree = [], []
    for _ in range(60):
        a = rng.integers(0, 1 << 63, 200, dtype=np.uint64)
        b = np.concatenate([a[: rng.integers(50, 200)], rng.integers(0, 1 << 63, 30, dtype=np.uint64)])
        sig = signatures([np.unique(a), np.unique(b), np.empty(0, np.uint64)])
        shared.append(len(np.intersect1d(a, b)) / len(np.union1d(a, b)))
        agree.append((sig[0] == sig[1]).mean())
        assert not sig[2].any()
    assert np.abs(np.subtract(shared, agree)).mean() < 0.05
    assert np.corrcoef(shared, agree)[0, 1] > 0.97


def test_candidates_connect_what_agrees():
    sig = np.array([[1, 1, 1, 1], [1, 1, 1, 2], [1, 1, 2, 2], [9, 9, 9, 9], [9, 9, 9, 8]])
    assert sorted(map(sorted, candidate_tree(sig, 3))) == [[0, 1], [1, 2], [3, 4]]


def test_other_keys_than_whole_numbers_are_refused(spark):
    with pytest.raises(TypeError, match="whole number"):
        near_duplicates(spark.createDataFrame([("a", "some words of a text")], "doc_id string, text string"))
