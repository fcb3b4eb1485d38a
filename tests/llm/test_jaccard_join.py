from fractions import Fraction
from itertools import combinations

import numpy as np
import pytest
from helpers import awkward, docs, empty, words
from hypothesis import given, settings
from hypothesis import strategies as st

from variantflow.llm.components import components
from variantflow.llm.hash_arrays import write_hashed
from variantflow.llm.jaccard_join import (
    InvertedLists, Signatures, distinct, divide_skip, jaccard_classes, link_block, one_of_each, set_id, set_ids,
)
from variantflow.sources.scratch import new_folder

T9 = Fraction(9, 10)


def brute(rows, size, t):
    """(n_shingles, component) of each row by comparing all pairs."""
    sets = []
    for _, text in rows:
        w = words(text)
        sets.append({tuple(w[i : i + size]) for i in range(max(1, len(w) - size + 1))} if w else set())
    parent = list(range(len(rows)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for x, y in combinations(range(len(rows)), 2):
        both = len(sets[x] & sets[y])
        if both and both >= t * len(sets[x] | sets[y]):
            parent[root(x)] = root(y)
    out = []
    for x in range(len(rows)):
        keys = [rows[y][0] for y in range(len(rows)) if root(y) == root(x) and rows[y][0] is not None]
        out.append((rows[x][0], len(sets[x]), min(keys, default=None)))
    return sorted(out, key=str)


def texts(seed, n=120):
    rng = np.random.default_rng(seed)
    vocabulary = [f"w{i}" for i in range(60)]
    out = []
    for i in range(n):
        if i % 3 and out:
            base = out[int(rng.integers(len(out)))].split()
            for _ in range(int(rng.integers(0, 4))):
                if base:
                    base[int(rng.integers(len(base)))] = vocabulary[int(rng.integers(60))]
            out.append(" ".join(base))
        else:
            out.append(" ".join(vocabulary[j] for j in rng.integers(0, 60, int(rng.integers(1, 120)))))
    return out


@pytest.mark.parametrize("size,t,block", [(3, T9, 4_000_000), (3, T9, 300), (5, Fraction(8, 10), 4_000_000), (2, Fraction(1, 2), 500)])
def test_classes_equal_all_pairs(spark, size, t, block):
    rows = [(i, x) for i, x in enumerate(texts(size + block))]
    df = docs(spark, [(i, x, "en", "a") for i, x in rows])
    got = jaccard_classes(df, size=size, threshold=t, block_shingles=block).collect()
    assert sorted(map(tuple, got), key=str) == brute(rows, size, t)


def test_awkward_rows(spark):
    df = awkward(spark)
    rows = [(r.doc_id, r.text) for r in df.collect()]
    got = jaccard_classes(df, size=3, threshold="9/10")
    assert got.columns == ["doc_id", "n_shingles", "component_id"]
    assert sorted(map(tuple, got.collect()), key=str) == brute(rows, 3, T9)
    assert jaccard_classes(empty(spark)).collect() == []


def test_one_of_each_keeps_the_smallest_key_and_all_columns(spark):
    df = awkward(spark)
    got = one_of_each(df, size=3, threshold="9/10")
    assert got.columns == df.columns
    rows = got.collect()
    keys = sorted((r.doc_id for r in rows if r.doc_id is not None))
    # 13 is 1 in capitals, 7 is 6 and a word; NULL keys go with the class of a known key
    assert keys == [1, 2, 3, 4, 5, 6, 8, 9, 10, 11, 12, 14]
    assert sum(r.doc_id is None for r in rows) == 1  # the one without text
    assert one_of_each(empty(spark)).collect() == []


def test_hot_group_of_copies_and_near_copies(spark):
    base = " ".join(f"w{i}" for i in range(200))
    rows = [(i, base if i % 2 else base.replace("w7 ", f"x{i} "), "en", "a") for i in range(400)]
    got = {r.doc_id: r.component_id for r in jaccard_classes(docs(spark, rows), size=3, threshold="9/10").collect()}
    assert set(got.values()) == {0}


@settings(max_examples=150, deadline=None)
@given(st.integers(0, 10_000), st.sampled_from([T9, Fraction(8, 10), Fraction(2, 3)]), st.integers(1, 400))
def test_similar_sets_share_a_signature(seed, t, n):
    rng = np.random.default_rng(seed)
    a = np.unique(rng.integers(0, 2**63, n).astype(np.uint64) * np.uint64(2))
    changes = int(rng.integers(0, n // 4 + 2))
    b = np.unique(np.concatenate([a[changes:], rng.integers(0, 2**63, int(rng.integers(0, changes + 1))).astype(np.uint64)]))
    both = len(np.intersect1d(a, b))
    if len(a) and len(b) and len(np.union1d(a, b)) != both and both >= t * len(np.union1d(a, b)):
        s = Signatures(t)
        assert set(s.of(a).tolist()) & set(s.of(b).tolist())


def test_sets_with_many_empty_parts_share_a_signature():
    s = Signatures(Fraction(8, 10))
    rng = np.random.default_rng(3)
    # all shingles in a narrow range leave most parts empty at the first cut
    a = np.unique(rng.integers(0, 2**40, 300).astype(np.uint64))
    b = a[10:]
    assert set(s.of(a).tolist()) & set(s.of(b).tolist())


@settings(max_examples=60, deadline=None)
@given(st.lists(st.sets(st.integers(0, 40), min_size=1, max_size=30), min_size=1, max_size=25))
def test_divide_skip_equals_all_pairs(sets):
    arrays = [np.array(sorted(s), np.uint64) for s in sets]
    index = InvertedLists(arrays)
    t = Fraction(7, 10)
    for x, s in enumerate(sets):
        got = divide_skip(index.lists(arrays[x]), len(s), index.sizes, t, lambda y: False)
        want = [(y, len(s & o)) for y, o in enumerate(sets) if len(s & o) >= t * len(s | o)]
        assert sorted(got) == want
    links = link_block(arrays, 0, t)
    parent = list(range(len(sets)))

    def root(x):
        return x if parent[x] == x else root(parent[x])

    for x, y in combinations(range(len(sets)), 2):
        if len(sets[x] & sets[y]) >= t * len(sets[x] | sets[y]):
            parent[root(x)] = root(y)
    for x, y in combinations(range(len(sets)), 2):
        assert (root(x) == root(y)) == (links.root(x) == links.root(y))


def test_a_block_without_links_is_searched_fast():
    """Every class comes up for every other; one step in Python for each entry of a list took some ten seconds."""
    from time import process_time

    rng = np.random.default_rng(5)
    sets = [np.sort(rng.choice(1000, 200, replace=False)).astype(np.uint64) for _ in range(1000)]
    sets.append(np.union1d(sets[500][:195], np.arange(2000, 2005, dtype=np.uint64)))
    began = process_time()
    links = link_block(sets, 0, Fraction(8, 10))
    assert process_time() - began < 4
    assert [x for x in range(len(sets)) if links.root(x) != x] == [1000] and links.root(1000) == 500


def test_distinct_sets_and_their_ids():
    rng = np.random.default_rng(6)
    raw = [rng.integers(0, 50, n).astype(np.uint64) for n in (0, 1, 2, 80, 0, 7)]
    sets = [distinct(x) for x in raw]
    assert all(np.array_equal(s, np.unique(x)) for s, x in zip(sets, raw))
    assert set_ids(sets).tolist() == [int(set_id(s)) for s in sets]
    assert set_ids([]).tolist() == []


def test_components(spark):
    chain = [(i, i + 1) for i in range(60)] + [(100, 101), (101, 100), (100, 100), (None, 5)]
    df = spark.createDataFrame(chain, "a long, b long")
    got = {r.node: r.component for r in components(df).collect()}
    assert got == {**{i: 0 for i in range(61)}, 100: 100, 101: 100}
    assert components(df.limit(0)).collect() == []


def test_hashed_arrays(spark):
    keys = [5, -1, -(2**63), 2**63 - 1, 0, 77]
    df = spark.createDataFrame([(k, i) for i, k in enumerate(keys)], "key long, place long")
    arrays = write_hashed(df, new_folder(spark, "test"), "key", ["place"], rows_of_shard=2)
    wanted = np.array([77, 6, -1, 5, 2**63 - 1], np.int64).view(np.uint64)
    found, columns = arrays.look_up(wanted)
    assert found.tolist() == [True, False, True, True, True]
    assert columns["place"].tolist() == [5, 0, 1, 0, 3]


def test_other_keys_than_whole_numbers_are_refused(spark):
    df = spark.createDataFrame([("a", "some words of a text")], "doc_id string, text string")
    for operator in (jaccard_classes, one_of_each):
        with pytest.raises(TypeError, match="whole number"):
            operator(df)
