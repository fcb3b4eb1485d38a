import math
import os
from collections import Counter, defaultdict

import numpy as np
import pytest
from helpers import awkward, docs, empty, words
from pyspark.sql import functions as F

from variantflow.llm.hash_arrays import local_path
from variantflow.llm.language_model import Level, _merge_grams, discounts, fit_language_model, perplexity, score_texts


def brute(train, texts):
    """(n_tokens, n_known, tokens, base, score) of each text by dictionaries."""
    ends = [words(t) + ["</s>\n"] for t in train]
    c, pairs = Counter(), Counter()
    for w in ends:
        c.update(w)
        pairs.update(zip(["<s>\n", *w[:-1]], w))
    n, v, before = sum(c.values()), len(c), Counter(w for _, w in pairs)
    counts = lambda values: [sum(x == k for x in values) for k in (1, 2, 3, 4)]
    d, e = discounts(counts(pairs.values())), discounts(counts(before.values()))
    off = lambda x, d: d[min(x, 3) - 1] if x else 0.0
    total, left = Counter(), defaultdict(float)
    for (a, _), x in pairs.items():
        total[a] += x
        left[a] += off(x, d)
    rest = sum(off(x, e) for x in before.values()) / len(pairs) if pairs else 1.0

    def p(a, b):
        one = (max(before[b] - off(before[b], e), 0) / len(pairs) if pairs else 0) + rest / (v + 1)
        if not total[a]:
            return one
        return max(pairs[a, b] - off(pairs[a, b], d), 0) / total[a] + left[a] / total[a] * one

    out = []
    for t in texts:
        w = words(t) + ["</s>\n"]
        base = sum(math.log10((c[x] + 1) / (n + v + 1)) for x in w)
        out.append((len(w), sum(c[x] > 0 for x in w), n, base, sum(math.log10(p(a, b)) for a, b in zip(["<s>\n", *w[:-1]], w))))
    return out, p, c


def texts(seed, n):
    rng = np.random.default_rng(seed)
    return [" ".join(f"w{min(int(x), 300)}" for x in rng.zipf(1.4, int(rng.integers(0, 60)))) for _ in range(n)]


@pytest.mark.parametrize("partitions", [1, 5])
def test_scores_equal_dictionaries(spark, partitions):
    train, held = texts(1, 120), texts(2, 40) + ["the unseen", "", None]
    df = docs(spark, [(i, t, "en", "a") for i, t in enumerate(train)]).repartition(partitions)
    model = fit_language_model(df)
    got = score_texts(docs(spark, [(i, t, "en", "a") for i, t in enumerate(held)]), model, keep=["doc_id"]).orderBy("doc_id").collect()
    want, p, c = brute(train, held)
    for r, w in zip(got, want, strict=True):
        assert tuple(r[1:4]) == w[:3]
        assert math.isclose(r.base_score, w[3], rel_tol=1e-9) and math.isclose(r.score, w[4], rel_tol=1e-9)
    # probabilities after a word sum to one, the unknown word among them
    assert math.isclose(sum(p("w1", x) for x in c) + p("w1", "never"), 1.0, rel_tol=1e-9)
    worse = docs(spark, [(0, "w250 w3 w200 w2 w190", "en", "a"), (1, train[0], "en", "a")])
    by_key = {r.doc_id: r.p for r in score_texts(worse, model, keep=["doc_id"]).withColumn("p", perplexity()).collect()}
    assert by_key[0] > by_key[1] > 1


def test_awkward_rows(spark):
    df = awkward(spark)
    rows = df.collect()
    got = score_texts(df, fit_language_model(df), keep=["doc_id", "text"]).collect()
    want, _, _ = brute([r.text for r in rows], [r.text for r in got])
    for r, w in zip(got, want, strict=True):
        assert tuple(r[2:5]) == w[:3] and math.isclose(r.score, w[4], rel_tol=1e-9)
    assert score_texts(empty(spark), fit_language_model(df), keep=["doc_id"]).collect() == []


def test_a_model_of_nothing(spark):
    got = score_texts(docs(spark, [(1, "a b", None, None)]), fit_language_model(empty(spark)), keep=["doc_id"]).first()
    assert (got.n_tokens, got.n_known, got.train_tokens, got.base_score, got.score) == (3, 0, 0, 0.0, 0.0)


def test_a_frequent_pair(spark):
    train = ["so it " * 2000] * 3 + ["so be it"]
    model = fit_language_model(docs(spark, [(i, t, "en", "a") for i, t in enumerate(train)]))
    want, _, _ = brute(train, ["so it so"])
    got = score_texts(docs(spark, [(1, "so it so", "en", "a")]), model, keep=[]).agg(F.first("score")).first()[0]
    assert math.isclose(got, want[0][4], rel_tol=1e-9)


def brute_of_order(order, train, held):
    """Score of each text by a recursion over orders, with dictionaries."""
    ends = [["<s>\n", *words(t), "</s>\n"] for t in train]
    counts = {order: Counter(tuple(w[i : i + order]) for w in ends for i in range(len(w) - order + 1))}
    for k in range(order - 1, 0, -1):
        raw = Counter(tuple(w[i : i + k]) for w in ends for i in range(len(w) - k + 1))
        left = Counter(g[1:] for g in {tuple(w[i : i + k + 1]) for w in ends for i in range(len(w) - k)})
        counts[k] = {g: raw[g] if g[0] == "<s>\n" else left[g] for g in raw if g != ("<s>\n",)}
    d = {k: discounts([sum(x == i for x in c.values()) for i in (1, 2, 3, 4)]) for k, c in counts.items()}
    after = {k: defaultdict(list) for k in counts}
    for k, c in counts.items():
        for g, x in c.items():
            after[k][g[:-1]].append(x)
    v = len(counts[1])

    def p(g):
        k = len(g)
        lower = p(g[1:]) if k > 1 else 1 / (v + 1)
        found = after[k].get(g[:-1])
        if not found:
            return lower
        off = lambda x: d[k][min(x, 3) - 1] if x else 0.0
        x = counts[k].get(g, 0)
        return (max(x - off(x), 0) + sum(map(off, found)) * lower) / sum(found)

    out = []
    for t in held:
        w = ["<s>\n", *words(t), "</s>\n"]
        out.append(sum(math.log10(p(tuple(w[max(0, i - order + 1) : i + 1]))) for i in range(1, len(w))))
    return out


@pytest.mark.parametrize("order", [2, 3, 4])
def test_each_order_equals_dictionaries(spark, order):
    train = texts(3, 120) + ["so it " * 400, "so be it", "", None]
    held = texts(4, 40) + ["so it so be it so", "the unseen w1 w2 w1", "", None]
    df = docs(spark, [(i, t, "en", "a") for i, t in enumerate(train)]).repartition(3)
    model = fit_language_model(df, order=order)
    found = score_texts(docs(spark, [(i, t, "en", "a") for i, t in enumerate(held)]), model, keep=["doc_id"])
    got = [r.score for r in found.orderBy("doc_id").collect()]
    assert np.allclose(got, brute_of_order(order, train, held), rtol=1e-9)


def test_contexts_of_very_many_words(spark):
    train = [f"so it w{i} w{i} so it" for i in range(700)] + [f"be w{i}" for i in range(300)] + texts(5, 60)
    held = ["so it w7 w7 so it", "so it w699", "so it never", "be w299", *texts(6, 10)]
    model = fit_language_model(docs(spark, [(i, t, "en", "a") for i, t in enumerate(train)]), order=3)
    found = score_texts(docs(spark, [(i, t, "en", "a") for i, t in enumerate(held)]), model, keep=["doc_id"])
    got = [r.score for r in found.orderBy("doc_id").collect()]
    assert np.allclose(got, brute_of_order(3, train, held), rtol=1e-9)


def test_a_model_leaves_its_arrays_only(spark):
    def shuffled():
        held = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
        return {held.apply(i).getName() for i in range(held.size()) if held.apply(i).getName().startswith("shuffle_")}

    rng = np.random.default_rng(7)
    train = [(i, " ".join(f"w{x}" for x in rng.integers(0, 400, 300)), "en", "a") for i in range(100)]
    df, before = docs(spark, train).repartition(3), shuffled()
    model = fit_language_model(df, order=3)
    assert shuffled() <= before
    folder = local_path(model.folder)
    size = lambda name: sum(os.path.getsize(f"{folder}/{f}") for f in os.listdir(folder) if f.startswith(f"{name}-of-3"))
    contexts = size("contexts") // 8
    assert contexts > 10_000
    # a byte for each context and a place for every sixteenth; each shard rounds up
    assert size("starts") + size("sizes") < 2 * contexts + 64 * model.shards


def test_merged_grams_and_stored_sums(tmp_path):
    rng = np.random.default_rng(8)
    for k, n in ((2, 500), (3, 500), (4, 500), (3, 0)):
        ids, counts = rng.integers(0, 6, (n, k)).astype(np.uint32), rng.integers(1, 5, n)
        want = Counter()
        for g, c in zip(ids.tolist(), counts.tolist()):
            want[tuple(g)] += c
        got, c = _merge_grams([ids[: n // 2], ids[n // 2 :]], [counts[: n // 2], counts[n // 2 :]])
        assert [(tuple(g), x) for g, x in zip(got.tolist(), c.tolist())] == sorted(want.items())
    level = Level(str(tmp_path), 3, 1)
    ids = np.array([(a, 1, w) for a, words_ in ((0, 300), (1, 20), (2, 3)) for w in range(words_)], np.uint32)
    counts = rng.integers(1, 400, len(ids))
    level.save(0, ids, counts)
    assert sorted(level.arrays["widths"][0].tolist()) == [20, 300]
    count, stats = level.look_up(ids[:, :2].astype(np.int64), ids[:, 2].astype(np.int64))
    assert (count == counts).all()
    for a in range(3):
        c = counts[ids[:, 0] == a]
        assert (stats[ids[:, 0] == a] == [c.sum(), (c == 1).sum(), (c == 2).sum(), (c >= 3).sum()]).all()
