import hashlib
import random
import re
import zlib

import numpy as np
import pytest
from helpers import ENGLISH, awkward, docs, empty

from variantflow.llm.batches import U, mix
from variantflow.llm.periodic_runs import periodic_runs, repetitive_stretches, runs_of, sequence_words
from variantflow.llm.queries import QUERIES

WORDS = re.compile(r"[^\x20\x09-\x0D]+")


def brute(w, least=6, exponent=4):
    """Runs from all periods at all places."""
    n, out = len(w), []
    for q in range(1, n // exponent + 1):
        i = q
        while i < n:
            if w[i] != w[i - q]:
                i += 1
                continue
            s = i - q
            while i < n and w[i] == w[i - q]:
                i += 1
            smaller = any(w[s : i - p] == w[s + p : i] for p in range(1, q))
            if i - s >= max(least, exponent * q) and not smaller:
                out.append((s, i - s, q))
    return sorted(out)


def periodic(rng, n, letters):
    w = [rng.randrange(letters) for _ in range(n)]
    if rng.random() < 0.6 and n:
        a = rng.randrange(n)
        p = 1 + (n - a) // rng.randint(3, 10)
        w = [w[a + (i - a) % p] if i >= a else x for i, x in enumerate(w)]
    return w


@pytest.mark.parametrize("least, exponent", [(6, 4), (2, 2), (6, 3), (3, 2)])
def test_runs_are_those_of_all_periods(least, exponent):
    rng = random.Random(least * exponent)
    for _ in range(1200):
        w = periodic(rng, rng.randint(0, 60), rng.randint(1, 4))
        assert runs_of(w, least, exponent) == brute(w, least, exponent)


@pytest.mark.parametrize("least, exponent", [(6, 4), (2, 2), (4, 3)])
def test_stretches_hold_all_runs(least, exponent):
    rng = random.Random(3)
    for _ in range(150):
        texts = [periodic(rng, rng.randint(0, 40), rng.randint(2, 30)) for _ in range(6)]
        first = np.cumsum([0] + [len(t) for t in texts])
        h = mix(np.array(sum(texts, []), U) + U(5))
        found = [[] for _ in texts]
        for a, b in repetitive_stretches(h, first, least, exponent):
            d = int(np.searchsorted(first, a, side="right")) - 1
            assert b <= first[d + 1]
            found[d] += [(s + a - first[d], n, q) for s, n, q in runs_of(h[a:b].tolist(), least, exponent)]
        assert [sorted(f) for f in found] == [brute(t, least, exponent) for t in texts]


def test_sequence_words():
    assert sequence_words(6, 4) == 5 and sequence_words(2, 2) == 1
    with pytest.raises(ValueError):
        sequence_words(6, 1)


def test_collapsed_text_and_other_columns(spark):
    text = "so " + "do re mi " * 5 + "fa\n\nla la la la la la end"
    found = periodic_runs(docs(spark, [(1, text, "en", "a")])).first()
    assert found["n_words"] == "n_words of 1"
    assert found["_n_words"] == 24
    assert [tuple(r) for r in found.runs] == [(1, 15, 3), (17, 6, 1)]
    assert found.collapsed == "so do re mi fa la end"


def test_awkward_rows(spark):
    rows = {r.doc_id: r for r in periodic_runs(awkward(spark), keep=["doc_id"]).collect()}
    for k in (2, 3, 4):
        assert (rows[k].n_words, rows[k].runs, rows[k].collapsed) == (0, [], "")
    assert rows[1].collapsed == ENGLISH
    assert rows[12].collapsed == "x" * 300_000
    assert rows[14].collapsed == "é\u00a0 ñ\u3000 ü"
    # the long text repeats all but a counter
    assert rows[6].runs == [] and rows[6].n_words == 3000 * 23
    assert len(rows) == 15
    assert periodic_runs(empty(spark)).collect() == []


def test_a_long_text_of_one_word(spark):
    found = periodic_runs(docs(spark, [(1, "la " * 200_000, None, None)]), keep=["doc_id"]).first()
    assert [tuple(r) for r in found.runs] == [(0, 200_000, 1)] and found.collapsed == "la"


def test_query_against_all_periods(spark):
    sf = "/root/testdata/sf0.001"
    rows = {r.doc_id: tuple(r) for r in QUERIES["op12_periodic_runs"](spark, sf).collect()}
    texts = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()
    assert len(rows) == len(texts)
    some = 0
    for doc_id, text in texts:
        w = WORDS.findall(text or "")
        if len(w) > 2000:
            continue
        h, n = zlib.crc32(str(doc_id).encode()), len(w)
        if h % 10 == 0 and n:
            a = h // 10 % n
            p = 1 + (n - a) // (3 + h // 10 % 8)
            w = [w[a + (i - a) % p] if i >= a else x for i, x in enumerate(w)]
        runs = brute(w)
        some += len(runs)
        gone = {i for s, m, q in runs for i in range(s + q, s + m)}
        best = min(runs, key=lambda r: (-r[1], r[0], r[2])) if runs else None
        told = (*best, 1000 * best[1] // best[2]) if best else (None,) * 4
        digests = ["".join(f"{s},{m},{q}\n" for s, m, q in runs), " ".join(x for i, x in enumerate(w) if i not in gone)]
        assert rows[doc_id] == (doc_id, len(runs), *told, *(hashlib.sha256(x.encode()).hexdigest() for x in digests))
    assert some
