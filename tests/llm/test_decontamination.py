import hashlib
import re

import pytest
from helpers import LOWER, awkward, docs, empty
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from variantflow.llm.decontamination import SuffixAutomaton, contaminated, n_hit, scan_benchmark, without_spans

WORD = re.compile("[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
ITEM = "one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen"


def windows(items, window):
    out = {}
    for name, words in items:
        for i in range(max(1, len(words) - window + 1) if words else 0):
            out.setdefault(tuple(words[i : i + window]), set()).add(name)
    return out


def brute(text, found):
    words = WORD.findall((text or "").translate(LOWER))
    marked, items = [False] * len(words), set()
    for w, names in found.items():
        for i in range(len(words) - len(w) + 1):
            if tuple(words[i : i + len(w)]) == w:
                marked[i : i + len(w)] = [True] * len(w)
                items |= names
    return len(words), sum(marked), sorted(x for x in items if x is not None)


@settings(max_examples=200, deadline=None)
@given(
    st.lists(st.lists(st.integers(0, 3), max_size=9), min_size=1, max_size=6),
    st.lists(st.integers(0, 3), max_size=40), st.integers(1, 5),
)
def test_automaton_finds_every_window(items, doc, window):
    named = list(enumerate(items))
    want = {}
    for w, names in windows(named, window).items():
        for i in range(len(doc) - len(w) + 1):
            if tuple(doc[i : i + len(w)]) == w:
                want.setdefault((i + len(w), len(w)), set()).update(names)
    got = {}
    for at, length, names in SuffixAutomaton(named, window).hits(doc):
        got.setdefault((at, length), set()).update(names)
    assert got == want


@pytest.mark.parametrize("block_words", [200_000, 8])
def test_scan_equals_brute_force(spark, block_words):
    items = [(1, ITEM), (2, "short item"), (3, None), (4, ""), (None, "no key here"), (5, ITEM.upper() + "!"), (6, "the")]
    bench = spark.createDataFrame(items, "item_id long, text string")
    extra = docs(spark, [
        (20, f"before {ITEM} after", "en", "a"), (21, "a Short-Item!", "en", "a"), (22, ITEM.rsplit(" ", 3)[0], "en", "a"),
        (23, ITEM.replace("seven", "7"), "en", "a"), (24, "no key here", "en", "a"), (25, f"{ITEM} {ITEM}", "en", "a"),
    ])
    df = awkward(spark).unionByName(extra)
    named = [(k if k is None else str(k), WORD.findall((x or "").translate(LOWER))) for k, x in items]
    found = windows(named, 13)
    got = scan_benchmark(df, bench, name="contamination", block_words=block_words, keep=["doc_id", "text"])
    rows = got.withColumn("hit", n_hit("contamination")).collect()
    assert len(rows) == df.count()
    for r in rows:
        c = r.contamination
        assert (c.n_words, r.hit, list(c["items"])) == brute(r.text, found)
        assert all(a.end < b.first for a, b in zip(c.spans, c.spans[1:]))


def test_empty_tables(spark):
    bench = spark.createDataFrame([], "item_id long, text string")
    rows = scan_benchmark(awkward(spark), bench, keep=["doc_id"], name="c").collect()
    assert all(r.c.spans == [] and r.c["items"] == [] for r in rows)
    assert scan_benchmark(empty(spark), bench, name="c").collect() == []


def test_cut_spans(spark):
    bench = spark.createDataFrame([(1, ITEM)], "item_id long, text string")
    filler = "filler " * 400
    df = docs(spark, [(1, f"Keep, {ITEM}; this.", "en", "a"), (2, f"{filler}{ITEM}", "en", "a"), (3, "clean", "en", "a"),
                      (4, f"{filler}{ITEM.rsplit(' ', 2)[0]}", "en", "a")])
    found = scan_benchmark(df, bench, name="c")
    got = {r.doc_id: r.text for r in without_spans(found, "c").collect()}
    assert got[1].startswith("Keep, ") and got[1].endswith("; this.") and "thirteen" not in got[1]
    assert "thirteen" not in got[2]  # longer than a window
    assert got[3] == "clean"
    assert "thirteen" in got[4]  # one window, less than a twentieth of the words


def test_limit_is_inclusive(spark):
    df = spark.createDataFrame([(5, 100), (4, 100), (0, 0)], "h long, n long")
    assert [r[0] for r in df.select(contaminated(F.col("h"), F.col("n"))).collect()] == [True, False, False]


def test_digest_of_no_items():
    assert hashlib.sha256(b"").hexdigest().startswith("e3b0c442")
