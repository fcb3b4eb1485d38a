"""Benchmark decontamination with a generalised suffix automaton over words.

The automaton holds every run of words of the normalised benchmark items.  The
words of a document are streamed through it; after each word the state tells the
longest run ending there that occurs in an item.  A run of ``window`` words, or a
whole item that is shorter, is a hit: all its words are marked.

Only runs of words that all occur in some item, and that are as long as the
shortest window, are streamed; every other word leads back to the start state
anyway.  Words are compared by 64-bit hashes.

The items are broadcast.  ``block_words`` bounds what is broadcast and built at
once: more items make more automata, through which the documents go one after
the other.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from variantflow.llm.batches import cut_words, free_name, map_texts, separators, slices_of_words, text_slices

#: words are ``[^\x00-\x2F\x3A-\x60\x7B-\x7F]+`` of the text with A-Z as a-z
NO_WORD = separators((0x00, 0x2F), (0x3A, 0x40), (0x5B, 0x60), (0x7B, 0x7F))
WINDOW = 13
BLOCK_WORDS = 200_000
#: pattern of the same words before lower-casing
WORD_PATTERN = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


class SuffixAutomaton:
    """All runs of words of several items; state 0 is the empty run."""

    def __init__(self, items: list[tuple[object, list[int]]], window: int):
        self.window = window
        self.next: list[dict[int, int]] = [{}]
        self.link = [-1]
        self.length = [0]
        self.items: dict[int, set] = {}  # of the windows of full length, by state
        self.whole: dict[int, dict[int, set]] = {}  # of shorter items, by state and length
        for _, words in items:
            last = 0
            for w in words:
                last = self._extend(last, w)
        for name, words in items:
            for state, n in self.matches(words):
                if n >= window:
                    self.items.setdefault(self.suffix(state, window), set()).add(name)
            if words and len(words) < window:
                state, n = list(self.matches(words))[-1]
                self.whole.setdefault(state, {}).setdefault(n, set()).add(name)
        self.shortest = min((min(len(w), window) for _, w in items if w), default=0)
        self._short_above()

    def _short_above(self) -> None:
        """For each state, the nearest state on its suffix path, itself first, that is a whole short item."""
        self.short = [-1] * len(self.link)
        for state in sorted(range(1, len(self.link)), key=self.length.__getitem__):
            self.short[state] = state if state in self.whole else self.short[self.link[state]]

    def _new(self, length: int, link: int, following: dict[int, int]) -> int:
        self.next.append(following)
        self.link.append(link)
        self.length.append(length)
        return len(self.link) - 1

    def _split(self, p: int, w: int, q: int) -> int:
        """The state of p's run and w alone, where q also stands for longer runs."""
        clone = self._new(self.length[p] + 1, self.link[q], dict(self.next[q]))
        self.link[q] = clone
        while p >= 0 and self.next[p].get(w) == q:
            self.next[p][w] = clone
            p = self.link[p]
        return clone

    def _extend(self, last: int, w: int) -> int:
        q = self.next[last].get(w)
        if q is not None:  # an earlier item has this run
            return q if self.length[q] == self.length[last] + 1 else self._split(last, w, q)
        state = self._new(self.length[last] + 1, 0, {})
        p = last
        while p >= 0 and w not in self.next[p]:
            self.next[p][w] = state
            p = self.link[p]
        if p >= 0:
            q = self.next[p][w]
            self.link[state] = q if self.length[q] == self.length[p] + 1 else self._split(p, w, q)
        return state

    def matches(self, words) -> Iterator[tuple[int, int]]:
        """State and longest matching length after each word."""
        state = n = 0
        following, link, length = self.next, self.link, self.length
        for w in words:
            while state and w not in following[state]:
                state = link[state]
                n = length[state]
            if w in following[state]:
                state = following[state][w]
                n += 1
            yield state, n

    def suffix(self, state: int, n: int) -> int:
        """The state of the last ``n`` words of a state's run."""
        while self.length[self.link[state]] >= n:
            state = self.link[state]
        return state

    def hits(self, words) -> Iterator[tuple[int, int, set]]:
        """(position after the last word, length, items) of each window that occurs."""
        for at, (state, n) in enumerate(self.matches(words), 1):
            if n >= self.window:
                yield at, self.window, self.items.get(self.suffix(state, self.window), set())
            short = self.short[state]
            while short > 0:
                for length, names in self.whole[short].items():
                    if length <= n:
                        yield at, length, names
                short = self.short[self.link[short]]


def _vocabulary(texts: list[str], names: list) -> tuple[np.ndarray, list[tuple[object, list[int]]]]:
    """Sorted hashes of the items' words, and the items as positions therein."""
    column = pa.array(texts, pa.string())
    hashes = []
    for _, _, words in slices_of_words(column, NO_WORD):
        h = words.hashes()
        hashes += [h[a:b] for a, b in zip(words.first[:-1], words.first[1:])]
    known = np.unique(np.concatenate(hashes)) if hashes else np.empty(0, np.uint64)
    return known, [(n, np.searchsorted(known, h).tolist()) for n, h in zip(names, hashes)]


class _Scan:
    def __init__(self, known: np.ndarray, automaton: SuffixAutomaton):
        self.known, self.automaton = known, automaton

    def runs(self, ids: np.ndarray, first: np.ndarray) -> Iterator[tuple[int, int, int]]:
        """(document, start, end) of runs of known words that are long enough."""
        inside = ids >= 0
        start, end = inside.copy(), inside.copy()
        if not len(ids):
            return
        start[1:] &= ~inside[:-1]
        end[:-1] &= ~inside[1:]
        bounds = first[1:-1]
        bounds = bounds[(bounds > 0) & (bounds < len(ids))]
        start[bounds] = inside[bounds]
        end[bounds - 1] = inside[bounds - 1]
        start, end = np.flatnonzero(start), np.flatnonzero(end) + 1
        long = end - start >= self.automaton.shortest
        start, end = start[long], end[long]
        doc = np.searchsorted(first, start, side="right") - 1
        yield from zip(doc.tolist(), start.tolist(), end.tolist())

    def __call__(self, texts: pa.Array):
        """Word counts, and for each document with hits its spans of words and its items."""
        for _, _, buf, offsets in text_slices(texts, 1 << 62):
            words = cut_words(buf, offsets, NO_WORD)
            counts = words.counts()
            spans: dict[int, list[list[int]]] = {}
            items: dict[int, set] = {}
            if len(self.known) and len(words.start):
                h = words.hashes()
                at = np.minimum(np.searchsorted(self.known, h), len(self.known) - 1)
                ids = np.where(self.known[at] == h, at, -1)
                for doc, start, end in self.runs(ids, words.first):
                    base = start - int(words.first[doc])
                    for position, length, names in self.automaton.hits(ids[start:end].tolist()):
                        _add_span(spans.setdefault(doc, []), base + position - length, base + position)
                        items.setdefault(doc, set()).update(names)
            return counts, spans, items, words
        return np.zeros(0, int), {}, {}, None


def _add_span(spans: list[list[int]], start: int, end: int) -> None:
    """Add a span whose end is not before the last one's, merging what touches."""
    while spans and spans[-1][1] >= start:
        start = min(start, spans.pop()[0])
    spans.append([start, end])


FOUND = "struct<n_words: bigint, spans: array<struct<first: bigint, end: bigint>>, items: array<string>>"


def _scan_job(held):
    def job():
        known, items, window = held.value
        scan = _Scan(known, SuffixAutomaton(items, window))

        def work(texts: pa.Array):
            counts, spans, items, _ = scan(texts)
            rows = [
                {
                    "n_words": int(n),
                    "spans": [{"first": a, "end": b} for a, b in spans.get(i, [])],
                    "items": sorted(x for x in items.get(i, ()) if x is not None),
                }
                for i, n in enumerate(counts.tolist())
            ]
            span = pa.struct([("first", pa.int64()), ("end", pa.int64())])
            kind = pa.struct([("n_words", pa.int64()), ("spans", pa.list_(span)), ("items", pa.list_(pa.string()))])
            return [pa.array(rows, kind)]

        return work

    return job


def scan_benchmark(
    docs: DataFrame,
    items: DataFrame,
    text: str = "text",
    item_key: str = "item_id",
    item_text: str = "text",
    keep: list[str] | None = None,
    name: str = "contamination",
    window: int = WINDOW,
    block_words: int = BLOCK_WORDS,
) -> DataFrame:
    """``docs`` with a struct column of what was found: n_words, spans, items.

    ``spans`` are the marked words as half-open ranges of word numbers, sorted,
    apart from each other; ``items`` the keys of the items whose windows occur,
    as text, sorted.  NULL and empty texts have no words and no hits; items
    without words never match; items with a NULL key mark words but are not
    listed; equal items are all listed.
    """
    spark = docs.sparkSession
    keep = docs.columns if keep is None else keep
    if name in keep:
        raise ValueError(f"a column is called {name} already")
    wanted = items.select(F.col(item_key).cast("string").alias("key"), F.coalesce(item_text, F.lit("")).alias("text"))
    # a word takes a byte and a separator at least
    sizes = wanted.agg(F.sum((F.octet_length("text") + 1) / 2).alias("words")).first()
    blocks = max(1, int(-(-(sizes.words or 0) // block_words)))
    out, found = docs, []
    for b in range(blocks):
        block = wanted.where(F.pmod(F.xxhash64("text"), F.lit(blocks)) == b).orderBy("key", "text").collect()
        known, numbered = _vocabulary([r.text for r in block], [r.key for r in block])
        held = spark.sparkContext.broadcast((known, numbered, window))
        column = name if blocks == 1 else free_name(out, f"{name}_{b}")
        out = map_texts(out, text, [*keep, *found] + [text] * (text not in keep and b + 1 < blocks), [(column, FOUND)], _scan_job(held))
        found.append(column)
    if blocks == 1:
        return out
    return _merged(out, keep, found, name)


def _merged(df: DataFrame, keep: list[str], found: list[str], name: str) -> DataFrame:
    """One struct for the findings of several blocks of items."""
    spans = F.array_sort(F.flatten(F.array(*[F.col(c)["spans"] for c in found])))
    start = F.expr("cast(array() as array<struct<first: bigint, end: bigint>>)")

    def add(done, span):
        last = F.element_at(done, -1)
        joined = F.struct(last["first"].alias("first"), F.greatest(last["end"], span["end"]).alias("end"))
        touches = (F.size(done) > 0) & (F.when(F.size(done) > 0, last["end"]) >= span["first"])
        return F.when(touches, F.concat(F.slice(done, 1, F.size(done) - 1), F.array(joined))).otherwise(
            F.concat(done, F.array(span))
        )

    items = F.array_sort(F.array_distinct(F.flatten(F.array(*[F.col(c)["items"] for c in found]))))
    merged = F.struct(
        F.col(found[0])["n_words"].alias("n_words"), F.aggregate(spans, start, add).alias("spans"), items.alias("items")
    )
    return df.select(*[df[f"`{c}`"] for c in keep], merged.alias(name))


def n_hit(found: str):
    """Marked words, from a struct of findings."""
    return F.aggregate(F.col(found)["spans"], F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["first"])


def contaminated(n_hits, n_words, percent: int = 5):
    """True if a document has hits, and they are ``percent`` of its words or more."""
    return (n_hits > 0) & (100 * n_hits >= percent * n_words)


def without_spans(docs: DataFrame, found: str, text: str = "text", longest: int = WINDOW, percent: int = 5) -> DataFrame:
    """``docs`` with marked words cut out of the text.

    Cut are spans of more than ``longest`` words, and all spans of a document
    whose marked words are ``percent`` of its words or more.  What stands
    between words is kept; texts without such spans are unchanged.
    """
    column = free_name(docs, "cut")
    over = contaminated(n_hit(found), F.col(found)["n_words"], percent)
    spans = F.when(over, F.col(found)["spans"]).otherwise(
        F.filter(F.col(found)["spans"], lambda s: s["end"] - s["first"] > longest)
    )
    marked = docs.withColumn(column, spans)
    gaps = F.split(F.col(text), WORD_PATTERN, -1)
    words = F.regexp_extract_all(F.col(text), F.lit(f"({WORD_PATTERN})"), 1)
    inside = lambda i: F.exists(F.col(column), lambda s: (s["first"] <= i) & (i < s["end"]))
    rest = F.transform(
        F.arrays_zip(gaps.alias("gap"), words.alias("word")),
        lambda x, i: F.concat(x["gap"], F.when(inside(i), "").otherwise(F.coalesce(x["word"], F.lit("")))),
    )
    cut = F.when(F.size(column) > 0, F.array_join(rest, "")).otherwise(F.col(text))
    return marked.withColumn(text, cut).drop(column)
