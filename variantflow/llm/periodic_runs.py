"""Periodic runs of words, found with a suffix automaton and link-cut access.

A run is a stretch of consecutive words with smallest period q that no
neighbouring word extends.  The words of a stretch are appended to a suffix
automaton one by one.  All suffixes of the prefix that ends at word i lie on the
path from its state to the root of the link tree, and each is coloured by the
place where it ended last.  Access of that path (link-cut, with splay trees)
walks its segments of one colour and recolours them with i: a segment of colour
j whose longest suffix has l words says that l words end alike at i and at j, and
no more.  Where the distance i - j is at most l, a square of that period ends at
i, and it reaches back to word j - l + 1.  The squares of one period and one
first word are a run.  The period is the smallest one: a suffix that also ended
nearer would have the nearer colour.

Most words are in no run.  In a run of at least ``exponent`` periods each
sequence of a few words is met again at most one period away, so only stretches
where that holds are given to the automaton.  This loses nothing: such a stretch
holds each of its runs whole.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from variantflow.llm.batches import BLANK, EXACT, ODD, U, cut_words, free_name, map_texts, mix, text_slices

#: a run has at least so many words, and at least so many periods
LEAST_WORDS = 6
LEAST_EXPONENT = 4

Run = tuple[int, int, int]


def automaton(words: list) -> tuple[list[int], list[int], list[int]]:
    """Suffix links, longest lengths, and the state of each prefix."""
    step: list[dict] = [{}]
    link, length, ends = [-1], [0], []
    last = 0
    for word in words:
        state = len(step)
        step.append({})
        link.append(0)
        length.append(length[last] + 1)
        p = last
        while p != -1 and word not in step[p]:
            step[p][word] = state
            p = link[p]
        if p != -1:
            q = step[p][word]
            if length[p] + 1 == length[q]:
                link[state] = q
            else:
                clone = len(step)
                step.append(step[q].copy())
                link.append(link[q])
                length.append(length[p] + 1)
                while p != -1 and step[p].get(word) == q:
                    step[p][word] = clone
                    p = link[p]
                link[q] = link[state] = clone
        last = state
        ends.append(state)
    return link, length, ends


class Paths:
    """The link tree cut into paths of one colour, each a splay tree ordered by depth.

    A path's colour stands at the root of its splay tree.
    """

    def __init__(self, link: list[int]):
        self.up = list(link)
        self.left = [-1] * len(link)
        self.right = [-1] * len(link)
        self.colour = [-1] * len(link)

    def splay(self, x: int) -> None:
        up, left, right, colour = self.up, self.left, self.right, self.colour
        while True:
            y = up[x]
            if y == -1 or (left[y] != x and right[y] != x):
                return
            z = up[y]
            if z != -1 and (left[z] == y or right[z] == y):
                self._rotate(y if (left[z] == y) == (left[y] == x) else x)
            # the last turn makes x the root, which tells the colour
            colour[x] = colour[up[x]]
            self._rotate(x)

    def _rotate(self, x: int) -> None:
        up, left, right, colour = self.up, self.left, self.right, self.colour
        y = up[x]
        z = up[y]
        colour[x] = colour[y]
        if left[y] == x:
            b = right[x]
            left[y], right[x] = b, y
        else:
            b = left[x]
            right[y], left[x] = b, y
        if b != -1:
            up[b] = y
        up[y] = x
        up[x] = z
        if z != -1:
            if left[z] == y:
                left[z] = x
            elif right[z] == y:
                right[z] = x

    def access(self, state: int, colour: int) -> list[tuple[int, int]]:
        """Recolour the path to the root; returns (old colour, deepest state) of its segments."""
        segments = []
        below, at = -1, state
        while at != -1:
            self.splay(at)
            old = self.colour[at]
            if old >= 0:
                segments.append((old, at))
            cut = self.right[at]
            if cut != -1:
                self.colour[cut] = old
            self.right[at] = below
            below, at = at, self.up[at]
        self.colour[below] = colour
        self.splay(state)
        return segments


def runs_of(words: list, least: int = LEAST_WORDS, exponent: int = LEAST_EXPONENT) -> list[Run]:
    """(start, length, period) of all runs of a sequence, by start and period."""
    link, length, ends = automaton(words)
    paths = Paths(link)
    last: dict[tuple[int, int], int] = {}
    for i, state in enumerate(ends):
        for j, deepest in paths.access(state, i):
            if i - j <= length[deepest]:
                last[j - length[deepest] + 1, i - j] = i
    found = ((start, end - start + 1, period) for (start, period), end in last.items())
    return sorted(run for run in found if run[1] >= max(least, exponent * run[2]))


def sequence_words(least: int, exponent: int) -> int:
    """Words of sequences that all lie one period from an equal one in any run."""
    if exponent < 2:
        raise ValueError("a run has two periods at least")
    return max(1, min(max(least, exponent * q) - 2 * q + 1 for q in range(1, least + 2)))


def repetitive_stretches(
    h: np.ndarray, first: np.ndarray, least: int, exponent: int
) -> list[tuple[int, int]]:
    """(start, end) of the stretches of a slice's words that can hold a run.

    ``h``: the words' hashes; document d has words first[d] to first[d + 1].
    """
    k = sequence_words(least, exponent)
    n = len(h) - k + 1
    if n < 1:
        return []
    of = np.repeat(np.arange(len(first) - 1), np.diff(first))
    sums = of[:n].astype(U) * ODD
    for i in range(k):
        sums = mix(sums + h[i : i + n])
    whole = of[:n] == of[k - 1 :]
    order = np.argsort(sums, kind="stable")
    ordered = sums[order]
    gap = np.where(ordered[1:] == ordered[:-1], order[1:] - order[:-1], len(h) + 1)
    far = np.full(n, len(h) + 1, np.int64)
    far[order[1:]] = gap
    far[order[:-1]] = np.minimum(far[order[:-1]], gap)
    near = whole & (far <= len(h))
    while True:
        # position i goes on from the one before it
        on = near[1:] & near[:-1] & (of[1:n] == of[: n - 1])
        starts = np.flatnonzero(near & ~np.concatenate([[False], on]))
        stops = np.flatnonzero(near & ~np.concatenate([on, [False]])) + 1
        # a stretch of so many sequences has k - 1 words more; its runs have periods of at most a share of it
        longest = np.repeat((stops - starts + k - 1) // exponent, stops - starts)
        at = np.flatnonzero(near)
        lost = at[far[at] > longest]
        if not len(lost):
            break
        near[lost] = False
    return [(s, e + k - 1) for s, e in zip(starts.tolist(), stops.tolist()) if e + k - 1 - s >= least]


def _job(least: int, exponent: int):
    schema = pa.list_(pa.struct([(n, pa.int64()) for n in ("start", "length", "period")]))

    def job():
        def work(texts: pa.Array):
            counts, runs, kept = [], [], []
            for _, _, buf, offsets in text_slices(texts):
                words = cut_words(buf, offsets, BLANK)
                first = words.first
                found: list[list[Run]] = [[] for _ in range(len(first) - 1)]
                h = words.hashes(EXACT)
                for a, b in repetitive_stretches(h, first, least, exponent):
                    doc = int(np.searchsorted(first, a, side="right")) - 1
                    _, names = np.unique(h[a:b], return_inverse=True)
                    shift = a - int(first[doc])
                    found[doc] += [(s + shift, n, q) for s, n, q in runs_of(names.tolist(), least, exponent)]
                raw = buf.tobytes()
                for d, of_doc in enumerate(found):
                    # bytes are split at the same blanks
                    text = raw[offsets[d] : offsets[d + 1]].split()
                    of_doc.sort()
                    if of_doc:
                        stays = np.ones(len(text), bool)
                        for s, n, q in of_doc:
                            stays[s + q : s + n] = False
                        text = [text[i] for i in np.flatnonzero(stays).tolist()]
                    kept.append(b" ".join(text))
                    runs.append([dict(zip(("start", "length", "period"), r)) for r in of_doc])
                counts.append(words.counts())
            return [
                pa.array(np.concatenate(counts) if counts else [], pa.int64()),
                pa.array(runs, schema),
                pa.array(kept, pa.binary()).cast(pa.string()),
            ]

        return work

    return job


def periodic_runs(
    docs: DataFrame,
    text: str = "text",
    keep: list[str] | None = None,
    names: tuple[str, str, str] = ("n_words", "runs", "collapsed"),
    least: int = LEAST_WORDS,
    exponent: int = LEAST_EXPONENT,
) -> DataFrame:
    """Columns ``keep`` (all by default) with word count, runs, and the text without repetitions.

    Words are ``[^\\x20\\x09-\\x0D]+``, numbered from 0, told apart by 64-bit
    hashes.  ``runs`` is an array of (start, length, period) by start, then
    period, of at least ``max(least, exponent * period)`` words.  The collapsed
    text has the words that are in no run or in the first period of each run that
    holds them, joined by one space.

    A NULL, empty or blank text has no words, no runs and an empty collapsed
    text.  Each row is judged by itself, so repeated rows, NULL keys and other
    columns change nothing; of a name in ``names`` that a kept column has, the new
    column gets underscores in front.  Texts of any length are read whole, in the
    task of their row.
    """
    keep = docs.columns if keep is None else keep
    fields = ("long", "array<struct<start:long,length:long,period:long>>", "string")
    narrow = docs.select(*[docs[f"`{c.replace('`', '``')}`"] for c in keep])
    free = [free_name(narrow, name) for name in names]
    return map_texts(docs, text, keep, list(zip(free, fields)), _job(least, exponent))
