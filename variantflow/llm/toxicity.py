"""Toxicity by a subsequence-kernel support vector machine on words.

A word is compared with others by the subsequences of three symbols that both
have, gaps included: an occurrence that spans s symbols counts ``DECAY ** (s - 3)``,
up to a span of ``SPAN``.  Inserted or left-out characters therefore cost a part
of the likeness only.  Punctuation and digits are dropped before, and single
letters in a row are one word, so ``i-d-i-o-t`` and ``i d i o t`` are both read.

The machine sees words through their kernel values with landmark words (Nyström).
As the kernel has an explicit, finite feature space, the fitted decision function
is one weight for each subsequence; scoring a text is then a few array passes
over its symbols, whatever the number of landmarks.

Labels belong to documents, not to words.  The first fit weighs each word by how
often it occurs in documents of either label; later ones take only the words of
a toxic document that scored highest as toxic.  A logistic function of the
highest word scores gives the score of a document.  It is fitted on a third
of the sample, from which the words were not learned.

The sample of labelled rows that is fitted in one task is bounded by
``sample`` toxic rows and twice as many others, with their whole texts.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from variantflow.llm.batches import cut_words, fitted, map_texts, quoted, separators, text_slices

SPAN = 5
DECAY = 0.6
LANDMARKS = 300
SAMPLE = 1000
TRAIN_WORDS = 15_000
ROUNDS = 3
#: word scores of a document that its score is made of
TOP = 8
#: word scores beyond these tell no more; a disguised word reaches the upper one as a plain one does
CLIP = (-1.0, 0.75)
THRESHOLD = 0.7

#: gaps of the three symbols: offsets of the second and third
OFFSETS = [(a, b) for b in range(2, SPAN) for a in range(1, b)]
EDGE = 0  # the symbol between words


def _symbols() -> np.ndarray:
    """Bytes to 6-bit symbols; 0 between words, 64 to drop."""
    table = np.full(256, 64, np.uint8)
    table[65:91] = table[97:123] = np.arange(1, 27)
    table[128:192] = 32 + np.arange(64) % 32  # the last bytes of other letters
    for blank in (*range(9, 14), 32):
        table[blank] = EDGE
    return table


SYMBOLS = _symbols()
BLANKS = separators((0, 0))


@dataclass
class Spelled:
    """Words of consecutive texts as symbols, with an edge before and after each word."""

    symbols: np.ndarray
    start: np.ndarray  # of each word, its first edge
    end: np.ndarray  # its last edge
    first: np.ndarray  # words of text d: first[d] to first[d + 1]

    def word(self, i: int) -> bytes:
        return self.symbols[self.start[i] : self.end[i] + 1].tobytes()


def spell(buf: np.ndarray, offsets: np.ndarray) -> Spelled:
    """The words of a slice of texts."""
    symbols = SYMBOLS[buf]
    keep = symbols < 64
    bounds = np.concatenate([np.zeros(1, np.int64), np.cumsum(keep)])[offsets]
    words = cut_words(symbols[keep], bounds, BLANKS)
    # the next letter joins a single letter if it is single too
    single = words.end - words.start == 1
    joined = np.zeros(len(single), bool)
    if len(single):
        joined[1:] = single[1:] & single[:-1]
        joined[words.first[:-1][words.first[:-1] < len(single)]] = False
    heads = np.flatnonzero(~joined)
    sizes = np.add.reduceat(words.end - words.start, heads) if len(heads) else np.zeros(0, np.int64)
    ends = np.cumsum(sizes + 1)
    out = np.zeros(int(ends[-1]) + 1 if len(ends) else 1, np.uint8)
    inside = np.ones(len(out), bool)
    inside[0] = False
    inside[ends] = False
    out[inside] = words.buf[np.flatnonzero(words.buf != EDGE)]
    return Spelled(out, ends - sizes - 1, ends, np.searchsorted(heads, words.first))


def occurrences(symbols: np.ndarray):
    """For each gap pattern: its weight, codes of the subsequences, and which lie in one word."""
    n = len(symbols)
    edges = np.cumsum(symbols == EDGE)
    wide = symbols.astype(np.int32)
    for a, b in OFFSETS:
        if n > b:
            code = (wide[: n - b] << 12) | (wide[a : n - b + a] << 6) | wide[b:]
            yield DECAY ** (b - 2), code, edges[b - 1 : n - 1] == edges[: n - b]


def norms(longest: int) -> np.ndarray:
    """Square root of the summed squared weights of a word, by its symbols with edges."""
    size = np.arange(longest + 1)
    total = sum(DECAY ** (2 * (b - 2)) * np.maximum(size - b, 0) for _, b in OFFSETS)
    return np.sqrt(np.maximum(total, 1e-12))


def word_scores(spelled: Spelled, weights: np.ndarray, offset: float) -> np.ndarray:
    """Decision value of each word; words too short for a subsequence have the offset."""
    if not len(spelled.start):
        return np.empty(0, np.float64)
    value = np.zeros(len(spelled.symbols), np.float32)
    for weight, code, within in occurrences(spelled.symbols):
        value[: len(code)] += np.float32(weight) * weights[code] * within
    sums = np.add.reduceat(value, spelled.start)
    size = spelled.end - spelled.start + 1
    return sums / norms(int(size.max()))[size] + offset


# --- training ---------------------------------------------------------------
@lru_cache(maxsize=4 * TRAIN_WORDS)
def features(word: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Subsequences of a word (with its edges) and their normed weights."""
    symbols = np.frombuffer(word, np.uint8)
    found = [(code[within], weight) for weight, code, within in occurrences(symbols)]
    codes = np.concatenate([c for c, _ in found]) if found else np.empty(0, np.int32)
    weights = np.concatenate([np.full(len(c), w) for c, w in found]) if found else np.empty(0)
    codes, place = np.unique(codes, return_inverse=True)
    return codes, np.bincount(place, weights, len(codes)) / norms(len(symbols))[len(symbols)]


class Landmarks:
    """Nyström map of words to their kernel values with the landmarks, whitened."""

    def __init__(self, words: list[bytes]):
        found = [features(w) for w in words]
        self.codes = np.unique(np.concatenate([c for c, _ in found]))
        self.table = np.zeros((len(self.codes) + 1, len(words)), np.float32)
        for j, (codes, weights) in enumerate(found):
            self.table[np.searchsorted(self.codes, codes), j] = weights
        values, vectors = np.linalg.eigh(self.table.T.astype(np.float64) @ self.table)
        good = values > 1e-6 * max(values.max(), 1e-12)
        self.whiten = vectors[:, good] / np.sqrt(values[good])

    def map(self, words: list[bytes], block: int = 1000) -> np.ndarray:
        out = np.zeros((len(words), self.whiten.shape[1]), np.float32)
        for start in range(0, len(words), block):
            found = [features(w) for w in words[start : start + block]]
            sizes = [len(c) for c, _ in found]
            codes = np.concatenate([c for c, _ in found])
            at = np.minimum(np.searchsorted(self.codes, codes), len(self.codes) - 1)
            at = np.where(self.codes[at] == codes, at, len(self.codes))  # the last row is zero
            rows = self.table[at] * np.concatenate([w for _, w in found])[:, None].astype(np.float32)
            kernel = np.add.reduceat(rows, np.cumsum([0] + sizes[:-1]))
            out[start : start + block] = kernel @ self.whiten
        return out

    def weights(self, w: np.ndarray) -> np.ndarray:
        """The decision function as one weight for each subsequence."""
        out = np.zeros(1 << 18, np.float32)
        out[self.codes] = self.table[:-1] @ (self.whiten @ w)
        return out


def fit_weighted(x: np.ndarray, yes: np.ndarray, no: np.ndarray, penalty: float, rounds: int = 25):
    """Linear machine with squared hinge loss, by Newton steps.

    Every row speaks for the positive class with weight ``yes`` and for the other
    with weight ``no``.  Returns weights and offset.
    """
    x = np.hstack([x, np.ones((len(x), 1), x.dtype)])
    w = np.zeros(x.shape[1])
    ridge = penalty * np.eye(x.shape[1])
    ridge[-1, -1] = 1e-6
    for _ in range(rounds):
        margin = x @ w.astype(x.dtype)
        pull = yes * np.maximum(1 - margin, 0) - no * np.maximum(1 + margin, 0)
        share = (yes * (margin < 1) + no * (margin > -1)).astype(x.dtype)
        used = np.flatnonzero(share)
        hess = (x[used] * share[used, None]).T @ x[used]
        step = np.linalg.solve(ridge + hess.astype(np.float64), ridge @ w - x.T @ pull.astype(x.dtype))
        w = w - step
        if np.abs(step).max() < 1e-4:
            break
    return w[:-1], float(w[-1])


def fit_logistic(x: np.ndarray, y: np.ndarray, share: np.ndarray, penalty: float = 0.02, rounds: int = 50):
    x = np.hstack([x, np.ones((len(x), 1))])
    w = np.zeros(x.shape[1])
    ridge = penalty * np.eye(x.shape[1])
    ridge[-1, -1] = 1e-6
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -40, 40)))
        grad = ridge @ w + x.T @ (share * (p - y))
        hess = ridge + (x * (share * np.maximum(p * (1 - p), 1e-6))[:, None]).T @ x
        step = np.linalg.solve(hess, grad)
        w = w - step
        if np.abs(step).max() < 1e-6:
            break
    return w


@dataclass
class Model:
    weights: np.ndarray  # of subsequences
    offset: float
    judge: np.ndarray  # of the highest word scores of a document

    def document_features(self, scores: np.ndarray, first: np.ndarray) -> np.ndarray:
        """The highest word scores of each document, how many are positive, and its length."""
        out = np.zeros((len(first) - 1, TOP + 3))
        for d, (a, b) in enumerate(zip(first[:-1].tolist(), first[1:].tolist())):
            own = scores[a:b]
            if b - a > TOP:
                own = np.partition(own, b - a - TOP)[-TOP:]
            top = np.full(TOP, -1.0)
            top[: len(own)] = np.clip(np.sort(own)[::-1], *CLIP)
            positive = float((scores[a:b] > 0).sum())
            out[d, :TOP] = top
            out[d, TOP:] = np.log1p(positive), np.log1p(b - a) / 4, 10 * positive / max(b - a, 20)
        return out

    def features(self, buf: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        spelled = spell(buf, offsets)
        return self.document_features(word_scores(spelled, self.weights, self.offset), spelled.first)

    def score(self, buf: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        found = self.features(buf, offsets)
        margin = found @ self.judge[:-1] + self.judge[-1]
        return 1 / (1 + np.exp(-np.clip(margin, -40, 40)))


def _slices(texts: list[str]):
    for _, _, buf, offsets in text_slices(pa.array(texts, pa.string())):
        yield buf, offsets


def _word_sets(texts: list[str]) -> Iterator[set[bytes]]:
    """The words of three symbols or more of each text."""
    for buf, offsets in _slices(texts):
        s = spell(buf, offsets)
        for a, b in zip(s.first[:-1].tolist(), s.first[1:].tolist()):
            yield {w for w in (s.word(i) for i in range(a, b)) if len(w) > 4}


def _fit_words(texts: list[str], toxic: np.ndarray, landmarks: int) -> tuple[np.ndarray, float]:
    names: dict[bytes, bytes] = {}  # a word that many documents have is held once
    sets = [{names.setdefault(w, w) for w in found} for found in _word_sets(texts)]
    n_toxic, n_clean = max(1, int(toxic.sum())), max(1, int((~toxic).sum()))
    in_toxic = Counter(w for s, t in zip(sets, toxic) if t for w in s)
    in_clean = Counter(w for s, t in zip(sets, toxic) if not t for w in s)
    lift = {w: n / n_toxic - in_clean[w] / n_clean for w, n in in_toxic.items()}
    suspects = sorted(lift, key=lambda w: (-lift[w], w))
    usual = sorted(in_clean, key=lambda w: (-in_clean[w], w))
    words = list(dict.fromkeys(suspects[: TRAIN_WORDS // 2] + usual[:TRAIN_WORDS]))[:TRAIN_WORDS]
    marks = list(dict.fromkeys(suspects[: landmarks // 2] + usual[: landmarks // 2]))
    nystrom = Landmarks(marks)
    x = nystrom.map(words)
    place = {w: i for i, w in enumerate(words)}
    no = np.array([in_clean[w] / n_clean for w in words])
    yes = np.array([in_toxic[w] / n_toxic for w in words])
    for turn in range(ROUNDS):
        w, b = fit_weighted(x, yes * 50 / max(yes.sum(), 1e-9), no * 100 / max(no.sum(), 1e-9), 0.05)
        score = x @ w + b
        if turn + 1 < ROUNDS:
            yes = np.zeros(len(words))
            for found, t in zip(sets, toxic):
                if t:
                    own = sorted((i for i in map(place.get, found) if i is not None), key=lambda i: -score[i])
                    for i in own[:3]:
                        yes[i] += 1 / n_toxic
    return nystrom.weights(w), b


def fit(rows: list[tuple[str, int]], landmarks: int = LANDMARKS) -> Model | None:
    """Model of (text, label) rows; None where a label is missing."""
    texts = [t for t, _ in rows]
    toxic = np.array([label == 1 for _, label in rows], bool)
    if toxic.all() or not toxic.any():
        return None
    third = np.zeros(len(rows), bool)
    for label in (True, False):
        own = np.flatnonzero(toxic == label)
        third[own[::3]] = len(own) > 2
    held = third if third.any() else ~third
    try:
        weights, offset = _fit_words([t for t, h in zip(texts, third) if not h], toxic[~third], landmarks)
    finally:
        features.cache_clear()
    model = Model(weights, offset, np.zeros(TOP + 4))
    x = [model.features(buf, offsets) for buf, offsets in _slices([t for t, h in zip(texts, held) if h])]
    # an empty document has no toxic word
    x.append(model.document_features(np.empty(0), np.array([0, 0])))
    x, y = np.concatenate(x), np.append(toxic[held].astype(float), 0.0)
    model.judge = fit_logistic(x, y, np.ones(len(y)))
    return model


def training_rows(
    docs: DataFrame, labels: DataFrame, text: str, key: str, label: str, sample: int
) -> DataFrame:
    """(text, label) of at most ``sample`` toxic and twice as many other rows, by a hash of the key; a key with both labels is toxic."""
    known = labels.where(F.col(quoted(key)).isNotNull() & F.col(quoted(label)).isin(0, 1))
    known = known.groupBy(F.col(quoted(key)).alias("key")).agg(F.max(quoted(label)).alias("label"))
    order = [F.xxhash64("key"), "key"]
    few = known.where("label = 1").orderBy(*order).limit(sample)
    few = few.unionByName(known.where("label = 0").orderBy(*order).limit(2 * sample))
    texts = docs.select(F.col(quoted(key)).alias("key"), F.col(quoted(text)).alias("text")).where("text IS NOT NULL")
    # at most 3 * sample keys
    rows = texts.join(F.broadcast(few), "key").groupBy("key")
    return rows.agg(F.min("text").alias("text"), F.max("label").alias("label")).select("text", "label")


def fit_toxicity(
    docs: DataFrame, labels: DataFrame, text: str = "text", key: str = "doc_id", label: str = "toxic",
    sample: int = SAMPLE,
) -> Model | None:
    """Model of the labelled rows of ``docs``; None if they have not both labels."""
    def values(rows):
        m = fit(sorted(rows))
        return m and (m.weights, m.offset, m.judge)

    found = fitted(training_rows(docs, labels, text, key, label, sample), values)
    return found and Model(*found)


def _score_job(held):
    def job():
        model = held.value

        def work(texts: pa.Array):
            for _, _, buf, offsets in text_slices(texts, 1 << 62):
                return [pa.array(model.score(buf, offsets), pa.float64())]

        return work

    return job


def score_toxicity(
    docs: DataFrame, model: Model | None, text: str = "text", keep: list[str] | None = None, name: str = "score"
) -> DataFrame:
    """``docs`` with the toxicity of each whole text, from 0 to 1.

    NULL and empty texts get the score of a text without words; without a model
    every score is 0.
    """
    keep = docs.columns if keep is None else keep
    if model is None:
        return docs.select(*[docs[quoted(c)] for c in keep], F.lit(0.0).alias(name))
    held = docs.sparkSession.sparkContext.broadcast(model)
    return map_texts(docs, text, keep, [(name, "double")], _score_job(held))
