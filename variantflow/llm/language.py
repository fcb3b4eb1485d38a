"""Language identification in two steps: the family first, then its languages.

The family of a text is chosen by linear support vector machines, one against the
others; inside a family with several languages each pair has a linear support
vector machine of its own, and the language with the most votes wins, by the sum
of its margins where votes are equal.  Features are the relative frequencies of
hashed runs of one to four bytes of the lower-cased text, with digits, signs and
white space as one blank, so a margin is the mean of a weight over all positions of the
text and needs one array pass over the whole of it.

The machines are fitted in one task from a bounded sample of labelled rows
(``sample`` for each language, taken by a hash of the text); their weights are a
fixed number of bytes whatever the corpus.
"""

from __future__ import annotations

import zlib
from collections import Counter
from dataclasses import astuple, dataclass
from itertools import combinations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from variantflow.llm.batches import fitted, map_texts, quoted, text_slices

UNKNOWN = "und"
#: features are hashed to so many bits
BITS = 13
ORDERS = (1, 2, 3, 4)
#: training rows of each language; their texts are learned whole
SAMPLE = 250
#: sizes of pieces of training texts from which short texts are learned too
SHORT_BYTES = (40, 200, 1000)

#: fixed values: families of languages by their ISO code; others are families of their own
FAMILIES = {
    "germanic": ("en", "de", "nl", "sv", "da", "no", "nb", "nn", "is", "af", "fy", "lb", "yi"),
    "romance": ("fr", "es", "it", "pt", "ro", "ca", "gl", "oc", "la", "eu"),
    "slavic": ("ru", "uk", "be", "bg", "mk", "sr", "hr", "bs", "sl", "cs", "sk", "pl"),
    "baltic": ("lt", "lv"),
    "uralic": ("fi", "et", "hu"),
    "turkic": ("tr", "az", "kk", "ky", "uz", "tk"),
    "indic": ("hi", "mr", "ne", "bn", "gu", "pa", "ur", "si"),
    "semitic": ("ar", "he", "am", "mt"),
    "malayic": ("id", "ms", "jv", "su", "tl"),
}
FAMILY_OF = {code: family for family, codes in FAMILIES.items() for code in codes}


def family(code: str) -> str:
    return FAMILY_OF.get(code.lower().replace("_", "-").split("-")[0], code)


def _folded() -> np.ndarray:
    """Bytes as they count: letters of ASCII in lower case, bytes of others, the rest blank."""
    table = np.arange(256, dtype=np.uint8)
    table[65:91] += 32
    keep = np.zeros(256, bool)
    keep[97:123] = keep[128:] = True
    table[~keep[table]] = 0x20
    return table


FOLDED = _folded()


def codes(buf: np.ndarray, order: int) -> np.ndarray:
    """Hashed codes of all runs of ``order`` bytes."""
    n = len(buf) - order + 1
    if n <= 0:
        return np.empty(0, np.int64)
    folded = FOLDED[buf].astype(np.uint32)
    value = folded[:n].copy()
    for i in range(1, order):
        value = (value << np.uint32(8)) | folded[i : n + i]
    value = (value ^ np.uint32(order * 0x1F3D5B79 & 0xFFFFFFFF)) * np.uint32(0x9E3779B1)
    return (value >> np.uint32(32 - BITS)).astype(np.int64)


def profile(text: bytes) -> np.ndarray:
    """Relative frequencies of all features of one text."""
    buf = np.frombuffer(text, np.uint8)
    out = np.zeros(1 << BITS, np.float32)
    for order in ORDERS:
        found = codes(buf, order)
        if len(found):
            out += np.bincount(found, minlength=1 << BITS).astype(np.float32) / len(found)
    return out


# --- linear support vector machines ------------------------------------------
def fit_svm(x: np.ndarray, y: np.ndarray, cost: float = 20.0, rounds: int = 20) -> tuple[np.ndarray, float]:
    """Weights and offset of a linear machine with squared hinge loss, by dual coordinate descent.

    ``y`` is +1 or -1; both classes weigh the same.
    """
    share = {s: len(y) / (2 * max(1, int((y == s).sum()))) for s in (1, -1)}
    upper = np.array([1 / (2 * cost * share[int(s)]) for s in y])
    norms = np.einsum("ij,ij->i", x, x) + 1 + upper
    alpha = np.zeros(len(y))
    w, b = np.zeros(x.shape[1]), 0.0
    order = np.random.default_rng(0)
    for _ in range(rounds):
        moved = 0.0
        for i in order.permutation(len(y)):
            step = max(alpha[i] - (y[i] * (x[i] @ w + b) - 1 + upper[i] * alpha[i]) / norms[i], 0.0) - alpha[i]
            if step:
                alpha[i] += step
                w += step * y[i] * x[i]
                b += step * y[i]
                moved = max(moved, abs(step))
        if moved < 1e-3 * max(1.0, alpha.max()):
            break
    return w, float(b)


def fit_sigmoid(margin: np.ndarray, y: np.ndarray, rounds: int = 50) -> tuple[float, float]:
    """Slope and offset of the probability of +1 given the margin (Platt), by Newton steps."""
    share = np.where(y > 0, len(y) / (2 * max(1, (y > 0).sum())), len(y) / (2 * max(1, (y < 0).sum())))
    goal = np.where(y > 0, 1 - 1e-3, 1e-3)
    a, b = 1.0, 0.0
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(a * margin + b, -40, 40)))
        g, h = share * (p - goal), share * np.maximum(p * (1 - p), 1e-6)
        grad = np.array([(g * margin).sum(), g.sum()]) + np.array([1e-3 * a, 0])
        hess = np.array([[(h * margin * margin).sum() + 1e-3, (h * margin).sum()], [(h * margin).sum(), h.sum() + 1e-6]])
        step = np.linalg.solve(hess, grad)
        a, b = a - step[0], b - step[1]
        if np.abs(step).max() < 1e-6:
            break
    return float(a), float(b)


@dataclass
class Machine:
    """One linear machine: positive margins speak for ``yes``."""

    yes: str
    no: str
    offset: float
    slope: float
    shift: float

    def probability(self, mean: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * (mean + self.offset) + self.shift, -40, 40)))


@dataclass
class Model:
    families: dict[str, list[str]]
    between: list[Machine]  # a family against all others
    within: list[Machine]  # two languages of a family
    weights: np.ndarray  # for each feature, one weight of each machine; between first

    def predict(self, means: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Language and score of texts from the mean weights of each machine."""
        names = list(self.families)
        n = len(means)
        if len(names) > 1:
            p = np.stack([m.probability(means[:, i]) for i, m in enumerate(self.between)], axis=1)
            if len(self.between) == 1:  # two families share one machine
                p = np.concatenate([p, 1 - p], axis=1)
            p /= np.maximum(p.sum(axis=1, keepdims=True), 1e-12)
        else:
            p = np.ones((n, len(names)))
        best = p.argmax(axis=1) if n else np.zeros(0, int)
        lang, score = np.empty(n, object), np.zeros(n)
        for f, name in enumerate(names):
            rows = np.flatnonzero(best == f)
            own, sure = self._inside(self.families[name], means[rows])
            lang[rows], score[rows] = own, sure * p[rows, f]
        return lang, score

    def _inside(self, languages: list[str], means: np.ndarray):
        votes = np.zeros((len(means), len(languages)))
        proof = np.zeros_like(votes)
        pairs = np.full((len(means), len(languages), len(languages)), 1.0)
        for i, m in enumerate(self.within, len(self.between)):
            if m.yes in languages:
                a, b = languages.index(m.yes), languages.index(m.no)
                p = m.probability(means[:, i])
                votes[:, a] += p >= 0.5
                votes[:, b] += p < 0.5
                proof[:, a] += p
                proof[:, b] += 1 - p
                pairs[:, a, b], pairs[:, b, a] = p, 1 - p
        best = (votes + proof / (2 * len(languages))).argmax(axis=1) if len(means) else np.zeros(0, int)
        # as sure as of the closest rival
        sure = pairs[np.arange(len(means)), best].min(axis=1) if len(means) else np.zeros(0)
        return np.array(languages, object)[best], sure


def _machine(x: np.ndarray, y: np.ndarray, yes: str, no: str) -> tuple[np.ndarray, Machine]:
    """Fit the machine on two thirds of the rows and its probabilities on the others."""
    # rows are mixed, so the first third is as good as any
    third = len(y) // 3
    if len(set(y[:third])) < 2 or len(set(y[third:])) < 2:
        third = 0
    w, b = fit_svm(x[third:], y[third:])
    slope, shift = fit_sigmoid(x[: third or None] @ w + b, y[: third or None])
    return w, Machine(yes, no, b, slope, shift)


def fit(rows: list[tuple[str, str]]) -> Model:
    """Model of (text, language) rows."""
    data: dict[str, list[np.ndarray]] = {}
    for i, (text, lang) in enumerate(rows):
        raw = text.encode()
        data.setdefault(lang, []).append(profile(raw))
        # short texts are learned from pieces of any place
        size = SHORT_BYTES[i % len(SHORT_BYTES)]
        start = zlib.crc32(raw) % max(1, len(raw) - size + 1)
        data[lang].append(profile(raw[start : start + size]))
    families: dict[str, list[str]] = {}
    for lang in sorted(data):
        families.setdefault(family(lang), []).append(lang)
    names = list(families)
    sets = data

    def against(left: list[str], right: list[str], yes: str, no: str):
        y = np.concatenate([np.ones(sum(len(sets[k]) for k in left)), -np.ones(sum(len(sets[k]) for k in right))])
        mixed = np.random.default_rng(1).permutation(len(y))
        x = np.empty((len(y), 1 << BITS), np.float32)  # mixed in place, so that there is one copy
        for place, row in zip(np.argsort(mixed).tolist(), (row for k in left + right for row in sets[k])):
            x[place] = row
        return _machine(x, y[mixed], yes, no)

    between, within = [], []
    for name in names if len(names) > 2 else names[:1] * (len(names) == 2):
        others = [k for f in names if f != name for k in families[f]]
        between.append(against(families[name], others, name, ""))
    for languages in families.values():
        within += [against([a], [b], a, b) for a, b in combinations(languages, 2)]
    machines = between + within
    weights = np.stack([w for w, _ in machines], axis=1) if machines else np.zeros((1 << BITS, 0))
    return Model(families, [m for _, m in between], [m for _, m in within], weights.astype(np.float32))


def mean_weights(weights: np.ndarray, buf: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """For each text of a slice and each machine, the mean weight over all features of the text."""
    out = np.zeros((len(offsets) - 1, weights.shape[1]))
    table = np.ascontiguousarray(weights.T)
    for order in ORDERS:
        found = codes(buf, order)
        first = np.minimum(offsets[:-1], len(found))
        last = np.maximum(np.minimum(offsets[1:] - order + 1, len(found)), first)
        count = np.maximum(last - first, 1)
        sums = np.zeros(len(found) + 1)
        for m in range(weights.shape[1]):
            np.cumsum(table[m][found], dtype=np.float64, out=sums[1:])
            out[:, m] += (sums[last] - sums[first]) / count
    return out


def training_rows(docs: DataFrame, text: str, lang: str, sample: int) -> DataFrame:
    """(text, lang, hash) of about three times ``sample`` labelled rows of each language, copies once."""
    usable = docs.where(F.col(quoted(lang)).isNotNull() & F.col(quoted(text)).rlike(r"\p{L}"))
    usable = usable.select(F.col(quoted(text)).alias("text"), F.col(quoted(lang)).alias("lang"))
    # copies count once, as they are taken once
    distinct = F.approx_count_distinct(F.xxhash64("text")).alias("n")
    counts = {r["lang"]: max(1, r["n"]) for r in usable.groupBy("lang").agg(distinct).collect()}
    if not counts:
        return usable.select("text", "lang", F.xxhash64("text").alias("h")).limit(0)
    # a hash of the text picks about three times as many rows as are needed, copies once
    parts = 1 << 31
    shares = [x for k, n in counts.items() for x in (F.lit(k), F.lit(min(parts, 3 * sample * parts // n)))]
    picked = usable.where(F.pmod(F.xxhash64("text"), F.lit(parts)) < F.create_map(*shares)[F.col("lang")])
    return picked.distinct().withColumn("h", F.xxhash64("text"))


def first_of_each(rows: list[tuple[str, str, int]], sample: int) -> list[tuple[str, str]]:
    """At most ``sample`` rows of each language in order of the hash, the same whatever the partitions."""
    out, taken = [], Counter()
    for text, lang, _ in sorted(rows, key=lambda r: (r[2], r[0], r[1])):
        taken[lang] += 1
        if taken[lang] <= sample:
            out.append((text, lang))
    return out


LETTER = r"\p{L}"


def _predict_job(held):
    def job():
        model = held.value

        def work(texts: pa.Array):
            lettered = pc.fill_null(pc.match_substring_regex(texts, LETTER), False)
            for _, _, buf, offsets in text_slices(texts, 1 << 62):
                lang, score = model.predict(mean_weights(model.weights, buf, offsets))
            none = pa.scalar(UNKNOWN)
            return [
                pc.if_else(lettered, pa.array(lang, pa.string()), none),
                pc.if_else(lettered, pa.array(score, pa.float64()), pa.scalar(0.0)),
            ]

        return work

    return job


def identify(docs: DataFrame, model: Model, text: str = "text", keep: list[str] | None = None,
             names: tuple[str, str] = ("lang_pred", "score")) -> DataFrame:
    """``docs`` with the predicted language of each whole text and a score from 0 to 1.

    NULL texts and texts without a letter are ``und`` with score 0, as is every
    text where the model knows no language.
    """
    keep = docs.columns if keep is None else keep
    fields = [(names[0], "string"), (names[1], "double")]
    if not model.families:
        blank = [F.lit(UNKNOWN).alias(names[0]), F.lit(0.0).alias(names[1])]
        return docs.select(*[docs[quoted(c)] for c in keep], *blank)
    held = docs.sparkSession.sparkContext.broadcast(model)
    return map_texts(docs, text, keep, fields, _predict_job(held))


def fit_languages(docs: DataFrame, text: str = "text", lang: str = "lang", sample: int = SAMPLE) -> Model:
    """The model of a table's labelled rows; rows without text or language teach nothing."""
    def values(rows):
        m = fit(first_of_each(rows, sample))
        return m.families, [astuple(x) for x in m.between], [astuple(x) for x in m.within], m.weights

    families, between, within, weights = fitted(training_rows(docs, text, lang, sample), values)
    return Model(families, [Machine(*x) for x in between], [Machine(*x) for x in within], weights)
