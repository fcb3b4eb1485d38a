"""Main text of web pages by the maximum-scoring subsequence.

A page is a row of tags and words.  A word scores by the elements it stands in, a
tag has a cost, and one scan finds the contiguous run of the page whose sum is
highest.  The words of that run whose own score is positive are the text, so a
short advert or menu inside the run goes too.

Scores are weights of a logistic regression on the names and class words of the
elements around a word, learned from labelled pages.  Pages with an ``article`` or
``main`` element carry their label themselves: its words are content, all others
are not.  Those two elements are never features, so the weights hold for pages that
mark nothing.  Names that usually hold no article text (menus, forms, adverts, reader
comments and the like) are no rule but a prior: their weights start low, and labelled
pages move them like any other.  At most ``sample`` labelled pages are looked at.
"""

from __future__ import annotations

import html
import math
import re
from collections import Counter
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from variantflow.llm.batches import fitted_to_sample, map_texts, quoted

SAMPLE = 500
#: bounds of a word's score; the cost of a tag is kept below half the least positive one, and words that
#: are cut out anyway are a small reason to end the text before them
WORD_RANGE = (-0.2, 2.0)
TAG_COST = (0.05, 0.4)
#: prior of the weights: mean of a word without features, mean of a name that is seldom article text,
#: and how far data move such a name, and any other
USUAL, SELDOM = 1.0, -8.0
SELDOM_SPREAD, SPREAD = 4.0, 0.5
#: steps of the fit
STEPS = 300

TOKEN = re.compile(
    r"<!--.*?(?:-->|$)|<[!?][^>]*>|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>", re.S
)
ATTRIBUTE = re.compile(r"(?:^|\s)(class|id|role|hidden|aria-hidden)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?", re.I)
NAME = re.compile(r"[a-z]+")

#: fixed values: elements of the HTML standard
RAW = frozenset("script style noscript template iframe svg math object canvas textarea title xmp noframes".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q rp rt ruby s samp "
    "small span strike strong sub sup time tt u var wbr".split()
)
CLOSES_P = frozenset(
    "address article aside blockquote details div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header "
    "hr main menu nav ol p pre section table ul".split()
)
CLOSED_BY_SAME = frozenset("li dt dd tr td th option p thead tbody tfoot".split())
BOILERPLATE = frozenset("head nav footer aside form button select dialog menu fieldset".split()) | RAW
#: words in class, id or role of elements that are not article text
NOT_TEXT = frozenset(
    "ad ads adv advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments consent "
    "cookie cookies disqus footer gdpr login masthead menu modal nav navbar navigation newsletter notice notices "
    "pagination popup promo promoted recommended related replies respond share sharing sidebar signup social sponsor "
    "sponsored subscribe toolbar widget complementary contentinfo search alert dialog".split()
)
CONTENT = ("article", "main")
#: containers that tell nothing by their name
GENERIC = frozenset(("html", "body", "div", "span", *CONTENT))
HIDDEN = "(hidden)"
#: means of the weights before any page is seen
PRIOR = {name: SELDOM for name in (*sorted(BOILERPLATE), "header", HIDDEN, *(f".{w}" for w in sorted(NOT_TEXT)))}


@dataclass
class Segment:
    """Words between two tags, or a tag without words."""

    text: str  # "" for a tag
    words: int
    features: tuple[str, ...]
    block: int
    own: int  # how many features those of article or main around it are; -1 outside


@dataclass
class Open:
    name: str
    features: tuple[str, ...]
    own: int


def _names(attributes: str) -> tuple[set[str], bool]:
    """Words of class, id and role; whether the element is hidden."""
    words: set[str] = set()
    hidden = False
    for name, *values in ATTRIBUTE.findall(attributes):
        value = "".join(values).lower()
        if name.lower() in ("hidden", "aria-hidden"):
            hidden |= value != "false"
        else:
            words.update(NAME.findall(value))
    return words, hidden


def segments(page: str) -> list[Segment]:
    """The tags and texts of a page in order."""
    out: list[Segment] = []
    stack = [Open("", (), -1)]
    block = at = 0
    end = len(page)

    def say(text: str) -> None:
        text = html.unescape(text)
        words = len(text.split())
        top = stack[-1]
        if text:
            out.append(Segment(text, words, top.features, block, top.own))

    while at < end:
        found = TOKEN.search(page, at)
        if not found:
            say(page[at:])
            break
        say(page[at : found.start()])
        at = found.end()
        name = (found[2] or "").lower()
        if not name:
            continue
        if name not in INLINE:
            block += 1
        if found[1]:
            depth = next((i for i in range(len(stack) - 1, 0, -1) if stack[i].name == name), 0)
            if depth:
                del stack[depth:]
            out.append(Segment("", 0, (f"/{name}",), block, stack[-1].own))
            continue
        if name in CLOSES_P or name in CLOSED_BY_SAME:
            for i in range(len(stack) - 1, 0, -1):
                if stack[i].name == name and name in CLOSED_BY_SAME or stack[i].name == "p" and name in CLOSES_P:
                    del stack[i:]
                    break
                if stack[i].name not in INLINE and stack[i].name != "p":
                    break
        top = stack[-1]
        out.append(Segment("", 0, (name,), block, top.own))
        if name in VOID:
            continue
        if name in RAW:
            close = re.compile(rf"</{re.escape(name)}\b[^>]*>", re.I).search(page, at)
            at = close.end() if close else end
            continue
        words, hidden = _names(found[3] or "")
        told = [f".{w}" for w in sorted(words)] if name not in ("html", "body") else []
        if hidden:
            told.append(HIDDEN)
        if name not in GENERIC:
            # the header of an article is another thing than that of a page
            told.insert(0, "article header" if name == "header" and top.own >= 0 else name)
        features = tuple(dict.fromkeys((*top.features, *told)))
        stack.append(Open(name, features, len(features) if top.own < 0 and name in CONTENT else top.own))
    return out


@dataclass
class Weights:
    """Weights of the features that words stand in, and costs of tags."""

    features: dict[str, float] = field(default_factory=lambda: dict(PRIOR))
    tags: dict[str, float] = field(default_factory=dict)
    usual: float = USUAL

    def word(self, features: tuple[str, ...]) -> float:
        """Log-odds that a word in these elements is content."""
        return self.usual + sum(self.features.get(f, 0.0) for f in features)

    def score(self, s: Segment) -> float:
        if not s.text:
            return -self.tags.get(s.features[0], sum(TAG_COST) / 2)
        if not s.words:
            return 0.0
        total = min(max(self.word(s.features), WORD_RANGE[0]), WORD_RANGE[1])
        # a word of a kind that is seen in content is worth more than the tags around it
        return s.words * (max(total, 2 * TAG_COST[1] + 0.1) if total > 0 else total)


def learn(pages: list[str], prior: dict[str, float] | None = None) -> Weights:
    """Weights from pages that mark their content; other pages teach nothing, and without any the prior is left.

    A page counts once for each set of features that its words stand in, so that
    long pages do not outweigh others.  A word in an element of low prior inside
    the marked one is labelled as no content; the marked one may have any name.
    """
    prior = PRIOR if prior is None else prior
    words: dict[tuple[str, ...], list[int]] = {}
    tags = {True: Counter(), False: Counter()}
    for page in pages:
        parts = segments(page)
        if all(s.own < 0 for s in parts):
            continue
        seen = set()
        for s in parts:
            if s.words:
                seen.add((s.features, s.own >= 0 and not any(prior.get(f, 0.0) < 0 for f in s.features[s.own :])))
            elif not s.text:
                tags[s.own >= 0][s.features[0]] += 1
        for features, content in seen:
            words.setdefault(features, [0, 0])[content] += 1
    if not words:
        return Weights(dict(prior))
    usual, found = fit(words, prior)
    costs = {}
    for f in sorted(set(tags[True]) | set(tags[False])):
        # the less a tag is one of content, the more it costs
        odds = math.log((tags[True][f] + 1) / (tags[False][f] + 1))
        costs[f] = TAG_COST[0] + (TAG_COST[1] - TAG_COST[0]) / (1 + math.exp(odds))
    return Weights({**prior, **found}, costs, usual)


def fit(words: dict[tuple[str, ...], list[int]], prior: dict[str, float]) -> tuple[float, dict[str, float]]:
    """The likeliest intercept and weights, given counts (other, content) of sets of features and a normal prior.

    Accelerated gradient steps, each weight's step bounded by its own curvature, so no step size is chosen.
    """
    sets = sorted(words)
    names = sorted({f for features in sets for f in features})
    place = {f: i + 1 for i, f in enumerate(names)}
    mean = np.array([USUAL, *(prior.get(f, 0.0) for f in names)])
    stiff = np.array([SPREAD, *(SELDOM_SPREAD if f in prior else SPREAD for f in names)]) ** -2.0
    # the intercept is a feature of every set
    row = np.array([i for i, features in enumerate(sets) for _ in range(len(features) + 1)])
    column = np.array([j for features in sets for j in (0, *(place[f] for f in features))])
    counts = np.array([words[features] for features in sets], float)
    total, size = counts.sum(axis=1), np.bincount(row)
    curve = stiff + np.bincount(column, (total * size)[row] / 4, len(mean))
    weights, ahead, pace = mean.copy(), mean.copy(), 1.0
    for _ in range(STEPS):
        odds = np.bincount(row, ahead[column], len(sets))
        missed = counts[:, 1] - total / (1 + np.exp(-odds))
        slope = np.bincount(column, missed[row], len(mean)) - stiff * (ahead - mean)
        after = ahead + slope / curve
        faster = (1 + math.sqrt(1 + 4 * pace * pace)) / 2
        ahead = after + (pace - 1) / faster * (after - weights)
        weights, pace = after, faster
    return float(weights[0]), {f: float(weights[i]) for f, i in place.items()}


def best_run(scores: list[float]) -> tuple[int, int]:
    """Half-open range with the highest sum, the first and longest of equals; (0, 0) if none is positive."""
    best = total = 0.0
    start = 0
    out = (0, 0)
    for i, score in enumerate(scores):
        if total <= 0:
            total, start = 0.0, i
        total += score
        if total > best or total == best and start == out[0] and best > 0:
            best, out = total, (start, i + 1)
    return out


def main_text(page: str | None, weights: Weights) -> str:
    """Content of the best run in blocks, each with single blanks, in page order, joined by two line ends."""
    if not page:
        return ""
    parts = segments(page)
    start, end = best_run([weights.score(s) for s in parts])
    blocks: dict[int, list[str]] = {}
    for s in parts[start:end]:
        # another inline tag without text is no blank, a line break is one
        if s.text and weights.word(s.features) > 0:
            blocks.setdefault(s.block, []).append(s.text)
        elif not s.text and s.features[0] == "br":
            blocks.setdefault(s.block, []).append(" ")
    joined = (" ".join("".join(found).split()) for _, found in sorted(blocks.items()))
    return "\n\n".join(x for x in joined if x)


def _extract_job(held):
    def job():
        weights = held.value

        def work(pages: pa.Array):
            texts = [main_text(p, weights) for p in pages.to_pylist()]
            return [pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())]

        return work

    return job


def learn_weights(pages: DataFrame, page: str = "html", sample: int = SAMPLE) -> Weights:
    """Weights from at most ``sample`` pages that mark their content, by a hash of the page."""
    marked = pages.where(F.col(quoted(page)).rlike("(?i)<(article|main)[\\s>]"))

    def values(found):
        w = learn(found)
        return w.features, w.tags, w.usual

    return Weights(*fitted_to_sample(marked.select(F.col(quoted(page)).alias("page")), "page", sample, values))


def extract(
    pages: DataFrame, weights: Weights, page: str = "html", keep: list[str] | None = None,
    names: tuple[str, str] = ("text", "n_chars"),
) -> DataFrame:
    """``pages`` with the main text of each whole page and its length in code points.

    NULL and empty pages, and pages without a run of positive score, have an empty
    text.  Unclosed elements end with their parent or the page.
    """
    keep = pages.columns if keep is None else keep
    held = pages.sparkSession.sparkContext.broadcast(weights)
    return map_texts(pages, page, keep, [(names[0], "string"), (names[1], "bigint")], _extract_job(held))
