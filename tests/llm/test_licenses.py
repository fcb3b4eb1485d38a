import numpy as np
import pytest
from helpers import ENGLISH, GERMAN, awkward, docs, empty

from variantflow.llm import licenses as L

PLAIN = [" ".join(np.random.default_rng(i).permutation((ENGLISH + " " + GERMAN).split())[: 5 + i % 30]) for i in range(300)]


@pytest.fixture(scope="module")
def model():
    return L.fit(PLAIN)


def found(model, text):
    words = L._paragraph_words([text])
    return [(c, round(p, 3)) for _, c, p in model.predict(words)]


def test_every_template_is_its_family(model):
    for family, templates in L.TEMPLATES.items():
        for text in templates:
            assert [c for c, _ in found(model, text)] == [family], text


def test_notices_worded_differently(model):
    for family, text in (
        ("mit", "This code is released under the MIT License."),
        ("apache-2.0", "LICENSED UNDER THE APACHE LICENSE, VERSION 2.0"),
        ("cc-by-nc", "The text is licensed under CC BY-NC 4.0"),
        ("gpl", "Work licensed under the GNU General Public License, version 3"),
        ("proprietary", "Copyright 2020 - all rights reserved."),
    ):
        assert [c for c, _ in found(model, text)] == [family], text


def test_plain_text_is_left_alone(model):
    rng = np.random.default_rng(1)
    words = ENGLISH.split()
    texts = [" ".join(words[i] for i in rng.integers(0, len(words), 20)) for _ in range(200)]
    assert sum(bool(found(model, t)) for t in texts) == 0


def test_licences_of_no_known_family_are_unknown(model):
    for text in ("Licensed under the Eclipse Public License.", "Released under the Artistic License 2.0."):
        assert [c for c, _ in found(model, text)] == ["unknown"]


def test_scan(spark, model):
    text = "First line.\n\nReleased under the MIT License.\nmore\nLicensed under CC BY-NC 4.0."
    got = L.scan_licenses(docs(spark, [(1, text, None, None), (2, ENGLISH, None, None)]), model, keep=["doc_id"]).collect()
    by = {r.doc_id: r for r in got}
    assert by[1].n_paragraphs == 4 and {x.paragraph: x.family for x in by[1].licensed} == {2: "mit", 4: "cc-by-nc"}
    assert by[1].license in ("mit", "cc-by-nc") and by[1].score >= L.LEAST_PROBABILITY
    assert (by[2].license, by[2].score, by[2].licensed) == ("none", 0.0, [])


def test_awkward_rows(spark):
    df = awkward(spark)
    model = L.fit_licenses(df)
    got = L.scan_licenses(df, model, keep=["doc_id"]).collect()
    assert len(got) == df.count() and {r.license for r in got} == {"none"}
    assert L.scan_licenses(empty(spark), L.fit_licenses(empty(spark)), keep=[]).collect() == []


def test_the_filter_of_paragraphs_loses_none(model):
    """All paragraphs, also those that only the sum of many classes tells from plain text."""
    rng = np.random.default_rng(2)
    pool = " ".join(t for ts in L.TEMPLATES.values() for t in ts).split() + ENGLISH.split() * 3
    texts = [" ".join(pool[i] for i in rng.integers(0, len(pool), int(rng.integers(1, 9)))) for _ in range(1500)]
    words = L._paragraph_words(texts)
    got = {p for p, _, _ in model.predict(words)}
    want = set()
    for i, features in enumerate(L._features(texts)):
        at = np.minimum(np.searchsorted(model.known, features), len(model.known) - 1)
        at = at[model.known[at] == features]
        if len(at):
            logits = model.weights[at].sum(axis=0) + model.offset
            if 1 - model._probabilities(logits[None, :])[0][0] >= L.LEAST_PROBABILITY:
                want.add(i)
    assert got == want and len(want) > 20


def test_long_lines_are_learned_whole(spark):
    """A word that stands far behind in plain lines is one of plain text."""
    head = "x " * 400
    lines = [f"{head}permission is granted by hand {i}" for i in range(60)]
    model = L.fit_licenses(docs(spark, [(i, t, None, None) for i, t in enumerate(PLAIN + lines)]))
    assert found(model, head + "permission is granted by hand") == []
