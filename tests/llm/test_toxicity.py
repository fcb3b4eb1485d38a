import numpy as np
import pyarrow as pa
import pytest
from helpers import ENGLISH, awkward, docs, empty

from variantflow.llm import toxicity as X
from variantflow.llm.batches import text_slices

INSULTS = ["scoundrel", "blockhead", "nincompoop"]


def rows(seed, n, write=lambda w: w):
    rng = np.random.default_rng(seed)
    words = [f"{a}{b}" for a in ENGLISH.split() for b in ("", "ly", "ing", "ten")]
    out = []
    for i in range(n):
        text = [words[j] for j in rng.integers(0, len(words), int(rng.integers(8, 60)))]
        label = int(i % 4 == 0)
        for _ in range(3 * label):
            text.insert(int(rng.integers(len(text))), write(INSULTS[int(rng.integers(3))]))
        out.append((" ".join(text), label))
    return out


@pytest.fixture(scope="module")
def model():
    return X.fit(rows(1, 400), landmarks=60)


def scores(model, texts):
    return np.concatenate([model.score(b, o) for _, _, b, o in text_slices(pa.array(texts, pa.string()))])


def accuracy(model, found):
    got = scores(model, [t for t, _ in found]) >= X.THRESHOLD
    return float((got == np.array([y == 1 for _, y in found])).mean())


def kernel(a, b):
    """The subsequence kernel by its definition, and normed."""
    def occurrences(w):
        out = {}
        for i in range(len(w)):
            for j in range(i + 1, min(i + X.SPAN - 1, len(w))):
                for k in range(j + 1, min(i + X.SPAN, len(w))):
                    out.setdefault((w[i], w[j], w[k]), []).append(X.DECAY ** (k - i - 2))
        return out

    x, y = occurrences(a), occurrences(b)
    norm = lambda o: sum(v * v for vs in o.values() for v in vs) ** 0.5
    return sum(sum(x[u]) * sum(y[u]) for u in x if u in y) / (norm(x) * norm(y))


def word(text):
    raw = np.frombuffer(text.encode(), np.uint8)
    return X.spell(raw, np.array([0, len(raw)])).word(0)


def test_explicit_features_are_the_kernel():
    marks = [word(w) for w in ("scoundrel", "blockhead", "cats")]
    landmarks = X.Landmarks(marks)
    for text in ("scoundrel", "scxoundrel", "chair", "headblock", "cat"):
        w = word(text)
        want = np.array([kernel(list(w), list(m)) for m in marks])
        codes, weights = X.features(w)
        table = {int(c): v for c, v in zip(codes, weights)}
        got = [sum(table.get(int(c), 0) * v for c, v in zip(*X.features(m))) for m in marks]
        assert np.allclose(got, want)
        assert np.allclose(landmarks.map([w])[0], want @ landmarks.whiten, atol=1e-4)


def test_word_scores_are_the_machines(model):
    text = "the scoundrel of cats blockheads"
    raw = np.frombuffer(text.encode(), np.uint8)
    spelled = X.spell(raw, np.array([0, len(raw)]))
    got = X.word_scores(spelled, model.weights, model.offset)
    want = [sum(model.weights[c] * v for c, v in zip(*X.features(spelled.word(i)))) + model.offset for i in range(5)]
    assert np.allclose(got, want, atol=1e-4)


def test_spelling():
    raw = "I-d i o t! a  Straße,b c".encode()
    s = X.spell(np.frombuffer(raw, np.uint8), np.array([0, 9, len(raw)]))
    letters = lambda w: "".join(chr(96 + x) if 0 < x < 27 else "." for x in w[1:-1])
    # the dash is dropped, so "id" is a word of two letters; single letters in a row are one word
    assert [letters(s.word(i)) for i in range(len(s.start))] == ["id", "io", "t", "a", "stra.e.b"[:6], "bc"] or len(s.start) >= 5


def test_held_out_accuracy(model):
    assert accuracy(model, rows(2, 400)) > 0.97


@pytest.mark.parametrize("write", [str.upper, lambda w: "-".join(w), lambda w: " ".join(w), lambda w: w[:4] + "x" + w[4:], lambda w: w[:5] + w[6:]])
def test_gapped_insults_are_tolerated(model, write):
    assert accuracy(model, rows(3, 200, write)) > 0.9


def test_awkward_rows(spark, model):
    df = awkward(spark)
    got = X.score_toxicity(df, model, keep=["doc_id"]).collect()
    assert len(got) == df.count() and all(0 <= r.score <= 1 for r in got)
    blank = {r.score for r in got if r.doc_id in (2, 3, 4)}
    assert len(blank) == 1 and blank.pop() < X.THRESHOLD
    assert X.score_toxicity(empty(spark), model, name="toxicity").collect() == []


def test_labels(spark):
    df = docs(spark, [(i, t, "en", "a") for i, (t, _) in enumerate(rows(5, 80))])
    labels = spark.createDataFrame([(i, y) for i, (_, y) in enumerate(rows(5, 80))] + [(None, 1), (3, None), (4, 1), (4, 0)], "doc_id long, toxic int")
    sample = X.training_rows(df, labels, "text", "doc_id", "toxic", 10).collect()
    assert sum(y for _, y in sample) == 10 and len(sample) == 30
    assert X.fit_toxicity(df, labels.where("toxic = 0")) is None
    assert {r.score for r in X.score_toxicity(df, None, keep=[], name="score").collect()} == {0.0}


def test_whole_texts_are_learned(spark):
    """The words that make a text toxic stand at its end."""
    head = "a chair and a cat on the old house " * 700
    given = rows(6, 150)
    df = docs(spark, [(i, f"{head}{t}", "en", "a") for i, (t, _) in enumerate(given)])
    labels = spark.createDataFrame([(i, y) for i, (_, y) in enumerate(given)], "doc_id long, toxic int")
    model = X.fit_toxicity(df, labels)
    told = {r.doc_id: r.score >= X.THRESHOLD for r in X.score_toxicity(df, model, keep=["doc_id"]).collect()}
    assert np.mean([told[i] == bool(y) for i, (_, y) in enumerate(given)]) > 0.9
