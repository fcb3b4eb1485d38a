import numpy as np
import pytest
from helpers import ENGLISH, FRENCH, GERMAN, SPANISH, awkward, docs, empty
from pyspark.sql import functions as F

from variantflow.llm import language as L

TEXTS = {"en": ENGLISH, "de": GERMAN, "fr": FRENCH, "es": SPANISH}


def rows(seed, n):
    rng = np.random.default_rng(seed)
    out = []
    for lang, text in TEXTS.items():
        words = text.split()
        out += [(" ".join(words[i] for i in rng.integers(0, len(words), int(rng.integers(4, 40)))), lang) for _ in range(n)]
    return out


@pytest.fixture(scope="module")
def model():
    return L.fit(rows(1, 60))


def test_families_first_then_pairs(model):
    assert model.families == {"germanic": ["de", "en"], "romance": ["es", "fr"]}
    assert len(model.between) == 1 and [(m.yes, m.no) for m in model.within] == [("de", "en"), ("es", "fr")]


def test_held_out_accuracy(spark, model):
    df = spark.createDataFrame(rows(2, 50), "text string, lang string")
    got = L.identify(df, model)
    assert got.columns == ["text", "lang", "lang_pred", "score"]
    right = got.agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int")), F.min("score"), F.max("score")).first()
    assert right[0] > 0.97 and right[1] >= 0 and right[2] <= 1


def test_mean_weights_equal_profiles(model):
    texts = [ENGLISH, "", "ab", "é", GERMAN.upper()]
    raw = [t.encode() for t in texts]
    offsets = np.cumsum([0] + [len(r) for r in raw])
    got = L.mean_weights(model.weights, np.frombuffer(b"".join(raw), np.uint8), offsets)
    want = np.stack([L.profile(r) @ model.weights for r in raw])
    assert np.allclose(got, want, atol=1e-4)


def test_awkward_rows(spark, model):
    df = awkward(spark)
    got = L.identify(df, model, keep=["doc_id"], names=("lang_pred", "score")).collect()
    assert len(got) == df.count()
    known = {r.doc_id: (r.lang_pred, r.score) for r in got}
    assert all(known[k] == ("und", 0.0) for k in (2, 3, 4, 5))
    assert known[8][0] == "de" and known[10][0] == "es" and known[14][0] != "und"
    names = ("guess", "sure")
    assert L.identify(df, model, names=names).columns == [*df.columns, *names]
    assert L.identify(empty(spark), model, names=names).collect() == []


def test_few_or_no_labels(spark):
    none = L.fit_languages(empty(spark))
    assert {(r.a, r.b) for r in L.identify(awkward(spark), none, keep=[], names=("a", "b")).collect()} == {("und", 0.0)}
    one = L.fit([(ENGLISH, "en"), (ENGLISH + " more", "en")])
    assert L.identify(docs(spark, [(1, GERMAN, None, None)]), one, keep=[]).first().lang_pred == "en"
    three = L.fit([(t, k) for k, t in (("en", ENGLISH), ("fr", FRENCH), ("ru", "кошка дома на старом стуле и дети в саду")) for _ in range(9)])
    got = L.identify(docs(spark, [(1, "кошка и дети", None, None), (2, ENGLISH, None, None)]), three, keep=["doc_id"]).collect()
    assert {r.doc_id: r.lang_pred for r in got} == {1: "ru", 2: "en"}


def test_the_sample_does_not_hang_on_partitions(spark):
    df = docs(spark, [(i, f"{t} {i % 7}", k, "a") for i in range(40) for k, t in TEXTS.items()])
    a, b = (L.first_of_each([tuple(r) for r in L.training_rows(df.repartition(n), "text", "lang", 5).collect()], 5) for n in (1, 7))
    assert a == b and len(a) == 20


def test_whole_texts_are_learned(spark):
    """What tells the language stands after a long beginning that all have in common."""
    rng = np.random.default_rng(3)
    shared = " ".join(str(i) for i in rng.integers(0, 10**6, 900))
    given = [(i, f"{shared} {text * 200}", lang, "a") for i, (text, lang) in enumerate(rows(4, 12))]
    model = L.fit_languages(docs(spark, given))
    ends = spark.createDataFrame(rows(5, 30), "text string, lang string")
    got = L.identify(ends, model).agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int"))).first()[0]
    assert got > 0.9
