import numpy as np
from helpers import CLASH, awkward

import corpus_pipeline as P
from variantflow.llm import toxicity
from variantflow.llm.queries import QUERIES
from variantflow.sources.scratch import written

SF = "/root/testdata/sf0.001"


def test_stages_decide_and_keep_columns(spark, monkeypatch):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, kept = docs.columns, docs
    names = [name for name, _ in P.STAGES]
    assert names == ["toxicity", "language_id", "jaccard_join", "decontamination", "packing"]
    for name, stage in P.STAGES[:-1]:
        result = written(stage(spark, kept, SF), name)
        assert result.columns == columns
        assert result.join(kept, "doc_id", "left_anti").isEmpty() and result.count() <= kept.count()
        kept = result
    last = P.STAGES[-1][1](spark, kept, SF)
    assert {r.doc_id for r in last.select("doc_id").collect()} == {r.doc_id for r in kept.select("doc_id").collect()}
    assert P.ORACLE_SQL is None and len(QUERIES) == 13


def test_stages_take_awkward_rows(spark, monkeypatch):
    # labels that teach nothing: every score is 0
    monkeypatch.setattr(toxicity, "fit_toxicity", lambda *a, **k: None)
    docs = written(awkward(spark), "awkward")
    for name, stage in P.STAGES[:-1]:
        docs = written(stage(spark, docs, SF), name)
        assert docs.columns[-len(CLASH):] == CLASH
    keys = {r.doc_id for r in docs.collect()}
    assert {8, 10} <= keys and not keys & {2, 3, 4, 5, 13}
    pieces = P.STAGES[-1][1](spark, docs, SF).collect()
    assert {r.doc_id for r in pieces} == keys
    assert all(len(np.frombuffer(r.ids, "<u4")) == r.length for r in pieces)


def test_stages_take_empty_tables(spark, monkeypatch):
    docs = awkward(spark).limit(0)
    for name, stage in P.STAGES:
        docs = written(stage(spark, docs, SF), name)
        assert docs.count() == 0
