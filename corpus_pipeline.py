"""From raw documents to packed training sequences, in five stages.

Every stage works on all that its predecessor kept, and its decisions take
effect.  All stages but the last return the columns of their documents.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from variantflow.llm import language, toxicity
from variantflow.llm.batches import fold, free_name, quoted
from variantflow.llm.decontamination import contaminated, n_hit, scan_benchmark
from variantflow.llm.jaccard_join import one_of_each
from variantflow.llm.packing import pack
from variantflow.llm.queries import LANGUAGE_FOLD, TOXICITY_FOLD, table
from variantflow.sources.scratch import written

#: rows of texts that go to a Python worker at once, where the session sets no number of its own
BATCH_ROWS = 1000
_BATCH_SETTING = "spark.sql.execution.arrow.maxRecordsPerBatch"
#: documents whose language is less sure than this go
LEAST_LANGUAGE_SCORE = 0.3

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score below the threshold of toxicity."""
    labels = table(spark, sf_dir, "labels")
    model = toxicity.fit_toxicity(docs, labels.where(~fold("doc_id", *TOXICITY_FOLD)))
    score = free_name(docs, "toxicity")
    found = toxicity.score_toxicity(docs, model, name=score)
    return found.where(F.col(score) < toxicity.THRESHOLD).drop(score)


def keep_known_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is known; texts without a letter have none."""
    model = language.fit_languages(docs.where(~fold("doc_id", *LANGUAGE_FOLD)))
    names = free_name(docs, "lang_pred"), free_name(docs, "lang_score")
    found = language.identify(docs, model, names=names)
    known = (F.col(names[0]) != language.UNKNOWN) & (F.col(names[1]) >= LEAST_LANGUAGE_SCORE)
    return found.where(known).drop(*names)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that shingles of five words link at a similarity of 0.8."""
    return one_of_each(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which less than a twentieth, or nothing, is benchmark text."""
    name = free_name(docs, "benchmark_found")
    found = scan_benchmark(docs, table(spark, sf_dir, "benchmark"), name=name)
    bad = contaminated(n_hit(name), F.col(quoted(name))["n_words"])
    return found.where(~bad).drop(name)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents with their ids and their place in sequences."""
    return pack(docs)


def in_small_batches(stage: Stage) -> Stage:
    """The stage, with batches that keep memory outside of Spark's heap small.

    A plan takes the setting when it runs, after the stage has returned, so it stays with the session.
    """

    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        if int(spark.conf.get(_BATCH_SETTING)) == 10_000:  # Spark's default
            spark.conf.set(_BATCH_SETTING, BATCH_ROWS)
        return stage(spark, docs, sf_dir)

    run_stage.__doc__ = stage.__doc__
    return run_stage


STAGES: list[tuple[str, Stage]] = [
    (name, in_small_batches(stage))
    for name, stage in (
        ("toxicity", drop_toxic),
        ("language_id", keep_known_languages),
        ("jaccard_join", drop_near_duplicates),
        ("decontamination", drop_contaminated),
        ("packing", pack_sequences),
    )
]

#: trained classifiers and a tokenizer decide, which SQL can't express
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on the documents of ``sf_dir``; each result is written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
