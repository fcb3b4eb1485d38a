"""Stage 1: rewrite every text in every variant."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence
from dataclasses import dataclass, replace
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from variantflow.functions.text import prompt_template, request_payload_json
from variantflow.operators.inference import Client, RetryPolicy, infer
from variantflow.operators.keyed import once_each, pending, text_id, unfinished, unfinished_pairs
from variantflow.operators.replies import dead_letter
from variantflow.operators.variants import assemble_wide
from variantflow.schemas import VARIANTS
from variantflow.sources.scratch import TEXTS, new_folder, written
from variantflow.streaming.progress import logged

CARRIED = ("row_idx", "variant", "original_text")


@dataclass(frozen=True)
class Rewritten:
    """Written results of both passes."""

    first: DataFrame
    second: DataFrame

    @property
    def attempts(self) -> DataFrame:
        """Every call, including those that a second one replaced."""
        return self.first.unionByName(self.second)

    @property
    def final(self) -> DataFrame:
        """One row for each (row, variant).

        The second pass holds exactly the keys without a reply in the first, so
        the two parts are disjoint and need no shuffle to be merged.
        """
        settled = self.first.filter(F.col("outcome") != "failed")
        return settled.unionByName(self.second)

    @property
    def state(self) -> DataFrame:
        """Accepted replies.  The outcome tells them without reading the texts."""
        return self.final.filter(F.col("outcome") == "ok")

    @property
    def dead(self) -> DataFrame:
        """What is still without a reply."""
        return dead_letter(self.final)

    def wide(self) -> DataFrame:
        """One row for each row key and text with a column for each variant."""
        return assemble_wide(self.state, ["row_idx", "text_id"]).drop("text_id")


def requests_of(work: DataFrame) -> DataFrame:
    """Add the JSON payload; ``work`` has row_idx, variant and original_text."""
    prompt = prompt_template(F.col("original_text"), F.col("variant"))
    return work.withColumn("payload", request_payload_json(prompt))


def call_service(
    work: DataFrame,
    client_factory: Callable[[], Client],
    *,
    pass_no: int = 1,
    policy: RetryPolicy = RetryPolicy(),
    sends: Sequence[str] | None = None,
    **options,
) -> DataFrame:
    """Results of one pass over a work list (lazy).  The text rides along."""
    return infer(
        requests_of(work),
        client_factory,
        text="original_text",
        pass_no=pass_no,
        policy=policy,
        sends=sends or (*CARRIED, "payload"),
        carry=CARRIED,
        **options,
    )


def retry_pass(
    first: DataFrame,
    client_factory: Callable[[], Client],
    *,
    policy: RetryPolicy = RetryPolicy(),
    spread_to: int | None = None,
    **options,
) -> DataFrame:
    """Call the service again for the failed rows of a written first pass (lazy).

    ``spread_to`` deals them out to so many tasks, unless ``first`` is read in as many
    already, as one that was dealt out is.  They are dealt by key and text: the failed
    variants of a text stay together, and its copies take little room.
    """
    failed = first.filter(F.col("outcome") == "failed").select(*CARRIED)
    # of files only: this plans a scan and runs nothing
    if spread_to and first.rdd.getNumPartitions() < spread_to:
        failed = failed.repartition(spread_to, "row_idx", "original_text")
    each_call = replace(policy, pause_by=None)
    return call_service(failed, client_factory, pass_no=2, policy=each_call, **options)


def rewrite(
    source: DataFrame,
    client_factory: Callable[[], Client],
    *,
    key: str = "row_idx",
    text: str = "description",
    variants: Sequence[str] = VARIANTS,
    state: DataFrame | None = None,
    redo: bool = False,
    spread_to: int | None = None,
    log: str | None = None,
    slice_rows: int | None = None,
    policy: RetryPolicy = RetryPolicy(),
    **options,
) -> Rewritten:
    """Both passes, each written once: to the ``log`` or to the scratch folder.

    ``spread_to`` deals the rows of both passes out to so many tasks, before they
    are fanned out.  Pairs that ``state`` holds are not called again.

    A row is told by its key and its text, so rows that share a key, or have
    none, get replies of their own; rows that share both are called once.

    With ``slice_rows`` the work list is written first and called in slices of
    about so many rows.  A slice is in the log as soon as it ends: a run that
    stops loses the calls of its open slice only, and one that starts again with
    the log's state takes up the rest.
    """
    rows = source.select(F.col(key).alias("row_idx"), F.col(text).alias("original_text"))
    rows = once_each(rows)
    calls = {"policy": policy, **options}
    run = f"{log.rstrip('/')}/run={uuid.uuid4().hex[:12]}" if log else new_folder(source.sparkSession, "rewrite")

    def once(results: DataFrame, name: str) -> DataFrame:
        return written(logged(results), path=f"{run}/batch={name}", **TEXTS)

    if not slice_rows:
        work = pending(rows, state, variants=variants, redo=redo, spread_to=spread_to)
        first = once(call_service(work, client_factory, **calls), "1")
        second = once(retry_pass(first, client_factory, spread_to=spread_to, **calls), "2")
        return Rewritten(first, second)

    todo = unfinished(rows, None if redo else state, variants=variants)
    parts = work_slices(todo, -(-source.count() // slice_rows))
    spread = spread_to or source.sparkSession.sparkContext.defaultParallelism
    first = [
        once(call_service(unfinished_pairs(part.repartition(spread), variants), client_factory, **calls), f"1-{i}")
        for i, part in enumerate(parts)
    ]
    second = [
        once(retry_pass(part, client_factory, spread_to=spread_to, **calls), f"2-{i}") for i, part in enumerate(first)
    ]
    return Rewritten(reduce(DataFrame.unionByName, first), reduce(DataFrame.unionByName, second))


def work_slices(todo: DataFrame, slices: int) -> list[DataFrame]:
    """The rows of a work list, written once and dealt by key and text into slices of about equal size."""
    spark = todo.sparkSession
    slices = max(1, slices)
    number = F.pmod(F.xxhash64("row_idx", text_id(F.col("original_text"))), F.lit(slices))
    dealt = todo.withColumn("slice", number)
    # a slice is written by one task, as it has a bounded number of rows
    tasks = max(1, min(slices, int(spark.conf.get("spark.sql.shuffle.partitions"))))
    folder = new_folder(spark, "work-list")
    dealt.repartition(tasks, "slice").write.partitionBy("slice").parquet(folder)
    found = spark.read.schema(dealt.schema).parquet(folder)
    return [found.where(F.col("slice") == i).drop("slice") for i in range(slices)]
