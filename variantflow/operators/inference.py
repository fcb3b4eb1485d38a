"""Calls to a text service for every row, with retries and backoff.

A *client factory* is a function without arguments that runs once for each task
and returns a client: ``client(request, attempt) -> (status, body)``.
``request`` is a dict of the row's columns.  A transport failure is an
``OSError``; any other exception stops the job.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Iterable, Iterator, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from variantflow.schemas import INFERENCE_FIELDS

Client = Callable[[dict, int], tuple[int, str]]


@dataclass(frozen=True)
class RetryPolicy:
    """Tries for one call, the first delay (doubled each time) and the pause.

    ``pause_s`` follows each change of ``pause_by`` in a task, or each call
    where ``pause_by`` is None.  ``in_flight`` calls run at once in a task.
    """

    # --- fixed values: defaults -------------------------------------------
    max_tries: int = 5
    base_delay_s: float = 2.0
    pause_s: float = 1.0
    # --- end of fixed values ----------------------------------------------
    pause_by: str | None = "row_idx"
    in_flight: int = 1
    rows_at_once: int = 256


NO_PAUSE = RetryPolicy(pause_s=0.0)


@dataclass(frozen=True)
class Answer:
    reply: str | None
    attempts: int
    waited_s: float
    outcome: str


def ask(
    client: Client, request: dict, policy: RetryPolicy, sleep: Callable[[float], None]
) -> Answer:
    """One call: up to ``max_tries`` tries, each failure followed by its delay."""
    waited = 0.0
    for attempt in range(1, policy.max_tries + 1):
        try:
            status, body = client(request, attempt)
        except OSError:
            status, body = 0, None
        if status == 200:
            return Answer(body or "", attempt, waited, "ok" if body else "empty")
        delay = policy.base_delay_s * 2.0 ** (attempt - 1)
        sleep(delay)
        waited += delay
    return Answer(None, policy.max_tries, waited, "failed")


def infer(
    requests: DataFrame,
    client_factory: Callable[[], Client],
    *,
    text: str = "text",
    pass_no: int = 1,
    policy: RetryPolicy = RetryPolicy(),
    sends: Sequence[str] | None = None,
    carry: Sequence[str] = ("row_idx", "variant"),
    sleep: Callable[[float], None] = time.sleep,
) -> DataFrame:
    """``carry`` columns plus pass, reply, attempts, total_delay_s and outcome.

    Rows with a NULL ``text`` are not sent.  ``sends`` names the columns the
    client needs (all by default).  Filters on the result do not reach the
    calls: filter ``requests`` first.  Each action on the result repeats the
    calls: write it once (see :func:`variantflow.sources.scratch.written`).
    """
    conf = requests.sparkSession.conf
    if conf.get("spark.speculation", "false").lower() == "true":
        raise ValueError("spark.speculation would repeat service calls; turn it off")

    asked = list(sends) if sends else list(requests.columns)
    if policy.pause_by and policy.pause_by not in asked:
        asked.append(policy.pause_by)
    needed = list(dict.fromkeys([*carry, *asked, text]))
    kept = list(carry)
    schema = T.StructType([*[requests.schema[c] for c in kept], *INFERENCE_FIELDS])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        client = client_factory()
        pool = ThreadPoolExecutor(policy.in_flight) if policy.in_flight > 1 else None
        last = object()

        def paced(rows: list[dict]) -> Iterator[dict]:
            nonlocal last
            for row in rows:
                group = row[policy.pause_by] if policy.pause_by else object()
                if policy.pause_s > 0 and row[text] is not None and group != last:
                    sleep(policy.pause_s)
                    last = group
                yield row

        def answer(request: dict) -> Answer:
            if request[text] is None:
                return Answer(None, 0, 0.0, "null_input")
            return ask(client, {**request, "pass": pass_no}, policy, sleep)

        for batch in batches:
            for start in range(0, batch.num_rows, policy.rows_at_once):
                part = batch.slice(start, policy.rows_at_once)
                rows = part.select(list(dict.fromkeys([*asked, text]))).to_pylist()
                each = pool.map if pool else map
                answers = list(each(answer, paced(rows)))
                columns = [part.column(c) for c in kept]
                columns += [
                    pa.array([pass_no] * len(rows), pa.int32()),
                    pa.array([a.reply for a in answers], pa.string()),
                    pa.array([a.attempts for a in answers], pa.int32()),
                    pa.array([a.waited_s for a in answers], pa.float64()),
                    pa.array([a.outcome for a in answers], pa.string()),
                ]
                yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return requests.select(*needed).mapInArrow(run, schema)


def http_client(
    url: str, payload: str = "payload", timeout_s: float = 120.0
) -> Callable[[], Client]:
    """Factory of a client that posts the ``payload`` column as JSON to ``url``."""

    def connect() -> Client:
        import requests

        session = requests.Session()
        session.headers["Content-Type"] = "application/json"

        def post(request: dict, attempt: int) -> tuple[int, str]:
            reply = session.post(url, data=request[payload].encode("utf-8"), timeout=timeout_s)
            return reply.status_code, reply.text

        return post

    return connect
