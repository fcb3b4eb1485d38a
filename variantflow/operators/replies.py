"""Sorting service responses and replies into kept, empty and failed."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from variantflow.schemas import DEAD_LETTER_SCHEMA


def classify_response(status: Column, error: Column) -> Column:
    """``ok``, ``retry`` or ``fatal`` for one response.

    ``error`` is NULL for an answered request, ``request`` for a transport
    failure and anything else for a fault that must not be retried.
    """
    return (
        F.when(error == "request", "retry")
        .when(error.isNotNull(), "fatal")
        .when(status == 200, "ok")
        .otherwise("retry")
    )


def reply_outcome(text: Column, reply: Column) -> Column:
    """Outcome of a finished call: see :data:`variantflow.schemas.OUTCOMES`."""
    return (
        F.when(text.isNull(), "null_input")
        .when(reply.isNull(), "failed")
        .when(reply == "", "empty")
        .otherwise("ok")
    )


def accept_reply(df: DataFrame, reply: str = "reply") -> DataFrame:
    """Rows whose reply is neither NULL nor empty; blanks count as text."""
    return df.filter(F.col(reply).isNotNull() & (F.col(reply) != ""))


def dead_letter(df: DataFrame, reply: str = "reply") -> DataFrame:
    """Rows without any reply, with the reason.  Empty replies are not included."""
    reason = F.when(F.col("original_text").isNull(), "null_input").otherwise("no_reply")
    return (
        df.filter(F.col(reply).isNull())
        .withColumn("reason", reason)
        .select(*DEAD_LETTER_SCHEMA.fieldNames())
    )
