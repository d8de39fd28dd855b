"""Splitting landed responses into usable, retryable and failed ones."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clipledger.functions import scalars as S

# Outcomes, and the status codes no retry can cure.
OK, TERMINAL, TRANSIENT = "ok", "terminal", "transient"
TERMINAL_STATUS = (401, 402, 403)


def route_responses(responses: DataFrame) -> DataFrame:
    """Adds ``route`` and ``message``; ``payload`` is filled for usable responses only.

    A blank body of a successful response is an empty object. Every status that is neither
    success nor terminal, a missing one included, is retryable. A landed line that could not be read is a failure.
    """
    body, status = F.col("body"), F.col("http_status")
    parsed = responses.withColumn(
        "payload", F.coalesce(F.col("payload"), F.try_parse_json(body))
    )
    payload = F.col("payload")
    blank = payload.isNull() & (F.coalesce(S.strip(body), F.lit("")) == "")
    success = F.coalesce(status == 200, F.lit(False))
    unread, reason = F.lit(False), F.lit(None).cast("string")
    if "broken" in responses.columns:
        unread, reason = F.col("broken").isNotNull(), F.col("broken.reason")
    route = (
        F.when(unread, TERMINAL)
        .when(success & (blank | payload.isNotNull()), OK)
        .when(success | status.isin(*TERMINAL_STATUS), TERMINAL)
        .otherwise(TRANSIENT)
    )
    message = (
        F.when(unread, F.concat(F.lit("broken line: "), reason))
        .when(F.col("route") == OK, None)
        .when(success, "bad JSON")
        .otherwise(S.error_message(body, payload))
    )
    return (
        parsed.withColumn("route", route)
        .withColumn("message", message)
        .withColumn(
            "payload",
            F.when(F.col("route") == OK, F.coalesce(payload, F.parse_json(F.lit("{}")))),
        )
    )


def usable(routed: DataFrame) -> DataFrame:
    """Usable responses only.

    Kept by an explode of at most one element: a filter on ``route`` would be pushed below the
    projection that parses the body, and every body would be parsed twice.
    """
    kept = F.when(F.col("route") == OK, F.array("payload"))
    others = [name for name in routed.columns if name != "payload"]
    return routed.select(*others, F.explode(kept).alias("payload"))


def quarantine(routed: DataFrame) -> DataFrame:
    """Failed and retryable responses, without their bodies, which may hold raw handles."""
    return routed.where(F.col("route") != OK).drop("body", "payload")
