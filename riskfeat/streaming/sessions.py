"""The session and amount operators over a stream of events."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskfeat.functions.stats import ratio
from riskfeat.operators.sessions import SESSION_GAP_SECONDS


def streaming_sessions(
    events: DataFrame, time: str, user: str, lateness: str = "1 hour", gap: int = SESSION_GAP_SECONDS
) -> DataFrame:
    """Start, end and rows of every session once the watermark has passed it.

    A gap of exactly ``gap`` seconds does not split, as in the batch operator.
    """
    window = F.session_window(F.col(time), f"{gap} seconds")
    sessions = events.withWatermark(time, lateness).groupBy(F.col(user), window)
    return sessions.agg(
        F.min(time).alias("session_start"), F.max(time).alias("session_end"), F.count(F.lit(1)).alias("n_rows")
    ).select(user, "session_start", "session_end", "n_rows")


def streaming_amounts(events: DataFrame, user: str, amount: str) -> DataFrame:
    """Running amount statistics per user, for an output mode of "update" or "complete"."""
    x = F.col(amount)
    return events.groupBy(user).agg(
        F.count(x).alias("amount_count"),
        F.sum(x).alias("amount_sum"),
        ratio(F.sum(x), F.count(x)).alias("amount_mean"),
        F.max(x).alias("amount_max"),
        F.min(x).alias("amount_min"),
    )
