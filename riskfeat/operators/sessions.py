"""Log union, gaps between rows, sessions and rates of change."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskfeat.functions.stats import ratio
from riskfeat.operators.ordered import Ordering, neighbour, per_key_ordered, running_sums
from riskfeat.roles import EventRoles

SESSION_GAP_SECONDS = 600
PROPERTY_RANK = "property_rank"


def union_logs(trans: DataFrame, op: DataFrame, common: list[str], roles: EventRoles = EventRoles()) -> DataFrame:
    """Both logs on their common columns, tagged by origin.

    ``property_rank`` keeps transactions before operations at equal timestamps.
    """
    tagged = [
        log.select(*common, F.lit(tag).alias(roles.property), F.lit(rank).alias(PROPERTY_RANK))
        for rank, (log, tag) in enumerate(((trans, "trans"), (op, "op")))
    ]
    return tagged[0].unionByName(tagged[1])


def user_order(df: DataFrame, roles: EventRoles = EventRoles()) -> Ordering:
    """A user's rows by time, transactions first at ties when the log is a union."""
    rank = [PROPERTY_RANK] if PROPERTY_RANK in df.columns else []
    return Ordering((roles.user,), roles.timestamp, (*rank, roles.seq))


def sessionize(
    df: DataFrame, roles: EventRoles = EventRoles(), gap: int = SESSION_GAP_SECONDS, hot_rows: int | None = None
) -> DataFrame:
    """Add the session ordinal (from 0): a gap of more than ``gap`` seconds starts a new one."""
    order = user_order(df, roles)

    def step(rows: DataFrame, chunked: bool) -> DataFrame:
        near = neighbour(rows, order, {"__previous": roles.timestamp}, chunked)
        starts = (F.col(roles.timestamp) - F.col("__previous") > gap).cast("int")
        return running_sums(near, order, {roles.session: starts}, chunked).drop("__previous")

    return per_key_ordered(df, order, step, hot_rows)


def change_to_next(
    df: DataFrame, columns: dict[str, str], roles: EventRoles = EventRoles(), hot_rows: int | None = None
) -> DataFrame:
    """Add ``{new: column}`` as this row's value minus the next row's value of the user."""
    order = user_order(df, roles)
    ahead = {f"__next_{new}": c for new, c in columns.items()}

    def step(rows: DataFrame, chunked: bool) -> DataFrame:
        near = neighbour(rows, order, ahead, chunked, ahead=True)
        kept = [c for c in near.columns if c not in ahead]
        return near.select(*kept, *[(F.col(c) - F.col(f"__next_{new}")).alias(new) for new, c in columns.items()])

    return per_key_ordered(df, order, step, hot_rows)


def amount_rate(df: DataFrame, roles: EventRoles = EventRoles(), hot_rows: int | None = None) -> DataFrame:
    """Add amount_diff, time_diff and amount_per_time; a zero time step counts as 0.01 s."""
    changed = change_to_next(df, {"amount_diff": roles.amount, "time_diff": roles.timestamp}, roles, hot_rows)
    step = F.when(F.col("time_diff") == 0, F.lit(0.01)).otherwise(F.col("time_diff").cast("double"))
    return changed.withColumn("amount_per_time", F.col("amount_diff").cast("double") / step)


def session_gap_mean(sessions: DataFrame, roles: EventRoles = EventRoles()) -> DataFrame:
    """Mean time between session ends, counted from time 0.

    The gaps telescope, so this is the last timestamp over the number of sessions.
    """
    last = F.max(roles.timestamp)
    n = F.max(roles.session) + 1
    return sessions.groupBy(roles.user).agg(ratio(last, n).alias("session_time_delta"))


def session_counts(sessions: DataFrame, roles: EventRoles = EventRoles()) -> DataFrame:
    """Whether a user has transactions, and in how many sessions each log appears.

    Sessions are reduced to one row each first, which needs no distinct count.
    """
    tag = F.col(roles.property)
    per_session = sessions.groupBy(roles.user, roles.session).agg(
        F.max((tag == "trans").cast("int")).alias("__t"), F.max((tag == "op").cast("int")).alias("__o")
    )
    return per_session.groupBy(roles.user).agg(
        F.max("__t").alias("has_trans"), F.sum("__t").alias("trans_count"), F.sum("__o").alias("op_count")
    )


def session_summary(sessions: DataFrame, roles: EventRoles = EventRoles()) -> DataFrame:
    """Start, end and number of rows of every session."""
    return sessions.groupBy(roles.user, roles.session).agg(
        F.min(roles.timestamp).alias("session_start"),
        F.max(roles.timestamp).alias("session_end"),
        F.count(F.lit(1)).alias("n_rows"),
    )
