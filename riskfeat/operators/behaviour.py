"""First and last behaviour, activity calendar, and overlap between two logs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskfeat.functions.stats import Stat, stats_of
from riskfeat.operators.sessions import user_order
from riskfeat.roles import EventRoles

DAY_PARTS = (-1, 8, 12, 15, 23)
HOUR_SHARES = ((0, 6), (6, 12), (12, 18), (18, 24))
WEEKEND = (0, 6)


def first_last_behaviour(df: DataFrame, roles: EventRoles = EventRoles()) -> DataFrame:
    """First and last log of a user, and the time parts of the first and last transaction."""
    at = F.struct(*user_order(df, roles).columns)
    parts = {"days_diff": roles.days, "hour": roles.hour, "week": roles.week, "time": roles.timestamp}
    trans_at = F.when(F.col(roles.property) == "trans", at)
    trans_value = F.struct(*[F.col(c).alias(p) for p, c in parts.items()])
    ends = df.groupBy(roles.user).agg(
        F.max_by(F.col(roles.property), at).alias("last_behaviour"),
        F.min_by(F.col(roles.property), at).alias("first_behaviour"),
        F.max_by(trans_value, trans_at).alias("__last"),
        F.min_by(trans_value, trans_at).alias("__first"),
    )
    return ends.select(
        roles.user,
        "last_behaviour",
        "first_behaviour",
        *[F.col(f"__{end}")[p].alias(f"{end}_{p}_trans") for p in parts for end in ("last", "first")],
    )


def calendar_stats(roles: EventRoles = EventRoles(), day_parts: Sequence[int] = DAY_PARTS) -> list[Stat]:
    """Span of active days, rows per weekday and rows per part of the day.

    Both ends of a day part are open, so an hour on a bound belongs to none. A user
    without rows in a slot gets NULL there.
    """
    days, week, hour = F.col(roles.days), F.col(roles.week), F.col(roles.hour)
    weekdays = [Stat(f"week_{d}_cnt", "count", days, where=week == d, absent_is_null=True) for d in range(7)]
    parts = [
        Stat(f"time_period_{i}_cnt", "count", days, where=(hour > low) & (hour < high), absent_is_null=True)
        for i, (low, high) in enumerate(zip(day_parts, day_parts[1:]))
    ]
    return [Stat("early_day", "min", days), Stat("max_day", "max", days), *weekdays, *parts]


def hour_share_stats(roles: EventRoles = EventRoles(), ranges: Sequence[tuple[int, int]] = HOUR_SHARES) -> list[Stat]:
    """Share of a user's rows with ``start < hour <= end``."""
    hour = F.col(roles.hour)
    return [Stat(f"hour_{a}_{b}_ratio", "share", ((hour > a) & (hour <= b)).cast("int")) for a, b in ranges]


def weekend_share_stats(roles: EventRoles = EventRoles(), weekend: Sequence[int] = WEEKEND) -> list[Stat]:
    """Share of a user's rows on the weekend days."""
    return [Stat("weekend_ratio", "share", F.col(roles.week).isin(*weekend).cast("int"))]


def amount_range_stats(roles: EventRoles = EventRoles()) -> list[Stat]:
    return stats_of(roles.amount, ("max", "min"), "amount")


def resource_overlap(df: DataFrame, resource: str, roles: EventRoles = EventRoles()) -> DataFrame:
    """Whether a user ever used the same resource in both logs; NULLs never match.

    Counts per (user, resource) combine map-side, so no per-user set is collected.
    """
    tag = F.col(roles.property)
    pairs = df.groupBy(roles.user, resource).agg(
        F.max((tag == "trans").cast("int")).alias("__t"), F.max((tag == "op").cast("int")).alias("__o")
    )
    shared = (F.col("__t") + F.col("__o") == 2) & F.col(resource).isNotNull()
    return pairs.groupBy(roles.user).agg(F.max(shared.cast("int")).alias(f"if_{resource}_same"))
