"""How common, how long-lived and how shared the values are that a user touches.

Event tables are first reduced to distinct (user, column, value) rows with counts, so
the joins on a value see one row per user and value, not one per event.
"""

from __future__ import annotations

from collections.abc import Sequence
from itertools import combinations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskfeat.functions.scalars import composite_key
from riskfeat.functions.stats import Stat, stats_of
from riskfeat.operators.grouping import grouped_stats, stats_by_column, unpivot
from riskfeat.operators.skew import UNKNOWN, Hot, all_present, find_hot, lookup_join, none_hot
from riskfeat.roles import EventRoles
from riskfeat.session import reliable_checkpoint

ROWS = "n_rows"


def user_values(df: DataFrame, columns: Sequence[str], roles: EventRoles = EventRoles()) -> DataFrame:
    """Distinct (user, column, value) with the number of rows behind each."""
    long = unpivot(df, [roles.user], columns).where(F.col("value").isNotNull() & F.col(roles.user).isNotNull())
    return long.groupBy(roles.user, "column", "value").agg(F.count(F.lit(1)).alias(ROWS))


def value_popularity(pairs: DataFrame) -> DataFrame:
    """Distinct users per (column, value), from distinct pairs."""
    return pairs.groupBy("column", "value").agg(F.count(F.lit(1)).alias("user_nuniq"))


def attach_by_value(
    df: DataFrame, fitted: DataFrame, columns: Sequence[str], named: dict[str, str], hot_rows: int | None = None
) -> DataFrame:
    """Add, per column, figures of the row's value from a table (column, value, …, __rows).

    ``named`` maps a figure to its output name, with ``{}`` for the column. The table is
    checkpointed: it serves every column, and is computed in one pass over the data.
    """
    fitted = reliable_checkpoint(fitted)
    for c in columns:
        figures = [F.col(figure).alias(name.format(c)) for figure, name in named.items()]
        of_column = fitted.where(F.col("column") == c).select(F.col("value").alias("__value"), *figures, "__rows")
        keyed = df.withColumn("__value", F.col(c).cast("string"))
        df = lookup_join(keyed, of_column, ["__value"], "__rows", hot_rows).drop("__value", "__rows")
    return df


def with_popularity(
    df: DataFrame, columns: Sequence[str], prefix: str, roles: EventRoles = EventRoles(), hot_rows: int | None = None
) -> DataFrame:
    """Add to every event row the number of distinct users of its value, per column."""
    popularity = user_values(df, columns, roles).groupBy("column", "value").agg(
        F.count(F.lit(1)).alias("user_nuniq"), F.sum(ROWS).alias("__rows")
    )
    return attach_by_value(df, popularity, columns, {"user_nuniq": f"{prefix}_{{}}_user_nuniq"}, hot_rows)


def popularity_user_stats(
    df: DataFrame,
    columns: Sequence[str],
    kinds: Sequence[str],
    prefix: str,
    roles: EventRoles = EventRoles(),
    hot_rows: int | None = None,
) -> DataFrame:
    """Per user, statistics of the popularity of the values on the user's rows."""
    pairs = user_values(df, columns, roles)
    popular = lookup_join(pairs, value_popularity(pairs), ["column", "value"], "user_nuniq", hot_rows)
    stats = [Stat(k, k, F.col("user_nuniq"), weight=F.col(ROWS)) for k in kinds]
    names = {c: f"{prefix}_{c}_user_nuniq_" for c in columns}
    return stats_by_column(popular, roles.user, names, stats, hot_rows, _hot_users(df, stats, roles, hot_rows))


def _hot_users(df: DataFrame, stats: Sequence[Stat], roles: EventRoles, hot_rows: int | None) -> Hot:
    """Hot users, counted on the plain events, when a statistic needs to know them."""
    needed = any(s.quantile is not None for s in stats)
    return find_hot(df, [roles.user], hot_rows) if needed else UNKNOWN


def frequency_encode(
    df: DataFrame, columns: Sequence[str], user: str, hot_rows: int | None = None
) -> DataFrame:
    """Add ``{column}_count``: how many rows share the row's value (NULL for a NULL value)."""
    long = unpivot(df, [user], columns).where(F.col("value").isNotNull())
    counts = long.groupBy("column", "value").agg(F.count(user).alias("__count"), F.count(F.lit(1)).alias("__rows"))
    return attach_by_value(df, counts, columns, {"__count": "{}_count"}, hot_rows)


def group_amount_to_rows(
    df: DataFrame,
    columns: Sequence[str],
    kinds: Sequence[str] = ("mean", "std"),
    roles: EventRoles = EventRoles(),
    hot_rows: int | None = None,
) -> DataFrame:
    """Add to every row the statistics of the amount over all rows with the same value."""
    long = unpivot(df, [roles.amount], columns)
    named = [Stat(k, k, F.col(roles.amount)) for k in kinds]
    stats = grouped_stats(long, ["column", "value"], [*named, Stat("__rows", "count", F.lit(1))], hot_rows)
    return attach_by_value(df, stats, columns, {k: f"amount_to_{k}_{{}}" for k in kinds}, hot_rows)


def amount_deviation(
    df: DataFrame,
    columns: Sequence[str],
    kinds: Sequence[str],
    roles: EventRoles = EventRoles(),
    hot_rows: int | None = None,
) -> DataFrame:
    """Per user, statistics of (mean amount of the row's value minus the row's amount)."""
    rows = group_amount_to_rows(df, columns, ("mean",), roles, hot_rows)
    stats = [
        s
        for c in columns
        for s in stats_of(
            F.col(f"amount_to_mean_{c}") - F.col(roles.amount).cast("double"), kinds, f"{c}_amt_sub_rt"
        )
    ]
    return grouped_stats(rows, [roles.user], stats, hot_rows, _hot_users(df, stats, roles, hot_rows))


def mode_frequency(df: DataFrame, keys: Sequence[str], column: str, name: str) -> DataFrame:
    """How often the most common non-null value of a column occurs in each group."""
    counts = df.groupBy(*keys, column).agg(F.count(F.col(column)).alias("__n"))
    top = F.max(F.when(F.col(column).isNotNull(), F.col("__n")))
    present = counts.where(all_present(keys))
    return present.groupBy(*keys).agg(top.alias(name))


def value_lifespan(df: DataFrame, columns: Sequence[str], prefix: str, roles: EventRoles = EventRoles()) -> DataFrame:
    """Per value (or combination of values): distinct users, first, last and range of days."""
    name = "_".join(columns)
    pairs = (
        df.where(all_present(columns))
        .groupBy(*columns, roles.user)
        .agg(F.min(roles.days).alias("__first"), F.max(roles.days).alias("__last"))
    )
    first, last = F.min("__first"), F.max("__last")
    return pairs.groupBy(*columns).agg(
        F.count(roles.user).alias(f"{prefix}_cnt_user_{name}"),
        first.alias(f"{prefix}_early_day_{name}"),
        last.alias(f"{prefix}_later_day_{name}"),
        (last - first).alias(f"{prefix}_range_day_{name}"),
    )


MEASURES = ("cnt_user", "early_day", "later_day", "range_day")


def _days_used(long: DataFrame, roles: EventRoles) -> DataFrame:
    """Per (column, value, user): the first and the last day."""
    return long.groupBy("column", "value", roles.user).agg(F.min("__day").alias("__first"), F.max("__day").alias("__last"))


def _lifespan() -> dict[str, Column]:
    """The measures of a value, as aggregates over its users."""
    first, last = F.min("__first"), F.max("__last")
    return dict(zip(MEASURES, (F.count(F.lit(1)), first, last, last - first), strict=True))


def _lifespans_beside(used: DataFrame, roles: EventRoles) -> DataFrame:
    """The measures of its value beside every row; a value's rows are bounded, as it is not hot."""
    of_value = Window.partitionBy("column", "value")
    first, last = F.min("__first").over(of_value), F.max("__last").over(of_value)
    measured = used.select(
        "column", roles.user, F.count(F.lit(1)).over(of_value).alias("cnt_user"), first.alias("early_day"), last.alias("later_day")
    )
    return measured.withColumn("range_day", F.col("later_day") - F.col("early_day"))


def shared_resource_stats(
    df: DataFrame,
    resources: Sequence[str],
    roles: EventRoles = EventRoles(),
    pairs_of: bool = False,
    hot_rows: int | None = None,
) -> DataFrame:
    """Per user and resource: max, min, mean and skew of the lifespan measures of its values.

    ``pairs_of`` looks at every pair of resources used together instead of single ones.
    """
    named: dict[str, Column] = (
        {
            f"{a}_{b}": F.when(F.col(a).isNotNull() & F.col(b).isNotNull(), composite_key(a, b))
            for a, b in combinations(resources, 2)
        }
        if pairs_of
        else {c: F.col(c).cast("string") for c in resources}
    )
    entries = F.array(*[F.struct(F.lit(n).alias("column"), v.alias("value")) for n, v in named.items()])
    long = df.select(roles.user, F.col(roles.days).alias("__day"), F.inline(entries))
    long = long.where(F.col("value").isNotNull() & F.col(roles.user).isNotNull())
    if none_hot(df, [*named.values(), F.col(roles.user)], hot_rows):
        # dealt out by value and then by user, everything else is local: partial aggregates would hardly shrink and are wide
        seen = _lifespans_beside(_days_used(long.repartition("column", "value"), roles), roles).repartition(roles.user)
    else:
        used = _days_used(long, roles)
        lifespan = used.groupBy("column", "value").agg(*[x.alias(name) for name, x in _lifespan().items()])
        seen = lookup_join(used.select("column", "value", roles.user), lifespan, ["column", "value"], "cnt_user", hot_rows)
    stats = [
        Stat(f"{measure}|{kind}", kind, F.col(measure)) for measure in MEASURES for kind in ("max", "min", "mean", "skew")
    ]
    tall = stats_by_column(seen, roles.user, {n: f"{n}|" for n in named}, stats, hot_rows)
    renamed = {f"{n}|{m}|{kind}": f"relate_{m}_{n}_{kind}" for n in named for m in MEASURES for kind in ("max", "min", "mean", "skew")}
    return tall.withColumnsRenamed(renamed)
