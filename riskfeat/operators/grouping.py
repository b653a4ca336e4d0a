"""Many conditional statistics per key in one pass, and pivots built on them.

Counts, sums, moments and distinct counts combine map-side, so a hot key is no
problem for them. Exact quantiles need a key's ordered values: ordinary keys use the
built-in percentile; for hot keys the rank is searched in rounds of histograms whose
range shrinks to the few values around the rank.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskfeat.functions.stats import Stat, stats_of
from riskfeat.operators.skew import UNKNOWN, Hot, all_present, hot_row_limit, split_hot
from riskfeat.session import reliable_checkpoint

BINS = 4096


def grouped_stats(
    df: DataFrame,
    keys: Sequence[str],
    stats: Iterable[Stat],
    hot_rows: int | None = None,
    hot: Hot = UNKNOWN,
    hot_on: Sequence[str] | None = None,
) -> DataFrame:
    """One row per key with every statistic, from a single aggregate for ordinary keys.

    ``hot_on`` are the key columns that decide hotness, all of them unless given.
    """
    keys, stats = list(keys), list(stats)
    expressions = [s.expression() for s in stats]
    if all(s.quantile is None for s in stats):
        return df.where(all_present(keys)).groupBy(*keys).agg(*expressions)
    cold, heavy = split_hot(df.where(all_present(keys)), hot_on or keys, hot_rows, hot)
    plain = cold.groupBy(*keys).agg(*expressions)
    if heavy is None:
        return plain
    ordered = [s for s in stats if s.quantile is not None]
    combined = [s.expression() for s in stats if s.quantile is None] or [F.count(F.lit(1)).alias("__rows")]
    limit = hot_row_limit(df.sparkSession, hot_rows)
    spread = heavy.groupBy(*keys).agg(*combined).join(_hot_quantiles(heavy, keys, ordered, limit), keys, "left")
    return plain.unionByName(spread.select(*plain.columns))


def _hot_quantiles(heavy: DataFrame, keys: list[str], stats: list[Stat], limit: int) -> DataFrame:
    slots = F.array(
        *[
            F.struct(
                F.lit(i).alias("slot"),
                s.value.cast("double").alias("x"),
                (F.lit(1) if s.weight is None else s.weight).cast("long").alias("w"),
            )
            for i, s in enumerate(stats)
        ]
    )
    group = [*keys, "__slot"]
    values = (
        heavy.select(*keys, F.explode(slots).alias("__e"))
        .select(*keys, F.col("__e.slot").alias("__slot"), F.col("__e.x").alias("__x"), F.col("__e.w").alias("__w"))
        .where(F.col("__x").isNotNull())
        .groupBy(*group, "__x")
        .agg(F.sum("__w").alias("__w"))
    )
    quantile = F.element_at(F.array(*[F.lit(s.quantile) for s in stats]), F.col("__slot") + 1)
    rank = quantile * (F.col("__n") - 1)
    # one row per hot key and statistic: small enough to broadcast
    around = (
        values.groupBy(*group)
        .agg(F.min("__x").alias("__lo"), F.max("__x").alias("__hi"), F.sum("__w").alias("__n"))
        .select(*group, "__lo", "__hi", rank.alias("__rank"), F.lit(0).cast("long").alias("__below"))
    )
    values = reliable_checkpoint(values)
    # outliers can leave most values in one bin: narrow while a task would get more than the limit and it helps
    before, most = None, limit + 1
    while most > limit and most != before:
        before = most
        around = reliable_checkpoint(_narrow(values, around, group))
        sizes = _inside(values, around, group).groupBy(*group).agg(F.count(F.lit(1)).alias("n"))
        most = sizes.agg(F.coalesce(F.max("n"), F.lit(0)).alias("n")).head()["n"]
    kept = _inside(values, around, group)
    cumulative = F.sum("__w").over(Window.partitionBy(*group).orderBy("__x").rowsBetween(Window.unboundedPreceding, 0))
    ranked = kept.select("*", (F.col("__below") + cumulative).alias("__upto"))

    def at(index: Column) -> Column:
        return F.max(F.when((F.col("__upto") > index) & (F.col("__upto") - F.col("__w") <= index), F.col("__x")))

    lower, upper = at(F.floor("__rank")), at(F.ceil("__rank"))
    part = F.max(F.col("__rank") - F.floor("__rank"))
    found = ranked.groupBy(*group).agg((lower + (upper - lower) * part).alias("__value"))
    return found.groupBy(*keys).agg(
        *[F.max(F.when(F.col("__slot") == i, F.col("__value"))).alias(s.name) for i, s in enumerate(stats)]
    )


def _inside(values: DataFrame, around: DataFrame, group: list[str]) -> DataFrame:
    return values.join(F.broadcast(around), group).where(F.col("__x").between(F.col("__lo"), F.col("__hi")))


def _narrow(values: DataFrame, around: DataFrame, group: list[str]) -> DataFrame:
    """Shrink each range to the bins that hold the two values next to the rank."""
    share = F.try_divide(F.col("__x") - F.col("__lo"), F.col("__hi") - F.col("__lo"))
    bin_of = F.least(F.floor(F.coalesce(share, F.lit(0.0)) * BINS), F.lit(BINS - 1))
    histogram = (
        _inside(values, around, group)
        .groupBy(*group, "__rank", "__below", bin_of.alias("__bin"))
        .agg(F.sum("__w").alias("__w"), F.min("__x").alias("__lo"), F.max("__x").alias("__hi"))
    )
    upto = F.col("__below") + F.sum("__w").over(
        Window.partitionBy(*group).orderBy("__bin").rowsBetween(Window.unboundedPreceding, 0)
    )
    ranked = histogram.select("*", upto.alias("__upto"))

    def holds(index: Column) -> Column:
        return (F.col("__upto") > index) & (F.col("__upto") - F.col("__w") <= index)

    first, last = holds(F.floor("__rank")), holds(F.ceil("__rank"))
    return ranked.groupBy(*group).agg(
        F.max(F.when(first, F.col("__lo"))).alias("__lo"),
        F.max(F.when(last, F.col("__hi"))).alias("__hi"),
        F.max("__rank").alias("__rank"),
        F.max(F.when(first, F.col("__upto") - F.col("__w"))).alias("__below"),
    )


def stats_by_column(
    long: DataFrame,
    user: str,
    names: dict[str, str],
    stats: Sequence[Stat],
    hot_rows: int | None = None,
    hot: Hot = UNKNOWN,
) -> DataFrame:
    """The same statistics for every ``column`` of a long table, side by side per user.

    ``names`` maps columns to the prefix of their outputs; each output is the prefix and
    the statistic's own name. Aggregating by (user, column) before pivoting keeps the
    generated aggregate small whatever the number of columns.
    """
    tall = grouped_stats(long, [user, "column"], stats, hot_rows, hot, [user])
    return tall.groupBy(user).agg(
        *[
            F.max(F.when(F.col("column") == c, F.col(s.name))).alias(f"{prefix}{s.name}")
            for c, prefix in names.items()
            for s in stats
        ]
    )


def trailing_stats(
    user: str, days: str, value: str, windows: Sequence[int], kinds: Sequence[str], name: str
) -> list[Stat]:
    """Statistics over rows later than each day bound; a user without such rows gets NULLs."""
    return [
        s
        for w in windows
        for s in stats_of(
            value, kinds, name, where=F.col(days) > w, suffix=f"_{w}d", absent_is_null=True
        )
    ]


def range_stats(
    column: str, bounds: Sequence[tuple[int, int]], value: str, kinds: Sequence[str], name: str
) -> list[Stat]:
    """Statistics over rows with ``start < column <= end`` for each range."""
    return [
        s
        for start, end in bounds
        for s in stats_of(
            value,
            kinds,
            name,
            where=(F.col(column) > start) & (F.col(column) <= end),
            suffix=f"_{start}_{end}",
            absent_is_null=True,
        )
    ]


def value_stats(
    column: str, values: Sequence[object], value: str, kinds: Sequence[str], name: str
) -> list[Stat]:
    """Statistics over the rows that carry each listed value."""
    return [
        s
        for v in values
        for s in stats_of(
            value, kinds, f"{name}_{v}_{value}", where=F.col(column) == F.lit(v), absent_is_null=True
        )
    ]


def null_stats(column: str, name: str) -> list[Stat]:
    """Number and share of NULLs."""
    missing = F.col(column).isNull().cast("int")
    return [Stat(f"{name}_null_cnt", "sum", missing), Stat(f"{name}_null_ratio", "mean", missing)]


def nunique_stats(df: DataFrame, keys: Sequence[str], columns: Sequence[str], name: str) -> DataFrame:
    """Distinct values of many columns per key.

    Up to three columns share one aggregate; more are unpivoted and deduplicated, which
    keeps the row expansion of the distinct rewrite out of the plan.
    """
    keys = list(keys)
    if len(columns) <= 3:
        return grouped_stats(df, keys, [Stat(f"{name}_{c}_nuniq", "nunique", F.col(c)) for c in columns])
    pairs = unpivot(df, keys, columns).groupBy(*keys, "column", "value").agg(F.lit(1).alias("one"))
    found = pairs.groupBy(*keys).agg(
        *[F.count(F.when((F.col("column") == c) & F.col("value").isNotNull(), 1)).alias(f"{name}_{c}_nuniq") for c in columns]
    )
    return found


def unpivot(df: DataFrame, keep: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """Rows ``(keep…, column, value)`` with the values as strings; NULL values stay."""
    entries = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value")) for c in columns])
    return df.select(*keep, F.inline(entries))


def pivot_stats(
    df: DataFrame,
    keys: Sequence[str],
    column: str,
    values: Sequence[object],
    measure: str,
    kinds: Sequence[str] = ("count", "sum", "mean", "max", "min", "median"),
    hot_rows: int | None = None,
    hot: Hot = UNKNOWN,
) -> DataFrame:
    """One column per listed value and statistic; a value a key never has gives 0.

    Keys whose rows all carry a NULL category or measure drop out, as in a pivot table.
    """
    rows = df.where(F.col(column).isNotNull())
    stats = [
        s
        for v in values
        for s in stats_of(measure, kinds, f"{column}_{v}_{measure}", where=F.col(column) == F.lit(v))
    ]
    wide = grouped_stats(rows, keys, stats, hot_rows, hot)
    return wide.na.fill(0, subset=[s.name for s in stats])


def category_values(df: DataFrame, column: str) -> list:
    """All categories of a column, in order, for building one output column each.

    The list becomes part of the schema. Columns with very many categories are better kept as rows or ids:
    ``categories.sparse_pivot`` and ``categories.sparse_one_hot``.
    """
    found = df.where(F.col(column).isNotNull()).select(column).distinct().collect()
    return sorted(row[0] for row in found)


def frequent_values(df: DataFrame, column: str, k: int) -> list:
    """The k most frequent values (ties by value)."""
    counts = df.where(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("__n"))
    return [row[0] for row in counts.orderBy(F.desc("__n"), F.asc(column)).limit(k).collect()]
