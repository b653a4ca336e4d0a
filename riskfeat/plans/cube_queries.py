"""Queries on the cube of daily parts, its sketches, and categories without columns."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskfeat.functions.states import HLL_ERROR, KLL_ERROR, THETA_ERROR, Figure, figures_of, merge_parts
from riskfeat.operators import categories
from riskfeat.operators.cube import DayCube
from riskfeat.plans import tables
from riskfeat.session import shared_folder

MOMENTS = ("mean", "std", "max", "min", "sum", "count")
WINDOWS = (27, 23, 15, 10, 5)
HOUR_RANGES = ((0, 6), (6, 12), (12, 18), (18, 24))
DAY = "days_diff"


def _in_two_steps(cube: DayCube, rows: DataFrame) -> DayCube:
    """The cube of all days but the last, then the last one added, as a daily job does."""
    last = rows.agg(F.max(DAY).alias("day")).head()["day"]
    if last is None:
        return cube.add(rows)
    return cube.add(rows.where(F.col(DAY) < last)).add(rows.where(F.col(DAY) == last))


def _user_cube(spark: SparkSession, folder: str, figures: Sequence[Figure]) -> DayCube:
    cube = DayCube(spark, shared_folder(spark, "cube"), ["user_id"], DAY, ["hour"], figures)
    return _in_two_steps(cube, tables.purchases(spark, folder))


def _log_cube(spark: SparkSession, folder: str, keys: Sequence[str], figures: Sequence[Figure]) -> DayCube:
    return _in_two_steps(DayCube(spark, shared_folder(spark, "cube"), keys, DAY, [], figures), tables.logs(spark, folder))


def cube_trailing_day_stats(spark, folder):
    """Trailing windows of any length from stored days."""
    figures = [f for w in WINDOWS for f in figures_of("amount", MOMENTS, "amount", F.col(DAY) > w, f"_{w}d", True)]
    return _user_cube(spark, folder, figures).roll_up(figures)


def cube_hour_range_stats(spark, folder):
    """Ranges of hours from stored hours."""
    figures = [
        f
        for a, b in HOUR_RANGES[:3]
        for f in figures_of("amount", MOMENTS, "hour_amount", (F.col("hour") > a) & (F.col("hour") <= b), f"_{a}_{b}", True)
    ]
    return _user_cube(spark, folder, figures).roll_up(figures)


def cube_calendar_counts(spark, folder):
    """Rows per weekday and range of hours, first and last activity."""
    weekdays = [Figure(f"week_{d}_cnt", "count", "seq", F.col(DAY) % 7 == d, True) for d in range(7)]
    hours = [
        Figure(f"hour_{a}_{b}_cnt", "count", "seq", (F.col("hour") > a) & (F.col("hour") <= b), True) for a, b in HOUR_RANGES
    ]
    figures = [*weekdays, *hours, Figure("first_time", "min", "timestamp"), Figure("last_time", "max", "timestamp")]
    return _user_cube(spark, folder, figures).roll_up(figures)


def sketch_distinct_counts(spark, folder):
    """Exact distinct values per log and column, and whether the merged daily sketches are within their error."""
    columns = ("user_id", "ip", "ip_3", "k7")
    figures = [Figure(c, "about_nunique", c) for c in columns]
    about = _log_cube(spark, folder, ["property"], figures).roll_up(figures)
    exact = tables.logs(spark, folder).groupBy("property").agg(*[F.count_distinct(c).alias(f"n_{c}") for c in columns])
    both = about.join(exact, "property")
    rows = F.array(*[F.struct(F.lit(c).alias("field"), F.col(f"n_{c}").alias("n"), F.col(c).alias("about")) for c in columns])
    near = F.abs(F.col("about") - F.col("n")) <= HLL_ERROR * F.col("n")
    return both.select("property", F.inline(rows)).select("property", "field", "n", near.cast("long").alias("within"))


def sketch_medians(spark, folder):
    """Amounts per log and weekday, and whether the rank of the sketched median is within its error."""
    figures = [Figure("median", "about_median", "amount")]
    about = _log_cube(spark, folder, ["property", "week"], figures).roll_up(figures)
    # two logs and seven weekdays
    rows = tables.logs(spark, folder).join(F.broadcast(about), ["property", "week"])
    x, n = F.col("amount").cast("double"), F.count("amount")
    below, upto = (F.sum(c.cast("long")) for c in (x < F.col("median"), x <= F.col("median")))
    near = (below / n - 0.5 <= KLL_ERROR) & (0.5 - upto / n <= KLL_ERROR)
    return rows.groupBy("property", "week").agg(n.alias("n"), near.cast("long").alias("within"))


def sketch_shared_values(spark, folder):
    """Values that occur in both logs, and whether the intersection of the sketches is within its error."""
    columns = ("user_id", "ip", "k7")
    figures = [Figure(c, "theta_nunique", c) for c in columns]
    cube = _log_cube(spark, folder, ["property"], figures)
    logs = merge_parts(cube.read(), ["property"], {c: ["theta"] for c in columns})
    shared = logs.agg(
        F.count(F.lit(1)).alias("n_logs"),
        *[F.theta_sketch_estimate(F.theta_intersection_agg(f"{c}__theta")).alias(c) for c in columns],
    )
    rows = F.array(*[F.struct(F.lit(c).alias("field"), F.when(F.col("n_logs") == 2, F.col(c)).otherwise(0).alias("about")) for c in columns])
    about = shared.select(F.inline(rows))
    log = tables.logs(spark, folder)
    exact = []
    for c in columns:
        per_value = log.where(F.col(c).isNotNull()).groupBy(c).agg(F.min("property").alias("a"), F.max("property").alias("b"))
        exact.append(
            per_value.agg(
                F.count(F.when(F.col("a") != F.col("b"), 1)).alias("n_shared"), F.count(F.lit(1)).alias("n_all")
            ).select(F.lit(c).alias("field"), "n_shared", "n_all")
        )
    both = reduce(DataFrame.unionByName, exact).join(F.broadcast(about), "field")
    near = F.abs(F.col("about") - F.col("n_shared")) <= THETA_ERROR * F.col("n_all")
    return both.select("field", "n_shared", "n_all", near.cast("long").alias("within"))


def sparse_one_hot(spark, folder):
    """Ids of each customer's categories in a one-hot vector of any length."""
    ids = categories.sparse_one_hot(tables.profile(spark, folder), "user_id", ["nation_segment", "segment_n"])
    return ids.select("user_id", F.array_join(F.transform("ids", lambda i: i.cast("string")), ",").alias("ids"))


def sparse_pivot(spark, folder):
    """Amounts per customer and day with its status: thousands of categories, no column for any."""
    orders = tables.commerce(spark, folder).withColumn("day_status", F.concat_ws("/", "days_diff", "status"))
    return categories.sparse_pivot(orders, ["user_id"], "day_status", figures_of("amount", ("count", "sum", "max"), "amount"))


QUERIES = {
    f.__name__: f
    for f in (
        cube_trailing_day_stats,
        cube_hour_range_stats,
        cube_calendar_counts,
        sketch_distinct_counts,
        sketch_medians,
        sketch_shared_values,
        sparse_one_hot,
        sparse_pivot,
    )
}
