"""Transforms of the one-row-per-user profile table.

Whole-column figures (minimum, mean, …) come from one aggregate that is read back as
a scalar subquery, so the profile itself is never shuffled for them.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskfeat.functions.scalars import equal_width_bin
from riskfeat.operators.grouping import category_values, unpivot
from riskfeat.operators.ordered import dense_codes
from riskfeat.operators.skew import lookup_join
from riskfeat.session import reliable_checkpoint

CROSS = ("div", "sub", "mul", "sum")


def column_totals(df: DataFrame, totals: Mapping[str, Column]) -> Column:
    """Whole-table aggregates as one struct value usable in any projection."""
    return df.agg(F.struct(*[x.alias(n) for n, x in totals.items()]).alias("totals")).scalar()


def min_max(x: Column, low: Column, high: Column, mode: str = "max") -> Column:
    """``(x - min) / max``, or divided by the range with ``mode="range"``."""
    bottom = high if mode == "max" else high - low
    return F.try_divide((x - low).cast("double"), bottom.cast("double"))


def _with_extremes(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    totals = column_totals(
        df,
        {f"{side}_{c}": f(c) for c in columns for side, f in (("lo", F.min), ("hi", F.max))},
    )
    return df.select("*", totals.alias("__totals"))


def min_max_scale(df: DataFrame, columns: Sequence[str], mode: str = "max") -> DataFrame:
    """Replace columns by their min-max scaled values."""
    t = F.col("__totals")
    scaled = {c: min_max(F.col(c), t[f"lo_{c}"], t[f"hi_{c}"], mode) for c in columns}
    return _with_extremes(df, columns).withColumns(scaled).select(*df.columns)


def cross_names(columns: Sequence[str]) -> list[str]:
    return [f"{a}_{kind}_{b}" for a, b in combinations(columns, 2) for kind in CROSS]


def pairwise_cross(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Add quotient, difference, product and sum of every pair of scaled columns.

    Everything is one projection over one aggregate, whatever the number of columns.
    """
    t = F.col("__totals")
    scaled = _with_extremes(df, columns).select(
        *df.columns, *[min_max(F.col(c), t[f"lo_{c}"], t[f"hi_{c}"]).alias(f"__s_{c}") for c in columns]
    )
    crossed = []
    for a, b in combinations(columns, 2):
        x, y = F.col(f"__s_{a}"), F.col(f"__s_{b}")
        crossed += [
            F.try_divide(x, y).alias(f"{a}_div_{b}"),
            (x - y).alias(f"{a}_sub_{b}"),
            (x * y).alias(f"{a}_mul_{b}"),
            (x + y).alias(f"{a}_sum_{b}"),
        ]
    return scaled.select(*df.columns, *crossed)


def equal_width_bins(df: DataFrame, columns: Sequence[str], k: int = 10) -> DataFrame:
    """Add ``{column}_bin``, the column cut into k equally wide bins."""
    t = F.col("__totals")
    bins = [
        equal_width_bin(F.col(c), t[f"lo_{c}"], t[f"hi_{c}"], k).alias(f"{c}_bin") for c in columns
    ]
    return _with_extremes(df, columns).select(*df.columns, *bins)


def zscore(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Replace columns by (x - mean) / sample standard deviation."""
    x = {c: F.col(c).cast("double") for c in columns}
    totals = column_totals(
        df, {f"{n}_{c}": f(x[c]) for c in columns for n, f in (("mean", F.avg), ("std", F.stddev_samp))}
    )
    t = F.col("__totals")
    return (
        df.select("*", totals.alias("__totals"))
        .withColumns({c: F.try_divide(x[c] - t[f"mean_{c}"], t[f"std_{c}"]) for c in columns})
        .select(*df.columns)
    )


def mean_fill(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Replace NULLs by the column mean."""
    totals = column_totals(df, {c: F.avg(F.col(c).cast("double")) for c in columns})
    t = F.col("__totals")
    return (
        df.select("*", totals.alias("__totals"))
        .withColumns({c: F.coalesce(F.col(c).cast("double"), t[c]) for c in columns})
        .select(*df.columns)
    )


def const_fill(df: DataFrame, number: float = -999, text: str | None = None) -> DataFrame:
    """Replace NULLs by a constant in every numeric (and, if given, every text) column."""
    filled = df.na.fill(number)
    return filled if text is None else filled.na.fill(text)


def one_hot(df: DataFrame, columns: Sequence[str], values: Mapping[str, Sequence] | None = None) -> DataFrame:
    """Add indicators ``oh_enc{i}``, numbered over the columns and their sorted values."""
    values = values or {c: category_values(df, c) for c in columns}
    pairs = [(c, v) for c in columns for v in values[c]]
    return df.select(
        "*",
        *[
            F.coalesce((F.col(c) == F.lit(v)).cast("int"), F.lit(0)).alias(f"oh_enc{i}")
            for i, (c, v) in enumerate(pairs)
        ],
    )


def label_codes(df: DataFrame, columns: Sequence[str], missing: str = "-1") -> DataFrame:
    """Alphabetical codes (column, value, code) of the categories, with a row count."""
    long = unpivot(df, [], columns).withColumn("value", F.coalesce("value", F.lit(missing)))
    distinct = long.groupBy("column", "value").agg(F.count(F.lit(1)).alias("__rows"))
    return dense_codes(distinct, ["column", "value"], "code", groups=["column"])


def label_encode(
    df: DataFrame, columns: Sequence[str], missing: str = "-1", hot_rows: int | None = None
) -> DataFrame:
    """Replace categories by alphabetical codes, fitted on all rows; NULL is a category."""
    codes = reliable_checkpoint(label_codes(df, columns, missing))
    out = df.withColumns({c: F.coalesce(F.col(c).cast("string"), F.lit(missing)) for c in columns})
    for c in columns:
        of_column = codes.where(F.col("column") == c).select(
            F.col("value").alias(c), F.col("code").alias("__code"), "__rows"
        )
        out = lookup_join(out, of_column, [c], "__rows", hot_rows).withColumn(c, F.col("__code"))
        out = out.drop("__code", "__rows")
    return out


def factorize(
    df: DataFrame, column: str, order: Sequence[str], name: str | None = None, hot_rows: int | None = None
) -> DataFrame:
    """Add codes by first appearance in the given order (unique per row); NULL gives -1."""
    name = name or f"{column}_code"
    first = (
        df.where(F.col(column).isNotNull())
        .groupBy(column)
        .agg(F.min(F.struct(*order)).alias("__first"), F.count(F.lit(1)).alias("__rows"))
    )
    codes = dense_codes(first, ["__first"], name).select(column, name, "__rows")
    coded = lookup_join(df, codes, [column], "__rows", hot_rows).drop("__rows")
    return coded.withColumn(name, F.coalesce(F.col(name), F.lit(-1)))


def column_profile(df: DataFrame, columns: Sequence[str], exact: bool = False) -> DataFrame:
    """Per column: dense (floating) or sparse (whole), distinct values, and whether below 1,000."""
    kinds = {f.name: f.dataType.typeName() for f in df.schema.fields}
    entries = F.array(
        *[
            F.struct(
                F.lit(c).alias("column"),
                F.lit("dense" if kinds[c] in ("double", "float") or kinds[c].startswith("decimal") else "sparse").alias(
                    "kind"
                ),
                F.col(c).cast("string").alias("value"),
            )
            for c in columns
        ]
    )
    long = df.select(F.inline(entries))
    distinct = F.count_distinct("value") if exact else F.approx_count_distinct("value")
    counted = long.groupBy("column", "kind").agg(distinct.alias("n_unique"))
    return counted.select("*", (F.col("n_unique") < 1000).cast("int").alias("below_1000"))


def bad_rate(df: DataFrame, column: str, label: str, top: int | None = 5) -> DataFrame:
    """Rows, bad rows and bad rate per category, worst first (``top`` rows, or all)."""
    table = (
        df.where(F.col(column).isNotNull())
        .groupBy(column)
        .agg(F.count(label).alias("total"), F.sum(label).alias("bad"))
        .select("*", F.try_divide(F.col("bad").cast("double"), F.col("total").cast("double")).alias("bad_rate"))
    )
    if top is None:
        return table
    return table.orderBy(F.desc_nulls_last("bad_rate"), F.asc(column)).limit(top)
