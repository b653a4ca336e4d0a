"""Named statistics as column builders, plain and weighted."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

# statistics that need the ordered values of a group, with their quantile
QUANTILES = {"median": 0.5, "q1": 0.25, "q3": 0.75}

BASIC = ("mean", "max", "min", "sum", "median", "count")
WITH_STD = ("mean", "std", "max", "min", "sum", "median", "count")
SPREAD = ("mean", "std", "max", "min", "sum", "median")


@dataclass(frozen=True, eq=False)
class Stat:
    """One output column: a statistic of a column, optionally over some rows only.

    ``weight`` counts a row several times (rows that were pre-aggregated).
    ``absent_is_null`` gives NULL, not 0, when no row qualifies.
    """

    name: str
    kind: str
    column: Column
    where: Column | None = None
    weight: Column | None = None
    absent_is_null: bool = False

    @property
    def value(self) -> Column:
        return self.column if self.where is None else F.when(self.where, self.column)

    @property
    def quantile(self) -> float | None:
        return QUANTILES.get(self.kind)

    def expression(self) -> Column:
        if self.weight is None:
            result = PLAIN[self.kind](self.value)
        else:
            result = WEIGHTED[self.kind](self.value, self.weight)
        if self.absent_is_null:
            result = F.nullif(result, F.lit(0))
        return result.alias(self.name)


def stats_of(
    column: str | Column,
    kinds: Iterable[str],
    name: str,
    *,
    where: Column | None = None,
    weight: Column | None = None,
    suffix: str = "",
    absent_is_null: bool = False,
) -> list[Stat]:
    """Several statistics of one column, named ``{name}_{kind}{suffix}``."""
    value = F.col(column) if isinstance(column, str) else column
    return [
        Stat(f"{name}_{kind}{suffix}", kind, value, where, weight, absent_is_null and kind in ("count", "nunique"))
        for kind in kinds
    ]


def ratio(top: Column, bottom: Column) -> Column:
    """Division that gives NULL for a zero divisor."""
    return F.try_divide(top.cast("double"), bottom.cast("double"))


def adjusted_skew(x: Column) -> Column:
    """Sample skewness with bias correction: NULL below 3 values, 0 without spread."""
    n = F.count(x).cast("double")
    g1 = F.coalesce(F.skewness(x.cast("double")), F.lit(0.0))
    return F.when(n >= 3, g1 * F.sqrt(n * (n - 1)) / (n - 2))


def _weighted_count(x: Column, w: Column) -> Column:
    return F.coalesce(F.sum(F.when(x.isNotNull(), w)), F.lit(0))


def _weighted_mean(x: Column, w: Column) -> Column:
    return ratio(F.sum(x * w), _weighted_count(x, w))


def _exact_scatter(x: Column, w: Column) -> Column:
    """n * sum(w x^2) - (sum w x)^2 of whole numbers, without rounding; NULL if a value is not whole or too large."""
    whole = "decimal(38,0)"
    value = F.when(x.isNotNull() & w.isNotNull(), F.when(x == F.floor(x), x.try_cast("decimal(19,0)")))
    weight = F.when(x.isNotNull(), w).try_cast("decimal(19,0)")
    first = F.try_multiply(value, weight).cast(whole)
    n, one = F.try_sum(weight).cast(whole), F.try_sum(first).cast(whole)
    two = F.try_sum(F.try_multiply(first, value).cast(whole)).cast(whole)
    scatter = F.try_subtract(F.try_multiply(n, two), F.try_multiply(one, one))
    return F.when(F.count(value) == F.count(weight), scatter.try_cast("double"))


def _weighted_std(x: Column, w: Column) -> Column:
    """Sample standard deviation; exact sums for whole numbers, whose squares may be far apart from their spread."""
    d = x.cast("double")
    n = _weighted_count(x, w).cast("double")
    total = F.sum(d * w)
    rough = F.greatest(F.sum(d * d * w) - total * total / F.nullif(n, F.lit(0.0)), F.lit(0.0))
    scatter = F.coalesce(F.try_divide(_exact_scatter(x, w), n), rough)
    return F.when(n > 1, F.when(F.min(x) == F.max(x), F.lit(0.0)).otherwise(F.sqrt(F.try_divide(scatter, n - 1))))


PLAIN: dict[str, Callable[[Column], Column]] = {
    "mean": lambda x: ratio(F.sum(x), F.count(x)),
    "std": lambda x: F.stddev_samp(x.cast("double")),
    "max": F.max,
    "min": F.min,
    "sum": F.sum,
    "sum0": lambda x: F.coalesce(F.sum(x), F.lit(0)),
    "count": F.count,
    "nunique": F.count_distinct,
    "skew": adjusted_skew,
    "share": lambda x: F.avg(x.cast("double")),
    **{kind: (lambda x, q=q: F.percentile(x.cast("double"), q)) for kind, q in QUANTILES.items()},
}

WEIGHTED: dict[str, Callable[[Column, Column], Column]] = {
    "mean": _weighted_mean,
    "std": _weighted_std,
    "max": lambda x, w: F.max(x),
    "min": lambda x, w: F.min(x),
    "sum": lambda x, w: F.sum(x * w),
    "sum0": lambda x, w: F.coalesce(F.sum(x * w), F.lit(0)),
    "count": _weighted_count,
    **{
        kind: (lambda x, w, q=q: F.percentile(x.cast("double"), q, w)) for kind, q in QUANTILES.items()
    },
}
