"""Statistics kept as parts that merge: one declaration serves plain, weighted, salted, stored and streamed aggregates.

A part says how it starts from rows and how several of it become one; both are aggregates that Spark combines
map-side. A statistic names the parts it needs and how its figure comes out of them. Parts are shared: mean, sum
and standard deviation of a column store a sum once.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskfeat.functions.stats import ratio

# sizes of the sketches and what they promise: share of the count, of the rank, of the union
HLL_LOG_K, HLL_ERROR = 12, 0.05
KLL_K, KLL_ERROR = 1000, 0.0133
THETA_LOG_K, THETA_ERROR = 12, 0.05


@dataclass(frozen=True, eq=False)
class Part:
    """``start`` takes (value, weight), the weight being None for plain rows; ``merge`` takes the stored part."""

    start: Callable[[Column, Column | None], Column]
    merge: Callable[[Column], Column]


@dataclass(frozen=True, eq=False)
class Merged:
    """A statistic: the parts it needs, and its figure from them."""

    parts: tuple[str, ...]
    finish: Callable[[Mapping[str, Column]], Column]


def _times(x: Column, w: Column | None) -> Column:
    return x if w is None else x * w


def _count(x: Column, w: Column | None) -> Column:
    return F.count(x) if w is None else F.coalesce(F.sum(F.when(x.isNotNull(), w)), F.lit(0)).cast("long")


def _quantiles(x: Column, w: Column | None) -> Column:
    if w is not None:
        raise ValueError("a quantile sketch takes rows, not weighted rows")
    return F.kll_sketch_agg_double(x.cast("double"), F.lit(KLL_K))


def _spread(p: Mapping[str, Column]) -> Column:
    """Sample standard deviation; exact up to the root where sums are decimals or whole numbers. NULL below 2 values."""
    n = p["n"]
    scatter = F.greatest(F.try_subtract(F.try_multiply(n, p["squares"]), F.try_multiply(p["sum"], p["sum"])).cast("double"), F.lit(0.0))
    return F.when(n > 1, F.when(p["min"] == p["max"], F.lit(0.0)).otherwise(F.sqrt(scatter / (n.cast("double") * (n - 1)))))


def _sketched_median(p: Mapping[str, Column]) -> Column:
    return F.when(F.kll_sketch_get_n_double(p["kll"]) > 0, F.kll_sketch_get_quantile_double(p["kll"], F.lit(0.5)))


PARTS: dict[str, Part] = {
    "n": Part(_count, lambda p: F.coalesce(F.sum(p), F.lit(0)).cast("long")),
    "sum": Part(lambda x, w: F.sum(_times(x, w)), F.sum),
    "squares": Part(lambda x, w: F.sum(_times(x * x, w)), F.sum),
    "min": Part(lambda x, w: F.min(x), F.min),
    "max": Part(lambda x, w: F.max(x), F.max),
    "hll": Part(lambda x, w: F.hll_sketch_agg(x, HLL_LOG_K), F.hll_union_agg),
    "theta": Part(lambda x, w: F.theta_sketch_agg(x, THETA_LOG_K), lambda p: F.theta_union_agg(p, THETA_LOG_K)),
    "kll": Part(_quantiles, F.kll_merge_agg_double),
}

STATISTICS: dict[str, Merged] = {
    "count": Merged(("n",), lambda p: p["n"]),
    "sum": Merged(("sum",), lambda p: p["sum"]),
    "mean": Merged(("n", "sum"), lambda p: ratio(p["sum"], p["n"])),
    "min": Merged(("min",), lambda p: p["min"]),
    "max": Merged(("max",), lambda p: p["max"]),
    "std": Merged(("n", "sum", "squares", "min", "max"), _spread),
    "about_nunique": Merged(("hll",), lambda p: F.coalesce(F.hll_sketch_estimate(p["hll"]), F.lit(0))),
    "theta_nunique": Merged(("theta",), lambda p: F.coalesce(F.theta_sketch_estimate(p["theta"]), F.lit(0))),
    "about_median": Merged(("kll",), _sketched_median),
}


def register_part(name: str, start: Callable, merge: Callable) -> None:
    """Declare a part; a name is declared once."""
    if name in PARTS:
        raise ValueError(f"part {name} exists")
    PARTS[name] = Part(start, merge)


def register_statistic(name: str, parts: Sequence[str], finish: Callable) -> None:
    """Declare a statistic on declared parts; every form of aggregation below then knows it."""
    if name in STATISTICS:
        raise ValueError(f"statistic {name} exists")
    unknown = [p for p in parts if p not in PARTS]
    if unknown:
        raise ValueError(f"unknown parts {unknown}")
    STATISTICS[name] = Merged(tuple(parts), finish)


@dataclass(frozen=True, eq=False)
class Figure:
    """One output column: a statistic of a column, optionally over the stored rows that ``where`` chooses.

    ``absent_is_null`` gives NULL, not 0, for a count without rows.
    """

    name: str
    kind: str
    column: str
    where: Column | None = None
    absent_is_null: bool = False

    def expression(self, part: Callable[[str, str], Column]) -> Column:
        """The figure from ``part(column, name of part)``."""
        needed = STATISTICS[self.kind]
        value = needed.finish({p: part(self.column, p) for p in needed.parts})
        return (F.nullif(value, F.lit(0)) if self.absent_is_null else value).alias(self.name)


def figures_of(
    column: str, kinds: Iterable[str], name: str, where: Column | None = None, suffix: str = "", absent_is_null: bool = False
) -> list[Figure]:
    """Several statistics of one column, named ``{name}_{kind}{suffix}``."""
    return [Figure(f"{name}_{kind}{suffix}", kind, column, where, absent_is_null and kind == "count") for kind in kinds]


def stored(column: str, part: str) -> str:
    """The column that holds a part."""
    return f"{column}__{part}"


def needed_parts(figures: Iterable[Figure]) -> dict[str, list[str]]:
    """Per column the parts that the figures need."""
    out: dict[str, list[str]] = {}
    for f in figures:
        have = out.setdefault(f.column, [])
        have.extend(p for p in STATISTICS[f.kind].parts if p not in have)
    return out


def start_parts(df: DataFrame, keys: Sequence[str], parts: Mapping[str, Sequence[str]], weight: str | None = None) -> DataFrame:
    """(keys, parts): rows reduced to one row of parts per key, also on a stream."""
    w = None if weight is None else F.col(weight)
    return df.groupBy(*keys).agg(*[PARTS[p].start(F.col(c), w).alias(stored(c, p)) for c, names in parts.items() for p in names])


def merge_parts(df: DataFrame, keys: Sequence[str], parts: Mapping[str, Sequence[str]]) -> DataFrame:
    """(keys, parts): rows of parts reduced to one row per key."""
    merged = [PARTS[p].merge(F.col(stored(c, p))).alias(stored(c, p)) for c, names in parts.items() for p in names]
    return df.groupBy(*keys).agg(*merged)


def finish_parts(df: DataFrame, keep: Sequence[str], figures: Iterable[Figure]) -> DataFrame:
    """(keep, figures) of rows of parts."""
    return df.select(*keep, *[f.expression(lambda c, p: F.col(stored(c, p))) for f in figures])


def merged_stats(
    df: DataFrame, keys: Sequence[str], figures: Sequence[Figure], weight: str | None = None, salts: int = 1
) -> DataFrame:
    """The figures per key from rows; a figure's ``where`` is for stored parts and not used here.

    With ``salts`` the rows of a key are dealt over that many groups first, so that the large states of a hot key are
    built by several tasks; the results are the same.
    """
    parts, keys = needed_parts(figures), list(keys)
    if salts == 1:
        return finish_parts(start_parts(df, keys, parts, weight), keys, figures)
    used = [c for c in df.columns if c in {*keys, *parts, weight}]
    salt = F.pmod(F.xxhash64(*used), F.lit(salts)).alias("__salt")
    dealt = start_parts(df.select(*used, salt), [*keys, "__salt"], parts, weight)
    return finish_parts(merge_parts(dealt, keys, parts), keys, figures)
