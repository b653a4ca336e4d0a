"""Row-level expressions: time parsing, composite keys, ordinals, bins, indicators."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

DAY_SECONDS = 86400


def relative_time(text: Column) -> dict[str, Column]:
    """Parts of ``"D days HH:MM:SS[.fraction]"``; the fraction is cut off."""
    words = F.split(text, " ")
    days = F.get(words, F.lit(0)).cast("int")
    clock = F.split(F.substring_index(F.get(words, F.lit(2)), ".", 1), ":")
    hour, minute, second = (F.get(clock, F.lit(i)).cast("int") for i in range(3))
    seconds = days.cast("long") * DAY_SECONDS + hour * 3600 + minute * 60 + second
    return {"days_diff": days, "hour": hour, "week": days % 7, "timestamp": seconds}


def with_relative_time(df: DataFrame, column: str) -> DataFrame:
    """Add days_diff, hour, week and timestamp (seconds) from a relative-time string."""
    return df.withColumns(relative_time(F.col(column)))


def composite_key(*columns: str | Column) -> Column:
    """Values joined by ``_``; a missing value takes part as the text ``nan``."""
    parts = [F.col(c) if isinstance(c, str) else c for c in columns]
    return F.concat_ws("_", *[F.coalesce(p.cast("string"), F.lit("nan")) for p in parts])


def with_composite_keys(df: DataFrame, keys: dict[str, Sequence[str]]) -> DataFrame:
    """Add several composite keys in one projection."""
    return df.withColumns({name: composite_key(*columns) for name, columns in keys.items()})


def ordinal(text: Column, separator: str = " ", item: int = 1) -> Column:
    """The number inside an ordinal string such as ``"level 12"``; -1 when missing."""
    return F.coalesce(F.get(F.split(text, separator), F.lit(item)).cast("int"), F.lit(-1))


def one_vs_rest(column: str, values: Sequence[object]) -> dict[str, Column]:
    """A 0/1 indicator per value and the indicators strung together."""
    flags = {
        f"is_{v}_{column}": F.coalesce((F.col(column) == F.lit(v)).cast("int"), F.lit(0)) for v in values
    }
    bits = F.concat(*[flag.cast("string") for flag in flags.values()])
    return {**flags, f"binary_{column}": bits}


def equal_width_bin(x: Column, low: Column, high: Column, k: int = 10) -> Column:
    """Number of the half-open, equally wide bin of x; the maximum is in the last bin."""
    step = (high - low).cast("double") / k
    place = F.floor(F.try_divide((x - low).cast("double"), step))
    return F.when(x.isNotNull(), F.least(F.coalesce(place, F.lit(0)), F.lit(k - 1))).cast("int")
