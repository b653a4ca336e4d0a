"""Keeping hot keys from landing in one task.

A *hot* key has more than ``hot_rows`` rows and is among the ``MAX_HOT_KEYS`` with the most rows, so the list of
hot keys (and anything with one row per hot key) has a fixed size bound and is broadcast. Everything
else takes the plain Spark route; a key beyond the list has at most one row in ``MAX_HOT_KEYS``.

Operators that need a key's rows in order look for hot keys while the plan is built,
with one column-pruned count; only if there are any does the plan get a branch for
them. A caller that already knows passes the list, or None for "there are none".
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

DEFAULT_HOT_ROWS = 1_000_000
HOT_ROWS_SETTING = "spark.riskfeat.hotRows"
MAX_HOT_KEYS = 10_000
SALTS = 4096
HASH_BUCKETS = 65_536


def hot_row_limit(spark: SparkSession, hot_rows: int | None = None) -> int:
    """Rows a single key may bring to one task."""
    if hot_rows is not None:
        return hot_rows
    return int(spark.conf.get(HOT_ROWS_SETTING, str(DEFAULT_HOT_ROWS)))


def is_limited(spark: SparkSession) -> bool:
    """Whether the session sets how many rows a task may take."""
    return spark.conf.get(HOT_ROWS_SETTING, None) is not None


def null_safe(left: DataFrame, right: DataFrame, names: Mapping[str, str]) -> Column:
    """Join condition {left column: right column} in which NULL equals NULL."""
    match = F.lit(True)
    for one, other in names.items():
        match = match & left[one].eqNullSafe(right[other])
    return match


class _Unknown:
    """Default of ``hot`` parameters: count the keys to find out."""


UNKNOWN = _Unknown()
Hot = DataFrame | None | _Unknown


def hot_keys(df: DataFrame, keys: Sequence[str], hot_rows: int | None = None) -> DataFrame:
    """Keys with more rows than one task should take, and ``__n``, their rows; at most ``MAX_HOT_KEYS``."""
    limit = hot_row_limit(df.sparkSession, hot_rows)
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n")).where(F.col("__n") > limit)
    return counts.orderBy(F.col("__n").desc(), *keys).limit(MAX_HOT_KEYS)


def find_hot(df: DataFrame, keys: Sequence[str], hot_rows: int | None = None) -> DataFrame | None:
    """The hot keys, or None when there are none. Runs one count over the key columns."""
    found = hot_keys(df.where(all_present(keys)), keys, hot_rows).select(*keys)
    return None if found.isEmpty() else found


def none_hot(df: DataFrame, columns: Sequence[Column], hot_rows: int | None = None) -> bool:
    """Whether no value of any of the columns can be hot.

    Rows are counted per bucket of a hash, so the count shuffles little whatever the number of values. Values that share a
    bucket count together: a False may be wrong, a True is not.
    """
    limit = hot_row_limit(df.sparkSession, hot_rows)
    buckets = [F.when(c.isNotNull(), F.pmod(F.xxhash64(F.lit(i), c), F.lit(HASH_BUCKETS))) for i, c in enumerate(columns)]
    sizes = df.select(F.explode(F.array(*buckets)).alias("__bucket")).where("__bucket IS NOT NULL").groupBy("__bucket").count()
    return sizes.where(F.col("count") > limit).isEmpty()


def split_hot(
    df: DataFrame, keys: Sequence[str], hot_rows: int | None = None, hot: Hot = UNKNOWN
) -> tuple[DataFrame, DataFrame | None]:
    """Rows of ordinary keys, and rows of hot keys if any. Rows with a NULL key are dropped."""
    df = df.where(all_present(keys))
    if isinstance(hot, _Unknown):
        hot = find_hot(df, keys, hot_rows)
    if hot is None:
        return df, None
    marked = F.broadcast(hot)
    return df.join(marked, list(keys), "left_anti"), df.join(marked, list(keys), "left_semi")


def lookup_join(
    rows: DataFrame,
    dim: DataFrame,
    on: Sequence[str],
    hot: DataFrame | str | None,
    hot_rows: int | None = None,
    inner: bool = False,
) -> DataFrame:
    """Add the columns of ``dim`` (at most one row per key) to ``rows``, safe for hot keys.

    ``hot`` is a frame of hot keys (None: there are none), or the name of a column of
    ``dim`` that holds the number of rows behind each key. Hot keys are looked up in a broadcast; they and
    the NULL keys then enter the shuffle join under a salted key that matches nothing,
    so they spread over all tasks. Rows without a partner keep NULLs unless ``inner``.
    """
    on = list(on)
    if hot is None:
        return rows.join(dim, on, "inner" if inner else "left").select(*rows.columns, *[c for c in dim.columns if c not in on])
    added = [c for c in dim.columns if c not in on]
    if isinstance(hot, str):
        limit = hot_row_limit(rows.sparkSession, hot_rows)
        dim_hot = dim.where(F.col(hot) > limit).orderBy(F.col(hot).desc(), *on).limit(MAX_HOT_KEYS)
    else:
        dim_hot = dim.join(F.broadcast(hot.select(*on)), on, "left_semi")
    payload = F.struct(*added)
    hot_side = dim_hot.select(*on, payload.alias("__hot"))
    cold_side = dim.select(
        *[F.col(c).alias(f"__d_{c}") for c in on],
        # always 0, yet not a literal: a literal would be folded out of the join key
        F.pmod(F.xxhash64(*on), F.lit(1)).alias("__d_salt"),
        payload.alias("__cold"),
    )
    looked_up = rows.join(F.broadcast(hot_side), on, "left")
    plain = F.col("__hot").isNull() & all_present(on)
    spread = F.pmod(F.xxhash64(*rows.columns), F.lit(SALTS)) + 1
    keyed = looked_up.select(
        "*",
        *[F.when(plain, F.col(c)).alias(f"__k_{c}") for c in on],
        F.when(plain, F.lit(0)).otherwise(spread).alias("__k_salt"),
    )
    matches = F.col("__k_salt") == F.col("__d_salt")
    for c in on:
        matches = matches & (F.col(f"__k_{c}") == F.col(f"__d_{c}"))
    found = F.coalesce(F.col("__hot"), F.col("__cold"))
    joined = keyed.join(cold_side, matches, "left")
    if inner:
        joined = joined.where(found.isNotNull())
    return joined.select(*rows.columns, *[found[c].alias(c) for c in added])


def all_present(keys: Sequence[str]) -> Column:
    present = F.lit(True)
    for c in keys:
        present = present & F.col(c).isNotNull()
    return present
