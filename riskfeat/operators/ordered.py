"""Neighbouring rows and running totals per key, without one task per hot key.

Ordinary keys use a plain window. The rows of hot keys are dealt out by ranges of (key, order), so that a
burst at one time is cut as well; the part of a key in one range is a chunk. Each chunk is windowed on its
own and then gets the carry of the chunks before it from a summary with one row per chunk. Both ways
sort NULL times first and treat NULL keys as one key, so a key's result does not depend on its size.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskfeat.operators.skew import hot_keys, hot_row_limit, is_limited, null_safe
from riskfeat.session import reliable_checkpoint

CHUNK = "__chunk"
# the key of a chunked row as one text that is never NULL
HOT_KEY = "__hot_key"
START = Window.unboundedPreceding


@dataclass(frozen=True)
class Ordering:
    """Rows of a key in the order of a whole-number column, then of tie columns."""

    keys: tuple[str, ...]
    by: str
    ties: tuple[str, ...] = ()

    @property
    def columns(self) -> list[str]:
        return [self.by, *self.ties]

    def window(self, chunked: bool):
        parts = [HOT_KEY, CHUNK] if chunked else list(self.keys)
        return Window.partitionBy(*parts).orderBy(*self.columns)


def _dealt(df: DataFrame, columns: Sequence[str], limit: int, n_rows: int | None) -> DataFrame:
    """Rows dealt out by ranges of the columns, with the number of the range; written, so that it stays.

    With ``n_rows`` there are as many ranges as it takes for about ``limit`` rows each, else as many as the session
    has shuffle partitions, joined where they are small.
    """
    if n_rows is None:
        spread = df.repartitionByRange(*columns)
    else:
        spread = df.repartitionByRange(max(1, -(-n_rows // limit)), *columns)
    return reliable_checkpoint(spread.withColumn(CHUNK, F.spark_partition_id()))


def per_key_ordered(
    df: DataFrame,
    ordering: Ordering,
    step: Callable[[DataFrame, bool], DataFrame],
    hot_rows: int | None = None,
) -> DataFrame:
    """Apply ``step(rows, chunked)`` to ordinary keys and to the chunks of hot keys."""
    keys = list(ordering.keys)
    found = hot_keys(df, keys, hot_rows)
    n_hot = found.agg(F.sum("__n").alias("n")).head()["n"]
    if not n_hot:
        return step(df, False)
    marked = F.broadcast(found.drop("__n").withColumnsRenamed({k: f"__h_{k}" for k in keys}))
    same = null_safe(df, marked, {k: f"__h_{k}" for k in keys})
    cold = df.join(marked, same, "left_anti")
    hot = df.join(marked, same, "left_semi").withColumn(HOT_KEY, F.to_json(F.struct(*keys)))
    limit = hot_row_limit(df.sparkSession, hot_rows)
    chunks = _dealt(hot, [HOT_KEY, *ordering.columns], limit, n_hot)
    return step(cold, False).unionByName(step(chunks, True).drop(CHUNK, HOT_KEY))


def neighbour(
    df: DataFrame, ordering: Ordering, columns: Mapping[str, str], chunked: bool, ahead: bool = False
) -> DataFrame:
    """Add ``{new: column}`` of the previous (or next) row of the key; NULL at the edge."""
    shift = F.lead if ahead else F.lag
    value = F.struct(*[F.col(c).alias(new) for new, c in columns.items()])
    local = shift(value).over(ordering.window(chunked))
    if not chunked:
        return df.select("*", local.alias("__near")).select(
            *df.columns, *[F.col("__near")[new].alias(new) for new in columns]
        )
    pick = F.min_by if ahead else F.max_by
    edges = df.groupBy(HOT_KEY, CHUNK).agg(pick(value, F.struct(*ordering.columns)).alias("__edge"))
    # one row per chunk
    across = shift("__edge").over(Window.partitionBy(HOT_KEY).orderBy(CHUNK))
    carry = edges.select(HOT_KEY, CHUNK, across.alias("__carry"))
    near = F.coalesce(F.col("__near"), F.col("__carry"))
    return (
        df.select("*", local.alias("__near"))
        .join(carry, [HOT_KEY, CHUNK])
        .select(*df.columns, *[near[new].alias(new) for new in columns])
    )


def running_sums(
    df: DataFrame, ordering: Ordering, sums: Mapping[str, Column], chunked: bool, inclusive: bool = True
) -> DataFrame:
    """Add running totals ``{new: measure}`` per key, with or without the row itself."""
    frame = ordering.window(chunked).rowsBetween(START, 0 if inclusive else -1)
    local = {new: F.coalesce(F.sum(x).over(frame), F.lit(0)) for new, x in sums.items()}
    if not chunked:
        return df.select("*", *[x.alias(new) for new, x in local.items()])
    return _carried(df, [HOT_KEY], local, sums)


def _carried(df: DataFrame, groups: Sequence[str], local: Mapping[str, Column], sums: Mapping[str, Column]) -> DataFrame:
    """Running totals inside chunks plus the totals of the group's earlier chunks."""
    named = {g: f"__g_{g}" for g in [*groups, CHUNK]}
    totals = df.groupBy(*groups, CHUNK).agg(*[F.sum(x).alias(f"__t_{new}") for new, x in sums.items()])
    # one row per group and chunk
    before = Window.partitionBy(*(groups or [F.lit(0)])).orderBy(CHUNK).rowsBetween(START, -1)
    carry = totals.select(
        *[F.col(g).alias(new) for g, new in named.items()],
        *[F.coalesce(F.sum(f"__t_{new}").over(before), F.lit(0)).alias(f"__c_{new}") for new in sums],
    )
    return (
        df.select("*", *[x.alias(f"__l_{new}") for new, x in local.items()])
        .join(carry, null_safe(df, carry, named))
        .select(*df.columns, *[(F.col(f"__l_{new}") + F.col(f"__c_{new}")).alias(new) for new in sums])
    )


def positions(df: DataFrame, ordering: Ordering, name: str, hot_rows: int | None = None) -> DataFrame:
    """Add the 1-based position of each row within its key."""
    return per_key_ordered(
        df, ordering, lambda rows, chunked: running_sums(rows, ordering, {name: F.lit(1)}, chunked), hot_rows
    )


def global_running(
    df: DataFrame,
    order: Sequence[str],
    sums: Mapping[str, Column],
    groups: Sequence[str] = (),
    inclusive: bool = True,
    bucket_rows: int | None = None,
) -> DataFrame:
    """Running totals over the whole table (or per group) in the order of unique keys.

    ``order`` must identify a row within its group. Rows are dealt out by ranges of (groups, order) and written
    once; each range is windowed on its own, and the totals of the group's earlier ranges are added, so no task
    sees the whole table. The number of ranges follows the data.
    """
    groups, order = list(groups), list(order)
    asked = bucket_rows is not None or is_limited(df.sparkSession)
    limit = hot_row_limit(df.sparkSession, bucket_rows)
    dealt = _dealt(df, [*groups, *order], limit, df.count() if asked else None)
    inside = Window.partitionBy(*groups, CHUNK).orderBy(*order).rowsBetween(START, 0 if inclusive else -1)
    local = {new: F.coalesce(F.sum(x).over(inside), F.lit(0)) for new, x in sums.items()}
    return _carried(dealt, groups, local, sums).drop(CHUNK)


def dense_codes(df: DataFrame, order: Sequence[str], name: str, start: int = 0, groups: Sequence[str] = ()) -> DataFrame:
    """Number the rows of a table of distinct keys 0, 1, 2, … in the order of ``order``."""
    return global_running(df, order, {name: F.lit(1)}, groups).withColumn(name, F.col(name) - 1 + start)
