"""What the operators share: words, helper columns, shared tables."""

from __future__ import annotations

import uuid
from contextlib import contextmanager
from collections.abc import Callable, Hashable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from riskfeat.session import checkpoint_folder

# ASCII white space separates words, so bytes.split() gives the same words as this pattern
WORD = r"[^\x20\x09-\x0D]+"
GAP = r"[\x20\x09-\x0D]+"


def words(text: Column) -> Column:
    """The words of a text in order (NULL for NULL)."""
    return F.array_remove(F.split(text, GAP), "")


def word_count(text: Column) -> Column:
    """Number of words; 0 for NULL."""
    return F.coalesce(F.size(words(F.coalesce(text, F.lit("")))), F.lit(0)).cast("long")


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with the value computed once, however often the body names it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def lower_ascii(text: Column) -> Column:
    """A-Z in lower case, every other character as it is."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def fresh(df: DataFrame, name: str) -> str:
    """A column name that ``df`` does not have yet."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def shared_path(spark: SparkSession, name: str) -> str:
    """A new path in the folder that driver and executors share; it goes when the session ends."""
    path = f"{checkpoint_folder(spark)}/riskfeat-{name}-{uuid.uuid4().hex}"
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(target)
    return path


_SCRATCH: list[list[str]] = []


def written(df: DataFrame, name: str) -> DataFrame:
    """The table written to the shared folder and read back: computed once, safe from lost executors."""
    path = shared_path(df.sparkSession, name)
    if _SCRATCH:
        _SCRATCH[-1].append(path)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def scratch(spark: SparkSession) -> Iterator[Callable[[DataFrame, str], DataFrame]]:
    """Tables written inside are removed at its end, but for those written with the function it gives."""
    _SCRATCH.append([])
    kept: list[str] = []

    def keep(df: DataFrame, name: str) -> DataFrame:
        out = written(df, name)
        kept.append(_SCRATCH[-1].pop())
        return out

    try:
        yield keep
    finally:
        paths = _SCRATCH.pop()
        if _SCRATCH:
            _SCRATCH[-1].extend(kept)
        configuration = spark._jsc.hadoopConfiguration()
        for path in paths:
            target = spark._jvm.org.apache.hadoop.fs.Path(path)
            target.getFileSystem(configuration).delete(target, True)


BATCH_BYTES = 8 << 20
BATCH_SETTING = "spark.sql.execution.arrow.maxBytesPerBatch"


def map_texts(rows: DataFrame, function: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: str) -> DataFrame:
    """``mapInArrow`` in batches of bounded bytes; a worker gives memory back when its task ends."""
    rows.sparkSession.conf.set(BATCH_SETTING, str(BATCH_BYTES))

    def bounded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from function(batches)
        finally:
            pa.default_memory_pool().release_unused()

    return rows.mapInArrow(bounded, schema)


_WORKER: dict = {}


def worker_cache(name: Hashable, make: Callable[[], object]):
    """What an operator keeps in a worker process between tasks; there is one at a time, so that they don't add up."""
    found = _WORKER.get(name)
    if found is None:
        _WORKER.clear()
        found = _WORKER[name] = make()
    return found


BROADCAST_ROWS = 20_000


def broadcast_if_small(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """Marked for broadcast if it has at most ``rows`` narrow rows, which is counted; else as it is."""
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df


def numbered(df: DataFrame, groups: Sequence[str], order: Sequence[str], name: str) -> DataFrame:
    """Add the position (from 0) of each row in its group, without one task per group.

    Rows are dealt by ranges of (groups, order), so a large group spreads over tasks; each
    range is numbered on its own and moved by the size of the group's earlier ranges. Equal rows
    are interchangeable: their positions are too.
    """
    groups, order = list(groups), list(order)
    part, tie = fresh(df, "__part"), fresh(df, "__tie")
    dealt = df.withColumn(tie, F.monotonically_increasing_id())
    dealt = dealt.repartitionByRange(*groups, *order, tie).withColumn(part, F.spark_partition_id())
    dealt = written(dealt, "numbered")
    inside = Window.partitionBy(*groups, part).orderBy(*order, tie)
    earlier = Window.partitionBy(*groups).orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    carry = (
        dealt.groupBy(*groups, part)
        .agg(F.count(F.lit(1)).alias("__n"))
        .select(
            *[F.col(c).alias(f"__g{i}") for i, c in enumerate(groups)],
            F.col(part).alias("__p"),
            F.coalesce(F.sum("__n").over(earlier), F.lit(0)).alias("__before"),
        )
    )
    match = F.col(part) == F.col("__p")
    for i, c in enumerate(groups):
        match = match & F.col(c).eqNullSafe(F.col(f"__g{i}"))
    local = dealt.withColumn(name, F.row_number().over(inside) - 1)
    return local.join(carry, match).select(*df.columns, (F.col(name) + F.col("__before")).alias(name))
