"""A table of partial statistics by day, from which windows and calendar figures roll up.

Rows are reduced once to (keys, day, dimensions) with the parts of every statistic, and stored by day. Trailing
windows, hour ranges, weekdays and parts of the day are all merges of the same stored parts, so the log is read once
for all of them, and a new day is added without reading old days.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from riskfeat.functions.states import PARTS, Figure, needed_parts, start_parts, stored
from riskfeat.operators.skew import all_present


class DayCube:
    """Parts per (keys, day, dimensions) in a folder with one subfolder a day.

    ``figures`` are those the cube has to answer; their parts are what it stores. Rows without a key or a day are left out,
    rows without a dimension are kept under NULL. Adding days that are there replaces them, so a job that is
    repeated leaves the same table.
    """

    def __init__(
        self,
        spark: SparkSession,
        path: str,
        keys: Sequence[str],
        day: str,
        dimensions: Sequence[str],
        figures: Sequence[Figure],
    ):
        self.spark, self.path, self.day = spark, path, day
        self.keys, self.dimensions = list(keys), list(dimensions)
        self.parts = needed_parts(figures)
        self.schema: StructType | None = None

    def add(self, rows: DataFrame) -> DayCube:
        """Reduce the rows of whole days and store them; other days stay untouched."""
        kept = rows.where(all_present([*self.keys, self.day]))
        reduced = start_parts(kept, [*self.keys, *self.dimensions, self.day], self.parts)
        self.schema = reduced.schema
        # a day's rows meet in few files, several if they are many: AQE splits what is too large
        dealt = reduced.hint("rebalance", self.day)
        dealt.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(self.day).parquet(self.path)
        return self

    def read(self) -> DataFrame:
        reader = self.spark.read if self.schema is None else self.spark.read.schema(self.schema)
        return reader.parquet(self.path)

    def roll_up(self, figures: Sequence[Figure], by: Sequence[str] | None = None, where: Column | None = None) -> DataFrame:
        """One row per key (``by``: some keys or dimensions) with every figure, in one aggregate.

        ``where`` on the day prunes the subfolders read.
        """
        by = self.keys if by is None else list(by)
        rows = self.read() if where is None else self.read().where(where)
        # figures that share a condition share the merged parts
        merged: dict[tuple[str, str, str], Column] = {}
        named: dict[int, dict[str, str]] = {}
        for i, f in enumerate(figures):
            condition = "" if f.where is None else str(f.where)
            names = named.setdefault(i, {})
            for p in needed_parts([f])[f.column]:
                part = F.col(stored(f.column, p))
                key = (f.column, p, condition)
                if key not in merged:
                    chosen = part if f.where is None else F.when(f.where, part)
                    merged[key] = PARTS[p].merge(chosen).alias(f"__p{len(merged)}")
                names[p] = f"__p{list(merged).index(key)}"
        wide = rows.groupBy(*by).agg(*merged.values())
        return wide.select(*by, *[f.expression(lambda c, p, names=named[i]: F.col(names[p])) for i, f in enumerate(figures)])
