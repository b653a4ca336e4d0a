"""Categories without a column for each: sparse indicators and statistics, for any number of categories."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskfeat.functions.states import Figure, merged_stats
from riskfeat.operators.grouping import unpivot
from riskfeat.operators.ordered import dense_codes
from riskfeat.operators.skew import all_present, lookup_join
from riskfeat.session import reliable_checkpoint


def category_ids(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column, value, __id, __rows): the categories numbered from 0 over the columns and their sorted values."""
    present = unpivot(df, [], columns).where(F.col("value").isNotNull())
    counted = present.groupBy("column", "value").agg(F.count(F.lit(1)).alias("__rows"))
    return dense_codes(counted, ["column", "value"], "__id")


def sparse_one_hot(df: DataFrame, key: str, columns: Sequence[str], hot_rows: int | None = None) -> DataFrame:
    """(key, ids): per row the sorted ids of its categories, the places of the ones in a one-hot vector.

    ``key`` names a row. NULL has no id, a row of NULLs an empty array. The schema is the same however many categories
    there are.
    """
    ids = reliable_checkpoint(category_ids(df, columns))
    named = unpivot(df.withColumn("__key", F.col(key)), ["__key"], columns).where(F.col("value").isNotNull())
    found = lookup_join(named, ids, ["column", "value"], "__rows", hot_rows)
    # at most one id a column
    ones = found.groupBy(F.col("__key").alias(key)).agg(F.sort_array(F.collect_list("__id")).alias("__ids"))
    filled = F.coalesce("__ids", F.array().cast("array<bigint>")).alias("ids")
    return df.select(key).join(ones, key, "left").select(key, filled)


def sparse_pivot(df: DataFrame, keys: Sequence[str], column: str, figures: Sequence[Figure], salts: int = 1) -> DataFrame:
    """(keys, column, figures): the statistics of a pivot, a row for each category that a key has.

    Rows without a key or a category are left out. No category is ever a column, so their number is not bounded.
    """
    keys = list(keys)
    return merged_stats(df.where(all_present([*keys, column])), [*keys, column], figures, salts=salts)


def category_vectors(sparse: DataFrame, keys: Sequence[str], column: str, figure: str) -> DataFrame:
    """(keys, vector): one figure of a sparse pivot as a map from category to figure, one row per key."""
    entries = F.collect_list(F.struct(F.col(column).alias("k"), F.col(figure).alias("v")))
    return sparse.groupBy(*keys).agg(F.map_from_entries(entries).alias("vector"))
