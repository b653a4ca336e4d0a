"""Cross-validation folds that depend on the user alone, not on row order."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskfeat.operators.ordered import global_running


def user_hash(user: Column, seed: int) -> Column:
    return F.md5(F.concat(F.lit(f"{seed}:"), user.cast("string")))


def hash_fold(user: Column, k: int, seed: int) -> Column:
    """Fold of a user from a hash; about stratified on large data."""
    head = F.conv(F.substring(user_hash(user, seed), 1, 8), 16, 10).cast("long")
    return (head % k).cast("int")


def with_hash_folds(labels: DataFrame, k: int, seed: int, user: str, label: str, fold: str = "fold") -> DataFrame:
    """Add the fold of labelled users; users to score have none."""
    return labels.withColumn(fold, F.when(F.col(label).isNotNull(), hash_fold(F.col(user), k, seed)))


def stratified_folds(
    labels: DataFrame, k: int, seed: int, user: str, label: str, fold: str = "fold", hot_rows: int | None = None
) -> DataFrame:
    """Exactly stratified folds: users of a label in hash order, dealt to the folds in turn."""
    known = labels.where(F.col(label).isNotNull()).withColumn("__hash", user_hash(F.col(user), seed))
    ranked = global_running(known, ["__hash", user], {"__rank": F.lit(1)}, [label], bucket_rows=hot_rows)
    dealt = ranked.withColumn(fold, ((F.col("__rank") - 1) % k).cast("int")).drop("__hash", "__rank")
    return dealt.unionByName(labels.where(F.col(label).isNull()).withColumn(fold, F.lit(None).cast("int")))
