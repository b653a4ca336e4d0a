"""The star-schema tables seen as profile, event logs and labels."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskfeat.functions.scalars import composite_key
from riskfeat.operators.folds import with_hash_folds
from riskfeat.operators.sessions import union_logs

MONEY = "decimal(18,2)"
FOLDS = 5
SEED = 2020
LOG_COLUMNS = ["user_id", "seq", "ip", "ip_3", "k7", "event_type", "amount", "days_diff", "hour", "week", "timestamp"]


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def activity(spark: SparkSession, folder: str) -> DataFrame:
    """Events with time parts since 2024-01-01, the amount, and ``props.k`` as a resource."""
    ts = F.col("ts")
    days = F.datediff(F.to_date(ts), F.lit("2024-01-01").cast("date"))
    seconds = days.cast("long") * 86400 + F.hour(ts) * 3600 + F.minute(ts) * 60 + F.second(ts)
    k = F.get_json_object("props", "$.k").cast("int")
    return table(spark, folder, "events").select(
        "user_id",
        F.col("event_id").alias("seq"),
        k.cast("string").alias("ip"),
        (k % 10).cast("string").alias("ip_3"),
        F.nullif(k % 7, F.lit(0)).cast("string").alias("k7"),
        "event_type",
        F.col("value").cast(MONEY).alias("amount"),
        days.alias("days_diff"),
        F.hour(ts).alias("hour"),
        (days % 7).alias("week"),
        seconds.alias("timestamp"),
    )


def purchases(spark: SparkSession, folder: str) -> DataFrame:
    return activity(spark, folder).where(F.col("event_type") == "purchase")


def operations(spark: SparkSession, folder: str) -> DataFrame:
    """All other events, also those without a type."""
    return activity(spark, folder).where(~F.col("event_type").eqNullSafe("purchase"))


def logs(spark: SparkSession, folder: str) -> DataFrame:
    """Purchases as transactions and the other events as operations, in one log."""
    return union_logs(purchases(spark, folder), operations(spark, folder), LOG_COLUMNS)


def commerce(spark: SparkSession, folder: str) -> DataFrame:
    """Orders as transactions, in days since 1995-01-01."""
    days = F.datediff(F.to_date("o_orderdate"), F.lit("1995-01-01").cast("date"))
    return table(spark, folder, "orders").select(
        F.col("o_custkey").alias("user_id"),
        F.col("o_orderkey").alias("seq"),
        F.col("o_orderstatus").alias("status"),
        F.col("o_orderpriority").alias("priority"),
        F.nullif(F.col("o_orderstatus"), F.lit("P")).alias("status_n"),
        F.col("o_totalprice").cast(MONEY).alias("amount"),
        days.alias("days_diff"),
        F.lit(0).alias("hour"),
        (days % 7).alias("week"),
        (days.cast("long") * 86400).alias("timestamp"),
    )


def order_resources(spark: SparkSession, folder: str) -> DataFrame:
    """Who bought from which supplier which part, and on which day."""
    items = table(spark, folder, "lineitem").select("l_orderkey", "l_suppkey", "l_partkey")
    return commerce(spark, folder).select("user_id", "seq", "days_diff").join(
        items.withColumnRenamed("l_orderkey", "seq"), "seq"
    )


def labels(spark: SparkSession, folder: str) -> DataFrame:
    """Users with a negative balance are bad; every fifth user is to be scored."""
    customer = table(spark, folder, "customer").select(
        F.col("c_custkey").alias("user_id"),
        F.when(F.col("c_custkey") % 5 != 0, (F.col("c_acctbal") < 0).cast("int")).alias("label"),
    )
    return with_hash_folds(customer, FOLDS, SEED, "user_id", "label")


def profile(spark: SparkSession, folder: str) -> DataFrame:
    """One row per customer with label, fold and categories."""
    customer = table(spark, folder, "customer").select(
        F.col("c_custkey").alias("user_id"),
        F.when(F.col("c_custkey") % 5 != 0, (F.col("c_acctbal") < 0).cast("int")).alias("label"),
        F.col("c_nationkey").alias("nation"),
        F.col("c_mktsegment").alias("segment"),
        F.nullif(F.col("c_mktsegment"), F.lit("BUILDING")).alias("segment_n"),
        composite_key("c_nationkey", "c_mktsegment").alias("nation_segment"),
    )
    return with_hash_folds(customer, FOLDS, SEED, "user_id", "label")


def numeric_profile(spark: SparkSession, folder: str) -> DataFrame:
    """Customers with whole-number columns: nation and order counts."""
    orders = commerce(spark, folder)
    counts = orders.groupBy("user_id").agg(
        F.count(F.lit(1)).alias("n_orders"),
        F.count(F.when(F.col("status") == "O", 1)).alias("n_open"),
        F.max("days_diff").alias("last_day"),
    )
    customer = table(spark, folder, "customer").select(
        F.col("c_custkey").alias("user_id"), F.col("c_nationkey").alias("nation"), F.col("c_mktsegment").alias("segment")
    )
    return customer.join(counts, "user_id", "left")
