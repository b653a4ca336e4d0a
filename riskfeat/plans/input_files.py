"""The star-schema tables written as the seven input files of the risk run."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskfeat.plans import tables
from riskfeat.session import shared_folder

# numbers as tools write them that keep gaps as floating point
AS_FLOAT = "decimal(18,1)"


def _files(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    customer = tables.table(spark, folder, "customer")
    scored = F.col("c_custkey") % 5 == 0
    person = customer.select(
        F.col("c_custkey").alias("user"),
        F.col("c_mktsegment").alias("sex"),
        F.col("c_nationkey").cast(AS_FLOAT).alias("province"),
        F.when(F.col("c_custkey") % 7 > 0, (F.col("c_custkey") % 90 + 0.5)).alias("age"),
        F.when(F.col("c_custkey") % 3 > 0, F.concat(F.lit("level "), F.col("c_custkey") % 20)).alias("balance"),
        scored.alias("scored"),
    )
    log = tables.activity(spark, folder)
    text = F.format_string("%d days %02d:%02d:%02d.000000000", "days_diff", "hour", F.floor(F.col("timestamp") % 3600 / 60), F.col("timestamp") % 60)
    events = log.select(
        F.col("user_id").alias("user"),
        F.col("event_type").alias("kind"),
        F.col("ip"),
        F.col("ip_3"),
        F.col("amount"),
        text.alias("tm_diff"),
        (F.col("user_id") % 5 == 0).alias("scored"),
    )
    out = {}
    for part, name, test in (("train", "train", False), ("test", "testb", True)):
        of_part = F.col("scored") == test
        out[f"{part}/{name}_base"] = person.where(of_part).drop("scored")
        trans = events.where(of_part & (F.col("kind") == "purchase"))
        out[f"{part}/{name}_trans"] = trans.select("user", "ip", "ip_3", "amount", "tm_diff")
        op = events.where(of_part & ~F.col("kind").eqNullSafe("purchase"))
        out[f"{part}/{name}_op"] = op.select("user", F.col("kind").alias("op_type"), "ip", "ip_3", "tm_diff")
    label = customer.where(~scored).select(
        F.col("c_custkey").alias("user"), (F.col("c_acctbal") < 0).cast("int").cast(AS_FLOAT).alias("label")
    )
    return {**out, "train/train_label": label}


def write_input_files(spark: SparkSession, folder: str) -> str:
    """Write all seven files (as folders of parts) under a new path of the shared folder and return it."""
    root = shared_folder(spark, "input")
    for name, rows in _files(spark, folder).items():
        rows.write.option("header", True).csv(f"{root}/{name}.csv")
    return root
