"""Session settings the operators are tuned for."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

PACKAGE_PARENT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))

# AQE does three jobs here: it drops the hot-key branches when there are no hot
# keys, it splits skewed join partitions, and it coalesces small shuffles.
SQL_SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    # plans of many hundred columns build several times faster without call sites
    "spark.sql.dataFrameQueryContext.enabled": "false",
    # more groups keep exact percentiles in the hash aggregate before it turns to sorting
    "spark.sql.objectHashAggregate.sortBased.fallbackThreshold": "2048",
}


def tune(spark: SparkSession) -> SparkSession:
    """Apply the runtime SQL settings to a session someone else created."""
    for key, value in SQL_SETTINGS.items():
        spark.conf.set(key, value)
    _let_workers_import(spark)
    return spark


def _let_workers_import(spark: SparkSession) -> None:
    """Workers on this machine find the package wherever they start; a cluster gets it with --py-files."""
    environment = spark.sparkContext.environment
    paths = environment.get("PYTHONPATH", "").split(os.pathsep)
    if PACKAGE_PARENT not in paths:
        environment["PYTHONPATH"] = os.pathsep.join([PACKAGE_PARENT, *filter(None, paths)])


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, memory: str = "8g") -> SparkSession:
    """A single-JVM session for tests and benchmarks."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("riskfeat")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    )
    for key, value in SQL_SETTINGS.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    _let_workers_import(spark)
    return spark


def checkpoint_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share, from ``spark.checkpoint.dir``.

    Only a local session may do without the setting; it gets a folder of its own.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured is None:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a shared folder")
        configured = tempfile.mkdtemp(prefix="riskfeat-")
        spark.conf.set("spark.checkpoint.dir", configured)
    return configured


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new path in the folder that driver and executors share; it is removed when the session ends."""
    path = f"{checkpoint_folder(spark)}/riskfeat-{name}-{uuid.uuid4().hex}"
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(target)
    return path


def reliable_checkpoint(df: DataFrame) -> DataFrame:
    """Cut lineage through the checkpoint folder the cluster names."""
    spark = df.sparkSession
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(checkpoint_folder(spark))
    return df.checkpoint()
