"""Writing scores, submissions and feature blocks, and feature deny-lists."""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Mapping, Sequence
from multiprocessing.pool import ThreadPool

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskfeat.session import reliable_checkpoint

SCORE_KEYS = ["model", "seed", "feature_set"]
# blocks written at the same time
WRITES_AT_ONCE = 4


def write_submission(scores: DataFrame, path: str, user: str = "user", score: str = "score") -> None:
    """A folder of headed CSV files with ``user,prob``."""
    out = scores.select(F.col(user).alias("user"), F.col(score).alias("prob"))
    out.write.mode("overwrite").option("header", True).csv(path)


def write_scores(scores: DataFrame, path: str, run: str = "scores") -> None:
    """Put scores into the score table, one folder per model, seed and feature set.

    What the table had for the same model, seed and feature set is replaced and everything else stays, so a run
    that is repeated, after a failure or with other users, leaves each score once. A manifest beside the table notes what
    ``run`` wrote; it is replaced in the same way, after the scores are complete.
    """
    scores = reliable_checkpoint(scores)
    _replaced(scores, path, SCORE_KEYS)
    written = scores.groupBy(*SCORE_KEYS).agg(F.count(F.lit(1)).alias("n_rows"))
    _replaced(written.withColumn("run", F.lit(run)), _manifest(path), ["run"])


def _manifest(path: str) -> str:
    return f"{path.rstrip('/')}_runs"


def _replaced(df: DataFrame, path: str, by: Sequence[str]) -> None:
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*by).parquet(path)


def read_runs(spark: SparkSession, path: str) -> DataFrame:
    """The manifest of a score table: (run, model, seed, feature_set, n_rows)."""
    return spark.read.parquet(_manifest(path))


def read_scores(spark: SparkSession, path: str, run: str | None = None) -> DataFrame:
    """The score table, or the part of it that one run wrote."""
    scores = spark.read.parquet(path)
    if run is None:
        return scores
    # one row per model, seed and feature set
    mine = read_runs(spark, path).where(F.col("run") == run).select(*SCORE_KEYS)
    return scores.join(F.broadcast(mine), SCORE_KEYS, "left_semi")


def write_block(df: DataFrame, path: str) -> DataFrame:
    """Write a feature block and read it back, which also cuts its lineage."""
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.parquet(path)


class BlockStore:
    """Feature blocks kept so that they join without a shuffle.

    Every block has one row per user and is written in the same number of buckets of the user, one sorted file per bucket. Tables
    that are bucketed alike are joined bucket by bucket, whatever their number. The files stay in
    ``folder``; the names by which the session knows them go with ``close``.
    """

    def __init__(self, spark: SparkSession, folder: str, key: str, buckets: int | None = None):
        self.spark, self.folder, self.key = spark, folder.rstrip("/"), key
        self.buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.names: dict[str, str] = {}

    def put(self, name: str, block: DataFrame) -> DataFrame:
        """Write (or replace) a block and return it as a table."""
        self.drop(name)
        table = f"riskfeat_{uuid.uuid4().hex}"
        dealt = block.repartition(self.buckets, self.key)
        layout = dealt.write.mode("overwrite").format("parquet").bucketBy(self.buckets, self.key).sortBy(self.key)
        layout.option("path", f"{self.folder}/{name}").saveAsTable(table)
        self.names[name] = table
        return self.get(name)

    def put_all(self, blocks: Mapping[str, DataFrame]) -> list[DataFrame]:
        """``put`` for blocks that do not read each other, up to ``WRITES_AT_ONCE`` side by side; in the order given."""
        with ThreadPool(min(WRITES_AT_ONCE, len(blocks))) as pool:
            put = inheritable_thread_target(self.spark)(self.put)
            return pool.starmap(put, blocks.items(), chunksize=1)

    def get(self, name: str) -> DataFrame:
        return self.spark.table(self.names[name])

    def drop(self, name: str) -> None:
        """Forget a block; its files stay until the name is written again."""
        if name in self.names:
            self.spark.sql(f"DROP TABLE IF EXISTS {self.names.pop(name)}")

    def close(self) -> None:
        for name in list(self.names):
            self.drop(name)


def drop_features(df: DataFrame, names: Iterable[str]) -> DataFrame:
    """Leave out the columns of a deny-list; unknown names are ignored."""
    return df.drop(*names)


def read_feature_list(spark: SparkSession, path: str) -> list[str]:
    """A deny-list kept as a text file of column names, one per line."""
    return [row[0].strip() for row in spark.read.text(path).collect() if row[0].strip()]
