from conftest import DATA
from pyspark.sql import Window
from pyspark.sql import functions as F

from riskfeat.operators.sessions import session_summary, sessionize
from riskfeat.plans import tables
from riskfeat.streaming.ordinals import streaming_ordinals
from riskfeat.streaming.sessions import streaming_amounts, streaming_sessions


def stream(spark, tmp_path):
    events = spark.read.parquet(f"{DATA}/events.parquet").withColumn("ts", F.date_trunc("second", "ts"))
    # a late last event moves the watermark past every session
    closing = events.limit(1).withColumn("ts", F.lit("2030-01-01").cast("timestamp")).withColumn("user_id", F.lit(-1).cast("long"))
    events = events.withColumn("ts", F.col("ts").cast("timestamp"))
    for i, part in enumerate((events, closing, closing)):
        part.write.parquet(f"{tmp_path}/in/{i}")
    schema = spark.read.parquet(f"{tmp_path}/in/0").schema
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/in/*")


def run(df, name, mode):
    query = df.writeStream.format("memory").queryName(name).outputMode(mode).start()
    try:
        query.processAllAvailable()
    finally:
        query.stop()
    return df.sparkSession.table(name)


def test_stream_sessions_equal_batch_sessions(spark, tmp_path):
    got = run(streaming_sessions(stream(spark, tmp_path), "ts", "user_id"), "stream_sessions", "append")
    batch = session_summary(sessionize(tables.logs(spark, DATA)))
    key = lambda rows: sorted((r[0], r[1]) for r in rows)
    mine = got.where("user_id >= 0").select("user_id", "n_rows").collect()
    assert key(mine) == key(batch.select("user_id", "n_rows").collect())


def test_stream_amounts(spark, tmp_path):
    got = run(streaming_amounts(stream(spark, tmp_path), "user_id", "value"), "stream_amounts", "complete")
    expected = spark.read.parquet(f"{DATA}/events.parquet").groupBy("user_id").count()
    rows = {r["user_id"]: r["amount_count"] for r in got.where("user_id >= 0").collect()}
    assert rows == {r["user_id"]: r["count"] for r in expected.collect()}


def ranked(events):
    purchase = F.col("event_type").eqNullSafe("purchase")
    return events.withColumn("rank", F.when(purchase, 0).otherwise(1))


def test_stream_ordinals_equal_batch_whatever_the_order_of_files(spark, tmp_path):
    events = ranked(spark.read.parquet(f"{DATA}/events.parquet")).withColumn("ts", F.date_trunc("second", "ts").cast("timestamp"))
    closing = events.limit(1).withColumn("ts", F.lit("2030-01-01").cast("timestamp")).withColumn("user_id", F.lit(-1).cast("long"))
    # every file holds rows of all days
    for i in range(3):
        events.where(F.pmod(F.xxhash64("event_id"), F.lit(3)) == i).coalesce(1).write.parquet(f"{tmp_path}/in/{i}")
    for i in (3, 4):
        closing.coalesce(1).write.parquet(f"{tmp_path}/in/{i}")
    reader = spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 1)
    numbered = streaming_ordinals(reader.parquet(f"{tmp_path}/in/*"), "ts", "user_id", "event_id", "rank", "60 days")
    got = run(numbered, "stream_ordinals", "append").where("user_id >= 0")
    order = Window.partitionBy("user_id").orderBy("timestamp", "property_rank", "seq")
    batch = sessionize(tables.logs(spark, DATA)).select(
        "user_id", "seq", "session", (F.row_number().over(order) - 1).alias("row_no"),
        (F.col("timestamp") - F.lag("timestamp").over(order)).alias("since_last"),
    )
    want = sorted(tuple(r) for r in batch.collect())
    assert sorted(tuple(r) for r in got.collect()) == want


def test_stream_ordinals_go_on_and_leave_late_rows_out(spark, tmp_path):
    batches = ([(1, 0), (2, 100)], [(3, 20_000)], [(5, 20_300)], [(4, 50), (6, 90_000)], [(7, 200_000)], [(8, 300_000)])
    for i, batch in enumerate(batches):
        df = spark.createDataFrame(batch, "event_id long, s long").withColumn("user_id", F.lit("u"))
        df = df.withColumn("ts", F.timestamp_seconds(F.col("s") + 1_700_000_000))
        df.coalesce(1).write.parquet(f"{tmp_path}/in/{i}")
    schema = spark.read.parquet(f"{tmp_path}/in/0").schema
    rows = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/in/*")
    got = run(streaming_ordinals(rows, "ts", "user_id", "event_id"), "stream_late", "append").collect()
    want = [(1, 0, 0, None), (2, 0, 1, 100), (3, 1, 2, 19_900), (5, 1, 3, 300), (6, 2, 4, 69_700), (7, 3, 5, 110_000)]
    assert sorted(tuple(r)[1:] for r in got)[: len(want)] == want
    assert 4 not in {r["seq"] for r in got}
