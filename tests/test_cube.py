"""Statistics in parts: every form agrees, days are added without touching others, categories without a limit."""

import math
from pathlib import Path

import pytest
from conftest import DATA
from pyspark.sql import functions as F

from riskfeat.functions import states
from riskfeat.functions.states import Figure, figures_of, merged_stats
from riskfeat.operators.categories import category_vectors, sparse_one_hot, sparse_pivot
from riskfeat.operators.cube import DayCube
from riskfeat.plans import tables

ROWS = [("a", d, h, float(x)) for d in range(4) for h in (1, 7) for x in range(d + 1)] + [
    ("b", 0, 3, None), ("b", 2, 3, 5.0), (None, 1, 1, 9.0), ("c", None, 1, 9.0), ("d", 3, None, 2.5),
]
FIGURES = figures_of("x", ("count", "sum", "mean", "std", "min", "max"), "x")


@pytest.fixture()
def rows(spark):
    return spark.createDataFrame(ROWS, "user string, day int, hour int, x double")


@pytest.fixture()
def own_statistic(monkeypatch):
    """A part and a statistic that the library does not have."""
    monkeypatch.setattr(states, "PARTS", dict(states.PARTS))
    monkeypatch.setattr(states, "STATISTICS", dict(states.STATISTICS))
    monkeypatch.setattr("riskfeat.operators.cube.PARTS", states.PARTS)
    states.register_part("cubes", lambda x, w: F.sum(x * x * x if w is None else x * x * x * w), F.sum)
    states.register_statistic("third", ("n", "cubes"), lambda p: p["cubes"] / p["n"])
    return [Figure("third", "third", "x")]


def by_key(df):
    return {r[0]: tuple(r)[1:] for r in df.collect()}


def third(values):
    return sum(v**3 for v in values) / len(values)


def test_own_statistic_in_every_form(spark, rows, own_statistic, tmp_path):
    known = rows.where("user = 'a'")
    want = {"a": pytest.approx((third([r[3] for r in ROWS if r[0] == "a"]),))}
    assert by_key(merged_stats(known, ["user"], own_statistic)) == want
    assert by_key(merged_stats(known, ["user"], own_statistic, salts=3)) == want
    counted = known.groupBy("user", "x").agg(F.count("*").alias("w"))
    assert by_key(merged_stats(counted, ["user"], own_statistic, weight="w")) == want
    cube = DayCube(spark, f"{tmp_path}/cube", ["user"], "day", ["hour"], own_statistic).add(known)
    assert by_key(cube.roll_up(own_statistic)) == want
    for i in range(2):
        known.where(F.col("day") % 2 == i).write.parquet(f"{tmp_path}/in/{i}")
    stream = spark.readStream.schema(known.schema).option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/in/*")
    query = (
        merged_stats(stream, ["user"], own_statistic)
        .writeStream.format("memory").queryName("own_statistic").outputMode("complete").start()
    )
    try:
        query.processAllAvailable()
    finally:
        query.stop()
    assert by_key(spark.table("own_statistic")) == want


def test_names_are_declared_once():
    with pytest.raises(ValueError):
        states.register_part("n", F.count, F.sum)
    with pytest.raises(ValueError):
        states.register_statistic("mean", ("n",), lambda p: p["n"])
    with pytest.raises(ValueError):
        states.register_statistic("new", ("no such part",), lambda p: p["n"])


def test_cube_equals_rows(spark, rows, tmp_path):
    late = figures_of("x", ("count", "mean", "std"), "late", F.col("day") > 1, absent_is_null=True)
    cube = DayCube(spark, f"{tmp_path}/cube", ["user"], "day", ["hour"], FIGURES)
    cube.add(rows.where("day < 2")).add(rows.where("day >= 2"))
    present = rows.where("user IS NOT NULL AND day IS NOT NULL")
    want = by_key(merged_stats(present, ["user"], FIGURES))
    got = by_key(cube.roll_up(FIGURES))
    assert set(got) == set(want) == {"a", "b", "d"}
    for k in want:
        assert got[k] == pytest.approx(want[k])
    assert by_key(cube.roll_up(late))["b"] == (1, 5.0, None)
    after = [r[3] for r in ROWS if r[0] == "a" and r[1] > 1]
    mean = sum(after) / len(after)
    spread = math.sqrt(sum((x - mean) ** 2 for x in after) / (len(after) - 1))
    assert by_key(cube.roll_up(late))["a"] == pytest.approx((len(after), mean, spread))


def test_a_day_is_added_alone_and_again(spark, rows, tmp_path):
    cube = DayCube(spark, f"{tmp_path}/cube", ["user"], "day", ["hour"], FIGURES)
    cube.add(rows.where("day < 3"))
    before = {p: p.stat().st_mtime_ns for p in Path(f"{tmp_path}/cube").rglob("*.parquet")}
    cube.add(rows.where("day = 3"))
    once = by_key(cube.roll_up(FIGURES))
    assert all(p.exists() and p.stat().st_mtime_ns == t for p, t in before.items())
    cube.add(rows.where("day = 3"))
    assert by_key(cube.roll_up(FIGURES)) == once
    days = cube.roll_up(FIGURES, where=F.col("day") == 3)
    plan = days._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(day" in plan
    assert cube.add(rows.where("day > 100")).roll_up(FIGURES).count() == 3


def test_empty_cube(spark, rows, tmp_path):
    cube = DayCube(spark, f"{tmp_path}/cube", ["user"], "day", ["hour"], FIGURES).add(rows.where("false"))
    assert cube.roll_up(FIGURES).count() == 0


def test_sketches_merge(spark, tmp_path):
    n = 50_000
    rows = spark.range(n).select(F.lit("k").alias("k"), (F.col("id") % 9).cast("int").alias("day"), F.col("id").alias("v"))
    figures = [Figure("n", "about_nunique", "v"), Figure("t", "theta_nunique", "v"), Figure("m", "about_median", "v")]
    cube = DayCube(spark, f"{tmp_path}/cube", ["k"], "day", [], figures).add(rows)
    for df in (cube.roll_up(figures), merged_stats(rows, ["k"], figures), merged_stats(rows, ["k"], figures, salts=4)):
        row = df.head()
        assert abs(row["n"] - n) <= states.HLL_ERROR * n
        assert abs(row["t"] - n) <= states.THETA_ERROR * n
        assert abs(row["m"] / n - 0.5) <= states.KLL_ERROR
    none = rows.withColumn("v", F.lit(None).cast("long"))
    assert tuple(merged_stats(none, ["k"], figures).head())[1:] == (0, 0, None)
    with pytest.raises(ValueError):
        merged_stats(rows, ["k"], figures, weight="day")


def test_any_number_of_categories(spark):
    n = 100_000
    df = spark.range(n).select("id", F.concat(F.lit("c"), "id").alias("c"), F.lit("x").alias("d"))
    ids = sparse_one_hot(df, "id", ["c", "d"])
    assert ids.agg(F.count_distinct("ids"), F.max(F.element_at("ids", 2)), F.min(F.size("ids"))).head() == (n, n, 2)
    wide = sparse_pivot(df.withColumn("u", F.col("id") % 3), ["u"], "c", figures_of("id", ("sum",), "id"))
    vectors = category_vectors(wide, ["u"], "c", "id_sum")
    sizes = vectors.select(F.size("vector").alias("n"), F.element_at("vector", F.concat(F.lit("c"), "u")).alias("own"), "u")
    assert sorted(tuple(r) for r in sizes.collect()) == [(33_333, 1, 1), (33_333, 2, 2), (33_334, 0, 0)]


def test_rows_without_categories(spark):
    df = spark.createDataFrame([(1, "a", None), (2, None, None), (3, "a", "b")], "id long, c string, d string")
    assert by_key(sparse_one_hot(df, "id", ["c", "d"])) == {1: ([0],), 2: ([],), 3: ([0, 1],)}


def test_real_log_salted(spark):
    log = tables.purchases(spark, DATA)
    figures = figures_of("amount", ("count", "sum", "mean", "std"), "amount")
    assert by_key(merged_stats(log, ["user_id"], figures)) == by_key(merged_stats(log, ["user_id"], figures, salts=5))
