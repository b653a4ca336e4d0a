"""Hand-computed small cases."""

import math

import pytest
from pyspark.sql import functions as F

from riskfeat.functions.scalars import composite_key, equal_width_bin, one_vs_rest, ordinal, with_relative_time
from riskfeat.functions.stats import BASIC, Stat, stats_of
from riskfeat.operators import behaviour, encoders, grouping, profile, scoring, sequences, sessions, vectors


def values(df, *columns):
    return [tuple(row[c] for c in columns) for row in df.collect()]


def events(spark, rows, columns="user_id string, timestamp long, seq long"):
    return spark.createDataFrame(rows, columns)


def test_relative_time(spark):
    df = with_relative_time(spark.createDataFrame([("12 days 05:06:07.000000000",)], "tm string"), "tm")
    assert values(df, "days_diff", "hour", "week", "timestamp") == [(12, 5, 5, 1055167)]


def test_session_gap(spark):
    df = sessions.sessionize(events(spark, [("a", t, i) for i, t in enumerate((0, 600, 1201, 1801))]))
    assert sorted(values(df, "timestamp", "session")) == [(0, 0), (600, 0), (1201, 1), (1801, 1)]
    assert values(sessions.session_gap_mean(df), "session_time_delta") == [(900.5,)]


def test_min_max_divides_by_the_maximum(spark):
    df = spark.createDataFrame([(1, 2), (2, 4), (3, 10)], "id int, x int")
    assert [x for (x,) in sorted(values(profile.min_max_scale(df, ["x"]), "x"))] == pytest.approx([0, 0.2, 0.8])


@pytest.mark.parametrize(
    "numbers, expected", [((1, 2, 10, 4), 1.469334548), ((1, 2), None), ((2, 2, 2), 0.0), ((1,), None)]
)
def test_adjusted_skew(spark, numbers, expected):
    df = spark.createDataFrame([("a", x) for x in numbers], "k string, x int")
    (got,) = values(grouping.grouped_stats(df, ["k"], [Stat("s", "skew", F.col("x"))]), "s")[0]
    assert got == (None if expected is None else pytest.approx(expected))


def test_std_of_one_row_is_null(spark):
    df = spark.createDataFrame([("a", 1)], "k string, x int")
    assert values(grouping.grouped_stats(df, ["k"], stats_of("x", ("std",), "x")), "x_std") == [(None,)]


def test_hours(spark):
    rows = [("a", h, 0, 0) for h in (0, 1, 6, 7)] + [("b", h, 0, 0) for h in (0, 7, 8)]
    df = spark.createDataFrame(rows, "user_id string, hour int, week int, days_diff int")
    share = grouping.grouped_stats(df, ["user_id"], behaviour.hour_share_stats())
    assert dict(values(share, "user_id", "hour_0_6_ratio"))["a"] == 0.5
    parts = grouping.grouped_stats(df, ["user_id"], behaviour.calendar_stats())
    assert dict(values(parts, "user_id", "time_period_0_cnt"))["b"] == 2
    assert dict(values(parts, "user_id", "time_period_3_cnt"))["b"] is None


def test_keys_and_ordinals(spark):
    df = spark.createDataFrame([("a", None, "level 12", None)], "x string, y string, o string, p string")
    got = df.select(composite_key("x", "y").alias("k"), ordinal(F.col("o")).alias("o"), ordinal(F.col("p")).alias("p"))
    assert values(got, "k", "o", "p") == [("a_nan", 12, -1)]


def test_province_bits(spark):
    df = spark.createDataFrame([(21,), (20,), (None,)], "province int")
    flags = one_vs_rest("province", (21, 26, 30, 20, 16))
    bits = sorted(v for (v,) in values(df.select(flags["binary_province"].alias("b")), "b"))
    assert bits == ["00000", "00010", "10000"]


def test_bins_are_half_open(spark):
    df = spark.createDataFrame([(0,), (9,), (10,), (99,), (100,)], "x int")
    got = df.select(equal_width_bin(F.col("x"), F.lit(0), F.lit(100)).alias("b"))
    assert [b for (b,) in values(got, "b")] == [0, 0, 1, 9, 9]


def test_pivot_fills_zero_and_window_gives_null(spark):
    df = spark.createDataFrame([("a", "v", 5, 3), ("b", "w", 7, 9)], "user_id string, c string, amount int, days_diff int")
    wide = grouping.pivot_stats(df, ["user_id"], "c", ["v", "w"], "amount")
    row = {r["user_id"]: r for r in wide.collect()}["a"]
    assert [row[f"c_w_amount_{k}"] for k in ("count", "sum", "mean", "max", "min", "median")] == [0] * 6
    late = grouping.grouped_stats(df, ["user_id"], grouping.trailing_stats("user_id", "days_diff", "amount", (5,), BASIC, "amount"))
    row = {r["user_id"]: r for r in late.collect()}["a"]
    assert [row[f"amount_{k}_5d"] for k in BASIC] == [None] * 6


def labelled(spark, rows):
    return spark.createDataFrame(rows, "user_id string, label int, fold int, v string")


def test_fold_encoding(spark):
    df = labelled(spark, [("a", 1, 0, "v"), ("b", 0, 0, "v"), ("c", 1, 1, "v"), ("t", None, None, "v"), ("d", 0, 1, "w")])
    got = dict(values(encoders.oof_encode(df, ["v"]), "user_id", "v_oof_mean"))
    assert got["a"] == got["b"] == 1.0
    assert got["c"] == 0.5
    assert got["t"] == pytest.approx(2 / 3)
    # "w" is unseen outside fold 1: the label mean of fold 0
    assert got["d"] == 0.5


def test_event_encoding(spark):
    people = spark.createDataFrame(
        [("a", 1, 0), ("b", 0, 0), ("c", 0, 1), ("t", None, None)], "user_id string, label int, fold int"
    )
    rows = [("a", "v")] * 3 + [("b", "v"), ("c", "v"), ("t", "v"), ("b", "only"), ("c", None)]
    log = spark.createDataFrame(rows, "user_id string, f string")
    by_row = dict(values(encoders.event_target_encode(log, people, ["f"]), "user_id", "f_te_mean"))
    by_user = dict(values(encoders.event_target_encode(log, people, ["f"], user_mean=True), "user_id", "f_te_mean"))
    assert by_row["c"] == 0.75 and by_user["c"] == 0.5
    assert by_row["t"] == 0.6 and by_user["t"] == pytest.approx(1 / 3)
    # fold 1 holds only the label 0; "only" is unseen there and drops out of b's mean
    assert by_row["b"] == 0.0


def test_weight_of_evidence(spark):
    rows = [(1, "v"), (1, "v"), (0, "v"), (1, "w"), (1, "w"), (0, "w"), (0, "w"), (0, "w")]
    df = spark.createDataFrame(rows, "label int, c string")
    got = dict(values(encoders.woe_table(df, "c", "label"), "c", "woe"))
    assert got["v"] == pytest.approx(math.log(2), abs=1e-5)


def test_bad_rate(spark):
    df = spark.createDataFrame([("x", 1), ("x", 0), ("x", 1)], "c string, label int")
    assert values(profile.bad_rate(df, "c", "label"), "total", "bad", "bad_rate") == [(3, 2, pytest.approx(2 / 3))]


def test_overlap_ignores_nulls(spark):
    rows = [("u", "trans", "a"), ("u", "trans", None), ("u", "op", None), ("u", "op", "b"), ("w", "trans", "a"), ("w", "op", "a")]
    df = spark.createDataFrame(rows, "user_id string, property string, ip string")
    assert dict(values(behaviour.resource_overlap(df, "ip"), "user_id", "if_ip_same")) == {"u": 0, "w": 1}


def test_first_and_last_at_a_tie(spark):
    columns = "user_id string, timestamp long, seq long, days_diff int, hour int, week int"
    trans = spark.createDataFrame([("u", 5, 9, 0, 0, 0)], columns)
    op = spark.createDataFrame([("u", 5, 1, 0, 0, 0)], columns)
    log = sessions.union_logs(trans, op, trans.columns)
    got = behaviour.first_last_behaviour(log)
    assert values(got, "first_behaviour", "last_behaviour", "last_time_trans") == [("trans", "op", 5)]


def test_words(spark):
    df = spark.createDataFrame([("ab,5,Cd_e f",)], "t string")
    assert values(df.select(vectors.words(F.col("t")).alias("w")), "w") == [(["ab", "cd_e"],)]


def test_auc_with_a_tie(spark):
    df = spark.createDataFrame([(0.1, 0), (0.4, 0), (0.4, 1), (0.8, 1)], "s double, y int")
    assert values(scoring.roc_auc(df, "s", "y"), "auc") == [(0.875,)]
    assert values(scoring.roc_auc(df, "s", "y", bucket_rows=1), "auc") == [(0.875,)]


def test_blend_ignores_the_scale_of_scores(spark):
    def blend(factor):
        rows = [(f"u{i}", "oof", "gbt", 1, "all", factor * s) for i, s in enumerate((0.2, 0.9, 0.4))]
        table = spark.createDataFrame(rows, "user_id string, split string, model string, seed int, feature_set string, score double")
        out = scoring.blend_scores(table, {"one": [scoring.Member("gbt", 1, "all", 1.0)]}, {"one": 0.7})
        return [b for (b,) in sorted(values(out, "blend"))]

    assert blend(1.0) == pytest.approx(blend(2.0))


def test_padding(spark):
    df = spark.createDataFrame([("a", [1, 2, 3]), ("b", [4]), ("c", None)], "user_id string, s array<int>")
    got = {r["user_id"]: (r["s"], r["seq_len"]) for r in sequences.pad_sequences(df, ["s"]).collect()}
    assert got == {"a": ([1, 2, 3], 3), "b": ([4, 0, 0], 1), "c": ([0, 0, 0], 1)}


def test_mode_and_fills(spark):
    df = spark.createDataFrame([(None, "x"), (None, None), (3.0, "y")], "n double, t string")
    got = sorted(values(profile.const_fill(df, -999, "-1"), "n", "t"))
    assert got == [(-999.0, "-1"), (-999.0, "x"), (3.0, "y")]
