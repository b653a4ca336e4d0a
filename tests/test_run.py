"""The run from input files to score files, on small made files."""

import csv
import glob

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, LongType, StructField, StructType
from risk_files import make_files

from riskfeat.operators import scoring
from riskfeat.plans import risk_features, risk_run
from riskfeat.sources.readers import column_types, read_inferred, read_risk_input, read_texts, read_with_rejects, split_labelled
from riskfeat.sources.sinks import read_feature_list, read_runs, read_scores, write_scores

SETTINGS = risk_features.RunSettings(
    folds=2,
    vector_tolerance=0.5,
    trees=scoring.TreeSettings(rounds=2, depth=3, step=0.3),
    runs={2020: ("all", "without_crosses"), 779: ("without_crosses",)},
    drop=("trans_hour_std",),
)
FAMILIES = {
    "full": [scoring.Member("gbt", 2020, "all", 1.0)],
    "lean": [scoring.Member("gbt", 2020, "without_crosses", 1.0)],
}


@pytest.fixture(scope="module")
def work(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("risk"))
    make_files(root)
    return root


@pytest.fixture(scope="module")
def source(spark, work):
    return read_risk_input(spark, work)


@pytest.fixture(scope="module")
def matrices(source, work):
    return risk_features.build_matrices(source, f"{work}/features", SETTINGS)


@pytest.fixture(scope="module")
def matrix(matrices):
    return matrices[2020]


def test_seeds_draw_their_own_folds(matrices):
    folds = [{r["user"]: r["fold"] for r in m.select("user", "fold").collect()} for m in matrices.values()]
    assert folds[0] != folds[1] and folds[0].keys() == folds[1].keys()


def test_input(source):
    known, unknown = split_labelled(source.profile)
    assert known.count() == 60 and unknown.count() == 20
    assert dict(source.trans.dtypes)["amount"] == "double"
    assert source.trans.where(F.col("timestamp").isNull()).count() == 0


def test_matrix(source, matrix):
    assert matrix.count() == 80
    assert matrix.select("user").distinct().count() == 80
    assert len(matrix.columns) == len(set(matrix.columns)) > 1200
    assert "trans_hour_std" not in matrix.columns
    numeric = scoring.feature_columns(matrix, risk_features.LABELS)
    assert set(matrix.columns) - set(numeric) == {"user", "label", "fold"}
    sums = {r["user"]: r["s"] for r in source.trans.groupBy("user").agg(F.sum("amount").alias("s")).collect()}
    for r in matrix.select("user", "amount_sum", "has_trans").collect():
        assert r["amount_sum"] == sums.get(r["user"])
        assert r["has_trans"] is not None


def test_scores_and_blend(spark, source, matrices, work):
    scores = risk_features.score_runs(matrices, SETTINGS)
    write_scores(scores, f"{work}/scores")
    stored = read_scores(spark, f"{work}/scores")
    assert stored.count() == 3 * 80
    aucs = risk_run.blend_and_write(stored, source.labels, f"{work}/out", FAMILIES, {"full": 0.7, "lean": 0.3})
    # the made labels follow one category, which out-of-fold trees must find
    assert all(r["auc"] > 0.6 for r in aucs.collect())
    for name in ("single", "averaged", "blended"):
        rows = [r for f in glob.glob(f"{work}/out/{name}/*.csv") for r in csv.DictReader(open(f))]
        assert len(rows) == 20 and set(rows[0]) == {"user", "prob"}


def test_sequence_inputs(source, work):
    rows = risk_features.sequence_inputs(source, f"{work}/sequences", folds=2).collect()
    assert len(rows) == 80
    longest = max(r["trans_seq_seq_len"] for r in rows)
    assert all(len(r["trans_seq_amount"]) == len(r["trans_seq_amount_te"]) == longest for r in rows)


def test_a_rerun_replaces_its_scores(spark, tmp_path):
    path = str(tmp_path / "scores")
    rows = [(f"u{i}", "oof", "gbt", seed, "all", i / 10) for i in range(6) for seed in (1, 2)]
    scores = spark.createDataFrame(rows, "user string, split string, model string, seed int, feature_set string, score double")
    write_scores(scores, path, "first")
    write_scores(scores, path, "first")
    assert read_scores(spark, path).count() == 12
    # another run replaces one seed with fewer users and leaves the other alone
    write_scores(scores.where("seed = 2 and user < 'u4'").withColumn("score", F.lit(1.0)), path, "second")
    stored = read_scores(spark, path)
    assert stored.groupBy("seed").count().orderBy("seed").collect() == [(1, 6), (2, 4)]
    assert {r["score"] for r in stored.where("seed = 2").collect()} == {1.0}
    assert {(r["run"], r["seed"], r["n_rows"]) for r in read_runs(spark, path).collect()} == {("first", 1, 6), ("first", 2, 6), ("second", 2, 4)}
    assert read_scores(spark, path, "second").count() == 4


def test_missing_texts_types_and_rejects(spark, tmp_path):
    (tmp_path / "t.csv").write_text(
        "user,age,ok,city,gap,code\n1,NaN,true,NA,,7\n2,3.5,False, null ,n/a,x7\n3, 4 ,TRUE,Rome,NA,8.0\n4,#N/A,,None,,9.5\n"
    )
    path = str(tmp_path / "t.csv")
    found = {r["column"]: (r["kind"], r["n_missing"]) for r in column_types(read_texts(spark, path)).collect()}
    assert found == {"user": ("long", 0), "age": ("double", 2), "ok": ("boolean", 1), "city": ("string", 3), "gap": ("none", 4), "code": ("string", 0)}
    rows = sorted(map(tuple, read_inferred(spark, path).collect()))
    assert rows == [(1, None, True, None, None, "7"), (2, 3.5, False, None, None, "x7"), (3, 4.0, True, "Rome", None, "8.0"), (4, None, None, None, None, "9.5")]
    schema = StructType([StructField("age", DoubleType()), StructField("code", LongType()), StructField("absent", LongType())])
    rows, rejects = read_with_rejects(spark, path, schema)
    assert sorted((r["user"], r["code"]) for r in rows.collect()) == [("1", 7), ("2", None), ("3", 8), ("4", None)]
    assert sorted((r["column"], r["kind"], r["text"]) for r in rejects.collect()) == [("code", "bigint", "9.5"), ("code", "bigint", "x7")]
    assert column_types(read_texts(spark, path).where("false")).where("kind <> 'none' or n_rows > 0").collect() == []


def test_deny_list_file(spark, tmp_path):
    (tmp_path / "drop.txt").write_text("a\n\nb\n")
    assert read_feature_list(spark, str(tmp_path / "drop.txt")) == ["a", "b"]


def test_numbers_in_files(spark, tmp_path):
    """Fractions, gaps and junk: nothing is lost without notice."""
    from riskfeat.sources.readers import BASE_SCHEMA, LABEL_SCHEMA, read_csv

    (tmp_path / "base.csv").write_text("user,age,province,sex\na,3.0,21.0,x\nb,12.5,,\nc, ,3,y\n")
    rows = read_csv(spark, str(tmp_path / "base.csv"), BASE_SCHEMA).collect()
    assert [tuple(r) for r in rows] == [("a", 3.0, 21, "x"), ("b", 12.5, None, None), ("c", None, 3, "y")]
    (tmp_path / "label.csv").write_text("user,label\na,1.0\nb,junk\nc,0.5\nd,0\n")
    rows = read_csv(spark, str(tmp_path / "label.csv"), LABEL_SCHEMA, rejected="bad").collect()
    assert [tuple(r) for r in rows] == [("a", 1, 0), ("b", None, 1), ("c", None, 1), ("d", 0, 0)]
    with pytest.raises(Exception, match="label cannot be junk"):
        read_csv(spark, str(tmp_path / "label.csv"), LABEL_SCHEMA).collect()
