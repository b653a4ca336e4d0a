"""Brute-force checks on random data."""

import dataclasses
import random
import threading
from collections import Counter

import numpy as np
import pytest
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from riskfeat.functions.stats import Stat, stats_of
from riskfeat.operators import encoders, grouping, ordered, profile, scoring, skew, vectors
from riskfeat.plans import feature_matrix, queries


def test_leave_fold_out_equals_refits(spark):
    rng = random.Random(3)
    people = [(f"u{i}", rng.choice([0, 1, None]), rng.choice("abc")) for i in range(60)]
    rows = [(u, y, None if y is None else i % 4, v) for i, (u, y, v) in enumerate(people)]
    df = spark.createDataFrame(rows, "user_id string, label int, fold int, v string")
    got = {r["user_id"]: r["v_oof_mean"] for r in encoders.oof_encode(df, ["v"]).collect()}
    for u, y, fold, v in rows:
        train = [r for r in rows if r[1] is not None and r[2] != fold]
        same = [r[1] for r in train if r[3] == v] or [r[1] for r in train]
        assert got[u] == pytest.approx(sum(same) / len(same))


@pytest.mark.parametrize("limit", [1, 7, 10**6])
def test_quantiles_of_a_hot_key(spark, limit):
    rng = random.Random(limit)
    numbers = {"hot": [rng.lognormvariate(3, 4) for _ in range(300)] + [1e15, 1e200], "cold": [2.0, 9.0], "flat": [5.0] * 40}
    numbers["halves"] = [float(i) for i in range(50)] + [1e200 + 1e190 * i for i in range(50)]
    df = spark.createDataFrame([(k, x) for k, xs in numbers.items() for x in xs], "k string, x double")
    stats = stats_of("x", ("median", "q1", "q3", "count"), "x")
    for r in grouping.grouped_stats(df, ["k"], stats, hot_rows=limit).collect():
        xs = numbers[r["k"]]
        expected = [np.quantile(xs, q) for q in (0.5, 0.25, 0.75)]
        assert [r["x_median"], r["x_q1"], r["x_q3"]] == pytest.approx(expected)
        assert r["x_count"] == len(xs)


@pytest.mark.parametrize("limit", [1, 10**6])
def test_weighted_median(spark, limit):
    df = spark.createDataFrame([("k", 1.0, 3), ("k", 2.0, 1), ("k", 9.0, 2)], "k string, x double, w long")
    (row,) = grouping.grouped_stats(df, ["k"], [Stat("m", "median", F.col("x"), weight=F.col("w"))], limit).collect()
    assert row["m"] == np.median([1, 1, 1, 2, 9, 9])


@pytest.mark.parametrize("limit", [1, 10, 10**6])
def test_global_running(spark, limit):
    rng = random.Random(5)
    keys = rng.sample(range(10000), 400)
    df = spark.createDataFrame([(k, k % 7) for k in keys], "k int, x int")
    got = {r["k"]: r["t"] for r in ordered.global_running(df, ["k"], {"t": F.col("x")}, bucket_rows=limit).collect()}
    total = 0
    for k in sorted(keys):
        total += k % 7
        assert got[k] == total
    # pruned and filtered plans must bind as well
    pruned = ordered.dense_codes(df.select("k").distinct(), ["k"], "code")
    assert pruned.where(F.col("code") >= 100).select("code").count() == 300


@pytest.mark.parametrize("limit", [3, 10**6])
def test_neighbours_and_sums_across_chunks(spark, limit):
    rng = random.Random(9)
    rows = [(rng.choice("ab"), rng.randrange(50), i, rng.randrange(5)) for i in range(120)]
    df = spark.createDataFrame(rows, "k string, t long, seq long, x int")
    order = ordered.Ordering(("k",), "t", ("seq",))

    def step(part, chunked):
        near = ordered.neighbour(part, order, {"before": "x"}, chunked)
        near = ordered.neighbour(near, order, {"after": "x"}, chunked, ahead=True)
        return ordered.running_sums(near, order, {"total": F.col("x")}, chunked)

    got = {r["seq"]: (r["before"], r["after"], r["total"]) for r in ordered.per_key_ordered(df, order, step, limit).collect()}
    for key in "ab":
        mine = sorted((r for r in rows if r[0] == key), key=lambda r: (r[1], r[2]))
        xs = [r[3] for r in mine]
        for i, r in enumerate(mine):
            expected = (xs[i - 1] if i else None, xs[i + 1] if i + 1 < len(xs) else None, sum(xs[: i + 1]))
            assert got[r[2]] == expected


@pytest.mark.parametrize("limit", [2, 10**6])
def test_lookup_join(spark, limit):
    rows = [(i, v) for i, v in enumerate(["a"] * 10 + ["b", None, None, "zz"])]
    left = spark.createDataFrame(rows, "id int, v string")
    dim = spark.createDataFrame([("a", 1, 10), ("b", 2, 1), ("c", 3, 0)], "v string, y int, n long")
    got = {r["id"]: r["y"] for r in skew.lookup_join(left, dim, ["v"], "n", limit).collect()}
    assert got == {i: {"a": 1, "b": 2}.get(v) for i, v in rows}
    hot = skew.hot_keys(left, ["v"], limit)
    got = {r["id"]: r["y"] for r in skew.lookup_join(left, dim, ["v"], hot, limit, inner=True).collect()}
    assert got == {i: {"a": 1, "b": 2}[v] for i, v in rows if v in ("a", "b")}


def test_weighted_std_of_large_numbers(spark):
    rows = [("a", 1e9 + i, 1) for i in range(3)] + [("b", 2.5, 2), ("b", 3.5, 2), ("c", 7.0, 1)]
    df = spark.createDataFrame(rows, "k string, x double, w long")
    got = {r["k"]: r["s"] for r in grouping.grouped_stats(df, ["k"], [Stat("s", "std", F.col("x"), weight=F.col("w"))]).collect()}
    assert got["a"] == 1.0 and got["c"] is None
    assert got["b"] == pytest.approx(np.std([2.5, 2.5, 3.5, 3.5], ddof=1))


@pytest.mark.parametrize("limit", [4, 10**6])
def test_missing_times_and_bursts(spark, limit):
    """A key's sessions do not depend on whether it counts as hot: NULL times, one burst, NULL users."""
    from riskfeat.operators import sessions

    rng = random.Random(17)
    rows = [(rng.choice(["a", "b", None]), rng.choice([None, 5, 5, 5, 5000, 9000]), i, float(i % 3)) for i in range(150)]
    df = spark.createDataFrame(rows, "user_id string, timestamp long, seq long, amount double")
    got = {r["seq"]: r["session"] for r in sessions.sessionize(df, hot_rows=limit).collect()}
    gaps = {r["seq"]: r["time_diff"] for r in sessions.amount_rate(df, hot_rows=limit).collect()}
    for user in ("a", "b", None):
        mine = sorted((r for r in rows if r[0] == user), key=lambda r: (r[1] is not None, r[1] or 0, r[2]))
        session = 0
        for i, r in enumerate(mine):
            before = mine[i - 1][1] if i else None
            session += r[1] is not None and before is not None and r[1] - before > 600
            assert got[r[2]] == session
            after = mine[i + 1][1] if i + 1 < len(mine) else None
            assert gaps[r[2]] == (None if r[1] is None or after is None else r[1] - after)


def test_svd_spans_the_right_space(spark):
    rng = np.random.default_rng(1)
    dense = rng.integers(0, 4, size=(30, 12)).astype(float)
    rows = [(f"u{i}", f"term{j:02d}", float(dense[i, j])) for i in range(30) for j in range(12) if dense[i, j]]
    df = spark.createDataFrame(rows, "user_id string, term string, weight double")
    out = {r[0]: np.array(r[1:]) for r in vectors.truncated_svd(df, "user_id", "svd", k=4).collect()}
    got = np.stack([out[f"u{i}"] for i in range(30)])
    _, s, vt = np.linalg.svd(dense, full_matrices=False)
    expected = dense @ vt[:4].T
    assert np.allclose(np.abs(got), np.abs(expected), atol=1e-6)
    assert np.allclose(np.linalg.norm(got, axis=0), s[:4])


def test_sentences_keep_order_and_overlap(spark, monkeypatch):
    monkeypatch.setattr(vectors, "SENTENCE_WORDS", 4)
    monkeypatch.setattr(vectors, "CONTEXT_WORDS", 2)
    rows = [("u", t, t, f"w{t}") for t in range(10)]
    df = spark.createDataFrame(rows, "user_id string, timestamp long, seq long, v string")
    found = sorted(r["sentence"] for r in vectors.value_sentences(df, "v").collect())
    assert found == [[f"w{i}" for i in span] for span in (range(0, 6), range(4, 10), range(8, 10))]


def test_svd_says_how_far_off_it_is(spark):
    rng = np.random.default_rng(2)
    dense = rng.normal(size=(60, 40))
    rows = [(f"u{i}", f"term{j:02d}", float(dense[i, j])) for i in range(60) for j in range(40)]
    df = spark.createDataFrame(rows, "user_id string, term string, weight double")
    loose, tight = (vectors.singular_projection(df, "user_id", 3, 2, tolerance, most=40) for tolerance in (0.5, 1e-2))
    assert loose.rounds < tight.rounds < 40 and (tight.residuals <= 1e-2).all() and (loose.residuals > 0.1).any()
    true = np.linalg.svd(dense)[1]
    # within a residual of each value found there is a true one
    assert (np.abs(tight.values - true[:3]) <= tight.residuals * true[0]).all()


def test_neighbour_counts_are_those_of_all_pairs(spark, monkeypatch):
    monkeypatch.setattr(vectors, "SENTENCE_WORDS", 7)
    rng = np.random.default_rng(3)
    lists = {f"u{i}": [f"w{x}" for x in rng.integers(0, 6, rng.integers(1, 40))] for i in range(5)}
    rows = [(u, t, t, w) for u, words in lists.items() for t, w in enumerate(words)]
    df = spark.createDataFrame(rows, "user_id string, timestamp long, seq long, v string").repartition(3)
    got = {(r["value"], r["term"]): round(10 * r["weight"]) for r in vectors.neighbour_counts(vectors.value_sentences(df, "v")).collect()}
    want = Counter()
    for words in lists.values():
        for a in range(len(words)):
            for b in range(a + 1, min(len(words), a + 11)):
                want[words[a], words[b]] += 11 - (b - a)
                want[words[b], words[a]] += 11 - (b - a)
    assert got == want


def test_value_vectors_have_the_neighbours_of_a_skip_gram_model(spark):
    from pyspark.ml.feature import Word2Vec

    rng = np.random.default_rng(4)
    # ten values that go together, four times
    lists = [[f"w{11 * g + x}" for x in rng.integers(0, 11, 60)] for g in range(4) for _ in range(15)]
    rows = [(f"u{i}", t, t, w) for i, words in enumerate(lists) for t, w in enumerate(words)]
    df = spark.createDataFrame(rows, "user_id string, timestamp long, seq long, v string")

    def near(found):
        unit = {w: np.array(v) / np.linalg.norm(v) for w, v in found.items()}
        return {w: set(sorted(unit.keys() - {w}, key=lambda x: -(unit[x] @ v))[:10]) for w, v in unit.items()}

    got = near({r["value"]: r["vector"] for r in vectors.value_vectors(df, "v", size=8).collect()})
    sentences = vectors.value_sentences(df, "v")
    model = Word2Vec(vectorSize=8, windowSize=10, minCount=1, maxIter=20, stepSize=0.1, seed=1, inputCol="sentence", outputCol="x").fit(sentences)
    want = near({r["word"]: r["vector"].toArray() for r in model.getVectors().collect()})
    assert got.keys() == want.keys()
    assert sum(len(got[w] & want[w]) for w in want) / (10 * len(want)) >= 0.9


def test_best_round_is_that_of_all_prefixes(spark):
    rng = np.random.default_rng(5)
    x = rng.normal(size=(400, 3))
    y = (x[:, 0] + x[:, 1] ** 2 + rng.normal(size=400) > 1).astype(int)
    df = spark.createDataFrame([(i, int(y[i]), i % 2, *map(float, x[i])) for i in range(400)], "user_id int, label int, fold int, a double, b double, c double")
    settings = scoring.TreeSettings(rounds=14, patience=3, depth=2, step=0.3)
    scores, models = scoring.trained_folds(df, ["a", "b", "c"], 2, settings)
    for fold, found in enumerate(models):
        aucs = []
        for rounds in range(1, settings.rounds + 1):
            features = VectorAssembler(inputCols=["a", "b", "c"], outputCol="features").transform(df.withColumn("label", F.col("label").cast("double")))
            model = scoring._boost(features.where(f"fold <> {fold}"), rounds, settings)
            held = model.transform(features.where(f"fold = {fold}")).select("user_id", "label", vector_to_array("probability")[1].alias("s"))
            aucs.append(scoring.roc_auc(held, "s", "label").head()["auc"])
            if rounds == found.best_round:
                mine = {r["user_id"]: r["score"] for r in scores.where("split = 'oof'").collect()}
                assert all(abs(mine[r["user_id"]] - r["s"]) < 1e-9 for r in held.collect())
        best = 0
        for i, auc in enumerate(aucs):
            if i - best >= settings.patience:
                break
            best = i if auc > aucs[best] else best
        assert found.best_round == best + 1 and found.auc == pytest.approx(aucs[best])


def test_auc_of_random_scores(spark):
    rng = random.Random(11)
    rows = [(rng.randrange(40) / 40, rng.randrange(2)) for _ in range(300)]
    df = spark.createDataFrame(rows, "s double, y int")
    bad = [s for s, y in rows if y]
    good = [s for s, y in rows if not y]
    expected = sum((b > g) + 0.5 * (b == g) for b in bad for g in good) / (len(bad) * len(good))
    for limit in (3, 10**6):
        (row,) = scoring.roc_auc(df, "s", "y", bucket_rows=limit).collect()
        assert row["auc"] == pytest.approx(expected)


def test_factorize_and_label_codes(spark):
    df = spark.createDataFrame([(1, "b"), (2, None), (3, "a"), (4, "b")], "id int, c string")
    got = {r["id"]: r["c_code"] for r in profile.factorize(df, "c", ["id"]).collect()}
    assert got == {1: 0, 2: -1, 3: 1, 4: 0}
    got = {r["id"]: r["c"] for r in profile.label_encode(df, ["c"]).collect()}
    assert got == {1: 2, 2: 0, 3: 1, 4: 2}


def test_every_category_is_listed(spark):
    df = spark.range(5000).select(F.lpad(F.col("id").cast("string"), 4, "0").alias("c"))
    assert grouping.category_values(df, "c") == [f"{i:04}" for i in range(5000)]


@pytest.fixture()
def small_matrix(spark):
    rows = [(i, i % 3 % 2 if i % 7 else None, i % 2, float(i % 11), float(i * i % 13) if i % 5 else None) for i in range(200)]
    return spark.createDataFrame(rows, "user_id long, label int, fold int, a double, b double")


def test_folds_are_fitted_side_by_side_over_vectors_built_once(small_matrix, monkeypatch):
    barrier, built = threading.Barrier(4, timeout=120), []
    fit, build = scoring.boost_to_best_round, scoring.feature_vector
    # every fit waits until those of both seeds and folds have begun
    monkeypatch.setattr(scoring, "boost_to_best_round", lambda *a: (barrier.wait(), fit(*a))[1])
    monkeypatch.setattr(scoring, "feature_vector", lambda names: (built.append(list(names)), build(names))[1])
    settings = scoring.TreeSettings(rounds=2, depth=2, step=0.1)
    got = scoring.ablation_scores(small_matrix, {"all": ["a", "b"], "one": ["a"]}, (1, 2), 2, settings)
    assert built == [["a", "b"], ["a"]]
    monkeypatch.undo()
    want = [
        scoring.gbt_oof_scores(small_matrix, f, 2, dataclasses.replace(settings, seed=s), feature_set=n)
        for n, f in {"all": ["a", "b"], "one": ["a"]}.items() for s in (1, 2)
    ]
    assert sorted(map(tuple, got.collect())) == sorted(tuple(r) for w in want for r in w.collect())


def test_the_ablation_boosts_full_size_trees(spark, small_matrix, monkeypatch):
    asked = []

    def trained(matrix, features, k, runs, roles):
        asked.append((k, list(runs)))
        return [(matrix.select("user_id", F.lit("oof").alias("split"), F.lit(0.5).alias("score")), [])] * len(runs)

    monkeypatch.setattr(scoring, "trained_runs", trained)
    monkeypatch.setattr(feature_matrix, "star_matrix", lambda *_: small_matrix)
    queries.feature_set_ablation(spark, "")
    full = scoring.TreeSettings(rounds=5000, patience=100, depth=8, step=0.02)
    assert asked == [(5, [dataclasses.replace(full, seed=s) for s in (2020, 779)])] * 3


def test_feature_vectors_are_those_of_an_assembler(small_matrix):
    got = small_matrix.select("user_id", vector_to_array(scoring.feature_vector(["a", "b"])).alias("x")).collect()
    filled = VectorAssembler(inputCols=["a", "b"], outputCol="v").transform(small_matrix.na.fill(scoring.MISSING, ["a", "b"]))
    assert got == filled.select("user_id", vector_to_array("v").alias("x")).collect()
    odd = small_matrix.withColumn("a", F.lit(float("nan"))).select(scoring.feature_vector(["a", "b"]).alias("v"))
    with pytest.raises(Exception, match="not a number"):
        odd.collect()
