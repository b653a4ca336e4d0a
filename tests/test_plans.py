"""Physical plans: native operators, pushed filters, no joins of all with all."""

import math
import threading
from collections import Counter

import pytest
from conftest import DATA
from pyspark.sql import functions as F

from riskfeat.operators import popularity, sequences, vectors
from riskfeat.plans import tables
from riskfeat.plans.feature_matrix import assemble, star_matrix
from riskfeat.plans.queries import REGISTRY
from riskfeat.sources.sinks import BlockStore

CORE = [
    "user_amount_stats", "trailing_day_stats", "user_nunique", "popularity_user_stats", "sessionize",
    "first_last_behaviour", "pairwise_cross", "oof_mean_encode", "event_target_encode", "tfidf_weights", "roc_auc",
]


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", CORE)
def test_no_python_and_no_cross_product(spark, name):
    text = plan(REGISTRY[name](spark, DATA))
    for unwanted in ("PythonUDF", "ArrowEval", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert unwanted not in text


def test_filters_and_columns_reach_the_scan(spark):
    text = plan(tables.purchases(spark, DATA).select("user_id", "amount"))
    assert "EqualTo(event_type,purchase)" in text
    assert "props" not in text.split("ReadSchema")[1]


def test_first_events_are_limited_before_the_shuffle(spark):
    text = plan(sequences.first_events(tables.logs(spark, DATA), 50))
    assert text.count("WindowGroupLimit") >= 2


def test_stored_blocks_join_without_a_shuffle(spark, tmp_path):
    store = BlockStore(spark, str(tmp_path), "user_id", 4)
    users = tables.profile(spark, DATA).select("user_id", "label")
    orders = tables.commerce(spark, DATA)
    blocks = [orders.groupBy("user_id").agg(F.count("seq").alias(f"n{i}"), F.sum("amount").alias(f"s{i}")) for i in range(6)]
    wide = assemble(store.put("users", users), [store.put(f"b{i}", b) for i, b in enumerate(blocks)])
    text = plan(wide)
    assert "Exchange" not in text and text.count("SortMergeJoin") == 6
    assert sorted(map(tuple, wide.collect())) == sorted(map(tuple, assemble(users, blocks).collect()))
    # a block that is written again takes the place of the old one
    again = store.put("b0", blocks[0].withColumn("n0", F.lit(7)))
    assert {r["n0"] for r in again.collect()} == {7}
    store.close()
    assert not [t for t in spark.catalog.listTables() if t.name.startswith("riskfeat_")]


def test_blocks_are_written_side_by_side_and_leave_no_names(spark, tmp_path, monkeypatch):
    barrier, put = threading.Barrier(2, timeout=120), BlockStore.put
    monkeypatch.setattr(BlockStore, "put", lambda *a: (barrier.wait(), put(*a))[1])
    store = BlockStore(spark, str(tmp_path), "user_id", 2)
    first, second = store.put_all({n: spark.range(5).select(F.col("id").alias("user_id"), F.lit(n).alias(n)) for n in "ab"})
    wide = assemble(first, [second])
    store.close()
    assert [r.asDict() for r in wide.orderBy("user_id").collect()] == [{"user_id": i, "a": "a", "b": "b"} for i in range(5)]


def test_matrix_of_blocks_is_assembled_without_a_shuffle(spark):
    assert "Exchange" not in plan(star_matrix(spark, DATA))


def test_shared_resources_are_dealt_out_by_value_and_by_user_only(spark):
    rows = [(u % 5, u % 7, u * 3 % 11 if u % 4 else None, u % 3) for u in range(60)] + [(None, 1, 1, 9), (1, None, 2, 0)]
    df = spark.createDataFrame(rows, "user_id long, days_diff int, a int, b int").repartition(3)
    for pairs_of in (False, True):
        found = popularity.shared_resource_stats(df, ("a", "b"), pairs_of=pairs_of)
        # the rows of the test are dealt out themselves
        assert plan(found).count("Exchange hashpartitioning") == 2
        parts = popularity.shared_resource_stats(df, ("a", "b"), pairs_of=pairs_of, hot_rows=1)
        rounded = [sorted(tuple(round(x, 9) if isinstance(x, float) else x for x in r) for r in f.collect()) for f in (found, parts)]
        assert rounded[0] == rounded[1] and len(rounded[0]) == 5


def test_term_weights_move_texts_and_rare_terms_only(spark, monkeypatch):
    texts = ["aa bb bb cc", "bb cc dd", "cc", None, "", "aa ee ee ee " + "x" * 300]
    docs = spark.createDataFrame([(i // 2, t) for i, t in enumerate(texts)] + [(None, "aa")], "doc_id long, text string")

    def weights(hot_rows=None):
        counts = vectors.term_counts(docs, "doc_id", "text", hot_rows)
        return vectors.tfidf_weights(counts, "doc_id", vectors.document_count(docs, "doc_id"), hot_rows)

    words = {d: Counter(w for t in texts[2 * d : 2 * d + 2] for w in ("nan" if t is None else t).split()) for d in range(3)}
    raw = {(d, w): n * (math.log(4 / (1 + sum(w in c for c in words.values()))) + 1) for d, c in words.items() for w, n in c.items()}
    want = {k: x / math.sqrt(sum(y * y for (d, _), y in raw.items() if d == k[0])) for k, x in raw.items()}
    for common, hot_rows in ((200_000, None), (2, None), (2, 1)):
        monkeypatch.setattr(vectors, "COMMON_TERMS", common)
        found = {(r["doc_id"], r["term"]): r["weight"] for r in weights(hot_rows).collect()}
        assert found == pytest.approx(want)
    monkeypatch.undo()
    short = docs.where("length(text) < 300")
    counts = vectors.term_counts(short, "doc_id", "text")
    text = plan(vectors.tfidf_weights(counts, "doc_id", F.lit(3)))
    assert text.count("Exchange hashpartitioning") == 1 and "SortMergeJoin" not in text


def test_user_statistics_shuffle_once(spark):
    text = plan(REGISTRY["user_amount_stats"](spark, DATA))
    assert text.count("Exchange hashpartitioning") == 1
