"""Every registered query against its SQL, also with nearly every key treated as hot."""

import pytest
from compare import differences, duck
from conftest import DATA

import __spark_entry__ as contract
from riskfeat.plans.oracle import oracle
from riskfeat.plans.queries import REGISTRY

# the queries of the optional subpackage have tests of their own
QUERIES, SQL = {name: f for name, f in contract.queries().items() if name in REGISTRY}, oracle()
ROWS_ONLY = {
    "countvec_svd", "tfidf_svd", "value_word2vec", "user_doc_embedding", "gbt_oof_scores",
    "feature_set_ablation",
}
HOT = [
    "user_amount_stats", "amount_rate_stats", "session_amount_stats", "pivot_property_days", "value_user_popularity",
    "popularity_user_stats", "shared_resource_stats", "sessionize", "time_to_next", "label_encode",
    "stratified_folds", "oof_mean_encode", "ordered_target", "event_target_encode", "event_target_encode_rows",
    "user_sequences", "user_tfidf_weights", "roc_auc",
]


@pytest.fixture(scope="module")
def con():
    return duck(DATA)


def test_only_learned_outputs_lack_sql():
    assert set(REGISTRY) - set(oracle()) == ROWS_ONLY


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(spark, con, name):
    assert differences(QUERIES[name](spark, DATA), con, SQL[name]) == []


@pytest.mark.parametrize("name", HOT)
def test_hot_route_equals_sql(spark, con, hot_keys_everywhere, name):
    assert differences(QUERIES[name](spark, DATA), con, SQL[name]) == []


def test_comparison_notices_a_difference(spark, con):
    wrong = SQL["user_nonnull_count"].replace("count(k7) AS k7_cnt", "count(k7) + 1 AS k7_cnt")
    assert differences(QUERIES["user_nonnull_count"](spark, DATA), con, wrong)


def test_flagship(spark):
    rows = contract.entry(spark).collect()
    assert len(rows) == 150
