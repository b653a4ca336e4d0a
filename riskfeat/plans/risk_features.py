"""From the seven input files to scores: feature blocks, encodings, trees and blend.

Every block is one row per user and is written in buckets of the user, so it is computed once and
the final matrix is a chain of one-to-one left joins without a shuffle.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field, replace
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskfeat.functions.scalars import composite_key, one_vs_rest, ordinal, with_composite_keys
from riskfeat.functions.stats import BASIC, SPREAD, WITH_STD, ratio, stats_of
from riskfeat.operators import behaviour, encoders, grouping, popularity, profile, scoring, sequences, sessions, vectors
from riskfeat.operators.folds import stratified_folds
from riskfeat.plans.feature_matrix import assemble, behaviour_block, feature_sets, property_pivot
from riskfeat.roles import EventRoles, LabelRoles
from riskfeat.sources.readers import NUMBER_COLUMNS, ORDINAL_COLUMNS, PLACE_COLUMNS, TEXT_COLUMNS, RiskInput
from riskfeat.sources.sinks import BlockStore, drop_features, write_block

EVENTS = EventRoles(user="user")
LABELS = LabelRoles(user="user")
USER = "user"

# fixed values: composite keys
PROFILE_KEYS = {
    "provider_regist": ("provider", "regist_type"),
    "level_verified": ("level", "verified"),
    "agreement": ("agreement1", "agreement2", "agreement3", "agreement4"),
    "province_city": ("province", "city"),
    "balance_all": ("balance1", "balance2"),
    "balance_avg_all": ("balance1_avg", "balance2_avg"),
    "product_amount": tuple(f"product{i}_amount" for i in range(1, 6)),
}
ENCODING_KEYS = {"city_level": ("city", "level"), "city_balance_avg": ("city", "balance_avg")}
OP_KEYS = {
    "op_pattern": ("op_type", "op_mode", "op_device"),
    "op_type_mode": ("op_type", "op_mode"),
    "op_type_device": ("op_type", "op_device"),
    "op_mode_device": ("op_mode", "op_device"),
    "ip_net_type": ("ip", "net_type"),
    "ip3_net_type": ("ip_3", "net_type"),
    "net_type_channel": ("net_type", "channel"),
}
TRANS_KEYS = {
    "tunnel_io": ("tunnel_in", "tunnel_out"),
    "type": ("type1", "type2"),
    "tunnel_io_type": ("tunnel_in", "tunnel_out", "type1", "type2"),
    "platform_tunnel_io_type": ("platform", "tunnel_in", "tunnel_out", "type1", "type2"),
    "platform_tunnel_io": ("platform", "tunnel_in", "tunnel_out"),
    "platform_type": ("platform", "type1", "type2"),
    "platform_amount": ("platform", "amount"),
    "type_amount": ("type1", "type2", "amount"),
    "tunnel_io_amount": ("tunnel_in", "tunnel_out", "amount"),
    "type1_amount": ("type1", "amount"),
    "type2_amount": ("type2", "amount"),
    "tunnel_in_amount": ("tunnel_in", "amount"),
    "tunnel_out_amount": ("tunnel_out", "amount"),
}
LOG_KEYS = {
    "week_property": ("week", "property"),
    "hour_property": ("hour", "property"),
    "day_property": ("days_diff", "property"),
    "day_week_property": ("days_diff", "week", "property"),
    "day_hour_property": ("days_diff", "hour", "property"),
}
# fixed values: the columns each operator is applied to
TIME_COLUMNS = ["days_diff", "week", "hour", "timestamp"]
TRANS_COLUMNS = ["days_diff", "platform", "tunnel_in", "tunnel_out", "type1", "type2"]
OP_COLUMNS = [
    "op_type", "op_mode", "op_device", "op_ip", "op_ip_3", "net_type", "channel", "days_diff", "timestamp", "hour",
    *OP_KEYS,
]
LOG_VALUE_COLUMNS = ["trans_op_ip", "trans_op_ip_3", "days_diff", "hour", "week", "timestamp", "property", "time_diff"]
COUNT_COLUMNS = ["city", "province", "balance", "ip_cnt", "using_time"]
CARD_COLUMNS = ["card_a_cnt", "card_b_cnt", "card_c_cnt", "card_d_cnt"]
ENCODED_PROFILE = [
    "province", "city", "city_level", "city_balance_avg", "age", "service1_amt", "ip_cnt", "login_days_cnt",
    "login_cnt_avg", "acc_count", *CARD_COLUMNS,
]
ENCODED_TRANS = [
    "platform", "tunnel_in", "tunnel_out", "type1", "type2", "amount", "platform_amount", "type_amount",
    "tunnel_io_amount", "type1_amount", "type2_amount", "tunnel_in_amount", "tunnel_out_amount",
]
ENCODED_OP = ["op_type", "op_device", "channel", "op_mode", "op_ip", "net_type", "op_ip_3"]
ENCODED_LOG = [*LOG_KEYS, "days_diff", "week", "hour"]
SEQUENCE_OP = ["op_type", "op_mode", "op_device", "channel"]
SEQUENCE_TRANS = ["tunnel_in", "tunnel_out", "type1", "type2", "platform", "amount"]
SEQUENCE_PROFILE = ["province", "city", "city_level", "city_balance_avg", "age", *CARD_COLUMNS]
RISKY_PROVINCES = (21, 26, 30, 20, 16)
TRAILING_DAYS = (27, 23, 15, 10, 5)
OP_LENGTH, TRANS_LENGTH = 200, 100


@dataclass(frozen=True)
class RunSettings:
    """What a run may vary."""

    folds: int = 5
    vector_size: int = 10
    # how far off the vectors may be, as a share of the largest singular value
    vector_tolerance: float = 0.01
    top_types: int = 2
    trees: scoring.TreeSettings = field(default_factory=scoring.TreeSettings)
    # feature sets per seed
    runs: Mapping[int, Sequence[str]] = field(
        default_factory=lambda: {
            2020: ("all", "without_behaviour", "without_crosses"),
            779: ("without_behaviour", "without_crosses"),
        }
    )
    drop: Sequence[str] = ()


@dataclass(frozen=True)
class Logs:
    trans: DataFrame
    op: DataFrame
    both: DataFrame


def prepare_logs(source: RiskInput) -> Logs:
    """Composite keys, rates, sessions and the union of both logs."""
    trans = sessions.amount_rate(with_composite_keys(source.trans, TRANS_KEYS), EVENTS)
    trans = trans.withColumnsRenamed({"ip": "trans_ip", "ip_3": "trans_ip_3"})
    op = with_composite_keys(source.op, OP_KEYS).withColumnsRenamed({"ip": "op_ip", "ip_3": "op_ip_3"})
    common = [USER, "seq", "ip", "ip_3", *TIME_COLUMNS]
    both = with_composite_keys(sessions.union_logs(source.trans, source.op, common, EVENTS), LOG_KEYS)
    both = sessions.change_to_next(both, {"time_diff": "timestamp"}, EVENTS)
    return Logs(trans, op, both.withColumnsRenamed({"ip": "trans_op_ip", "ip_3": "trans_op_ip_3"}))


def _time_stats(prefix: str) -> list:
    return [s for c in TIME_COLUMNS for s in stats_of(c, SPREAD, f"{prefix}_{c}")]


def profile_blocks(people: DataFrame) -> dict[str, DataFrame]:
    """Crosses of the whole-number columns, and value frequencies; each from the columns it needs."""
    crosses = profile.cross_names(NUMBER_COLUMNS)
    return {
        "crosses": profile.pairwise_cross(people.select(USER, *NUMBER_COLUMNS), NUMBER_COLUMNS).select(USER, *crosses),
        "counts": popularity.frequency_encode(people.select(USER, *COUNT_COLUMNS), COUNT_COLUMNS, USER).select(
            USER, *[f"{c}_count" for c in COUNT_COLUMNS]
        ),
    }


def category_block(people: DataFrame, behaving: DataFrame) -> DataFrame:
    """Alphabetical codes of the text columns and composite keys, and indicators of the risky provinces."""
    ends = ["last_behaviour", "first_behaviour"]
    flags = one_vs_rest("province", RISKY_PROVINCES)
    keyed = combined_profile_keys(people)
    text = keyed.select(USER, *TEXT_COLUMNS, *PROFILE_KEYS, *[x.alias(n) for n, x in flags.items()])
    joined = text.join(behaving.select(USER, *ends), USER, "left")
    return profile.label_encode(joined, [*TEXT_COLUMNS, *PROFILE_KEYS, "binary_province", *ends])


def entity_columns(people: DataFrame) -> DataFrame:
    """User, label, fold and the profile's own numbers, ordinals included."""
    return people.select(
        USER,
        "label",
        LABELS.fold,
        *PLACE_COLUMNS,
        *NUMBER_COLUMNS,
        *[ordinal(F.col(c)).alias(c) for c in ORDINAL_COLUMNS],
        ratio(F.col("product7_fail_cnt"), F.col("product7_cnt")).alias("product7_fail_ratio"),
    )


def trans_blocks(trans: DataFrame, settings: RunSettings) -> dict[str, DataFrame]:
    """All feature blocks of the transaction log."""
    typed = [
        s
        for column, k in (("type1", settings.top_types), ("type2", 1), ("tunnel_io", 1))
        for value in grouping.frequent_values(trans, column, k)
        for measure in ("days_diff", "hour")
        for s in grouping.value_stats(column, [value], measure, SPREAD, column)
    ]
    main = grouping.grouped_stats(
        trans,
        [USER],
        [
            *stats_of("amount", BASIC, "amount"),
            *grouping.trailing_stats(USER, "days_diff", "amount", TRAILING_DAYS, WITH_STD, "amount"),
            *grouping.null_stats("trans_ip", "trans_trans_ip"),
            *grouping.null_stats("trans_ip_3", "trans_trans_ip_3"),
            *typed,
            *_time_stats("trans"),
        ],
    )
    distinct = grouping.nunique_stats(trans, [USER], TRANS_COLUMNS, "trans")
    rates = main.join(distinct, USER).withColumns(
        {
            "amount_per_days": ratio(F.col("amount_sum"), F.col("trans_days_diff_nuniq")),
            "amount_per_cnt": ratio(F.col("amount_sum"), F.col("amount_count")),
        }
    )
    pivots = {
        f"pivot_{c}": grouping.pivot_stats(trans, [USER], c, grouping.category_values(trans, c), "amount")
        for c in ("platform", "type1", "type2", "type")
    }
    size, near = settings.vector_size, settings.vector_tolerance
    amounts = vectors.value_vectors(trans, "amount", size, EVENTS, near)
    terms = vectors.value_term_counts(trans, USER, "platform_tunnel_io_type")
    weights = vectors.tfidf_weights(terms, USER, vectors.document_count(trans, USER))
    return {
        "trans_stats": rates,
        **pivots,
        "trans_popularity": popularity.popularity_user_stats(trans, TRANS_COLUMNS, SPREAD, "trans", EVENTS),
        "trans_d2v": vectors.user_doc_embedding(trans, "amount", size, EVENTS, amounts),
        "trans_w2v": vectors.value_word2vec(trans, "amount", size, EVENTS, amounts),
        "trans_tfidf": vectors.truncated_svd(weights, USER, "svd_tfidf_platform_tunnel_io_type", size, tolerance=near),
        "trans_count": vectors.truncated_svd(
            terms.withColumnRenamed("tf", "weight"), USER, "svd_countvec_platform_tunnel_io_type", size, tolerance=near
        ),
    }


def op_blocks(op: DataFrame, settings: RunSettings) -> dict[str, DataFrame]:
    """All feature blocks of the operation log."""
    size, near = settings.vector_size, settings.vector_tolerance
    channels = vectors.value_vectors(op, "channel", size, EVENTS, near)
    blocks = {
        "op_stats": grouping.grouped_stats(op, [USER], _time_stats("op")),
        "op_nunique": grouping.nunique_stats(op, [USER], OP_COLUMNS, "op"),
        "op_popularity": popularity.popularity_user_stats(op, OP_COLUMNS, SPREAD, "op", EVENTS),
        "op_w2v": vectors.value_word2vec(op, "channel", size, EVENTS, channels),
    }
    for c in ("op_mode", "op_type"):
        terms = vectors.value_term_counts(op, USER, c)
        weights = vectors.tfidf_weights(terms, USER, vectors.document_count(op, USER))
        blocks[f"tfidf_{c}"] = vectors.truncated_svd(weights, USER, f"svd_tfidf_{c}", size, tolerance=near)
        counts = terms.withColumnRenamed("tf", "weight")
        blocks[f"count_{c}"] = vectors.truncated_svd(counts, USER, f"svd_countvec_{c}", size, tolerance=near)
    return blocks


def log_blocks(both: DataFrame) -> dict[str, DataFrame]:
    """All feature blocks of the union of both logs."""
    nulls = [
        *grouping.null_stats("trans_op_ip", "trans_op_trans_op_ip"),
        *grouping.null_stats("trans_op_ip_3", "trans_op_trans_op_ip_3"),
    ]
    return {
        "log_stats": grouping.grouped_stats(both, [USER], [*nulls, *_time_stats("trans_op")]),
        "log_nunique": grouping.nunique_stats(both, [USER], LOG_VALUE_COLUMNS, "trans_op"),
        "log_popularity": popularity.popularity_user_stats(both, LOG_VALUE_COLUMNS, SPREAD, "trans_op", EVENTS),
        "log_pivot": property_pivot(both, EVENTS),
    }


def encoding_blocks(people: DataFrame, logs: Logs) -> dict[str, DataFrame]:
    """Out-of-fold target encodings of the profile and of the three logs."""
    keyed = with_composite_keys(people, ENCODING_KEYS)
    return {
        "te_profile": encoders.oof_encode(keyed, ENCODED_PROFILE, roles=LABELS, suffix="label_kfold_mean"),
        "te_trans": encoders.event_target_encode(logs.trans, people, ENCODED_TRANS, ("mean",), roles=LABELS),
        "te_op": encoders.event_target_encode(logs.op, people, ENCODED_OP, SPREAD, suffix="op_te", roles=LABELS),
        "te_log": encoders.event_target_encode(logs.both, people, ENCODED_LOG, SPREAD, suffix="log_te", roles=LABELS),
    }


def supplementary_blocks(logs: Logs) -> dict[str, DataFrame]:
    """Shared resources, calendar and further per-user figures that the main run leaves out."""
    trans, both = logs.trans, sessions.sessionize(logs.both, EVENTS)
    calendar = grouping.grouped_stats(
        trans,
        [USER],
        [*behaviour.calendar_stats(EVENTS), *behaviour.hour_share_stats(EVENTS), *behaviour.weekend_share_stats(EVENTS)],
    )
    return {
        "calendar": calendar.withColumn("range_day", F.col("max_day") - F.col("early_day")),
        "shared": popularity.shared_resource_stats(
            trans, ("platform", "tunnel_in", "tunnel_out", "type1", "type2", "trans_ip", "trans_ip_3"), EVENTS
        ),
        "session_gap": sessions.session_gap_mean(both, EVENTS),
        "ip_overlap": behaviour.resource_overlap(both, "trans_op_ip", EVENTS),
        "ip3_overlap": behaviour.resource_overlap(both, "trans_op_ip_3", EVENTS),
        "rate": grouping.grouped_stats(trans, [USER], stats_of("amount_per_time", BASIC, "amount_diff")),
    }


def build_matrices(
    source: RiskInput, folder: str, settings: RunSettings = RunSettings(), supplementary: bool = False
) -> dict[int, DataFrame]:
    """The feature matrix of every seed: user, label, fold and one numeric column per feature.

    A seed draws its own folds, and with them its own target encodings; all other blocks are computed once.
    """
    people = write_block(source.profile, f"{folder}/people")
    prepared = prepare_logs(source)
    logs = Logs(*[write_block(getattr(prepared, n), f"{folder}/log_{n}") for n in ("trans", "op", "both")])
    behaving = write_block(behaviour_block(logs.both, EVENTS), f"{folder}/behaviour")
    blocks = {
        **profile_blocks(people),
        "categories": category_block(people, behaving),
        **trans_blocks(logs.trans, settings),
        **op_blocks(logs.op, settings),
        **log_blocks(logs.both),
        "log_behaviour": behaving.drop("last_behaviour", "first_behaviour"),
        **(supplementary_blocks(logs) if supplementary else {}),
    }
    store = BlockStore(people.sparkSession, f"{folder}/blocks", USER)
    shared = [store.put(name, block) for name, block in blocks.items()]
    out = {}
    for seed in settings.runs:
        folded = write_block(
            stratified_folds(people, settings.folds, seed, USER, "label"), f"{folder}/people_{seed}"
        )
        coded = [
            store.put(f"{name}_{seed}", block) for name, block in encoding_blocks(folded, logs).items()
        ]
        entity = store.put(f"entity_{seed}", entity_columns(folded))
        wide = assemble(entity, [*shared, *coded], USER)
        # a user without events has a code of its own
        wide = wide.withColumn("has_trans", F.coalesce("has_trans", F.lit(-1)))
        out[seed] = write_block(drop_features(wide, settings.drop), f"{folder}/matrix_{seed}")
    store.close()
    return out


def build_matrix(
    source: RiskInput, folder: str, settings: RunSettings = RunSettings(), supplementary: bool = False
) -> DataFrame:
    """The feature matrix of the first seed."""
    first = next(iter(settings.runs))
    return build_matrices(source, folder, replace(settings, runs={first: settings.runs[first]}), supplementary)[first]


def score_runs(matrices: Mapping[int, DataFrame], settings: RunSettings = RunSettings()) -> DataFrame:
    """The score table of every (feature set, seed) run; the trees keep one seed, the folds have the run's."""
    runs = []
    for seed, names in settings.runs.items():
        matrix = matrices[seed]
        named = feature_sets(scoring.feature_columns(matrix, LABELS), profile.cross_names(NUMBER_COLUMNS))
        for name in names:
            every = scoring.fold_scores(matrix, named[name], settings.folds, settings.trees, LABELS)
            runs.append(scoring.average_fold_scores(every, "gbt", seed, name, LABELS))
    return reduce(DataFrame.unionByName, runs)


def evaluate(scores: DataFrame, labels: DataFrame, score: str = "score", keys: Sequence[str] = ()) -> DataFrame:
    """AUC of out-of-fold scores against the labels."""
    known = scores.where(F.col("split") == "oof").join(labels.select(USER, "label"), USER)
    return scoring.roc_auc(known, score, "label", keys)


def sequence_inputs(source: RiskInput, folder: str, folds: int = 5, seed: int = 1997) -> DataFrame:
    """Inputs of a sequence model: scaled profile columns and padded event sequences.

    Event rows carry their out-of-fold codes; the first 200 operations and 100
    transactions of a user become arrays.
    """
    folded = with_composite_keys(stratified_folds(source.profile, folds, seed, USER, "label"), ENCODING_KEYS)
    people = write_block(folded, f"{folder}/people")
    encoded = encoders.oof_encode(people, SEQUENCE_PROFILE, fill="own_mean", roles=LABELS, suffix="label_kfold_mean")
    codes = [f"{c}_label_kfold_mean" for c in SEQUENCE_PROFILE]
    frequency = popularity.frequency_encode(people.select(USER, *COUNT_COLUMNS), COUNT_COLUMNS, USER)
    counted = people.join(frequency.drop(*COUNT_COLUMNS), USER)
    numbers = [*NUMBER_COLUMNS, *[f"{c}_count" for c in COUNT_COLUMNS], *ORDINAL_COLUMNS, "product7_fail_ratio"]
    base = counted.withColumns({c: ordinal(F.col(c)) for c in ORDINAL_COLUMNS}).withColumn(
        "product7_fail_ratio", ratio(F.col("product7_fail_cnt"), F.col("product7_cnt"))
    )
    category = [*TEXT_COLUMNS, *PLACE_COLUMNS]
    flagged = profile.one_hot(
        base.withColumns({c: F.coalesce(F.col(c).cast("string"), F.lit("-1")) for c in category}), category
    )
    flags = [c for c in flagged.columns if c.startswith("oh_enc")]
    filled = profile.mean_fill(write_block(encoded, f"{folder}/encoded"), codes)
    joined = write_block(flagged.join(filled, USER, "left"), f"{folder}/joined")
    scaled = profile.zscore(joined, [*flags, *numbers, *codes]).select(
        USER, "label", LABELS.fold, *flags, *numbers, *codes
    )
    parts = []
    for log, columns, length, prefix in (
        (source.op, SEQUENCE_OP, OP_LENGTH, "op_seq"),
        (source.trans, SEQUENCE_TRANS, TRANS_LENGTH, "trans_seq"),
    ):
        rows = write_block(encoders.event_target_rows(log, people, columns, roles=LABELS), f"{folder}/{prefix}")
        lists = sequences.user_sequences(rows, columns, [f"{c}_te" for c in columns], length, EVENTS)
        everyone = people.select(USER).join(lists, USER, "left")
        padded = sequences.pad_sequences(everyone, [*columns, *[f"{c}_te" for c in columns]])
        parts.append(padded.select(USER, *[F.col(c).alias(f"{prefix}_{c}") for c in padded.columns if c != USER]))
    return reduce(lambda left, part: left.join(part, USER, "left"), parts, scaled)


def combined_profile_keys(people: DataFrame) -> DataFrame:
    """The profile with its composite category keys."""
    return people.select("*", *[composite_key(*parts).alias(name) for name, parts in PROFILE_KEYS.items()])
