"""Joining feature blocks on the user key, feature sets, and the blend recipe."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskfeat.functions.stats import BASIC, ratio, stats_of
from riskfeat.operators import behaviour, encoders, grouping, popularity, profile, sessions
from riskfeat.operators.scoring import Member
from riskfeat.plans import tables
from riskfeat.roles import EventRoles
from riskfeat.session import shared_folder
from riskfeat.sources.sinks import BlockStore

# fixed values: blend members and weights
BLEND_FAMILIES: dict[str, list[Member]] = {
    "full": [
        Member("gbt", 2020, "without_behaviour", 0.33),
        Member("gbt", 2020, "all", 0.33),
        Member("gbt", 779, "without_behaviour", 0.33),
    ],
    "lean": [
        Member("gbt", 2020, "without_crosses", 0.5),
        Member("gbt", 779, "without_crosses", 0.5),
    ],
    "sequence": [Member("nn", 1997, "all", 1.0)],
}
BLEND_WEIGHTS: dict[str, float] = {"full": 0.7, "sequence": 0.1, "lean": 0.2}

# fixed values: columns left out of the "without_behaviour" feature set
BEHAVIOUR_COLUMNS = (
    "trans_trans_ip_3_null_cnt", "trans_trans_ip_3_null_ratio", "has_trans", "last_behaviour", "first_behaviour",
    "last_days_diff_trans", "first_days_diff_trans", "last_hour_trans", "first_hour_trans", "last_week_trans",
    "first_week_trans", "last_time_trans", "first_time_trans", "trans_count", "op_count", "trans_ratio",
)


def assemble(entity: DataFrame, blocks: Iterable[DataFrame], user: str = "user_id") -> DataFrame:
    """Left-join one-row-per-user blocks onto the entity table; blocks of one store need no shuffle for it."""
    return reduce(lambda left, block: left.join(block.hint("merge"), user, "left"), blocks, entity)


def property_pivot(log: DataFrame, roles: EventRoles = EventRoles()) -> DataFrame:
    """Day statistics of a user's transactions and operations, and the ratio of their counts."""
    wide = grouping.pivot_stats(log, [roles.user], roles.property, ("trans", "op"), roles.days)
    count = {tag: F.col(f"{roles.property}_{tag}_{roles.days}_count") for tag in ("trans", "op")}
    return wide.withColumn("op_trans_ratio", ratio(count["trans"], count["op"]))


def behaviour_block(log: DataFrame, roles: EventRoles = EventRoles()) -> DataFrame:
    """First and last behaviour, session counts per log, and their ratio."""
    counted = sessions.session_counts(sessions.sessionize(log, roles), roles)
    block = behaviour.first_last_behaviour(log, roles).join(counted, roles.user)
    return block.withColumn("trans_ratio", ratio(F.col("trans_count"), F.col("op_count")))


def feature_sets(features: Sequence[str], crosses: Sequence[str]) -> dict[str, list[str]]:
    """All columns; without behaviour columns; also without crosses."""
    behaving, crossed = set(BEHAVIOUR_COLUMNS), set(crosses)
    without = [c for c in features if c not in behaving]
    return {
        "all": list(features),
        "without_behaviour": without,
        "without_crosses": [c for c in without if c not in crossed],
    }


STAR_NUMBERS = ["nation", "n_orders", "n_open", "last_day"]
STAR_CROSSES = profile.cross_names(STAR_NUMBERS)


def star_matrix(spark: SparkSession, folder: str) -> DataFrame:
    """A feature matrix over the star-schema tables: blocks kept in buckets of the user, and one left join per block."""
    known = tables.profile(spark, folder)
    log = tables.logs(spark, folder)
    orders = tables.commerce(spark, folder)
    user = ["user_id"]
    crossed = profile.pairwise_cross(tables.numeric_profile(spark, folder), STAR_NUMBERS).drop("segment")
    order_stats = grouping.grouped_stats(
        orders,
        user,
        [
            *stats_of("amount", BASIC, "order_amount"),
            *[
                s
                for status in ("F", "O", "P")
                for s in stats_of("amount", ("count", "mean"), f"status_{status}", where=F.col("status") == status)
            ],
        ],
    )
    calendar = grouping.grouped_stats(
        tables.purchases(spark, folder), user, [*stats_of("amount", BASIC, "amount"), *behaviour.calendar_stats()]
    )
    behaving = behaviour_block(log)
    coded_behaviour = behaving.withColumns(
        {c: F.when(F.col(c).isNotNull(), (F.col(c) == "trans").cast("int")) for c in ("first_behaviour", "last_behaviour")}
    )
    popular = popularity.popularity_user_stats(log, ("ip", "k7"), ("mean", "max"), "log")
    encoded = encoders.oof_encode(known, ("nation", "segment_n", "nation_segment"))
    event_codes = encoders.event_target_encode(log, known, ("ip", "event_type"), ("mean", "max"))
    store = BlockStore(spark, shared_folder(spark, "star-blocks"), "user_id")
    entity = store.put("entity", known.select("user_id", "label", "fold"))
    blocks = {
        "crossed": crossed, "orders": order_stats, "calendar": calendar, "behaviour": coded_behaviour,
        "popular": popular, "encoded": encoded, "event_codes": event_codes,
    }
    matrix = assemble(entity, store.put_all(blocks))
    # the plan knows the files and their layout; the session need not keep the names
    store.close()
    return matrix
