"""Label-aware encodings without leakage.

A user sits in one fold, so "fit on the other folds" is the category's total minus
the fold's own share: one aggregate per (column, value, fold) replaces k refits. The
folds of a category travel as one map of at most k entries on the category's row.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskfeat.functions.stats import Stat, ratio
from riskfeat.operators.grouping import stats_by_column, unpivot
from riskfeat.operators.ordered import Ordering, per_key_ordered, running_sums
from riskfeat.operators.profile import column_totals
from riskfeat.operators.skew import find_hot, lookup_join
from riskfeat.roles import LabelRoles
from riskfeat.session import reliable_checkpoint

WOE_EPS = 1e-6
TOTALS = "__totals"


@dataclass(frozen=True)
class Fitted:
    """What an encoder may use: label sum and rows of the category, and of all rows."""

    bad: Column
    n: Column
    all_bad: Column
    all_n: Column

    @property
    def mean(self) -> Column:
        return ratio(self.bad, self.n)

    @property
    def prior(self) -> Column:
        return ratio(self.all_bad, self.all_n)


def _m_estimate(f: Fitted, m: float = 1.0) -> Column:
    return F.when(f.n > 0, F.try_divide(f.bad + m * f.prior, f.n + m))


def _james_stein(f: Fitted) -> Column:
    within = F.try_divide(f.mean * (1 - f.mean), f.n.cast("double"))
    between = F.try_divide(f.prior * (1 - f.prior), f.all_n.cast("double"))
    shrink = F.coalesce(F.try_divide(within, within + between), F.lit(0.0))
    return (1 - shrink) * f.mean + shrink * f.prior


def _woe(f: Fitted, eps: float = WOE_EPS) -> Column:
    bad_share = (f.bad + eps) / (f.all_bad + eps)
    good_share = (f.n - f.bad + eps) / (f.all_n - f.all_bad + eps)
    return F.when(f.n > 0, F.log(bad_share / good_share))


def _seen_twice(f: Fitted) -> Column:
    """Leave-one-out code of a row that was not fitted: the category's mean; none for a category of a single row."""
    return F.when(f.n > 1, f.mean)


def _smooth_woe(f: Fitted, add: float = 1.0) -> Column:
    """Weight of evidence with both shares regularised; 0 for a category of a single row."""
    bad_share = (f.bad + add) / (f.all_bad + 2 * add)
    good_share = (f.n - f.bad + add) / (f.all_n - f.all_bad + 2 * add)
    return F.when(f.n > 1, F.log(bad_share / good_share)).when(f.n > 0, F.lit(0.0))


METHODS: dict[str, Callable[[Fitted], Column]] = {
    "mean": lambda f: f.mean,
    "m_estimate": _m_estimate,
    "james_stein": _james_stein,
    "woe": _woe,
    "smooth_woe": _smooth_woe,
    "leave_one_out": _seen_twice,
    # the expanding statistic after all fitted rows
    "ordered": _m_estimate,
}
# the code of an event value that was not fitted; the label mean for methods not named here
UNSEEN = {"mean": None, "smooth_woe": 0.0}


def category_moments(long: DataFrame, label_sum: Column, label_rows: Column, roles: LabelRoles) -> DataFrame:
    """Per (column, value): label sum, labelled rows, all rows, and the share of each fold."""
    per_fold = (
        long.where(F.col("value").isNotNull())
        .groupBy("column", "value", roles.fold)
        .agg(
            F.coalesce(F.sum(label_sum), F.lit(0)).alias("s"),
            F.coalesce(F.sum(label_rows), F.lit(0)).alias("n"),
            F.count(F.lit(1)).alias("rows"),
        )
    )
    fold_entry = F.when(F.col(roles.fold).isNotNull(), F.struct(F.col(roles.fold), F.struct("s", "n")))
    return per_fold.groupBy("column", "value").agg(
        F.sum("s").alias("s_all"),
        F.sum("n").alias("n_all"),
        F.sum("rows").alias("__rows"),
        F.map_from_entries(F.collect_list(fold_entry)).alias("by_fold"),
    )


def fold_totals(rows: DataFrame, label_sum: Column, label_rows: Column, roles: LabelRoles) -> Column:
    """Label sum and labelled rows of the whole table and of each fold, as one value."""
    per_fold = rows.groupBy(roles.fold).agg(
        F.coalesce(F.sum(label_sum), F.lit(0)).alias("s"), F.coalesce(F.sum(label_rows), F.lit(0)).alias("n")
    )
    entry = F.when(F.col(roles.fold).isNotNull(), F.struct(F.col(roles.fold), F.struct("s", "n")))
    return column_totals(
        per_fold,
        {"s_all": F.sum("s"), "n_all": F.sum("n"), "by_fold": F.map_from_entries(F.collect_list(entry))},
    )


def _outside_fold(whole: Column, by_fold: Column, part: str, fold: Column) -> Column:
    """The total without the fold; everything for a row that is in no fold."""
    return whole - F.coalesce(F.try_element_at(by_fold, fold)[part], F.lit(0))


def _with_totals(rows: DataFrame, totals: Column) -> DataFrame:
    """Carry the totals as a column, so that the plan holds their subquery once."""
    return rows.select("*", totals.alias(TOTALS))


def _fitted(roles: LabelRoles, fold: Column | None = None) -> Fitted:
    fold = F.col(roles.fold) if fold is None else fold
    by_fold, totals = F.col("by_fold"), F.col(TOTALS)
    return Fitted(
        F.coalesce(_outside_fold(F.col("s_all"), by_fold, "s", fold), F.lit(0)),
        F.coalesce(_outside_fold(F.col("n_all"), by_fold, "n", fold), F.lit(0)),
        _outside_fold(totals["s_all"], totals["by_fold"], "s", fold),
        _outside_fold(totals["n_all"], totals["by_fold"], "n", fold),
    )


def oof_encode(
    profile: DataFrame,
    features: Sequence[str],
    method: str = "mean",
    fill: str = "prior",
    suffix: str = "oof_mean",
    roles: LabelRoles = LabelRoles(),
    hot_rows: int | None = None,
) -> DataFrame:
    """Out-of-fold encoding of profile columns: ``user`` and ``{column}_{suffix}``.

    Users to score are encoded from all labelled users. A category unseen in the other
    folds gets ``fill``: "prior" (label mean of the other folds), "own_mean" (mean of
    the encoded labelled column) or "category_mean" (unweighted mean over the
    categories of the other folds).
    """
    label = F.col(roles.label)
    ones = label.isNotNull().cast("long")
    long = unpivot(profile, [roles.user, roles.label, roles.fold], features)
    moments = category_moments(long, label, ones, roles)
    totals = fold_totals(profile, label, ones, roles)
    rows = _with_totals(lookup_join(long, moments, ["column", "value"], "__rows", hot_rows), totals)
    fitted = _fitted(roles)
    code = METHODS[method](fitted)
    if fill == "prior":
        filled = rows.select(roles.user, "column", F.coalesce(code, fitted.prior).alias("code"))
    elif fill == "own_mean":
        coded = rows.select(roles.user, "column", roles.label, code.alias("code"))
        # one row per encoded column
        means = coded.where(label.isNotNull()).groupBy("column").agg(F.avg("code").alias("__fill"))
        filled = coded.join(F.broadcast(means), "column", "left").withColumn("code", F.coalesce("code", "__fill"))
    elif fill == "category_mean":
        # k + 1 trainings, so each category appears k + 1 times
        ids = F.concat(F.map_keys(F.col(TOTALS)["by_fold"]), F.array(F.lit(-1)))
        every = _with_totals(moments, totals).select("*", F.explode(ids).alias("__training"))
        training = F.nullif(F.col("__training"), F.lit(-1))
        per_category = every.select(
            "column", "__training", METHODS[method](_fitted(roles, training)).alias("code")
        )
        means = per_category.groupBy("column", "__training").agg(F.avg("code").alias("__fill"))
        coded = rows.select(
            roles.user, "column", F.coalesce(F.col(roles.fold), F.lit(-1)).alias("__training"), code.alias("code")
        )
        filled = coded.join(F.broadcast(means), ["column", "__training"], "left").withColumn(
            "code", F.coalesce("code", "__fill")
        )
    else:
        raise ValueError(f"unknown fill {fill}")
    return _one_column_each(filled, features, suffix, roles)


def _one_column_each(coded: DataFrame, features: Sequence[str], suffix: str, roles: LabelRoles) -> DataFrame:
    return coded.groupBy(roles.user).agg(
        *[F.max(F.when(F.col("column") == c, F.col("code"))).alias(f"{c}_{suffix}") for c in features]
    )


def leave_one_out_encode(
    profile: DataFrame,
    features: Sequence[str],
    suffix: str = "loo",
    roles: LabelRoles = LabelRoles(),
    hot_rows: int | None = None,
) -> DataFrame:
    """A labelled user gets the category mean without itself, a user to score the mean.

    A category without other labelled users gives the overall label mean.
    """
    label = F.col(roles.label)
    ones = label.isNotNull().cast("long")
    long = unpivot(profile, [roles.user, roles.label, roles.fold], features)
    moments = category_moments(long, label, ones, roles)
    totals = fold_totals(profile, label, ones, roles)
    rows = _with_totals(lookup_join(long, moments, ["column", "value"], "__rows", hot_rows), totals)
    s = F.col("s_all") - F.coalesce(label, F.lit(0))
    n = F.col("n_all") - ones
    code = F.coalesce(ratio(s, n), ratio(F.col(TOTALS)["s_all"], F.col(TOTALS)["n_all"]))
    return _one_column_each(rows.select(roles.user, "column", code.alias("code")), features, suffix, roles)


def ordered_target_rows(
    profile: DataFrame,
    features: Sequence[str],
    position: str,
    suffix: str = "ordered",
    roles: LabelRoles = LabelRoles(),
    hot_rows: int | None = None,
) -> DataFrame:
    """Expanding target statistic of labelled rows: (labels before + prior) / (rows before + 1)."""
    label = F.col(roles.label)
    known = profile.where(label.isNotNull())
    prior = column_totals(known, {"p": ratio(F.sum(label), F.count(label))})["p"]
    keep = dict.fromkeys([roles.user, roles.label, position])
    long = unpivot(known, list(keep), features).where(F.col("value").isNotNull())
    order = Ordering(("column", "value"), position, () if position == roles.user else (roles.user,))
    before = per_key_ordered(
        long,
        order,
        lambda rows, chunked: running_sums(
            rows, order, {"__s": label.cast("long"), "__n": F.lit(1)}, chunked, inclusive=False
        ),
        hot_rows,
    )
    code = (F.col("__s") + prior) / (F.col("__n") + 1)
    return _one_column_each(before.select(roles.user, "column", code.alias("code")), features, suffix, roles)


def ordered_target_encode(
    profile: DataFrame,
    features: Sequence[str],
    position: str,
    suffix: str = "cat_enc",
    roles: LabelRoles = LabelRoles(),
    hot_rows: int | None = None,
) -> DataFrame:
    """Out-of-fold code of a category: the expanding statistic of its last fitted row.

    That value is (label sum without the last row + prior) / rows, so only the last
    label per category and fold is needed, not the running totals. Unseen categories
    get the prior.
    """
    label = F.col(roles.label)
    ones = label.isNotNull().cast("long")
    keep = dict.fromkeys([roles.user, roles.label, roles.fold, position])
    long = unpivot(profile, list(keep), features)
    moments = category_moments(long, label, ones, roles)
    at = F.struct(F.col(position).alias("at"), F.col(roles.user).alias("user"))
    lasts = (
        long.where(F.col("value").isNotNull() & label.isNotNull())
        .groupBy("column", "value", roles.fold)
        .agg(F.max(F.struct(at.alias("at"), label.alias("y"))).alias("last"))
        .groupBy("column", "value")
        .agg(F.collect_list(F.struct(F.col(roles.fold).alias("fold"), F.col("last"))).alias("lasts"))
    )
    totals = fold_totals(profile, label, ones, roles)
    fits = moments.join(lasts, ["column", "value"], "left")
    rows = _with_totals(lookup_join(long, fits, ["column", "value"], "__rows", hot_rows), totals)
    fitted = _fitted(roles)
    others = F.filter("lasts", lambda e: ~e["fold"].eqNullSafe(F.col(roles.fold)))
    last_label = F.array_max(F.transform(others, lambda e: e["last"]))["y"]
    code = F.coalesce(F.try_divide(fitted.bad - last_label + fitted.prior, fitted.n.cast("double")), fitted.prior)
    return _one_column_each(rows.select(roles.user, "column", code.alias("code")), features, suffix, roles)


def woe_table(df: DataFrame, column: str, label: str, eps: float = WOE_EPS) -> DataFrame:
    """Weight of evidence of every category of a labelled table."""
    y = F.col(label)
    known = df.where(y.isNotNull())
    totals = column_totals(known, {"bad": F.sum(y), "n": F.count(y)})
    counts = known.where(F.col(column).isNotNull()).groupBy(column).agg(F.sum(y).alias("bad"), F.count(y).alias("n"))
    woe = _woe(Fitted(F.col("bad"), F.col("n"), totals["bad"], totals["n"]), eps)
    return counts.select(column, "bad", "n", woe.alias("woe"))


@dataclass(frozen=True)
class EventEncoding:
    """The fitted parts of an event encoder, shared by its row and user outputs."""

    pairs: DataFrame
    moments: DataFrame
    totals: Column
    hot_users: DataFrame | None


def fit_event_encoding(
    events: DataFrame,
    labels: DataFrame,
    features: Sequence[str],
    user_mean: bool = False,
    roles: LabelRoles = LabelRoles(),
    hot_rows: int | None = None,
) -> EventEncoding:
    """Reduce events to (user, column, value) counts, attach labels, and sum per category.

    ``user_mean`` lets every user count once per value instead of once per event.
    """
    long = unpivot(events, [roles.user], features).where(F.col(roles.user).isNotNull())
    counted = long.groupBy(roles.user, "column", "value").agg(F.count(F.lit(1)).alias("n_rows"))
    hot_users = find_hot(events, [roles.user], hot_rows)
    known = labels.select(roles.user, roles.label, roles.fold)
    pairs = lookup_join(counted, known, [roles.user], hot_users, hot_rows, inner=True)
    weight = F.lit(1).cast("long") if user_mean else F.col("n_rows")
    label_sum = F.col(roles.label) * weight
    label_rows = F.when(F.col(roles.label).isNotNull(), weight)
    moments = category_moments(pairs, label_sum, label_rows, roles)
    one_column = pairs.where(F.col("column") == features[0])
    return EventEncoding(pairs, moments, fold_totals(one_column, label_sum, label_rows, roles), hot_users)


def event_target_encode(
    events: DataFrame,
    labels: DataFrame,
    features: Sequence[str],
    kinds: Sequence[str] = ("mean",),
    method: str = "mean",
    user_mean: bool = False,
    suffix: str = "te",
    roles: LabelRoles = LabelRoles(),
    hot_rows: int | None = None,
) -> DataFrame:
    """Per user, statistics of the out-of-fold codes of the values on the user's events.

    With ``method="mean"`` a value unseen in the other folds has no code; it is 0 for "smooth_woe" and the label
    mean for the other methods.
    """
    fit = fit_event_encoding(events, labels, features, user_mean, roles, hot_rows)
    rows = lookup_join(fit.pairs, fit.moments, ["column", "value"], "__rows", hot_rows)
    fitted = _fitted(roles)
    code = METHODS[method](fitted)
    if method != "mean":
        rows = _with_totals(rows, fit.totals)
        unseen = UNSEEN.get(method)
        code = F.coalesce(code, fitted.prior if unseen is None else F.lit(unseen))
    coded = rows.select(roles.user, "column", "n_rows", code.alias("code"))
    # a user with rows but no code has the sum 0
    stats = [Stat(k, "sum0" if k == "sum" else k, F.col("code"), weight=F.col("n_rows")) for k in kinds]
    names = {c: f"{c}_{suffix}_" for c in features}
    return stats_by_column(coded, roles.user, names, stats, hot_rows, fit.hot_users)


def event_target_rows(
    events: DataFrame,
    labels: DataFrame,
    features: Sequence[str],
    user_mean: bool = False,
    suffix: str = "te",
    roles: LabelRoles = LabelRoles(),
    hot_rows: int | None = None,
) -> DataFrame:
    """Event rows with the out-of-fold code of each feature's value in ``{feature}_{suffix}``."""
    fit = fit_event_encoding(events, labels, features, user_mean, roles, hot_rows)
    known = labels.select(roles.user, F.col(roles.label).alias("__label"), F.col(roles.fold).alias("__fold"))
    out = lookup_join(events, known, [roles.user], fit.hot_users, hot_rows, inner=True)
    event_rows = fit.pairs.groupBy("column", "value").agg(F.sum("n_rows").alias("__events"))
    # the fitted table serves every feature, so it is computed once
    sized = reliable_checkpoint(fit.moments.join(event_rows, ["column", "value"]))
    for c in features:
        of_column = sized.where(F.col("column") == c).select(
            F.col("value").alias("__value"), "s_all", "n_all", "by_fold", "__events"
        )
        keyed = out.withColumn("__value", F.col(c).cast("string"))
        joined = lookup_join(keyed, of_column, ["__value"], "__events", hot_rows)
        code = METHODS["mean"](_fitted(roles, F.col("__fold")))
        out = joined.withColumn(f"{c}_{suffix}", code).drop("__value", "s_all", "n_all", "by_fold", "__events")
    return out.drop("__label", "__fold")
