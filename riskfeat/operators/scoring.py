"""Boosted-tree scores out of fold, exact AUC and weighted blends, all keyed by user.

Score table: ``user, split ("oof" or "test"), model, seed, feature_set, score``.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass, field, replace
from functools import reduce
from multiprocessing.pool import ThreadPool

import numpy as np
import pyarrow as pa
from pyspark import inheritable_thread_target
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskfeat.operators.ordered import global_running
from riskfeat.operators.profile import min_max
from riskfeat.roles import LabelRoles
from riskfeat.session import reliable_checkpoint

MISSING = -999.0
# models fitted at the same time: a level of a tree is too short a job to fill a cluster by itself
FITS_AT_ONCE = 5


@dataclass(frozen=True)
class TreeSettings:
    """Boosting settings; the defaults are the full-size ones.

    Boosting stops when the AUC of the held-out fold has not risen for ``patience`` rounds, and the best round counts.
    """

    rounds: int = 5000
    patience: int = 100
    depth: int = 8
    step: float = 0.02
    rows_share: float = 0.8
    columns_share: str = "0.8"
    min_rows: int = 5
    bins: int = 32
    seed: int = 2020
    extra: Mapping[str, object] = field(default_factory=dict)


def feature_columns(df: DataFrame, roles: LabelRoles = LabelRoles(), drop: Sequence[str] = ()) -> list[str]:
    """Numeric columns that may enter a model (metadata only)."""
    numeric = ("double", "float", "integer", "long", "short", "byte", "boolean")
    held = {roles.user, roles.label, roles.fold, *drop}
    return [
        f.name
        for f in df.schema.fields
        if f.name not in held and (f.dataType.typeName() in numeric or f.dataType.typeName().startswith("decimal"))
    ]


def gbt_oof_scores(
    matrix: DataFrame,
    features: Sequence[str],
    k: int = 5,
    settings: TreeSettings = TreeSettings(),
    roles: LabelRoles = LabelRoles(),
    model: str = "gbt",
    feature_set: str = "all",
) -> DataFrame:
    """k-fold boosted trees: each labelled user scored by the model that did not see it,
    users to score by the mean of the k models.

    The held-out fold also says which round is the best.
    """
    every = fold_scores(matrix, features, k, settings, roles)
    return average_fold_scores(every, model, settings.seed, feature_set, roles)


def leaf_values(model: GBTClassificationModel) -> np.ndarray:
    """One row per tree: what each leaf, from left to right, adds to the margin; its size is that of the trees.

    A tree is read from its printed form, in which numbers are exact and leaves come in the order of their indices.
    """
    found = [[float(x) for x in re.findall(r"Predict: (\S+)", tree.toDebugString)] for tree in model.trees]
    out = np.zeros((len(found), max(map(len, found))))
    for row, (values, weight) in enumerate(zip(found, model.treeWeights, strict=True)):
        out[row, : len(values)] = np.array(values) * weight
    return out


def staged_margins(model: GBTClassificationModel, rows: DataFrame, keep: Sequence[str], first: int, last: int) -> DataFrame:
    """Rows (keep…, round, margin): the running sum of the trees after each of the rounds ``first`` to ``last``."""
    values = rows.sparkSession.sparkContext.broadcast(leaf_values(model))
    leaves = model.copy().setLeafCol("__leaves").transform(rows).select(*keep, vector_to_array("__leaves").alias("__leaves"))

    def stage(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        added = values.value[:last]
        tree = np.arange(len(added))
        for whole in batches:
            # few rows at a time: each becomes one per round
            for start in range(0, whole.num_rows, 256):
                batch = whole.slice(start, 256)
                at = batch.column(len(keep))
                leaf = at.flatten().to_numpy().reshape(len(at), -1)[:, : len(added)].astype(np.int64)
                margins = np.cumsum(added[tree, leaf], axis=1)[:, first - 1 :]
                repeated = pa.array(np.repeat(np.arange(len(at)), margins.shape[1]))
                columns = [batch.column(i).take(repeated) for i in range(len(keep))]
                rounds = np.tile(np.arange(first, first + margins.shape[1], dtype=np.int32), len(at))
                yield pa.record_batch([*columns, pa.array(rounds), pa.array(margins.ravel())], names=[*keep, "round", "margin"])

    kept = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in leaves.schema.fields[: len(keep)])
    return leaves.mapInArrow(stage, f"{kept}, round int, margin double")


@dataclass(frozen=True)
class Boosted:
    """Trees, the round with the highest AUC on the held-out rows, that AUC, and the rounds looked at."""

    model: GBTClassificationModel
    best_round: int
    auc: float | None
    looked_at: int


def _boost(known: DataFrame, rounds: int, settings: TreeSettings) -> GBTClassificationModel:
    return GBTClassifier(
        featuresCol="features",
        labelCol="label",
        maxIter=rounds,
        maxDepth=settings.depth,
        stepSize=settings.step,
        subsamplingRate=settings.rows_share,
        featureSubsetStrategy=settings.columns_share,
        minInstancesPerNode=settings.min_rows,
        maxBins=settings.bins,
        seed=settings.seed,
        **settings.extra,
    ).fit(known)


def boost_to_best_round(known: DataFrame, held_out: DataFrame, settings: TreeSettings) -> Boosted:
    """Boosted trees of ``known``, and their best round on ``held_out`` (both with ``label`` and ``features``).

    A round costs as much as any other, so as many are trained as patience asks for: twice its number at first, and twice
    as many again while the AUC still rises. A longer run starts with the same trees, so rounds that have been looked at
    are not looked at again. The AUCs of ``patience`` rounds at a time are exact and come from one grouped
    pass. Of equal AUCs the earliest round counts; without both classes held out there is no AUC, and the first training
    counts with all its rounds.
    """
    best, best_auc, seen = 0, None, 0
    rounds = min(settings.rounds, 2 * settings.patience)
    while True:
        model = _boost(known, rounds, settings)
        while seen < rounds and seen - best < settings.patience:
            last = min(rounds, seen + settings.patience)
            margins = staged_margins(model, held_out, ["label"], seen + 1, last)
            for r in sorted(roc_auc(margins, "margin", "label", ["round"]).collect(), key=lambda r: r["round"]):
                # patience may run out inside the block
                if r["auc"] is not None and r["round"] - best <= settings.patience and (best_auc is None or r["auc"] > best_auc):
                    best, best_auc = r["round"], r["auc"]
            seen = last
        if best_auc is None:
            return Boosted(model, rounds, None, rounds)
        if rounds == settings.rounds or seen - best >= settings.patience:
            return Boosted(model, best, best_auc, min(seen, best + settings.patience))
        rounds = min(settings.rounds, 2 * rounds)


def feature_vector(features: Sequence[str]) -> Column:
    """The features as one vector, NULL as ``MISSING``; a value that is not a number is an error."""
    numbers = F.array(*[F.coalesce(F.col(c).cast("double"), F.lit(MISSING)) for c in features])
    refused = F.raise_error(F.lit("a feature is not a number")).cast("array<double>")
    return array_to_vector(F.when(F.array_contains(numbers, float("nan")), refused).otherwise(numbers))


def _fit_fold(ready: DataFrame, fold: int, settings: TreeSettings, roles: LabelRoles) -> tuple[DataFrame, Boosted]:
    """(user, split, score) of the users that the fold's model did not see, at its best round; and the model."""
    labelled, outside = ready.where(F.col("label").isNotNull()), F.col(roles.fold) == fold
    trees = boost_to_best_round(labelled.where(~outside), labelled.where(outside), settings)
    unseen = ready.where(F.col("label").isNull() | outside)
    margins = staged_margins(trees.model, unseen, [roles.user, "label"], trees.best_round, trees.best_round)
    scores = margins.select(
        roles.user,
        F.when(F.col("label").isNull(), "test").otherwise("oof").alias("split"),
        # the trees were fitted to a margin of half the log odds
        (1 / (1 + F.exp(-2 * F.col("margin")))).alias("score"),
    )
    return scores, trees


def trained_runs(
    matrix: DataFrame,
    features: Sequence[str],
    k: int,
    runs: Sequence[TreeSettings],
    roles: LabelRoles = LabelRoles(),
) -> list[tuple[DataFrame, list[Boosted]]]:
    """``trained_folds`` for several settings over the same vectors, which are built once.

    Up to ``FITS_AT_ONCE`` models are fitted side by side; none depends on another.
    """
    spark = matrix.sparkSession
    rows = matrix.select(
        roles.user, F.col(roles.label).cast("double").alias("label"), roles.fold, feature_vector(features).alias("features")
    )
    ready = rows.persist()
    pool = ThreadPool(min(FITS_AT_ONCE, k * len(runs)))
    try:
        fit = inheritable_thread_target(spark)(lambda run, fold: _fit_fold(ready, fold, run, roles))
        fitted = pool.starmap(fit, [(run, fold) for run in runs for fold in range(k)], chunksize=1)
        out = []
        for i in range(len(runs)):
            scores, models = zip(*fitted[i * k : (i + 1) * k], strict=True)
            out.append((reliable_checkpoint(reduce(DataFrame.unionByName, scores)), list(models)))
        return out
    finally:
        pool.close()
        pool.join()
        ready.unpersist()


def trained_folds(
    matrix: DataFrame,
    features: Sequence[str],
    k: int = 5,
    settings: TreeSettings = TreeSettings(),
    roles: LabelRoles = LabelRoles(),
) -> tuple[DataFrame, list[Boosted]]:
    """(user, split, score) of every fold's model, at its best round, for the users it did not see; and the models."""
    return trained_runs(matrix, features, k, [settings], roles)[0]


def fold_scores(
    matrix: DataFrame,
    features: Sequence[str],
    k: int = 5,
    settings: TreeSettings = TreeSettings(),
    roles: LabelRoles = LabelRoles(),
) -> DataFrame:
    """(user, split, score) of every fold's model for the users it did not see."""
    return trained_folds(matrix, features, k, settings, roles)[0]


def average_fold_scores(
    fold_scores: DataFrame, model: str, seed: int, feature_set: str, roles: LabelRoles = LabelRoles()
) -> DataFrame:
    """Score-table rows from the scores of k fold models, of this library or of any other.

    A labelled user has the one score of its held-out fold; a user to score has k, which
    are averaged.
    """
    return (
        fold_scores.groupBy(roles.user, "split")
        .agg(F.avg("score").alias("score"))
        .select(
            roles.user,
            "split",
            F.lit(model).alias("model"),
            F.lit(seed).alias("seed"),
            F.lit(feature_set).alias("feature_set"),
            "score",
        )
    )


def ablation_scores(
    matrix: DataFrame,
    feature_sets: Mapping[str, Sequence[str]],
    seeds: Sequence[int],
    k: int = 5,
    settings: TreeSettings = TreeSettings(),
    roles: LabelRoles = LabelRoles(),
) -> DataFrame:
    """Scores of every feature set with every seed, in one score table."""
    # every feature set reads the matrix; a checkpoint computes it once and outlives executors
    matrix = reliable_checkpoint(matrix)
    seeded = [replace(settings, seed=seed) for seed in seeds]
    tables = [
        average_fold_scores(every, "gbt", run.seed, name, roles)
        for name, columns in feature_sets.items()
        for run, (every, _) in zip(seeded, trained_runs(matrix, columns, k, seeded, roles), strict=True)
    ]
    return reduce(DataFrame.unionByName, tables)


def roc_auc(df: DataFrame, score: str, label: str, groups: Sequence[str] = (), bucket_rows: int | None = None) -> DataFrame:
    """Exact ROC AUC, overall or per group; equal scores count half."""
    groups = list(groups)
    y = F.col(label)
    known = df.where(y.isNotNull() & F.col(score).isNotNull())
    by_score = known.groupBy(*groups, score).agg(
        F.sum(y.cast("long")).alias("__pos"), F.sum(1 - y.cast("long")).alias("__neg")
    )
    order = [*groups, score]
    below = global_running(by_score, order, {"__below": F.col("__neg")}, groups, inclusive=False, bucket_rows=bucket_rows)
    wide = "decimal(38,0)"
    twice = F.col("__pos").cast("decimal(19,0)") * (2 * F.col("__below") + F.col("__neg")).cast("decimal(19,0)")
    pos, neg = F.sum("__pos"), F.sum("__neg")
    pairs = pos.cast("double") * neg.cast("double")
    auc = F.try_divide(F.sum(twice).cast(wide).cast("double") / 2, pairs)
    return below.groupBy(*groups).agg(pos.alias("n_bad"), neg.alias("n_good"), auc.alias("auc"))


def auc_summary(fold_aucs: DataFrame, auc: str = "auc") -> DataFrame:
    """Mean and population standard deviation of the fold AUCs."""
    return fold_aucs.agg(F.avg(auc).alias("auc_mean"), F.stddev_pop(auc).alias("auc_std"))


@dataclass(frozen=True)
class Member:
    """A scored run inside a blend family, with its weight there."""

    model: str
    seed: int
    feature_set: str
    weight: float


def blend_scores(
    scores: DataFrame,
    families: Mapping[str, Sequence[Member]],
    weights: Mapping[str, float],
    roles: LabelRoles = LabelRoles(),
) -> DataFrame:
    """Average the runs of each family, min-max scale, and add up with the family weights.

    Each split is scaled by its own minimum and maximum. Runs are matched by key, in one
    aggregate over the score table.
    """
    averaged = []
    for name, members in families.items():
        share = F.lit(None).cast("double")
        for m in members:
            hit = (F.col("model") == m.model) & (F.col("seed") == m.seed) & (F.col("feature_set") == m.feature_set)
            share = F.when(hit, F.lit(m.weight)).otherwise(share)
        averaged.append(F.sum(F.col("score") * share).alias(name))
    wide = scores.groupBy(roles.user, "split").agg(*averaged)
    extremes = wide.groupBy("split").agg(
        *[f(n).alias(f"__{side}_{n}") for n in families for side, f in (("lo", F.min), ("hi", F.max))]
    )
    # one row per split
    scaled = wide.join(F.broadcast(extremes), "split")
    blend = F.lit(0.0)
    for n, w in weights.items():
        blend = blend + w * min_max(F.col(n), F.col(f"__lo_{n}"), F.col(f"__hi_{n}"))
    return scaled.select(roles.user, "split", *families, blend.alias("blend"))
