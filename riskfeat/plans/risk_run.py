"""The whole run: read, build, score, evaluate, blend, write."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskfeat.operators import scoring
from riskfeat.plans.feature_matrix import BLEND_FAMILIES, BLEND_WEIGHTS
from riskfeat.plans.risk_features import USER, RunSettings, build_matrices, evaluate, score_runs
from riskfeat.roles import LabelRoles
from riskfeat.sources.readers import read_risk_input
from riskfeat.sources.sinks import read_scores, write_scores, write_submission


def blend_and_write(
    scores: DataFrame,
    labels: DataFrame,
    folder: str,
    families: Mapping[str, Sequence[scoring.Member]] = BLEND_FAMILIES,
    weights: Mapping[str, float] = BLEND_WEIGHTS,
) -> DataFrame:
    """Write the best single run, the seed average and the final blend; return their AUCs."""
    single = scores.where((F.col("model") == "gbt") & (F.col("seed") == 2020) & (F.col("feature_set") == "all"))
    blended = scoring.blend_scores(scores, families, weights, LabelRoles(user=USER))
    candidates = {
        "single": (single, "score"),
        "averaged": (blended, next(iter(families))),
        "blended": (blended, "blend"),
    }
    tables = []
    for name, (table, column) in candidates.items():
        write_submission(table.where(F.col("split") == "test"), f"{folder}/{name}", USER, column)
        tables.append(evaluate(table, labels, column).select(F.lit(name).alias("candidate"), "auc"))
    return tables[0].unionByName(tables[1]).unionByName(tables[2])


def run(
    spark: SparkSession,
    root: str,
    work: str,
    settings: RunSettings = RunSettings(),
    other_scores: DataFrame | None = None,
    families: Mapping[str, Sequence[scoring.Member]] | None = None,
    weights: Mapping[str, float] | None = None,
) -> DataFrame:
    """Everything from the input files to the three score files.

    ``other_scores`` adds runs of outside models (a sequence network, say) to the score
    table. Without them the blend is made of the tree families alone.
    """
    source = read_risk_input(spark, root)
    matrices = build_matrices(source, f"{work}/features", settings)
    write_scores(score_runs(matrices, settings), f"{work}/scores", "trees")
    if other_scores is not None:
        write_scores(other_scores, f"{work}/scores", "other")
    if families is None:
        families = {n: m for n, m in BLEND_FAMILIES.items() if other_scores is not None or n != "sequence"}
        weights = {n: w for n, w in BLEND_WEIGHTS.items() if n in families}
    return blend_and_write(read_scores(spark, f"{work}/scores"), source.labels, f"{work}/submission", families, weights)
