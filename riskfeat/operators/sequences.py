"""Per-user event sequences: the first n events as coded and scaled arrays, padded."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskfeat.operators.grouping import unpivot
from riskfeat.operators.ordered import dense_codes
from riskfeat.operators.profile import zscore
from riskfeat.operators.sessions import user_order
from riskfeat.operators.skew import lookup_join
from riskfeat.roles import EventRoles
from riskfeat.session import reliable_checkpoint

POSITION = "__pos"


def first_events(df: DataFrame, n: int, roles: EventRoles = EventRoles()) -> DataFrame:
    """The first n rows of every user. Spark limits each user map-side before shuffling."""
    order = Window.partitionBy(roles.user).orderBy(*user_order(df, roles).columns)
    return df.withColumn(POSITION, F.row_number().over(order)).where(F.col(POSITION) <= n)


def appearance_codes(top: DataFrame, columns: Sequence[str], roles: EventRoles = EventRoles()) -> DataFrame:
    """Codes 1, 2, … per column in the order values first appear by (user, position)."""
    long = unpivot(top, [roles.user, POSITION], columns)
    first = long.groupBy("column", "value").agg(
        F.min(F.struct(roles.user, POSITION)).alias("__first"), F.count(F.lit(1)).alias("__rows")
    )
    return dense_codes(first, ["column", "__first"], "code", start=1, groups=["column"])


def vocabulary_sizes(codes: DataFrame) -> DataFrame:
    """Number of codes per column, counting 0, the padding."""
    return codes.groupBy("column").agg((F.count(F.lit(1)) + 1).alias("vocabulary"))


def _truncated(
    df: DataFrame, categories: Sequence[str], numbers: Sequence[str], n: int, roles: EventRoles
) -> DataFrame:
    top = first_events(df, n, roles)
    return top.select(
        roles.user,
        POSITION,
        *[F.coalesce(F.col(c).cast("string"), F.lit("0")).alias(c) for c in categories],
        *[F.coalesce(F.col(c).cast("double"), F.lit(0.0)).alias(c) for c in numbers],
    )


def user_sequences(
    df: DataFrame,
    categories: Sequence[str],
    numbers: Sequence[str] = (),
    n: int = 200,
    roles: EventRoles = EventRoles(),
    hot_rows: int | None = None,
) -> DataFrame:
    """One row per user with an array per column, in time order, at most n long.

    Codes and z-scores are fitted on the truncated rows. Missing values count as 0.
    """
    top = _truncated(df, categories, numbers, n, roles)
    codes = reliable_checkpoint(appearance_codes(top, categories, roles))
    coded = zscore(top, list(numbers)) if numbers else top
    for c in categories:
        of_column = codes.where(F.col("column") == c).select(
            F.col("value").alias(c), F.col("code").alias("__code"), "__rows"
        )
        coded = lookup_join(coded, of_column, [c], "__rows", hot_rows).withColumn(c, F.col("__code"))
        coded = coded.drop("__code", "__rows")
    step = F.struct(POSITION, *categories, *numbers)
    lists = coded.groupBy(roles.user).agg(F.array_sort(F.collect_list(step)).alias("__steps"))
    return lists.select(roles.user, *[F.col("__steps")[c].alias(c) for c in (*categories, *numbers)])


def pad(values: Column, length: Column, filler: Column) -> Column:
    """Cut or fill an array to a length; a missing array counts as one filler."""
    filled = F.coalesce(values, F.array(filler))
    return F.slice(F.concat(filled, F.array_repeat(filler, length.cast("int"))), F.lit(1), length.cast("int"))


def pad_sequences(df: DataFrame, columns: Sequence[str], length: int | None = None) -> DataFrame:
    """Pad arrays with 0 to one length (the longest row's unless given) and add ``seq_len``."""
    size = F.size(F.coalesce(F.col(columns[0]), F.array(F.lit(0))))
    if length is None:
        longest = df.agg(F.max(F.greatest(size, F.lit(1))).alias("longest")).scalar()
    else:
        longest = F.lit(length)
    kinds = {f.name: f.dataType.elementType for f in df.schema.fields if f.name in columns}
    return df.withColumn("seq_len", size).withColumns(
        {c: pad(F.col(c), longest, F.lit(0).cast(kinds[c])) for c in columns}
    )
