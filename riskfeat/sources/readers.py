"""Reading the seven input files, with declared schemas.

Numbers may be written with or without a fraction: files made by tools that keep gaps as floating point have
``3.0`` for 3. Counts and amounts are read as doubles; codes and labels are whole numbers, and ``3.0`` is 3 there too.
The usual texts for a missing value (``MISSING``) are NULL in every column. Any other text that is no number (or no
whole number where one is needed) is never dropped silently: it stops the read, or is counted, or goes to a side table.
Files without a declared schema get their types from all their rows, in one pass.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DataType, DoubleType, IntegerType, LongType, StringType, StructField, StructType

from riskfeat.functions.scalars import with_relative_time

# fixed values: the column names of the input files
ORDINAL_COLUMNS = ["balance", "balance_avg", "balance1", "balance1_avg", "balance2", "balance2_avg"] + [
    f"product{i}_amount" for i in range(1, 7)
]
TEXT_COLUMNS = [
    "sex", "provider", "level", "verified", "regist_type",
    "agreement1", "agreement2", "agreement3", "agreement4", "service3",
]
PLACE_COLUMNS = ["province", "city"]
NUMBER_COLUMNS = [
    "age", "using_time", "card_a_cnt", "card_b_cnt", "card_c_cnt", "card_d_cnt",
    "agreement_total", "acc_count", "op1_cnt", "op2_cnt", "service1_cnt", "service1_amt", "service2_cnt",
    "login_cnt_period1", "login_cnt_period2", "login_cnt_avg", "login_days_cnt", "ip_cnt",
    "product7_cnt", "product7_fail_cnt",
]


def _schema(text: list[str], whole: list[str] = (), small: list[str] = (), number: list[str] = ()) -> StructType:
    return StructType(
        [StructField(c, StringType()) for c in text]
        + [StructField(c, LongType()) for c in whole]
        + [StructField(c, DoubleType()) for c in number]
        + [StructField(c, IntegerType()) for c in small]
    )


LABEL_SCHEMA = _schema(["user"], small=["label"])
BASE_SCHEMA = _schema(["user", *TEXT_COLUMNS, *ORDINAL_COLUMNS, "service3_level"], PLACE_COLUMNS, number=NUMBER_COLUMNS)
TRANS_SCHEMA = _schema(
    ["user", "platform", "tunnel_in", "tunnel_out", "type1", "type2", "ip", "ip_3", "tm_diff"], number=["amount"]
)
OP_SCHEMA = _schema(["user", "op_type", "op_mode", "op_device", "ip", "ip_3", "net_type", "channel", "tm_diff"])


# fixed values: texts for a missing value
MISSING = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA",
    "NULL", "NaN", "None", "n/a", "nan", "null",
)
# fixed values: texts for truth values
TRUTH = ("True", "TRUE", "true", "False", "FALSE", "false")


def present(text: Column) -> Column:
    """The text, or NULL if it stands for a missing value; blanks around such a text do not matter."""
    return F.when(~F.trim(text).isin(*MISSING), text)


def _typed(text: Column, kind: DataType) -> Column:
    """The text as a value of the type; NULL for a missing value, and for a text that does not fit."""
    text = present(text)
    if isinstance(kind, StringType):
        return text
    if isinstance(kind, DoubleType):
        number = F.trim(text).try_cast(kind)
        return F.when(~F.isnan(number), number)
    exact = F.trim(text).try_cast("decimal(38,10)")
    return F.when(exact == F.floor(exact), exact.try_cast(kind))


def _misfit(text: Column, kind: DataType) -> Column:
    """Whether a text that is there does not fit the type."""
    return F.lit(False) if isinstance(kind, StringType) else present(text).isNotNull() & _typed(text, kind).isNull()


def read_texts(spark: SparkSession, path: str) -> DataFrame:
    """A headed CSV file or folder with every field as it is written."""
    header = spark.read.option("header", True).csv(path).columns
    return spark.read.option("header", True).schema(StructType([StructField(c, StringType()) for c in header])).csv(path)


def column_types(texts: DataFrame) -> DataFrame:
    """What the columns of a file of texts hold, from all its rows: (column, kind, n_rows, n_missing, n_whole, n_number).

    Per column the texts are counted that are truth values, whole numbers and numbers; counts add up in any order, so
    one aggregate over all rows does, and files can be taken together. The kind is the narrowest of boolean, long, double
    and string that all present texts fit, and ``none`` if there are none. ``3.0`` is a number but no whole number here.
    """
    sums = [F.count(F.lit(1)).alias("rows")]
    for i, c in enumerate(texts.columns):
        text = F.trim(present(F.col(f"`{c}`")))
        number = text.try_cast("double")
        tests = {
            "there": text.isNotNull(),
            "truth": text.isin(*TRUTH),
            "whole": text.rlike(r"^[+-]?[0-9]+$") & text.try_cast("long").isNotNull(),
            "number": number.isNotNull() & ~F.isnan(number),
        }
        sums += [F.count_if(test).alias(f"{name}{i}") for name, test in tests.items()]
    entries = []
    for i, c in enumerate(texts.columns):
        there = F.col(f"there{i}")
        kind = (
            F.when(there == 0, "none")
            .when(F.col(f"truth{i}") == there, "boolean")
            .when(F.col(f"whole{i}") == there, "long")
            .when(F.col(f"number{i}") == there, "double")
            .otherwise("string")
        )
        entries.append(
            F.struct(
                F.lit(c).alias("column"), kind.alias("kind"), F.col("rows").alias("n_rows"), (F.col("rows") - there).alias("n_missing"),
                F.col(f"whole{i}").alias("n_whole"), F.col(f"number{i}").alias("n_number"),
            )
        )
    return texts.agg(*sums).select(F.inline(F.array(*entries)))


def inferred_schema(texts: DataFrame) -> StructType:
    """The schema of a file of texts by ``column_types``; a column without any text is a string."""
    kinds = {"boolean": BooleanType(), "long": LongType(), "double": DoubleType()}
    found = {r["column"]: r["kind"] for r in column_types(texts).collect()}
    return StructType([StructField(c, kinds.get(found[c], StringType())) for c in texts.columns])


def read_inferred(spark: SparkSession, path: str) -> DataFrame:
    """A headed CSV file or folder with the types that its own rows have."""
    texts = read_texts(spark, path)
    out = []
    for f in inferred_schema(texts).fields:
        text = F.col(f"`{f.name}`")
        truth = isinstance(f.dataType, BooleanType)
        out.append((present(text).try_cast("boolean") if truth else _typed(text, f.dataType)).alias(f.name))
    return texts.select(*out)


def read_with_rejects(spark: SparkSession, path: str, schema: StructType) -> tuple[DataFrame, DataFrame]:
    """The file with its declared types, a field that does not fit as NULL, and the fields that do not fit.

    The side table has one row per such field: ``row`` (a hash of the row as it is written), ``column``, ``kind`` and ``text``.
    """
    texts = read_texts(spark, path)
    known = {f.name: f.dataType for f in schema.fields if f.name in texts.columns}
    rows = texts.select(*[_typed(F.col(f"`{c}`"), known[c]).alias(c) if c in known else F.col(f"`{c}`") for c in texts.columns])
    fields = F.array(
        *[
            F.struct(
                F.lit(c).alias("column"), F.lit(kind.simpleString()).alias("kind"), F.col(f"`{c}`").alias("text"),
                _misfit(F.col(f"`{c}`"), kind).alias("misfit"),
            )
            for c, kind in known.items()
        ]
    )
    row = F.xxhash64(*[F.col(f"`{c}`") for c in texts.columns]).alias("row")
    rejects = texts.select(row, F.inline(F.filter(fields, lambda f: f["misfit"]))).drop("misfit")
    return rows, rejects


def read_csv(spark: SparkSession, path: str, schema: StructType, rejected: str | None = None) -> DataFrame:
    """A headed CSV file or folder; columns are matched to the schema by name, others stay texts.

    A field that does not fit its type stops the read with its column and text. With ``rejected`` it is NULL
    instead, and a column of that name has the number of such fields in the row.
    """
    rows = read_texts(spark, path)
    known = {f.name: f.dataType for f in schema.fields}
    out, misfits = [], []
    for c in rows.columns:
        text = F.col(f"`{c}`")
        if c not in known:
            out.append(text)
            continue
        value = _typed(text, known[c])
        if not isinstance(known[c], StringType):
            misfit = _misfit(text, known[c])
            misfits.append(F.coalesce(misfit.cast("int"), F.lit(0)))
            if rejected is None:
                told = F.concat(F.lit(f"{path}: {c} cannot be "), text)
                value = F.when(misfit, F.raise_error(told).cast(known[c])).otherwise(value)
        out.append(value.alias(c))
    if rejected is not None:
        out.append(sum(misfits, F.lit(0)).alias(rejected))
    return rows.select(*out)


@dataclass(frozen=True)
class RiskInput:
    """Labelled and unlabelled profiles in one table, and the two event logs."""

    profile: DataFrame
    trans: DataFrame
    op: DataFrame
    labels: DataFrame


def read_logs(spark: SparkSession, root: str, name: str, schema: StructType, test: str) -> DataFrame:
    """Train and test log together, with time parts and a stable row id."""
    both = read_csv(spark, f"{root}/train/train_{name}.csv", schema).unionByName(
        read_csv(spark, f"{root}/test/{test}_{name}.csv", schema)
    )
    timed = with_relative_time(both, "tm_diff")
    # rows alike in every column are interchangeable, so a hash of the row settles ties
    return timed.withColumn("seq", F.xxhash64(*both.columns))


def read_risk_input(spark: SparkSession, root: str, test: str = "testb") -> RiskInput:
    """All seven files. Rows to score have a NULL label."""
    labels = read_csv(spark, f"{root}/train/train_label.csv", LABEL_SCHEMA)
    train = labels.join(read_csv(spark, f"{root}/train/train_base.csv", BASE_SCHEMA), "user", "left")
    score = read_csv(spark, f"{root}/test/{test}_base.csv", BASE_SCHEMA)
    return RiskInput(
        train.unionByName(score, allowMissingColumns=True),
        read_logs(spark, root, "trans", TRANS_SCHEMA, test),
        read_logs(spark, root, "op", OP_SCHEMA, test),
        labels,
    )


def split_labelled(df: DataFrame, label: str = "label") -> tuple[DataFrame, DataFrame]:
    """Rows with a label, and rows to score."""
    return df.where(F.col(label).isNotNull()), df.where(F.col(label).isNull())
