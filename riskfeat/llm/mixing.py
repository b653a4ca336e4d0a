"""Mixing sources to target weights.

Every document gets a hash-random key. Within a source documents are in the order of their keys; a
source gives all of its documents as many whole times as its budget holds, then those before the
cut, and the document at the cut gives just the words that are still missing. The cut comes
from prefix sums in two steps: totals per range of keys, then the rows of the one range
with the cut. Keys are uniform, so equal ranges of them are equally full and no task takes a whole source.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskfeat.llm.text import WORD, broadcast_if_small, fresh, word_count, written

WEIGHTS = (5, 2, 1)
MOST_EPOCHS = 3
RANGE_ROWS = 2_000
KEY_RANGES = 16**8


def _source_key(source: Column) -> Column:
    """Never NULL, so that it can be joined on."""
    return F.coalesce(F.concat(F.lit("s"), source), F.lit("n"))


def _random_key(doc_id: Column, seed: str) -> Column:
    return F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("null"))))


def _sized(docs: DataFrame, seed: str) -> DataFrame:
    return docs.select(
        "doc_id",
        _source_key(F.col("source")).alias("source_key"),
        "source",
        word_count(F.col("text")).alias("size"),
        _random_key(F.col("doc_id"), seed).alias("key"),
    )


def source_targets(sized: DataFrame, weights: Sequence[int] = WEIGHTS, epochs: int = MOST_EPOCHS) -> DataFrame:
    """(source_key, source, source_size, n_docs, target): budgets by weight, at most ``epochs`` times a source.

    One row per source goes through the windows, never the documents. A source is capped if its
    fair share, once all sources with a smaller size per weight are capped, is above its cap.
    """
    by_source = sized.groupBy("source_key").agg(
        F.first("source").alias("source"), F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("n_docs")
    )
    rank = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), (rank % len(weights)).cast("int") + 1)
    weighed = by_source.withColumn("weight", weight).withColumn("cap", F.lit(epochs) * F.col("source_size"))
    fullest = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
    before = fullest.rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy(F.lit(0))
    exact = "decimal(38,0)"
    share = weighed.select(
        "*",
        (F.sum("source_size").over(everything) - F.coalesce(F.sum("cap").over(before), F.lit(0))).alias("rest"),
        (F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0))).alias("rest_weight"),
    ).withColumn(
        "capped",
        F.col("cap").cast(exact) * F.col("rest_weight") <= F.col("rest").cast(exact) * F.col("weight"),
    )
    # the first source that is not capped sets the level for all that follow it
    level = F.first(F.when(~F.col("capped"), F.struct("rest", "rest_weight")), ignorenulls=True).over(
        fullest.rowsBetween(Window.unboundedPreceding, 0)
    )
    target = F.when(level.isNull(), F.col("cap").cast("double")).otherwise(
        F.col("weight") * level["rest"].cast("double") / level["rest_weight"]
    )
    return share.select("source_key", "source", "source_size", "n_docs", target.alias("target"))


def mix_plan(
    docs: DataFrame,
    weights: Sequence[int] = WEIGHTS,
    epochs: int = MOST_EPOCHS,
    seed: str = "mix",
    range_rows: int = RANGE_ROWS,
) -> tuple[DataFrame, DataFrame]:
    """The sized documents, and one row per source: its target, whole epochs, cut key and words at the cut.

    Documents with an id, source and size in common are cut alike. Empty texts have size 0.
    """
    sized = written(_sized(docs, seed), "sized")
    targets = written(source_targets(sized, weights, epochs), "targets")
    budget = F.floor(F.col("target") + 0.5).cast("long")
    some = F.greatest(F.col("source_size"), F.lit(1))
    goals = targets.select(
        "*",
        F.floor(budget / some).cast("long").alias("whole"),
        F.pmod(budget, some).alias("rest"),
        # about range_rows documents to a range
        F.greatest(F.lit(1), F.ceil(F.col("n_docs") / range_rows)).alias("ranges"),
    )
    by_key = (
        sized.join(broadcast_if_small(goals), "source_key")
        .where(F.col("rest") > 0)
        .select(
            "source_key",
            "key",
            "size",
            "rest",
            F.floor(F.conv(F.substring("key", 1, 8), 16, 10).cast("long") * F.col("ranges") / KEY_RANGES).alias("range"),
        )
    )
    in_order = Window.partitionBy("source_key").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    cut_range = (
        by_key.groupBy("source_key", "range")
        .agg(F.sum("size").alias("total"), F.first("rest").alias("rest"))
        .withColumn("before", F.coalesce(F.sum("total").over(in_order), F.lit(0)))
        .where((F.col("before") < F.col("rest")) & (F.col("rest") <= F.col("before") + F.col("total")))
        .select("source_key", "range", "before")
    )
    # one row per source
    cut_range = broadcast_if_small(written(cut_range, "cut-ranges"))
    inside = Window.partitionBy("source_key").orderBy("key").rowsBetween(Window.unboundedPreceding, -1)
    cut = (
        by_key.join(cut_range, ["source_key", "range"])
        .groupBy("source_key", "key")
        .agg(
            F.sum("size").alias("total"),
            F.max("size").alias("size"),
            F.first("rest").alias("rest"),
            F.first("before").alias("before"),
        )
        .withColumn("before", F.col("before") + F.coalesce(F.sum("total").over(inside), F.lit(0)))
        .where((F.col("before") < F.col("rest")) & (F.col("rest") <= F.col("before") + F.col("total")))
        # rows that repeat an id share the words that are missing
        .select(
            "source_key",
            F.col("key").alias("cut_key"),
            F.ceil((F.col("rest") - F.col("before")) * F.col("size") / F.col("total")).cast("long").alias("cut_words"),
        )
    )
    cuts = goals.select("source_key", "source_size", "target", "whole").join(cut, "source_key", "left")
    return sized, broadcast_if_small(written(cuts, "cuts"))


def _part(key: Column, size: Column) -> Column:
    """Words of the last, partial epoch that a document gives."""
    return F.when(key < F.col("cut_key"), size).when(key == F.col("cut_key"), F.least(size, F.col("cut_words"))).otherwise(0)


def mix_amounts(docs: DataFrame, **options) -> DataFrame:
    """(doc_id, size, source_size, target, taken) of every document; NULL sources are one source, the last.

    A NULL or empty text has size 0 and nothing is taken of it. Every row is a document of its own, those with a
    repeated or NULL doc_id too. An empty table gives no rows.
    """
    sized, cuts = mix_plan(docs, **options)
    taken = F.col("whole") * F.col("size") + _part(F.col("key"), F.col("size"))
    return sized.join(cuts, "source_key").select("doc_id", "size", "source_size", "target", taken.cast("long").alias("taken"))


def mix(docs: DataFrame, seed: str = "mix", **options) -> DataFrame:
    """The documents of the mix, all columns kept: one row per epoch, the one at the cut shortened to its first words.

    Empty texts carry no words: they come with the whole epochs and before the cut. A column ``n_chars``, if
    there is one, follows the text. Reruns give the same rows.
    """
    _, cuts = mix_plan(docs, seed=seed, **options)
    key, source, size, copy = (fresh(docs, f"__{n}") for n in ("key", "source", "size", "copy"))
    renamed = cuts.select(F.col("source_key").alias(source), "cut_key", "cut_words", "whole")
    named = {c: fresh(docs, f"__{c}") for c in ("cut_key", "cut_words", "whole")}
    keyed = docs.withColumns(
        {
            source: _source_key(F.col("source")),
            key: _random_key(F.col("doc_id"), seed),
            size: word_count(F.col("text")),
        }
    ).join(renamed.withColumnsRenamed(named), source)
    k, n, cut_key, cut_words, whole = (F.col(c) for c in (key, size, named["cut_key"], named["cut_words"], named["whole"]))
    last = F.when((k < cut_key) | ((k == cut_key) & (n <= cut_words)), F.lit(-1)).when(k == cut_key, cut_words)
    # -1: the whole text
    copies = F.concat(F.array_repeat(F.lit(-1).cast("long"), whole.cast("int")), F.array_compact(F.array(last.cast("long"))))
    pieces = F.regexp_extract_all("text", F.lit(f"[\\x20\\x09-\\x0D]*{WORD}"), F.lit(0))
    start = F.array_join(F.slice(pieces, F.lit(1), F.greatest(F.col(copy), F.lit(0)).cast("int")), "")
    text = F.when(F.col(copy) < 0, F.col("text")).otherwise(start)
    out = {c: F.col(c) for c in docs.columns} | {"text": text}
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        out["n_chars"] = F.when(F.col(copy) < 0, F.col("n_chars")).otherwise(F.length(text)).cast(kind)
    return keyed.withColumn(copy, F.explode(copies)).select(*[c.alias(n) for n, c in out.items()])


ORACLE_AMOUNTS = """
WITH sized AS (
  SELECT doc_id, source, md5('mix:' || coalesce(CAST(doc_id AS VARCHAR), 'null')) AS key,
    CAST(coalesce(len(regexp_extract_all(text, '[^ \\x09-\\x0D]+')), 0) AS BIGINT) AS size
  FROM documents),
sources AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
    list_value(5, 2, 1)[1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3] AS weight
  FROM sized GROUP BY source),
shares AS (
  SELECT *, 3 * source_size AS cap,
    sum(source_size) OVER () - coalesce(sum(3 * source_size) OVER fullest, 0) AS rest,
    sum(weight) OVER () - coalesce(sum(weight) OVER fullest, 0) AS rest_weight
  FROM sources
  WINDOW fullest AS (ORDER BY CAST(3 * source_size AS DOUBLE) / weight, source NULLS LAST
                     ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
levels AS (
  SELECT *, cap * rest_weight <= rest * weight AS capped FROM shares),
level AS (
  SELECT rest, rest_weight FROM levels WHERE NOT capped
  ORDER BY CAST(cap AS DOUBLE) / weight, source NULLS LAST LIMIT 1),
targets AS (
  SELECT l.source, l.source_size,
    CASE WHEN l.capped THEN CAST(l.cap AS DOUBLE)
      ELSE l.weight * CAST((SELECT rest FROM level) AS DOUBLE) / CAST((SELECT rest_weight FROM level) AS DOUBLE) END AS target
  FROM levels l),
placed AS (
  SELECT s.doc_id, s.size, t.source_size, t.target, CAST(floor(t.target + 0.5) AS BIGINT) AS budget,
    coalesce(sum(s.size) OVER (PARTITION BY s.source ORDER BY s.key ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
  FROM sized s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target,
  CAST((budget // greatest(source_size, 1)) * size
    + greatest(0, least(size, budget % greatest(source_size, 1) - before)) AS BIGINT) AS taken
FROM placed
"""
