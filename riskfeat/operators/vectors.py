"""Text-like vectors of what a user's values are: weights, SVD and embeddings.

A user's values are never gathered into one document: all vectors start from counts
per (user, term), so a user with a third of the rows is many small counts. Value vectors factorise the counts
of neighbours in time; they are tables like any other and never pass the driver.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskfeat.operators.ordered import positions
from riskfeat.operators.sessions import user_order
from riskfeat.operators.skew import Hot, find_hot, lookup_join
from riskfeat.roles import EventRoles
from riskfeat.session import reliable_checkpoint

# fixed value: a word is a run of two or more letters, digits or underscores
WORD_PATTERN = r"[\p{L}\p{N}_]{2,}"
SENTENCE_WORDS = 1000
CONTEXT_WORDS = 10
# fixed value: frequent contexts are damped by this power
CONTEXT_POWER = 0.75
# terms whose document counts are broadcast, and the longest of them: at most 25 MB of text
COMMON_TERMS = 200_000
COMMON_TERM_BYTES = 128


def words(text: Column) -> Column:
    """Lower-case words of at least two characters."""
    return F.regexp_extract_all(F.lower(text), F.lit(WORD_PATTERN), F.lit(0))


def term_counts(df: DataFrame, key: str, text: str, hot_rows: int | None = None) -> DataFrame:
    """Rows (key, term, tf). A NULL text counts as the word ``nan``.

    The texts are dealt out by their key before they are split, so a key's terms stay together for what follows; their words
    are several times as large. With hot keys the words are dealt out instead.
    """
    value = F.coalesce(F.col(text).cast("string"), F.lit("nan"))
    texts = df.where(F.col(key).isNotNull()).select(key, value.alias("__text"))
    if find_hot(df, [key], hot_rows) is None:
        texts = texts.repartition(key)
    exploded = texts.select(key, F.explode(words(F.col("__text"))).alias("term"))
    return exploded.groupBy(key, "term").agg(F.count(F.lit(1)).alias("tf"))


def value_term_counts(df: DataFrame, key: str, value: str) -> DataFrame:
    """``term_counts`` for repeated short values: rows are counted before they are split."""
    text = F.coalesce(F.col(value).cast("string"), F.lit("nan"))
    counted = df.where(F.col(key).isNotNull()).groupBy(key, text.alias("__v")).agg(F.count(F.lit(1)).alias("__n"))
    exploded = counted.select(key, F.explode(words(F.col("__v"))).alias("term"), "__n")
    return exploded.groupBy(key, "term").agg(F.sum("__n").alias("tf"))


def tfidf_weights(counts: DataFrame, key: str, documents: Column, hot_rows: int | None = None) -> DataFrame:
    """Rows (key, term, weight): tf · (ln((1+N)/(1+df)) + 1), scaled to length 1 per key.

    The most common terms are looked up in a broadcast, which moves no counts; only the counts of the others are shuffled.
    """
    found = reliable_checkpoint(counts.groupBy("term").agg(F.count(F.lit(1)).alias("df")))
    short = found.where(F.octet_length("term") <= COMMON_TERM_BYTES)
    common = short.orderBy(F.col("df").desc(), "term").limit(COMMON_TERMS)
    weighted = counts.join(F.broadcast(common), ["term"], "left")
    others = found.join(F.broadcast(common), ["term"], "left_anti")
    if not others.isEmpty():
        rare = lookup_join(weighted.where(F.col("df").isNull()).drop("df"), others, ["term"], "df", hot_rows)
        # dealt out as the texts were, so that the union is not shuffled again
        weighted = weighted.where(F.col("df").isNotNull()).unionByName(rare.repartition(key))
    idf = F.log((1 + documents) / (1 + F.col("df"))) + 1
    raw = weighted.select(key, "term", (F.col("tf") * idf).alias("weight"))
    # a key has each term once, so its rows are bounded by the vocabulary
    length = F.sqrt(F.sum(F.col("weight") * F.col("weight")).over(Window.partitionBy(key)))
    return raw.select(key, "term", (F.col("weight") / length).alias("weight"))


def document_count(df: DataFrame, key: str) -> Column:
    """Number of distinct keys, as a value for ``tfidf_weights``."""
    return df.agg(F.count_distinct(key).alias("n")).scalar()


def _direction(term: Column, i: int) -> Column:
    """A standard normal number that is a function of the term and i alone."""

    def uniform(part: int) -> Column:
        return (F.pmod(F.xxhash64(term, F.lit(i), F.lit(part)), F.lit(1 << 52)) + 0.5) / float(1 << 52)

    return F.sqrt(-2 * F.log(uniform(0))) * F.cos(2 * np.pi * uniform(1))


def _matrix(batch: pa.RecordBatch) -> np.ndarray:
    vectors = batch.column(batch.schema.get_field_index("v"))
    return vectors.flatten().to_numpy().reshape(len(vectors), -1)


def _gram(rows: DataFrame, size: int) -> np.ndarray:
    """Products of all pairs of columns, summed over the rows: size x size figures reach the driver."""

    def products(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((size, size))
        for batch in batches:
            if batch.num_rows:
                m = _matrix(batch)
                total += m.T @ m
        yield pa.record_batch({"i": pa.array(range(size), pa.int32()), "p": pa.array(list(total), pa.list_(pa.float64()))})

    parts = rows.select("v").mapInArrow(products, "i int, p array<double>").select("i", F.posexplode("p").alias("j", "x"))
    out = np.zeros((size, size))
    for r in parts.groupBy("i", "j").agg(F.sum("x").alias("x")).collect():
        out[r["i"], r["j"]] = r["x"]
    return out


def _turned(rows: DataFrame, matrix: np.ndarray) -> DataFrame:
    """The vectors of the rows times a small matrix."""

    def turn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                turned = pa.array(list(_matrix(batch) @ matrix), pa.list_(pa.float64()))
                yield batch.set_column(batch.schema.get_field_index("v"), "v", turned)

    return rows.mapInArrow(turn, rows.schema)


def _vector_sum(size: int) -> Column:
    """The sum of weighted vectors, entry by entry."""
    return F.array(*[F.coalesce(F.sum(F.col("weight") * F.get("v", F.lit(i))), F.lit(0.0)) for i in range(size)]).alias("v")


def _times(weights: DataFrame, rows: DataFrame, on: str, by: str, size: int, hot: Hot) -> DataFrame:
    """The sparse rows (or their transpose) times the vectors: a join and a grouped sum."""
    return lookup_join(weights, rows, [on], hot).groupBy(by).agg(_vector_sum(size))


def _orthonormal(rows: DataFrame, size: int) -> tuple[DataFrame, np.ndarray]:
    """The same column space with orthonormal columns, longest first, and their squared lengths before.

    Directions without length become 0.
    """
    values, vectors = np.linalg.eigh(_gram(rows, size))
    values, vectors = np.maximum(values[::-1], 0.0), vectors[:, ::-1]
    kept = values > 1e-12 * max(values.max(), 1e-300)
    scale = np.where(kept, 1 / np.sqrt(np.where(kept, values, 1.0)), 0.0)
    return _turned(rows, vectors * scale), np.where(kept, values, 0.0)


@dataclass(frozen=True)
class Projection:
    """Rows projected on singular vectors (columns ``c0``, ``c1``, …), the singular values, and how far off each
    pair is: the length of ``A v - s u`` as a share of the largest singular value."""

    rows: DataFrame
    values: np.ndarray
    residuals: np.ndarray
    rounds: int


def singular_projection(
    weights: DataFrame, key: str, k: int = 10, more: int = 10, tolerance: float = 0.01, most: int = 12
) -> Projection:
    """Project sparse rows (key, term, weight) on the first k right singular vectors.

    Randomised: the rows are projected on k + ``more`` directions that are hashes of the terms, and the space is sharpened by
    multiplying by the rows and their transpose. Every round ends with a bound on its own error: with u of the
    space, ``s v = Aᵀ u`` holds exactly, so what is missing is ``|A v - s u|² = |A v|² - s²``, and both lengths
    are at hand. Rounds go on until that is at most ``tolerance`` of the largest singular value for
    the first k, ``most`` times at most. Every product is a join and a grouped sum; neither keys nor terms reach the driver
    or one task.
    """
    size = k + more
    entries = reliable_checkpoint(weights.select(key, "term", F.col("weight").cast("double").alias("weight")))
    hot_key, hot_term = find_hot(entries, [key]), find_hot(entries, ["term"])
    directions = F.array(*[_direction(F.col("term"), i) for i in range(size)])
    by_key = reliable_checkpoint(entries.withColumn("v", directions).groupBy(key).agg(_vector_sum(size)))
    for done in range(1, most + 1):
        by_term = reliable_checkpoint(_times(entries, _orthonormal(by_key, size)[0], key, "term", size, hot_key))
        right, squares = _orthonormal(by_term, size)
        by_key = reliable_checkpoint(_times(entries, right, "term", key, size, hot_term))
        missing = np.maximum(np.diag(_gram(by_key, size)) - squares, 0.0)
        residuals = np.sqrt(missing / max(squares.max(), 1e-300))[:k]
        if (residuals <= tolerance).all():
            break
    rows = by_key.select(key, *[F.get("v", F.lit(i)).alias(f"c{i}") for i in range(k)])
    return Projection(rows, np.sqrt(squares[:k]), residuals, done)


def truncated_svd(weights: DataFrame, key: str, name: str, k: int = 10, more: int = 10, tolerance: float = 0.01) -> DataFrame:
    """``singular_projection`` as columns ``{name}_{i}``."""
    out = singular_projection(weights, key, k, more, tolerance).rows
    return out.withColumnsRenamed({f"c{i}": f"{name}_{i}" for i in range(k)})


def value_sentences(
    df: DataFrame, value: str, roles: EventRoles = EventRoles(), hot_rows: int | None = None
) -> DataFrame:
    """Each user's values in time order, in sentences of 1,000 words and the first words of the next one.

    The overlap is as wide as the context of a word, so no pair of neighbours is lost at a cut.
    """
    order = user_order(df, roles)
    placed = positions(df.select(value, *order.keys, *order.columns), order, "__pos", hot_rows)
    word = F.coalesce(F.col(value).cast("string"), F.lit("nan"))
    cut = F.floor((F.col("__pos") - 1) / SENTENCE_WORDS)
    # a context may be wider than a sentence
    first = F.greatest(F.floor((F.col("__pos") - 1 - CONTEXT_WORDS) / SENTENCE_WORDS), F.lit(0).cast("long"))
    grouped = placed.withColumn("__sentence", F.explode(F.sequence(first, cut))).groupBy(roles.user, "__sentence").agg(
        F.array_sort(F.collect_list(F.struct(F.col("__pos").alias("pos"), word.alias("word")))).alias("__w")
    )
    return grouped.select(roles.user, F.col("__w")["word"].alias("sentence"))


def neighbour_counts(sentences: DataFrame) -> DataFrame:
    """Rows (value, term, weight): how often two values stand within ten rows of each other in a user's time order.

    Rows next to each other count 1, a tenth less for each step further, which is how often a context of
    random width reaches that far. Both directions are listed; a value may be its own neighbour.
    """
    own = F.sequence(F.lit(0), F.least(F.size("sentence"), F.lit(SENTENCE_WORDS)) - 1)
    words = F.col("sentence")
    # the words beyond the sentence's own are those of the next one: they are partners only
    pairs = sentences.select("sentence", F.explode(own).alias("at")).select(
        F.get(words, F.col("at")).alias("one"),
        F.posexplode(F.slice(words, F.col("at") + 2, F.lit(CONTEXT_WORDS))).alias("step", "other"),
    )
    # whole tenths are added up, so that the sums do not depend on their order
    tenths = F.sum(F.lit(CONTEXT_WORDS) - F.col("step"))
    forward = pairs.groupBy("one", "other").agg(tenths.alias("n"))
    ends = F.array(F.struct(F.col("one").alias("value"), F.col("other").alias("term")), F.struct(F.col("other").alias("value"), F.col("one").alias("term")))
    both = forward.select(F.inline(ends), "n").groupBy("value", "term").agg(F.sum("n").alias("n"))
    return both.select("value", "term", (F.col("n") / float(CONTEXT_WORDS)).alias("weight"))


def neighbour_information(counts: DataFrame, hot_rows: int | None = None) -> DataFrame:
    """Rows (value, term, weight) of neighbours that meet more often than by chance: the positive part of
    ``ln(p(value, term) / (p(value) p'(term)))`` with p' damped by the power 0.75."""
    counts = reliable_checkpoint(counts)
    sums = counts.groupBy("value").agg(F.sum("weight").alias("w"), F.count(F.lit(1)).alias("__rows"))
    damped = F.pow("w", F.lit(CONTEXT_POWER))
    whole = sums.agg(F.sum(damped).alias("damped")).scalar()
    # the table is symmetric: the sums of its rows are those of its columns
    of_value = sums.select("value", F.col("w").alias("w_value"), "__rows")
    of_term = sums.select(F.col("value").alias("term"), (damped / whole).alias("p_term"), "__rows")
    known = lookup_join(counts, of_value, ["value"], "__rows", hot_rows).drop("__rows")
    known = lookup_join(known, of_term, ["term"], "__rows", hot_rows)
    information = F.log(F.col("weight") / (F.col("w_value") * F.col("p_term")))
    return known.select("value", "term", information.alias("weight")).where(F.col("weight") > 0)


def value_vectors(df: DataFrame, value: str, size: int = 10, roles: EventRoles = EventRoles(), tolerance: float = 0.01) -> DataFrame:
    """Vectors of the values of a column, from their neighbours in the users' time order: rows (value, vector array).

    A skip-gram model factorises the information that two values have on each other; here the table of
    that information is built and factorised as such. Counts and vectors stay tables of Spark, whatever the number of
    values; the result does not depend on seeds or partitions. A value without informative neighbours has no vector.
    """
    information = neighbour_information(neighbour_counts(value_sentences(df, value, roles)))
    found = singular_projection(information, "value", size, tolerance=tolerance)
    scale = [1 / np.sqrt(x) if x > 0 else 0.0 for x in found.values]
    return reliable_checkpoint(
        found.rows.select("value", F.array(*[F.col(f"c{i}") * F.lit(float(x)) for i, x in enumerate(scale)]).alias("vector"))
    )


def value_counts(df: DataFrame, value: str, roles: EventRoles = EventRoles()) -> DataFrame:
    """Rows (user, value, n_rows) with NULL as the value ``nan``."""
    word = F.coalesce(F.col(value).cast("string"), F.lit("nan"))
    return df.where(F.col(roles.user).isNotNull()).groupBy(roles.user, word.alias("value")).agg(
        F.count(F.lit(1)).alias("n_rows")
    )


def mean_vectors(
    counts: DataFrame, vectors: DataFrame, name: str, size: int, user: str, weight: Column, hot_rows: int | None = None
) -> DataFrame:
    """Per user, the weighted mean of the vectors of its values, as ``{name}_{i}``."""
    popular = counts.groupBy("value").agg(F.count(F.lit(1)).alias("__rows"))
    known = lookup_join(counts, vectors.join(popular, "value"), ["value"], "__rows", hot_rows, inner=True)
    total = F.sum(weight)
    return known.groupBy(user).agg(
        *[F.try_divide(F.sum(weight * F.col("vector")[i]), total).alias(f"{name}_{i}") for i in range(size)]
    )


def value_word2vec(
    df: DataFrame, value: str, size: int = 10, roles: EventRoles = EventRoles(), vectors: DataFrame | None = None
) -> DataFrame:
    """Per user, the mean vector of its values; ``vectors`` takes the place of fitting them."""
    vectors = value_vectors(df, value, size, roles) if vectors is None else vectors
    counts = value_counts(df, value, roles)
    named = f"{value}_w2v"
    out = mean_vectors(counts, vectors, named, size, roles.user, F.col("n_rows").cast("double"))
    return out.withColumnsRenamed({f"{named}_{i}": f"{named}_{i}_mean" for i in range(size)})


def user_doc_embedding(
    df: DataFrame, value: str, size: int = 10, roles: EventRoles = EventRoles(), vectors: DataFrame | None = None
) -> DataFrame:
    """Per user, the mean of its values' vectors, weighted by tf · idf; ``vectors`` takes the place of fitting them."""
    vectors = value_vectors(df, value, size, roles) if vectors is None else vectors
    counts = value_counts(df, value, roles)
    users = document_count(df, roles.user)
    found = counts.groupBy("value").agg(F.count(F.lit(1)).alias("df"))
    weighted = lookup_join(counts, found, ["value"], "df")
    idf = F.log((1 + users) / (1 + F.col("df"))) + 1
    return mean_vectors(weighted, vectors, f"{value}_d2v", size, roles.user, F.col("n_rows") * idf)
