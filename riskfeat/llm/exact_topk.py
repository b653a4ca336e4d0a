"""Exact top-k search by inner product: every stated query against every row.

Entries become whole numbers ``floor(64 x)``, so scores are exact. Queries and candidates are cut into blocks of bounded
size; a task gets one block of each. It turns its candidates into postings, the list of (candidate, weight) per
dimension, and a query goes through its own dimensions one by one, adding weight times weight into one score per
candidate. Each block hands on its k best, found by partition selection; the best of all blocks are merged per query.
Queries never meet in one task more candidates than a block holds, and only k rows per query and block are moved.

Defined results: a vector that is NULL or holds NULL, NaN, an infinity or an entry of 2^18 or more (its scores might pass
64 bits) takes no part; nor does a row without id. Entries that a shorter vector lacks count as 0, and empty
vectors score 0. Ties go to the smaller id. A row with the query's own id is never its candidate; rows that repeat
another id are candidates as often as they occur, and a query id with several different vectors is asked once for
each. Other columns are ignored; without queries or candidates there are no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# fixed value: entries become floor(SCALE * entry)
SCALE = 64.0
LARGEST = float(1 << 18)
TOP = 20
QUERY_EVERY = 20
# numbers in a block; a block of candidates takes 8 bytes a number in a task, twice
BLOCK_NUMBERS = 2_000_000
LEAST_ROWS = 1024
# a dimension in which this share of a block has a weight is kept as a whole column
FULL_SHARE = 0.3

ORACLE_TOP = f"""
WITH whole AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor({SCALE} * CAST(x AS DOUBLE)) AS BIGINT)) AS w
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0
), scored AS (
  SELECT q.vec_id AS query_id, c.vec_id,
    CAST(list_sum(list_transform(range(1, len(q.w) + 1), lambda i: q.w[i] * c.w[i])) AS BIGINT) AS score
  FROM whole q JOIN whole c ON c.vec_id <> q.vec_id
  WHERE q.vec_id % {QUERY_EVERY} = 0
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS place FROM scored
)
SELECT query_id, CAST(place AS INTEGER) AS rank, vec_id, score FROM ranked WHERE place <= {TOP}
"""


def _whole(vector: Column) -> Column:
    return F.transform(vector, lambda x: F.floor(x * SCALE).cast("int"))


def _matrix(vectors: pa.Array, width: int) -> np.ndarray:
    """Lists of whole numbers as rows; what a list lacks is 0."""
    sizes = vectors.value_lengths().to_numpy()
    out = np.zeros((len(vectors), width), dtype=np.int64)
    out[np.arange(width) < sizes[:, None]] = vectors.flatten().to_numpy()
    return out


def postings(rows: np.ndarray) -> list[tuple[np.ndarray | None, np.ndarray]]:
    """Per dimension the candidates with a weight and their weights; (None, column) where most have one."""
    out = []
    for column in rows.T:
        found = np.flatnonzero(column)
        out.append((None, column.copy()) if len(found) > FULL_SHARE * len(column) else (found, column[found]))
    return out


def accumulated(query: np.ndarray, lists: list[tuple[np.ndarray | None, np.ndarray]], scores: np.ndarray) -> None:
    """Scatter the weighted postings of the query's dimensions into the scores."""
    scores.fill(0)
    for dimension in np.flatnonzero(query):
        found, weights = lists[dimension]
        if found is None:
            scores += query[dimension] * weights
        else:
            scores[found] += query[dimension] * weights


def best(scores: np.ndarray, allowed: np.ndarray, k: int) -> np.ndarray:
    """Places of the k highest allowed scores; of equal ones the first places."""
    places = np.flatnonzero(allowed)
    if len(places) > k:
        values = scores[places]
        kth = np.partition(values, len(values) - k)[len(values) - k]
        above = places[values > kth]
        places = np.concatenate([above, places[values == kth][: k - len(above)]])
    return places[np.lexsort((places, -scores[places]))]


def _searched(table: pa.Table, k: int) -> Iterator[tuple[pa.RecordBatch, pa.Table, np.ndarray]]:
    """Per query of a block: its row, the k best candidates of the block, and their scores."""
    is_query = table.column("asked").to_numpy().astype(bool)
    asked, held = table.filter(pa.array(is_query)), table.filter(pa.array(~is_query)).sort_by("id")
    if not asked.num_rows or not held.num_rows:
        return
    lists = [t.column("w").combine_chunks() for t in (asked, held)]
    width = max(int(x.value_lengths().to_numpy().max(initial=0)) for x in lists)
    queries, candidates = (_matrix(x, width) for x in lists)
    ids, own = held.column("id").to_numpy(), asked.column("id").to_numpy()
    by_dimension = postings(candidates)
    scores = np.zeros(len(ids), dtype=np.int64)
    for row, query in enumerate(queries):
        accumulated(query, by_dimension, scores)
        places = best(scores, ids != own[row], k)
        yield asked.slice(row, 1), held.select(["id", "times"]).take(pa.array(places)), scores[places]


def exact_top_k(
    df: DataFrame,
    is_query: Column,
    vector: str = "embedding",
    row_id: str = "vec_id",
    k: int = TOP,
    block_numbers: int = BLOCK_NUMBERS,
) -> DataFrame:
    """Rows (query_id, rank, id, score): the k highest scores of each row of ``is_query`` among all other rows.

    See the module for NULLs, odd vectors, ties, repeated rows, empty tables and other columns.
    """
    spark = df.sparkSession
    entries = F.col(vector).cast("array<double>")
    fits = F.forall(entries, lambda x: F.coalesce(F.abs(x) < LARGEST, F.lit(False)))
    rows = df.where(F.col(row_id).isNotNull() & fits).select(
        F.col(row_id).cast("long").alias("id"), _whole(entries).alias("w"), F.coalesce(is_query, F.lit(False)).alias("ask")
    )
    size = rows.agg(F.count(F.lit(1)).alias("n"), F.sum(F.size("w")).alias("numbers"), F.count_if("ask").alias("q")).head()
    if not size["q"]:
        return spark.createDataFrame([], f"query_id long, rank int, `{row_id}` long, score long")
    width = max(1, -(-(size["numbers"] or 0) // size["n"]))
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    most = max(1, block_numbers // width)
    # no fewer blocks than their size asks for; more where tasks would be idle
    held_blocks = max(-(-size["n"] // most), min(tasks, size["n"] // LEAST_ROWS), 1)
    asked_blocks = -(-size["q"] // most)
    # equal rows are one with a count, so that blocks have the size they should
    rows = rows.groupBy("id", "w").agg(F.count(F.lit(1)).alias("times"), F.max("ask").alias("ask"))

    def block(n: int) -> Column:
        return F.pmod(F.xxhash64("id", "w"), F.lit(n)).cast("int")

    def every(n: int) -> Column:
        return F.explode(F.sequence(F.lit(0), F.lit(n - 1)))

    queries = rows.where("ask").select(
        block(asked_blocks).alias("qb"), every(held_blocks).alias("cb"), "id", "w", "times", F.lit(True).alias("asked")
    )
    candidates = rows.select(
        every(asked_blocks).alias("qb"), block(held_blocks).alias("cb"), "id", "w", "times", F.lit(False).alias("asked")
    )
    blocks = queries.unionByName(candidates)

    schema = "query_id long, query array<int>, id long, times long, score long"

    def search(table: pa.Table) -> pa.Table:
        out = []
        for query, found, scores in _searched(table, k):
            same = pa.array(np.zeros(found.num_rows, dtype=np.int64))
            columns = [query.column("id").take(same), query.column("w").take(same), *found.columns, pa.array(scores)]
            out.append(pa.table(columns, names=["query_id", "query", "id", "times", "score"]))
        return pa.concat_tables(out) if out else empty

    empty = pa.schema(
        [("query_id", pa.int64()), ("query", pa.list_(pa.int32())), *[(c, pa.int64()) for c in ("id", "times", "score")]]
    ).empty_table()
    # the hash of the vector keeps different vectors of one query id apart
    near = blocks.groupBy("qb", "cb").applyInArrow(search, schema)
    repeats = F.explode(F.sequence(F.lit(1), F.least("times", F.lit(k)).cast("int"))).alias("repeat")
    near = near.select("query_id", F.xxhash64("query").alias("query"), "id", "score", repeats).drop("repeat")
    place = F.row_number().over(Window.partitionBy("query_id", "query").orderBy(F.desc("score"), "id"))
    merged = near.withColumn("rank", place).where(F.col("rank") <= k)
    return merged.select("query_id", F.col("rank").cast("int").alias("rank"), F.col("id").alias(row_id), "score")


def nearest(df: DataFrame) -> DataFrame:
    """The contract's search: every vec_id divisible by 20 asks all other rows for its 20 highest scores."""
    return exact_top_k(df, F.col("vec_id") % QUERY_EVERY == 0)
