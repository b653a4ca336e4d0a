"""Near-duplicate documents: banded MinHash, sequential Bayesian verification, exact confirmation.

1. Each text becomes its set of word shingles, a signature of ``HASHES`` minima, and a fingerprint of the set.
   Equal sets are one class; only classes go on, so copies never meet in pairs.
2. Signatures are cut into bands. In every bucket of equal bands each class first meets one class, drawn
   at random; that joins most groups. In buckets that still hold several components, classes of different
   components meet: as pairs in small buckets, in larger ones the classes outside the bucket's largest component
   against all, in blocks of ``BLOCK`` classes or ``BLOCK_BYTES`` of sets. A block works on bounded arrays and
   hands out links only, so the pairs of a large group never become rows.
3. A candidate pair compares its signatures a batch of hashes at a time and is dropped as soon as the posterior
   probability that its similarity reaches the threshold falls below the miss probability.
4. Survivors are confirmed on their full sets, and links are joined into components.

The number of rows to a band follows from the miss probability: the largest with
(1 - t^rows)^bands at most ``MISS``. Every bucket is finished: no two of its classes stay in different
components without having been compared.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskfeat.llm.text import broadcast_if_small, map_texts, scratch, worker_cache, written

HASHES = 128
BATCH = 32
MISS = 1e-6
CACHED_WORDS = 200_000
SMALL = 16
BLOCK = 1024
BLOCK_BYTES = 8 << 20
# ids of documents to look up; as many longs as a broadcast may have
LOOKED_UP = 500_000
MASK = (1 << 64) - 1


def band_rows(threshold: float, hashes: int = HASHES, miss: float = MISS) -> int:
    """Rows to a band such that a pair at the threshold is missed with at most this probability."""
    fitting = [r for r in range(1, hashes + 1) if (1 - threshold**r) ** (hashes // r) <= miss]
    return max(fitting, default=1)


def least_matches(threshold: float, hashes: int = HASHES, batch: int = BATCH, miss: float = MISS) -> list[tuple[int, int]]:
    """After n hashes, the fewest matches with which a pair goes on: (n, matches).

    With a uniform prior, m matches of n give the posterior Beta(m + 1, n - m + 1); it exceeds the threshold with
    the probability that a binomial of n + 1 draws at the threshold is at most m.
    """
    out = []
    for n in range(batch, hashes + 1, batch):
        below, m = 0.0, 0
        while True:
            below += comb(n + 1, m) * threshold**m * (1 - threshold) ** (n + 1 - m)
            if below >= miss:
                break
            m += 1
        out.append((n, m))
    return out


class WordHashes(dict):
    """64-bit hashes of words; frequent words come early and are kept, the rest are hashed each time."""

    def __missing__(self, word: bytes) -> int:
        import xxhash

        found = xxhash.xxh3_64_intdigest(word)
        if len(self) < CACHED_WORDS:
            self[word] = found
        return found


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit numbers."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingle_set(text: bytes, size: int) -> np.ndarray:
    """Sorted distinct hashes of the shingles; shorter texts are one shingle, texts without words none."""
    found = text.lower().split()
    n = len(found)
    if not n:
        return np.empty(0, dtype=np.uint64)
    h = np.fromiter(map(worker_cache("word-hashes", WordHashes).__getitem__, found), dtype=np.uint64, count=n)
    width = min(size, n)
    total = np.full(n - width + 1, width, dtype=np.uint64)
    for i in range(width):
        total = mixed(total ^ h[i : n - width + 1 + i]) + np.uint64(i + 1)
    return np.unique(total)


def _hash_family(hashes: int) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(20_240_501)
    odd = rng.integers(0, 1 << 63, hashes, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    return odd, rng.integers(0, 1 << 63, hashes, dtype=np.uint64)


def signature(shingles: np.ndarray, hashes: int = HASHES) -> np.ndarray:
    """The upper 32 bits of the minimum of each hash function over the set."""
    odd, add = _FAMILY
    low = np.full(hashes, np.iinfo(np.uint64).max, dtype=np.uint64)
    for start in range(0, len(shingles), 1024):
        block = shingles[start : start + 1024, None]
        np.minimum(low, (block * odd + add).min(axis=0), out=low)
    return (low >> np.uint64(32)).astype("<u4")


_FAMILY = _hash_family(HASHES)


def sketches(docs: DataFrame, size: int) -> DataFrame:
    """(doc_id, n_shingles, set_id, signature) of every document; no set_id without words or without a doc_id."""

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash

        for batch in batches:
            ids = batch.column(0).to_pylist()
            counts, names, signs = [], [], []
            for doc_id, text in zip(ids, batch.column(1).cast(pa.binary()), strict=True):
                found = shingle_set(text.as_py() or b"", size)
                counts.append(len(found))
                linked = len(found) > 0 and doc_id is not None
                names.append(xxhash.xxh3_128_digest(found.tobytes()) if linked else None)
                signs.append(signature(found).tobytes() if linked else None)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(counts, pa.int64()), pa.array(names, pa.binary()), pa.array(signs, pa.binary())],
                ["doc_id", "n_shingles", "set_id", "signature"],
            )

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return map_texts(rows, sketch, "doc_id long, n_shingles long, set_id binary, signature binary")


def _bands(signs: np.ndarray, rows: int) -> np.ndarray:
    """For each signature a hash of the place and the values of each band."""
    bands = HASHES // rows
    signs = signs.astype(np.uint64)
    total = np.tile(np.arange(bands, dtype=np.uint64), (len(signs), 1))
    for i in range(rows):
        total = mixed(total ^ signs[:, i : bands * rows : rows]) + np.uint64(i + 1)
    return total.view(np.int64)


def _signs(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), dtype="<u4").reshape(-1, HASHES)


def banded(classes: DataFrame, rows: int) -> DataFrame:
    """(bucket, node): each class once per band; the bucket is a hash of the band's place and values."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                buckets = _bands(_signs(batch.column(1)), rows)
                nodes = np.repeat(np.asarray(batch.column(0)), buckets.shape[1])
                yield pa.RecordBatch.from_arrays([pa.array(buckets.ravel()), pa.array(nodes)], ["bucket", "node"])

    return map_texts(classes.select("node", "signature"), cut, "bucket long, node long")


def likely(pairs: DataFrame, threshold: float) -> DataFrame:
    """Of (a, b, sign_a, sign_b) those that the sequential test does not drop."""
    steps = least_matches(threshold)

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            alive = np.arange(batch.num_rows)
            if batch.num_rows:
                left, right = _signs(batch.column(2)), _signs(batch.column(3))
                matches, seen = np.zeros(len(left), dtype=np.int64), 0
                for n, least in steps:
                    matches[alive] += (left[alive, seen:n] == right[alive, seen:n]).sum(axis=1)
                    alive, seen = alive[matches[alive] >= least], n
            kept = pa.array(alive)
            yield pa.RecordBatch.from_arrays([batch.column(0).take(kept), batch.column(1).take(kept)], ["a", "b"])

    return map_texts(pairs.select("a", "b", "sign_a", "sign_b"), compare, "a long, b long")


def confirmed(pairs: DataFrame, texts: DataFrame, size: int, percent: int) -> DataFrame:
    """Of (a, b) those with 100 * shared >= percent * union shingles, on the whole sets."""
    left = texts.select(F.col("node").alias("a"), F.col("text").alias("text_a"))
    right = texts.select(F.col("node").alias("b"), F.col("text").alias("text_b"))

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name, sets = None, np.empty(0, dtype=np.uint64)
        for batch in batches:
            kept = []
            nodes = batch.column(0).to_pylist()
            for i, (one, two) in enumerate(zip(batch.column(2).cast(pa.binary()), batch.column(3).cast(pa.binary()), strict=True)):
                if nodes[i] != name:
                    name, sets = nodes[i], shingle_set(one.as_py(), size)
                other = shingle_set(two.as_py(), size)
                both = len(np.intersect1d(sets, other, assume_unique=True))
                if 100 * both >= percent * (len(sets) + len(other) - both):
                    kept.append(i)
            some = pa.array(kept, pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0).take(some), batch.column(1).take(some)], ["a", "b"])

    both = pairs.join(left, "a").join(right, "b")
    return map_texts(both.select("a", "b", "text_a", "text_b"), verify, "a long, b long")


def shingle_sets(texts: DataFrame, size: int) -> DataFrame:
    """(node, shingles) of (node, text): the sorted set as little-endian 64-bit numbers."""

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [shingle_set(t.as_py() or b"", size).tobytes() for t in batch.column(1).cast(pa.binary())]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sets, pa.binary())], ["node", "shingles"])

    return map_texts(texts.select("node", "text"), build, "node long, shingles binary")


class Forest:
    """Components while links are found, so that only links that join two of them are handed out."""

    def __init__(self, labels: list[int]):
        self.parent = {x: x for x in labels}

    def top(self, x: int) -> int:
        while self.parent[x] != x:
            self.parent[x] = x = self.parent[self.parent[x]]
        return x


def links_in_block(table: pa.Table, percent: int, rows: int) -> list[tuple[int, int]]:
    """Links between the two sides of a block (or inside it, if both sides are the same) that join components.

    A pair is compared in the first band that it shares only, and only if its components differ, if the shingles that
    each side shares with anyone in the block leave room for the threshold, and if the sequential test lets it pass.
    """
    nodes, labels = table["node"].to_pylist(), table["label"].to_pylist()
    mine, inside = np.asarray(table["block"]), table["i"][0].as_py() == table["j"][0].as_py()
    sets = [np.frombuffer(b, dtype=np.uint64) for b in table["shingles"].to_pylist()]
    signs = _signs(table["signature"].combine_chunks())
    bands = _bands(signs, rows)
    band = int(np.flatnonzero(bands[0] == table["bucket"][0].as_py())[0])
    sizes = np.array([len(s) for s in sets])
    seen, counts = np.unique(np.concatenate(sets), return_counts=True)
    shared = np.array([(counts[np.searchsorted(seen, s)] > 1).sum() for s in sets])
    names = np.unique(np.array(labels), return_inverse=True)[1]
    left = np.arange(len(nodes)) if inside else np.flatnonzero(mine == table["i"][0].as_py())
    right = left if inside else np.flatnonzero(mine == table["j"][0].as_py())
    steps = least_matches(percent / 100)
    forest, found = Forest(labels), []
    for a in left:
        others = right[right > a] if inside else right
        others = others[names[others] != names[a]]
        room = np.minimum(shared[others], shared[a]) * (100 + percent) >= percent * (sizes[others] + sizes[a])
        others = others[room]
        others = others[~(bands[others, :band] == bands[a, :band]).any(axis=1)]
        matches, before = np.zeros(len(others), dtype=np.int64), 0
        for n, least in steps:
            matches += (signs[others, before:n] == signs[a, before:n]).sum(axis=1)
            others, matches, before = others[matches >= least], matches[matches >= least], n
        for b in others:
            one, two = forest.top(labels[a]), forest.top(labels[b])
            if one == two:
                continue
            both = len(np.intersect1d(sets[a], sets[b], assume_unique=True))
            if 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
                forest.parent[max(one, two)] = min(one, two)
                found.append((min(nodes[a], nodes[b]), max(nodes[a], nodes[b])))
    return found


def dealt_blocks(large: DataFrame, classes: DataFrame, sets: DataFrame) -> DataFrame:
    """(bucket, i, j, block, node, label, signature, shingles): large buckets of (bucket, node, label), block against block.

    The largest component of a bucket has nothing to find inside itself: only the classes outside it meet all
    classes. Both sides are dealt into blocks by their number of classes and the bytes of their sets; the blocks
    of the outsiders are numbered first.
    """
    per_label = large.groupBy("bucket", "label").agg(F.count(F.lit(1)).alias("n"))
    main = per_label.groupBy("bucket").agg(F.max_by("label", F.struct("n", "label")).alias("main"))
    sided = large.join(main, "bucket").withColumn("outside", F.col("label") != F.col("main")).drop("main")
    sided = written(sided.join(sets.select("node", F.octet_length("shingles").alias("bytes")), "node"), "sided")

    def blocks(outside: bool) -> Column:
        here = F.col("outside") == outside
        classes_, bytes_ = F.count_if(here), F.sum(F.when(here, F.col("bytes")).otherwise(0))
        return F.greatest(F.ceil(classes_ / BLOCK), F.ceil(bytes_ / BLOCK_BYTES)).cast("int")

    counts = sided.groupBy("bucket").agg(blocks(True).alias("outs"), blocks(False).alias("ins"))
    own = F.pmod(F.xxhash64("node", "bucket"), F.when(F.col("outside"), F.col("outs")).otherwise(F.col("ins"))).cast("int")
    return (
        sided.join(counts, "bucket")
        .withColumn("block", own + F.when(F.col("outside"), 0).otherwise(F.col("outs")))
        .withColumn("last", F.when(F.col("outside"), F.col("outs") + F.col("ins")).otherwise(F.col("outs")) - 1)
        .select("bucket", "node", "label", "block", F.explode(F.sequence(F.lit(0), "last")).alias("other"))
        .withColumn("i", F.least("block", "other"))
        .withColumn("j", F.greatest("block", "other"))
        .join(classes.select("node", "signature"), "node")
        .join(sets, "node")
        .select("bucket", "i", "j", "block", "node", "label", "signature", "shingles")
    )


def block_links(large: DataFrame, classes: DataFrame, sets: DataFrame, percent: int, rows: int) -> DataFrame:
    """(a, b): links between components in large buckets of (bucket, node, label)."""

    def compare(table: pa.Table) -> pa.Table:
        found = links_in_block(table, percent, rows)
        return pa.table({c: pa.array([f[k] for f in found], pa.int64()) for k, c in enumerate("ab")})

    return dealt_blocks(large, classes, sets).groupBy("bucket", "i", "j").applyInArrow(compare, "a long, b long")


def components(edges: DataFrame) -> DataFrame:
    """(node, component): the smallest node each node of an edge can reach.

    Alternates two steps until nothing changes: every node sends its larger neighbours to its smallest one, then
    its smaller ones. Each step is a grouped minimum and a join; the edges stay as many as they were at most.
    """
    edges = edges.select(F.greatest("a", "b").alias("hi"), F.least("a", "b").alias("lo")).where("hi > lo").distinct()
    before = None
    while True:
        both = edges.unionByName(edges.select(F.col("lo").alias("hi"), F.col("hi").alias("lo")))
        low = both.groupBy("hi").agg(F.min("lo").alias("low"))
        large = (
            both.where("lo > hi")
            .join(low, "hi")
            .select(F.col("lo").alias("hi"), F.least("hi", "low").alias("lo"))
            .distinct()
        )
        least = large.groupBy("hi").agg(F.min("lo").alias("low"))
        small = (
            large.join(least, "hi")
            .select(F.when(F.col("lo") == F.col("low"), F.col("hi")).otherwise(F.col("lo")).alias("hi"), F.col("low").alias("lo"))
            .where("hi > lo")
            .distinct()
        )
        edges = written(small, "edges")
        now = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("hi", "lo").cast("decimal(38,0)"))).head()
        if now == before:
            return edges.select(F.col("hi").alias("node"), F.col("lo").alias("component")).unionByName(
                edges.select(F.col("lo").alias("node"), F.col("lo").alias("component")).distinct()
            )
        before = now


def _signed(pairs: DataFrame, classes: DataFrame) -> DataFrame:
    sign = classes.select("node", "signature")
    return pairs.join(sign.withColumnsRenamed({"node": "a", "signature": "sign_a"}), "a").join(
        sign.withColumnsRenamed({"node": "b", "signature": "sign_b"}), "b"
    )


def links(classes: DataFrame, texts: DataFrame, size: int, percent: int) -> DataFrame:
    """(node, component) of all classes that are linked to another one."""
    threshold = percent / 100
    rows = band_rows(threshold)
    spread = written(banded(classes, rows), "bands")
    # a bucket with one class has no pair
    shared = spread.groupBy("bucket").agg(
        F.count(F.lit(1)).alias("n"), F.min_by("node", F.xxhash64("bucket", "node")).alias("hub")
    )
    buckets = written(spread.join(shared.where("n > 1"), "bucket"), "buckets")

    def texts_of(nodes: DataFrame) -> DataFrame:
        # an id that repeats with other texts is compared by its smallest text
        needed = broadcast_if_small(written(nodes.distinct(), "needed"), LOOKED_UP)
        return texts.join(needed, "node", "left_semi").groupBy("node").agg(F.min("text").alias("text"))

    def verified(pairs: DataFrame) -> DataFrame:
        distinct = pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
        few = written(likely(_signed(distinct, classes), threshold), "likely")
        nodes = few.select(F.col("a").alias("node")).unionByName(few.select(F.col("b").alias("node")))
        return written(confirmed(few, written(texts_of(nodes), "texts"), size, percent), "links")

    stars = buckets.where("node <> hub").select(F.col("hub").alias("a"), F.col("node").alias("b"))
    edges = verified(stars)
    first = written(components(edges), "components")
    labelled = written(
        buckets.join(first, "node", "left").select("bucket", "node", "n", F.coalesce("component", "node").alias("label")),
        "labelled",
    )
    several = labelled.groupBy("bucket").agg(F.min("label").alias("one"), F.max("label").alias("other"))
    # two classes that are apart have met already
    still_open = labelled.where("n > 2").join(several.where("one < other").select("bucket"), "bucket")
    still_open = written(still_open, "open")
    small = still_open.where(F.col("n") <= SMALL)
    left = small.select("bucket", F.col("node").alias("a"), F.col("label").alias("label_a"))
    right = small.select("bucket", F.col("node").alias("b"), F.col("label").alias("label_b"))
    pairs = left.join(right, "bucket").where("a < b AND label_a <> label_b").select("a", "b")
    more = verified(pairs)
    large = written(still_open.where(F.col("n") > SMALL), "large")
    sets = written(shingle_sets(texts_of(large.select("node")), size), "sets")
    blocks = written(block_links(large, classes, sets, percent, rows), "block-links")
    return components(edges.unionByName(more).unionByName(blocks))


def near_duplicates(docs: DataFrame, size: int = 5, percent: int = 80) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) of every row.

    Documents are linked if 100 * shared >= percent * union of their sets of ``size``-word shingles; the component
    is named by its smallest doc_id, which is the one that is kept. Texts without words (NULL, empty, blank) and
    rows without a doc_id are linked with nothing and kept. Rows that repeat a doc_id get the result of
    that id; further columns are ignored; an empty table gives an empty result.
    """
    found = written(sketches(docs, size), "sketches")
    classes = found.where(F.col("set_id").isNotNull()).groupBy("set_id").agg(
        F.min("doc_id").alias("node"), F.first("signature").alias("signature")
    )
    classes = written(classes, "classes")
    # the smallest document of a class stands for it
    texts = docs.select(F.col("doc_id").cast("long").alias("node"), F.coalesce("text", F.lit("")).alias("text"))
    # bands, buckets, candidates and their texts are not needed once the components are known
    with scratch(docs.sparkSession) as keep:
        linked = keep(links(classes, texts, size, percent), "linked")
    named = classes.join(linked, "node", "left").select("set_id", F.coalesce("component", "node").alias("component_id"))
    out = found.drop("signature").join(named, "set_id", "left")
    component = F.coalesce("component_id", "doc_id")
    return out.select(
        "doc_id", "n_shingles", component.alias("component_id"), F.col("doc_id").eqNullSafe(component).alias("kept")
    )


def without_near_duplicates(docs: DataFrame, size: int = 5, percent: int = 80) -> DataFrame:
    """The documents that ``near_duplicates`` keeps, one row for each doc_id, all columns kept.

    Rows without a doc_id stay; of rows that repeat a doc_id one stays, the one with the smallest text.
    """
    with scratch(docs.sparkSession) as keep:
        kept = keep(near_duplicates(docs, size, percent).where("kept").select("doc_id").distinct(), "kept")
    kept = broadcast_if_small(kept, LOOKED_UP)
    repeated = written(docs.groupBy("doc_id").count().where("count > 1 AND doc_id IS NOT NULL").select("doc_id"), "repeated")
    chosen = docs.join(kept, docs["doc_id"].eqNullSafe(kept["doc_id"]), "left_semi")
    if repeated.isEmpty():
        return chosen
    once = chosen.join(repeated, "doc_id", "left_anti").select(*docs.columns)
    rest = chosen.join(repeated, "doc_id", "left_semi").select(*docs.columns)
    order = F.struct(F.coalesce("text", F.lit("")).alias("text"), F.struct(*docs.columns).alias("row"))
    least = rest.groupBy("doc_id").agg(F.min(order).alias("least"))
    return once.unionByName(least.select(*[F.col(f"least.row.{c}").alias(c) for c in docs.columns]))


def oracle_near_duplicates(size: int, percent: int) -> str:
    """``near_duplicates`` as SQL that joins the shingle sets themselves, for small tables with unique ids."""
    return rf"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^ \x09-\x0D]+') AS w
  FROM documents),
shingles AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) >= {size}
    THEN list_transform(range(1, len(w) - {size - 2}), lambda i: array_to_string(w[i:i + {size - 1}], ' '))
    WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS s
  FROM words),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
pairs AS (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id < b.doc_id
  GROUP BY 1, 2),
links AS (
  SELECT x, y FROM pairs JOIN sizes nx ON nx.doc_id = x JOIN sizes ny ON ny.doc_id = y
  WHERE 100 * c >= {percent} * (nx.n + ny.n - c)),
both_ways AS (SELECT x, y FROM links UNION ALL SELECT y, x FROM links),
reached AS (
  SELECT doc_id, doc_id AS label FROM words
  UNION
  SELECT y, label FROM reached JOIN both_ways ON x = doc_id WHERE label < y)
SELECT r.doc_id, coalesce(any_value(n), 0) AS n_shingles, min(label) AS component_id, r.doc_id = min(label) AS kept
FROM reached r LEFT JOIN sizes ON sizes.doc_id = r.doc_id GROUP BY r.doc_id
"""
