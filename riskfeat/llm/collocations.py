"""Phrase collocations by sampled mining: a sample proposes frequent phrases, full passes count and correct them.

A sample of the documents, mined at a lowered threshold, proposes the frequent phrases. The first full pass counts
every proposed phrase and their negative border, the phrases that were not proposed though both parts one word
shorter were. A border phrase that turns out frequent is a failure of the sample: it joins the proposals, and another full pass counts
the phrases that this brings into reach, until a pass finds nothing new.

These passes count phrases by a hash of 40 bits, which never counts a phrase too low; the last pass counts whatever reached the
threshold by the words themselves. So the counts are exact, whatever the sample was and whichever hashes meet.
Tasks hold the proposals as a bitmap of fixed size: hashes that meet in it only make a pass count more phrases.

Defined results: a NULL text is empty, a NULL language is ``und``; NULL, missing or repeated ids do not matter, every
row counts. Texts are lower-cased A-Z and split at ``[.,;:!?\\x0A-\\x0D]`` into pieces and at blanks and tabs into words; a very
long text is one row like any other. Ties in the score go by count, then by phrase in byte order. Other columns are ignored, and an
empty table gives no rows.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskfeat.llm.text import map_texts, scratch, written
from riskfeat.operators.skew import lookup_join

# fixed values: the longest phrase, the least count, the score's factor, the cover that drops a phrase, rows per language
LONGEST, LEAST, FACTOR, COVER_PERCENT, TOP = 4, 30, 2_000_000, 80, 2000
UNKNOWN_LANGUAGE = "und"
SAMPLE_SHARE = 0.25
DRAWS = 1 << 20
# 8 MB
BITS = 26
BUCKET_BITS = 15  # of Spark's bitmap functions
# the first bits of a hash, by which phrases are counted; short ones make small shuffles
COUNT_BITS = 40
# hashes that a task holds before it hands them on, and that a task which adds them up should get
HELD, ADDED = 4_000_000, 1 << 20
# A-Z to a-z, and every mark that ends a piece to a full stop
PIECES = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ,;:!?\n\x0b\x0c\r", b"abcdefghijklmnopqrstuvwxyz" + 9 * b".")
STOP = b"."
MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)
COUNTED = "lang string, phrase string, size int, n long"
GAP = re.compile(rb"[ \t.]")
SLICE = 1 << 20
# an odd factor, so that it has an inverse modulo 2^64
BASE = 0xD1342543DE82EF95

ORACLE_COLLOCATIONS = f"""
WITH pieces AS (
  SELECT coalesce(lang, '{UNKNOWN_LANGUAGE}') AS lang, unnest(regexp_split_to_array(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\\x0A-\\x0D]')) AS piece
  FROM documents
), listed AS (
  SELECT lang, regexp_extract_all(piece, '[^\\x20\\x09]+') AS w FROM pieces
), counted AS (
  SELECT lang, size, array_to_string(list_slice(w, p, p + size - 1), ' ') AS phrase, count(*) AS f
  FROM listed, (SELECT unnest(range(1, {LONGEST + 1})) AS size), unnest(range(1, len(w) - size + 2)) AS u(p)
  WHERE len(w) >= size GROUP BY ALL
), totals AS (
  SELECT lang, sum(f) AS n FROM counted WHERE size = 1 GROUP BY lang
), frequent AS (
  SELECT * FROM counted WHERE f >= {LEAST}
), cuts AS (
  SELECT lang, phrase, f, k, array_to_string(list_slice(string_split(phrase, ' '), 1, k), ' ') AS head,
    array_to_string(list_slice(string_split(phrase, ' '), k + 1, size), ' ') AS tail
  FROM frequent, unnest(range(1, size)) AS u(k)
), scored AS (
  SELECT c.lang, c.phrase, c.f AS a, c.k, h.f AS l, t.f AS r,
    (CAST({FACTOR} AS HUGEINT) * c.f) // (h.f + t.f) AS score
  FROM cuts c JOIN frequent h ON h.lang = c.lang AND h.phrase = c.head
  JOIN frequent t ON t.lang = c.lang AND t.phrase = c.tail
), lowest AS (
  SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1
), inner_parts AS (
  SELECT lang, f, array_to_string(list_slice(string_split(phrase, ' '), p, p + length - 1), ' ') AS phrase
  FROM frequent, unnest(range(2, size)) AS u(length), unnest(range(1, size - length + 2)) AS v(p)
), kept AS (
  SELECT * FROM lowest c WHERE NOT EXISTS (
    SELECT 1 FROM inner_parts p WHERE p.lang = c.lang AND p.phrase = c.phrase AND 100 * p.f >= {COVER_PERCENT} * c.a)
), placed AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS place FROM kept
)
SELECT lang, place AS rank, phrase, a, l, r, CAST(n AS BIGINT) AS n, CAST(score AS BIGINT) AS score
FROM placed JOIN totals USING (lang) WHERE place <= {TOP}
"""


def lowered(least: int, share: float) -> int:
    """The threshold in a sample: the expected count of a just frequent phrase less half a deviation.

    Lower ones propose more phrases that are not frequent, whose border is large; what is missed costs later passes little.
    """
    expected = least * share
    return max(1, int(expected - 0.5 * expected**0.5))


def _known(bits: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    at = hashes >> np.uint64(64 - BITS)
    return (bits[at >> np.uint64(3)] >> (at & np.uint64(7)).astype(np.uint8)) & 1 == 1


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(29))) * MULTIPLIER
    return (x ^ (x >> np.uint64(32))) * MULTIPLIER


@cache
def _powers(n: int, base: int = BASE) -> np.ndarray:
    """The first n powers of the base, modulo 2^64."""
    return np.cumprod(np.append(np.uint64(1), np.full(n - 1, base, dtype=np.uint64)), dtype=np.uint64)


def word_hashes(data: bytes, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """The hash of every word of a text that went through ``PIECES``, and the number of full stops before it.

    A word's hash is a polynomial of its bytes, taken from running sums over the text. Slices are cut between words.
    """
    hashes, pieces, start, stops = [], [], 0, 0
    while start < len(data):
        end = min(start + SLICE, len(data))
        if end < len(data):
            gap = GAP.search(data, end)
            end = gap.start() if gap else len(data)
        text = np.frombuffer(data, np.uint8, end - start, start)
        size = max(SLICE, 1 << (len(text) - 1).bit_length())
        inside = np.concatenate([[False], (text != 32) & (text != 9) & (text != 46), [False]])
        edges = np.flatnonzero(inside[1:] != inside[:-1])
        first, past = edges[::2], edges[1::2]
        sums = np.zeros(len(text) + 1, dtype=np.uint64)
        np.cumsum((text + np.uint64(1)) * _powers(size)[: len(text)], out=sums[1:])
        hashes.append(_mixed(((sums[past] - sums[first]) * _powers(size, pow(BASE, -1, 1 << 64))[first]) ^ np.uint64(seed)))
        before = np.cumsum(text == 46)
        pieces.append(stops + before[first])
        stops += int(before[-1])
        start = end
    if not hashes:
        return np.zeros(0, dtype=np.uint64), np.zeros(0, dtype=np.int64)
    return np.concatenate(hashes), np.concatenate(pieces)


def _longer(head: np.ndarray, word: np.ndarray) -> np.ndarray:
    """Hashes of phrases from those of their heads and last words."""
    return _mixed(_mixed(head) + word)


def _texts(batch: pa.RecordBatch) -> dict[str, bytes]:
    """The texts of a batch per language, lower-cased, with a full stop wherever a piece ends."""
    by_language = defaultdict(list)
    for lang, text in zip(*(batch.column(batch.schema.get_field_index(c)).to_pylist() for c in ("lang", "text"))):
        by_language[lang].append(text)
    return {lang: "\n".join(texts).encode().translate(PIECES) for lang, texts in by_language.items()}


def _seed(lang: str) -> int:
    return xxhash.xxh64_intdigest(lang.encode())


def within_reach(
    words: np.ndarray, pieces: np.ndarray, now: np.ndarray | None, before: np.ndarray | None, sizes: tuple[int, ...], proposed: int
) -> Iterator[np.ndarray]:
    """Hashes of all occurrences of phrases, of the given sizes, that are within reach of ``now`` but not of ``before``.

    A phrase is within reach if the two phrases one word shorter are proposed, which is what the bitmap says up to the
    size ``proposed``; longer ones count as proposed if they are within reach themselves. All single words are.
    """
    hashes = words
    same = pieces[1:] == pieces[:-1]
    reach, old = np.ones(len(words), dtype=bool), np.full(len(words), before is not None)
    for size in range(1, max(sizes) + 1):
        if size > 1:
            held = reach & _known(now, hashes) if size - 1 <= proposed else reach
            reach = held[:-1] & held[1:]
            if size == 2:
                reach &= same
            if before is not None:
                held = old & _known(before, hashes)
                old = held[:-1] & held[1:] & reach
            else:
                old = np.zeros(len(reach), dtype=bool)
            hashes = _longer(hashes[:-1], words[size - 1 :])
        if size in sizes:
            yield hashes[reach & ~old]


def _summed(hashes: np.ndarray, counts: np.ndarray, cap: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct hashes in order and their counts; a count above ``cap`` is ``cap``."""
    bits = np.uint64(cap.bit_length())
    joined = np.sort((hashes << bits) | np.minimum(counts, cap).astype(np.uint64))
    hashes = joined >> bits
    starts = np.flatnonzero(np.append(True, hashes[1:] != hashes[:-1])[: len(hashes)])
    if not len(starts):
        return hashes, counts
    return hashes[starts], np.minimum(np.add.reduceat(joined & ((np.uint64(1) << bits) - np.uint64(1)), starts), np.uint64(cap))


def pack(hashes: np.ndarray, counts: np.ndarray) -> bytes:
    """Hashes in order and their counts: differences and counts byte plane by byte plane, compressed."""
    planes = [np.diff(hashes, prepend=np.uint64(0)).astype("<u8"), counts.astype("<u8")]
    raw = np.concatenate([x.view(np.uint8).reshape(-1, 8).T.ravel() for x in planes])
    return zstandard.compress(raw.tobytes(), 1)


def unpack(packed: bytes) -> tuple[np.ndarray, np.ndarray]:
    planes = np.frombuffer(zstandard.decompress(packed), np.uint8).reshape(2, 8, -1)
    steps, counts = (np.ascontiguousarray(x.T).view("<u8").ravel() for x in planes)
    return np.cumsum(steps, dtype=np.uint64), counts


def _ranges(hashes: np.ndarray, counts: np.ndarray, range_bits: int) -> pa.RecordBatch:
    """One row (range, packed) for every range of hashes."""
    of_range = hashes >> np.uint64(COUNT_BITS - range_bits)
    cuts = np.flatnonzero(of_range[1:] != of_range[:-1]) + 1
    packed = [pack(h, n) for h, n in zip(np.split(hashes, cuts), np.split(counts, cuts), strict=True)]
    return pa.record_batch({"range": pa.array(of_range[np.append(0, cuts)].astype(np.int64)), "packed": pa.array(packed, pa.binary())})


def frequent_hashes(
    docs: DataFrame, now: Broadcast, before: Broadcast | None, sizes: tuple[int, ...], least: int, range_bits: int, proposed: int = LONGEST
) -> DataFrame:
    """The hashes of phrases newly within reach that occur ``least`` times.

    Tasks add up their hashes and hand them on in ranges, packed; each range is added up by a task. Counts
    only have to tell whether they reach ``least``.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits, old = now.value, None if before is None else before.value
        held, n_held = [], 0
        for batch in batches:
            found = []
            for lang, data in _texts(batch).items():
                words, pieces = word_hashes(data, _seed(lang))
                found.extend(within_reach(words, pieces, bits, old, sizes, proposed))
            if found:
                hashes = np.concatenate(found) >> np.uint64(64 - COUNT_BITS)
                held.append(_summed(hashes, np.ones(len(hashes), dtype=np.uint64), least))
                n_held += len(held[-1][0])
            if n_held > HELD:
                yield _ranges(*_summed(*map(np.concatenate, zip(*held)), least), range_bits)
                held, n_held = [], 0
        if n_held:
            yield _ranges(*_summed(*map(np.concatenate, zip(*held)), least), range_bits)

    def add(table: pa.Table) -> pa.Table:
        parts = [unpack(x) for x in table.column("packed").to_pylist()]
        hashes, counts = _summed(*map(np.concatenate, zip(*parts)), least)
        return pa.table({"hash": pa.array(hashes[counts >= least].astype(np.int64))})

    return map_texts(docs, count, "range long, packed binary").groupBy("range").applyInArrow(add, "hash long")


def _distinct(places: np.ndarray, hashes: np.ndarray, ids: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """First places of the distinct phrases that start at ``places``, and their counts."""
    ordered = places[np.argsort(hashes[places], kind="stable")]
    new = np.append(True, np.diff(hashes[ordered]) != 0)
    differs = np.zeros(len(new), dtype=bool)
    for step in range(size):
        differs |= np.append(True, np.diff(ids[ordered + step]) != 0)
    if (differs & ~new).any():
        # two phrases share a hash: order by the words themselves
        ordered = places[np.lexsort([ids[places + step] for step in range(size)])]
        new = np.append(True, np.any([np.diff(ids[ordered + step]) != 0 for step in range(size)], axis=0))
    starts = np.flatnonzero(new)
    return ordered[starts], np.diff(np.append(starts, len(new)))


def count_text(data: bytes, seed: int, held: np.ndarray, longest: int) -> Iterator[tuple[pa.Array, int, np.ndarray]]:
    """(phrases, size, counts) of the phrases of a text that the bitmap has; the empty phrase, of size 0, counts the words."""
    tokens = data.replace(STOP, b" . ").split()
    if not tokens:
        return
    coded = pa.array(tokens, pa.binary()).dictionary_encode()
    words, ids = coded.dictionary, coded.indices.to_numpy()
    stop = pc.index(words, pa.scalar(STOP, pa.binary())).as_py()
    # the stop has no hash of its own: its place is left out and filled in
    of_word = word_hashes(b" ".join(w for w in words.to_pylist() if w != STOP), seed)[0]
    last = (of_word if stop < 0 else np.insert(of_word, stop, 0))[ids]
    whole = ids != stop
    yield pa.array([""]), 0, whole.sum(keepdims=True)
    hashes = last
    for size in range(1, longest + 1):
        if size > 1:
            whole = whole[:-1] & whole[1:]
            hashes = _longer(hashes[:-1], last[size - 1 :])
        places = np.flatnonzero(whole & _known(held, hashes))
        if len(places):
            first, counts = _distinct(places, hashes, ids, size)
            parts = [words.take(pa.array(ids[first + step])) for step in range(size)]
            phrases = pc.binary_join_element_wise(*parts, pa.scalar(b" ", pa.binary())) if size > 1 else parts[0]
            yield phrases.cast(pa.string()), size, counts


def count_phrases(docs: DataFrame, held: Broadcast, longest: int) -> DataFrame:
    """Exact counts (lang, phrase, size, n) of the phrases in the bitmap."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lang, data in _texts(batch).items():
                for phrases, size, counts in count_text(data, _seed(lang), held.value, longest):
                    same = pa.array(np.zeros(len(phrases), dtype=np.int64))
                    columns = [pa.array([lang]).take(same), phrases, pa.array([size], pa.int32()).take(same), pa.array(counts.astype(np.int64))]
                    yield pa.record_batch(columns, names=["lang", "phrase", "size", "n"])

    return map_texts(docs, count, COUNTED).groupBy("lang", "phrase", "size").agg(F.sum("n").alias("n"))


def _bitmap(hashes: DataFrame) -> np.ndarray:
    """The bitmap of the hashes; pieces of 4 KB, at most 2^(BITS - 15) of them, reach the driver."""
    # the first bits of the hash are the place
    at = F.shiftright("hash", COUNT_BITS - BITS)
    bucket = F.shiftright(at, BUCKET_BITS)
    parts = hashes.groupBy(bucket.alias("b")).agg(F.bitmap_construct_agg(F.pmod(at, F.lit(1 << BUCKET_BITS))).alias("bits"))
    out = np.zeros(1 << (BITS - 3), dtype=np.uint8)
    for row in parts.collect():
        start = row["b"] << (BUCKET_BITS - 3)
        piece = np.frombuffer(row["bits"], dtype=np.uint8)
        out[start : start + len(piece)] = piece
    return out


def frequent_phrases(
    df: DataFrame, least: int = LEAST, longest: int = LONGEST, share: float = SAMPLE_SHARE
) -> tuple[DataFrame, DataFrame]:
    """All phrases of up to ``longest`` words with at least ``least`` occurrences in their language, as
    (lang, phrase, size, n), and the number of words per language.

    ``share`` of the documents propose; it decides the number of passes, never the result.
    """
    spark = df.sparkSession
    send = spark.sparkContext.broadcast
    ids = [F.col(c).cast("string") for c in ("doc_id", "text") if c in df.columns]
    docs = df.where(F.col("text").isNotNull()).select(
        "text",
        F.coalesce(F.col("lang").cast("string"), F.lit(UNKNOWN_LANGUAGE)).alias("lang"),
        F.pmod(F.xxhash64(*ids), F.lit(DRAWS)).alias("draw"),
    )
    texts = docs.select("lang", "text")
    every = tuple(range(1, longest + 1))
    with scratch(spark) as keep:
        sample = written(docs.where(F.col("draw") < int(share * DRAWS)).select("lang", "text"), "phrase-sample")
        # about one hash for every third character; it decides the size of tasks only
        drawn = sample.agg(F.coalesce(F.sum(F.length("text")), F.lit(0))).head()[0]
        range_bits = min(COUNT_BITS, max(6, int(drawn / max(share, 0.01) / 3 / ADDED).bit_length()))
        bits = np.zeros(1 << (BITS - 3), dtype=np.uint8)
        # words, then pairs of frequent words, then all that is made of frequent pairs
        for known_size, sizes in ((0, every[:1]), (1, every[1:2]), (2, every[2:])):
            if sizes:
                few = lowered(least, share)
                bits = bits | _bitmap(frequent_hashes(sample, send(bits), None, sizes, few, range_bits, known_size))
        before, held = None, np.zeros_like(bits)
        while True:
            now = send(bits)
            found = _bitmap(frequent_hashes(texts, now, before, every, least, range_bits))
            held, wider = held | found, bits | found
            if (wider == bits).all():
                break
            before, bits = now, wider
        counts = count_phrases(texts, send(held), longest)
        # the empty phrase stays whatever its count
        out = keep(counts.where((F.col("size") == 0) | (F.col("n") >= least)), "phrases")
    return out.where("size > 0"), out.where("size = 0").select("lang", "n")


def _slice(words: Column, start, length) -> Column:
    return F.array_join(F.slice(words, start, length), " ")


def collocations(
    df: DataFrame, least: int = LEAST, top: int = TOP, longest: int = LONGEST, share: float = SAMPLE_SHARE
) -> DataFrame:
    """Rows (lang, rank, phrase, a, l, r, n, score): each language's best phrases of two and more words.

    ``a`` counts the phrase, ``l`` and ``r`` the two parts of its lowest-scoring cut, ``n`` all words. A phrase inside a longer
    one that has at least 80 percent of its count is left out. See the module for NULLs, odd texts, ties, repeated rows,
    empty tables and other columns.
    """
    phrases, totals = frequent_phrases(df, least, longest, share)
    words = F.split("phrase", " ")
    several = phrases.where("size > 1")
    k = F.explode(F.sequence(F.lit(1), F.col("size") - 1)).alias("k")
    cuts = several.select("lang", "phrase", "size", F.col("n").alias("a"), k).select(
        "*", _slice(words, F.lit(1), F.col("k")).alias("head"), _slice(words, F.col("k") + 1, F.col("size") - F.col("k")).alias("tail")
    )
    for side, name in (("head", "l"), ("tail", "r")):
        used = cuts.groupBy("lang", side).agg(F.count(F.lit(1)).alias("__rows"))
        part = phrases.select("lang", F.col("phrase").alias(side), F.col("n").alias(name)).join(used, ["lang", side])
        cuts = lookup_join(cuts, part, ["lang", side], "__rows", inner=True).drop("__rows")
    exact = F.expr(f"(CAST(a AS DECIMAL(19,0)) * CAST({FACTOR} AS DECIMAL(9,0))) div (CAST(l AS DECIMAL(19,0)) + r)")
    lowest = cuts.groupBy("lang", "phrase", "a").agg(F.min(F.struct(exact.alias("score"), "k", "l", "r")).alias("cut"))
    length = F.explode(F.sequence(F.lit(2), F.col("size") - 1)).alias("length")
    longer = several.where("size > 2").select("lang", "phrase", "size", "n", length)
    starts = F.explode(F.sequence(F.lit(1), F.col("size") - F.col("length") + 1)).alias("at")
    inner = longer.select("*", starts).groupBy("lang", _slice(words, F.col("at"), F.col("length")).alias("phrase"))
    scored = lowest.join(inner.agg(F.max("n").alias("cover")), ["lang", "phrase"], "left").where(
        F.col("cover").isNull() | (100 * F.col("cover") < COVER_PERCENT * F.col("a"))
    )
    rows = scored.select("lang", "phrase", "a", "cut.score", "cut.l", "cut.r")
    # a language may hold most phrases: the best of each share of it first
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    shares = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    part = F.pmod(F.xxhash64("phrase"), F.lit(shares))
    first = rows.withColumn("part", part).withColumn("place", F.row_number().over(Window.partitionBy("lang", "part").orderBy(*order)))
    near = first.where(F.col("place") <= top).drop("part", "place")
    placed = near.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long"))
    # one row per language
    return placed.where(F.col("rank") <= top).join(F.broadcast(totals), "lang").select(
        "lang", "rank", "phrase", "a", "l", "r", "n", "score"
    )
