"""Near-duplicate lines by an exact set-similarity join.

A line is the set of its words in lower case. Lines with equal sets are one class. The words of a line are put in
an order that is the same for all lines, rarest first; two sets with a Jaccard similarity of at least t then share two
words among the first n - ceil(t n) + 2 of each, or all they have in common. Pairs that share such a word pass a
signature filter, a length filter and a positional filter; those that do so for two words are verified on the whole
sets. A line goes if an earlier one, by document and place, is similar enough.

Rarity: all words of all texts are counted in ``BUCKETS`` buckets of their hash. Words are 64-bit numbers that sort by
the magnitude of their bucket's count, then by hash: frequent words are last for every line. Words that share a bucket
seem as frequent as all of them; any fixed order finds all pairs, a better one just makes the lists of
candidates shorter. The table of magnitudes has one byte a bucket whatever the data.

Signature: 64 bits; each word turns one of them over, by its hash. Each bit in which two signatures differ takes a word
that only one of the two sets has, so too many such bits rule a pair out. Words in common cancel out, so long lines fill
a signature no more than short ones.

Lists of up to ``LONG_LIST`` classes are joined with themselves. Longer lists, as large groups of near copies make
them, are worked off in two rounds: each class meets the earliest class of its list, and a class that is similar to
that one is settled, since one earlier match is enough; only classes that are still open meet the others, dealt by
length and, in very long lists, by a salt. There one word in common makes a candidate, as the second may be in a short
list. Whole sets are made again from the texts, for candidates only.

In large tables the words are dealt out in up to ``MOST_PASSES`` passes, one after the other, and the files of a shuffle are
removed when what it was made for is written.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from functools import reduce

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from riskfeat.llm.text import GAP, broadcast_if_small, scratch, written

PERCENT = 80
BUCKETS = 1 << 20
MIN_WORDS = 1
LONG_LIST = 256
SALTS = 16
SALT_ROWS = 4096
SOME_OTHERS = 8
PASS_ENTRIES = 4_000_000
MOST_PASSES = 8
BROADCAST_LINES = 500_000
PAIR = ("l_doc_id", "l_line_no", "e_doc_id", "e_line_no", "both")
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def bucket_levels(docs: DataFrame) -> bytes:
    """Per bucket of word hashes the magnitude of its words' count, 4 steps for a factor of 2; ``BUCKETS`` bytes."""
    # a line break parts words as a space does; a plain explode has Spark split each text once more, to see whether it has any words
    text = F.replace(F.col("text"), F.lit("\n"), F.lit(" "))
    every = docs.select(F.explode_outer(_pieces(text)).alias("word")).where("word != ''")
    counts = every.groupBy(_bucket(F.xxhash64("word")).alias("bucket")).agg(F.count(F.lit(1)).alias("n"))
    # at most BUCKETS rows of two numbers
    found = counts.select("bucket", F.least(F.floor(4 * F.log2("n")) + 1, F.lit(127)).cast("byte").alias("level")).toArrow()
    levels = np.zeros(BUCKETS, dtype=np.int8)
    levels[found["bucket"].to_numpy()] = found["level"].to_numpy()
    return levels.tobytes()


def _bucket(hashed: Column) -> Column:
    return hashed.bitwiseAND(F.lit(BUCKETS - 1)).cast("int")


def word_key(hashed: Column, levels: bytes) -> Column:
    """A number for a word's hash: its bucket's magnitude above 56 bits of the hash, so rare words come first."""
    level = F.ascii(F.substring(F.lit(levels), _bucket(hashed) + 1, F.lit(1)).cast("string"))
    return F.shiftleft(level.cast("long"), 56).bitwiseOR(F.shiftrightunsigned(hashed, 8))


def signature(keys: Column) -> Column:
    """64 bits, those that an odd number of words name by their numbers."""
    bit = lambda k: F.call_function("shiftleft", F.lit(1).cast("long"), k.bitwiseAND(F.lit(63)).cast("int"))
    return F.aggregate(keys, F.lit(0).cast("long"), lambda bits, k: bits.bitwiseXOR(bit(k)))


def _pieces(line: Column) -> Column:
    """The words of a line in lower case; empty strings may be among them.

    Splitting at one character is many times faster than at a pattern, which only lines with other white space need.
    """
    low = F.lower(line)
    return F.when(line.rlike(r"[\x09-\x0D]"), F.split(low, GAP)).otherwise(F.split(low, " "))


def word_set(line: Column) -> Column:
    """The distinct words of a line as 64-bit hashes."""
    hashes = F.array_distinct(F.transform(_pieces(line), lambda w: F.xxhash64(w)))
    return F.array_remove(hashes, F.xxhash64(F.lit("")))


def lines_of(docs: DataFrame) -> DataFrame:
    """(doc_id, line_no, line) of every line, also of those without words; NULL texts have none."""
    return docs.select("doc_id", F.posexplode(F.split("text", "\n")).alias("line_no", "line"))


def _first(n: Column, percent: int) -> Column:
    """Length of the prefix: n - ceil(percent * n / 100) + 2, or n if that is less."""
    return F.least(n - F.ceil(n * percent / F.lit(100.0)) + 2, n).cast("int")


def _keyed_lines(docs: DataFrame, percent: int) -> DataFrame:
    """(doc_id, line_no, set_id, n, bits, prefix) of every line; n is 0 for lines without words."""
    levels = bucket_levels(docs)
    in_order = F.sort_array(F.transform(word_set(F.col("line")), lambda h: word_key(h, levels)))
    n = F.size("keys")
    return lines_of(docs).select("doc_id", "line_no", in_order.alias("keys")).select(
        "doc_id",
        "line_no",
        # equal sets have their words in the same order, so the hash of the array names the set
        F.xxhash64("keys").alias("set_id"),
        n.alias("n"),
        signature(F.col("keys")).alias("bits"),
        # 32 bits of a word: words that share them only make a candidate more
        F.slice("keys", F.lit(1), _first(n, percent)).cast("array<bigint>").alias("prefix"),
    ).withColumn("prefix", F.transform("prefix", lambda k: k.bitwiseAND(F.lit(0x7FFFFFFF)).cast("int")))


def _fitting(a: str, b: str, percent: int) -> Column:
    """Words that only one can have, length filter, and what can still be shared after one of the first two common words."""
    n_a, n_b, place_a, place_b, bits_a, bits_b = (F.col(f"{side}.{c}") for c in ("n", "place", "bits") for side in (a, b))
    apart = (100 + percent) * F.bit_count(bits_a.bitwiseXOR(bits_b)) <= (100 - percent) * (n_a + n_b)
    length = 100 * F.least(n_a, n_b) >= percent * F.greatest(n_a, n_b)
    # the second common word has one before it
    shared = (100 + percent) * (F.least(n_a - place_a, n_b - place_b) + 1) >= percent * (n_a + n_b)
    return apart & length & shared


def _before(a: str, b: str) -> Column:
    """Whether a's line is the earlier one; NULL ids are first."""
    d_a, d_b = F.col(f"{a}.doc_id"), F.col(f"{b}.doc_id")
    smaller = F.coalesce(d_a < d_b, d_a.isNull() & d_b.isNotNull())
    return smaller | (d_a.eqNullSafe(d_b) & (F.col(f"{a}.line_no") < F.col(f"{b}.line_no")))


def _counted(joined: DataFrame, earlier: str, later: str, percent: int) -> DataFrame:
    """The pairs that pass the filters, and for how many words they do."""
    chosen = joined.where(_fitting(earlier, later, percent) & _before(earlier, later))
    ends = [F.col(f"{side}.{c}").alias(f"{name}_{c}") for side, name in ((later, "l"), (earlier, "e")) for c in ("doc_id", "line_no")]
    both = (F.col(f"{earlier}.n") + F.col(f"{later}.n")).alias("both")
    return chosen.select(*ends, both).groupBy(*PAIR).agg(F.count(F.lit(1)).alias("words"))


def _pairs(counted: Callable[[int], DataFrame], passes: int, percent: int, twice: bool) -> DataFrame:
    """The pairs (later, earlier) of all passes; ``twice``: for two words, if they need so many in common."""
    if passes == 1:
        found = counted(0)
    else:
        # each pass deals out its words only, and its shuffle files are gone when the next begins
        parts = [written(counted(i), "line-pass") for i in range(passes)]
        found = reduce(DataFrame.unionByName, parts).groupBy(*PAIR).agg(F.sum("words").alias("words"))
    if twice:
        found = found.where((F.col("words") > 1) | (percent * F.col("both") <= 100 + percent))
    place = lambda name: F.struct(F.col(f"{name}_doc_id").alias("doc_id"), F.col(f"{name}_line_no").alias("line_no"))
    return found.select(place("l").alias("later"), place("e").alias("earlier"))


def _in_pass(entries: DataFrame, i: int, passes: int) -> DataFrame:
    """The entries of the words that the pass deals out."""
    return entries if passes == 1 else entries.where(F.pmod(F.xxhash64("word"), F.lit(passes)) == i)


def _sets(docs: DataFrame, pairs: DataFrame) -> DataFrame:
    """(at, set) of the lines in the pairs."""
    needed = pairs.select(F.explode(F.array("later", "earlier")).alias("at")).distinct()
    # a document has a bounded number of lines
    by_doc = needed.groupBy(F.col("at.doc_id").alias("__doc")).agg(F.collect_set("at.line_no").alias("__lines"))
    by_doc = broadcast_if_small(written(by_doc, "needed"), BROADCAST_LINES)
    # of rows that repeat a document any one will do: those with the class's text
    texts = docs.select("doc_id", "text").join(by_doc, F.col("doc_id").eqNullSafe(F.col("__doc")))
    split = texts.select("doc_id", "__lines", F.posexplode(F.split("text", "\n")).alias("line_no", "line"))
    chosen = split.where(F.array_contains("__lines", F.col("line_no")))
    at = F.struct("doc_id", "line_no").alias("at")
    return chosen.select(at, word_set(F.col("line")).alias("set")).dropDuplicates(["at"])


def _verified(docs: DataFrame, pairs: DataFrame, percent: int) -> DataFrame:
    """The pairs, which are a written table, whose whole sets are similar enough."""
    sets = written(_sets(docs, pairs), "line-sets")
    both = pairs.join(sets.select(F.col("at").alias("later"), F.col("set").alias("set_a")), "later").join(
        sets.select(F.col("at").alias("earlier"), F.col("set").alias("set_b")), "earlier"
    )
    common = F.size(F.array_intersect("set_a", "set_b"))
    return both.where(100 * common >= percent * (F.size("set_a") + F.size("set_b") - common)).select("later", "earlier")


def _similar(docs: DataFrame, pairs: DataFrame, percent: int) -> DataFrame:
    """(later, earlier) of similar pairs, at least one for each later line that has any.

    A line is held against the earliest of its candidates first; the others are only asked where that one fails. Where
    lines have many others, as in groups of near copies, the earliest ``SOME_OTHERS`` of them come before the rest.
    """
    pairs = written(pairs, "line-pairs")
    earliest = written(pairs.groupBy("later").agg(F.min("earlier").alias("earlier")), "line-earliest")
    settled = written(_verified(docs, earliest, percent), "settled")
    left = pairs.join(settled.select("later"), "later", "left_anti").join(earliest, ["later", "earlier"], "left_anti")
    left = written(left, "line-others")
    n, lines = left.agg(F.count(F.lit(1)), F.count_distinct("later")).head()
    if n > 2 * SOME_OTHERS * lines:
        rank = F.row_number().over(Window.partitionBy("later").orderBy("earlier"))
        ranked = written(left.withColumn("rank", rank), "line-ranks")
        some = written(ranked.where(F.col("rank") <= SOME_OTHERS).drop("rank"), "line-some")
        more = written(_verified(docs, some, percent), "settled")
        rest = ranked.where(F.col("rank") > SOME_OTHERS).drop("rank").join(more.select("later").distinct(), "later", "left_anti")
        settled, left = settled.unionByName(more), written(rest, "line-rest")
    return settled.unionByName(_verified(docs, left, percent))


def _long_lists(docs: DataFrame, listed: DataFrame, passes: int, percent: int) -> DataFrame:
    """Similar pairs of the long lists, at least one for each class that has an earlier similar one in them."""
    order = F.struct("doc_id", "line_no")
    columns = ["doc_id", "line_no", "n", "place", "bits"]
    firsts = listed.groupBy("word").agg(F.min_by(F.struct(*columns), order).alias("first"))
    firsts = broadcast_if_small(written(firsts, "firsts"))
    entries = listed.select("word", "salts", F.struct(*columns).alias("me"))
    meet = lambda i: _counted(_in_pass(entries, i, passes).join(firsts, "word"), "first", "me", percent)
    settled = written(_similar(docs, _pairs(meet, passes, percent, twice=False), percent), "settled")
    done = written(settled.select(F.col("later.doc_id").alias("d"), F.col("later.line_no").alias("l")).distinct(), "done")
    # the bands of all lengths that sets similar enough can have
    band = lambda n: F.floor(F.log(n.cast("double")) / math.log(max(100 / percent, 1.01))).cast("int")
    n = F.col("me.n")
    bands = F.sequence(band(F.ceil(n * percent / F.lit(100.0))), band(F.ceil(n * 100 / F.lit(float(percent)))))
    salt = F.pmod(F.xxhash64("me.doc_id", "me.line_no"), F.col("salts")).cast("int")

    def meet_others(i: int) -> DataFrame:
        own = _in_pass(entries, i, passes)
        open_ = own.join(done, F.col("me.doc_id").eqNullSafe(F.col("d")) & (F.col("me.line_no") == F.col("l")), "left_anti")
        others = own.select("word", band(n).alias("band"), salt.alias("salt"), F.col("me").alias("other"))
        near = open_.select("word", "me", "salts", F.explode(bands).alias("band"))
        dealt = near.select("word", "me", "band", F.explode(F.sequence(F.lit(0), F.col("salts") - 1)).alias("salt"))
        return _counted(dealt.join(others, ["word", "band", "salt"]), "other", "me", percent)

    return settled.unionByName(_similar(docs, _pairs(meet_others, passes, percent, twice=False), percent))


def _matches(docs: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """(later, like): per class with an earlier similar class one of these."""
    entries = classes.select("at.doc_id", "at.line_no", "n", "bits", F.posexplode("prefix").alias("place", "word"))
    n_entries = classes.agg(F.sum(F.size("prefix"))).head()[0] or 0
    passes = max(1, min(MOST_PASSES, n_entries // PASS_ENTRIES))
    lists = entries.groupBy("word").agg(F.count(F.lit(1)).alias("__n")).where(F.col("__n") > LONG_LIST)
    salts = F.least(F.ceil(F.col("__n") / SALT_ROWS), F.lit(SALTS)).cast("int")
    long = written(lists.select("word", salts.alias("salts")), "long-lists")
    some_long = long.head() is not None
    long = broadcast_if_small(long)
    short = entries.join(long, "word", "left_anti") if some_long else entries

    def meet(i: int) -> DataFrame:
        own = _in_pass(short, i, passes)
        # the same columns on both sides, so that Spark can use one exchange for both
        joined = own.alias("one").join(own.alias("two"), F.col("one.word") == F.col("two.word"))
        return _counted(joined, "one", "two", percent)

    found = _similar(docs, _pairs(meet, passes, percent, twice=True), percent)
    if some_long:
        found = found.unionByName(_long_lists(docs, entries.join(long, "word"), passes, percent))
    return found.groupBy("later").agg(F.min("earlier").alias("like"))


@contextmanager
def _shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """Inside, the shuffle files of each action go when it ends; whoever asks for them again has them made again."""
    before = spark.conf.get(SHUFFLE_CLEANUP, None)
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.set(SHUFFLE_CLEANUP, before) if before is not None else spark.conf.unset(SHUFFLE_CLEANUP)


def duplicate_lines(docs: DataFrame, percent: int = PERCENT, min_words: int = MIN_WORDS) -> DataFrame:
    """(doc_id, line_no, like_doc, like_line) of each line that goes, with an earlier line it is similar to.

    Lines with fewer than ``min_words`` different words are left alone, as are lines without words and NULL texts. Lines
    are in the order of doc_id (NULL first) and line number; repeated documents follow each other. Columns other than
    doc_id and text don't matter; an empty table has no lines.
    """
    at = F.struct("doc_id", "line_no").alias("at")
    with _shuffles_removed(docs.sparkSession), scratch(docs.sparkSession) as keep:
        # the length is tested on the written lines: the words would be ordered twice otherwise
        lines = written(_keyed_lines(docs, percent), "lines").where(F.col("n") >= max(min_words, 1))
        row = F.struct("doc_id", "line_no", "n", "bits", "prefix")
        classes = lines.groupBy("set_id").agg(F.min(row).alias("row"))
        # the earliest line stands for its class
        classes = classes.select("set_id", F.struct("row.doc_id", "row.line_no").alias("at"), "row.n", "row.bits", "row.prefix")
        classes = written(classes, "line-classes")
        matched = _matches(docs, classes, percent)
        # of a class the later lines go; its first goes too if an earlier class is similar
        known = classes.select("set_id", F.col("at").alias("first_at")).join(
            matched, F.col("first_at").eqNullSafe(F.col("later")), "left"
        ).select("set_id", "first_at", "like")
        gone = (
            lines.select(at, "set_id")
            .join(known, "set_id")
            .select("at", F.coalesce("like", F.when(F.col("first_at") < F.col("at"), F.col("first_at"))).alias("like"))
            .where("like IS NOT NULL")
            .select("at.doc_id", "at.line_no", F.col("like.doc_id").alias("like_doc"), F.col("like.line_no").alias("like_line"))
        )
        return keep(gone, "gone")


def without_duplicate_lines(docs: DataFrame, percent: int = PERCENT, min_words: int = MIN_WORDS) -> DataFrame:
    """The documents without the lines that go, all columns kept; other lines stay as they are.

    A text that loses all its lines is empty; NULL stays NULL. Rows that repeat a doc_id lose the same lines.
    """
    gone = duplicate_lines(docs, percent, min_words).groupBy(F.col("doc_id").alias("__doc")).agg(
        F.collect_set("line_no").alias("__gone")
    )
    joined = docs.join(gone, F.col("doc_id").eqNullSafe(F.col("__doc")), "left")
    kept = F.filter(F.split("text", "\n"), lambda line, i: ~F.array_contains("__gone", i))
    text = F.when(F.col("__gone").isNull(), F.col("text")).otherwise(F.array_join(kept, "\n"))
    return joined.select(*[text.alias(c) if c == "text" else F.col(c) for c in docs.columns])
