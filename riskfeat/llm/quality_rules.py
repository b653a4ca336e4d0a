"""Quality rules as a short-circuit cascade.

Each rule rejects a document by its text alone. On a sample of all partitions every rule is run by itself: that
gives its cost and the share it rejects. The cascade then asks the rules in the order of rejection
per cost, and a document that one rule rejects is not shown to the next. The order changes the
work, never the verdict.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskfeat.llm.text import fresh, let, words, written

REPEAT_WINDOW = 8
SAMPLE_ROWS = 1000
TIMED_BYTES = 8 << 20
MOST_REPEATS = 64
SYMBOLS = "#*$%&|<>"


def word_chars(text: Column) -> Column:
    """Code points in words."""
    return F.length(F.regexp_replace(text, r"[\x20\x09-\x0D]+", ""))


def n_symbols(text: Column) -> Column:
    return F.length(text) - F.length(F.translate(text, SYMBOLS, ""))


def n_dup_lines(text: Column) -> Column:
    """Lines with a word that are equal to an earlier line."""
    lines = F.filter(F.split(text, "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]"))
    return let(lines, lambda kept: F.size(kept) - F.size(F.array_distinct(kept)))


def _pairwise(left: Column, shift: int, join: Callable[[Column, Column], Column]) -> Column:
    """``join(a[i], a[i + shift])`` for every i that has both."""
    n = F.size(left) - shift
    return F.zip_with(F.slice(left, F.lit(1), n), F.slice(left, F.lit(1 + shift), n), join)


def _window_hashes(all_words: Column) -> Column:
    """A hash per window of eight words, by doubling: of 1, 2, 4, then 8 words."""
    hashes = F.transform(all_words, lambda w: F.xxhash64(w))
    for shift in (1, 2, 4):
        hashes = let(hashes, _doubled(shift))
    return hashes


def _doubled(shift: int) -> Callable[[Column], Column]:
    return lambda h: _pairwise(h, shift, lambda a, b: F.xxhash64(a, b))


def _covered(hashes: Column) -> Column:
    """Words inside windows that occur twice or more."""
    ordered = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    same = let(
        ordered,
        lambda o: F.flatten(
            _pairwise(o, 1, lambda a, b: F.when(a["h"] == b["h"], F.array(a["i"], b["i"])).otherwise(F.array().cast("array<int>")))
        ),
    )
    # a window adds the words up to the next repeated window's start, at most its own eight
    places = F.sort_array(F.array_distinct(same))
    steps = let(
        places,
        lambda p: F.zip_with(p, F.slice(p, F.lit(2), F.size(p)), lambda a, b: F.least(F.lit(REPEAT_WINDOW), F.coalesce(b - a, F.lit(REPEAT_WINDOW)))),
    )
    return F.aggregate(steps, F.lit(0), lambda total, step: total + step)


def n_repeat_words(all_words: Column) -> Column:
    """Words in windows of eight words found twice or more in the text, the first included."""
    found = let(
        _window_hashes(all_words),
        lambda h: F.when(F.size(F.array_distinct(h)) < F.size(h), _covered(h)).otherwise(0),
    )
    return F.when(F.size(all_words) > REPEAT_WINDOW, found).otherwise(0)


def measures(text: Column) -> dict[str, Column]:
    """The base measures of a text; all 0 for NULL, empty and blank texts."""
    whole = F.coalesce(text, F.lit(""))
    both = let(words(whole), lambda w: F.struct(F.size(w).alias("n"), n_repeat_words(w).alias("repeated")))
    return {
        "counted": both,
        "word_chars": word_chars(whole).cast("long"),
        "n_symbols": n_symbols(whole).cast("long"),
        "n_dup_lines": n_dup_lines(whole).cast("long"),
    }


@dataclass(frozen=True)
class Rule:
    """``rejects(text)`` is true for a document that must go; the text is never NULL."""

    name: str
    rejects: Callable[[Column], Column]


def _share(text: Column, kept: Callable[[Column], Column], most: float) -> Column:
    """More than ``most`` of the words are such."""
    return let(words(text), lambda w: F.size(F.filter(w, kept)) > F.size(w) * most)


def _mean_length(text: Column) -> Column:
    n = F.greatest(F.size(words(text)), F.lit(1))
    return let(word_chars(text) / n, lambda mean: (mean < 2.5) | (mean > 14))


def _lines(text: Column) -> Column:
    return n_dup_lines(text) * 2 > F.size(F.split(text, "\n"))


def _letters(text: Column) -> Column:
    return F.length(F.regexp_replace(text, r"\P{L}+", ""))


def _capitals(text: Column) -> Column:
    return let(_letters(text), lambda n: (n >= 40) & (F.length(F.regexp_replace(text, r"\P{Lu}+", "")) * 2 > n))


def _stutter(text: Column) -> Column:
    """More than a fifth of the words are the word before again."""

    def repeated(w: Column) -> Column:
        same = F.filter(_pairwise(w, 1, lambda a, b: a == b), lambda equal: equal)
        return F.when(F.size(w) > 1, F.size(same) * 5 > F.size(w)).otherwise(F.lit(False))

    return let(words(text), repeated)


# the two rules that define a failed base
BASE_RULES = (
    Rule("too_short", lambda t: F.size(words(t)) < 20),
    Rule("repeated_windows", lambda t: let(words(t), lambda w: 100 * n_repeat_words(w) > 30 * F.size(w))),
)
MORE_RULES = (
    Rule("symbols", lambda t: n_symbols(t) * 10 > F.size(words(t))),
    Rule("without_letters", lambda t: _share(t, lambda w: ~w.rlike(r"\p{L}"), 0.3)),
    Rule("word_length", _mean_length),
    Rule("repeated_lines", _lines),
    Rule("capitals", _capitals),
    Rule("stutter", _stutter),
)
RULES = BASE_RULES + MORE_RULES


@dataclass(frozen=True)
class Estimate:
    rule: Rule
    seconds: float
    rejected: float

    @property
    def worth(self) -> float:
        """Rejection per cost; a rule that rejects nothing in the sample comes after all that do."""
        return self.rejected / max(self.seconds, 1e-6)


def _sample(docs: DataFrame, share: float | None) -> DataFrame:
    """Texts drawn from all partitions alike, about ``SAMPLE_ROWS`` unless a share is given."""
    text = docs.select(F.coalesce(F.col("text"), F.lit("")).alias("text"))
    if share is None:
        share = min(1.0, SAMPLE_ROWS / max(docs.count(), 1))
    return written(text if share == 1.0 else text.sample(share, seed=7), "rule-sample")


def estimate(docs: DataFrame, rules: Sequence[Rule], share: float | None = None) -> list[Estimate]:
    """Cost and selectivity of each rule on a sample of documents, best first.

    A rule is timed over the sample repeated to ``TIMED_BYTES``, less the time of the same job without a rule: what is
    left is the rule's own work, not that of starting a job. The sample only decides the order of
    evaluation. An empty one leaves the order as given.
    """
    sample = _sample(docs, share)
    n_bytes = sample.agg(F.sum(F.octet_length("text"))).head()[0] or 0
    repeats = max(1, min(MOST_REPEATS, TIMED_BYTES // max(n_bytes, 1)))

    def run(verdict: Column, times: int) -> tuple[float, float]:
        again = sample.select("text", F.explode(F.sequence(F.lit(1), F.lit(times))))
        begun = time.perf_counter()
        found = again.agg(F.avg(verdict.cast("double"))).head()[0]
        return time.perf_counter() - begun, found or 0.0

    def timed(verdict: Column) -> tuple[float, float]:
        # the first run compiles
        run(verdict, 1)
        return run(verdict, repeats)

    idle, _ = timed(F.octet_length("text") < 0)
    results = []
    for rule in rules:
        seconds, rejected = timed(rule.rejects(F.col("text")))
        results.append(Estimate(rule, max(seconds - idle, 0.0), rejected))
    return sorted(results, key=lambda e: (-e.worth, e.seconds if e.rejected else 0.0))


def cascade(text: Column, rules: Sequence[Rule]) -> Column:
    """True if no rule rejects the text; later rules are only evaluated for texts that passed the earlier ones."""
    whole = F.coalesce(text, F.lit(""))
    verdict = F.lit(True)
    for rule in reversed(list(rules)):
        verdict = F.when(rule.rejects(whole), F.lit(False)).otherwise(verdict)
    return verdict


def keep_good(docs: DataFrame, rules: Sequence[Rule] = RULES) -> DataFrame:
    """The documents that no rule rejects, all columns kept.

    NULL and blank texts are too short and go; repeated rows are judged alike; an empty table stays empty.
    """
    ordered = [e.rule for e in estimate(docs, rules)]
    return docs.where(cascade(F.col("text"), ordered))


def quality_report(docs: DataFrame, rules: Sequence[Rule] = MORE_RULES) -> DataFrame:
    """doc_id, n_words, the base measures, base_failed, and kept: neither the base nor a rule rejects the document.

    A NULL or empty text has no words, so the base rejects it. Every row is judged by its own text, rows that repeat a doc_id
    too; columns other than doc_id and text don't matter; an empty table gives no rows.
    """
    ordered = [e.rule for e in estimate(docs, rules)]
    verdict = fresh(docs, "__verdict")
    found = docs.select("doc_id", "text", *[c.alias(n) for n, c in measures(F.col("text")).items()])
    n, repeated = F.col("counted.n").cast("long"), F.col("counted.repeated").cast("long")
    failed = (n < 20) | (100 * repeated > 30 * n)
    return (
        found.withColumn("base_failed", failed)
        .withColumn(verdict, F.when(F.col("base_failed"), F.lit(False)).otherwise(cascade(F.col("text"), ordered)))
        .select(
            "doc_id",
            n.alias("n_words"),
            "word_chars",
            "n_symbols",
            "n_dup_lines",
            repeated.alias("n_repeat_words"),
            "base_failed",
            F.col(verdict).alias("kept"),
        )
    )


ORACLE_QUALITY = r"""
WITH texts AS (
  SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^ \x09-\x0D]+') AS w,
    list_filter(string_split(coalesce(text, ''), chr(10)), lambda l: regexp_matches(l, '[^ \x09-\x0D]')) AS lines
  FROM documents),
windows AS (
  SELECT doc_id, i, array_to_string(w[i:i + 7], ' ') AS v
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 6)) AS i FROM texts WHERE len(w) > 8)),
again AS (SELECT doc_id, v FROM windows GROUP BY doc_id, v HAVING count(*) > 1),
covered AS (
  SELECT doc_id, count(DISTINCT i + k) AS n FROM windows JOIN again USING (doc_id, v), (SELECT unnest(range(8)) AS k)
  GROUP BY doc_id),
measured AS (
  SELECT doc_id, t, w, CAST(len(w) AS BIGINT) AS n_words, CAST(length(regexp_replace(t, '[ \x09-\x0D]+', '', 'g')) AS BIGINT) AS word_chars,
    CAST(length(t) - length(translate(t, '#*$%&|<>', '')) AS BIGINT) AS n_symbols,
    CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines,
    CAST(coalesce(covered.n, 0) AS BIGINT) AS n_repeat_words,
    length(regexp_replace(t, '\P{L}+', '', 'g')) AS letters, length(regexp_replace(t, '\P{Lu}+', '', 'g')) AS capitals
  FROM texts LEFT JOIN covered USING (doc_id)),
judged AS (
  SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed,
    n_symbols * 10 > n_words
    OR len(list_filter(w, lambda x: NOT regexp_matches(x, '\p{L}'))) > n_words * 0.3
    OR word_chars * 1.0 / greatest(n_words, 1) < 2.5 OR word_chars * 1.0 / greatest(n_words, 1) > 14
    OR n_dup_lines * 2 > len(string_split(t, chr(10)))
    OR (letters >= 40 AND capitals * 2 > letters)
    OR len(list_filter(range(2, len(w) + 1), lambda i: w[i] = w[i - 1])) * 5 > n_words AS rejected
  FROM measured)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND NOT rejected AS kept
FROM judged
"""
