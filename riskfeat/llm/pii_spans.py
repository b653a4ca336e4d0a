"""Personal data in texts, in plain and in disguised writing, as spans of the source.

Plain identifiers are matched on the text as it is. A text that shows signs of disguise is also
rewritten by transducers that keep for every character they emit the place it came from: look-alike
characters become the plain ones, spelled digits become digits, "at" and "dot" become signs. The
same matchers run on the result, and a normalised span is mapped back to the source characters that
made it. Plain spans always stay; a disguised one is added where it overlaps none.

Matching takes time in proportion to the text, whatever it holds: every matcher starts only
at places where a match can start.
"""

from __future__ import annotations

import re
import unicodedata
from bisect import bisect_left
from collections.abc import Iterator
from itertools import accumulate
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskfeat.llm.text import map_texts

KINDS = ("email", "ip", "card", "phone")


class Span(NamedTuple):
    """Code points [start, end) of the source that hold an identifier."""

    start: int
    end: int
    kind: str

    def __str__(self) -> str:
        return f"{self.kind}:{self.start}:{self.end}"


_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")


def emails(text: str) -> Iterator[Span]:
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            done = domain.end()
            yield Span(start, done, "email")
        else:
            # what stands before this sign cannot start a match any more
            done = at + 1
        at = text.find("@", max(done, at + 1))


def _byte(part: str) -> bool:
    return len(part.lstrip("0")) <= 3 and int(part) <= 255


def ips(text: str) -> Iterator[Span]:
    for m in _IP.finditer(text):
        if all(map(_byte, m.group().split("."))):
            yield Span(m.start(), m.end(), "ip")


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def cards(text: str) -> Iterator[Span]:
    for m in _CARD.finditer(text):
        digits = m.group().replace(" ", "").replace("-", "")
        if 12 <= len(digits) <= 19 and luhn(digits):
            yield Span(m.start(), m.end(), "card")


def phones(text: str) -> Iterator[Span]:
    for m in _PHONE.finditer(text):
        if 9 <= sum(c.isdigit() for c in m.group()) <= 15:
            yield Span(m.start(), m.end(), "phone")


def _sorted(spans: list[Span]) -> list[Span]:
    return sorted(spans, key=lambda s: (s.start, KINDS.index(s.kind), s.end))


def plain_spans(text: str) -> list[Span]:
    """Leftmost matches of each kind that do not overlap within the kind."""
    found = list(emails(text)) if "@" in text else []
    if _DIGIT.search(text):
        found += [*ips(text), *cards(text)]
        if "+" in text:
            found += phones(text)
    return _sorted(found)


class Mapped(NamedTuple):
    """A text, and for each of its characters the source range it came from."""

    text: str
    starts: list[int]
    ends: list[int]


# Cyrillic and Greek letters that look like Latin ones; full-width and styled ones follow from Unicode
_LOOKS = dict(
    zip(
        "аеорсухіјѕԁһԛԝкмтнвАВЕКМНОРСТХУІЈЅοαενικρτυχΑΒΕΖΗΙΚΜΝΟΡΤΥΧ",
        "aeopcyxijsdhqwkmtnbABEKMHOPCTXYIJSoaevikptuxABEZHIKMNOPTYX",
        strict=True,
    )
)
_INVISIBLE = "­​‌‍⁠﻿"
_DASHES = "‐‑‒–—−﹣－"
_STYLED = "！-～①-⓿²³¹⁰-₉﹒﹫\U0001d400-\U0001d7ff٠-٩۰-۹०-९"
_SUSPECT = re.compile("[" + "".join(_LOOKS) + _INVISIBLE + _DASHES + _STYLED + "   　]")
_ODD_DIGIT = re.compile("[٠-٩۰-۹०-९]")


def _look_alike(c: str) -> str:
    if c in _LOOKS:
        return _LOOKS[c]
    if c in _INVISIBLE:
        return ""
    if c in _DASHES:
        return "-"
    if _ODD_DIGIT.match(c):
        return str(unicodedata.digit(c))
    if _SUSPECT.match(c):
        plain = unicodedata.normalize("NFKC", c)
        return plain if plain.isascii() else c
    return c


def plain_characters(source: Mapped) -> Mapped:
    """Look-alike characters become plain, invisible ones go."""
    if not _SUSPECT.search(source.text):
        return source
    out, starts, ends = [], [], []
    for c, start, end in zip(*source, strict=True):
        for new in _look_alike(c):
            out.append(new)
            starts.append(start)
            ends.append(end)
    return Mapped("".join(out), starts, ends)


def rewritten(source: Mapped, pattern: re.Pattern, new) -> Mapped:
    """Every match replaced by ``new(match)``, whose characters all come from the whole match."""
    out, starts, ends, done = [], [], [], 0
    for m in pattern.finditer(source.text):
        a, b = m.span()
        if a == b:
            continue
        put = new(m)
        out += [source.text[done:a], put]
        starts += source.starts[done:a] + [source.starts[a]] * len(put)
        ends += source.ends[done:a] + [source.ends[b - 1]] * len(put)
        done = b
    if not done:
        return source
    out.append(source.text[done:])
    return Mapped("".join(out), starts + source.starts[done:], ends + source.ends[done:])


_DIGIT_WORDS = dict(zip(("zero", "one", "two", "three", "four", "five", "six", "seven", "eight", "nine", "oh"), "01234567890", strict=True))
_WORD = "(?:zero|one|two|three|four|five|six|seven|eight|nine|oh)"
_REPEAT = r"(?:(?:double|triple)[ -]+)?"
# a run of at least three, so that a single "one" in prose stays a word
_SPELLED = re.compile(rf"(?<![^\W_])(?:plus[ ]+)?{_REPEAT}{_WORD}(?:[ ,-]{{1,2}}{_REPEAT}{_WORD}){{2,}}(?![^\W_])", re.IGNORECASE)
_SPELLED_PART = re.compile(rf"(plus)|(?:(double|triple)[ -]+)?({_WORD})", re.IGNORECASE)
_LONELY = re.compile(rf"(?<=[0-9.+)(-])[ ]({_WORD})(?![^\W_])|(?<![^\W_])({_WORD})[ ](?=[0-9.])", re.IGNORECASE)
_PLUS = re.compile(r"(?<![^\W_])plus[ ]+(?=[0-9])", re.IGNORECASE)
_AT = re.compile(r"[ ]?(?:[\[({<][ ]?(?:at|@|arroba|arobase|ät)[ ]?[\])}>])[ ]?", re.IGNORECASE)
_DOT = re.compile(r"[ ]?(?:[\[({<][ ]?(?:dot|\.|punto|punkt|point)[ ]?[\])}>])[ ]?", re.IGNORECASE)
_NUMBER_DOT = re.compile(r"(?<=[0-9])(?:[ ]+dot[ ]+|[ ]+\.[ ]*|[ ]*\.[ ]+)(?=[0-9])", re.IGNORECASE)
_SPOKEN = re.compile(
    r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9_%+.-]+(?: (?:dot|\.) [A-Za-z0-9_%+-]+){0,4}(?: (?:at|@) |_at_|-at-|@)"
    r"[A-Za-z0-9-]+(?:(?: (?:dot|\.) |_dot_|-dot-|\.)[A-Za-z0-9-]+)+",
    re.IGNORECASE,
)
_SPOKEN_SIGN = re.compile(r"[ _-](at|@|dot|\.)[ _-]|@|\.", re.IGNORECASE)


# letters that match "s" and "i" when case is ignored
_CASE = str.maketrans("ſıİ", "sii")


def _low(word: str) -> str:
    return word.translate(_CASE).lower()


def _digits(m: re.Match) -> str:
    out = []
    for plus, times, word in _SPELLED_PART.findall(m.group()):
        many = {"double": 2, "triple": 3}.get(_low(times), 1)
        out.append("+" if plus else _DIGIT_WORDS[_low(word)] * many)
    return "".join(out)


def _spoken(source: Mapped) -> Mapped:
    """Addresses written as "name at host dot org": signs in place of the words, inside the address only."""
    texts: list[str] = []
    starts: list[int] = []
    ends: list[int] = []
    done = 0

    def add(part: Mapped, a: int, b: int) -> None:
        texts.append(part.text[a:b])
        starts.extend(part.starts[a:b])
        ends.extend(part.ends[a:b])

    for m in _SPOKEN.finditer(source.text):
        a, b = m.span()
        name = re.split(" at | @ |@|_at_|-at-", m.group(), flags=re.IGNORECASE)[0]
        telling = (_DIGIT.search(name) or "." in name) and not _VERSION.fullmatch(name)
        if not telling and not re.search("dot| @ | [.] ", m.group(), re.IGNORECASE):
            # "look at example.org" and "version 2.0 at example.org" are prose; "j.doe at example.org" is an address
            continue
        inside = Mapped(source.text[a:b], source.starts[a:b], source.ends[a:b])
        inside = rewritten(inside, _SPOKEN_SIGN, lambda s: "@" if (s.group(1) or s.group()).lower() in ("at", "@") else ".")
        add(source, done, a)
        add(inside, 0, len(inside.text))
        done = b
    if not done:
        return source
    add(source, done, len(source.text))
    return Mapped("".join(texts), starts, ends)


# a number or a version, as the name of an address no more than prose
_VERSION = re.compile(r"v?[0-9]+(?:[.,][0-9]+)*", re.IGNORECASE)
# what a transducer for addresses changes stands beside one of these; a plain address has none
_SPOKEN_WORD = re.compile(r"[ _-](?:at|@|dot|\.)[ _-]", re.IGNORECASE)
_FIRST = (_SUSPECT, _NUMBER_DOT, _AT, _DOT, _PLUS, _LONELY, _SPELLED)


def disguised(text: str) -> bool:
    """Whether any transducer might change the text: the first one that does sees the text as it is. Never wrong on the side of no."""
    return any(p.search(text) for p in _FIRST) or (_SPOKEN_WORD.search(text) is not None and _SPOKEN.search(text) is not None)


def normalised(text: str) -> Mapped:
    places = list(range(len(text)))
    out = plain_characters(Mapped(text, places, [p + 1 for p in places]))
    out = rewritten(out, _SPELLED, _digits)
    out = rewritten(out, _LONELY, lambda m: _DIGIT_WORDS[_low(m.group(1) or m.group(2))])
    out = rewritten(out, _PLUS, lambda m: "+")
    out = rewritten(rewritten(out, _AT, lambda m: "@"), _DOT, lambda m: ".")
    out = rewritten(out, _NUMBER_DOT, lambda m: ".")
    return _spoken(out)


def all_spans(text: str) -> tuple[list[Span], list[Span]]:
    """(plain spans, plain and disguised spans), by start, then kind."""
    base = plain_spans(text)
    if not disguised(text):
        return base, base
    mapped = normalised(text)
    if mapped.text == text:
        return base, base
    # plain spans may overlap: of those that start before a place, the furthest end; added ones never do
    plain_starts = sorted(s.start for s in base)
    furthest = list(accumulate((s.end for s in sorted(base, key=lambda s: s.start)), max))
    added: list[tuple[int, int, str]] = []
    for s in plain_spans(mapped.text):
        start, end = min(mapped.starts[s.start : s.end]), max(mapped.ends[s.start : s.end])
        before = bisect_left(plain_starts, end)
        if before and furthest[before - 1] > start:
            continue
        at = bisect_left(added, (end,))
        if at and added[at - 1][1] > start:
            continue
        added.insert(at, (start, end, s.kind))
    spans = [*base, *[Span(*s) for s in added]]
    return base, _sorted(spans)


def find_pii(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(id, base, spans): arrays of (kind, start, end) per row, plain ones and all.

    NULL and empty texts have none. Repeated rows give repeated rows, further columns are
    ignored, an empty table gives an empty table.
    """
    one = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())])

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [all_spans(t.as_py() or "") for t in batch.column(1)]
            columns = [
                pa.array([[(s.kind, s.start, s.end) for s in pair[i]] for pair in found], pa.list_(one)) for i in (0, 1)
            ]
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns], ["id", "base", "spans"])

    kind = docs.schema[id_column].dataType.simpleString()
    spans = "array<struct<kind string, start long, end long>>"
    rows = docs.select(F.col(id_column).alias("id"), F.col(text_column).alias("text"))
    out = map_texts(rows, search, f"id {kind}, base {spans}, spans {spans}")
    return out.withColumnRenamed("id", id_column)


def joined(spans: Column) -> Column:
    """kind:start:end of every span, comma-joined."""
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ","
    )


def pii_digest(docs: DataFrame) -> DataFrame:
    """doc_id, plain identifiers of each kind, SHA-256 of their spans, and all spans.

    One row per input row. A NULL or empty text has no spans: counts of 0, the hash of the empty text, and "" as spans.
    An empty table gives no rows.
    """
    counts = [
        F.size(F.filter("base", _is(kind))).cast("long").alias(f"n_{kind}") for kind in KINDS
    ]
    return find_pii(docs).select(
        "doc_id",
        *counts,
        F.sha2(joined(F.col("base")), 256).alias("base_sha256"),
        joined(F.col("spans")).alias("spans"),
        (F.size("spans") - F.size("base")).cast("long").alias("n_disguised"),
    )


def _is(kind: str):
    return lambda s: s["kind"] == kind
