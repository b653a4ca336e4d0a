"""Token counts of whole texts.

Texts are taken in batches of bounded bytes. A text is split where no token can cross:
at ASCII white space, if the tokenizer drops it, and before a final full stop or comma after
a letter (a tokenizer for which this does not hold gets whole texts). The pieces that a worker has not seen are encoded in one call of the library per
batch, and a text's count is the sum over its pieces; only lengths leave the function.
"""

from __future__ import annotations

import os
import re
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskfeat.llm.text import map_texts, worker_cache

BATCH_BYTES = 4 << 20
CACHED_PIECES = 400_000


# small letters that a lower-casing or composing normaliser leaves as they are
_SMALL = re.compile("[a-zß-öø-ÿ]+")
_KEPT_BYTES = [*range(33, 127), *range(161, 173), *range(174, 256)]
# byte-level vocabularies write each byte as a character: printable ones as themselves, the others from 256 on
_BYTE_LETTERS = {b: 256 + i for i, b in enumerate(b for b in range(256) if b not in _KEPT_BYTES)}


class PieceEncoder:
    """Encodes pieces of text with a tokenizers file, each distinct piece once while it is kept.

    ``encode(texts)`` yields for each text a list of what ``keep(ids)`` made of its pieces. The
    memory is bounded by ``cached`` pieces; what does not fit is encoded again when it returns.
    """

    def __init__(self, path: str, keep, cached: int = CACHED_PIECES):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.special = [t.content.encode().lower() for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.keep, self.cached, self.known = keep, cached, {}
        self.model = self.tokenizer.model
        self.lower = self._lower_cases()
        self.splits = self._can_split()
        self.direct = self.splits and self._goes_direct()
        self.ends = {mark: self._encoded([mark])[0] for mark in (b".", b",")}

    def _encoded(self, pieces: list[bytes]) -> list:
        """What the library makes of each piece; words of small letters go straight to its model."""
        out: list = [None] * len(pieces)
        others = []
        for i, piece in enumerate(pieces):
            # a lone surrogate cannot come from Spark; replace guards against it all the same
            text = piece.decode("utf-8", "replace")
            if self.direct and _SMALL.fullmatch(text):
                out[i] = self.keep(self._word(piece))
            else:
                others.append((i, text))
        encoded = self.tokenizer.encode_batch([t for _, t in others], add_special_tokens=False)
        for (i, _), e in zip(others, encoded, strict=True):
            out[i] = self.keep(e.ids)
        return out

    def _word(self, word: bytes) -> list[int]:
        return [t.id for t in self.model.tokenize(word.decode("latin-1").translate(_BYTE_LETTERS))]

    def _goes_direct(self) -> bool:
        """Whether words of small letters pass normaliser and pre-tokenizer as one byte-level word, unchanged."""
        letters = "".join(map(chr, [*range(ord("a"), ord("z") + 1), *range(0xDF, 0xF7), *range(0xF8, 0x100)]))
        probes = [*letters, letters[:26], letters[26:], *(f"{a}{b}" for a in "sté" for b in letters), "thes", "lles", "ñandú"]
        return all(self.tokenizer.encode(p, add_special_tokens=False).ids == self._word(p.encode()) for p in probes)

    def _lower_cases(self) -> bool:
        """Whether capitals make no difference, so that one piece stands for all its spellings."""
        import json

        steps = json.loads(self.tokenizer.to_str()).get("normalizer") or {}
        return any(s.get("type") == "Lowercase" for s in steps.get("normalizers", [steps]))

    def _can_split(self) -> bool:
        """Whether this tokenizer drops white space and keeps letters apart from marks; else texts stay whole."""
        probes = ("Ab cd, ef.\n gh", "  x.  y,z \t w's... q\r\n", "é. 12, 3.5 .")
        for probe in probes:
            whole = self.tokenizer.encode(probe, add_special_tokens=False).ids
            parts = [p[:-1] + " " + p[-1] if p[-1] in ".," and p[-2:-1].isalpha() else p for p in probe.split()]
            pieces = " ".join(parts).split()
            split = [i for p in pieces for i in self.tokenizer.encode(p, add_special_tokens=False).ids]
            if whole != split:
                return False
        return True

    def pieces(self, text: bytes) -> list[bytes]:
        if not self.splits:
            return [text]
        if not self.lower:
            return text.split()
        # special strings are found before the text is lower-cased: such texts keep their capitals
        low = text.lower()
        return (text if any(s in low for s in self.special) else low).split()

    def encode(self, texts: Iterable[bytes]) -> list[list]:
        split = [self.pieces(t) for t in texts]
        new = set().union(*split).difference(self.known)
        found = self.known
        if new:
            stems = {p[:-1] if self.splits and p[-1:] in (b".", b",") and p[-2:-1].isalpha() else p for p in new}
            stems = [s for s in stems if s not in self.known]
            extra = dict(zip(stems, self._encoded(stems), strict=True))
            for p in new:
                if p not in extra:
                    stem = p[:-1]
                    extra[p] = (extra[stem] if stem in extra else self.known[stem]) + self.ends[p[-1:]]
            if len(self.known) + len(extra) <= self.cached:
                self.known.update(extra)
            else:
                # frequent pieces come early and stay; the rest only serves this batch
                room = self.cached - len(self.known)
                if room > 0:
                    self.known.update(list(extra.items())[:room])
                look = self.known.get
                return [[v if (v := look(p)) is not None else extra[p] for p in row] for row in split]
        return [list(map(found.__getitem__, row)) for row in split]


def encoder(path: str, kind: str) -> PieceEncoder:
    """One per worker process, for a tokenizer file and a kind of result."""
    keep = len if kind == "lengths" else _packed
    return worker_cache((path, kind), lambda: PieceEncoder(path, keep))


def _packed(ids: list[int]) -> bytes:
    """Ids as little-endian unsigned 32-bit integers."""
    import numpy as np

    return np.asarray(ids, dtype="<u4").tobytes()


def by_bytes(texts: list[bytes], limit: int = BATCH_BYTES) -> Iterator[tuple[int, int]]:
    """Consecutive ranges of texts of at most ``limit`` bytes each (or one text)."""
    start = size = 0
    for i, text in enumerate(texts):
        if i > start and size + len(text) > limit:
            yield start, i
            start, size = i, 0
        size += len(text)
    if start < len(texts):
        yield start, len(texts)


def utf8(column: pa.Array) -> list[bytes]:
    """Texts as UTF-8 bytes; NULL is an empty text."""
    return [t or b"" for t in column.cast(pa.binary()).to_pylist()]


def token_counts(
    docs: DataFrame, tokenizer: str, id_column: str = "doc_id", text_column: str = "text", limit: int = 2048
) -> DataFrame:
    """(id, n_bytes, n_tokens, over_limit) of every row, in any order.

    NULL and empty texts have 0 bytes and 0 tokens. Repeated rows give repeated rows, a NULL id
    stays NULL, further columns are ignored, an empty table gives an empty table. Special strings
    inside texts are single tokens, as the library has it by default; none are added.
    """
    rows = docs.select(F.col(id_column).alias("id"), F.col(text_column).alias("text"))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = encoder(tokenizer, "lengths")
        for batch in batches:
            texts = utf8(batch.column(1))
            totals: list[int] = []
            for start, end in by_bytes(texts):
                totals += map(sum, counter.encode(texts[start:end]))
            sizes = pa.array(list(map(len, texts)), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), sizes, pa.array(totals, pa.int64())], ["id", "n_bytes", "n_tokens"]
            )

    kind = docs.schema[id_column].dataType.simpleString()
    counted = map_texts(rows, count, f"id {kind}, n_bytes long, n_tokens long")
    return counted.select(
        F.col("id").alias(id_column), "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit")
    )
