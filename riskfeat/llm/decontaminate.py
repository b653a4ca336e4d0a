"""Benchmark passages in documents, also with other numbers, names and units.

Texts become templates: every word is lower-cased and freed of marks, and numbers, names and
units are replaced by typed placeholders. A second form keeps the names, in lower case, so that a copy with other capitals or
sentence marks is found too; a match in either form counts. Windows of template words are hashed and joined with the
windows of the benchmark. A window counts if its slots are consistent: equal slots of the item hold equal values in
the document and different ones different values. So a question with other numbers is found, and a text that only
shares a pattern of slots is not; windows that are hardly more than slots must have the item's own values. The query and the pipeline ask this of each window; ``contaminations`` asks it of
a document's whole alignment with an item unless told otherwise.

The windows of documents never leave the workers unless a bitmap of fixed size, made from the benchmark's
windows, lets them pass; the hash join decides on those that do, whatever the benchmark's size.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskfeat.llm.minhash_dedup import mixed
from riskfeat.llm.text import broadcast_if_small, map_texts, scratch, worker_cache, written

WINDOW = 10
# words outside the slots that a window needs for its slots to be free: a row of numbers is no question
LEAST_PLAIN = 3
BITMAP_BITS = 24
# ids of found documents that a broadcast may have
FOUND = 500_000
CACHED_WORDS = 200_000
# fixed values
UNITS = (
    "m km cm mm mi mile miles ft feet foot inch inches yard yards metre metres meter meters g kg mg lb lbs pound pounds "
    "oz ounce ounces ton tons tonne tonnes l ml litre litres liter liters gallon gallons s sec second seconds min minute "
    "minutes h hr hour hours day days week weeks month months year years percent degree degrees dollar dollars euro euros "
    "cent cents mph kmh watt watts volt volts joule joules"
).split()

KIND_WORD, KIND_NUMBER, KIND_UNIT = 0, 1, 2
CAPITAL, ENDS = 4, 8
FLAGS = 4
SLOT = {"number": 0x1F83D9AB, "name": 0x5BE0CD19, "unit": 0x9B05688C}
# what it takes from the sides of a word; the inside stays
_MARKS = re.compile(r"^[^\w$€£%+-]+|[^\w$€£%]+$")
_SENTENCE_END = re.compile(r"[.!?:;][\"'”’)\]]*$")
_NUMBER = re.compile(r"^[+-]?[$€£]?[0-9][0-9.,:/]*[%$€£]?$")


class TemplateWords(dict):
    """Per word: 60 bits of hash of the canonical form, its kind, whether it has a capital, whether it ends a sentence."""

    def __missing__(self, word: bytes) -> int:
        import xxhash

        stem, ends = (word[:-1], word[-1:] != b",") if word[-1:] in (b".", b",", b"!", b"?", b";", b":") else (word, False)
        if stem.isalpha():
            # letters A-Z, perhaps with one closing mark: what the patterns below would find, without them
            low = stem.lower()
            flags = (KIND_UNIT if low in _UNIT_SET else KIND_WORD) | CAPITAL * stem[:1].isupper() | ENDS * ends
        else:
            text = word.decode("utf-8", "replace")
            core = _MARKS.sub("", text)
            low = core.lower().encode()
            kind = KIND_NUMBER if _NUMBER.match(core) else KIND_UNIT if low in _UNIT_SET else KIND_WORD
            ends = bool(_SENTENCE_END.search(text)) or not core
            flags = kind | CAPITAL * core[:1].isupper() | ENDS * ends
        found = (xxhash.xxh3_64_intdigest(low) >> FLAGS << FLAGS) | flags
        if len(self) < CACHED_WORDS:
            self[word] = found
        return found


_UNIT_SET = frozenset(u.encode() for u in UNITS)


class Template:
    """The words of one text: template tokens, slot kinds and the values behind them."""

    def __init__(self, text: bytes, named_first: bool = False):
        found = text.split()
        coded = np.fromiter(map(worker_cache("template-words", TemplateWords).__getitem__, found), dtype=np.uint64, count=len(found))
        flags = (coded & np.uint64(15)).astype(np.uint8)
        self.values = coded >> np.uint64(FLAGS)
        number = (flags & 3) == KIND_NUMBER
        after_number = np.concatenate([[False], number[:-1]])
        # a capital after the end of a sentence says nothing
        inside = np.concatenate([[False], (flags[:-1] & ENDS) == 0]) if len(found) else number
        unit = ((flags & 3) == KIND_UNIT) & after_number
        name = ((flags & CAPITAL) > 0) & inside & ~number & ~unit
        # the first word of an item is inside a sentence where the item is quoted
        if named_first and len(found):
            name[0] = (flags[0] & CAPITAL) > 0 and not number[0]
        self.folded = self.values.copy()
        self.typed = number | unit
        for chosen, kind in ((number, "number"), (unit, "unit")):
            self.folded[chosen] = SLOT[kind]
        self.tokens = self.folded.copy()
        self.slots = self.typed | name
        self.tokens[name] = SLOT["name"]

    def windows(self, widths: Iterable[int]) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
        """(width, hashes, places, whether folded) for those widths that fit in the text, the smaller ones first.

        A window that holds a name comes twice: with the slot, and folded to lower case with the name itself.
        """
        widths = {w for w in widths if 0 < w <= len(self.tokens)}
        total = np.zeros((2, len(self.tokens) + 1), dtype=np.uint64)
        both = np.stack([self.tokens, self.folded])
        for i in range(max(widths, default=0)):
            total = mixed(total[:, :-1] ^ both[:, i:]) + np.uint64(i + 1)
            if i + 1 in widths:
                other = np.flatnonzero(total[0] != total[1])
                places = np.concatenate([np.arange(total.shape[1]), other])
                yield i + 1, np.concatenate([total[0], total[1, other]]), places, np.arange(len(places)) >= total.shape[1]

    def slot_values(self, start: int, width: int, folded: bool = False) -> list[tuple[int, int]]:
        """(place in the window, value) of the slots of a window; names are none if it is folded."""
        slots = self.typed if folded else self.slots
        return [(int(i), int(self.values[start + i])) for i in np.flatnonzero(slots[start : start + width])]


WINDOW_COLUMNS = "id long, place long, window long, slots array<struct<at long, value long>>"
ITEM_COLUMNS = WINDOW_COLUMNS + ", size int, held int"
_SLOTS = pa.list_(pa.struct([("at", pa.int64()), ("value", pa.int64())]))


def document_windows(rows: DataFrame, widths: Iterable[int], bitmap) -> DataFrame:
    """(id, place, window, slots) of the windows of (id, text) that the bitmap lets pass."""
    widths = sorted(widths)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.frombuffer(bitmap.value, dtype=np.uint8)
        for batch in batches:
            ids, places, hashes, slots = [], [], [], []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.binary()), strict=True):
                template = Template(text.as_py() or b"")
                for width, found, at, folded in template.windows(widths):
                    some = np.flatnonzero(_passes(bits, found))
                    ids += [doc_id] * len(some)
                    places += at[some].tolist()
                    hashes.append(found[some].view(np.int64))
                    slots += [template.slot_values(int(at[i]), width, bool(folded[i])) for i in some]
            window = pa.array(np.concatenate(hashes) if hashes else np.empty(0, np.int64))
            columns = [pa.array(ids, pa.int64()), pa.array(places, pa.int64()), window, pa.array(slots, _SLOTS)]
            yield pa.RecordBatch.from_arrays(columns, ["id", "place", "window", "slots"])

    return map_texts(rows.select(F.col("id").cast("long").alias("id"), "text"), cut, WINDOW_COLUMNS)


def item_windows(rows: DataFrame, width: int) -> DataFrame:
    """(id, place, window, slots, size, held) of the windows of (id, text); a shorter item is one window of its length.

    Windows with names come in both forms, the first one also with its first word as a name if it has a capital. Slots at
    places below ``held`` must hold the item's own values: all of a window with fewer than
    LEAST_PLAIN words outside its slots, and the first word of a short window that is a name only if quoted.
    """

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for item_id, text in zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.binary()), strict=True):
                text = text.as_py() or b""
                plain, quoted = Template(text), Template(text, named_first=True)
                for template in (plain, quoted):
                    for size, found, places, folded in template.windows([min(width, len(plain.tokens))]):
                        if template is quoted:
                            found = found[: int((plain.slots[:1] != quoted.slots[:1]).sum())]
                        for at, fold, window in zip(places.tolist(), folded.tolist(), found.view(np.int64).tolist()):
                            slots = template.slot_values(at, size, fold)
                            held = int(size < width and template is quoted)
                            if size - len(slots) < LEAST_PLAIN:
                                held = size
                            out.append((item_id, at, window, slots, size, held))
            columns = list(zip(*out)) or [()] * 6
            types = (pa.int64(), pa.int64(), pa.int64(), _SLOTS, pa.int32(), pa.int32())
            names = ["id", "place", "window", "slots", "size", "held"]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names)

    return map_texts(rows.select(F.col("id").cast("long").alias("id"), "text"), cut, ITEM_COLUMNS)


def _places(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two bits of the bitmap for each window."""
    mask = np.uint64((1 << BITMAP_BITS) - 1)
    return hashes & mask, (hashes >> np.uint64(BITMAP_BITS)) & mask


def _passes(bits: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    one, two = _places(hashes)
    hit = bits[one >> np.uint64(3)] >> (one & np.uint64(7)).astype(np.uint8)
    some = np.flatnonzero(hit & 1)
    out = np.zeros(len(hashes), dtype=bool)
    out[some] = (bits[two[some] >> np.uint64(3)] >> (two[some] & np.uint64(7)).astype(np.uint8)) & 1
    return out


def window_bitmap(windows: DataFrame):
    """A broadcast bitmap of fixed size (2 MB) in which every window of the benchmark has its two bits."""
    mask = (1 << BITMAP_BITS) - 1
    both = F.array(
        F.col("window").bitwiseAND(mask), F.shiftrightunsigned("window", BITMAP_BITS).bitwiseAND(mask)
    )
    words = (
        windows.select(F.explode(both).alias("bit"))
        .select(F.shiftright("bit", 5).alias("word"), F.expr("shiftleft(1L, cast(bit & 31 as int))").alias("value"))
        .groupBy("word")
        .agg(F.bit_or("value").alias("value"))
    )
    # at most 2^19 words, however large the benchmark is
    bits = np.zeros(1 << (BITMAP_BITS - 5), dtype="<u4")
    for row in words.toLocalIterator():
        bits[row["word"]] = row["value"]
    return windows.sparkSession.sparkContext.broadcast(bits.tobytes())


def _one_to_one(slots: str) -> Column:
    """Whether equal slots of the item hold equal values and different ones different values."""
    pairs = F.size(F.array_distinct(F.transform(slots, lambda s: F.struct(s["theirs"], s["ours"]))))
    theirs = F.size(F.array_distinct(F.transform(slots, lambda s: s["theirs"])))
    ours = F.size(F.array_distinct(F.transform(slots, lambda s: s["ours"])))
    return (pairs == theirs) & (pairs == ours)


def contaminations(docs: DataFrame, benchmark: DataFrame, width: int = WINDOW, each_window: bool = False) -> DataFrame:
    """(doc_id, item_id, n_windows, first_word, n_slots, n_changed): each document with each item found in it.

    ``n_windows`` counts the places of matching windows of the best alignment, ``first_word`` is the first of them,
    ``n_changed`` the slots with a value other than the benchmark's. With ``each_window`` a window counts if it is
    consistent in itself, whatever stands elsewhere in its alignment; without it, one slot that disagrees
    anywhere in an alignment refuses the whole alignment, verbatim windows too. NULL, empty and wordless texts match nothing; a
    item shorter than the window is one window of its own length, which is looked for in every document; what its slots
    may hold is said at ``item_windows``. An item's first word may be quoted inside a sentence. NULL ids are not reported.
    Repeated documents are found once per id; repeated items each. Further columns are ignored.
    """
    items = written(
        item_windows(benchmark.select(F.col("item_id").alias("id"), "text").where("id IS NOT NULL"), width), "items"
    )
    bitmap = window_bitmap(items)
    rows = docs.select(F.col("doc_id").alias("id"), "text").where("id IS NOT NULL AND text IS NOT NULL")
    # at most as many lengths as the window has words
    widths = {width} | {r["size"] for r in items.select("size").distinct().collect()}
    passed = written(document_windows(rows, widths, bitmap), "windows").distinct()
    theirs = items.distinct().select(
        F.col("id").alias("item_id"), F.col("place").alias("item_place"), "window", F.col("slots").alias("item_slots"), "held"
    )
    pairs = F.arrays_zip("item_slots", "slots")
    held = F.forall(pairs, lambda p: (p["slots"]["at"] >= F.col("held")) | (p["item_slots"]["value"] == p["slots"]["value"]))
    matched = passed.join(theirs, "window").where(held).select(
        F.col("id").alias("doc_id"),
        "item_id",
        "place",
        (F.col("place") - F.col("item_place")).alias("shift"),
        F.transform(
            pairs,
            lambda p: F.struct(
                (F.col("place") + p["slots"]["at"]).alias("at"),
                p["item_slots"]["value"].alias("theirs"),
                p["slots"]["value"].alias("ours"),
            ),
        ).alias("slots"),
    )
    if each_window:
        matched = matched.where(_one_to_one("slots"))
    # a group is one document, item and alignment: at most as many windows as the item has words
    aligned = matched.groupBy("doc_id", "item_id", "shift").agg(
        F.countDistinct("place").alias("n_windows"),
        F.min("place").alias("first_word"),
        F.array_distinct(F.flatten(F.collect_set("slots"))).alias("slots"),
    )
    consistent = aligned if each_window else aligned.where(_one_to_one("slots"))
    best = consistent.groupBy("doc_id", "item_id").agg(
        F.max_by(
            F.struct(
                "n_windows",
                "first_word",
                F.size("slots").cast("long").alias("n_slots"),
                F.size(F.filter("slots", lambda s: s["theirs"] != s["ours"])).cast("long").alias("n_changed"),
            ),
            F.struct("n_windows", -F.col("first_word")),
        ).alias("best")
    )
    return best.select("doc_id", "item_id", "best.*")


def decontaminated(docs: DataFrame, benchmark: DataFrame, width: int = WINDOW) -> DataFrame:
    """The documents in which no item was found, all columns kept; rows with a NULL id stay."""
    with scratch(docs.sparkSession) as keep:
        found = keep(contaminations(docs, benchmark, width, each_window=True).select("doc_id").distinct(), "contaminated")
    return docs.join(broadcast_if_small(found, FOUND), "doc_id", "left_anti").select(*docs.columns)
