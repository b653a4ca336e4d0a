"""Token-ID files: independent zstandard frames, a document index and a trailing seek table.

One file per range of document ids, in ascending order of id:

    frame of document 0, frame of document 1, …      ids as little-endian unsigned 32-bit integers
    index    skippable frame: the number of documents, their ids (int64), which ids are NULL (bytes)
    seek table    skippable frame: for each document compressed size, decompressed size and checksum,
                  then the number of documents, a descriptor and the closing magic number
    mark     an empty skippable frame

Every frame can be decompressed alone, so a reader fetches the index and the seek table
and touches only the documents asked for. Each frame is checked against its checksum (the low
32 bits of XXH64 over the ids). Skippable frames are ignored by any zstandard decoder. Files go
through Spark's own writer, so that retried and speculative tasks leave no partial files, and on
any file system Spark can reach: rows of frames are written as text whose line separator is the
empty skippable frame, which therefore also closes the file.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from riskfeat.llm.text import map_texts, written
from riskfeat.llm.token_counts import by_bytes, encoder, utf8

# fixed values of the zstandard format
SKIPPABLE_EMPTY = b"\x50\x2a\x4d\x18\x00\x00\x00\x00"
INDEX_MAGIC = 0x184D2A5D
SEEK_TABLE_MAGIC = 0x184D2A5E
SEEKABLE_MAGIC = 0x8F92EAB1
CHECKSUM_FLAG = 0x80

ROW_BYTES = 1 << 20
FILE_BYTES = 256 << 20
LEVEL = 3


class FileBuilder:
    """Collects the frames of one file and hands them out in rows of about ``ROW_BYTES``."""

    def __init__(self) -> None:
        import zstandard

        self.compressor = zstandard.ZstdCompressor(level=LEVEL, write_checksum=True, write_content_size=True)
        self.entries: list[tuple[int, int, int]] = []
        self.ids: list[int | None] = []
        self.waiting: list[bytes] = []
        self.waiting_bytes = 0

    def add(self, doc_id: int | None, payload: bytes) -> Iterator[bytes]:
        import xxhash

        frame = self.compressor.compress(payload)
        self.entries.append((len(frame), len(payload), xxhash.xxh64_intdigest(payload) & 0xFFFFFFFF))
        self.ids.append(doc_id)
        self.waiting.append(frame)
        self.waiting_bytes += len(frame)
        if self.waiting_bytes >= ROW_BYTES:
            yield self._row()

    def _row(self) -> bytes:
        row = b"".join(self.waiting)
        size, whole, check = self.entries[-1]
        # the separator that Spark's writer puts after the row belongs to its last frame
        self.entries[-1] = (size + len(SKIPPABLE_EMPTY), whole, check)
        self.waiting, self.waiting_bytes = [], 0
        return row

    def close(self) -> Iterator[bytes]:
        if not self.ids:
            return
        if self.waiting:
            yield self._row()
        n = len(self.ids)
        nulls = np.array([d is None for d in self.ids], dtype=np.uint8)
        index = struct.pack("<Q", n) + np.array([d or 0 for d in self.ids], dtype="<i8").tobytes() + nulls.tobytes()
        table = np.array(self.entries, dtype="<u4").tobytes() + struct.pack("<IBI", n, CHECKSUM_FLAG, SEEKABLE_MAGIC)
        yield (
            struct.pack("<II", INDEX_MAGIC, len(index)) + index + struct.pack("<II", SEEK_TABLE_MAGIC, len(table)) + table
        )


class FileReader:
    """The documents of one file: ids and sizes from index and seek table, ids of tokens on demand."""

    def __init__(self, content: bytes):
        import zstandard

        self.decompressor = zstandard.ZstdDecompressor()
        self.content = content
        mark = len(content) - len(SKIPPABLE_EMPTY)
        if content[mark:] != SKIPPABLE_EMPTY:
            raise ValueError("token file is cut short")
        n, _, magic = struct.unpack_from("<IBI", content, mark - 9)
        if magic != SEEKABLE_MAGIC:
            raise ValueError("not a token file")
        table = mark - 9 - 12 * n
        entries = np.frombuffer(content, dtype="<u4", count=3 * n, offset=table).reshape(n, 3)
        self.sizes, self.lengths, self.checks = entries.astype(np.int64).T
        self.offsets = np.concatenate([[0], np.cumsum(self.sizes)[:-1]])
        index = table - 8 - 9 * n
        ids = np.frombuffer(content, dtype="<i8", count=n, offset=index)
        nulls = np.frombuffer(content, dtype=np.uint8, count=n, offset=index + 8 * n)
        self.ids = [None if null else int(i) for i, null in zip(ids, nulls, strict=True)]

    def tokens(self, position: int) -> bytes:
        """The ids of one document, checked; only its own frame is decompressed."""
        import xxhash

        start = self.offsets[position]
        frame = self.content[start : start + self.sizes[position]]
        payload = self.decompressor.decompress(frame, allow_extra_data=True)
        if len(payload) != self.lengths[position] or xxhash.xxh64_intdigest(payload) & 0xFFFFFFFF != self.checks[position]:
            raise ValueError(f"checksum of document {self.ids[position]} differs")
        return payload


def write_token_files(
    docs: DataFrame,
    path: str,
    tokenizer: str,
    end_id: int | None = 1,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> None:
    """Encode every text, append ``end_id`` and write the files to ``path`` in ascending order of id.

    NULL and empty texts are just the end id; a NULL id sorts first; repeated ids stay separate
    documents, in order of their texts. Further columns are ignored; an empty table writes no documents.
    Files are made from about ``FILE_BYTES`` of text at most, however large the table; rows that repeat an id are dealt
    by the beginnings of their texts.
    """
    rows = docs.select(F.col(id_column).cast("long").alias("id"), F.col(text_column).alias("text"))
    n_bytes = rows.agg(F.sum(F.octet_length("text"))).head()[0] or 0
    files = -(-n_bytes // FILE_BYTES)
    keys = ["id", F.substring("text", 1, 64)]
    usual = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = rows.repartitionByRange(files, *keys) if files > usual else rows.repartitionByRange(*keys)
    ordered = ranged.sortWithinPartitions("id", "text")
    end = b"" if end_id is None else struct.pack("<I", end_id)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces, build = encoder(tokenizer, "ids"), FileBuilder()

        def out(row: bytes) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([row], pa.binary())], ["frames"])

        for batch in batches:
            ids, texts = batch.column(0).to_pylist(), utf8(batch.column(1))
            for start, stop in by_bytes(texts):
                for doc_id, found in zip(ids[start:stop], pieces.encode(texts[start:stop]), strict=True):
                    found.append(end)
                    for row in build.add(doc_id, b"".join(found)):
                        yield out(row)
        for row in build.close():
            yield out(row)

    frames = map_texts(ordered, encode, "frames binary")
    frames.select(F.col("frames").cast("string")).write.option("lineSep", SKIPPABLE_EMPTY.decode()).text(path)


def read_token_files(spark: SparkSession, path: str, only: Sequence[int] | None = None) -> DataFrame:
    """(file, position, doc_id, offset, n_tokens, ids) of all documents, or of those asked for.

    ``offset`` counts the ids before the document in its file; ``ids`` are little-endian unsigned
    32-bit integers. A damaged frame raises.
    """
    wanted = None if only is None else frozenset(only)

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, content in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                if not content.as_buffer().size:
                    continue
                file = FileReader(content.as_py())
                counts = file.lengths // 4
                before = np.concatenate([[0], np.cumsum(counts)[:-1]])
                chosen = [i for i, d in enumerate(file.ids) if wanted is None or d in wanted]
                for at in range(0, len(chosen), 1000):
                    some = chosen[at : at + 1000]
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array([name] * len(some), pa.string()),
                            pa.array(some, pa.int64()),
                            pa.array([file.ids[i] for i in some], pa.int64()),
                            pa.array(before[some], pa.int64()),
                            pa.array(counts[some], pa.int64()),
                            pa.array([file.tokens(i) for i in some], pa.binary()),
                        ],
                        ["file", "position", "doc_id", "offset", "n_tokens", "ids"],
                    )

    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).select("path", "content")
    return files.mapInArrow(
        decode, "file string, position long, doc_id long, offset long, n_tokens long, ids binary"
    )


def with_starts(rows: DataFrame) -> DataFrame:
    """Replace file, position and offset by ``start``: the ids of all documents before each one.

    Files are in the order of their names; there is one total per file, so the window over
    files sees a row per file.
    """
    before = Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)
    carry = (
        rows.groupBy("file")
        .agg(F.sum("n_tokens").alias("__n"))
        .select("file", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__before"))
    )
    kept = [c for c in rows.columns if c not in ("file", "position", "offset")]
    return rows.join(carry, "file").select((F.col("offset") + F.col("__before")).alias("start"), *kept)


def token_file_digest(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document, from the files alone."""
    read = read_token_files(spark, path).withColumn("ids_crc32", F.crc32("ids")).drop("ids")
    return with_starts(written(read, "token-index")).select("doc_id", "start", "n_tokens", "ids_crc32")
