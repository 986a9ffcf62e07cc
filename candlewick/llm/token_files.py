"""Token ids in binary files: independent zstandard frames with a trailing seek table.

A file is a series of zstandard frames. Data frames hold whole documents in ascending order of their ids::

    count u32 | document ids i64 x count | lengths u64 x count | ids u32 ...        (all little-endian)

Two skippable frames close the file. The first (magic 0x184D2A5D) lists first document id and document count of every
data frame. The second is the seek table of the seekable zstandard format (magic 0x184D2A5E): compressed size, size and
checksum of every frame, then the footer. Frames are written by Spark's text writer, whose line separator is an empty
skippable frame: so the whole file is a valid zstandard stream, each frame is committed with its task, and the
footer stands right before the last separator. A reader looks at the end of a file and opens only the frames it needs.
"""

from __future__ import annotations

import struct

from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from candlewick.llm.tables import sliced, total_bytes, whole, written
from candlewick.llm.tokens import byte_level

# Fixed values of the format.
SEPARATOR = "P*M\x18\0\0\0\0"
INDEX_MAGIC, TABLE_MAGIC, FOOTER_MAGIC = 0x184D2A5D, 0x184D2A5E, 0x8F92EAB1
CHECKSUMS = 0x80

#: Bytes of ids in a frame, and of text in a file, about.
FRAME_BYTES, FILE_BYTES = 1 << 20, 24 << 20


class DamagedFile(ValueError):
    """A frame or table that does not hold what was written."""


def _checksum(data: bytes) -> int:
    return xxhash.xxh64_intdigest(data) & 0xFFFFFFFF


def _skippable(magic: int, content: bytes) -> bytes:
    return struct.pack("<II", magic, len(content)) + content


class FrameWriter:
    """Frames of one file; ``add`` wants ascending document ids, ``close`` gives the last frames."""

    def __init__(self, frame_bytes: int = FRAME_BYTES, level: int = 3):
        self.frame_bytes, self.packer = frame_bytes, zstandard.ZstdCompressor(level=level, write_content_size=True)
        self.keys, self.bodies, self.size = [], [], 0
        self.entries, self.firsts = [], []

    def add(self, key: int, ids: bytes) -> Iterator[bytes]:
        if self.keys and self.size + len(ids) > self.frame_bytes:
            yield self._frame()
        self.keys.append(key)
        self.bodies.append(ids)
        self.size += len(ids)

    def _frame(self) -> bytes:
        lengths = np.array([len(b) // 4 for b in self.bodies], "<u8")
        head = struct.pack("<I", len(self.keys)) + np.array(self.keys, "<i8").tobytes() + lengths.tobytes()
        data = head + b"".join(self.bodies)
        frame = self.packer.compress(data)
        self.entries.append((len(frame) + len(SEPARATOR), len(data), _checksum(data)))
        self.firsts.append((self.keys[0], len(self.keys)))
        self.keys, self.bodies, self.size = [], [], 0
        return frame

    def close(self) -> Iterator[bytes]:
        if self.keys:
            yield self._frame()
        index = _skippable(INDEX_MAGIC, b"".join(struct.pack("<qI", *x) for x in self.firsts))
        self.entries.append((len(index), 0, 0))
        table = b"".join(struct.pack("<III", *x) for x in self.entries)
        footer = struct.pack("<IBI", len(self.entries), CHECKSUMS, FOOTER_MAGIC)
        # One row: the separator comes after the footer only.
        yield index + _skippable(TABLE_MAGIC, table + footer)


class FrameReader:
    """Documents of one file's bytes; a frame is decompressed and checked when one of its documents is asked for."""

    def __init__(self, data: bytes):
        self.data, self.opened = data, 0
        end = len(data) - len(SEPARATOR)
        count, flags, magic = struct.unpack_from("<IBI", data, end - 9) if end >= 9 else (0, 0, 0)
        table = end - 9 - 12 * count
        if magic != FOOTER_MAGIC or flags != CHECKSUMS or table < 8 or count < 1:
            raise DamagedFile("no seek table at the end")
        if struct.unpack_from("<II", data, table - 8) != (TABLE_MAGIC, 12 * count + 9):
            raise DamagedFile("the seek table has another size")
        entries = list(struct.iter_unpack("<III", data[table : end - 9]))
        self.frames, at = [], 0
        for size, length, check in entries[:-1]:
            self.frames.append((at, size - len(SEPARATOR), length, check))
            at += size
        if at + entries[-1][0] != table - 8:
            raise DamagedFile("the seek table does not cover the file")
        index = data[at + 8 : at + entries[-1][0]]
        if struct.unpack_from("<II", data, at) != (INDEX_MAGIC, len(index)) or len(index) != 12 * len(self.frames):
            raise DamagedFile("no document index")
        self.firsts = [x[0] for x in struct.iter_unpack("<qI", index)]

    def frame(self, number: int) -> list[tuple[int, bytes]]:
        at, size, length, check = self.frames[number]
        try:
            data = zstandard.ZstdDecompressor().decompress(self.data[at : at + size], max_output_size=length)
        except zstandard.ZstdError as error:
            raise DamagedFile(f"frame {number}: {error}") from error
        if len(data) != length or _checksum(data) != check:
            raise DamagedFile(f"frame {number}: wrong checksum")
        self.opened += 1
        (count,) = struct.unpack_from("<I", data)
        keys = np.frombuffer(data, "<i8", count, 4).tolist()
        lengths = np.frombuffer(data, "<u8", count, 4 + 8 * count).tolist()
        out, start = [], 4 + 16 * count
        for key, n in zip(keys, lengths, strict=True):
            out.append((key, data[start : start + 4 * n]))
            start += 4 * n
        return out

    def documents(self) -> Iterator[tuple[int, bytes]]:
        for number in range(len(self.frames)):
            yield from self.frame(number)

    def requested(self, keys: list[int]) -> Iterator[tuple[int, bytes]]:
        """Documents with these ids; opens only frames that can hold one."""
        wanted, needed = set(keys), set()
        for key in wanted:
            last = bisect_left(self.firsts, key)
            # Frames that start with the key, and the one before, which may end with it.
            needed.update(range(max(0, last - 1), last))
            while last < len(self.firsts) and self.firsts[last] == key:
                needed.add(last)
                last += 1
        for number in sorted(needed):
            yield from (x for x in self.frame(number) if x[0] in wanted)


def write_tokens(
    docs: DataFrame, path: str, tokenizer: str, end_id: int = 0, key: str = "doc_id", text: str = "text",
    file_bytes: int = FILE_BYTES, frame_bytes: int = FRAME_BYTES,
) -> None:
    """Writes the ids of every document, followed by ``end_id``, into files under ``path``.

    Documents are dealt by ranges of their id, one file for each range of about ``file_bytes`` of text, and ascend
    within it. A null or empty text has the end id alone. Documents with one id follow each other in order of their
    text; when such a group spans two files, they hold it in any order. A null id can't be written and raises. An
    empty table gives no document. Other columns are not read. A worker holds one frame, or one longer document.
    """
    files = max(1, -(-total_bytes(docs, text) // file_bytes))
    rows = docs.select(F.col(key).cast("long").alias("doc_id"), whole(text).alias("text"))
    rows = rows.withColumn("doc_id", F.coalesce("doc_id", F.raise_error(F.lit("a document has no id")).cast("long")))
    # Rows with one id may be many: their texts tell them apart when ranges are drawn.
    ranges = rows.withColumn("part", F.xxhash64("text")).repartitionByRange(files, "doc_id", "part").sortWithinPartitions("doc_id", "text")
    end = np.array([end_id], "<u4").tobytes()

    def frames(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, writer, any_row = byte_level(tokenizer), FrameWriter(frame_bytes), False
        for batch in (part for batch in batches for part in sliced(batch)):
            for name, body in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                any_row = True
                for frame in writer.add(name, encoder.ids(body) + end):
                    yield pa.RecordBatch.from_arrays([pa.array([frame], pa.binary())], names=["frame"])
        for frame in writer.close() if any_row else ():
            yield pa.RecordBatch.from_arrays([pa.array([frame], pa.binary())], names=["frame"])

    done = ranges.select("doc_id", "text").mapInArrow(frames, "frame binary")
    # Cast, not decoded: the bytes are written as they are.
    done.select(F.col("frame").cast("string").alias("value")).write.option("lineSep", SEPARATOR).text(path)


def read_tokens(spark: SparkSession, path: str, keys: list[int] | None = None) -> DataFrame:
    """Documents of the files: ``doc_id``, ``ids`` (bytes), ``n_tokens``, ``file``, ``start_in_file``.

    With ``keys``, only the frames that can hold these documents are decompressed, and ``start_in_file`` is null.
    A damaged file raises.
    """
    schema = pa.schema([("doc_id", pa.int64()), ("ids", pa.binary()), ("n_tokens", pa.int64()), ("file", pa.string()), ("start_in_file", pa.int64())])

    def documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, data in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                reader = FrameReader(data.as_py())
                rows, size, start = [], 0, 0
                for key, ids in reader.documents() if keys is None else reader.requested(keys):
                    rows.append((key, ids, len(ids) // 4, name, start if keys is None else None))
                    start, size = start + len(ids) // 4, size + len(ids)
                    if size > 4 * FRAME_BYTES:
                        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)
                        rows, size = [], 0
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)

    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path)
    return files.filter("length > 0").select("path", "content").mapInArrow(documents, "doc_id long, ids binary, n_tokens long, file string, start_in_file long")


def with_starts(tokens: DataFrame) -> DataFrame:
    """Adds ``start``: the ids of all documents before a document, over all files in order of their ids."""
    files = tokens.groupBy("file").agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last"), F.sum("n_tokens").alias("file_tokens"))
    # One row for each file; files are as large as the writer makes them.
    before = Window.orderBy("first", "last", "file").rowsBetween(Window.unboundedPreceding, -1)
    files = files.withColumn("before", F.coalesce(F.sum("file_tokens").over(before), F.lit(0)))
    joined = tokens.join(files.select("file", "before"), "file")
    return joined.withColumn("start", F.col("before") + F.col("start_in_file"))


def digests(tokens: DataFrame) -> DataFrame:
    """Checksums and starts. Numbers alone are kept from one reading of the files; starts are summed up from them."""
    narrow = tokens.select("doc_id", "n_tokens", "file", "start_in_file", F.crc32("ids").alias("ids_crc32"))
    return with_starts(written(narrow, "token-rows")).select("doc_id", "start", "n_tokens", "ids_crc32")
