"""Token ids of whole documents in binary files of fixed-width bits.

Every id takes the least number of bits that the vocabulary's ids need. A file holds consecutive documents in
ascending order of their id (null first; rows of one id by a hash of their text), and is readable by itself:

    header   64 bytes: magic, format version, bits, ids per block, number of the task, of the task's file, documents,
             ids, blocks
    documents  id (8 bytes), null mark (1), first position in the file (8, and one more at the end), one column each
    offsets  byte at which each block starts, 8 bytes each, and the end
    blocks   ``block_ids`` ids each (the last may have fewer), low bits first, padded to whole bytes

All numbers are little-endian. As the width is fixed, an id's place follows from its position: its block's offset and a
bit address inside, so that any range of ids is read from the blocks that it touches, by numpy, from
memory-mapped files too (``TokenFile``).

``write_token_files`` deals the documents out by ranges of (id, text hash, row stamp), encodes each range in order and
writes it: nothing but the documents is shuffled, once. The row stamp spreads an id, or a text, that a third of all rows
have; it is a row's place in the partitions of ``docs``, which should therefore be read from a table (stage it otherwise). A task
closes a file at the first document's end beyond ``file_ids``, so it holds one file's ids and one batch. Spark's text
writer writes the bytes (a line break closes each file), so any file system of Spark's will do and the commit protocol
covers lost executors. There are at most ``MAX_FILES`` files and one per task: larger inputs get larger files, and the
index (a row per file) stays small enough to send to all tasks.

Null text is empty: it has the end id alone. Repeated rows are documents of their own; a null id is kept. Only the two
named columns are read. An empty table gives no documents.
"""

from __future__ import annotations

import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martsmith.llm.common import staged, table
from martsmith.llm.subwords import TextEncoder
from martsmith.session import scratch_path

VOCABULARY = "byte_bpe_50k.json"
MAGIC, VERSION = b"TOKBITS\n", 1
HEADER = "<8sIIQQQQQQ"
HEADER_BYTES = struct.calcsize(HEADER)  # 64
BLOCK_IDS = 1 << 16  # a multiple of 8: full blocks end at whole bytes
FILE_IDS = 1 << 23
TASK_BYTES = 1 << 24  # of text
MAX_FILES, MAX_TASKS = 200_000, 20_000
BATCH_DOCS = 256

DOCUMENTS = "task long, file long, nth long, doc_id long, first long, n_tokens long, ids_crc32 long"


def bits_for(vocabulary_size: int) -> int:
    """The least number of bits that hold every id below ``vocabulary_size``."""
    return max(1, (vocabulary_size - 1).bit_length())


def pack_bits(ids: np.ndarray, bits: int) -> bytes:
    """``ids`` at ``bits`` bits each, low bits first, padded to whole bytes."""
    ids = np.ascontiguousarray(ids, "<u4")
    if bits in (8, 16, 32):
        return ids.astype(f"<u{bits // 8}").tobytes()
    each = np.unpackbits(ids.view(np.uint8).reshape(-1, 4), axis=1, bitorder="little", count=bits)
    return np.packbits(each.reshape(-1), bitorder="little").tobytes()


def unpack_bits(raw, bits: int, first: int, count: int) -> np.ndarray:
    """``count`` ids from the ``first`` on; only the bytes that hold them are touched."""
    if bits in (8, 16, 32):
        return np.frombuffer(raw, f"<u{bits // 8}", count, first * bits // 8).astype(np.uint32)
    at = first * bits
    own = np.frombuffer(raw, np.uint8, -(-(at + count * bits) // 8) - at // 8, at // 8)
    each = np.unpackbits(own, bitorder="little", count=at % 8 + count * bits)[at % 8:].reshape(count, bits)
    padded = np.zeros((count, 32), np.uint8)
    padded[:, :bits] = each
    return np.packbits(padded, axis=1, bitorder="little").view("<u4").reshape(-1)


def file_bytes(task: int, file: int, docs: list[tuple], bits: int, block_ids: int = BLOCK_IDS) -> bytes:
    """One file of ``docs`` (id or None, ids)."""
    ids = np.concatenate([x for _, x in docs]).astype("<u4", copy=False)
    starts = np.zeros(len(docs) + 1, "<i8")
    np.cumsum([len(x) for _, x in docs], out=starts[1:])
    blocks = [pack_bits(ids[i:i + block_ids], bits) for i in range(0, len(ids), block_ids)]
    head = HEADER_BYTES + 17 * len(docs) + 8 + 8 * (len(blocks) + 1)
    offsets = np.cumsum([head, *map(len, blocks)]).astype("<i8")
    return b"".join([
        struct.pack(HEADER, MAGIC, VERSION, bits, block_ids, task, file, len(docs), len(ids), len(blocks)),
        np.array([d or 0 for d, _ in docs], "<i8").tobytes(), np.array([d is None for d, _ in docs], np.uint8).tobytes(),
        starts.tobytes(), offsets.tobytes(), *blocks])


class TokenFile:
    """A file's documents and ids, out of any buffer (bytes, or a memory map)."""

    def __init__(self, raw) -> None:
        magic, version, self.bits, self.block_ids, self.task, self.file, self.n_docs, self.n_ids, blocks = struct.unpack_from(HEADER, raw, 0)
        if magic != MAGIC or version != VERSION:
            raise ValueError("not a file of token ids, or of another version")
        self.raw, at = raw, HEADER_BYTES
        self.doc_ids = np.frombuffer(raw, "<i8", self.n_docs, at)
        self.is_null = np.frombuffer(raw, np.uint8, self.n_docs, at + 8 * self.n_docs).astype(bool)
        self.starts = np.frombuffer(raw, "<i8", self.n_docs + 1, at + 9 * self.n_docs)
        self.offsets = np.frombuffer(raw, "<i8", blocks + 1, at + 17 * self.n_docs + 8)

    def ids(self, first: int, count: int) -> np.ndarray:
        """The ids at positions ``first`` to ``first + count`` of the file."""
        if first < 0 or count < 0 or first + count > self.n_ids:
            raise IndexError("no such range of ids")
        parts, end = [np.zeros(0, np.uint32)], first + count
        for b in range(first // self.block_ids, -(-end // self.block_ids) if count else 0):
            lo = b * self.block_ids
            own = memoryview(self.raw)[self.offsets[b]:self.offsets[b + 1]]
            begin, stop = max(first, lo) - lo, min(end, lo + self.block_ids) - lo
            parts.append(unpack_bits(own, self.bits, begin, stop - begin))
        return np.concatenate(parts)

    def document(self, nth: int) -> np.ndarray:
        return self.ids(int(self.starts[nth]), int(self.starts[nth + 1] - self.starts[nth]))


_ENCODERS: dict[str, TextEncoder] = {}


def _encoder(path: str) -> TextEncoder:
    """One per worker process, whatever tasks it runs."""
    if path not in _ENCODERS:
        _ENCODERS[path] = TextEncoder(path)
    return _ENCODERS[path]


def write_token_files(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", end_id: int = 2, vocabulary: str | None = None,
                      file_ids: int = FILE_IDS, block_ids: int = BLOCK_IDS, task_bytes: int = TASK_BYTES) -> None:
    """Write the token ids of ``docs``, each closed by ``end_id``, below ``path`` (a new folder)."""
    if block_ids % 8:
        raise ValueError("block_ids must be a multiple of 8")
    vocabulary = vocabulary or public_tokenizers.path(VOCABULARY)
    from tokenizers import Tokenizer

    bits = bits_for(max(Tokenizer.from_file(vocabulary).get_vocab_size(), end_id + 1))
    own = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    n_bytes, n_docs = own.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0)), F.count(F.lit(1))).first()
    tasks = max(1, min(MAX_TASKS, -(-n_bytes // task_bytes)))
    file_ids = max(file_ids, -(-(n_bytes + n_docs) // MAX_FILES))  # an id has one byte or more
    order = ["doc_id", "key", "stamp"]
    dealt = own.select("*", F.xxhash64("text").alias("key"), F.monotonically_increasing_id().alias("stamp")).repartitionByRange(
        tasks, *order).sortWithinPartitions(*order)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, task, file, held, n = _encoder(vocabulary), TaskContext.get().partitionId(), 0, [], 0
        end = np.uint32(end_id)

        def closed() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([file_bytes(task, file, held, bits, block_ids)], pa.binary())], ["content"])

        for batch in batches:
            for i in range(0, batch.num_rows, BATCH_DOCS):
                part = batch.slice(i, BATCH_DOCS)
                for doc_id, ids in zip(part.column(0).to_pylist(), encoder.encode(part.column(1).to_pylist()), strict=True):
                    held.append((doc_id, np.append(ids, end).astype(narrow)))
                    n += len(ids) + 1
                    if n >= file_ids:
                        yield closed()
                        file, held, n = file + 1, [], 0
        if held:
            yield closed()

    narrow = "<u2" if bits <= 16 else "<u4"
    files = dealt.select("doc_id", "text").mapInArrow(run, "content binary")
    files.select(F.col("content").cast("string").alias("value")).write.option("compression", "none").option(
        "maxRecordsPerFile", 1).option("lineSep", "\n").text(path)


def _files(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.format("binaryFile").load(path).where("length > 0").select("content")


def file_index(spark: SparkSession, path: str) -> DataFrame:
    """(task, file, n_docs, n_ids, base): a row per file, ``base`` being the ids in all files before it."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            heads = [struct.unpack(HEADER, x.as_py())[4:8] for x in batch.column(0)]
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*heads, strict=True)] if heads else
                                             [pa.array([], pa.int64())] * 4, ["task", "file", "n_docs", "n_ids"])

    heads = _files(spark, path).select(F.substring("content", 1, HEADER_BYTES).alias("head")).mapInArrow(
        run, "task long, file long, n_docs long, n_ids long")
    before, rows = 0, []
    for r in sorted(heads.collect()):  # at most MAX_FILES + MAX_TASKS rows
        rows.append((*r, before))
        before += r.n_ids
    return spark.createDataFrame(rows, "task long, file long, n_docs long, n_ids long, base long")


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document, out of the files alone."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column(0):
                f = TokenFile(content.as_buffer())
                raw = memoryview(f.ids(0, f.n_ids).astype("<u4", copy=False)).cast("B")
                n = np.diff(f.starts)
                crc = [zlib.crc32(raw[4 * s:4 * e]) for s, e in zip(f.starts[:-1].tolist(), f.starts[1:].tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays([
                    pa.array(np.full(f.n_docs, f.task)), pa.array(np.full(f.n_docs, f.file)), pa.array(np.arange(f.n_docs)),
                    pa.array(f.doc_ids, pa.int64(), mask=f.is_null), pa.array(f.starts[:-1]), pa.array(n), pa.array(crc, pa.int64()),
                ], [c.split()[0] for c in DOCUMENTS.split(", ")])

    found = staged(_files(spark, path).mapInArrow(run, DOCUMENTS), "token-documents")  # the files are read once
    sizes = found.groupBy("task", "file").agg(F.sum("n_tokens").alias("n_ids")).collect()  # at most MAX_FILES + MAX_TASKS rows
    bases, before = [], 0
    for r in sorted(sizes):
        bases.append((r.task, r.file, before))
        before += r.n_ids
    index = F.broadcast(spark.createDataFrame(bases, "task long, file long, base long"))
    return found.join(index, ["task", "file"]).select("doc_id", (F.col("base") + F.col("first")).alias("start"), "n_tokens", "ids_crc32")


def read_range(spark: SparkSession, path: str, start: int, count: int) -> np.ndarray:
    """``count`` ids from position ``start`` of the whole: from the files that hold them, and of those the blocks only. The
    range must fit in the driver's memory."""
    index = file_index(spark, path).where((F.col("base") < start + count) & (F.col("base") + F.col("n_ids") > start))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column(0):
                f = TokenFile(content.as_buffer())
                if base := of.get((f.task, f.file)):
                    lo, hi = max(start, base[0]) - base[0], min(start + count, base[0] + f.n_ids) - base[0]
                    yield pa.RecordBatch.from_arrays([pa.array([base[0] + lo]), pa.array([f.ids(lo, hi - lo).tobytes()], pa.binary())], ["at", "ids"])

    of = {(r.task, r.file): (r.base,) for r in index.collect()}
    parts = _files(spark, path).mapInArrow(run, "at long, ids binary").collect()
    return np.concatenate([np.zeros(0, np.uint32), *[np.frombuffer(r.ids, "<u4") for r in sorted(parts)]])


def op13_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of every document, read back from the files just written."""
    path = scratch_path(spark, f"token-files-{uuid.uuid4().hex[:12]}")
    write_token_files(table(spark, sf_dir, "documents"), path)
    return read_documents(spark, path)
