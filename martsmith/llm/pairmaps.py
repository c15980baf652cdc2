"""Alignment of two tokenizers over a corpus by inverted bitmaps of id pairs.

Both tokenizers' tokens cover the same bytes. Offsets where a token of A and one of B both end cut a text into groups, and
the two tokens that end there are linked. How often a pair of ids is linked in the whole corpus scores its links.

1. Texts are encoded by units that neither tokenizer looks across (``subwords``): a unit's ids, groups and links are found
   once. A text with a unit whose tokens' bytes aren't its own is tried as a whole.
2. Documents get slots in chunks of at most ``CHUNK_LINKS`` links (or one longer document) and ``CHUNK_DOCS`` documents. A
   chunk's inverted index has, for each linked pair, the bitmap of the slots that hold it (plane 0: the OR of the documents'
   bits) and planes for the multiplicity beyond one (plane k: bit k - 1 of it). A bitmap is an array of 16-bit slots, or plain
   bits where that is shorter. Chunks are disjoint, so a pair's bitmaps in all chunks together are its posting.
3. Popcounts add up: plane 0 to the pair's documents, planes by their weight to its links. The maximum over a B id's pairs
   tells its best ones.
4. Postings take the pairs' scores back: each chunk's bitmaps are collected again, bounded as they are, and hand
   count and mark to their slots.

A pair has one row per chunk and plane, whatever share of all links it has, so no key is hot. Null and empty texts, and
those whose joined tokens of A or B differ from the text with a space before it, have no tokens: zeros. Rows of one id, or
with a null id, are documents of their own. Only the two named columns are read. An empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from martsmith.llm.common import staged, table
from martsmith.llm.subwords import ByteLevel, Interned, Ragged, SpacePiece, unit_ids, units_of

VOCABULARY_A, VOCABULARY_B = "byte_bpe_50k.json", "piece_bpe_32k.model"
CHUNK_LINKS, CHUNK_DOCS = 1 << 22, 1 << 16
BATCH_DOCS = 256


class Aligner:
    """Ids, groups and links of texts by both vocabularies; ``code`` of a pair is ``a * size_b + b``."""

    def __init__(self, path_a: str, path_b: str, max_units: int = 200_000) -> None:
        self.a, self.b, self.max_units = ByteLevel(path_a), SpacePiece(path_b), max_units
        self.size_b = self.b.size
        if self.a.size * self.b.size > 1 << 46:
            raise ValueError("pairs of ids and slots must fit a long")
        self.bytes_a, self.bytes_b = (np.array(list(map(len, e.pieces)), np.int64) for e in (self.a, self.b))
        self.names_a, self.names_b = ([str(i) for i in range(e.size)] for e in (self.a, self.b))
        self._forget()

    def _forget(self) -> None:
        self.known, self.links, self.groups = Interned(), Ragged(np.int64), []
        self.sizes = np.zeros((0, 2), np.int64)  # ids of A, of B; negative where the bytes differ

    def _align(self, units: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[bytes]]:
        """(ids of A and B, or -1; number of links; codes of the links; groups) of each unit."""
        (n_a, a), (n_b, b) = unit_ids(self.a, units), unit_ids(self.b, units)
        own = [b" " + u for u in units]
        good = np.ones(len(units), bool)
        for n, ids, e in ((n_a, a, self.a), (n_b, b, self.b)):
            parts = list(map(e.pieces.__getitem__, ids.tolist()))
            if b"".join(parts) != b"".join(own):
                at = [0, *np.cumsum(n).tolist()]
                good &= [b"".join(parts[s:t]) == u for u, s, t in zip(own, at, at[1:], strict=False)]
        a, b = a[np.repeat(good, n_a)], b[np.repeat(good, n_b)]
        unit_of_a = np.repeat(np.flatnonzero(good), n_a[good])
        _, in_a, in_b = np.intersect1d(np.cumsum(self.bytes_a[a]), np.cumsum(self.bytes_b[b]), assume_unique=True, return_indices=True)
        n_links = np.bincount(unit_of_a[in_a], minlength=len(units))
        text_a, text_b = [self.names_a[i] for i in a.tolist()], [self.names_b[i] for i in b.tolist()]
        to_a, to_b = (in_a + 1).tolist(), (in_b + 1).tolist()
        groups = [",".join(text_a[s:t]) + "|" + ",".join(text_b[u:v]) for s, t, u, v in zip([0, *to_a], to_a, [0, *to_b], to_b, strict=False)]
        at = [0, *np.cumsum(n_links).tolist()]
        told = [";".join(groups[s:t]).encode() for s, t in zip(at, at[1:], strict=False)]
        return np.where(good[:, None], np.stack([n_a, n_b], 1), -1), n_links, a[in_a] * self.size_b + b[in_b], told

    def align(self, texts: list[str | None]) -> Iterator[tuple[int, int, np.ndarray, str]]:
        """(ids of A, of B, codes of the links, sha256 of the groups) of each text; ``''`` without tokens."""
        if len(self.known) > self.max_units:
            self._forget()
        numbers = [self.known.numbers(units_of(" " + t)) if t else None for t in texts]
        new, self.known.new = self.known.new, []
        if new:
            sizes, n_links, codes, groups = self._align(new)
            self.sizes = np.concatenate([self.sizes, sizes])
            self.links.extend(n_links, codes)
            self.groups += groups
        for text, own in zip(texts, numbers, strict=True):
            if own is None:
                yield 0, 0, np.zeros(0, np.int64), ""
                continue
            sizes, codes, groups = self.sizes[own], None, None
            if (sizes < 0).any():  # the bytes may yet agree in sum
                sizes, _, codes, groups = self._align([text.encode("utf-8")])
            if (sizes < 0).any():
                yield 0, 0, np.zeros(0, np.int64), ""
                continue
            if codes is None:
                codes, groups = self.links.gather(own), map(self.groups.__getitem__, own.tolist())
            yield *map(int, sizes.sum(0)), codes, hashlib.sha256(b";".join(groups)).hexdigest()


_ALIGNERS: dict[tuple[str, str], Aligner] = {}


def _aligner(a: str, b: str) -> Aligner:
    """One per worker process."""
    if (a, b) not in _ALIGNERS:
        _ALIGNERS[a, b] = Aligner(a, b)
    return _ALIGNERS[a, b]


DOC, POSTING = 0, 1
ROWS = pa.schema([("kind", pa.int8()), ("chunk", pa.int64()), ("slot", pa.int32()), ("doc_id", pa.int64()), ("n_a", pa.int64()), ("n_b", pa.int64()),
                  ("n_links", pa.int64()), ("groups_sha256", pa.string()),
                  ("code", pa.int64()), ("plane", pa.int8()), ("dense", pa.bool_()), ("bits", pa.binary())])
ROWS_SQL = ("kind tinyint, chunk long, slot int, doc_id long, n_a long, n_b long, n_links long, groups_sha256 string, "
            "code long, plane tinyint, dense boolean, bits binary")


def bitmaps(codes: np.ndarray, slots: np.ndarray, n_slots: int) -> Iterator[tuple[int, np.ndarray, np.ndarray, list[bytes] | pa.Array]]:
    """(plane, codes, dense, bits) of a chunk's links: one bitmap per pair, plane by plane, arrays and plain bits apart."""
    keys, times = np.unique(codes << 16 | slots, return_counts=True)
    beyond = times - 1
    plane = 0
    while len(keys):
        own = keys if plane == 0 else keys[beyond >> (plane - 1) & 1 > 0]
        code, slot = own >> 16, (own & 0xFFFF).astype("<u2")
        first = np.flatnonzero(np.diff(code, prepend=-1))
        n = np.diff(first, append=len(own))
        dense = n > n_slots // 16
        if (~dense).any():
            ends = 2 * np.concatenate([[0], np.cumsum(n[~dense])]).astype(np.int32)
            data = slot[np.repeat(~dense, n)].tobytes()
            yield plane, code[first][~dense], np.zeros(len(ends) - 1, bool), pa.Array.from_buffers(
                pa.binary(), len(ends) - 1, [None, pa.py_buffer(ends.tobytes()), pa.py_buffer(data)])
        if dense.any():
            made = []
            for s, k in zip(first[dense], n[dense], strict=True):
                bits = np.zeros(n_slots, bool)
                bits[slot[s:s + k]] = True
                made.append(np.packbits(bits, bitorder="little").tobytes())
            yield plane, code[first][dense], np.ones(len(made), bool), made
        plane += 1
        if not (beyond >> (plane - 1)).any():
            return


def slots_in(dense: bool, bits: bytes) -> np.ndarray:
    """The slots of a bitmap."""
    return np.flatnonzero(np.unpackbits(np.frombuffer(bits, np.uint8), bitorder="little")) if dense else np.frombuffer(bits, "<u2").astype(np.int64)


def index_rows(docs: DataFrame, id_col: str, text_col: str, path_a: str, path_b: str, chunk_links: int, chunk_docs: int) -> DataFrame:
    """Documents with chunk and slot, and their chunks' bitmaps."""
    def rows(**columns) -> pa.RecordBatch:
        n = len(next(v for v in columns.values() if not isinstance(v, int)))
        return pa.RecordBatch.from_arrays([
            pa.nulls(n, f.type) if f.name not in columns else pa.array([columns[f.name]] * n, f.type) if isinstance(columns[f.name], int)
            else columns[f.name] if isinstance(columns[f.name], pa.Array) else pa.array(columns[f.name], f.type) for f in ROWS], schema=ROWS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner, chunk = _aligner(path_a, path_b), TaskContext.get().partitionId() << 33
        docs_held: list[tuple] = []
        codes_held: list[np.ndarray] = []
        n = 0

        def closed() -> Iterator[pa.RecordBatch]:
            ids, n_a, n_b, sha = zip(*docs_held, strict=True)
            sizes = [len(c) for c in codes_held]
            yield rows(kind=DOC, chunk=chunk, slot=np.arange(len(ids)), doc_id=list(ids), n_a=list(n_a), n_b=list(n_b), n_links=sizes, groups_sha256=list(sha))
            for plane, code, dense, bits in bitmaps(np.concatenate(codes_held), np.repeat(np.arange(len(ids)), sizes), len(ids)):
                for i in range(0, len(code), 1 << 16):
                    part = slice(i, i + (1 << 16))
                    yield rows(kind=POSTING, chunk=chunk, code=code[part], plane=plane, dense=dense[part], bits=bits[part])

        for batch in batches:
            for i in range(0, batch.num_rows, BATCH_DOCS):
                part = batch.slice(i, BATCH_DOCS)
                for doc_id, (n_a, n_b, codes, sha) in zip(part.column(0).to_pylist(), aligner.align(part.column(1).to_pylist()), strict=True):
                    docs_held.append((doc_id, n_a, n_b, sha))
                    codes_held.append(codes)
                    n += len(codes)
                    if n >= chunk_links or len(docs_held) >= chunk_docs:
                        yield from closed()
                        chunk, n = chunk + 1, 0
                        docs_held, codes_held = [], []
        if docs_held:
            yield from closed()

    own = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return own.mapInArrow(run, ROWS_SQL)


def pair_counts(index: DataFrame, size_b: int) -> DataFrame:
    """(code, n_docs, n_links, is_best) of every linked pair, by popcounts of its bitmaps."""
    count = F.when(F.col("dense"), F.bitmap_count("bits")).otherwise((F.length("bits") / 2).cast("long"))
    weight = F.expr("shiftleft(1L, greatest(0, cast(plane AS int) - 1))")
    counts = index.where(F.col("kind") == POSTING).select("code", "plane", count.alias("ones"), weight.alias("weight")).groupBy("code").agg(
        F.sum(F.when(F.col("plane") == 0, F.col("ones")).otherwise(0)).alias("n_docs"), F.sum(F.col("ones") * F.col("weight")).alias("n_links"))
    b = F.col("code") % size_b
    best = counts.groupBy(b.alias("b")).agg(F.max("n_links").alias("most"))
    return counts.withColumn("b", b).join(best, "b").select("code", "n_docs", "n_links", (F.col("n_links") == F.col("most")).alias("is_best"))


def scored(index: DataFrame, counts: DataFrame) -> DataFrame:
    """(chunk, slot, n_best, count_sum): what the postings hand back to the documents with links."""
    own = index.where(F.col("kind") == POSTING).select("chunk", "code", "plane", "dense", "bits").join(
        counts.select("code", F.col("n_links").alias("score"), "is_best"), "code").select("chunk", "plane", "dense", "bits", "score", "is_best")

    def run(postings: pa.Table) -> pa.Table:
        postings = postings.combine_chunks()
        plane, dense, score, is_best = (postings.column(c).to_numpy() for c in ("plane", "dense", "score", "is_best"))
        weight = np.left_shift(1, np.maximum(plane.astype(np.int64) - 1, 0))
        bits = postings.column("bits").to_pylist()
        parts = [slots_in(d, x) for d, x in zip(dense.tolist(), bits, strict=True)]
        slots, n = np.concatenate(parts), [len(p) for p in parts]
        top = int(slots.max()) + 1
        sums, best, there = np.zeros(top, np.int64), np.zeros(top, np.int64), np.zeros(top, bool)
        np.add.at(sums, slots, np.repeat(weight * score, n))
        np.add.at(best, slots, np.repeat(weight * is_best, n))
        there[slots] = True
        at = np.flatnonzero(there)
        chunk = postings.column("chunk")[0].as_py()
        return pa.table({"chunk": pa.array([chunk] * len(at), pa.int64()), "slot": pa.array(at, pa.int32()), "n_best": best[at], "count_sum": sums[at]})

    return own.groupBy("chunk").applyInArrow(run, "chunk long, slot int, n_best long, count_sum long")


def _index(docs: DataFrame, id_col: str, text_col: str, vocabulary_a: str | None, vocabulary_b: str | None, chunk_links: int, chunk_docs: int) -> tuple[DataFrame, int]:
    import sentencepiece

    path_a, path_b = vocabulary_a or public_tokenizers.path(VOCABULARY_A), vocabulary_b or public_tokenizers.path(VOCABULARY_B)
    index = staged(index_rows(docs, id_col, text_col, path_a, path_b, chunk_links, chunk_docs), "pair-index")
    return index, sentencepiece.SentencePieceProcessor(model_file=path_b).get_piece_size()


def pairs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", vocabulary_a: str | None = None, vocabulary_b: str | None = None,
          chunk_links: int = CHUNK_LINKS, chunk_docs: int = CHUNK_DOCS) -> DataFrame:
    """(a, b, n_docs, n_links, is_best) of every pair of ids linked in ``docs``."""
    index, size_b = _index(docs, id_col, text_col, vocabulary_a, vocabulary_b, chunk_links, chunk_docs)
    a: Column = F.floor(F.col("code") / size_b)
    return pair_counts(index, size_b).select(a.alias("a"), (F.col("code") % size_b).alias("b"), "n_docs", "n_links", "is_best")


def align(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", vocabulary_a: str | None = None, vocabulary_b: str | None = None,
          chunk_links: int = CHUNK_LINKS, chunk_docs: int = CHUNK_DOCS) -> DataFrame:
    """(doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256): a row per row of ``docs``."""
    index, size_b = _index(docs, id_col, text_col, vocabulary_a, vocabulary_b, chunk_links, chunk_docs)
    heads = index.where(F.col("kind") == DOC).select("chunk", "slot", "doc_id", "n_a", "n_b", "n_links", "groups_sha256")
    return heads.join(scored(index, pair_counts(index, size_b)), ["chunk", "slot"], "left").select(
        "doc_id", "n_a", "n_b", F.col("n_links").alias("n_groups"), "n_links", F.coalesce("n_best", F.lit(0)).cast("long").alias("n_best"),
        F.coalesce("count_sum", F.lit(0)).cast("long").alias("count_sum"), "groups_sha256")


def op11_pair_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256 of every document."""
    return align(table(spark, sf_dir, "documents"))
