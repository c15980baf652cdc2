"""Exact top-k by inner product with vector-approximation files.

The approximation table: vectors come in blocks; each block has its own grid of 2**bits cells per dimension
and holds, per vector, the cell numbers and the exact integers. For a query the cell numbers alone give an
upper and a lower bound of every score of the block (one matrix product). Vectors whose upper bound is
under the k-th lower bound, or under the k-th score found before, are out; the rest are read exactly
in order of their bounds (best first) until the k-th score exceeds the next bound.

The queries are a stated set. They go to the tasks in groups of ``query_bytes``, one scan of the table
per group; a task keeps k rows per query, and the last ranking sees k per query and task.

Vectors with components so large that a score need not fit a long are kept as they are, in blocks of their own: their
scores (and those of such queries) are bounded in floating point and, where the bounds leave it open, computed in
integers of any size. Only a score among the k best that no long holds is an error.

Vectors that are null or hold null or non-finite components take no part; nor do rows with a null id. Vectors of other lengths than a
query's aren't compared with it. A query's own row is any with its id; of usable query rows with one
id the least vector counts. Repeated candidate rows are ranked each. Ties go to the smaller id.
"""

from __future__ import annotations

import math
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from martsmith.llm.common import staged, table
from martsmith.session import scratch_path

SCALE = 1024
BLOCK = 4096
TABLE = "dim int, ids binary, cells binary, exact binary, base binary, step binary"
FOUND = "query_id long, vec_id long, score long, beyond int"  # beyond: 1 or -1 if the score is over or under all longs
LONG = 1 << 63


def plain_limit(dim: int) -> int:
    """Products of vectors of smaller integers, and their bounds, fit a long (and the integers 32 bits)."""
    return math.isqrt((1 << 60) // max(1, int(dim)))


def integer(x: float) -> int:
    """floor(SCALE * x), exactly."""
    return int(x) * SCALE if abs(x) >= 1 << 53 else math.floor(x * SCALE)


def vectors(ids: pa.Array, lists: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(ids, matrix) of the usable vectors, by length: of integers, or as they are (floating point) if they are large."""
    there = ids.is_valid().to_numpy(zero_copy_only=False) & lists.is_valid().to_numpy(zero_copy_only=False)
    ids, lists = ids.filter(pa.array(there)), lists.filter(pa.array(there))
    sizes = np.diff(lists.offsets.to_numpy())
    flat = lists.flatten()
    value = flat.cast(pa.float64()).fill_null(np.nan).to_numpy(zero_copy_only=False)
    bad = np.bincount(np.repeat(np.arange(len(sizes)), sizes), weights=~np.isfinite(value), minlength=len(sizes)) > 0
    starts, names = np.cumsum(sizes) - sizes, ids.to_numpy()
    for dim in np.unique(sizes[~bad]):
        rows = np.flatnonzero(~bad & (sizes == dim))
        at = starts[rows][:, None] + np.arange(dim)
        wide = (np.abs(value[at]) >= (plain_limit(dim) - 1) / SCALE).any(axis=1)
        if not wide.all():
            yield names[rows[~wide]].astype(np.int64), np.floor(SCALE * value[at[~wide]]).astype(np.int64)
        if wide.any():
            yield names[rows[wide]].astype(np.int64), value[at[wide]]


def approximation(data: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", bits: int = 6) -> DataFrame:
    """The table of blocks; those of large vectors have no cells."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for ids, exact in vectors(b.column(0), b.column(1)):
                for i in range(0, len(ids), BLOCK):
                    part = exact[i:i + BLOCK]
                    if part.dtype == np.float64:
                        out.append((part.shape[1], ids[i:i + BLOCK].tobytes(), None, part.astype("<f8").tobytes(), None, None))
                        continue
                    low, high = (part.min(axis=0), part.max(axis=0)) if part.shape[1] else (part[0], part[0])
                    step = np.maximum(1, -(-(high - low + 1) // (1 << bits)))
                    cells = ((part - low) // step).astype(np.uint8)
                    out.append((part.shape[1], ids[i:i + BLOCK].tobytes(), cells.tobytes(), part.astype("<i4").tobytes(), low.tobytes(), step.tobytes()))
            if out:
                types = [pa.int32()] + [pa.binary()] * 5
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), types, strict=True)],
                                                 ["dim", "ids", "cells", "exact", "base", "step"])

    own = data.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast("array<double>").alias("vector"))
    return own.mapInArrow(run, TABLE)


def product(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """a @ b of integers, in floating point where that is exact."""
    if a.size and b.size and float(np.abs(a).max()) * float(np.abs(b).max()) * a.shape[-1] < 1 << 53:
        return (a.astype(np.float64) @ b.astype(np.float64)).astype(np.int64)
    return a @ b


def wide_scores(queries: np.ndarray, rows: np.ndarray, own: np.ndarray, k: int) -> Iterator[tuple[np.ndarray, list[int]]]:
    """Per query the places of the ``rows`` that can be among its k best (those that are its ``own`` can't), and
    their exact scores. Both matrices are of integers or, with large components, as they are."""
    with np.errstate(all="ignore"):
        a, b = (m * (SCALE if m.dtype == np.float64 else 1.0) for m in (queries, rows))
        about = a @ b.T
        # rounding of the sums, and each factor's floor, which takes less than 1 from it
        slack = (np.abs(a) + 1) @ (np.abs(b) + 1).T * (4 * (a.shape[1] + 4) * 2.0 ** -53) + sum(
            np.abs(m).sum(axis=1)[:, None] if t else np.abs(m).sum(axis=1) for m, t in ((a, True), (b, False))) + a.shape[1]
        low, high = about - slack, about + slack
    sure = np.isfinite(low) & np.isfinite(high)
    low, high = np.where(sure, low, -np.inf), np.where(sure, high, np.inf)
    low[own] = -np.inf
    ints = {}  # exact rows, made once per row that a query needs

    def exact(v: np.ndarray) -> list[int]:
        return [integer(x) for x in v.tolist()] if v.dtype == np.float64 else v.tolist()

    for j in range(len(queries)):
        bar = np.partition(low[j], len(rows) - k)[len(rows) - k] if len(rows) >= k else -np.inf
        left, q = np.flatnonzero(~own[j] & (high[j] >= bar)), exact(queries[j])
        for i in left.tolist():
            if i not in ints:
                ints[i] = exact(rows[i])
        yield left, [sum(map(int.__mul__, q, ints[i])) for i in left.tolist()]


class Best:
    """The k best (score, id) of each of some queries of one length. Scores are Python's integers."""

    def __init__(self, ids: np.ndarray, queries: np.ndarray, k: int) -> None:
        self.ids, self.queries, self.k = ids, queries, k
        self.found: list[list[tuple[int, int]]] = [[] for _ in ids]  # (-score, id), in order

    def see(self, ids: np.ndarray, cells: np.ndarray, exact: np.ndarray, base: np.ndarray, step: np.ndarray, rows: int = 256) -> None:
        """Take a block into account; ``rows`` queries share a product."""
        k = self.k
        if self.queries.dtype == np.float64:
            self.see_wide(ids, exact, rows)
            return
        for first in range(0, len(self.ids), rows):
            q = self.queries[first:first + rows]
            corner = product(q * step, cells.T.astype(np.int64)) + (q * base).sum(axis=1)[:, None]
            over = (np.maximum(q, 0) * (step - 1)).sum(axis=1)
            under = (np.minimum(q, 0) * (step - 1)).sum(axis=1)
            for j in range(len(q)):
                got, own = self.found[first + j], ids == self.ids[first + j]
                others = len(ids) - int(own.sum())
                if not others:
                    continue
                low = np.where(own, np.iinfo(np.int64).min, corner[j] + under[j])
                bar = np.partition(low, len(ids) - k)[len(ids) - k] if others >= k else None
                if len(got) >= k:
                    kth = min(max(-got[k - 1][0], -LONG), LONG - 1)
                    bar = max(bar, kth) if bar is not None else kth
                high = corner[j] + over[j]
                left = np.flatnonzero(~own & (high >= bar) if bar is not None else ~own)
                left = left[np.argsort(-high[left], kind="stable")]
                for i in range(0, len(left), 64):
                    if len(got) >= k and -got[k - 1][0] > int(high[left[i]]):
                        break
                    part = left[i:i + 64]
                    scores = product(exact[part], q[j])
                    got = sorted([*got, *zip((-scores).tolist(), ids[part].tolist(), strict=True)])[:k]
                self.found[first + j] = got

    def see_wide(self, ids: np.ndarray, exact: np.ndarray, rows: int = 256) -> None:
        """Take a block into account whose vectors, or the queries, are large."""
        for first in range(0, len(self.ids), rows):
            own = ids == self.ids[first:first + rows, None]
            for j, (left, scores) in enumerate(wide_scores(self.queries[first:first + rows], exact, own, self.k), first):
                self.found[j] = sorted([*self.found[j], *zip((-x for x in scores), ids[left].tolist(), strict=True)])[:self.k]


def search(blocks: DataFrame, queries: tuple[np.ndarray, list[np.ndarray]], k: int) -> DataFrame:
    """(query_id, vec_id, score, beyond): k rows per query and task at most."""
    ids, matrix = queries
    kinds: dict[tuple[int, bool], list[int]] = {}
    for i, v in enumerate(matrix):
        kinds.setdefault((len(v), v.dtype == np.float64), []).append(i)
    groups = {kind: (ids[at], np.stack([matrix[i] for i in at])) for kind, at in kinds.items()}
    shared = blocks.sparkSession.sparkContext.broadcast(groups)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = {kind: Best(i, m, k) for kind, (i, m) in shared.value.items()}
        for b in batches:
            for dim, *raw in zip(*(c for c in b.columns), strict=True):
                d = dim.as_py()
                asked = [best[kind] for kind in ((d, False), (d, True)) if kind in best]
                if not asked:
                    continue
                names, cells, exact, base, step = (np.frombuffer(x.as_py() or b"", t) for x, t in zip(
                    raw, ("<i8", np.uint8, "<i4" if raw[1].is_valid else "<f8", "<i8", "<i8"), strict=True))
                exact = exact.reshape(len(names), d)
                for x in asked:
                    if raw[1].is_valid:
                        x.see(names, cells.reshape(len(names), d), exact.astype(np.int64), base, step)
                    else:
                        x.see_wide(names, exact)
        rows = [(int(q), i, -s if -LONG < s <= LONG else 0, 0 if -LONG < s <= LONG else 1 if s < 0 else -1)
                for x in best.values() for q, got in zip(x.ids, x.found, strict=True) for s, i in got]
        cols = list(zip(*rows, strict=True)) or [[], [], [], []]
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, [pa.int64()] * 3 + [pa.int32()], strict=True)],
                                         ["query_id", "vec_id", "score", "beyond"])

    return blocks.mapInArrow(run, FOUND)


def top_k(data: DataFrame, is_query: Column, k: int = 10, id_col: str = "vec_id", vector_col: str = "embedding",
          bits: int = 6, query_bytes: int = 16 << 20) -> DataFrame:
    """(query_id, rank, vec_id, score) for the rows of ``data`` for which ``is_query`` holds, against all others."""
    spark = data.sparkSession
    blocks = staged(approximation(data, id_col, vector_col, bits), "vectors")
    numbers = F.col(vector_col).cast("array<double>")
    usable = ~F.exists(numbers, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))  # null for a null vector
    asked = staged(data.where(is_query & F.col(id_col).isNotNull() & usable).groupBy(F.col(id_col).cast("long").alias("id")).agg(
        F.min(F.col(vector_col).cast("array<double>")).alias("vector")), "queries")
    size = asked.agg(F.coalesce(F.sum(F.size("vector").cast("long") + 1), F.lit(0))).first()[0]
    parts = max(1, -(-8 * size // query_bytes))
    path = scratch_path(spark, f"neighbours-{uuid.uuid4().hex[:12]}")
    for part in range(parts):  # each a scan of the whole table for a bounded group of queries
        got = asked.where(F.pmod(F.xxhash64("id"), F.lit(parts)) == part).toArrow().combine_chunks()
        ids, matrix = [], []
        for batch in got.to_batches():
            for names, exact in vectors(batch.column(0), batch.column(1)):
                ids.append(names)
                matrix.extend(exact)
        found = search(blocks, (np.concatenate(ids) if ids else np.zeros(0, np.int64), matrix), k)
        found.write.mode("append").parquet(path)
    found = spark.read.schema(FOUND).parquet(path)
    order = Window.partitionBy("query_id").orderBy(F.desc("beyond"), F.desc("score"), "vec_id")
    score = F.when(F.col("beyond") == 0, F.col("score")).otherwise(F.raise_error(F.lit("a score among the best fits no long")).cast("long"))
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", score.alias("score"))


def op4_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """query_id, rank, vec_id, score: the 10 best of all other rows for the rows whose id is divisible by 100."""
    return top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)


OP4_SQL = """
WITH usable AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * CAST(x AS DOUBLE))) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.v, c.v) AS BIGINT) AS score
  FROM usable q JOIN usable c ON q.vec_id <> c.vec_id
  WHERE q.vec_id % 100 = 0
)
SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score
FROM scored
QUALIFY row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) <= 10
"""
