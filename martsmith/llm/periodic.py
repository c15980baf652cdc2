"""Periodic runs of words: maximal stretches that repeat their first ``q`` words at least three times.

A run has smallest period q and ``max(min_words, 3 q)`` words or more, and no neighbouring word extends it. Periods are
dealt with by octave. An octave has anchors, a step apart, and knows its runs by them: as a run's words equal those q
further on for 2 q words or more, at some anchor a whole step of words equals the step of words q further on.

1. Words get numbers within their document. A document of more than ``tile_words`` words is exploded, per octave (the
   short ones together), into tiles that overlap by what an anchor needs on either side, and the tiles are shuffled;
   others are one tile.
2. A tile is solved by itself. Names of blocks, built by doubling, tell the anchors at which a period may occur; there
   the Z-functions of the words after and before the anchor (the boundary) give, for every period, how far
   equality reaches either way, and whether a smaller period explains it. What smaller periods cover isn't tried again.
   Names are hashes and only choose anchors: each claim rests on the Z-functions' comparison of words.
3. Fragments (document, period, interval) are shuffled by document and period, and those that touch are stitched. A
   tile's own are stitched before that, and a document of one tile sends none that can't be a run.

Null text has no words. Rows are told apart by a stamp, so rows of one id, or with a null id, stay rows of their own.
Only the two named columns are read. An empty table gives no rows. Words are maximal sequences without ASCII white space.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from fractions import Fraction
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from martsmith.llm.common import staged, table, text_split

MIN_WORDS = 24
STEP = 8  # of the first octaves: periods 1 to 7, whose runs have MIN_WORDS words at least
TILE_WORDS = 1 << 14

Fragment = tuple[int, int, int]  # period q, and the interval of positions i whose words at i and i + q are equal


def octaves(n_words: int) -> int:
    """The number of octaves of a document: periods 1 to 7, 8 to 15, 16 to 31, ... up to a third of its words."""
    return 0 if n_words < MIN_WORDS else max(1, (n_words // 3).bit_length() - 2)


def step_of(octave: int) -> int:
    return STEP << max(0, octave - 1)


def periods_of(octave: int) -> tuple[int, int]:
    """The least period, and the first beyond the octave."""
    return (1, STEP) if octave == 0 else (step_of(octave), 2 * step_of(octave))


@cache
def divided(q: int) -> tuple[int, ...]:
    """q over each of its prime factors: the periods one of which a repeated block of q words would have."""
    out, rest, p = [], q, 2
    while p * p <= rest:
        if rest % p == 0:
            out.append(q // p)
            while rest % p == 0:
                rest //= p
        p += 1
    return tuple([*out, q // rest] if rest > 1 else out)


def z_function(words: list[int]) -> list[int]:
    """For each position, how many words from there on equal those from the start on."""
    n = len(words)
    z, left, right = [n] + [0] * (n - 1), 0, 0
    for i in range(1, n):
        k = min(right - i, z[i - left]) if i < right else 0
        while i + k < n and words[k] == words[i + k]:
            k += 1
        z[i] = k
        if i + k > right:
            left, right = i, i + k
    return z


def doubled(names: np.ndarray, step: int) -> np.ndarray:
    """Names of blocks twice as long: of the block of ``step`` words and the one after it."""
    a, b = names[:-step], names[step:]
    mixed = (a ^ (a >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9) + (b ^ (b >> np.uint64(32))) * np.uint64(0x94D049BB133111EB)
    return mixed ^ (mixed >> np.uint64(31))


def merged(fragments: list[Fragment]) -> list[Fragment]:
    out: list[Fragment] = []
    for q, lo, hi in sorted(fragments):
        if out and out[-1][0] == q and lo <= out[-1][2]:
            out[-1] = (q, out[-1][1], max(hi, out[-1][2]))
        else:
            out.append((q, lo, hi))
    return out


def solve(words: np.ndarray, first_octave: int, end_octave: int, anchors: tuple[int, int] | None = None, origin: int = 0) -> list[Fragment]:
    """The fragments at the anchors of a tile, whose first word has the number ``origin`` of the document; ``anchors`` (from,
    to) are numbers of the document too. Only periods that no smaller one explains."""
    n = len(words)
    from_, to = anchors or (0, n)
    found: list[Fragment] = []
    names, length = words.astype(np.uint64), 1
    covered = np.zeros(n + 1, np.int64)  # how far a known stretch over this word reaches
    for octave in range(first_octave, end_octave):
        step, (least, end) = step_of(octave), periods_of(octave)
        while length < step and len(names) > length:
            names, length = doubled(names, length), 2 * length
        if length < step or len(names) <= least:
            break
        shift = -origin % step  # of the tile's first anchor
        if octave == 0:
            at = np.arange(shift, len(names), step)
            q = np.arange(least, end)
            k, which = np.nonzero((at[:, None] + q < len(names)) & (names[np.minimum(at[:, None] + q, len(names) - 1)] == names[at][:, None]))
            where, periods = at[k], q[which]
        else:
            own = names[shift:]
            if len(own) <= step:
                continue
            hit = np.flatnonzero(own[step:] == np.repeat(own[:-step:step], step)[:len(own) - step])
            where, periods = shift + hit // step * step, step + hit % step
        if not len(where):
            continue
        keep = (where + origin >= from_) & (where + origin < to) & (covered[where] < np.minimum(where + 3 * step, n))
        where, periods = where[keep], periods[keep]
        if not len(where):
            continue
        fresh: list[Fragment] = []
        order = np.argsort(where, kind="stable")
        cuts = np.flatnonzero(np.diff(where[order], prepend=-1))
        for c, qs in zip(where[order][cuts].tolist(), np.split(periods[order], cuts[1:]), strict=True):
            fresh += boundary(words, c, qs.tolist(), step)
        fresh = merged(fresh)
        for q, lo, hi in fresh:
            np.maximum(covered[lo:hi + q], hi + q, out=covered[lo:hi + q])
        found += fresh
    return [(q, lo + origin, hi + origin) for q, lo, hi in found]


def boundary(words: np.ndarray, c: int, periods: list[int], step: int) -> list[Fragment]:
    """The fragments around the boundary before word ``c``: up to a step back, up to two steps on."""
    ahead = z_function(words[c:c + 4 * step].tolist())
    good = [q for q in periods if q < len(ahead) and ahead[q] >= step
            and not any(ahead[d] >= q - d for d in divided(q) if d < q)]
    if not good:
        return []
    top = max(good)
    before = words[max(0, c - step):c + top][::-1].tolist()  # position c - 1 is number ``top``
    back = z_function([*before[top:], -1, *before])
    pattern = len(before) - top
    return [(q, c - back[pattern + 1 + top - q], c + min(ahead[q], 2 * step)) for q in good]


def tiles(words: np.ndarray, tile_words: int) -> Iterator[tuple[int, int, int, int, int, np.ndarray]]:
    """(first octave, end, first anchor, end, origin, words) of the tiles of a long document."""
    n, end = len(words), octaves(len(words))
    short = max([o + 1 for o in range(end) if step_of(o) <= tile_words // 8], default=0)
    for lo, hi in [(0, short)] * (short > 0) + [(o, o + 1) for o in range(short, end)]:
        widest = step_of(hi - 1)
        stride = max(tile_words, 2 * widest) // widest * widest
        for a in range(0, n, stride):
            origin = max(0, a - widest)
            yield lo, hi, a, min(n, a + stride), origin, words[origin:a + stride + 4 * widest]


def is_run(q: int, lo: int, hi: int) -> bool:
    return hi - lo + q >= max(MIN_WORDS, 3 * q)


def numbered(words: list[bytes]) -> np.ndarray:
    """Words as numbers, equal for equal words."""
    of: dict[bytes, int] = {}
    return np.fromiter((of.setdefault(w, len(of)) for w in words), np.int32, len(words))


def digest(raw: bytes) -> str:
    return hashlib.sha256(raw).hexdigest()


# One table of documents, fragments and tiles: the documents are read once.
DOC, FRAGMENT, TILE = 0, 1, 2
ROWS = pa.schema([
    ("kind", pa.int8()), ("row", pa.int64()), ("doc_id", pa.int64()), ("n_words", pa.int64()), ("plain_sha256", pa.string()), ("text", pa.string()),
    ("period", pa.int64()), ("lo", pa.int64()), ("hi", pa.int64()),
    ("octave", pa.int64()), ("end_octave", pa.int64()), ("anchor", pa.int64()), ("end_anchor", pa.int64()), ("origin", pa.int64()), ("words", pa.binary())])
ROWS_SQL = ("kind tinyint, row long, doc_id long, n_words long, plain_sha256 string, text string, period long, lo long, hi long, "
            "octave long, end_octave long, anchor long, end_anchor long, origin long, words binary")
OUT = ("doc_id long, n_words long, runs array<struct<start:long,length:long,period:long>>, start long, length long, period long, "
       "exponent_milli long, runs_sha256 string, collapsed_sha256 string, collapsed string")


def exploded(docs: DataFrame, id_col: str, text_col: str, tile_words: int, texts: bool) -> DataFrame:
    """Documents, the fragments of those of one tile, and the tiles of the others. A document without fragments and tiles
    carries its text only if ``texts``."""
    def rows(row: int, doc_id: int | None, text: str) -> Iterator[dict]:
        words = text.encode("utf-8").split()  # bytes: ASCII white space only
        own: list[dict] = []
        if octaves(len(words)):
            ids = numbered(words)
            if len(words) <= tile_words:
                own = [{"kind": FRAGMENT, "row": row, "period": q, "lo": lo, "hi": hi} for q, lo, hi in merged(solve(ids, 0, octaves(len(ids)))) if is_run(q, lo, hi)]
            else:
                own = [{"kind": TILE, "row": row, "octave": o, "end_octave": e, "anchor": a, "end_anchor": z, "origin": origin, "words": part.astype("<i4").tobytes()}
                       for o, e, a, z, origin, part in tiles(ids, tile_words)]
        yield {"kind": DOC, "row": row, "doc_id": doc_id, "n_words": len(words), "plain_sha256": None if own else digest(b" ".join(words)),
               "text": text if own or texts else None}
        yield from own

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        row, held, size = TaskContext.get().partitionId() << 33, [], 0
        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                for r in rows(row, doc_id, text.as_py() or ""):
                    held.append(r)
                    size += 100 + len(r.get("words") or r.get("text") or "")
                    if size > 1 << 23:
                        yield pa.RecordBatch.from_pylist(held, ROWS)
                        held, size = [], 0
                row += 1
        if held:
            yield pa.RecordBatch.from_pylist(held, ROWS)

    own = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return own.mapInArrow(run, ROWS_SQL)


def solved(rows: DataFrame) -> DataFrame:
    """(row, period, lo, hi): the fragments of the tiles, which are dealt out."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for t in batch.to_pylist():
                got = merged(solve(np.frombuffer(t["words"], "<i4"), t["octave"], t["end_octave"], (t["anchor"], t["end_anchor"]), t["origin"]))
                cols = list(zip(*got, strict=True)) or [[], [], []]
                yield pa.RecordBatch.from_arrays([pa.array([t["row"]] * len(got), pa.int64()), *[pa.array(c, pa.int64()) for c in cols]], ["row", "period", "lo", "hi"])

    cut = rows.where(F.col("kind") == TILE).select("row", "octave", "end_octave", "anchor", "end_anchor", "origin", "words")
    return cut.repartition("row", "octave", "anchor").mapInArrow(run, "row long, period long, lo long, hi long")


def stitched(fragments: DataFrame) -> DataFrame:
    """(row, runs): fragments of a document and period that touch become one; runs by start, then period."""
    own = Window.partitionBy("row", "period")
    before = F.max("hi").over(own.orderBy("lo", "hi").rowsBetween(Window.unboundedPreceding, -1))
    island = F.sum(F.when(F.col("before").isNull() | (F.col("lo") > F.col("before")), 1).otherwise(0)).over(
        own.orderBy("lo", "hi").rowsBetween(Window.unboundedPreceding, Window.currentRow))
    whole = fragments.withColumn("before", before).withColumn("island", island).groupBy("row", "period", "island").agg(
        F.min("lo").alias("start"), (F.max("hi") - F.min("lo") + F.col("period")).alias("length"))
    return whole.where(F.col("length") >= F.greatest(F.lit(MIN_WORDS), 3 * F.col("period"))).groupBy("row").agg(
        F.array_sort(F.collect_list(F.struct("start", "length", "period"))).alias("runs"))


def described(doc_id: int | None, text: str, runs: list[dict], texts: bool) -> tuple:
    words = text.encode("utf-8").split()
    keep = np.ones(len(words), bool)
    for r in runs:
        keep[r["start"] + r["period"]:r["start"] + r["length"]] = False
    collapsed = b" ".join([words[k] for k in np.flatnonzero(keep)])
    best = min(runs, key=lambda r: (-Fraction(r["length"], r["period"]), r["start"], r["period"]), default=None)
    told = [best["start"], best["length"], best["period"], 1000 * best["length"] // best["period"]] if best else [None] * 4
    listed = "".join(f"{r['start']},{r['length']},{r['period']}\n" for r in runs).encode()
    return (doc_id, len(words), runs, *told, digest(listed), digest(collapsed), collapsed.decode("utf-8") if texts else None)


def periodic_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", tile_words: int = TILE_WORDS, texts: bool = False) -> DataFrame:
    """A row per row of ``docs``: doc_id, n_words, runs (start, length, period), the run with the greatest length over period
    (start, length, period, exponent_milli; ties to the smallest start, then period), runs_sha256, collapsed_sha256 and, with ``texts``,
    ``collapsed``: the words but those that a run has after its first period, joined by spaces."""
    rows = staged(exploded(docs, id_col, text_col, tile_words, texts), "periodic-tiles")
    fragments = rows.where(F.col("kind") == FRAGMENT).select("row", "period", "lo", "hi").unionByName(solved(rows))
    heads = rows.where(F.col("kind") == DOC)
    plain = heads.where(F.col("plain_sha256").isNotNull())
    none = F.array().cast("array<struct<start:long,length:long,period:long>>")
    nothing = plain.select("doc_id", "n_words", none.alias("runs"), *[F.lit(None).cast("long").alias(c) for c in ("start", "length", "period", "exponent_milli")],
                           F.lit(digest(b"")).alias("runs_sha256"), F.col("plain_sha256").alias("collapsed_sha256"),
                           (F.array_join(text_split(F.col("text"), "[\\x20\\x09-\\x0D]+"), " ") if texts else F.lit(None).cast("string")).alias("collapsed"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [c.split()[0] for c in ("doc_id", "n_words", "runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256", "collapsed")]
        run_type = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))
        types = [pa.int64()] * 2 + [run_type] + [pa.int64()] * 4 + [pa.string()] * 3
        for batch in batches:
            for i in range(0, batch.num_rows, 256):
                out = [described(r["doc_id"], r["text"], r["runs"] or [], texts) for r in batch.slice(i, 256).to_pylist()]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), types, strict=True)], names)

    hit = heads.where(F.col("plain_sha256").isNull()).select("row", "doc_id", "text").join(stitched(fragments), "row", "left")
    out = hit.select("doc_id", "text", "runs").mapInArrow(run, OUT).unionByName(nothing)
    return out if texts else out.drop("collapsed")


def with_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, text): every tenth document by crc32 of its id repeats a part of itself up to its end; null ids don't."""
    space = "[\\x20\\x09-\\x0D]+"
    own = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"),
                      F.crc32(F.col(id_col).cast("long").cast("string")).alias("h"))
    words = F.when(F.col("h") % 10 == 0, text_split(F.col("text"), space))
    own = own.withColumn("ws", words).withColumn("n", F.size("ws").cast("long")).withColumn("g", F.floor(F.col("h") / 10))
    own = own.withColumn("a", F.when(F.col("n") > 0, F.col("g") % F.col("n")))
    own = own.withColumn("p", 1 + F.floor((F.col("n") - F.col("a")) / (3 + F.col("g") % 8)))

    def at(i: Column) -> Column:
        return F.get("ws", F.when(i < F.col("a"), i).otherwise(F.col("a") + (i - F.col("a")) % F.col("p")).cast("int"))

    made = F.array_join(F.transform(F.sequence(F.lit(0).cast("long"), F.col("n") - 1), at), " ")
    return own.select("doc_id", F.when(F.coalesce(F.col("n"), F.lit(0)) > 0, made).otherwise(F.col("text")).alias("text"))


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, n_runs, start, length, period, exponent_milli, runs_sha256, collapsed_sha256 of every document."""
    got = periodic_runs(with_repeats(table(spark, sf_dir, "documents")))
    return got.select("doc_id", F.size("runs").cast("long").alias("n_runs"), "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256")
