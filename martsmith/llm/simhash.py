"""SimHash near-duplicate groups with pigeonring candidate pruning.

1. A fingerprint per document (Arrow batches; whole texts, long ones in bounded chunks).
2. Equal fingerprints collapse before any pairing, so a group of exact copies is one node.
3. A fingerprint is a ring of ``segments`` bit segments. If two differ in at most ``max_bits``
   bits, then some segment starts a chain whose first l segments differ, for every l, in at most
   floor(l * max_bits / segments) bits. The leading part of that budget is 0: those segments are
   equal, and their value is the join key. The rest of the chain is checked inside the join
   condition, then the whole distance.
4. A bucket of more than ``bucket_bound`` different fingerprints is not paired. Its members
   go the exact other way: two values differ in at most 2 bits exactly if they share one of
   their one-bit neighbours (or one is a neighbour of the other), so linking each to its
   neighbours that two of them share costs 65 rows per member and loses no link.
   (Hence ``max_bits`` is 2 at most.)
5. Connected components by alternating large and small stars, on staged tables.

Null text is as empty text: fingerprint 0, linked like any other. Repeated rows are copies;
rows with a null id take part, and a group's id is the smallest id that is not null.
``keep_one`` goes by ids alone and is for ids that name one text; ``one_per_group`` tells rows apart by id and text.
Only the id and text columns are read, so extra columns do no harm.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import islice, repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from martsmith.llm.common import fingerprint128, fresh, staged, table

MASK64 = (1 << 64) - 1
CHUNK = 1 << 16  # shingles whose bits are counted at once


def simhash(text: str | None, shingle: int = 3) -> int:
    """64-bit fingerprint: bit set if set in over half of the shingles' XXH64 (seed 42)."""
    words = text.encode("utf-8").lower().split() if text else []  # bytes: ASCII case and space only
    if not words:
        return 0
    parts = [words[i:] for i in range(shingle)] if len(words) >= shingle else [[w] for w in words]
    hashes = map(xxhash.xxh64_intdigest, map(b" ".join, zip(*parts, strict=False)), repeat(42))
    ones, total = np.zeros(64, np.int64), 0
    while (h := np.fromiter(islice(hashes, CHUNK), np.uint64)).size:
        bits = np.unpackbits(h.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
        total += h.size
    return int(np.packbits(ones * 2 > total, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3) -> DataFrame:
    """(doc_id, fp): one row per input row, the fingerprint as a signed long."""
    return _with_fingerprint(docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")), shingle)


def _with_fingerprint(own: DataFrame, shingle: int) -> DataFrame:
    """``own`` (longs, and text) with fp in place of text."""
    keep = [c for c in own.columns if c != "text"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fp = np.array([simhash(t.as_py(), shingle) for t in b.column(0)], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([*b.columns[1:], pa.array(fp)], [*keep, "fp"])

    return own.select("text", *keep).mapInArrow(run, ", ".join(f"{c} long" for c in [*keep, "fp"]))


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def ring_masks(segments: int) -> list[list[int]]:
    """masks[start][l - 1]: the bits of the l segments from ``start`` on, around the ring."""
    cuts = [64 * i // segments for i in range(segments + 1)]
    one = [((1 << (hi - lo)) - 1) << lo for lo, hi in zip(cuts, cuts[1:], strict=False)]
    return [[sum(one[(s + j) % segments] for j in range(n)) for n in range(1, segments + 1)] for s in range(segments)]


def linked(fps: DataFrame, max_bits: int = 2, segments: int = 7, bucket_bound: int = 128) -> DataFrame:
    """Edges (a, b) whose components are those of "differ in at most ``max_bits`` bits".

    ``fps``: distinct values in column ``fp``. An end of an edge may be a value that is
    no fingerprint but a one-bit neighbour of several."""
    if not 0 <= max_bits < segments <= 64 or max_bits > 2:
        raise ValueError("max_bits from 0 to 2, under segments, is supported")
    masks = ring_masks(segments)
    budget = [n * max_bits // segments for n in range(1, segments + 1)]
    equal = sum(b == 0 for b in budget)  # chain lengths that leave no bit
    keys = fps.select("fp", F.explode(F.array(*[
        F.struct(F.lit(s).alias("start"), F.col("fp").bitwiseAND(F.lit(_signed(masks[s][equal - 1]))).alias("key"))
        for s in range(segments)])).alias("k")).select("fp", "k.start", "k.key")
    sizes = keys.groupBy("start", "key").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    shared = staged(keys.join(sizes, ["start", "key"]), "simhash-buckets")

    def chain(diff: Column) -> Column:
        """The prefixes of the chain that begins at ``start`` keep their budgets."""
        ok = F.lit(False)
        for s in range(segments):
            fits = F.lit(True)
            for n in range(equal, segments):
                fits &= F.bit_count(diff.bitwiseAND(F.lit(_signed(masks[s][n])))) <= budget[n]
            ok |= (F.col("x.start") == s) & fits
        return ok

    few = shared.where(F.col("n") <= bucket_bound)
    diff = F.col("x.fp").bitwiseXOR(F.col("y.fp"))
    pairs = few.alias("x").join(
        few.alias("y"),
        (F.col("x.start") == F.col("y.start")) & (F.col("x.key") == F.col("y.key")) & (F.col("x.fp") < F.col("y.fp"))
        & chain(diff) & (F.bit_count(diff) <= max_bits),
    ).select(F.col("x.fp").alias("a"), F.col("y.fp").alias("b"))

    flips = [F.col("fp")] + [F.col("fp").bitwiseXOR(F.lit(_signed(1 << i))) for i in range(64 if max_bits else 0)]
    many = shared.where(F.col("n") > bucket_bound).select("fp").distinct()
    near = many.select("fp", F.explode(F.array(*flips)).alias("near"))
    if max_bits == 1:  # neighbours count only if they are fingerprints themselves
        hubs = near.where("fp = near").select("near")
    else:
        hubs = near.groupBy("near").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("near")
    crowd = near.join(hubs, "near").where("fp <> near").select(F.col("fp").alias("a"), F.col("near").alias("b"))
    return pairs.union(crowd)


def components(edges: DataFrame) -> DataFrame:
    """(node, root): each node of ``edges`` (a, b) with the smallest node of its component.

    Large star: a node's larger neighbours are linked to its smallest neighbour (or itself).
    Small star: its smaller neighbours, and it, are linked to the smallest of them. Both keep
    components and, alternated, end in stars after O(log^2 n) rounds. Minima are partial
    aggregates and every join has one row per node on one side, so a node of great degree
    is no single task's burden. Each round's edges are a staged table."""

    def ordered(e: DataFrame) -> DataFrame:
        return e.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()

    def mark(e: DataFrame) -> tuple:
        return tuple(e.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b"))).first())

    cur = staged(ordered(edges), "components-0")
    seen, rounds = mark(cur), 0
    while seen[0]:
        both = cur.union(cur.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = ordered(both.join(low, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")))
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        rounds += 1
        cur = staged(ordered(small.union(least.select("a", F.col("m").alias("b")))), f"components-{rounds}")
        now = mark(cur)
        if now == seen:
            break
        seen = now
    return cur.select(F.col("a").alias("node"), F.col("b").alias("root")).union(cur.select("b", "b").distinct())


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3,
                    max_bits: int = 2, segments: int = 7, bucket_bound: int = 128) -> DataFrame:
    """(doc_id, fp, component_id), one row per input row."""
    fps = staged(fingerprints(docs, id_col, text_col, shingle), "simhash-fps")
    reps = staged(fps.groupBy("fp").agg(F.min("doc_id").alias("first_id")), "simhash-reps")
    roots = staged(components(linked(reps.select("fp"), max_bits, segments, bucket_bound))
                   .join(reps, F.col("node") == F.col("fp")).select("fp", "root", "first_id"), "simhash-roots")
    ids = roots.groupBy("root").agg(F.min("first_id").alias("group_id"))
    grouped = roots.join(ids, "root").select(F.col("fp").alias("fp_of"), "group_id")
    of = reps.join(grouped, F.col("fp") == F.col("fp_of"), "left").select(
        F.col("fp").alias("rep"), F.coalesce("group_id", "first_id").alias("component_id"))
    return fps.join(of, F.col("fp") == F.col("rep")).select("doc_id", "fp", "component_id")


def keep_one(docs: DataFrame, groups: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """The rows of ``docs`` whose id is their group's id, one row per id; rows with a null id
    can't be named by a group and stay."""
    kept = groups.where("doc_id = component_id").select(F.col("doc_id").alias("kept_id")).distinct()
    first = docs.where(F.col(id_col).isNotNull()).join(kept, F.col(id_col) == F.col("kept_id"), "left_semi")
    return first.dropDuplicates([id_col]).unionByName(docs.where(F.col(id_col).isNull()))


def _row_key(id_col: str, text_col: str) -> list[Column]:
    """128 bits of id and text, null told apart from any value."""
    return fingerprint128(F.col(id_col).isNull(), F.col(id_col), F.col(text_col).isNull(), F.col(text_col))


def one_per_group(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3,
                  max_bits: int = 2, segments: int = 7, bucket_bound: int = 128) -> DataFrame:
    """``docs`` with one row of each near-duplicate group: the smallest id that is not null, or of a group without ids
    a null one; of several texts with that id in the group, the least by hash. Rows are told apart by id and text, so an
    id that stands in several groups is judged in each."""
    key = _row_key(id_col, text_col)
    own = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"), key[0].alias("key_1"), key[1].alias("key_2"))
    first = F.min(F.struct(F.col("doc_id").isNull().alias("nameless"), "doc_id", "key_1", "key_2")).alias("first")
    reps = staged(_with_fingerprint(own, shingle).groupBy("fp").agg(first), "simhash-firsts")
    roots = components(linked(reps.select("fp"), max_bits, segments, bucket_bound))
    of = reps.join(roots, F.col("fp") == F.col("node"), "left").select(F.coalesce("root", "fp").alias("root"), "first.*")
    key_1, key_2 = fresh(docs.columns, "key_1"), fresh(docs.columns, "key_2")
    chosen = of.groupBy("root").agg(first).select(F.col("first.key_1").alias(key_1), F.col("first.key_2").alias(key_2))
    keyed = docs.select("*", key[0].alias(key_1), key[1].alias(key_2))
    return keyed.join(staged(chosen, "simhash-chosen"), [key_1, key_2], "left_semi").dropDuplicates([key_1, key_2]).select(*docs.columns)


def op3_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, fingerprint (16 hex digits), component_id of every document."""
    got = near_duplicates(table(spark, sf_dir, "documents"))
    return got.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
