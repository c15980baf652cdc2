"""Dense surrogate ids (AUTO_INCREMENT) without a single-partition step.

1. With a declared order the rows are range-partitioned and sorted by it (ties by a hash of
   the whole row, so a hot value of the order columns is spread over ranges too; or by all columns, where
   the ids have to equal a global ``row_number()``). Without one nothing is sorted.
2. Every row is stamped with ``monotonically_increasing_id`` = (partition index << 33) + position and the
   result is written as a staging table under the shared checkpoint folder. The stamp is stored data: a
   lost executor or a second read cannot deal the rows out differently.
3. Per-partition row counts (one row per partition, read back from the staging table) give
   each partition's offset through a running sum.
4. id = start + offset(partition) + position + 1, by a join with the offsets: broadcast while they are few.

Rows that are stored already, each with hashes of its own, need no second staged table (``number_in_ranges``): their order
columns and hashes are read first, to find ranges of equal depth and to count what each holds, so that the range sort's
partitions know their offsets before they are written to the target.

The result is unique, dense and above ``start``. The largest id is checked against the id's type
before anything is written to a target.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from martsmith.operators.dedup import arrival_order
from martsmith.operators.joins import estimated_size_bytes
from martsmith.session import conf_bytes, scratch_path

_POS_BITS = 33
# One row per partition in the offsets table; at ~16 bytes a row this bound
# keeps the broadcast under 16 MB. Above it the join is planned as a shuffle.
MAX_BROADCAST_PARTITIONS = 1_000_000
ID_MAX = {"tinyint": 2**7 - 1, "smallint": 2**15 - 1, "int": 2**31 - 1, "bigint": 2**63 - 1}
STAMP = "__mid"


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as a parquet table under the checkpoint folder and read it back
    (cuts the lineage; the write is a SQL action, so observed metrics fire)."""
    return read_stage(df.sparkSession, write_stage(df, name))


def write_stage(df: DataFrame, name: str) -> str:
    path = scratch_path(df.sparkSession, f"{name}-{uuid.uuid4().hex[:12]}")
    df.write.mode("overwrite").parquet(path)
    return path


def read_stage(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def drop_stage(spark: SparkSession, path: str) -> None:
    """Remove a staged table that nothing reads any more."""
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


def stamped(df: DataFrame) -> DataFrame:
    """``df`` with each row's partition and position, to be staged before use."""
    return df.withColumn(STAMP, F.monotonically_increasing_id())


def number_stamped(staged: DataFrame, id_col: str = "id", start_after: int = 0, id_type: str = "int") -> DataFrame:
    """``staged`` (a stored table with the stamp) with ``id_col`` = ``start_after`` + 1, 2, ... put first."""
    numbered = staged.withColumn("__part", F.shiftright(F.col(STAMP), _POS_BITS))
    # one count per partition of the staged write: the running sum is done on the driver
    counts = sorted(
        (int(r["__part"]), int(r["__n"]))
        for r in numbered.groupBy("__part").agg(F.count(F.lit(1)).alias("__n")).collect()
    )
    running, rows = 0, []
    for part, n in counts:
        rows.append((part, running))
        running += n
    if start_after + running > ID_MAX.get(id_type, 2**63 - 1):
        raise ValueError(f"ids up to {start_after + running} do not fit {id_type}")
    offsets = staged.sparkSession.createDataFrame(rows, "__part long, __off long")
    if len(rows) <= MAX_BROADCAST_PARTITIONS:
        offsets = F.broadcast(offsets)
    pos = F.col(STAMP).bitwiseAND(F.lit((1 << _POS_BITS) - 1))
    new_id = (F.lit(int(start_after)) + F.col("__off") + pos + F.lit(1)).cast(id_type)
    out = numbered.join(offsets, "__part").withColumn(id_col, new_id)
    return out.select(id_col, *[f"`{c}`" for c in staged.columns if c != STAMP])


def in_order(df: DataFrame, order: Sequence[str | Column], total: bool = True, tiebreak_exclude: Sequence[str] = ()) -> DataFrame:
    """``df`` sorted by ``order`` (ascending, NULLs first), ties by all other columns (``total``) or by a
    hash of the row."""
    if total:
        return df.orderBy(*arrival_order(df, order, exclude=tiebreak_exclude))
    keys = [F.col(f"`{o}`").asc_nulls_first() if isinstance(o, str) else o for o in order]
    return df.orderBy(*keys, F.xxhash64(*[F.col(f"`{c}`") for c in df.columns]))


# A range of rows is shuffled in about this many times the bytes that it takes in a stored table. Ranges are found from
# so many rows each; there are at most as many of them as ``task_session`` has shuffle partitions.
SHUFFLED_GROWTH, SAMPLED_PER_RANGE, MAX_RANGES = 4, 30, 20_000


def _range_count(rows: DataFrame) -> int:
    """Ranges of the advised partition's size, or of 1 MB while those are fewer than the cores (as AQE merges partitions)."""
    shuffled = SHUFFLED_GROWTH * estimated_size_bytes(rows)
    least = min(rows.sparkSession.sparkContext.defaultParallelism, -(-shuffled // 2**20))
    advised = conf_bytes(rows.sparkSession, "spark.sql.adaptive.advisoryPartitionSizeInBytes")
    return min(MAX_RANGES, max(1, least, -(-shuffled // advised)))


def _range_of(places: DataFrame, wanted: int) -> tuple[Column, int]:
    """(the number of the range that a row's place falls into, how many ranges there are): a binary search, by the
    types' own order with NULLs first, in boundaries of about equal depth that a sample of ``places`` gives."""
    total = places.count() if wanted > 1 else 0
    if not total:
        return F.lit(0), 1
    held = places.sample(min(1.0, SAMPLED_PER_RANGE * wanted / total), 1).collect()
    held.sort(key=lambda place: [(v is not None, v) for v in place])
    picked = list(dict.fromkeys(tuple(held[k * len(held) // wanted]) for k in range(1, wanted))) if held else []
    if not picked:
        return F.lit(0), 1
    bounds = F.sort_array(F.array(*[F.struct(*[F.lit(v).cast(f.dataType).alias(f.name) for v, f in zip(b, places.schema.fields)]) for b in picked]))
    steps = F.array(*[F.lit(1 << k) for k in reversed(range(len(picked).bit_length()))])

    def search(place: Column) -> Column:
        return F.aggregate(steps, F.lit(0), lambda found, step: F.when(F.get(bounds, found + step - 1) <= place, found + step).otherwise(found))

    return F.get(F.transform(F.array(F.struct(*[F.col(f"`{c}`") for c in places.columns])), search), F.lit(0)), len(picked) + 1


def number_in_ranges(
    rows: DataFrame,
    places: DataFrame,
    order: Sequence[str],
    tie: Sequence[str],
    id_col: str = "id",
    start_after: int = 0,
    id_type: str = "int",
) -> DataFrame:
    """``rows`` with ``id_col`` = ``start_after`` + 1, 2, ... in the order of ``order`` (ascending, NULLs first), ties by ``tie``.

    ``rows`` must read stored tables alone, and have in each evaluation the same rows; ``places`` has their ``order`` and ``tie`` columns
    (hashes of a row, so that a hot value spreads) and is cheap to read. ``rows`` itself is evaluated once, by whoever writes the result,
    and passes one exchange. Each range is one partition, which numbers its sorted rows from the count of those before it; a partition
    that isn't the range's own is an error."""
    names = [*order, *tie]
    places = places.select(*[f"`{c}`" for c in names])
    which, ranges = _range_of(places, _range_count(rows))
    counts = {r["__range"]: r["__n"] for r in places.select(which.alias("__range")).groupBy("__range").agg(F.count(F.lit(1)).alias("__n")).collect()}
    running, offsets = start_after, []
    for k in range(ranges):
        offsets.append(running)
        running += counts.get(k, 0)
    if running > ID_MAX.get(id_type, 2**63 - 1):
        raise ValueError(f"ids up to {running} do not fit {id_type}")
    dealt = rows.withColumn("__range", which).repartitionById(ranges, F.col("__range"))
    placed = dealt.sortWithinPartitions(*[F.col(f"`{c}`").asc_nulls_first() for c in names])
    pos = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << _POS_BITS) - 1))
    offset = F.get(F.array(*[F.lit(n).cast("long") for n in offsets]), F.col("__range"))
    own = F.spark_partition_id() == F.col("__range")
    new_id = F.when(own, offset + pos + F.lit(1)).otherwise(F.raise_error(F.lit("a range of ordered ids is not a partition of its own")))
    return placed.select(new_id.cast(id_type).alias(id_col), *[f"`{c}`" for c in rows.columns])


def assign_surrogate_ids(
    df: DataFrame,
    order: Sequence[str | Column] = (),
    id_col: str = "id",
    start_after: int = 0,
    id_type: str = "int",
    tiebreak_exclude: Sequence[str] = (),
    total: bool = True,
) -> DataFrame:
    """Add ``id_col`` = ``start_after`` + 1, 2, ... in the order given, or in any order if none is.

    ``df`` should be a scan or a staged table if there is an order: a global sort evaluates its
    input twice (once to sample range boundaries)."""
    sorted_rows = in_order(df, order, total, tiebreak_exclude) if order else df
    return number_stamped(stage(stamped(sorted_rows), "surrogate"), id_col, start_after, id_type)


def max_id(existing: DataFrame | None, id_col: str = "id") -> int:
    """Largest id in the target (0 for a missing or empty table): a one-row aggregate."""
    if existing is None:
        return 0
    row = existing.agg(F.max(F.col(id_col)).alias("m")).first()
    return int(row["m"]) if row and row["m"] is not None else 0
