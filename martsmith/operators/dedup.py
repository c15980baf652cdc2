"""Distinct rows and deterministic first-row-wins deduplication on a unique key.

``first_wins`` is the in-batch half of a keyed insert-ignore: among rows that
share a unique key only the first in arrival order survives. The arrival
order is the source query's ORDER BY followed by *all remaining columns*, so
ties are broken the same way on every run and by every engine (the source
query leaves them open).

Plan shape: ``row_number() over (partition by key order by ...) = 1`` is
planned with a *partial* WindowGroupLimit before the shuffle, so a hot key
contributes at most one row per map task to the exchange - a key that holds a
third of the table does not end up in one reducer.

Keys with a NULL component never collide (NULLs are distinct in a UNIQUE
index). Such rows are all kept. Where the rows are a mere scan they are read beside the window, by a filter that
reaches the scan, and enter no exchange. Where the rows are computed, that would compute them twice: there each such row
gets a salt of its own that counts as part of the key (``with_salt``), so that all rows go through one window and
one anti join, spread over all tasks.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martsmith.functions.scalar import collated
from martsmith.operators.joins import broadcast_limit


def distinct_rows(df: DataFrame, collation: str | None = None) -> DataFrame:
    """``SELECT DISTINCT``: a hash aggregate on all columns with map-side combine.

    With a ``collation`` string columns compare under it (e.g. ``UTF8_LCASE``
    folds case); the output columns then carry that collation."""
    if not collation:
        return df.distinct()
    cols = [
        collated(F.col(f"`{f.name}`"), collation).alias(f.name)
        if isinstance(f.dataType, T.StringType) else F.col(f"`{f.name}`")
        for f in df.schema.fields
    ]
    return df.select(*cols).distinct()


def distinct_spellings(df: DataFrame, collation: str) -> DataFrame:
    """``SELECT DISTINCT`` under a collation with a stated choice: of the rows that it calls equal the least by their own
    bytes stays, spelled as it is (NULLs first), whatever the plan and the number of tasks."""
    own = [F.col(f"`{c}`") for c in df.columns]
    under = [collated(c, collation).alias(f"__c{i}") if isinstance(f.dataType, T.StringType) else c.alias(f"__c{i}")
             for i, (c, f) in enumerate(zip(own, df.schema.fields))]
    least = df.select(*under, F.struct(*own).alias("__row")).groupBy(*[f"__c{i}" for i in range(len(own))]).agg(F.min("__row").alias("__row"))
    return least.select(*[F.col("__row")[c].alias(c) for c in df.columns])


FINGERPRINT = ("__fp1", "__fp2")


def fingerprinted(df: DataFrame) -> DataFrame:
    """``df`` with two 64-bit hashes of each row."""
    return df.select("*", *[F.xxhash64(F.lit(seed), *[F.col(f"`{c}`") for c in df.columns]).alias(n) for seed, n in enumerate(FINGERPRINT, 1)])


def _repeated(marked: DataFrame, max_repeated_bytes: int | None):
    """(the fingerprints that several rows have, whether they are few enough to be sent to all tasks)"""
    repeated = marked.groupBy(*FINGERPRINT).agg(F.count(F.lit(1)).alias("__n")).where("__n > 1").select(*FINGERPRINT)
    bound = broadcast_limit(marked, max_repeated_bytes) // 16
    held = repeated.limit(bound + 1).toArrow()  # 16 bytes a row, within the bound of a broadcast
    return held, held.num_rows <= bound


def distinct_stored_rows(stored: DataFrame, max_repeated_bytes: int | None = None) -> DataFrame:
    """``SELECT DISTINCT`` of wide rows in two levels; ``stored`` must be a scan or a staged table (it is read twice).

    1. Only two 64-bit hashes per row are shuffled, counted before and after: fingerprints that occur once belong to rows
       without an equal.
    2. Rows of the repeated fingerprints are compared in full, by a DISTINCT of their own: rows that merely share a
       fingerprint both stay. All others pass beside it and are never shuffled.

    The repeated fingerprints are sent to all tasks, so they must be few: beyond ``max_repeated_bytes`` (the session's
    broadcast bound) most rows would meet an equal in their own task anyway, and the one-level DISTINCT with its map-side
    combine is taken."""
    marked = fingerprinted(stored)
    held, fits = _repeated(marked, max_repeated_bytes)
    if not fits:
        return stored.distinct()
    few = F.broadcast(stored.sparkSession.createDataFrame(held))
    again = marked.join(few, list(FINGERPRINT), "left_semi").select(*[F.col(f"`{c}`") for c in stored.columns]).distinct()
    return marked.join(few, list(FINGERPRINT), "left_anti").select(*[F.col(f"`{c}`") for c in stored.columns]).unionByName(again)


def distinct_fingerprinted(stored: DataFrame, store: Callable[[DataFrame], DataFrame], max_repeated_bytes: int | None = None) -> DataFrame:
    """``distinct_stored_rows`` of a stored table of ``fingerprinted`` rows, as a frame of stored rows with their hashes: the equal
    rows that are left of the repeated fingerprints are stored by ``store``. Whoever reads a few columns of the result, or reads it
    twice, compares and shuffles nothing; without repeated fingerprints it is ``stored`` itself."""
    held, fits = _repeated(stored, max_repeated_bytes)
    if not held.num_rows:
        return stored
    if not fits:
        return store(stored.distinct())
    few = F.broadcast(stored.sparkSession.createDataFrame(held))
    names = [F.col(f"`{c}`") for c in stored.columns]
    again = store(stored.join(few, list(FINGERPRINT), "left_semi").select(*names).distinct())
    return stored.join(few, list(FINGERPRINT), "left_anti").select(*names).unionByName(again)


def key_columns(df: DataFrame, key: Sequence[str], collation: str | None = None) -> list[Column]:
    types = {f.name: f.dataType for f in df.schema.fields}
    out = []
    for k in key:
        c = F.col(f"`{k}`")
        if collation and isinstance(types[k], T.StringType):
            c = collated(c, collation)
        out.append(c)
    return out


SALT = "__salt"


def is_scan(df: DataFrame) -> bool:
    """Whether ``df`` reads one stored table, with filters and projections at most."""
    plan = df._jdf.queryExecution().optimizedPlan()
    while plan.nodeName() in ("Project", "Filter"):
        plan = plan.children().head()
    return plan.nodeName() == "LogicalRelation"


def with_salt(df: DataFrame, key: Sequence[str]) -> DataFrame:
    """``df`` with a salt that makes a key with a NULL part unlike any other: 0 where the key is
    complete, the row's place elsewhere. Without a nullable key column, or with a salt already, ``df`` itself."""
    if SALT in df.columns or not any(df.schema[k].nullable for k in key):
        return df
    complete = F.lit(True)
    for k in key:
        complete = complete & F.col(f"`{k}`").isNotNull()
    return df.withColumn(SALT, F.when(complete, F.lit(0).cast("long")).otherwise(F.monotonically_increasing_id() + 1))


def arrival_order(df: DataFrame, order: Sequence[str | Column], exclude: Sequence[str] = ()) -> list[Column]:
    """The total arrival order: the given order columns, then every other column, ascending
    with NULLs first (the server's and Spark's default)."""
    cols: list[Column] = []
    named = set()
    for o in order:
        if isinstance(o, str):
            named.add(o)
            cols.append(F.col(f"`{o}`").asc_nulls_first())
        else:
            cols.append(o)
    for f in df.schema.fields:
        if f.name in named or f.name in exclude:
            continue
        cols.append(F.col(f"`{f.name}`").asc_nulls_first())
    return cols


def first_wins(
    df: DataFrame,
    key: Sequence[str],
    order: Sequence[str | Column] = (),
    collation: str | None = None,
    tiebreak_exclude: Sequence[str] = (),
) -> DataFrame:
    """Keep the first row per ``key`` in arrival order; rows with a NULL key part all stay.

    ``order`` is the source query's ORDER BY (column names are sorted ascending,
    NULLs first); the remaining columns break ties."""
    if not key:
        raise ValueError("first_wins needs a key")
    if SALT not in df.columns and any(df.schema[k].nullable for k in key) and is_scan(df):
        complete = " AND ".join(f"`{k}` IS NOT NULL" for k in key)
        whole = df.where(complete)
        w = Window.partitionBy(*key_columns(df, key, collation)).orderBy(*arrival_order(df, order, exclude=tiebreak_exclude))
        first = whole.withColumn("__rn", F.row_number().over(w)).filter(F.col("__rn") == 1).drop("__rn")
        return first.unionByName(df.where(f"NOT ({complete})"))
    salted = with_salt(df, key)
    salt = [F.col(SALT)] if SALT in salted.columns else []
    w = Window.partitionBy(*key_columns(df, key, collation), *salt).orderBy(
        *arrival_order(df, order, exclude=(*tiebreak_exclude, SALT))
    )
    first = salted.withColumn("__rn", F.row_number().over(w)).filter(F.col("__rn") == 1)
    return first.select(*[f"`{c}`" for c in df.columns])
