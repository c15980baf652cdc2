"""Pure planning half of the three load modes: (existing, incoming) -> rows to write.

These functions never write; they return DataFrames, so each load mode can be
checked against a SQL oracle and composed with the surrogate id step. The
write half lives in ``martsmith.sinks``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martsmith.operators.dedup import SALT, first_wins, key_columns, with_salt


def anti_existing(batch: DataFrame, existing: DataFrame, key: Sequence[str],
                  collation: str | None = None) -> DataFrame:
    """Drop ``batch`` rows whose complete key is already in ``existing``; rows with a NULL
    key part never match, and their salts spread them over the join's tasks."""
    salted = with_salt(batch, key)
    names = [f"__tk{i}" for i in range(len(key))]
    keys = existing.select(
        *[c.alias(n) for c, n in zip(key_columns(existing, key, collation), names)]
    ).where(" AND ".join(f"{n} IS NOT NULL" for n in names))
    pairs = list(zip(key_columns(salted, key, collation), names))
    if SALT in salted.columns:
        keys = keys.withColumn("__tsalt", F.lit(0).cast("long"))
        pairs.append((F.col(SALT), "__tsalt"))
    cond = None
    for bc, n in pairs:
        eq = bc == F.col(n)
        cond = eq if cond is None else cond & eq
    return salted.join(keys, cond, "left_anti").select(*[f"`{c}`" for c in batch.columns])


def plan_insert_ignore(
    existing: DataFrame | None,
    incoming: DataFrame,
    key: Sequence[str],
    order: Sequence[str | Column] = (),
    collation: str | None = None,
    tiebreak_exclude: Sequence[str] = (),
) -> DataFrame:
    """Rows of ``incoming`` that a keyed INSERT IGNORE would add to ``existing``.

    1. in-batch first-wins on ``key`` (arrival ``order``, then all columns);
    2. ``left_anti`` against the keys already in the target - an existing row is
       never updated;
    3. rows with a NULL key part pass both steps (they never collide).
    """
    salted = with_salt(incoming, key)
    batch = first_wins(salted, key, order, collation, tiebreak_exclude)
    if existing is not None:
        batch = anti_existing(batch, existing, key, collation)
    return batch.select(*[f"`{c}`" for c in incoming.columns])


def guarded_refresh_content(existing: DataFrame, incoming: DataFrame) -> DataFrame:
    """Table content after a guarded refresh, as one lazy plan: ``incoming`` if it
    has at least one row, else ``existing`` unchanged.

    The guard is an uncorrelated ``NOT EXISTS`` on ``incoming``: Spark plans it
    as a one-row scalar subquery (``CollectLimit 1``) evaluated once, no join."""
    return incoming.unionByName(existing.where(~incoming.exists()))


def insert_ignore_report(existing: DataFrame | None, incoming: DataFrame, key: Sequence[str],
                         order: Sequence[str | Column] = (), collation: str | None = None) -> DataFrame:
    """MET-1 as a lazy one-row frame: ``read``, ``deduped_in_batch``, ``already_present``,
    ``written`` of an insert-ignore of ``incoming`` into ``existing``.

    Counted per key group (a partial aggregate, so a hot key costs one row per
    map task), then one join of the groups against the distinct target keys.
    ``order`` does not change counts; it is accepted to mirror the load call."""
    salted = with_salt(incoming, key)
    salt = [F.col(SALT)] if SALT in salted.columns else []  # a row with a NULL key part is a group of its own
    names = [f"__k{i}" for i in range(len(key))]
    groups = salted.groupBy(
        *[kc.alias(n) for kc, n in zip(key_columns(incoming, key, collation), names)], *salt
    ).agg(F.count(F.lit(1)).alias("__n"))
    present = F.lit(False)
    if existing is not None:
        tnames = [f"__tk{i}" for i in range(len(key))]
        tkeys = existing.select(
            *[kc.alias(n) for kc, n in zip(key_columns(existing, key, collation), tnames)]
        ).where(" AND ".join(f"{n} IS NOT NULL" for n in tnames)).distinct().withColumn("__present", F.lit(True))
        cond = None
        for n, tn in zip(names, tnames):
            eq = F.col(n) == F.col(tn)
            cond = eq if cond is None else cond & eq
        if salt:
            cond = cond & (F.col(SALT) == F.lit(0))
        groups = groups.join(tkeys, cond, "left")
        present = F.coalesce(F.col("__present"), F.lit(False))
    return groups.select("__n", present.alias("__present")).agg(
        F.coalesce(F.sum("__n"), F.lit(0)).cast("long").alias("read"),
        F.coalesce(F.sum(F.col("__n") - 1), F.lit(0)).cast("long").alias("deduped_in_batch"),
        F.count_if("__present").alias("already_present"),
        F.count_if(~F.col("__present")).alias("written"),
    )
