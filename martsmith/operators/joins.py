"""Join shapes of the marts: star lookup, bridge lookup, orphan-preserving fact join,
joins on keys of different types, and NULL-key spreading for outer joins.

All joins are single-column equi joins. Broadcasting is decided per call from
the optimizer's size estimate against a bound; above it the join is left to
the planner (sort-merge, re-planned by AQE from runtime sizes).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The estimate comes from file sizes (compressed) and column widths, so it can
# be several times below the in-memory size; keep the bound well under the
# executor memory a broadcast may take. Per session: ``martsmith.broadcastMaxBytes``.
DEFAULT_BROADCAST_BYTES = 32 * 1024 * 1024
BROADCAST_CONF = "martsmith.broadcastMaxBytes"


def broadcast_limit(df: DataFrame, max_bytes: int | None = None) -> int:
    """The broadcast bound in force: the explicit argument, else the session setting."""
    if max_bytes is not None:
        return max_bytes
    return int(df.sparkSession.conf.get(BROADCAST_CONF, str(DEFAULT_BROADCAST_BYTES)))


def estimated_size_bytes(df: DataFrame) -> int:
    """Catalyst's size estimate of ``df`` (file sizes and projections; may over-estimate)."""
    try:
        size = df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()
        return int(size if isinstance(size, int) else size.toString())
    except Exception:  # pragma: no cover - estimate not available: treat as large
        return 1 << 62


def checked_broadcast(df: DataFrame, max_bytes: int | None = None) -> DataFrame:
    """Broadcast hint only when the estimated size is under the bound."""
    return F.broadcast(df) if estimated_size_bytes(df) <= broadcast_limit(df, max_bytes) else df


def typed_key(key: Column, as_type: str = "bigint") -> Column:
    """Key rendered as an integer for a join (``int = string``), as the server compares the two: by
    numeric value, so ``'12.0'`` and ``'1e1'`` are 12 and 10. Text with a fraction or without a
    number becomes NULL and matches nothing instead of failing the job (the server would
    take the numeric prefix of ``'12abc'``; here that text matches nothing)."""
    number, text = key.try_cast("decimal(38,10)"), key.cast("string")
    # the decimal rounds what lies beyond ten places: digits after the point, or a small power of ten, tell of it
    beyond = text.rlike(r"^[^eE]*\.[0-9]*[1-9][0-9]*\s*$") | (key.try_cast("double") != F.floor(key.try_cast("double")))
    return F.when((number == F.floor(number)) & ~beyond, number).try_cast(as_type)


def skew_safe_left_join(preserved: DataFrame, other: DataFrame, preserved_key: str, other_key: str,
                        strategy: str = "auto", max_broadcast_bytes: int | None = None,
                        other_keys: DataFrame | None = None, preserved_keys: DataFrame | None = None) -> DataFrame:
    """``preserved`` LEFT JOIN ``other`` ON preserved_key = other_key, planned so that no
    key - and not NULL either - can put a third of the rows into one task.

    ``strategy``:

    * ``"broadcast"``: broadcast hash join of ``other``, no shuffle at all;
    * ``"split"``: one INNER JOIN that loses no row, as AQE may split a hot key of an inner join on *both*
      sides (a left outer join only allows splitting the preserved side, so a
      key with a huge fan-out on ``other`` would stay in one task):
      - the *distinct* keys of ``preserved`` that ``other`` lacks (partial aggregates: a hot key is one row, and
        only key columns are read) are added to ``other``, as rows of NULLs;
      - rows with a NULL key, which can never match, are extended with NULLs beside the join and enter no exchange;
    * ``"auto"``: broadcast if the checked estimate of ``other`` is within the bound, else split.

    With an explicit ``"split"`` the joins are sort-merge joins whatever the sizes (the plan of large tables, on any table);
    under ``"auto"`` AQE may still broadcast a side that turns out small.

    AQE gives a split up if something above relies on the join's partitioning, as a later
    DISTINCT or window on the same key would. The join therefore returns its
    key as the greater of the two equal keys: a value, not the partitioning
    column, so what follows deals the rows out anew and hot keys stay split.

    Column names of the two sides must be distinct; keys are column names.
    ``other_keys`` and ``preserved_keys`` (one column each) may give a side's key set from a cheaper
    source when that side is itself a join that preserves its key side."""
    if strategy not in ("auto", "broadcast", "split"):
        raise ValueError("strategy must be 'auto', 'broadcast' or 'split'")
    pk = F.col(f"`{preserved_key}`")
    ok = F.col(f"`{other_key}`")
    kept = (lambda df: df.hint("merge")) if strategy == "split" else (lambda df: df)
    if strategy == "auto":
        fits = estimated_size_bytes(other) <= broadcast_limit(other, max_broadcast_bytes)
        strategy = "broadcast" if fits else "split"
    if strategy == "broadcast":
        return preserved.join(F.broadcast(other), pk == ok, "left")
    def distinct_keys(given: DataFrame | None, side: DataFrame, key: Column, name: str) -> DataFrame:
        keys = side.select(key) if given is None else given
        return keys.toDF(name).where(F.col(name).isNotNull()).distinct()

    fill = [F.lit(None).cast(f.dataType).alias(f.name) for f in other.schema.fields]
    lacking = distinct_keys(preserved_keys, preserved, pk, "__joined").join(
        kept(distinct_keys(other_keys, other, ok, "__other_key")), F.col("__joined") == F.col("__other_key"), "left_anti")
    whole = other.where(ok.isNotNull()).select(*[F.col(f"`{n}`") for n in other.columns], ok.alias("__joined")).unionByName(
        lacking.select(*fill, "__joined"))
    key = F.greatest(pk, F.col("__joined")).cast(preserved.schema[preserved_key].dataType).alias(preserved_key)
    joined = preserved.where(pk.isNotNull()).join(kept(whole), pk == F.col("__joined"), "inner").select(
        *[key if n == preserved_key else F.col(f"`{n}`") for n in preserved.columns], *[F.col(f"`{n}`") for n in other.columns])
    return joined.unionByName(preserved.where(pk.isNull()).select("*", *fill))
