"""Run a mart: query -> conform -> dedup / anti join -> surrogate ids -> write, with a load report.

Step order matters (defaults and truncation *create* key collisions, so the
dedup comes after them): NaN -> NULL, type conform, NOT NULL defaults,
in-batch first-wins, anti join against the target, surrogate ids, write.

The arrival order is the source query's ORDER BY, captured *before* conform
(a NULL user id sorts first even though the NOT NULL default turns it into 0).
"""

from __future__ import annotations

from dataclasses import asdict, dataclass

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from martsmith.operators.conform import COERCED_COL, REJECTED_COL, conform, rejected_cells
from martsmith.operators.dedup import FINGERPRINT, first_wins
from martsmith.operators.loadplan import anti_existing
from martsmith.operators.surrogate import (
    STAMP,
    drop_stage,
    in_order,
    max_id,
    number_in_ranges,
    number_stamped,
    read_stage,
    stamped,
    write_stage,
)
from martsmith.plans.jobs import MARTS, MartSpec
from martsmith.schemas import TargetSpec
from martsmith.sources.registry import SourceRegistry


def _arrival_names(spec: TargetSpec) -> list[str]:
    return [f"__arrival_{i}" for i in range(len(spec.order))]


def with_arrival(df: DataFrame, spec: TargetSpec) -> tuple[DataFrame, list[str]]:
    names = _arrival_names(spec)
    return df.withColumns({n: F.col(f"`{o}`") for n, o in zip(names, spec.order)}), names


def mart_rows(src: SourceRegistry, name: str, on_bad_cast: str = "null", **query_options) -> DataFrame:
    """Rows a load of mart ``name`` writes into an empty target (surrogate id aside).
    ``query_options`` go to the mart's query (e.g. ``json_null="literal"`` for users)."""
    mart = MARTS[name]
    spec = mart.target
    q, arrival = with_arrival(mart.query(src, **query_options), spec)
    rows = conform(q, spec, on_bad_cast=on_bad_cast, keep=tuple(arrival))
    if spec.key:
        rows = first_wins(rows, spec.key, arrival, spec.key_collation)
    return rows.drop(*arrival)


@dataclass
class LoadReport:
    mart: str
    mode: str
    read: int = 0
    coerced_cells: int = 0
    deduped_in_batch: int = 0
    already_present: int = 0
    written: int = 0
    skipped_empty: bool = False
    replayed: bool = False  # the target already held this run; nothing was done

    def as_dict(self) -> dict:
        return asdict(self)

    def to_frame(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame([self.as_dict()])


def load_mart(
    spark: SparkSession,
    src: SourceRegistry,
    mart: MartSpec | str,
    target,
    on_bad_cast: str = "null",
    run_id: str | None = None,
    rejects: str | None = None,
    **query_options,
) -> LoadReport:
    """Load one mart into ``target`` (``ParquetTarget``/``VersionedTarget``/``JdbcTarget``) by its spec's mode.

    * ``insert_ignore``: first-wins within the batch, rows whose key is already
      in the target are skipped, existing rows are never changed;
    * ``append``: every row is added (keyless table);
    * ``full_refresh``: the target is replaced by the batch (first-wins on the
      key); an empty batch leaves the old content in place.

    With a ``run_id`` (of a target that keeps a ledger) the load counts once: a run that the
    target already holds returns its report, marked as replayed, and touches nothing. With ``rejects``, a
    folder, the cells that the conversion to the target's types changed are added there (key, column, rule, value), from the
    same evaluation of the query.
    """
    mart = MARTS[mart] if isinstance(mart, str) else mart
    return load_frame(spark, mart.query(src, **query_options), mart.target, target, on_bad_cast,
                      name=mart.name, run_id=run_id, rejects=rejects)


def _observed(observation: Observation) -> dict:
    """The metrics; none if the optimizer proved the rows empty and dropped the counting with them."""
    try:
        return observation.get
    except Py4JJavaError:
        return {}


def load_frame(
    spark: SparkSession,
    query: DataFrame,
    spec: TargetSpec,
    target,
    on_bad_cast: str = "null",
    name: str | None = None,
    run_id: str | None = None,
    rejects: str | None = None,
) -> LoadReport:
    """Load the query-level frame ``query`` into ``target`` following ``spec`` (also the
    body of each streaming micro-batch).

    A ``query`` with the columns of ``FINGERPRINT`` is one of stored rows (``distinct_fingerprinted``): an append in a declared order
    then stages nothing more."""
    name = name or spec.name
    report = LoadReport(name, spec.mode)
    if run_id is not None:
        if not hasattr(target, "find_run"):
            raise ValueError(f"{type(target).__name__} keeps no ledger of runs")
        if (held := target.find_run(spark, run_id)) is not None:
            return LoadReport(**{**held, "replayed": True})

    q, arrival = with_arrival(query, spec)
    obs_read = Observation(f"{name}_read")
    in_ranges = bool(spec.surrogate and arrival and not spec.key and spec.mode == "append" and set(FINGERPRINT) <= set(q.columns))
    tie = list(FINGERPRINT) if in_ranges else []
    conformed = conform(q, spec, on_bad_cast=on_bad_cast, keep=(*arrival, *tie), count_coerced=True, tell=rejects is not None)
    conformed = conformed.observe(
        obs_read, F.count(F.lit(1)).alias("rows"), F.coalesce(F.sum(COERCED_COL), F.lit(0)).alias("coerced")
    ).drop(COERCED_COL)

    target.create_if_missing(spark)
    indexed = bool(getattr(target, "buckets", 0)) and spec.mode == "insert_ignore"
    existing = target.read(spark) if spec.mode != "full_refresh" else None
    obs_batch = None
    temporary: list[str] = []

    def staged(df: DataFrame, what: str) -> DataFrame:
        temporary.append(write_stage(df, f"{name}-{what}"))
        return read_stage(spark, temporary[-1])

    rows = conformed
    if rejects is not None:  # stored once: the load reads the rows of it, the side table the cells
        rows = staged(rows, "conformed")
        named = spec.key or [n for n, _ in spec.columns if n != spec.surrogate][:1]
        rejected_cells(rows, named).write.mode("append").parquet(rejects)
        rows = rows.drop(REJECTED_COL)
    if spec.key:
        rows = first_wins(rows, spec.key, arrival, spec.key_collation)
        obs_batch = Observation(f"{name}_batch")
        rows = rows.observe(obs_batch, F.count(F.lit(1)).alias("rows"))
        if indexed:  # stored, as its bounds choose what is read of the index
            rows = staged(rows, "batch")
            rows = anti_existing(rows, target.keys(spark, rows), spec.key)
        elif spec.mode == "insert_ignore" and existing is not None:
            rows = anti_existing(rows, existing, spec.key, spec.key_collation)
    obs_new = None
    if not in_ranges:  # there every row that is read is new
        obs_new = Observation(f"{name}_new")
        rows = rows.observe(obs_new, F.count(F.lit(1)).alias("rows"))

    ticket = None  # of a target that shows rows only when they are published
    if not spec.surrogate and spec.mode != "full_refresh":
        # nothing reads the new rows twice: one job computes them and appends
        # (the target keys it reads are listed before the job writes)
        ticket = target.append(rows.drop(*arrival))
    elif in_ranges:  # the stored rows are read for their places in the order, and once as a whole by the job that appends
        known = getattr(target, "max_id", None)
        start = known(spark) if known else max_id(existing, spec.surrogate)
        id_type = spec.field(spec.surrogate).dataType.simpleString()
        rows = number_in_ranges(rows, q.select(*arrival, *tie), arrival, tie, spec.surrogate, start, id_type)
        ticket = target.append(rows.drop(*arrival, *tie))
    else:
        # One evaluation of the whole plan: the new rows are staged in the checkpoint
        # folder (the observations fire exactly once), stamped with their place; the
        # empty guard, the ids and the target write read the staged table. Only a
        # declared order costs a sort, and a second staged table.
        rows = staged(stamped(rows), "rows")
        if spec.mode == "full_refresh" and rows.isEmpty():
            report.skipped_empty = True
        else:
            if spec.surrogate:
                known = getattr(target, "max_id", None)
                start = 0 if spec.mode == "full_refresh" else known(spark) if known else max_id(existing, spec.surrogate)
                id_type = spec.field(spec.surrogate).dataType.simpleString()
                if arrival:
                    rows = staged(stamped(in_order(rows.drop(STAMP), arrival, total=False)), "sorted")
                rows = number_stamped(rows, spec.surrogate, start, id_type)
            rows = rows.drop(*arrival, STAMP)
            if spec.mode == "full_refresh":
                ticket = target.overwrite(rows)
            else:
                ticket = target.append(rows)

    r = _observed(obs_read)
    report.read = int(r.get("rows", 0) or 0)
    report.coerced_cells = int(r.get("coerced", 0) or 0)
    batch_rows = int(_observed(obs_batch).get("rows", 0) or 0) if obs_batch else report.read
    new_rows = int(_observed(obs_new).get("rows", 0) or 0) if obs_new else batch_rows
    report.deduped_in_batch = report.read - batch_rows
    report.already_present = batch_rows - new_rows
    report.written = 0 if report.skipped_empty else new_rows
    if ticket is not None:
        target.publish(spark, ticket, run_id, report.as_dict())
    for path in temporary:  # the target holds the rows; after a failure the tables stay for a look
        drop_stage(spark, path)
    return report


def load_all(spark: SparkSession, src: SourceRegistry, targets: dict,
             names: list[str] | None = None, on_bad_cast: str = "null") -> list[LoadReport]:
    """Run the marts one after another (each an independent job, as the source jobs are);
    ``targets`` maps mart name -> target."""
    return [load_mart(spark, src, n, targets[n], on_bad_cast) for n in (names or list(MARTS))]

