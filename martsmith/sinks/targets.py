"""Where a mart is loaded: a parquet folder on shared storage or a JDBC table.

A target knows its ``TargetSpec``; it can be created empty with the declared
schema (``CREATE TABLE IF NOT EXISTS``), read, appended to and overwritten.
Writes are plain Spark writes (per-task output, job-level commit). A parquet refresh
writes the new content beside the old one and then switches by two renames, so a
failed write leaves the old content (``VersionedTarget`` has no moment between). JDBC writes go through a
staging table and one transaction, ``batchsize`` rows per round trip. Whether a JDBC table exists is asked of the
server's catalog: any other trouble is an error, never "no table".

``append`` and ``overwrite`` of a ``ParquetTarget`` take effect at once; those of the others return a ticket, and ``publish``
makes the load visible together with the entry of its run.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence
from contextlib import contextmanager
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martsmith.operators.surrogate import drop_stage, read_stage, write_stage
from martsmith.schemas import VARCHAR_META, TargetSpec
from martsmith.sources.registry import JdbcTable


def _ordered(df: DataFrame, spec: TargetSpec) -> DataFrame:
    """Bind by name: target columns in table order (surrogate included when present)."""
    cols = [f.name for f in spec.schema.fields if f.name in df.columns]
    return df.select(*[f"`{n}`" for n in cols])


@dataclass
class ParquetTarget:
    spec: TargetSpec
    path: str

    def _fs(self, spark: SparkSession):
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
        return path, path(self.path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def exists(self, spark: SparkSession) -> bool:
        """A metadata call on the target's file system (no Spark job). A refresh that died
        between its two renames is put right: the old content gets its name back."""
        path, fs = self._fs(spark)
        if fs.exists(path(self.path)):
            return True
        kept = [s.getPath() for s in fs.globStatus(path(f"{self.path.rstrip('/')}.old-*")) or []]
        return bool(kept) and bool(fs.rename(kept[0], path(self.path)))

    def create_if_missing(self, spark: SparkSession) -> None:
        if not self.exists(spark):
            spark.createDataFrame([], self.spec.schema).write.mode("ignore").parquet(self.path)

    def read(self, spark: SparkSession) -> DataFrame | None:
        if not self.exists(spark):
            return None
        return spark.read.schema(self.spec.schema).parquet(self.path)

    def append(self, df: DataFrame) -> None:
        _ordered(df, self.spec).write.mode("append").parquet(self.path)

    def overwrite(self, df: DataFrame) -> None:
        spark, run = df.sparkSession, uuid.uuid4().hex[:12]
        base = self.path.rstrip("/")
        new, old = f"{base}.new-{run}", f"{base}.old-{run}"
        _ordered(df, self.spec).write.parquet(new)
        path, fs = self._fs(spark)
        had = self.exists(spark)
        if had and not fs.rename(path(base), path(old)):
            raise OSError(f"{base} could not be set aside; the new content is in {new}")
        if not fs.rename(path(new), path(base)):
            raise OSError(f"{new} could not take the place of {base}; the old content is in {old}")
        if had:
            fs.delete(path(old), True)


@dataclass(frozen=True)
class StagedLoad:
    """Rows in a staging table of the server, not yet in the target."""

    table: str
    columns: tuple[str, ...]
    replace: bool


@dataclass
class JdbcTarget:
    """A table behind a JDBC URL.

    A load goes into a staging table of its own first (any number of tasks, any number of attempts) and from there, in one
    transaction of the server, into the target: the run's entry in the ledger table, the rows, and for a refresh the deletion of
    the old ones. Readers see the table before or after a load. Staged rows carry their place in a stored table and a random
    mark of the attempt that wrote them, so a partition that was committed and then retried counts once, whatever the keys."""

    spec: TargetSpec
    url: str
    dbtable: str
    properties: dict = field(default_factory=dict)
    batchsize: int = 500
    num_partitions: int | None = None

    def _opts(self) -> dict:
        opts = {"url": self.url, "dbtable": self.dbtable, "batchsize": str(self.batchsize)}
        if self.num_partitions:
            opts["numPartitions"] = str(self.num_partitions)
        opts.update(self.properties)
        return opts

    def _connection(self, spark: SparkSession):
        """A connection of the driver process; errors propagate."""
        jvm = spark.sparkContext._jvm
        settings = jvm.java.util.Properties()
        for k, v in self.properties.items():
            settings.setProperty(k, str(v))
        if driver := self.properties.get("driver"):
            jvm.org.apache.spark.sql.execution.datasources.jdbc.DriverRegistry.register(driver)
        return jvm.java.sql.DriverManager.getConnection(self.url, settings)

    @contextmanager
    def _connected(self, spark: SparkSession):
        connection = self._connection(spark)
        try:
            yield connection
        finally:
            connection.close()

    def _owner_and_name(self, table: str) -> tuple[str, str]:
        owner, _, name = table.replace("`", "").replace('"', "").rpartition(".")
        return owner, name

    def _found(self, connection, table: str) -> tuple | None:
        """(catalog, schema, name) as the server spells them, if it has the table."""
        schema, name = self._owner_and_name(table)
        meta = connection.getMetaData()
        for fold in (str, str.upper, str.lower):  # servers fold unquoted names differently
            # some servers call a database a catalog, others a schema
            for catalog, owner in ((None, fold(schema) or None), (schema or None, None)):
                found = meta.getTables(catalog, owner, fold(name), None)
                if found.next():
                    return found.getString(1), found.getString(2), found.getString(3)
        return None

    def exists(self, spark: SparkSession) -> bool:
        with self._connected(spark) as connection:
            return self._found(connection, self.dbtable) is not None

    def create_if_missing(self, spark: SparkSession) -> None:
        """The table, and its unique key: a key that an earlier attempt didn't get to is added."""
        if not self.exists(spark):
            empty = spark.createDataFrame([], self.spec.schema)
            options = {k: v for k, v in {"createTableColumnTypes": column_types(self.spec)}.items() if v}
            empty.write.format("jdbc").options(**self._opts(), **options).mode("ignore").save()
        if self.spec.key:
            with self._connected(spark) as connection:
                if not self._has_key(connection):
                    connection.createStatement().execute(unique_key_ddl(self.spec, self.dbtable, connection.getMetaData().getIdentifierQuoteString()))

    def _has_key(self, connection) -> bool:
        """Whether an index of the server's has the spec's key. Not every server lists a unique key with nullable columns as a
        unique index, so any index of exactly these columns counts."""
        index, of = connection.getMetaData().getIndexInfo(*self._found(connection, self.dbtable), False, False), {}
        while index.next():
            if index.getString("COLUMN_NAME"):
                of.setdefault(index.getString("INDEX_NAME"), set()).add(index.getString("COLUMN_NAME").lower())
        return {k.lower() for k in self.spec.key} in of.values()

    def slice_column(self) -> str | None:
        """The column by which the table is read in slices: the surrogate id, or a key's first column if it is a whole number."""
        if self.spec.surrogate:
            return self.spec.surrogate
        if self.spec.key and isinstance(self.spec.field(self.spec.key[0]).dataType, T.IntegralType):
            return self.spec.key[0]
        return None

    def read(self, spark: SparkSession) -> DataFrame | None:
        """The table, in ``num_partitions`` slices between the bounds that one query on the server finds."""
        if not self.exists(spark):
            return None
        column = self.slice_column() if self.num_partitions else None
        return JdbcTable(self.url, self.dbtable, dict(self.properties), column, num_partitions=self.num_partitions).read(spark)

    # -- loads

    def append(self, df: DataFrame) -> StagedLoad:
        return self._stage(df, replace=False)

    def overwrite(self, df: DataFrame) -> StagedLoad:
        return self._stage(df, replace=True)

    def _stage(self, df: DataFrame, replace: bool) -> StagedLoad:
        rows = _ordered(df, self.spec)
        name = f"{self.dbtable}_load_{uuid.uuid4().hex[:12]}"
        # a stored table: a retried task writes the same rows with the same places again
        path = write_stage(rows.withColumn(PLACE, F.monotonically_increasing_id()), f"{self.spec.name}-jdbc")
        attempt = F.reflect(F.lit("java.util.UUID"), F.lit("randomUUID"))
        types = ", ".join(x for x in (column_types(self.spec, rows.columns), f"`{ATTEMPT}` VARCHAR(36)") if x)
        read_stage(df.sparkSession, path).withColumn(ATTEMPT, attempt).write.format("jdbc").options(
            **{**self._opts(), "dbtable": name}).option("createTableColumnTypes", types).mode("errorifexists").save()
        drop_stage(df.sparkSession, path)
        return StagedLoad(name, tuple(rows.columns), replace)

    def find_run(self, spark: SparkSession, run_id: str) -> dict | None:
        """The report of a run that the table holds."""
        with self._connected(spark) as connection:
            if self._found(connection, self._ledger()) is None:
                return None
            query = connection.prepareStatement(f"SELECT REPORT FROM {self._ledger()} WHERE TARGET_NAME = ? AND RUN_ID = ?")
            query.setString(1, self._owner_and_name(self.dbtable)[1].lower())
            query.setString(2, run_id)
            found = query.executeQuery()
            return json.loads(found.getString(1)) if found.next() else None

    def _ledger(self) -> str:
        return f"{self.dbtable.rpartition('.')[0]}.{LEDGER}".lstrip(".")

    def publish(self, spark: SparkSession, staged: StagedLoad, run_id: str | None, report: dict) -> None:
        """Move staged rows into the target, with the run's entry, in one transaction."""
        with self._connected(spark) as connection:
            quote = connection.getMetaData().getIdentifierQuoteString()
            if run_id is not None and self._found(connection, self._ledger()) is None:
                connection.createStatement().execute(ledger_ddl(self._ledger()))
            place = f"{quote}{PLACE}{quote}"
            connection.createStatement().execute(f"CREATE INDEX ix_{staged.table.rpartition('_')[2]} ON {staged.table} ({place})")
            connection.setAutoCommit(False)
            try:
                if run_id is not None:  # first: a second load of the run waits here, or fails
                    entry = connection.prepareStatement(f"INSERT INTO {self._ledger()} (TARGET_NAME, RUN_ID, REPORT) VALUES (?, ?, ?)")
                    for n, value in enumerate((self._owner_and_name(self.dbtable)[1].lower(), run_id, json.dumps(report)), 1):
                        entry.setString(n, value)
                    entry.executeUpdate()
                if staged.replace:
                    connection.createStatement().executeUpdate(f"DELETE FROM {self.dbtable}")
                connection.createStatement().executeUpdate(
                    merge_sql(self.spec, self.dbtable, staged.table, staged.columns, quote, self.url.split(":")[1]))
                connection.commit()
            except BaseException:
                connection.rollback()
                raise
            connection.setAutoCommit(True)
            connection.createStatement().execute(f"DROP TABLE {staged.table}")


LEDGER, PLACE, ATTEMPT = "martsmith_runs", "load_place", "load_attempt"


def ledger_ddl(table: str) -> str:
    return (f"CREATE TABLE {table} (TARGET_NAME VARCHAR(120) NOT NULL, RUN_ID VARCHAR(120) NOT NULL, REPORT VARCHAR(2000) NOT NULL, "
            "PRIMARY KEY (TARGET_NAME, RUN_ID))")


def merge_sql(spec: TargetSpec, table: str, staging: str, columns: Sequence[str], quote: str = "`", dialect: str = "") -> str:
    """The statement that moves staged rows into the target: of a place that several attempts wrote one row, and of keyed
    insert-ignore loads only keys that the target lacks. NULL key parts equal nothing, here as in a unique key. Where the server
    has a form that ignores duplicates (``dialect``: the URL's second part), it is used too: it takes the key's lock."""
    def names(alias: str, cols: Sequence[str]) -> str:
        return ", ".join(f"{alias}{quote}{c}{quote}" for c in cols)

    def same(c: str, other: str) -> str:
        return f"{other}.{quote}{c}{quote} = s.{quote}{c}{quote}"

    once = (f"NOT EXISTS (SELECT 1 FROM {staging} d WHERE {same(PLACE, 'd')} "
            f"AND d.{quote}{ATTEMPT}{quote} < s.{quote}{ATTEMPT}{quote})")
    wheres, verb, tail = [once], "INSERT INTO", ""
    if spec.key and spec.mode == "insert_ignore":
        wheres.append(f"NOT EXISTS (SELECT 1 FROM {table} t WHERE {' AND '.join(same(k, 't') for k in spec.key)})")
        verb = {"mysql": "INSERT IGNORE INTO", "mariadb": "INSERT IGNORE INTO"}.get(dialect, verb)
        tail = {"postgresql": " ON CONFLICT DO NOTHING"}.get(dialect, tail)
    return f"{verb} {table} ({names('', columns)}) SELECT {names('s.', columns)} FROM {staging} s WHERE {' AND '.join(wheres)}{tail}"


def column_types(spec: TargetSpec, columns: Sequence[str] | None = None) -> str:
    """``createTableColumnTypes``: the declared VARCHAR lengths (other types follow from the schema)."""
    return ", ".join(f"`{f.name}` VARCHAR({f.metadata[VARCHAR_META]})" for f in spec.schema.fields
                     if isinstance(f.dataType, T.StringType) and f.metadata.get(VARCHAR_META) and (columns is None or f.name in columns))


def unique_key_ddl(spec: TargetSpec, dbtable: str, quote: str = "`") -> str:
    """The statement that gives a created table its unique key."""
    name = f"uk_{spec.name}_{'_'.join(spec.key)}"[:60]
    return f"ALTER TABLE {dbtable} ADD CONSTRAINT {name} UNIQUE ({', '.join(f'{quote}{k}{quote}' for k in spec.key)})"
