"""A parquet target of immutable versions: no moment without a table, loads that count once, and a key index.

Every load writes a folder of its own and then publishes a version: one small file that lists the folders the table
consists of, the runs that made it, and its largest id.

```
<path>/data/<load>/part-*.parquet      rows of one load, never changed
<path>/versions/000000000007.json      a version; the newest is the table
<path>/keys-<n>/                       key index: a bucketed table of (key columns, version)
```

* **Readers** resolve the newest version once and read its folders: before a load, during it and after a failed one they
  see whole versions. A refresh publishes a version with the new folder alone.
* **Publishing** creates the version's file, which fails if it is there: of two loads that started from one version the
  second gets an error and its folder is never part of the table.
* **Run ledger.** A load may carry a run id. It is published with the rows, in the same file, so a replayed run is recognised
  and adds nothing, whatever the table's keys: appends without a key, and rows with a NULL key, count once.
* **Key index** (``buckets`` above 0, complete keys without collation): the keys lie in a bucketed, sorted table, hashed as
  Spark hashes a join, so the anti join of a new batch shuffles the batch alone. Batch bounds on the first key column reach the
  index's scan: row groups are skipped by their footers' least and greatest key. The index of a version is written after
  it; versions not yet indexed (a load that died in between) are added by the next load, and a key that is there twice
  does no harm.

Old versions stay readable until ``drop_unreferenced``.
"""

from __future__ import annotations

import hashlib
import json
import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martsmith.schemas import TargetSpec
from martsmith.sinks.targets import _ordered

KEPT = ("version", "folders", "runs", "max_id", "index")
EMPTY = {"version": 0, "folders": [], "runs": {}, "max_id": 0, "index": "keys-1"}


class ConcurrentLoad(RuntimeError):
    """Another load has published a version since this one started."""


@dataclass(frozen=True)
class Ticket:
    """A written load that isn't part of the table yet."""

    folder: str
    base: int  # the version it starts from
    replace: bool


@dataclass
class VersionedTarget:
    spec: TargetSpec
    path: str
    buckets: int = 0

    def __post_init__(self) -> None:
        if self.buckets and (not self.spec.key or self.spec.key_collation):
            raise ValueError("a key index needs a key, and one without collation: buckets hash bytes")
        self.path = self.path.rstrip("/")

    def _fs(self, spark: SparkSession):
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
        return path, path(self.path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    # -- versions

    def versions(self, spark: SparkSession) -> list[int]:
        path, fs = self._fs(spark)
        found = fs.globStatus(path(f"{self.path}/versions/*.json")) or []
        return sorted(int(s.getPath().getName().split(".")[0]) for s in found)

    def version(self, spark: SparkSession, number: int | None = None) -> dict | None:
        """A version's content; the newest if no number is given. A file still being written is no version yet."""
        for n in reversed(self.versions(spark)):
            if number in (None, n) and (held := self._parsed(spark, n)):
                return held
        return None

    def _parsed(self, spark: SparkSession, number: int) -> dict | None:
        path, fs = self._fs(spark)
        stream = fs.open(path(self._file(number)))
        try:
            text = spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()
        try:
            return json.loads(text)
        except json.JSONDecodeError:
            return None

    def _file(self, number: int) -> str:
        return f"{self.path}/versions/{number:012d}.json"

    def _publish(self, spark: SparkSession, held: dict) -> None:
        path, fs = self._fs(spark)
        try:
            stream = fs.create(path(self._file(held["version"])), False)
        except Exception as e:
            if held["version"] in self.versions(spark):
                raise ConcurrentLoad(f"version {held['version']} of {self.path} is there already") from e
            raise
        try:
            stream.write(bytearray(json.dumps({k: held[k] for k in KEPT}).encode()))
        finally:
            stream.close()

    # -- target protocol

    def exists(self, spark: SparkSession) -> bool:
        return self.version(spark) is not None

    def create_if_missing(self, spark: SparkSession) -> None:
        if not self.exists(spark):
            self._publish(spark, {**EMPTY, "version": 1})

    def read(self, spark: SparkSession, version: int | None = None) -> DataFrame | None:
        held = self.version(spark, version)
        if held is None:
            return None
        if not held["folders"]:
            return spark.createDataFrame([], self.spec.schema)
        return spark.read.schema(self.spec.schema).parquet(*[f"{self.path}/data/{f}" for f in held["folders"]])

    def find_run(self, spark: SparkSession, run_id: str) -> dict | None:
        """The report of a run that the table holds."""
        held = self.version(spark)
        return held["runs"].get(run_id) if held else None

    def max_id(self, spark: SparkSession) -> int:
        held = self.version(spark)
        return held["max_id"] if held else 0

    def append(self, df: DataFrame) -> Ticket:
        return self._write(df, replace=False)

    def overwrite(self, df: DataFrame) -> Ticket:
        return self._write(df, replace=True)

    def _write(self, df: DataFrame, replace: bool) -> Ticket:
        spark = df.sparkSession
        held = self.version(spark)
        ticket = Ticket(uuid.uuid4().hex, held["version"] if held else 0, replace)
        _ordered(df, self.spec).write.parquet(f"{self.path}/data/{ticket.folder}")
        return ticket

    def publish(self, spark: SparkSession, ticket: Ticket, run_id: str | None, report: dict) -> None:
        """Make a written load part of the table, together with its run."""
        held = self.version(spark) or EMPTY
        if held["version"] != ticket.base:
            raise ConcurrentLoad(f"{self.path} went from version {ticket.base} to {held['version']} during the load")
        number, folder = ticket.base + 1, ticket.folder
        top = 0
        if self.spec.surrogate:
            top = spark.read.schema(self.spec.schema).parquet(f"{self.path}/data/{folder}").agg(F.max(self.spec.surrogate)).first()[0] or 0
        self._publish(spark, {
            "version": number, "folders": [folder] if ticket.replace else [*held["folders"], folder],
            "runs": {**held["runs"], **({run_id: report} if run_id else {})}, "max_id": top if ticket.replace else max(top, held["max_id"]),
            "index": f"keys-{number}" if ticket.replace else held["index"]})
        if self.buckets:
            self._index_missing(spark)

    # -- key index

    def _index_table(self, spark: SparkSession, index: str) -> str:
        """The catalog's name of the index, registered over its folder if this session hasn't yet."""
        name = "martsmith_" + hashlib.sha256(f"{self.path}/{index}".encode()).hexdigest()[:24]
        types = {f.name: f.dataType.simpleString() for f in self.spec.schema.fields}
        keys = ", ".join(f"`{k}`" for k in self.spec.key)
        spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({', '.join(f'`{k}` {types[k]}' for k in self.spec.key)}, `__folder` STRING) USING parquet "
                  f"CLUSTERED BY ({keys}) SORTED BY ({keys}) INTO {int(self.buckets)} BUCKETS LOCATION '{self.path}/{index}'")
        spark.catalog.refreshTable(name)
        return name

    def _marker(self, index: str, folder: str) -> str:
        return f"{self.path}/indexed/{index}/{folder}"

    def _index_missing(self, spark: SparkSession) -> str:
        """Add the keys of folders that the index lacks; the index's name in the catalog."""
        held = self.version(spark)
        name = self._index_table(spark, held["index"])
        path, fs = self._fs(spark)
        for folder in held["folders"]:
            done = path(self._marker(held["index"], folder))
            if fs.exists(done):
                continue
            rows = spark.read.schema(self.spec.schema).parquet(f"{self.path}/data/{folder}")
            keys = rows.select(*[f"`{k}`" for k in self.spec.key], F.lit(folder).alias("__folder")).where(
                " AND ".join(f"`{k}` IS NOT NULL" for k in self.spec.key))
            keys.repartition(int(self.buckets), *[f"`{k}`" for k in self.spec.key]).write.mode("append").insertInto(name)
            fs.create(done, True).close()
        return name

    def keys(self, spark: SparkSession, batch: DataFrame | None = None) -> DataFrame:
        """The table's complete keys, from the index. With a stored ``batch`` only those within its bounds on the first key
        column: two values go through the driver."""
        keys = spark.table(self._index_missing(spark)).select(*[f"`{k}`" for k in self.spec.key])
        first = F.col(f"`{self.spec.key[0]}`")
        if batch is not None and not isinstance(self.spec.field(self.spec.key[0]).dataType, T.StringType):
            low, high = batch.agg(F.min(first), F.max(first)).first()
            keys = keys.where(F.lit(False)) if low is None else keys.where(first.between(low, high))
        return keys

    # -- housekeeping

    def drop_unreferenced(self, spark: SparkSession, keep_versions: int = 1) -> list[str]:
        """Delete all but the newest ``keep_versions`` versions, and the folders that none of the kept ones lists: of replaced
        content and of failed loads. Not to be called while a load runs."""
        path, fs = self._fs(spark)
        numbers = self.versions(spark)
        kept = [v for n in numbers[-max(1, keep_versions):] if (v := self.version(spark, n))]
        for n in numbers[:-max(1, keep_versions)]:
            fs.delete(path(self._file(n)), False)
        used = {f for v in kept for f in v["folders"]}
        gone = [s.getPath().getName() for s in fs.globStatus(path(f"{self.path}/data/*")) or [] if s.getPath().getName() not in used]
        for f in gone:
            fs.delete(path(f"{self.path}/data/{f}"), True)
        return sorted(gone)
