"""Source registry: logical table name -> DataFrame (parquet path or JDBC table).

The source jobs run one federated SQL text on the source server. Here every
source table is its own scan and all joins run on Spark executors; filters and
column pruning reach the scan (parquet ``PushedFilters``/``ReadSchema``, JDBC
``WHERE`` and column list).
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

# The operational tables the marts read, as ``<schema>.<table>``: three source
# schemas (user accounts, admin/campaigns, wallet) on one server.
SOURCE_TABLES = (
    "accounts.users accounts.countries accounts.cities accounts.user_types accounts.types "
    "accounts.kyc_infos accounts.kyc_ex_platforms accounts.states accounts.aml_stores "
    "accounts.investor_categories admin.user_bank_infos admin.campaign_masters admin.countries "
    "admin.campaign_transactions admin.issuer_onboardings admin.referral_transactions "
    "wallet.fund_users wallet.add_funds wallet.withdraw_funds"
).split()

TABLES_WITHOUT_ID = ("accounts.user_types", "admin.user_bank_infos", "wallet.fund_users", "wallet.withdraw_funds")

# The raw tables of the test data set.
TEST_TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


@dataclass
class JdbcTable:
    """A table behind a JDBC URL, read in parallel slices.

    ``partition_column`` (whole numbers) and ``num_partitions`` make Spark issue one range query
    per slice; ``fetchsize`` sets rows per round trip. ``slices``:

    * ``even``: ranges of one width, between the bounds given or those of one min/max query;
    * ``depth``: ranges that hold about equally many rows, whatever gaps the column has: the server counts rows per cell of a
      grid, crowded cells are counted again on a finer one (``equal_depth``), and the boundaries follow from the counts;
    * ``hash``: for tables without such a column, by the server's hash of ``hash_columns`` (``hash_predicates``)."""

    url: str
    dbtable: str
    properties: dict = field(default_factory=dict)
    partition_column: str | None = None
    lower_bound: int | None = None
    upper_bound: int | None = None
    num_partitions: int | None = None
    fetchsize: int = 10_000
    slices: str = "even"
    hash_columns: tuple[str, ...] = ()

    def _quoted(self, spark: SparkSession, name: str) -> str:
        """A column as the server spells it, quoted as Spark quotes it in the slices' predicates."""
        columns = spark.read.format("jdbc").option("url", self.url).option("dbtable", self.dbtable).options(**self.properties).load().columns
        own = next((c for c in columns if c.lower() == name.lower()), name)
        return spark.sparkContext._jvm.org.apache.spark.sql.jdbc.JdbcDialects.get(self.url).quoteIdentifier(own)

    def _ask(self, spark: SparkSession, query: str) -> list:
        return spark.read.format("jdbc").option("url", self.url).option("dbtable", f"({query}) asked").options(**self.properties).load().collect()

    def predicates(self, spark: SparkSession) -> list[str]:
        """The conditions of ``depth`` and ``hash`` slices: every row meets one of them."""
        n = self.num_partitions or 1
        if self.slices == "hash":
            return hash_predicates([self._quoted(spark, c) for c in self.hash_columns], n, self.url.split(":")[1])
        column = self._quoted(spark, self.partition_column)

        def count(low: int, width: int, cells: int) -> dict[int, int]:
            """Rows per cell of ``width`` from ``low`` on."""
            cell = f"(({column} - {low}) / {width})"
            cell = f"FLOOR{cell}" if self.url.split(":")[1] in ("mysql", "mariadb") else cell  # whole numbers elsewhere
            inside = f"{column} >= {low} AND {column} < {low + width * cells}"
            # the cell is a column of its own first: servers differ in grouping by expressions
            cells_of = f"SELECT {cell} AS cell FROM {self.dbtable} WHERE {inside}"
            return {int(r[0]): int(r[1]) for r in self._ask(spark, f"SELECT cell, COUNT(*) AS n FROM ({cells_of}) cells_of GROUP BY cell")}

        low, high = self._ask(spark, f"SELECT MIN({column}) AS lo, MAX({column}) AS hi FROM {self.dbtable}")[0]
        return range_predicates(column, [] if low is None else equal_depth(int(low), int(high), n, count))

    def read(self, spark: SparkSession) -> DataFrame:
        reader = spark.read.format("jdbc").option("url", self.url).option("dbtable", self.dbtable)
        reader = reader.option("fetchsize", str(self.fetchsize))
        # DATETIME columns carry no zone: read them as timestamp_ntz.
        reader = reader.option("preferTimestampNTZ", "true")
        for k, v in self.properties.items():
            reader = reader.option(k, v)
        if self.slices != "even":
            options = {"fetchsize": str(self.fetchsize), "preferTimestampNTZ": "true", **self.properties}
            return spark.read.jdbc(self.url, self.dbtable, predicates=self.predicates(spark), properties=options)
        low, high = self.lower_bound, self.upper_bound
        if self.partition_column and (low is None or high is None):
            column = self._quoted(spark, self.partition_column)
            low, high = self._ask(spark, f"SELECT MIN({column}) AS lo, MAX({column}) AS hi FROM {self.dbtable}")[0]
        if self.partition_column and low is not None:  # an empty table has no bounds and needs no slices
            reader = (
                reader.option("partitionColumn", self.partition_column)
                .option("lowerBound", str(low))
                .option("upperBound", str(int(high) + 1))
                .option("numPartitions", str(self.num_partitions or 1))
            )
        return reader.load()


CELLS = 16  # of the counting grid, per slice


def equal_depth(low: int, high: int, slices: int, count: Callable[[int, int, int], dict[int, int]]) -> list[int]:
    """Boundaries (``slices`` - 1 at most, ascending) between ``low`` and ``high`` with about equally many rows between them.

    ``count(low, width, cells)`` gives the rows of each cell that has some. A cell with more than a quarter of a slice is
    counted again on a grid inside it, until its cells are single values."""
    def counted(start: int, end: int) -> list[tuple[int, int, int]]:
        """(first value, width, rows) of the cells from ``start`` up to ``end``."""
        width = max(1, -(-(end - start) // (CELLS * slices)))
        cells = -(-(end - start) // width)
        return [(start + k * width, width, n) for k, n in sorted(count(start, width, cells).items())]

    cells = counted(low, high + 1)
    total = sum(n for *_, n in cells)
    crowded = max(1, total // (4 * slices))
    while any(n > crowded and width > 1 for _, width, n in cells):
        cells = [c for first, width, n in cells for c in (counted(first, first + width) if n > crowded and width > 1 else [(first, width, n)])]
    bounds, held, done = [], 0, 0
    for first, _, n in cells:
        # a boundary before the cell if that is nearer to the slice's end than one after it
        if held and done + held + n / 2 > total * (len(bounds) + 1) / slices and len(bounds) < slices - 1:
            bounds.append(first)
            done, held = done + held, 0
        held += n
    return bounds


def range_predicates(column: str, bounds: list[int]) -> list[str]:
    """One condition per slice; NULLs go with the first."""
    if not bounds:
        return ["1 = 1"]
    return [f"{column} < {bounds[0]} OR {column} IS NULL", *[f"{column} >= {a} AND {column} < {b}" for a, b in zip(bounds, bounds[1:])],
            f"{column} >= {bounds[-1]}"]


def hash_predicates(columns: list[str], slices: int, dialect: str) -> list[str]:
    """One condition per slice by the server's hash of the columns' text; rows alike in them share a slice."""
    text = "CONCAT_WS('|', " + ", ".join(f"COALESCE(CAST({c} AS CHAR), '')" for c in columns) + ")"
    if dialect in ("mysql", "mariadb"):
        number = f"CRC32({text})"
    elif dialect == "postgresql":
        number = f"ABS(hashtext({text.replace('AS CHAR', 'AS TEXT')})::bigint)"
    else:
        raise ValueError(f"no hash known of {dialect}")
    return [f"MOD({number}, {slices}) = {k}" for k in range(slices)]


@dataclass
class ParquetTable:
    """A parquet folder or file; its splits are the scan's tasks, at any size."""

    path: str

    def read(self, spark: SparkSession) -> DataFrame:
        return spark.read.parquet(self.path)


class SourceRegistry:
    """Resolves logical source names (``accounts.users``...) to DataFrames.

    Entries are table descriptors (``ParquetTable``/``JdbcTable``) or functions
    ``registry -> DataFrame`` for views derived from other entries. Each name
    is resolved once per registry, so a table used twice in a query is the
    same scan (Catalyst may still reuse the exchange)."""

    def __init__(self, spark: SparkSession,
                 tables: Mapping[str, object] | None = None) -> None:
        self.spark = spark
        self._defs: dict[str, object] = dict(tables or {})
        self._cache: dict[str, DataFrame] = {}

    def register(self, name: str, table: object) -> SourceRegistry:
        self._defs[name] = table
        self._cache.pop(name, None)
        return self

    def names(self) -> list[str]:
        return sorted(self._defs)

    def __contains__(self, name: str) -> bool:
        return name in self._defs

    def table(self, name: str) -> DataFrame:
        if name not in self._cache:
            if name not in self._defs:
                raise KeyError(f"unknown source table {name!r}; known: {self.names()}")
            d = self._defs[name]
            if isinstance(d, DataFrame):
                df = d
            elif isinstance(d, Callable) and not hasattr(d, "read"):
                df = d(self)
            else:
                df = d.read(self.spark)
            self._cache[name] = df
        return self._cache[name]

    __getitem__ = table


_SCANS: dict[tuple[str, int, str], DataFrame] = {}


def _shared_scan(path: str):
    """Resolve a read-only parquet file once per session: listing files and reading
    footers is a fixed driver-side cost per scan, paid once for all queries."""
    def build(reg: SourceRegistry) -> DataFrame:
        # the application id changes with every new SparkContext, the JVM hash code
        # with every new session: a stopped session's frames are never reused
        key = (reg.spark.sparkContext.applicationId, reg.spark._jsparkSession.hashCode(), path)
        if key not in _SCANS:
            _SCANS[key] = ParquetTable(path).read(reg.spark)
        return _SCANS[key]
    return build


def parquet_dir_registry(spark: SparkSession, sf_dir: str,
                         names: tuple[str, ...] = tuple(TEST_TABLES)) -> SourceRegistry:
    """One scan per ``{sf_dir}/{name}.parquet`` (read-only test data, resolved once per session)."""
    return SourceRegistry(spark, {n: _shared_scan(f"{sf_dir.rstrip('/')}/{n}.parquet") for n in names})


def jdbc_registry(spark: SparkSession, url: str, databases: Mapping[str, str],
                  properties: Mapping[str, str] | None = None,
                  partitioning: Mapping[str, tuple[str, int | None, int | None, int]] | None = None,
                  fetchsize: int = 10_000, num_partitions: int = 0, slices: str = "even") -> SourceRegistry:
    """Registry of all operational tables behind one JDBC server.

    ``databases`` maps the logical schema (``accounts``, ``admin``, ``wallet``) to the
    database name on the server; ``partitioning`` gives (column, lower, upper,
    partitions) per logical table for parallel range reads of the big tables; without an
    entry, tables with an ``id`` are read in ``num_partitions`` slices of it (0: in one), of even width or, with
    ``slices="depth"``, of equally many rows."""
    partitioning = partitioning or {}
    tables = {}
    for name in SOURCE_TABLES:
        schema, table = name.split(".", 1)
        default = ("id", None, None, num_partitions) if num_partitions and name not in TABLES_WITHOUT_ID else (None, None, None, None)
        col, lo, hi, n = partitioning.get(name, default)
        tables[name] = JdbcTable(url, f"{databases[schema]}.{table}", dict(properties or {}),
                                 col, lo, hi, n, fetchsize, slices if col and name not in partitioning else "even")
    return SourceRegistry(spark, tables)


def parquet_registry(spark: SparkSession, root: str) -> SourceRegistry:
    """Registry of operational tables exported as parquet under ``{root}/{schema}/{table}``."""
    root = root.rstrip("/")
    return SourceRegistry(spark, {n: ParquetTable(f"{root}/{n.replace('.', '/')}") for n in SOURCE_TABLES})

