"""Sources: table scans over parquet or JDBC, and the test-data stand-ins."""

from martsmith.sources.registry import (
    SOURCE_TABLES,
    TEST_TABLES,
    JdbcTable,
    ParquetTable,
    SourceRegistry,
    jdbc_registry,
    parquet_dir_registry,
    parquet_registry,
)
from martsmith.sources.standins import STANDINS, standin_registry, standin_sql

__all__ = [
    "JdbcTable",
    "ParquetTable",
    "SOURCE_TABLES",
    "STANDINS",
    "SourceRegistry",
    "TEST_TABLES",
    "jdbc_registry",
    "parquet_dir_registry",
    "parquet_registry",
    "standin_registry",
    "standin_sql",
]
