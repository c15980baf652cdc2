"""Load targets (parquet folder, versioned parquet table, JDBC table) and the write half of the load modes."""

from martsmith.sinks.targets import JdbcTarget, ParquetTarget
from martsmith.sinks.versioned import ConcurrentLoad, VersionedTarget

__all__ = ["ConcurrentLoad", "JdbcTarget", "ParquetTarget", "VersionedTarget"]
