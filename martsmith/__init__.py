"""martsmith: declarative reporting marts on Spark.

A mart is a DataFrame query over operational tables (scans, lookup/bridge/orphan
joins, projection, JSON extraction, code decoding, distinct) followed by a load
into a flat target table in one of three modes: ``append``, keyed
``insert_ignore`` (first row wins, never updates) and guarded ``full_refresh``.
Every step is a DataFrame -> DataFrame transform that runs on executors.
"""

from martsmith.schemas import TargetSpec, TARGETS

__all__ = ["TargetSpec", "TARGETS"]
