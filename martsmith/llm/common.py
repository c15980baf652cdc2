"""Small helpers shared by the training-data operators."""

from __future__ import annotations

import uuid
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from martsmith.session import scratch_path

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A whole input table, read by Spark (any file system Spark knows)."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared checkpoint folder and read it back: cuts the lineage, and a
    lost executor costs no recomputation of what lies before. The caller's result may
    still read the table, so its life is that of the checkpoint folder."""
    path = scratch_path(df.sparkSession, f"{name}-{uuid.uuid4().hex[:12]}")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def lower_az(text: Column) -> Column:
    """ASCII A-Z to a-z, all else as it is."""
    return F.translate(text, UPPER, UPPER.lower())


def fingerprint128(*cols: Column) -> list[Column]:
    """Two independent 64-bit hashes of the same columns (the first argument seeds them)."""
    return [F.xxhash64(F.lit(seed), *cols) for seed in (1, 2)]


def fresh(columns: Iterable[str], base: str) -> str:
    """``base``, with underscores put before it until no column has that name (in any case)."""
    taken = {c.lower() for c in columns}
    while base.lower() in taken:
        base = "_" + base
    return base


def text_split(text: Column, separator: str) -> Column:
    """``text`` cut at ``separator`` (a pattern that matches one character or more), without empty parts."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), separator, -1), "")
