"""The corpus pipeline: language ID, line dedup, near-dedup, decontamination, packing.

Each stage works on all rows that the one before kept and, but for the last, returns the columns of
``documents``. A stage's result is written to the shared checkpoint folder and read again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martsmith.llm.common import staged, table
from martsmith.llm.decontam import drop_contaminated
from martsmith.llm.langid import identified, learn
from martsmith.llm.linededup import dedup_lines
from martsmith.llm.packing import pack
from martsmith.llm.simhash import one_per_group


def in_a_known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Language ID: documents without letters, in no language for the most part, or in none that was learnt, go."""
    return identified(docs, learn(docs))


def without_boilerplate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Line dedup: a source's boilerplate lines go (``n_chars`` follows), from pages that hold nothing else too. Copies of
    one text count as one page, so that they stay whole for the next stage to choose one."""
    cut = dedup_lines(docs, copies_once=True)
    n_chars = F.when(F.col("n_dropped") > 0, F.length("text")).otherwise(F.col("n_chars")).cast(docs.schema["n_chars"].dataType)
    return cut.withColumn("n_chars", n_chars).select(*docs.columns)


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """SimHash near-dedup: the document with the smallest id of each group stays."""
    return one_per_group(docs)


def without_benchmarks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Benchmark decontamination: documents with a benchmark window go."""
    return drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Packing: the pieces of all documents that are left, with sequence and offset."""
    return pack(docs)


STAGES = [
    ("language_id", in_a_known_language),
    ("line_dedup", without_boilerplate),
    ("simhash_dedup", one_of_each_group),
    ("decontamination", without_benchmarks),
    ("packing", packed),
]

#: Viterbi labels, SimHash and token ids are beyond SQL; the stages are tested by brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage over the whole ``documents`` table."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
