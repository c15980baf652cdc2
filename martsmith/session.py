"""Session helpers: a sensibly configured SparkSession and the shared checkpoint folder."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings that every mart job relies on. AQE re-plans joins from runtime sizes,
# splits skewed join partitions and coalesces small shuffle partitions.
DEFAULT_CONF = {
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.parquet.outputTimestampType": "TIMESTAMP_MICROS",
}


def build_session(
    master: str | None = None,
    app_name: str = "martsmith",
    shuffle_partitions: int | None = None,
    extra_conf: dict[str, str] | None = None,
) -> SparkSession:
    """Get or create a session with the mart defaults (used by tests and bench)."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra_conf or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def scale_conf(shuffled_bytes: int, target_partition_bytes: int = 256 * 1024 * 1024,
               max_partitions: int = 20_000) -> dict[str, str]:
    """Settings for a run whose largest stage shuffles ``shuffled_bytes``.

    Shuffle partitions are sized so that each holds about ``target_partition_bytes`` (AQE coalesces the
    small ones and splits skewed join partitions), up to ``max_partitions``: the driver
    keeps a map status per map task and reducer, so beyond that partitions grow instead
    (tasks spill). Scans read splits of the target size; automatic broadcasts stay under the
    bound that ``checked_broadcast`` uses. Pass the result as ``extra_conf`` to
    ``build_session`` or set it on the cluster."""
    partitions = min(max_partitions, max(200, -(-int(shuffled_bytes) // target_partition_bytes)))
    held = max(target_partition_bytes, -(-int(shuffled_bytes) // partitions))
    return {
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes),
        "spark.sql.files.maxPartitionBytes": str(target_partition_bytes),
        "spark.sql.autoBroadcastJoinThreshold": str(32 * 1024 * 1024),
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(4 * held),
    }


# What a task of a mart's job reads: columnar or compressed bytes, of which the marts' wide rows make 20 times as much
# in memory (a scan of 16 MB of line items holds about 400 MB of transactions when it sorts them).
TASK_BYTES = 16 * 1024 * 1024
ROW_GROWTH = 24
# The JVM interprets longer methods and never compiles them: conversions of 45 columns fused into one loop have 13,377 bytes.
JIT_BYTES = 8000


def _stored_bytes(spark: SparkSession, path: str) -> int:
    """Bytes of the files under ``path``, by its file system's own listing."""
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return fs.getContentSummary(folder).getLength() if fs.exists(folder) else 0


def conf_bytes(spark: SparkSession, key: str) -> int:
    return int(spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(spark.conf.get(key)))


def _least(spark: SparkSession, key: str, value: int) -> str:
    return str(min(conf_bytes(spark, key), value))


def task_session(spark: SparkSession, input_path: str) -> SparkSession:
    """A session of the same application whose tasks are sized by what they read, so that a larger input makes more tasks and
    not larger ones: map-side sorts and hash tables of wide rows (the partial steps of first-wins and DISTINCT, on
    scans and on the output of fan-out joins) then stay within a task's memory and don't spill.

    Scans read splits, and AQE makes shuffle partitions, of ``TASK_BYTES`` at most; a shuffle starts with as many partitions as the
    input under ``input_path`` calls for (AQE merges those that are small). Operators whose fused code would be too long for the JVM to
    compile (``JIT_BYTES``) run one by one. All other settings are ``spark``'s; smaller
    sizes set there, and a number of first partitions, stay."""
    own = spark.newSession()
    for key, value in spark.conf.getAll.items():
        if spark.conf.isModifiable(key):
            own.conf.set(key, value)
    own.conf.set("spark.sql.files.maxPartitionBytes", _least(spark, "spark.sql.files.maxPartitionBytes", TASK_BYTES))
    own.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", _least(spark, "spark.sql.adaptive.advisoryPartitionSizeInBytes", TASK_BYTES))
    skewed = "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes"
    own.conf.set(skewed, _least(spark, skewed, 2 * TASK_BYTES))
    huge = "spark.sql.codegen.hugeMethodLimit"
    own.conf.set(huge, str(min(int(spark.conf.get(huge)), JIT_BYTES)))
    first = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
    if not spark.conf.get(first, None):
        wanted = -(-_stored_bytes(spark, input_path) * ROW_GROWTH // (4 * TASK_BYTES))
        own.conf.set(first, str(min(20_000, max(wanted, int(spark.conf.get("spark.sql.shuffle.partitions"))))))
    return own


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the reliable checkpoint folder of this session.

    The cluster names a shared folder in ``spark.checkpoint.dir``; it is used as
    is. Only when nothing is configured (unit tests on ``local[*]``) a private
    folder is created. On a non-local master a missing setting is an error:
    a machine-local folder would not survive the loss of an executor.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = sc.getConf().get("spark.checkpoint.dir", None) or spark.conf.get(
        "spark.checkpoint.dir", None
    )
    if not configured:
        if not sc.master.startswith("local"):
            raise RuntimeError(
                "spark.checkpoint.dir is not set; point it at a shared folder "
                "(HDFS/object store) before running mart loads on a cluster"
            )
        configured = tempfile.mkdtemp(prefix="martsmith-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared checkpoint folder for staged tables."""
    base = ensure_checkpoint_dir(spark)
    return os.path.join(base, "martsmith-staging", name)
