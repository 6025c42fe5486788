"""Session settings that the jobs rely on. On a cluster the submitted session wins; nothing here sizes it."""

from __future__ import annotations

import tempfile
from functools import cache

from pyspark.sql import SparkSession

RUNTIME_SETTINGS = {
    # Timestamps are instants; days and months are taken in UTC.
    "spark.sql.session.timeZone": "UTC",
    # Run-time partition sizing, join choice and skew splitting.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
}

#: What a task reads at most, of files and of a shuffle. Rows are up to 20 times larger in memory than there, and sorts and
#: hash tables hold them: with Spark's own 128 and 64 MB a task needs more than a gigabyte.
TASK_BYTES = {
    "spark.sql.files.maxPartitionBytes": 8 << 20,
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": 16 << 20,
}
#: Input for each partition of a shuffle, before small ones are put together. Wide rows are several times their input.
SHUFFLED_INPUT = 4 << 20
INITIAL_PARTITIONS = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"


def use_runtime_settings(spark: SparkSession, folder: str | None = None) -> SparkSession:
    """Settings that keep tasks small; smaller sizes and more partitions that a submitted session has stay.

    With the ``folder`` of the input, shuffles begin with partitions in proportion to its bytes, so that a larger input gives
    more tasks and not larger ones.
    """
    for name, value in RUNTIME_SETTINGS.items():
        spark.conf.set(name, value)
    to_bytes = spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes
    for name, most in TASK_BYTES.items():
        if to_bytes(spark.conf.get(name)) > most:
            spark.conf.set(name, f"{most}b")
    if folder:
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
        files = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        wanted = -(-files.getContentSummary(path).getLength() // SHUFFLED_INPUT)
        least = max(int(spark.conf.get("spark.sql.shuffle.partitions")), int(spark.conf.get(INITIAL_PARTITIONS, "1")))
        if wanted > least:
            spark.conf.set(INITIAL_PARTITIONS, str(wanted))
    return spark


def local_session(app: str = "accountweave", cores: int | str = "*", shuffle_partitions: int = 8) -> SparkSession:
    """Session for tests and for work on one machine."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        # Small shuffles on one machine: rather all cores than few full partitions.
        .config("spark.sql.adaptive.coalescePartitions.minPartitionSize", "128k")
        .getOrCreate()
    )
    return use_runtime_settings(spark)


@cache
def _own_folder() -> tempfile.TemporaryDirectory:
    """Folder of this process, removed when it ends."""
    return tempfile.TemporaryDirectory(prefix="accountweave-")


def checkpoint_folder(spark: SparkSession, name: str) -> str:
    """Folder for intermediate tables of this application, below the shared folder that the cluster names.

    Where ``spark.checkpoint.dir`` is unset, a session on one machine (tests) takes a folder of its own process. On a
    cluster that would be a different disk on each executor, so there it is an error.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not shared:
        if not spark.sparkContext.master.partition("[")[0] == "local":
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        shared = _own_folder().name
    return f"{shared.rstrip('/')}/{spark.sparkContext.applicationId}/{name}"


def drop_staged(spark: SparkSession) -> None:
    """Remove all that this application has staged; results that still read from it must have been written before."""
    spark.catalog.clearCache()
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(checkpoint_folder(spark, "staged"))
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
