"""Session defaults and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

# AQE coalesces small shuffle partitions and splits skewed ones at run time; it needs enough of them to
# start from, see sized_shuffles.
SESSION_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    # HotSpot never compiles methods above this size; wide projections run faster without fusing them.
    "spark.sql.codegen.hugeMethodLimit": "8000",
    # Keep the generated code of more queries than the default hundred stages.
    "spark.sql.codegen.cache.maxEntries": "1000",
    # Recording the Python line of every column costs several JVM calls per expression.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def local_session(cores: str = "*", shuffle_partitions: int = 8, name: str = "layerwright") -> SparkSession:
    """A session for tests and the bench; on a cluster the submitter supplies the session."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(name)
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    )
    for key, value in SESSION_CONF.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


# Bytes per shuffle partition, whatever the size of the input.
SHUFFLE_PARTITION_BYTES = 256 << 20
LEAST_PARTITION_BYTES = 16 << 20
INITIAL_PARTITIONS = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
ADVISORY_BYTES = "spark.sql.adaptive.advisoryPartitionSizeInBytes"


def shuffle_partitions(spark: SparkSession, input_bytes: int) -> int:
    """Shuffle partitions to start with for an input of this size, never fewer than configured."""
    wanted = -(-input_bytes // SHUFFLE_PARTITION_BYTES)
    return max(wanted, int(spark.conf.get("spark.sql.shuffle.partitions")))


def partition_bytes(spark: SparkSession, input_bytes: int) -> int:
    """Target partition size: 256 MB, less where that would leave cores idle."""
    per_core = input_bytes // spark.sparkContext.defaultParallelism
    return max(min(per_core, SHUFFLE_PARTITION_BYTES), LEAST_PARTITION_BYTES)


@contextmanager
def sized_shuffles(spark: SparkSession, input_bytes: int) -> Iterator[None]:
    """Run shuffles, and write files, with partitions to match the input.

    AQE merges shuffle partitions that turn out small but cannot add any, so a fixed default would leave
    hundreds of gigabytes in each at 100 TB.
    """
    wanted = {
        INITIAL_PARTITIONS: str(shuffle_partitions(spark, input_bytes)),
        ADVISORY_BYTES: str(partition_bytes(spark, input_bytes)),
    }
    before = {key: spark.conf.get(key, None) for key in wanted}
    for key, value in wanted.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, as named by ``spark.checkpoint.dir``.

    Where the setting is missing, a local session gets a temporary folder of its own; on a cluster
    that would be lost with the machine, so it is an error there.
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
    named = tempfile.mkdtemp(prefix="layerwright-")
    spark.sparkContext.setCheckpointDir(named)
    return named


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path below :func:`shared_dir`."""
    return f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"
