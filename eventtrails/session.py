"""Session helpers for tests, the bench and scripts.

Library functions never create or configure a session: they take
DataFrames. This module only builds a local session for tests and the
bench, and reads (never invents, on a cluster) the shared checkpoint folder.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Session settings this library relies on for scale.
RECOMMENDED_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def scale_conf(
    input_bytes: int, executor_cores: int = 4, target_partition_bytes: int = 256 << 20, shuffle_bytes: int | None = None
) -> dict:
    """Suggested settings for a cluster job over ``input_bytes`` of events.

    Returns a dict to pass to ``SparkSession.builder.config`` (nothing is
    set here). Input splits and post-shuffle partitions target
    ``target_partition_bytes`` each, so a task holds one partition plus
    working memory well inside an executor core's share; AQE coalesces small
    shuffle outputs and splits skewed ones (a skewed partition is one over 5x
    the median and over 4x the target size). The initial shuffle partition
    count is ``shuffle_bytes`` (the largest single shuffle; by default a
    sixteenth of the input, since shuffles here carry key tables, frontiers and
    narrow columns) over the target, rounded up to a multiple of the core count
    of one executor: sizing it by the input would make map-output tables of
    billions of blocks. Broadcasts stay at Spark's
    default 10 MB, checked from statistics or measured by AQE.
    """
    target = int(target_partition_bytes)
    moved = int(input_bytes) // 16 if shuffle_bytes is None else int(shuffle_bytes)
    parts = max(executor_cores, -(-moved // target))
    parts = -(-parts // executor_cores) * executor_cores
    return {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(parts),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target),
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "5",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(4 * target),
        "spark.sql.shuffle.partitions": str(parts),
        "spark.sql.files.maxPartitionBytes": str(target),
        "spark.sql.autoBroadcastJoinThreshold": str(10 << 20),
    }


def local_session(
    cores: int | str = "*",
    shuffle_partitions: int = 8,
    app: str = "eventtrails",
    extra_conf: dict | None = None,
) -> SparkSession:
    """A ``local[cores]`` session for tests and the bench.

    Sets a checkpoint folder under the system temp dir only when none is
    configured (``spark.checkpoint.dir``), which is right for a single
    machine and wrong for a cluster, where the cluster names a shared one.
    """
    b = SparkSession.builder.master(f"local[{cores}]").appName(app)
    conf = dict(RECOMMENDED_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf["spark.driver.memory"] = os.environ.get("EVENTTRAILS_DRIVER_MEMORY", "8g")
    conf.update(extra_conf or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    shared_dir(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str | None:
    """The configured (shared) checkpoint folder, or ``None``."""
    return spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()


def shared_dir(spark: SparkSession) -> str:
    """The folder for intermediate tables: ``spark.checkpoint.dir``.

    Executors and driver must share it, so only a local session without the
    setting gets a temporary one; elsewhere a missing setting is an error.
    """
    d = checkpoint_dir(spark)
    if d is None:
        if not spark.sparkContext.master.startswith("local["):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by driver and executors")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="eventtrails-ckpt-"))
        d = spark.sparkContext.getCheckpointDir()
    return d.rstrip("/")


_written: dict[str, list[str]] = {}


def shared_path(spark: SparkSession, label: str = "table") -> str:
    """A new path in the shared folder, removed by :func:`drop_intermediates`."""
    path = f"{shared_dir(spark)}/eventtrails-{label}-{uuid.uuid4().hex}"
    _written.setdefault(spark.sparkContext.applicationId, []).append(path)
    return path


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write ``df`` as a Parquet table in the shared folder and continue from it.

    The written table survives executor loss, its measured size plans the next
    join, and it is written by one job (an eager ``Dataset.checkpoint`` computes
    the frame twice: once to count it and once to save it).
    """
    spark = df.sparkSession
    path = shared_path(spark)
    df.write.parquet(path)
    # the schema is known: no footer reads to infer it again
    return spark.read.schema(df.schema).parquet(path)


def drop_intermediates(spark: SparkSession) -> None:
    """Delete the tables this application has written to the shared folder.

    Call it once results that read them have been written or collected.
    """
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    for path in _written.pop(spark.sparkContext.applicationId, []):
        p = spark._jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(conf).delete(p, True)
