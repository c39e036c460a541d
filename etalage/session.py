"""Session construction and the shared checkpoint folder."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings every job wants; callers may override any of them.
DEFAULT_CONF = {
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # checkpoints of frames no longer referenced are removed, not left to pile up
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def build_session(
    master: str | None = None,
    app_name: str = "etalage",
    shuffle_partitions: int | None = None,
    conf: dict[str, str] | None = None,
) -> SparkSession:
    """Build (or reuse) a session with the defaults above.

    ``master`` is only set when given, so on a cluster the launcher decides.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = dict(DEFAULT_CONF)
    if shuffle_partitions:
        settings["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    settings.update(conf or {})
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    On a cluster this setting points at shared storage and is used as is.
    Only a local session without the setting (tests, laptops) gets a fresh
    folder of its own.
    """
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        path = spark.sparkContext.getCheckpointDir()
    if path:
        return path.rstrip("/")
    master = spark.sparkContext.master
    if not master.startswith("local"):
        raise RuntimeError(
            "spark.checkpoint.dir is not set; point it at shared storage on a cluster"
        )
    path = tempfile.mkdtemp(prefix="etalage-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    spark.sparkContext.setCheckpointDir(path)
    return path


def scale_conf(input_bytes: int, executor_cores: int, executors: int,
               target_partition_bytes: int = 1 << 30, most_partitions: int = 50_000) -> dict[str, str]:
    """Partition sizing for a cluster run over ``input_bytes`` of parquet.

    A shuffle of m map tasks and r partitions is m x r entries in the driver's map
    outputs, about a byte each once compressed: 100 TB in 256 MB pieces would be
    400k x 400k. So a partition holds about 1 GiB, there are never fewer than two
    waves of tasks, and never more than ``most_partitions`` partitions: 100 TB on
    1000 executors x 8 cores is 50k partitions of 2 GiB (sorted with spilling,
    6 waves) and 100k map tasks of 1 GiB, 5e9 entries or 5 GB on the driver; with
    push-based shuffle (an external shuffle service) the merged outputs are far
    fewer. Adaptive execution then joins small partitions and splits skewed ones
    by their real sizes.
    """
    slots = max(1, executor_cores * executors)
    parts = min(most_partitions, max(2 * slots, -(-input_bytes // target_partition_bytes)))
    return {
        "spark.sql.shuffle.partitions": str(parts),
        "spark.sql.files.maxPartitionBytes": str(target_partition_bytes),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes // 4),
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(2 * target_partition_bytes),
        "spark.shuffle.push.enabled": "true",
    }
