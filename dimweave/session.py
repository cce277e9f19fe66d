"""Session helpers: a tuned SparkSession and a shared work folder.

Work folders live under ``spark.checkpoint.dir`` because that is the folder a
cluster shares between driver and executors.  Only when the setting is unset
(local runs, tests) do we create one ourselves.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

#: Name of the folder under the checkpoint root that holds all work tables.
WORK = "dimweave-work"


def get_spark(master: str | None = None, app: str = "dimweave",
              shuffle_partitions: int | None = None, **extra: str) -> SparkSession:
    """Return a session configured for this library.

    AQE is on so shuffle partition counts coalesce at runtime and skewed
    join partitions are split; the session time zone is UTC so naive
    timestamps read and print the same as in DuckDB.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        # coalesce to the advisory size rather than to the core count: fewer,
        # fuller tasks (the setting Spark recommends for shared clusters)
        "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
    }
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra)
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def scale_conf(input_bytes: int, *, total_cores: int, target_partition_bytes: int = 256 << 20) -> dict[str, str]:
    """Suggested settings for a run that reads ``input_bytes`` on ``total_cores``.

    Shuffle partitions start at input / target size (at least 2x the cores)
    so no reducer has to spill much; AQE then coalesces small ones and splits
    skewed ones.  Scan splits use the same target size.
    """
    parts = max(2 * total_cores, -(-input_bytes // target_partition_bytes))
    return {
        "spark.sql.shuffle.partitions": str(parts),
        "spark.sql.files.maxPartitionBytes": str(target_partition_bytes),
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes // 2),
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(target_partition_bytes * 2),
    }


def checkpoint_root(spark: SparkSession) -> str:
    """The shared checkpoint folder of the cluster.

    Taken from the session (``spark.checkpoint.dir``, which Spark applies to
    the context at start-up).  Only when it is unset on a local master (tests)
    a private folder is created and registered, so later calls agree on it; on
    a cluster no folder of the driver's machine would do, so that fails.
    """
    sc = spark.sparkContext
    root = sc.getCheckpointDir() or sc.getConf().get("spark.checkpoint.dir", None)
    if not root:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that driver and executors share")
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="dimweave-ckpt-"))
        root = sc.getCheckpointDir()
    return root


def work_dir(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder under the shared checkpoint root."""
    root = checkpoint_root(spark).rstrip("/")
    return f"{root}/{WORK}/{name}-{uuid.uuid4().hex[:12]}"


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether ``path`` exists on its (shared) file system, via the Hadoop API."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


def local_path(path: str) -> str:
    """Strip a ``file:`` scheme for local-only helpers (tests)."""
    return path[5:] if path.startswith("file:") else path


__all__ = ["WORK", "get_spark", "scale_conf", "checkpoint_root", "work_dir", "path_exists", "local_path"]
