"""Session settings the library relies on, and where it may write.

Nothing here hides Spark: ``configure`` only sets the handful of SQL
options the models depend on (UTC calendar days, AQE) and ``scratch_dir``
finds a folder every executor can reach.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Options the results depend on (calendar day in UTC) and options for scale
# (AQE re-plans joins with runtime sizes, coalesces small shuffle partitions
# and splits skewed ones).
REQUIRED_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # A task sorts a whole partition of bodies, at some 24 MB of memory a
    # compressed one: shuffles are cut fine and put together up to this size, so
    # that it grows with neither the input nor a small spark.sql.shuffle.partitions.
    # (Up to 200 are written without a sort.)
    "spark.sql.adaptive.coalescePartitions.initialPartitionNum": "200",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16MB",
    # Broadcast only what AQE has measured: no broadcast chosen from
    # compile-time estimates (compressed file sizes understate a side), and a
    # runtime threshold on the actual shuffle output of the small side.
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "32MB",
    # A selective join side (one type's ids) filters the wide body scan by a
    # bloom filter before its shuffle; Spark applies it to scans over 10 GB.
    "spark.sql.optimizer.runtime.bloomFilter.enabled": "true",
    "spark.sql.optimizer.runtime.bloomFilter.creationSideThreshold": "512MB",
}


def configure(spark: SparkSession) -> SparkSession:
    for key, value in REQUIRED_CONF.items():
        spark.conf.set(key, value)
    return spark


def local_session(app: str = "silverline", cores: int | str = "*",
                  shuffle_partitions: int = 8, checkpoint_dir: str | None = None,
                  **extra: str) -> SparkSession:
    """A local session for tests and the bench (the UI stays off).

    ``checkpoint_dir`` is registered only when the session names no
    ``spark.checkpoint.dir`` of its own (e.g. from ``spark-defaults.conf``).
    """
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", extra.pop("driver_memory", "8g"))
    )
    for key, value in {**REQUIRED_CONF, **extra}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    sc = spark.sparkContext
    if checkpoint_dir and not (sc.getConf().get("spark.checkpoint.dir", None)
                               or sc.getCheckpointDir()):
        sc.setCheckpointDir(checkpoint_dir)
    checkpoint_root(spark)
    return configure(spark)


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    On a cluster this must be set (a distributed file system path every
    executor reaches) and is used as is.  Only in local mode, when it is
    unset, a fresh folder under the system temp directory is registered.
    """
    sc = spark.sparkContext
    root = sc.getConf().get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not root:
        if not sc.master.startswith("local"):
            # a driver-local folder is invisible to executors on a cluster
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
        root = tempfile.mkdtemp(prefix="silverline-ckpt-")
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(root)
    return root


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A new, unique folder below the shared checkpoint root."""
    root = checkpoint_root(spark).rstrip("/")
    return f"{root}/{name}-{uuid.uuid4().hex[:12]}"
