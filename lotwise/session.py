"""Session settings and the shared scratch folder."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # rows for Python go by bytes: long texts make small batches
    "spark.sql.execution.arrow.maxBytesPerBatch": "8m",
    # the JVM never compiles methods above 8000 bytes; wide cleaning stages run faster without fused code
    "spark.sql.codegen.hugeMethodLimit": "8000",
}


def get_session(app_name: str = "lotwise", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the jobs rely on.

    Without ``master`` the cluster's own submit settings decide, including the number of shuffle
    partitions; AQE merges small ones and splits skewed ones at run time.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**_SETTINGS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def apply_settings(spark: SparkSession) -> None:
    """Bring a session that somebody else built to the same settings."""
    for key, value in _SETTINGS.items():
        spark.conf.set(key, value)


def spread(df: DataFrame) -> DataFrame:
    """Give every core a share of an input that arrives in fewer partitions than there are cores.

    Large inputs have more splits than cores and pass unchanged.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df if df.rdd.getNumPartitions() >= cores else df.repartition(cores)


def dealt(df: DataFrame, rows_per_task: int) -> DataFrame:
    """The rows dealt evenly over tasks of ``rows_per_task``, at least one task a core: for work that costs much per row.

    A file may have fewer row groups than splits, and splits without one are empty, so their number tells nothing.
    """
    tasks = -(-df.count() // rows_per_task)
    return df.repartition(max(tasks, df.sparkSession.sparkContext.defaultParallelism))


def scratch_root(spark: SparkSession) -> str:
    """The shared folder for written intermediate tables.

    It is the one the cluster names in ``spark.checkpoint.dir``. Only a local session without that
    setting gets a temporary folder of its own: on a cluster such a folder would exist on one
    machine only.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors can reach")
    root = tempfile.mkdtemp(prefix="lotwise-")
    atexit.register(shutil.rmtree, root, ignore_errors=True)
    spark.conf.set("spark.checkpoint.dir", root)
    return root


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, unused path below the shared folder."""
    return f"{scratch_root(spark).rstrip('/')}/lotwise/{name}-{uuid.uuid4().hex}"


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Let ``DataFrame.checkpoint()`` and tree training write to the shared folder."""
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(scratch_root(spark))
