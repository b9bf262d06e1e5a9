"""Session settings the pipeline relies on, and the shared scratch folder.

The pipeline's day boundaries are UTC (dates arrive as epoch milliseconds and
``DATE(TIMESTAMP_MILLIS(x))`` is a UTC date), so every entry point calls
``apply_pipeline_conf`` on the session it is given.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

PIPELINE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    # Runtime re-planning: coalesce small shuffle partitions, split skewed
    # join partitions, and turn sort-merge joins into broadcast joins when a
    # side's *measured* size falls under the threshold.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


def apply_pipeline_conf(spark: SparkSession) -> SparkSession:
    for key, value in PIPELINE_CONF.items():
        spark.conf.set(key, value)
    return spark


def build_session(
    master: str = "local[*]",
    shuffle_partitions: int = 8,
    app_name: str = "tallyward",
    extra: dict | None = None,
) -> SparkSession:
    """Session for tests, the bench and local runs (a cluster brings its own)."""
    builder = (
        SparkSession.builder.master(master)
        .appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", "8g")
        .config("spark.sql.files.maxPartitionBytes", str(128 * 1024 * 1024))
    )
    for key, value in {**PIPELINE_CONF, **(extra or {})}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return apply_pipeline_conf(spark)


def shared_root(spark: SparkSession) -> str:
    """The cluster's shared folder (``spark.checkpoint.dir``).

    A folder of our own is made only when the session names none *and* runs in
    local mode, as a bare test session does; on a cluster a machine-local folder
    would not be visible to other executors, so an unset setting is an error. A
    ``file:`` folder may be a mount that all machines have; ``fresh_dir`` asks the executors.
    """
    root = None
    try:
        root = spark.sparkContext.getCheckpointDir()
    except Exception:  # Spark Connect has no SparkContext
        root = None
    if not root:
        root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        master = spark.conf.get("spark.master", "") or ""
        if not master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by the cluster")
        root = tempfile.mkdtemp(prefix="tallyward-")
        try:
            spark.sparkContext.setCheckpointDir(root)
        except Exception:
            pass
    return root.rstrip("/")


def _require_shared(spark: SparkSession, root: str) -> None:
    """An error if what executors write to ``root`` is not there for the driver: a write would
    lose those rows without one. Only a ``file:`` folder on a cluster is tried, by as many
    files as the executors have cores."""
    from tallyward.sources.tables import FileSystem

    fs = FileSystem(spark, root)
    if fs.scheme != "file" or (spark.conf.get("spark.master", "") or "").startswith("local"):
        return
    n = spark.sparkContext.defaultParallelism
    trial = f"{root}/tallyward-trial-{uuid.uuid4().hex[:12]}"
    try:
        spark.range(0, n, 1, n).write.parquet(trial)
        found = sum(name.startswith("part-") for name in fs.files(trial))
    finally:
        fs.remove(trial)
    if found != n:
        raise RuntimeError(f"spark.checkpoint.dir is {root}, a machine's own folder: executors do not share it")


def fresh_dir(spark: SparkSession, label: str) -> str:
    """A new, unique folder for one run, under a folder of the application in the shared
    root that is removed when the session's JVM ends."""
    from tallyward.sources.tables import FileSystem

    root = shared_root(spark)
    own = f"{root}/tallyward/{spark.sparkContext.applicationId}"
    fs = FileSystem(spark, own)
    if not fs.exists(own):
        _require_shared(spark, root)
    fs.scratch(own)
    return f"{own}/{label}-{uuid.uuid4().hex[:12]}"
