"""Session defaults and the shared work folder.

All data written by this package outside a named table lands under the
folder named by ``spark.checkpoint.dir`` (a shared file system). A local-mode
session without the setting gets a private temporary folder; a cluster session
without it is an error.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings every job relies on. ANSI mode makes bad casts (dates, decimal
# overflow) raise instead of silently producing NULL; UTC keeps timestamps
# stable across hosts; AQE re-plans joins and partition counts at runtime.
DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Broadcasts happen only when Catalyst's size estimate (or, under AQE,
    # the measured shuffle size) is below these limits; beyond them the
    # planner falls back to a shuffled join.
    "spark.sql.autoBroadcastJoinThreshold": str(32 * 1024 * 1024),
    "spark.sql.adaptive.autoBroadcastJoinThreshold": str(32 * 1024 * 1024),
    "spark.sql.files.maxPartitionBytes": str(256 * 1024 * 1024),
    "spark.sql.parquet.filterPushdown": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
}


def build_session(
    master: str | None = None,
    app_name: str = "keelson",
    shuffle_partitions: int | None = None,
    extra: dict[str, str] | None = None,
) -> SparkSession:
    """Create (or reuse) a session with the package defaults."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    apply_sql_defaults(spark)
    return spark


def apply_sql_defaults(spark: SparkSession) -> None:
    """Runtime SQL settings the package depends on (safe on an existing session)."""
    for k in (
        "spark.sql.session.timeZone",
        "spark.sql.ansi.enabled",
        "spark.sql.adaptive.enabled",
        "spark.sql.adaptive.skewJoin.enabled",
    ):
        spark.conf.set(k, DEFAULT_CONF[k])


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder named by ``spark.checkpoint.dir``.

    A local-mode session without that setting (a laptop, a test) gets a
    private temporary folder. On a cluster the setting is required: a folder
    of the driver's machine could not be read by the executors."""
    sc = spark.sparkContext
    current = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not current:
        master = sc.master
        if not (master == "local" or master.startswith("local[")):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        current = tempfile.mkdtemp(prefix="keelson-ckpt-")
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(current)
    return current


def work_dir(spark: SparkSession, label: str = "run") -> str:
    """A fresh, unique folder under the shared checkpoint folder."""
    base = checkpoint_dir(spark).rstrip("/")
    return f"{base}/keelson-work/{label}-{uuid.uuid4().hex[:12]}"


def materialise(spark: SparkSession, df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once under the shared folder and read it back: cuts the
    lineage, and the copy survives the loss of any executor."""
    path = work_dir(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
