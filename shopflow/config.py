"""Session construction and shared-folder lookup.

Everything that must survive an executor loss (stream checkpoints, table
versions, lineage cuts) goes below the folder the cluster names in
``spark.checkpoint.dir``.  A folder of our own is chosen only where that
setting is unset and the master is local, as in tests.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every job relies on.  AQE re-plans joins at runtime (broadcast when
# a shuffled side turns out small, split skewed partitions of sort-merge
# joins, coalesce small shuffle partitions).
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def build_session(
    master: str | None = None,
    app_name: str = "shopflow",
    shuffle_partitions: int | None = None,
    extra_conf: dict[str, str] | None = None,
    hive: bool = False,
) -> SparkSession:
    """Create (or fetch) a session with the library's defaults.

    ``master`` is left to ``spark-submit`` / the cluster when None.
    ``hive`` uses the Hive catalog, as the reference's batch jobs do.
    ``shuffle_partitions`` defaults to Spark's own value; on a cluster it
    should be sized so a shuffle partition holds roughly 128-256 MB.
    """
    builder = SparkSession.builder.appName(app_name)
    if hive:
        builder = builder.enableHiveSupport()
    if master is not None:
        builder = builder.master(master)
    for key, value in DEFAULT_CONF.items():
        builder = builder.config(key, value)
    if shuffle_partitions is not None:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for key, value in (extra_conf or {}).items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("WARN")
    return spark


def ensure_utc(spark: SparkSession) -> None:
    """Pin the session time zone: epoch <-> date/time text is done in UTC."""
    if spark.conf.get("spark.sql.session.timeZone", None) != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def _checkpoint_dir(spark: SparkSession) -> str | None:
    current = spark.sparkContext.getCheckpointDir()
    if current:
        return current
    conf = spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    return conf or None


def work_dir(spark: SparkSession, *parts: str) -> str:
    """Shared work folder below the session's checkpoint dir.

    Reads ``spark.checkpoint.dir`` (or the context's checkpoint dir).  If
    neither is set, a fresh local folder is created and registered on a
    ``local`` master, as tests need; on a cluster, whose executors could
    not read it, that is an error.  ``parts`` are appended as sub-folders.
    """
    base = _checkpoint_dir(spark)
    if base is None:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        base = tempfile.mkdtemp(prefix="shopflow-ckpt-")
        spark.sparkContext.setCheckpointDir(base)
        base = _checkpoint_dir(spark) or base
    if not parts:
        return base
    return base.rstrip("/") + "/" + "/".join(parts)


def fresh_dir(spark: SparkSession, kind: str) -> str:
    """A new, unique sub-folder of the work folder (never reused)."""
    return work_dir(spark, kind, uuid.uuid4().hex)
