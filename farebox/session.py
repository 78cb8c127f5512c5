"""Session configuration.

The library never owns or stops a session: every public function takes the
caller's DataFrames (or session) and returns lazy DataFrames. ``configure``
only sets runtime SQL options that the semantics depend on; ``build_session``
is a convenience for tests, the bench and local runs.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Runtime options the operators rely on (all settable on a live session).
SEMANTIC_CONF = {
    # Un-zoned trip timestamps; every date part is taken on the wall clock.
    "spark.sql.session.timeZone": "UTC",
    # Division by zero and overflowing casts raise instead of silently
    # producing NULL; the operators guard every division explicitly.
    "spark.sql.ansi.enabled": "true",
    # Runtime re-planning: coalesce small shuffle partitions, split skewed
    # join partitions, switch to broadcast when a side turns out small.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.parquet.filterPushdown": "true",
}

# Starting points for a large cluster (100 TB of trips). Shuffle partitions
# are only the initial count; AQE coalesces them to the advisory size.
CLUSTER_CONF = {
    "spark.sql.shuffle.partitions": "20000",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
    "spark.sql.files.maxPartitionBytes": "256m",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "4",
    "spark.sql.files.maxRecordsPerFile": "20000000",
}


def configure(spark: SparkSession) -> SparkSession:
    for key, value in SEMANTIC_CONF.items():
        spark.conf.set(key, value)
    return spark


def build_session(master: str | None = None, app_name: str = "farebox",
                  shuffle_partitions: int | None = None,
                  extra: dict[str, str] | None = None, cluster: bool = False) -> SparkSession:
    """Session with the UI off, UTC, AQE on; ``cluster`` starts from CLUSTER_CONF."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    builder = (builder.config("spark.ui.enabled", "false")
               # Checkpoint files of collected DataFrames are removed as they go.
               .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true"))
    for key, value in (SEMANTIC_CONF | (CLUSTER_CONF if cluster else {})).items():
        builder = builder.config(key, value)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for key, value in (extra or {}).items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return configure(spark)


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder the cluster names in ``spark.checkpoint.dir``.

    Only when the session has none and runs in local mode (tests, local runs)
    is a folder of our own set; a cluster session without one is an error,
    since a machine-local folder is not shared by the executors.
    """
    try:
        sc = spark.sparkContext
    except Exception:  # Spark Connect: no SparkContext on the client
        sc = None
    current = sc.getCheckpointDir() if sc is not None else None
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        if sc is not None:
            sc.setCheckpointDir(configured)
        return configured
    master = spark.conf.get("spark.master", "local")
    if not master.startswith("local"):
        # A machine-local folder is not reachable from other executors.
        raise RuntimeError("set spark.checkpoint.dir to a shared folder (HDFS, object store) "
                           "for this cluster session")
    local = tempfile.mkdtemp(prefix="farebox-ckpt-")
    if sc is not None:
        sc.setCheckpointDir(local)
        return sc.getCheckpointDir() or local
    return local


def session_key(spark: SparkSession) -> tuple:
    """Identity of a session for per-session plan reuse."""
    try:
        return (id(spark), spark.sparkContext.applicationId)
    except Exception:
        return (id(spark), spark.conf.get("spark.app.id", ""))


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique location under the checkpoint folder."""
    base = checkpoint_dir(spark).rstrip("/")
    return os.path.join(base, "farebox-scratch", f"{name}-{uuid.uuid4().hex[:12]}")
