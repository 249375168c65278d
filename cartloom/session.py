"""Session construction and the shared working folder.

On a cluster the shared folder comes from ``spark.checkpoint.dir`` (set by the
cluster); only when it is unset (local tests) do we create one.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark import SparkConf, SparkContext
from pyspark.sql import SparkSession

# Settings that matter at scale; all are plain Spark SQL confs.
DEFAULT_CONF = {
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Partial aggregation stays on; files are split at 128 MB for scans.
    "spark.sql.files.maxPartitionBytes": str(128 * 1024 * 1024),
    # Arrow only matters for toPandas in tests.
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def build_session(master: str | None = None, shuffle_partitions: int = 8,
                  app_name: str = "cartloom", extra: dict | None = None) -> SparkSession:
    """Create (or reuse) a session with the engine's defaults.

    Defaults are set only where the submission has not set them, and not at all on a
    running session; ``master`` is only set when given, so ``spark-submit`` keeps
    control on a cluster. ``extra`` is set as given.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = {}
    if SparkSession.getActiveSession() is None:
        SparkContext._ensure_initialized()  # so that SparkConf sees the submission
        submitted = SparkConf()
        defaults = DEFAULT_CONF | {"spark.sql.shuffle.partitions": str(shuffle_partitions)}
        conf = {k: v for k, v in defaults.items() if not submitted.contains(k)}
    conf.update(extra or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    sc = _context(spark)
    if sc is not None:
        sc.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def _context(spark: SparkSession):
    """The SparkContext of a classic session; None under Spark Connect."""
    try:
        return spark.sparkContext
    except Exception:  # noqa: BLE001 - Spark Connect sessions have no SparkContext
        return None


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared folder for checkpoints and intermediate tables.

    Reads ``spark.checkpoint.dir``; sets a local one only if the session has none
    (as in unit tests on ``local[*]``).
    """
    sc = _context(spark)
    current = sc.getCheckpointDir() if sc is not None else None
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if sc is None:
        if not configured:
            raise RuntimeError("spark.checkpoint.dir must name a shared folder")
        return configured
    if not configured:
        if not sc.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
        configured = tempfile.mkdtemp(prefix="cartloom-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir()


def session_key(spark: SparkSession) -> str:
    """An id of the running application (or Connect session) for per-session memos."""
    sc = _context(spark)
    if sc is not None:
        return sc.applicationId
    return getattr(spark, "session_id", None) or str(id(spark))


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder under the shared checkpoint folder."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/cartloom/{name}-{uuid.uuid4().hex}"


def local_path(path: str) -> str:
    """Strip a ``file:`` scheme (for tests that inspect files)."""
    return path[len("file:"):] if path.startswith("file:") else path


__all__ = ["build_session", "ensure_checkpoint_dir", "scratch_path", "session_key", "local_path"]
