"""Session helpers: UTC semantics, AQE, and the shared checkpoint folder."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile

from pyspark.sql import SparkSession

UTC = "UTC"

# Scratch folders chosen for local applications without spark.checkpoint.dir.
_LOCAL_ROOTS: dict[str, str] = {}


def get_session(master: str | None = None, app_name: str = "daybook",
                shuffle_partitions: int | None = None) -> SparkSession:
    """Build (or reuse) a session with the settings the engine relies on.

    On a cluster leave ``master`` unset so spark-submit decides; the shuffle
    partition count then stays whatever the cluster configured and AQE
    coalesces/splits partitions at runtime.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    builder = (
        builder.config("spark.sql.session.timeZone", UTC)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
    )
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    spark = builder.getOrCreate()
    use_utc(spark)
    return spark


def use_utc(spark: SparkSession) -> None:
    """The reference treats every timestamp as UTC; pin the session zone."""
    if spark.conf.get("spark.sql.session.timeZone", None) != UTC:
        spark.conf.set("spark.sql.session.timeZone", UTC)


def checkpoint_root(spark: SparkSession, allow_local: bool = True) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    The cluster's setting always wins.  Only when it is unset (local runs,
    tests) is a private scratch folder created and registered, so that
    snapshots and checkpoints have somewhere to go.
    """
    # The configured folder, not sc.getCheckpointDir(): Spark adds a fresh
    # per-application subfolder there, which a later run could never find.
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    try:
        sc = spark.sparkContext
    except Exception as exc:                     # e.g. a Spark Connect session
        raise RuntimeError("spark.checkpoint.dir is not set") from exc
    root = sc.getConf().get("spark.checkpoint.dir", None) or _LOCAL_ROOTS.get(sc.applicationId)
    if not root:
        if not allow_local or not sc.master.startswith("local"):
            raise RuntimeError(
                "spark.checkpoint.dir is not set; point it at a shared folder "
                "(e.g. an object-store prefix) visible to every executor")
        root = _LOCAL_ROOTS[sc.applicationId] = tempfile.mkdtemp(prefix="daybook-ckpt-")
        atexit.register(shutil.rmtree, root, ignore_errors=True)
        sc.setCheckpointDir(root)
    return root.rstrip("/")


def delete_folder(spark: SparkSession, uri: str) -> None:
    """Remove a folder on any Hadoop file system; nothing happens if it is gone."""
    path = spark._jvm.org.apache.hadoop.fs.Path(uri)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def local_path(uri: str) -> str | None:
    """Filesystem path for a ``file:`` URI or bare path; None for remote stores."""
    if uri.startswith("file:"):
        return uri[len("file:"):]
    if "://" in uri:
        return None
    return uri if os.path.isabs(uri) else os.path.abspath(uri)
