"""Session helpers.

Library code never creates a session on its own; these helpers are for tests,
the bench and command-line use.  On a cluster the submitter owns the session
and its settings, including ``spark.checkpoint.dir``.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession


def get_session(master: str | None = None, shuffle_partitions: int = 8, app: str = "podium") -> SparkSession:
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.sources.partitionOverwriteMode", "dynamic")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("PODIUM_DRIVER_MEMORY", "8g"))
        # generated code for wide text expressions can exceed HotSpot's 8000-byte
        # JIT limit and would then run interpreted; let the JIT compile it
        .config("spark.driver.extraJavaOptions", "-XX:-DontCompileHugeMethods")
        .config("spark.executor.extraJavaOptions", "-XX:-DontCompileHugeMethods")
    )
    if master:
        builder = builder.master(master)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    checkpoint_dir(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder for checkpoints and scratch tables.

    Read from ``spark.checkpoint.dir``; only when the session has none and runs
    in one process (local tests) a fresh local folder is created and registered.
    On a cluster an unset folder is an error.
    """
    sc = spark.sparkContext
    path = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if not path and sc.getCheckpointDir() is not None:
        # SparkContext checkpoint folders get a per-application sub-folder; use its parent
        path = sc.getCheckpointDir().rsplit("/", 1)[0]
    if not path:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        path = tempfile.mkdtemp(prefix="podium-ckpt-")
        try:
            spark.conf.set("spark.checkpoint.dir", path)
        except Exception:  # noqa: BLE001 - a session may refuse to change it; the context keeps it
            pass
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(path)
    return path


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh sub-folder of the checkpoint folder (shared on a cluster)."""
    import uuid

    base = checkpoint_dir(spark).rstrip("/")
    return f"{base}/{name}-{uuid.uuid4().hex[:12]}"


def _fs_path(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a file or folder is there, in any file system Spark reads."""
    fs, p = _fs_path(spark, path)
    return fs.exists(p)


def delete_path(spark: SparkSession, path: str) -> None:
    fs, p = _fs_path(spark, path)
    fs.delete(p, True)


def replace_path(spark: SparkSession, new: str, path: str) -> None:
    """Put the folder ``new`` in the place of ``path`` (which may not exist yet)."""
    fs, p = _fs_path(spark, path)
    fs.delete(p, True)
    if not fs.rename(_fs_path(spark, new)[1], p):
        raise OSError(f"cannot rename {new} to {path}")


def child_names(spark: SparkSession, path: str) -> list[str]:
    fs, p = _fs_path(spark, path)
    return [f.getPath().getName() for f in fs.listStatus(p)] if fs.exists(p) else []
