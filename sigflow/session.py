"""Session and scratch-folder helpers.

Scratch data (staged inputs, stream checkpoints, topic files) lives under the
shared folder the cluster names in ``spark.checkpoint.dir``. Only when that
setting is missing (a bare local session, as in tests) do we create one.
"""

from __future__ import annotations

import hashlib
import tempfile
import uuid

from pyspark.sql import SparkSession


def build_session(
    master: str = "local[*]",
    shuffle_partitions: int = 8,
    app_name: str = "sigflow",
    extra: dict | None = None,
) -> SparkSession:
    """Session for tests and the bench. On a cluster the caller passes its own."""
    builder = (
        SparkSession.builder.master(master)
        .appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    for key, value in (extra or {}).items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def scratch_root(spark: SparkSession) -> str:
    """Shared scratch folder: ``spark.checkpoint.dir`` (or the checkpoint
    folder already set on the context). Only a local session without one
    (tests) gets a new folder here; a cluster session without it is an
    error."""
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            # A machine-local folder is not shared by the executors.
            raise ValueError("set spark.checkpoint.dir to a shared folder (HDFS, object store)")
        # spark.checkpoint.dir cannot change at run time; the context's
        # checkpoint folder can, and later calls find it there.
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="run-", dir="/tmp"))
        root = spark.sparkContext.getCheckpointDir()
    return root.rstrip("/")


def new_scratch_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder under the scratch root; never reused, never cleared."""
    return f"{scratch_root(spark)}/sigflow/{name}-{uuid.uuid4().hex[:12]}"


def _hadoop_path(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    fs = hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return fs, hpath


def path_exists(spark: SparkSession, path: str) -> bool:
    """Existence check through the cluster file system (local, HDFS, object store)."""
    fs, hpath = _hadoop_path(spark, path)
    return bool(fs.exists(hpath))


def publish(spark: SparkSession, written: str, path: str) -> None:
    """Rename a written folder to its published name; if another application
    was first, its folder stays."""
    fs, source = _hadoop_path(spark, written)
    target = _hadoop_path(spark, path)[1]
    fs.mkdirs(target.getParent())
    if not fs.exists(target) and not fs.rename(source, target) and not fs.exists(target):
        raise OSError(f"could not publish {path}")


def file_paths(spark: SparkSession, path: str) -> list:
    """The files below a folder (or the file itself) as Hadoop paths; none if
    it does not exist. Hidden folders are left out."""
    fs, root = _hadoop_path(spark, path)
    if not fs.exists(root):
        return []
    found, waiting = [], [fs.getFileStatus(root)]
    while waiting:
        at = waiting.pop()
        if at.isFile():
            found.append(at.getPath())
        elif at.getPath() == root or not at.getPath().getName().startswith(("_", ".")):
            waiting += list(fs.listStatus(at.getPath()))
    return found


def file_signature(spark: SparkSession, path: str) -> str | None:
    """A hash of the names, sizes and modification times of a file, or of all
    files below a folder, through the cluster file system; None when it does
    not exist."""
    fs, hpath = _hadoop_path(spark, path)
    if not fs.exists(hpath):
        return None
    found, files = [], fs.listFiles(hpath, True)
    while files.hasNext():
        f = files.next()
        found.append(f"{f.getPath()}:{f.getLen()}:{f.getModificationTime()}")
    return hashlib.sha256("\n".join(sorted(found)).encode()).hexdigest()[:32]
