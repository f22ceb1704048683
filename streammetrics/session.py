"""Session helpers: building a session and locating the shared work folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"


def build_session(master: str | None = None, app: str = "streammetrics",
                  shuffle_partitions: int | None = None, **conf: str) -> SparkSession:
    """Session with AQE on and the UI off; ``master`` only for local runs."""
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    settings = {
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
    }
    if shuffle_partitions:
        settings["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    settings.update(conf)
    for k, v in settings.items():
        b = b.config(k, v)
    return b.getOrCreate()


def work_dir(spark: SparkSession) -> str:
    """Shared folder for checkpoints and written intermediate tables.

    The cluster names it in ``spark.checkpoint.dir``; only when that is unset in
    a local session (tests, development) a fresh local folder is created and
    registered. A cluster session without the setting is an error.
    """
    d = spark.conf.get(CHECKPOINT_CONF, None) or spark.sparkContext.getConf().get(CHECKPOINT_CONF, None)
    if not d:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError(f"set {CHECKPOINT_CONF} to a folder shared by the cluster")
        d = tempfile.mkdtemp(prefix="streammetrics-")
        spark.conf.set(CHECKPOINT_CONF, d)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(d)
    return d.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, unique sub-folder of the shared work folder."""
    return f"{work_dir(spark)}/{name}-{uuid.uuid4().hex[:12]}"


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def exists(spark: SparkSession, path: str) -> bool:
    """Whether a path exists on the cluster file system (Hadoop FileSystem API)."""
    fs, p = _fs(spark, path)
    return bool(fs.exists(p))


def delete(spark: SparkSession, path: str) -> bool:
    """Recursively delete a path on the cluster file system."""
    fs, p = _fs(spark, path)
    return bool(fs.delete(p, True))


def move(spark: SparkSession, source: str, target: str) -> None:
    """Rename a path on the cluster file system, making the target's parent folders."""
    fs, p = _fs(spark, source)
    to = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(target)
    fs.mkdirs(to.getParent())
    if not fs.rename(p, to):
        raise OSError(f"cannot rename {source} to {target}")


def make_folder(spark: SparkSession, path: str) -> None:
    """Make a folder on the cluster file system if it isn't there."""
    fs, p = _fs(spark, path)
    fs.mkdirs(p)


def list_partitions(spark: SparkSession, path: str, column: str) -> list[int]:
    """Integer values of the ``column=value`` sub-folders of a partitioned table."""
    fs, p = _fs(spark, path)
    if not fs.exists(p):
        return []
    out = []
    prefix = column + "="
    for st in fs.listStatus(p):
        name = st.getPath().getName()
        if st.isDirectory() and name.startswith(prefix):
            try:
                out.append(int(name[len(prefix):]))
            except ValueError:
                pass
    return sorted(out)


def child_names(spark: SparkSession, path: str) -> list[str]:
    """Names of the entries of a folder; none if it isn't there."""
    fs, p = _fs(spark, path)
    return [st.getPath().getName() for st in fs.listStatus(p)] if fs.exists(p) else []


def size_of(spark: SparkSession, path: str) -> int:
    """Bytes of all files below a path."""
    fs, p = _fs(spark, path)
    return int(fs.getContentSummary(p).getLength())


def read_small_file(spark: SparkSession, path: str) -> str:
    """Text of one small file (a manifest)."""
    fs, p = _fs(spark, path)
    stream = fs.open(p)
    try:
        return bytes(spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toByteArray(stream)).decode()
    finally:
        stream.close()


def write_small_file(spark: SparkSession, path: str, text: str) -> None:
    """Write one small file (a manifest) that appears whole: written under a hidden name, then renamed."""
    fs, p = _fs(spark, path)
    hidden = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(p.getParent(), f".{p.getName()}-{uuid.uuid4().hex[:8]}")
    stream = fs.create(hidden, True)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()
    if not fs.rename(hidden, p):
        raise OSError(f"cannot rename to {path}")


__all__ = ["build_session", "child_names", "make_folder", "move", "read_small_file", "size_of", "work_dir", "scratch_path",
           "exists", "delete", "list_partitions", "write_small_file"]
