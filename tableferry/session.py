"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import threading
import uuid
import warnings
from contextlib import contextmanager

from pyspark.sql import SparkSession


def local_session(cores: int | str = "*", app: str = "tableferry", **conf: str) -> SparkSession:
    """A session for tests and benchmarks on one machine; clusters bring their own."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.adaptive.enabled", "true")
    )
    for name, value in conf.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors can reach, as named by ``spark.checkpoint.dir``.

    A machine-local temporary folder is used only when the setting is absent and
    the whole application runs on this machine. On a cluster a folder of the local
    file system must be a mount that all machines share, which cannot be seen from
    here, so it is warned about.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    on_cluster = not spark.sparkContext.master.startswith("local")
    if base:
        if on_cluster and filesystem(spark, base)[0].getScheme() == "file":
            warnings.warn(f"{base} must be mounted on all machines of the cluster", stacklevel=2)
        return base.rstrip("/")
    if on_cluster:
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="tableferry-"))
    return spark.sparkContext.getCheckpointDir()


def filesystem(spark: SparkSession, location: str):
    """The file system holding ``location``, and ``location`` as its path."""
    path = spark._jvm.org.apache.hadoop.fs.Path(location)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()), path


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A new, not yet existing path in the shared folder, removed when the driver exits.

    :func:`clear_scratch` removes all of them earlier, once their readers are done.
    """
    location = f"{shared_dir(spark)}/tableferry/{name}-{uuid.uuid4().hex}"
    _scratch.append(location)
    fs, path = filesystem(spark, location)
    # deleteOnExit only accepts a path that exists.
    fs.mkdirs(path)
    fs.deleteOnExit(path)
    return f"{location}/data"


_scratch: list[str] = []


def clear_scratch(spark: SparkSession) -> None:
    """Remove the scratch folders made so far; results that still read them are of no use afterwards."""
    while _scratch:
        fs, path = filesystem(spark, _scratch.pop())
        fs.delete(path, True)


_lock = threading.Lock()
_held: dict[tuple, tuple[int, str | None]] = {}


@contextmanager
def setting(spark: SparkSession, name: str, value: str):
    """Run an action with a session setting; the last of parallel users puts the old value back."""
    slot = (id(spark._jsparkSession), name)
    with _lock:
        users, before = _held.get(slot, (0, spark.conf.get(name, None)))
        _held[slot] = (users + 1, before)
        spark.conf.set(name, value)
    try:
        yield
    finally:
        with _lock:
            users, before = _held.pop(slot)
            if users > 1:
                _held[slot] = (users - 1, before)
            elif before is None:
                spark.conf.unset(name)
            else:
                spark.conf.set(name, before)
