"""Session checks and the shared scratch area for staged tables."""

from __future__ import annotations

import atexit
import tempfile
import uuid
import weakref
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

_DIR_CONF = "spark.checkpoint.dir"
#: Drops a job's shuffle files when it ends; what a staged table was made from is not read again.
_CLEAN_CONF = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_local_dirs: dict[str, str] = {}
_paths: dict[str, SparkSession] = {}
_staged: weakref.WeakKeyDictionary[DataFrame, str] = weakref.WeakKeyDictionary()


def require_utc(spark: SparkSession) -> None:
    zone = spark.conf.get("spark.sql.session.timeZone")
    if zone not in ("UTC", "Etc/UTC", "Z", "GMT"):
        raise RuntimeError(f"spark.sql.session.timeZone must be UTC, found {zone!r}")


def scratch_root(spark: SparkSession) -> str:
    """The shared folder the session names in ``spark.checkpoint.dir``.

    Only a local-mode session without that setting gets a temporary folder of its own.
    """
    named = spark.conf.get(_DIR_CONF, None) or spark.sparkContext.getConf().get(_DIR_CONF)
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError(f"set {_DIR_CONF} to a folder that all executors share")
    app = spark.sparkContext.applicationId
    if app not in _local_dirs:
        _local_dirs[app] = tempfile.mkdtemp(prefix="barlake-")
    return _local_dirs[app]


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new folder name; the folder goes with the session at the latest."""
    path = f"{scratch_root(spark)}/{label}-{uuid.uuid4().hex}"
    if not _paths:
        atexit.register(_drop_left_over)
    _paths[path] = spark
    return path


def _delete(spark: SparkSession, path: str) -> None:
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)
    _paths.pop(path, None)


def _drop_left_over() -> None:
    """Deletes what lazily returned frames still needed; a session that has ended is left alone."""
    for path, spark in list(_paths.items()):
        if spark.sparkContext._jsc is None:
            break
        _delete(spark, path)


@contextmanager
def session_conf(spark: SparkSession, name: str, value: str) -> Iterator[None]:
    """A setting of the session for what runs meanwhile."""
    before = spark.conf.get(name, None)
    spark.conf.set(name, value)
    try:
        yield
    finally:
        spark.conf.unset(name) if before is None else spark.conf.set(name, before)


def stage(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    Cuts lineage without depending on executor-local storage, and keeps the
    columnar layout so that later reads still prune columns. Shuffle files of the write
    go with it; a frame that is executed again afterwards is computed anew.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    with session_conf(spark, _CLEAN_CONF, "true"):
        df.write.parquet(path)
    stored = spark.read.schema(df.schema).parquet(path)
    _staged[stored] = path
    return stored


def staged_paths(spark: SparkSession) -> set[str]:
    """Folders that this session has staged and not yet deleted."""
    return {path for path, owner in _paths.items() if owner is spark}


def release(spark: SparkSession, paths: set[str], reader: DataFrame) -> None:
    """Delete those of ``paths`` that ``reader`` does not read; none if it shows no files at all."""
    own = _staged.get(reader)
    read = reader.inputFiles() if paths else []
    if not read and own is None:
        return
    for path in paths & set(_paths) - {own}:
        name = path.rsplit("/", 1)[1]  # unique, and independent of how a file system writes its urls
        if not any(f"/{name}/" in file for file in read):
            _delete(spark, path)


def unstage(spark: SparkSession, *frames: DataFrame) -> None:
    """Delete tables written by ``stage`` once nothing reads them any more."""
    for frame in frames:
        _delete(spark, _staged.pop(frame))
