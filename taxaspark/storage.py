"""Tables written to the folder that driver and executors share, so that later jobs start from files."""

from __future__ import annotations

import atexit
import tempfile
import threading
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

#: Folders of the tables made inside the innermost open :func:`scratch` of this thread.
_OPEN: ContextVar[list[str] | None] = ContextVar("scratch", default=None)


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: ``spark.checkpoint.dir``.

    Where it is unset, a new local one if Spark runs on one machine; on a cluster that is an error, as executors would write to
    folders that nobody else sees.
    """
    where = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not where:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="taxaspark-"))
        where = spark.sparkContext.getCheckpointDir()
    return where


def _write(df: DataFrame, tag: str) -> tuple[str, DataFrame]:
    spark = df.sparkSession
    folder = f"{shared_dir(spark)}/taxaspark-{uuid.uuid4().hex}"
    with _shuffles_removed(spark):
        df.write.option("compression", "zstd").parquet(f"{folder}/{tag}")
    return folder, spark.read.schema(df.schema).parquet(f"{folder}/{tag}")


#: Of Spark: whether a query's shuffle files go when it ends. Else they stay until the driver happens to collect its garbage.
_REMOVAL = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_WRITERS = threading.Lock()
#: By session, how many tables are being written, and how the setting was before the first.
_WRITING: dict[SparkSession, tuple[int, str | None]] = {}


@contextmanager
def _shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of what is written inside go with its end: the table stands for them."""
    with _WRITERS:
        n, before = _WRITING.get(spark, (0, None))
        if not n:
            before = spark.conf.get(_REMOVAL, None)
            spark.conf.set(_REMOVAL, "true")
        _WRITING[spark] = n + 1, before
    try:
        yield
    finally:
        with _WRITERS:
            n, before = _WRITING.pop(spark)
            if n > 1:
                _WRITING[spark] = n - 1, before
            elif before is None:
                spark.conf.unset(_REMOVAL)
            else:
                spark.conf.set(_REMOVAL, before)


def materialize(df: DataFrame, tag: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: later jobs start from files that survive a lost executor.

    Inside a :func:`scratch` the files are deleted with it. Others back a result that its owner may read at any time, and are deleted
    when the driver ends, if Spark still runs then.
    """
    folder, out = _write(df, tag)
    _owner(df.sparkSession).append(folder)
    return out


def _owner(spark: SparkSession) -> list[str]:
    """The folders that go with the open scratch or, without one, with the driver."""
    folders = _OPEN.get()
    if folders is None:
        if not _LATER:
            atexit.register(_clear)
        folders = _LATER.setdefault(spark.sparkContext.applicationId, [])
    return folders


#: By application, folders of tables that back results.
_LATER: dict[str, list[str]] = {}


def _clear() -> None:
    spark = SparkSession.getActiveSession()
    if spark is None or spark.sparkContext._jsc is None:
        return
    for folder in _LATER.pop(spark.sparkContext.applicationId, []):
        _delete(spark, folder)


def _delete(spark: SparkSession, folder: str) -> None:
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def remove(df: DataFrame) -> None:
    """Delete the files behind a table of :func:`materialize` that no later job reads."""
    for folder in {f.rpartition("/")[0].rpartition("/")[0] for f in df.inputFiles()}:
        if folder.rpartition("/")[2].startswith("taxaspark-"):
            _delete(df.sparkSession, folder)


@contextmanager
def work_folder(spark: SparkSession) -> Iterator[str]:
    """A new folder of the shared storage, deleted at the end with all that is in it."""
    folder = f"{shared_dir(spark)}/taxaspark-{uuid.uuid4().hex}"
    try:
        yield folder
    finally:
        _delete(spark, folder)


@contextmanager
def scratch(spark: SparkSession) -> Iterator[Callable[[DataFrame, str], DataFrame]]:
    """Tables that :func:`materialize` makes inside are deleted at the end; what it yields writes one that stays with those around it."""
    folders, outer = [], _owner(spark)

    def write(df: DataFrame, tag: str) -> DataFrame:
        folder, out = _write(df, tag)
        outer.append(folder)
        return out

    token = _OPEN.set(folders)
    try:
        yield write
    finally:
        _OPEN.reset(token)
        for folder in folders:
            _delete(spark, folder)
