"""Intermediate tables in the folder all executors share."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterable, Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

_LOCAL_FOLDERS: dict[str, str] = {}
_SCOPE: ContextVar[str | None] = ContextVar("martline_stages", default=None)


def shared_folder(spark: SparkSession) -> str:
    """The folder named in ``spark.checkpoint.dir``.

    Only a local session without that setting gets a temporary folder: on a
    cluster a machine-local folder would be lost with its machine.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder all executors can reach")
    app = spark.sparkContext.applicationId
    if app not in _LOCAL_FOLDERS:
        _LOCAL_FOLDERS[app] = tempfile.mkdtemp(prefix="martline-")
    return _LOCAL_FOLDERS[app]


def new_path(spark: SparkSession, name: str) -> str:
    """An unused path in the shared folder."""
    root = _SCOPE.get() or f"{shared_folder(spark)}/martline/{spark.sparkContext.applicationId}"
    return f"{root}/{name}-{uuid.uuid4().hex}"


def stage(df: DataFrame, name: str = "stage", codec: str | None = None) -> DataFrame:
    """Write ``df`` once as a Parquet table and read it back.

    Later steps start from the written rows, so a lost executor never causes the
    upstream work to run again, and two readers always see the same values. ``codec``
    is the compression, the session's if none is named.
    """
    return stage_all([df], name, codec)


def stage_all(frames: Iterable[DataFrame], name: str = "stage", codec: str | None = None) -> DataFrame:
    """``stage`` of frames with the same columns, at least one, one after the other into one table."""
    path = None
    for df in frames:
        path = path or new_path(df.sparkSession, name)
        df.write.mode("append").parquet(path, compression=codec)
    return df.sparkSession.read.schema(df.schema).parquet(path)


#: Spark's setting to delete the shuffle files of a query when it ends.
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_freed(spark: SparkSession) -> Iterator[None]:
    """Delete the shuffle files of each query that ends inside the block, so that steps do not add up on disk.

    Only for blocks that run no frame twice. The session's setting is put back at the end.
    """
    before = spark.conf.get(_CLEANUP, None)
    spark.conf.set(_CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.unset(_CLEANUP) if before is None else spark.conf.set(_CLEANUP, before)


@contextmanager
def temporary_stages(spark: SparkSession) -> Iterator[None]:
    """Delete what is staged inside the block when it ends.

    Only for blocks whose results are written to tables of their own.
    """
    folder = new_path(spark, "scope")
    token = _SCOPE.set(folder)
    try:
        yield
    finally:
        _SCOPE.reset(token)
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
