"""Paths, completed writes and materialised intermediate results."""

import os
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyarrow.fs import FileSystem, LocalFileSystem
from pyspark.sql import DataFrame, SparkSession


# Folders named since the innermost open block of ``scratch`` began.
_named: ContextVar[list[str] | None] = ContextVar("named", default=None)


def shared_folder(spark: SparkSession) -> str:
    """Folder for intermediate tables: the session's checkpoint folder.

    A session without one gets a folder in the warehouse, which executors share too.
    """
    context = spark.sparkContext
    folder = context.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if folder is None:
        warehouse = spark.conf.get("spark.sql.warehouse.dir").rstrip("/")
        context.setCheckpointDir(f"{warehouse}/quizloom-checkpoints")
        folder = context.getCheckpointDir()
    return folder.rstrip("/")


def new_name(name: str) -> str:
    return f"quizloom-{name}-{uuid.uuid4().hex}"


def new_folder(spark: SparkSession, name: str = "table") -> str:
    """A path in the shared folder that nothing else uses; the folder is not made."""
    path = f"{shared_folder(spark)}/{new_name(name)}"
    named = _named.get()
    if named is not None:
        named.append(path)
    return path


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """A block whose intermediate tables are removed when it ends, also by an error.

    DataFrames made inside may read such tables, so use them up before the end: write them
    to a folder of your own, collect them, or return them by ``materialise_alone``.
    """
    named: list[str] = []
    token = _named.set(named)
    try:
        yield
    finally:
        _named.reset(token)
        for path in named:
            delete_folder(spark, path)


def delete_folder(spark: SparkSession, path: str) -> None:
    """Remove an intermediate table that no plan reads any more."""
    fs, hadoop_path = _file_system(spark, path)
    fs.delete(hadoop_path, True)


def materialise(df: DataFrame) -> DataFrame:
    """Write the rows as a table in the shared folder and read them from there on.

    Used where rows come from model calls, or where several passes over an expensive
    result would repeat it. Each row is computed once, the copy survives the loss of
    executors, and unlike a checkpoint's rows, later reads fetch only the columns they
    need.
    """
    spark = df.sparkSession
    path = new_folder(spark)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def materialise_alone(spark: SparkSession, make: Callable[[], DataFrame]) -> DataFrame:
    """``materialise(make())`` without the tables that ``make`` and its plan have stored.

    The table itself lives as long as the block of ``scratch`` around the call, if any.
    """
    path = new_folder(spark)
    with scratch(spark):
        df = make()
        df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def _file_system(spark: SparkSession, path: str):
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()), hadoop_path


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, hadoop_path = _file_system(spark, path)
    return fs.exists(hadoop_path)


def is_complete(spark: SparkSession, path: str) -> bool:
    """True if a job finished writing the folder."""
    return path_exists(spark, f"{path.rstrip('/')}/_SUCCESS")


def child_folders(spark: SparkSession, path: str) -> list[str]:
    fs, hadoop_path = _file_system(spark, path)
    if not fs.exists(hadoop_path):
        return []
    return [s.getPath().getName() for s in fs.listStatus(hadoop_path) if s.isDirectory()]


def data_files(spark: SparkSession, path: str) -> list[tuple[str, int]]:
    """Path and bytes of the data files of a stored table, by name."""
    fs, hadoop_path = _file_system(spark, path)
    found = [s for s in fs.listStatus(hadoop_path) if s.isFile()]
    files = [(s.getPath().toString(), s.getLen()) for s in found if s.getPath().getName()[0] not in "._"]
    return sorted(files)


def empty_files(spark: SparkSession, path: str) -> list[str]:
    """Paths of the files without bytes directly in a folder, by name.

    A folder that the driver's machine mounts is listed here, file by file and keeping only
    the empty ones. Elsewhere a file costs one short call to the JVM, for its length.
    """
    fs, hadoop_path = _file_system(spark, path)
    folder = fs.makeQualified(hadoop_path)
    local = folder.toUri().getPath()
    if fs.getScheme() == "file" and os.path.isdir(local):
        with os.scandir(local) as entries:
            empty = [e.name for e in entries if e.is_file() and e.stat().st_size == 0]
        return sorted(f"{folder.toString().rstrip('/')}/{name}" for name in empty if name[0] not in "._")
    empty = [s for s in fs.listStatus(hadoop_path) if s.getLen() == 0]
    found = [s.getPath() for s in empty if s.isFile()]
    return sorted(p.toString() for p in found if p.getName()[0] not in "._")


def open_path(path: str) -> tuple[FileSystem, str]:
    """File system and name of a path, for tasks that read shared files by themselves."""
    if "://" in path:
        return FileSystem.from_uri(path)
    return LocalFileSystem(), path.removeprefix("file:")
