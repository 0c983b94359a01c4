"""Folders on shared storage: scratch space, staged frames, and looking at what a path holds."""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from datetime import datetime, timedelta, timezone
from typing import NamedTuple

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession

from tierlake.functions.sizing import TASK_ROWS

_TIME = "%Y%m%dT%H%M%S%f"


def unique_name(prefix: str, after: str | None = None) -> str:
    """A fresh name; names with the same prefix sort by the time they were made.

    after: a name with the prefix, made by another machine perhaps, that the new one must sort behind whatever the clocks say.
    """
    now = datetime.now(timezone.utc)
    if after is not None and (last := name_time(after, prefix)) is not None:
        now = max(now, last + timedelta(microseconds=1))
    return f"{prefix}{now:{_TIME}}_{uuid.uuid4().hex[:8]}"


def name_time(name: str, prefix: str) -> datetime | None:
    """When `unique_name` made a name; None for any other name."""
    if not re.fullmatch(rf"{re.escape(prefix)}\d{{8}}T\d{{12}}_[0-9a-f]{{8}}", name):
        return None
    return datetime.strptime(name.removeprefix(prefix).partition("_")[0], _TIME).replace(tzinfo=timezone.utc)


def one_process(spark: SparkSession) -> bool:
    """Whether driver and executors are the same process, so that its memory and its folders serve for both."""
    master = spark.conf.get("spark.master", "")
    return master == "local" or master.startswith("local[")


def scratch_folder(spark: SparkSession) -> str:
    """A fresh folder name below `spark.checkpoint.dir`, which every executor can reach.

    Only a session in one process may do without that setting; it uses its warehouse folder.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not one_process(spark):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        root = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/.scratch"
    return f"{root.rstrip('/')}/{unique_name('tierlake_')}"


class Staged(NamedTuple):
    frame: DataFrame
    stored_bytes: int


@contextmanager
def staged(df: DataFrame) -> Iterator[Staged]:
    """`df` written once and read back, for a plan that needs it several times.

    A live source gives other rows each time it is asked; the copy gives the same ones, has a known size for
    Spark to plan with, and survives a lost executor. It is deleted at the end of the block.
    """
    spark, folder = df.sparkSession, scratch_folder(df.sparkSession)
    path, files = _file_system(spark, folder)
    try:
        df.write.option("maxRecordsPerFile", TASK_ROWS).parquet(folder)
        size = files.getContentSummary(path).getLength()
        yield Staged(spark.read.schema(df.schema).parquet(folder), size)
    finally:
        files.delete(path, True)


def committed_folders(spark: SparkSession, path: str, marker: str = "_SUCCESS") -> list[str]:
    """Folders below `path` that a finished Spark write, or the file `marker`, has marked as complete, oldest name first."""
    pattern, files = _file_system(spark, f"{path}/*/{marker}")
    found = files.globStatus(pattern) or []
    return sorted(status.getPath().getParent().toString() for status in found)


def write_text(spark: SparkSession, name: str, text: str, overwrite: bool = True) -> None:
    path, files = _file_system(spark, name)
    out = files.create(path, overwrite)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()


def read_text(spark: SparkSession, name: str) -> str | None:
    """What a small file holds; None if there is none."""
    path, files = _file_system(spark, name)
    if not files.exists(path):
        return None
    opened = files.open(path)
    try:
        return bytes(opened.readAllBytes()).decode()
    finally:
        opened.close()


def remove_folder(spark: SparkSession, name: str) -> None:
    """Delete a folder with all in it, or a file."""
    path, files = _file_system(spark, name)
    files.delete(path, True)


def make_folder(spark: SparkSession, name: str) -> None:
    path, files = _file_system(spark, name)
    files.mkdirs(path)


def rename(spark: SparkSession, name: str, to: str) -> bool:
    """Whether the file was there and has been renamed."""
    path, files = _file_system(spark, name)
    try:
        return files.rename(path, _file_system(spark, to)[0])
    except Py4JJavaError as failed:
        if "FileNotFound" in failed.java_exception.getClass().getName():
            return False
        raise


def plain_path(spark: SparkSession, name: str) -> str:
    """A path the way the file system spells it, so that two spellings of one path compare equal."""
    path, files = _file_system(spark, name)
    return files.makeQualified(path).toString().rstrip("/")


def folder_names(spark: SparkSession, path: str) -> list[str]:
    """Names of what lies directly in `path`."""
    folder, files = _file_system(spark, path)
    return [status.getPath().getName() for status in files.listStatus(folder)]


def _file_system(spark: SparkSession, name: str):
    path = spark._jvm.org.apache.hadoop.fs.Path(name)
    return path, path.getFileSystem(spark._jsc.hadoopConfiguration())
