"""Sizes of inputs, and the session settings that should follow from them."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tierlake.functions.names import column_name

# Rows take about this many times their size in parquet once they are shuffled.
_GROWTH = 3
_BYTES_PER_TASK = 512 * 1024**2
# Beyond this the bookkeeping of a shuffle costs more than larger tasks, which can spill.
_MOST_PARTITIONS = 50_000
# Files may hold a row in a few bytes, so a plan that fixes its partitions has one for so many bytes of them, up to a number
# that is cheap to keep; below the least size there is nothing to fix.
_FILE_BYTES_PER_PART, _MANY_PARTS, _LEAST_BYTES = 2 * 1024**2, 4_000, 32 * 1024**2
# Rows of one task, and of one file, where bytes say little about what rows take in memory.
TASK_ROWS = 1_000_000
# What a row and a column of fixed size take in memory, at most.
_ROW_BYTES, _COLUMN_BYTES = 16, 16


def size_setting(spark: SparkSession, setting: str) -> int:
    """A size setting in bytes; below zero when switched off."""
    text = spark.conf.get(setting)
    return -1 if text.startswith("-") else spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(text)


def planned_bytes(df: DataFrame) -> int | None:
    """The size of all inputs of `df`, exact for files; None if Spark does not know the size of one, such as a JDBC table.

    Spark's own size of a join is the product of its sides, which says nothing about what is shuffled.
    """
    unknown = df.sparkSession._jsparkSession.sessionState().conf().defaultSizeInBytes()
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    sizes = [int(leaves.apply(i).stats().sizeInBytes()) for i in range(leaves.size())]
    return None if any(size >= unknown for size in sizes) else sum(sizes)


def added(*sizes: int | None) -> int | None:
    """The sum of some sizes; None if one is not known."""
    return None if None in sizes else sum(sizes)


def row_bytes(schema: T.StructType) -> Column:
    """About what a row takes in memory: its texts and binaries count with their length, nested values with that of their JSON."""
    total = F.lit(_ROW_BYTES + _COLUMN_BYTES * len(schema.fields)).cast("long")
    for field in schema.fields:
        column = F.col(column_name(field.name))
        if isinstance(field.dataType, (T.StringType, T.BinaryType)):
            total += F.coalesce(F.octet_length(column), F.lit(0))
        elif isinstance(field.dataType, (T.StructType, T.ArrayType, T.MapType)):
            total += F.coalesce(F.octet_length(F.to_json(column)), F.lit(0)) * 2
        elif isinstance(field.dataType, T.AtomicType) and field.dataType.typeName() == "variant":
            total += F.coalesce(F.octet_length(column.cast("string")), F.lit(0)) * 2
    return total


def fits_broadcast(spark: SparkSession, rows_in_memory: int) -> bool:
    """Whether rows of this measured size are within Spark's limit for a broadcast side."""
    return 0 <= rows_in_memory <= size_setting(spark, "spark.sql.autoBroadcastJoinThreshold")


def fixed_parts(spark: SparkSession, stored_bytes: int | None) -> int | None:
    """How many partitions a plan should fix for files of this size; None if Spark's own choice will do or the size is not known.

    Adaptive execution joins partitions by their compressed size, which for rows that compress well is a small part of
    what a task then sorts and hashes.
    """
    if stored_bytes is None or stored_bytes < _LEAST_BYTES:
        return None
    few = min(stored_bytes // _FILE_BYTES_PER_PART, _MANY_PARTS)
    many = min(stored_bytes * _GROWTH // _BYTES_PER_TASK, _MOST_PARTITIONS)
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), few, many)


@contextmanager
def room_to_shuffle(
    spark: SparkSession, stored_bytes: int | None, multiple_of: int = 1, rows: int | None = None
) -> Iterator[int]:
    """Raise the number of shuffle partitions, while the block lasts, to what `stored_bytes` of input need.

    The number is never lowered, and stays if the size is not known; adaptive execution joins partitions that turn out small, and it is a multiple of
    `multiple_of`, so that the partitions of a hash shuffle nest with as many hash buckets. The settings are the
    session's, so blocks in one session must not overlap.

    rows: how many rows these bytes are. Where rows compress well, the sizes by which Spark cuts files, joins partitions
        and finds and splits hot ones are lowered to those of `TASK_ROWS` rows, so that a task's memory does not follow the compression.
    """
    setting = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
    if spark.conf.get(setting, None) is None:
        setting = "spark.sql.shuffle.partitions"
    sizes = {} if rows is None or stored_bytes is None else _sizes_of_tasks(spark, stored_bytes, rows)
    before = {name: spark.conf.get(name) for name in (setting, *sizes)}
    wanted = max((stored_bytes or 0) * _GROWTH // _BYTES_PER_TASK, (rows or 0) // TASK_ROWS)
    wanted = max(int(before[setting]), min(wanted, _MOST_PARTITIONS))
    partitions = -(-wanted // multiple_of) * multiple_of
    try:
        for name, value in {setting: partitions, **sizes}.items():
            spark.conf.set(name, str(value))
        yield partitions
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)


def _sizes_of_tasks(spark: SparkSession, stored_bytes: int, rows: int) -> dict[str, int]:
    """Size settings under which a task gets about `TASK_ROWS` rows, given their size in files; only those to be lowered."""
    task = max(1, stored_bytes * TASK_ROWS // max(rows, TASK_ROWS))
    wanted = {
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": task,
        "spark.sql.adaptive.coalescePartitions.minPartitionSize": task,
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": 4 * task,
        "spark.sql.files.maxPartitionBytes": task + size_setting(spark, "spark.sql.files.openCostInBytes"),
    }
    return {name: size for name, size in wanted.items() if rows > TASK_ROWS and size < size_setting(spark, name)}
