"""What the operators of this package share: stored steps, folds, and words of many texts as numpy arrays."""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tierlake.functions.storage import scratch_folder

#: Bytes of text that a task looks at together; a longer text comes alone.
PIECE_BYTES = 1 << 20
#: Bytes of rows that are sent to Python together; a larger row comes alone.
BATCH_BYTES = 8 << 20


_LIBC = ctypes.CDLL(None) if hasattr(ctypes.CDLL(None), "malloc_trim") else None


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame) -> DataFrame:
    """`df` written once below `spark.checkpoint.dir` and read back: computed once, and safe from lost executors.

    Spark deletes the shuffle files of a finished step when the driver's garbage collector finds that nothing refers to
    them any more, so it is asked to look; otherwise the files of all steps of a query add up.
    """
    spark, folder = df.sparkSession, scratch_folder(df.sparkSession)
    with _small_batches(spark):
        df.write.option("compression", "zstd").parquet(folder)
    gc.collect()
    spark._jvm.System.gc()
    return spark.read.schema(df.schema).parquet(folder)


@contextmanager
def _small_batches(spark: SparkSession) -> Iterator[None]:
    """Batches for Python by their bytes, as ten thousand long texts or lists are more than a task should hold twice."""
    setting = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(setting)
    spark.conf.set(setting, str(BATCH_BYTES))
    try:
        yield
    finally:
        spark.conf.set(setting, before)


def columns(df: DataFrame) -> list[Column]:
    """All columns by their names, whatever characters these hold."""
    return [F.col(f"`{name.replace('`', '``')}`") for name in df.columns]


def fresh(df: DataFrame, *names: str) -> list[str]:
    """Names like `names` that no column of `df` has, in whatever case."""
    taken = {name.lower() for name in df.columns}
    found = []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        found.append(name)
    return found


def held_out(doc_id: str | Column = "doc_id") -> Column:
    """Whether a document is kept from training: crc32 of its id as text leaves 2 by 4. False for a NULL id."""
    column = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.coalesce(F.crc32(column.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def for_training(docs: DataFrame) -> DataFrame:
    """Rows that a model may learn from; those without an id belong to no fold and are left out."""
    return docs.filter(F.col("doc_id").isNotNull() & ~held_out())


def pieces(batches, column: str = "text", most: int = PIECE_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of Arrow batches with about `most` bytes of `column` each, so that memory follows no batch's length."""
    for batch in batches:
        if not batch.num_rows:
            continue
        _, offsets = utf8(batch.column(column))
        start = 0
        while start < batch.num_rows:
            end = int(np.searchsorted(offsets, offsets[start] + most, side="right")) - 1
            end = min(max(end, start + 1), batch.num_rows)
            yield batch.slice(start, end - start)
            start = end
    _release()


def _release() -> None:
    """Give back what a finished task has freed: an idle worker would keep it from the executor's next tasks."""
    pa.default_memory_pool().release_unused()
    if _LIBC is not None:
        _LIBC.malloc_trim(0)


def utf8(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts end to end, and where each begins (one more offset than texts). NULL is empty."""
    texts = texts.cast(pa.large_binary())
    if texts.null_count:
        texts = texts.fill_null(b"")
    _, offsets, data = texts.buffers()
    if not len(texts):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    at = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    whole = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return whole[at[0] : at[-1]], at - at[0]


def runs(inside: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the maximal runs of true bytes, which never cross from one text into the next."""
    if not len(inside):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    last = inside.copy()
    last[:-1] &= ~inside[1:]
    borders = offsets[1:-1]
    borders = borders[(borders > 0) & (borders < len(inside))]
    first[borders] = inside[borders]
    last[borders - 1] = inside[borders - 1]
    return np.flatnonzero(first), np.flatnonzero(last) + 1


_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_powers: list[np.ndarray] = []


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers 0 .. n of the hash's base and of its inverse, modulo 2^64."""
    if not _powers or len(_powers[0]) <= n:
        size = max(n + 1, PIECE_BYTES + (1 << 16))
        both = []
        for base in (_BASE, _INVERSE):
            power = np.full(size, base, np.uint64)
            power[0] = 1
            both.append(np.cumprod(power, dtype=np.uint64))
        _powers[:] = both
    return _powers[0], _powers[1]


def mixed(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values."""
    x = x ^ (x >> np.uint64(31))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(29)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(32)
    return x


def prefix_sums(data: np.ndarray) -> np.ndarray:
    """Sums from which `span_hashes` takes the polynomial hash of any span."""
    power, _ = powers(len(data))
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * power[: len(data)], out=sums[1:])
    return sums


def span_hashes(sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each span's bytes, wherever the span lies."""
    _, inverse = powers(len(sums) - 1)
    return mixed((sums[ends] - sums[starts]) * inverse[starts] + (ends - starts).astype(np.uint64))


def as_list(offsets: np.ndarray, values: np.ndarray, kind: pa.DataType) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(values, kind))
