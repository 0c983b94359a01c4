"""Exact duplicates by recipes of content-defined chunks.

Texts are cut where a rolling hash of the last 32 bytes says so, so equal texts are cut alike. Chunks are deduplicated by
their bytes, which turns their hashes into verified identifiers, and documents are then compared by the ordered lists of
these identifiers. Each chunk's bytes take part in one shuffle, after equal ones of a task have been joined; long
documents never move.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tierlake.llm.common import columns, fresh, pieces, stored, utf8

#: Sizes of a chunk in bytes: none is shorter but the last, cuts come every `MEAN_BYTES` or so after that, none is longer.
LEAST_BYTES, MEAN_BYTES, MOST_BYTES = 1024, 2048, 16384

_GEAR = np.random.default_rng(20).integers(0, 1 << 32, 256, dtype=np.uint32)


def cuts(data: np.ndarray, offsets: np.ndarray) -> list[list[int]]:
    """The ends of each text's chunks, counted from the start of `data`."""
    rolling = _GEAR[data]
    for shift in (1, 2, 4, 8, 16):  # the hash then covers 2, 4, 8, 16, 32 bytes
        rolling[shift:] = rolling[shift:] + (rolling[:-shift] << np.uint32(shift))
    marks = np.flatnonzero((rolling >> np.uint32(8)) % np.uint32(MEAN_BYTES) == 0) + 1
    found = []
    for start, end in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True):
        ends, at = [], start
        for mark in marks[np.searchsorted(marks, start + LEAST_BYTES) : np.searchsorted(marks, end)].tolist():
            while mark - at > MOST_BYTES:
                at += MOST_BYTES
                ends.append(at)
            if mark - at >= LEAST_BYTES:
                ends.append(mark)
                at = mark
        while end - at > MOST_BYTES:
            at += MOST_BYTES
            ends.append(at)
        if end > at:
            ends.append(end)
        found.append(ends)
    return found


def _cut(batches):
    for batch in pieces(batches):
        data, offsets = utf8(batch.column("text"))
        ends = cuts(data, offsets)
        raw = data.tobytes()
        chunks = []
        for start, own in zip(offsets.tolist(), ends, strict=False):
            chunks.append([raw[a:b] for a, b in zip([start, *own], own, strict=False)])
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), batch.column("text_sha256"), pa.array(chunks, pa.list_(pa.binary()))],
            ["doc_id", "text_sha256", "chunks"],
        )


def duplicates(docs: DataFrame, hash_of=F.xxhash64) -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256.

    Texts are equal when their bytes are; NULL counts as empty, so all empty and NULL texts are one group. Of a group the
    row with the largest doc_id stays (a NULL id is the smallest); where that id is repeated, exactly one of its rows. Other
    columns are not looked at. An empty table gives no rows. `hash_of` names chunks; chunks that share a name are told
    apart by their bytes, so the result does not depend on it.
    """
    text = F.coalesce("text", F.lit(""))
    cut = docs.select(F.col("doc_id").cast("long"), F.sha2(text, 256).alias("text_sha256"), text.alias("text")).mapInArrow(
        _cut, "doc_id long, text_sha256 string, chunks array<binary>"
    )
    names = F.transform("chunks", lambda c: hash_of(c).cast("long"))
    recipes = stored(
        cut.select("doc_id", "text_sha256", names.alias("recipe"), F.monotonically_increasing_id().alias("row"))
    )
    recipes = _verified(cut, recipes, hash_of)
    # Written out because adaptive execution can only split the rows of a hot group between two plain shuffles.
    groups = stored(
        recipes.groupBy("recipe").agg(F.max(F.struct("doc_id", "row")).alias("keep"), F.count("*").alias("group_size"))
    )
    return recipes.join(groups, "recipe").select(
        "doc_id",
        F.col("keep.doc_id").alias("keep_id"),
        "group_size",
        (F.col("row") == F.col("keep.row")).alias("kept"),
        "text_sha256",
    )


def _verified(cut: DataFrame, recipes: DataFrame, hash_of) -> DataFrame:
    """`recipes` with identifiers that stand for one content each.

    A name that stands for several contents gets a number per content beside it. That hardly happens with 64 bits, and
    what it takes then is only done then.
    """
    contents = cut.select(F.explode("chunks").alias("chunk")).distinct()
    named = contents.select(hash_of("chunk").cast("long").alias("name"), "chunk")
    shared = named.groupBy("name").agg(F.count("*").alias("n")).filter("n > 1")
    shared = stored(shared.select("name"))
    if shared.isEmpty():
        return recipes
    number = F.row_number().over(Window.partitionBy("name").orderBy("chunk"))
    numbered = stored(named.join(shared, "name", "left_semi").withColumn("number", number))
    at = cut.select("text_sha256", F.posexplode("chunks").alias("pos", "chunk"))
    at = at.withColumn("name", hash_of("chunk").cast("long")).join(numbered, ["name", "chunk"], "left")
    part = F.struct("pos", "name", F.coalesce("number", F.lit(0)).cast("long").alias("number"))
    by_text = at.groupBy("text_sha256").agg(F.sort_array(F.collect_set(part)).alias("parts"))
    pairs = F.flatten(F.transform("parts", lambda p: F.array(p["name"], p["number"])))
    by_text = by_text.select("text_sha256", pairs.alias("identified"))
    found = recipes.join(by_text, "text_sha256", "left")
    return stored(found.withColumn("recipe", F.coalesce("identified", "recipe")).drop("identified"))


def keep_one(docs: DataFrame) -> DataFrame:
    """The rows of `docs`, all columns, that stay: of equal texts the row with the largest doc_id.

    NULL is the same text as an empty one. A row without an id stays only if no row with an id has its text. Of several rows with
    the id and the text that stay, one does, chosen by a hash of its columns. Texts may have any length, an empty table gives no
    rows, and columns may have any names.
    """
    kept = duplicates(docs).filter("kept").select("doc_id", "text_sha256").distinct()
    sha, order, n, kept_id, kept_sha = fresh(docs, "sha", "order", "n", "kept_id", "kept_sha")
    keyed = docs.withColumns({sha: F.sha2(F.coalesce("text", F.lit("")), 256), order: F.xxhash64(*columns(docs))})
    same = F.col("doc_id").eqNullSafe(F.col(kept_id)) & (F.col(sha) == F.col(kept_sha))
    left = keyed.join(kept.toDF(kept_id, kept_sha), same)
    first = F.row_number().over(Window.partitionBy("doc_id", sha).orderBy(order))
    return left.withColumn(n, first).filter(F.col(n) == 1).select(*columns(docs))
