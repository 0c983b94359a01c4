"""Removal of word sequences that occur elsewhere too, by matching statistics against compressed indexes of shards.

Streaming every document past the index of every shard would take a number of searches that grows with the square of the
corpus. Here what can match meets in one shard. An anchor of a window of LENGTH words is where the least hash of its
GRAM-word sequences (grams) begins, so equal windows have equal anchors at the same offset, and a window can only be repeated
if the gram at its anchor is. The windows with one anchor make a segment of at most 2 * LENGTH - GRAM words. Segments go to
the shard of their gram; each window of the corpus lies in one segment.

Equal segments are joined before the shuffle: each counts once, and if there are several all their windows are
repeated. Where a gram is left with several different segments, these become a shard's text. Its FM-index is searched backwards
from the end of each window of its segments, which gives matching statistics; windows whose statistic reaches LENGTH are
reported.

A gram with more segments than a shard should hold, such as that of a passage on every page, is not one shard's: its windows are
dealt again by longer grams, which take in half of the words left beside the gram, before it or behind it, so that equal
windows still meet. At the last, a gram is a whole window, and equal ones are joined before the shuffle. So nothing
is too large for a task, and nothing is left out.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tierlake.functions.storage import scratch_folder, unique_name
from tierlake.llm.common import mixed, pieces, powers, prefix_sums, span_hashes, stored
from tierlake.llm.fm_index import FMIndex
from tierlake.llm.words import joined, spelled, word_hashes, words_of

LENGTH, GRAM = 35, 18
#: Segments of a shard on average; different segments of a gram from which it is dealt again by longer grams.
SHARD_SEGMENTS, HOT_SEGMENTS = 10_000, 20_000
_STRETCH = 1 << 17  # words whose windows are looked at together
_PLACE = 20  # bits of a position within a stretch; the rest of a 64-bit key is hash


def anchors(words: np.ndarray, border: np.ndarray, length: int = LENGTH, gram: int = GRAM) -> np.ndarray:
    """The anchors of all windows: place, and the least and most words by which the windows begin before it.

    words: hashes of the words of all texts; border: where each text's begin.
    """
    parts = [np.zeros((0, 3), np.int64)]
    width = length - gram + 1
    for start in range(0, max(0, len(words) - length + 1), _STRETCH):
        here = words[start : start + _STRETCH + length - 1]
        windows = len(here) - length + 1
        edge = np.zeros(windows + 1, np.int64)
        first, last = np.clip(border[:-1] - start, 0, windows), np.clip(border[1:] - length + 1 - start, 0, windows)
        some = first < last
        np.add.at(edge, first[some], 1)
        np.add.at(edge, last[some], -1)
        valid = np.flatnonzero(np.cumsum(edge)[:windows])
        if not len(valid):
            continue
        sums, grams = prefix_sums(here), np.arange(len(here) - gram + 1)
        keys = span_hashes(sums, grams, grams + gram) >> np.uint64(_PLACE) << np.uint64(_PLACE) | grams.astype(np.uint64)
        least = np.lib.stride_tricks.sliding_window_view(keys, width).min(axis=1)
        place = (least[valid] & np.uint64((1 << _PLACE) - 1)).astype(np.int64)
        new = np.ones(len(valid), bool)
        new[1:] = (np.diff(place) != 0) | (np.diff(valid) != 1)
        begin = np.flatnonzero(new)
        end = np.append(begin[1:], len(valid)) - 1
        at = place[begin]
        parts.append(np.stack([at + start, at - valid[end], at - valid[begin]], axis=1))
    return np.concatenate(parts)


def named(words: np.ndarray, rows: np.ndarray, length: int, gram: int) -> tuple[np.ndarray, np.ndarray]:
    """For each anchor (place, least, most) the hash of its gram and that of its segment, of what it is and where the gram lies."""
    first, of_gram, of_segment = 0, np.empty(len(rows), np.uint64), np.empty(len(rows), np.uint64)
    place, least, most = rows.T
    while first < len(rows):  # anchors are in order of place, so some of them need a stretch of the words only
        begin = place[first] - most[first]
        last = max(first + 1, int(np.searchsorted(place, begin + _STRETCH)))
        some = slice(first, last)
        begin = (place[some] - most[some]).min()
        end = (place[some] - least[some]).max() + length
        sums = prefix_sums(words[begin:end])
        at = place[some] - begin
        of_gram[some] = span_hashes(sums, at, at + gram)
        whole = span_hashes(sums, at - most[some], at - least[some] + length)
        of_segment[some] = mixed(whole * np.uint64(0x9E3779B97F4A7C15) + most[some].astype(np.uint64))
        first = last
    return of_gram, of_segment


def _rows(key: pa.Array, place: np.ndarray, rows: np.ndarray, names: tuple[np.ndarray, np.ndarray]) -> pa.RecordBatch:
    columns = [pa.array(x.view(np.int64)) for x in names]
    return pa.RecordBatch.from_arrays(
        [*columns, key, pa.array(place), pa.array(rows[:, 1]), pa.array(rows[:, 2])], ["gram", "segment", "key", "place", "least", "most"]
    )


_ANCHORS = "gram long, segment long, key binary, place long, least long, most long"


def _find_anchors(length: int, gram: int):
    def find(batches):
        for batch in pieces(batches):
            data, starts, ends, border = words_of(batch.column("text"))
            words = word_hashes(data, starts, ends)
            rows = anchors(words, border, length, gram)
            text = np.searchsorted(border, rows[:, 0], side="right") - 1
            key = batch.column("key").take(pa.array(text))
            yield _rows(key, rows[:, 0] - border[text], rows, named(words, rows, length, gram))

    return find


def _with_anchors(batches):
    """Batches of texts with the anchors that come with them, in order: words, border, anchors, their texts and (place, least, most)."""
    for batch in pieces(batches):
        data, starts, ends, border = words_of(batch.column("text"))
        text = np.repeat(np.arange(batch.num_rows), np.diff(batch.column("anchors").offsets.to_numpy()))
        own = batch.column("anchors").flatten()
        rows = np.stack([_field(own, name).to_numpy() for name in ("place", "least", "most")], axis=1)
        rows[:, 0] += border[text]
        order = np.argsort(rows[:, 0], kind="stable")
        yield batch, data, starts, ends, border, own.take(pa.array(order)), text[order], rows[order]


def _field(rows: pa.StructArray, name: str) -> pa.Array:
    return rows.field(rows.type.get_field_index(name))


def _renamed(length: int, gram: int):
    """The anchors that come with each text, named by grams of another length."""

    def name(batches):
        for batch, data, starts, ends, border, _, text, rows in _with_anchors(batches):
            names = named(word_hashes(data, starts, ends), rows, length, gram)
            yield _rows(batch.column("key").take(pa.array(text)), rows[:, 0] - border[text], rows, names)

    return name


def _spelled(length: int):
    """The words of the segments at the anchors that come with each text."""

    def spell(batches):
        for _, data, starts, ends, _, own, _, rows in _with_anchors(batches):
            place, least, most = rows.T
            first, last = starts[place - most], ends[place - least + length - 1]
            texts = [data[i:j].tobytes() for i, j in zip(first.tolist(), last.tolist(), strict=True)]
            names = ["gram", "segment", "least", "most"]
            yield pa.RecordBatch.from_arrays([*(_field(own, n) for n in names), pa.array(texts, pa.binary())], [*names, "words"])

    return spell


def _shard(length: int):
    """The windows of a shard's segments that occur in it more than once."""

    def search(segments: pa.Table) -> pa.Table:
        segments = segments.combine_chunks()
        data, starts, ends, border = words_of(segments.column("words").combine_chunks().cast(pa.binary()))
        codes = spelled(data, starts, ends).dictionary_encode()
        ids = codes.indices.to_numpy().astype(np.int64)
        index = FMIndex(ids, border)
        windows = np.diff(border) - length + 1
        owner = np.repeat(np.arange(len(windows)), windows)
        nth = np.arange(windows.sum()) - np.repeat(np.cumsum(windows) - windows, windows)
        match = index.matching(ids, border[owner] + nth + length, length)
        hit = match >= length
        # Neighbouring windows of a segment make one span.
        first, last = hit.copy(), hit.copy()
        first[1:] &= ~(hit[:-1] & (owner[1:] == owner[:-1]))
        last[:-1] &= ~(hit[1:] & (owner[1:] == owner[:-1]))
        own = owner[first]
        most = segments.column("most").to_numpy()[own]
        some = pa.array(own)
        return pa.table(
            {
                "gram": segments.column("gram").take(some),
                "segment": segments.column("segment").take(some),
                "low": pa.array(nth[first] - most),
                "high": pa.array(nth[last] - most + length),
            }
        )

    return search


def _removed(length: int, digest: bool):
    def cut(batches):
        for batch in pieces(batches):
            data, starts, ends, border = words_of(batch.column("text"))
            n = np.diff(border)
            edge = np.zeros(len(starts) + 1, np.int64)
            spans = batch.column("spans")
            text = np.repeat(np.arange(batch.num_rows), np.diff(spans.offsets.to_numpy()))
            for name, sign in (("start", 1), ("stop", -1)):
                np.add.at(edge, border[text] + _field(spans.flatten(), name).to_numpy(), sign)
            whole = (batch.column("copies").to_numpy() > 1) & (n >= length)
            np.add.at(edge, border[:-1][whole], 1)
            np.add.at(edge, border[1:][whole], -1)
            keep = np.cumsum(edge)[:-1] == 0
            kept = joined(data, starts, ends, border, keep)
            if digest:
                kept = pa.array([hashlib.sha256(t.as_buffer()).hexdigest() for t in kept], pa.string())
            total = np.concatenate([[0], np.cumsum(~keep)])
            removed = total[border[1:]] - total[border[:-1]]
            yield pa.RecordBatch.from_arrays(
                [batch.column("key"), pa.array(n, pa.int64()), pa.array(removed, pa.int64()), kept], ["key", "n_words", "n_removed", "kept"]
            )

    return cut


def strip_repeats(docs: DataFrame, length: int = LENGTH, gram: int | None = None, hot: int = HOT_SEGMENTS) -> DataFrame:
    """One row per document, repeated ones too: doc_id, n_words, n_removed, kept (the words that are left, joined by a blank).

    A word goes if a window of `length` words covers it whose words, as they are, also follow each other anywhere else, in the
    same text or another; windows are judged on the input. NULL and empty texts have no words. A NULL doc_id stays NULL,
    other columns are not looked at, an empty table gives no rows.
    """
    return _stripped(docs, length, gram, hot, digest=False)


def digests(docs: DataFrame) -> DataFrame:
    """As `strip_repeats`, with the SHA-256 of what is left."""
    return _stripped(docs, LENGTH, GRAM, HOT_SEGMENTS, digest=True).withColumnRenamed("kept", "kept_sha256")


def _stripped(docs: DataFrame, length: int, gram: int | None, hot: int, digest: bool) -> DataFrame:
    spark, gram = docs.sparkSession, gram or max(1, (length + 1) // 2)
    text = F.coalesce("text", F.lit(""))
    plain = docs.select(F.col("doc_id").cast("long"), F.substring(F.unhex(F.sha2(text, 256)), 1, 16).alias("key"), text.alias("text"))
    texts = unique_name("tierlake_texts_")
    # Each distinct text once, bucketed so that it is not shuffled again when anchors and spans come back to it.
    distinct = plain.groupBy("key").agg(F.first("text").alias("text"), F.count("*").alias("copies"))
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    distinct.write.bucketBy(buckets, "key").option("path", scratch_folder(spark)).option("compression", "zstd").saveAsTable(texts)
    try:
        spans = _spans(spark.table(texts), length, gram, hot)
        by_text = spans.groupBy("key").agg(F.collect_list(F.struct("start", "stop")).alias("spans"))
        none = F.array().cast("array<struct<start: long, stop: long>>")
        left = spark.table(texts).join(by_text, "key", "left").select("key", "text", "copies", F.coalesce("spans", none).alias("spans"))
        kept = left.mapInArrow(_removed(length, digest), "key binary, n_words long, n_removed long, kept string")
        return stored(plain.select("doc_id", "key").join(kept, "key").drop("key"))
    finally:
        spark.sql(f"DROP TABLE {texts}")


def _spans(texts: DataFrame, length: int, gram: int, hot: int) -> DataFrame:
    """Rows (key, start, stop) of words that are covered by repeated windows."""
    # A text with fewer bytes than its words and the blanks between them would take has too few.
    long = texts.filter(F.octet_length("text") >= 2 * length - 1).select("key", "text")
    found = _repeated_grams(long.mapInArrow(_find_anchors(length, gram), _ANCHORS))
    spans = None
    while True:
        shape, same = ["gram", "segment", "least", "most"], F.struct("key", "place")
        # Each different segment once; `several` tells whether all of its windows are repeated.
        each = stored(found.groupBy(*shape).agg(F.min(same).alias("at"), F.count("*").alias("several")))
        grams = stored(each.groupBy("gram").agg(F.count("*").alias("different")).filter("different > 1"))
        crowded = grams.filter(F.col("different") > hot).select("gram") if gram < length else grams.filter("false").select("gram")
        few = grams.join(crowded, "gram", "left_anti").select("gram")
        count = grams.filter(F.col("different") <= hot).agg(F.sum("different")).first()[0] or 0
        own = each.join(few, "gram", "left_semi").select("gram", "segment", "at.key", "at.place", "least", "most")
        words = _beside(long, own).mapInArrow(_spelled(length), "gram long, segment long, least long, most long, words binary")
        shard = F.pmod(F.col("gram"), F.lit(max(1, -(-count // SHARD_SEGMENTS))))
        hits = words.groupBy(shard.alias("shard")).applyInArrow(_shard(length), "gram long, segment long, low long, high long")
        single = each.filter("several > 1").join(crowded, "gram", "left_anti")
        single = single.select("gram", "segment", (-F.col("most")).alias("low"), (length - F.col("least")).alias("high"))
        # Written out because adaptive execution can only split a segment of very many texts between two plain shuffles.
        hits = stored(hits.join(single, ["gram", "segment"], "left_anti").unionByName(single))
        here = found.join(hits, ["gram", "segment"])
        here = here.select("key", (F.col("place") + F.col("low")).alias("start"), (F.col("place") + F.col("high")).alias("stop"))
        spans = here if spans is None else spans.union(here)
        rest = found.join(crowded, "gram", "left_semi")
        if gram == length or crowded.isEmpty():
            return spans
        more = -(-(length - gram) // 2)
        place, least, most = F.col("place"), F.col("least"), F.col("most")
        before = rest.filter(most >= more).select(
            "key", (place - more).alias("place"), F.greatest(least - more, F.lit(0)).alias("least"), (most - more).alias("most")
        )
        behind = rest.filter(least < more).select("key", "place", "least", F.least(most, F.lit(more - 1)).alias("most"))
        gram += more
        found = _repeated_grams(_beside(long, before.union(behind)).mapInArrow(_renamed(length, gram), _ANCHORS))


def _repeated_grams(anchors_: DataFrame) -> DataFrame:
    """The anchors whose gram is found more than once."""
    found, where = stored(anchors_), F.xxhash64("key", "place", "most")
    several = found.groupBy("gram").agg(F.min(where).alias("low"), F.max(where).alias("high")).filter("low <> high")
    return stored(found.join(stored(several.select("gram")), "gram"))


def _beside(texts: DataFrame, anchors_: DataFrame) -> DataFrame:
    """Texts with their anchors, which are as many as a text has."""
    anchor = F.struct([F.col(name) for name in anchors_.columns if name != "key"])
    return texts.join(anchors_.groupBy("key").agg(F.collect_list(anchor).alias("anchors")), "key").select("key", "text", "anchors")
