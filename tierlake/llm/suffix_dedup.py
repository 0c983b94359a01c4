"""Removal of byte strings that occur elsewhere too, by merging sorted suffixes that know their common prefixes.

Sorting every suffix of a corpus moves hundreds of bytes for each byte of text. Here only suffixes at anchors are sorted. An
anchor of a window of LENGTH bytes is where the least hash of its GRAM-byte strings begins, so equal windows have their
anchors at the same offset, about one anchor serves (LENGTH - GRAM) / 2 windows that follow each other, and a window can only be
repeated if the string at its anchor is. Anchors whose string is found once are dropped.

The text to the right of each remaining anchor, and the reversed text to its left, are sorted within a task, front-coded
into runs and exchanged by the string's hash. A loser tree merges the runs of a part; every player carries the length of the
prefix it shares with the last string put out, so known prefixes are not compared again, and the lengths come out with the
order. Two windows that begin l bytes before their anchors are equal exactly if their anchors share LENGTH - l bytes to the
right and l to the left, which both orders tell for all anchors of a part at once.

A string that very many texts share would make a part without bound. Windows at such anchors are counted by a 128-bit
digest instead, which is summed up before the shuffle.
"""

from __future__ import annotations

import hashlib
from itertools import groupby
from operator import itemgetter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tierlake.functions.storage import scratch_folder, unique_name
from tierlake.llm.common import mixed, pieces, powers, prefix_sums, stored, utf8

LENGTH, GRAM = 400, 200
#: Anchors of a part on average; anchors of one string from which its windows are counted by digest; bytes of strings that a
#: task holds and sorts together, as long a stretch as its memory allows, so that the runs of a part are few and long.
PART_ANCHORS, HOT_ANCHORS, RUN_BYTES = 20_000, 100_000, 32 << 20
_PLACE = 24  # bits of a position within a stretch of text; the rest of a 64-bit key is hash
_STRETCH = 1 << 20  # bytes whose windows are looked at together; their hashes take some ninety times that


def anchors(data: np.ndarray, offsets: np.ndarray, length: int = LENGTH, gram: int = GRAM):
    """The anchors of all windows that lie in one text: hash, place, and the least and most bytes by which windows begin before it."""
    parts = [np.zeros((0, 4), np.int64)]
    width = length - gram + 1
    for start in range(0, max(0, len(data) - length + 1), _STRETCH):
        here = data[start : start + _STRETCH + length - 1]
        valid = np.zeros(len(here) + 2, np.int64)
        first = np.clip(offsets[:-1] - start, 0, len(here) + 1)
        last = np.clip(offsets[1:] - length + 1 - start, 0, len(here) - length + 1)
        some = first < last
        np.add.at(valid, first[some], 1)
        np.add.at(valid, last[some], -1)
        valid = np.flatnonzero(np.cumsum(valid)[: len(here) - length + 1])
        if not len(valid):
            continue
        sums = prefix_sums(here)
        _, inverse = powers(len(here))
        grams = mixed((sums[gram:] - sums[:-gram]) * inverse[: len(here) - gram + 1])
        keys = (grams >> np.uint64(_PLACE)) << np.uint64(_PLACE) | np.arange(len(grams), dtype=np.uint64)
        place = (_least(keys, width)[valid] & np.uint64((1 << _PLACE) - 1)).astype(np.int64)
        new = np.ones(len(valid), bool)
        new[1:] = (np.diff(place) != 0) | (np.diff(valid) != 1)
        begin = np.flatnonzero(new)
        end = np.append(begin[1:], len(valid)) - 1
        at = place[begin]
        parts.append(np.stack([grams[at].view(np.int64), at + start, at - valid[end], at - valid[begin]], axis=1))
    return np.concatenate(parts)


def _least(keys: np.ndarray, width: int) -> np.ndarray:
    """The least of every `width` keys in a row."""
    n = len(keys)
    rows = -(-n // width)
    filled = np.full(rows * width, np.iinfo(np.uint64).max, np.uint64)
    filled[:n] = keys
    block = filled.reshape(rows, width)
    onward = np.minimum.accumulate(block, axis=1).ravel()
    back = np.minimum.accumulate(block[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(back[: n - width + 1], onward[width - 1 : n])


def common(a: bytes, b: bytes, known: int = 0) -> int:
    """The length of the common prefix of two strings, of which `known` bytes are known."""
    n = min(len(a), len(b))
    x, y = a[known:n], b[known:n]
    if x == y:
        return n
    return n - ((int.from_bytes(x) ^ int.from_bytes(y)).bit_length() + 7) // 8


def front_coded(keys: list[bytes]) -> bytes:
    """A sorted run: for each key the length it shares with the one before and the length of the rest, and then all rests."""
    shared = [0, *(common(a, b) for a, b in zip(keys, keys[1:], strict=False))][: len(keys)]
    rests = [key[n:] for key, n in zip(keys, shared, strict=True)]
    heads = np.array([shared, [*map(len, rests)]], "<u4")
    return len(keys).to_bytes(4, "little") + heads.tobytes() + b"".join(rests)


def decoded(run: bytes) -> tuple[list[int], list[bytes]]:
    """The shared lengths and the keys of a run."""
    n = int.from_bytes(run[:4], "little")
    shared, sizes = np.frombuffer(run, "<u4", 2 * n, 4).reshape(2, n).tolist()
    keys, last, at = [], b"", 4 + 8 * n
    for keep, size in zip(shared, sizes, strict=True):
        last = last[:keep] + run[at : at + size]
        at += size
        keys.append(last)
    return shared, keys


def merged(runs: list[tuple[list[int], list[bytes]]]) -> tuple[list[int], list[int], list[int]]:
    """All keys of some sorted runs in order: run, place in it, and length shared with the key before.

    A loser tree whose players know what they share with the last key put out: a player that shares more is smaller, and
    only at a tie are bytes compared, from there on.
    """
    size = 1 << max(0, len(runs) - 1).bit_length()
    key: list[bytes] = [b""] * size
    shares = [-1] * size  # -1: no key left, so it loses
    place = [0] * size
    for r, (_, keys) in enumerate(runs):
        if keys:
            key[r], shares[r] = keys[0], 0

    def play(a: int, b: int) -> tuple[int, int]:
        """Winner and loser, which then knows what it shares with the winner."""
        one, two = shares[a], shares[b]
        if one != two:
            return (a, b) if one > two else (b, a)
        if one < 0:
            return a, b
        x, y = key[a], key[b]
        both = common(x, y, one)
        if both == len(x):
            first = both < len(y) or a < b
        else:
            first = both < len(y) and x[both] < y[both]
        if first:
            shares[b] = both
            return a, b
        shares[a] = both
        return b, a

    losers = [0] * size
    winners = [0] * size + list(range(size))
    for node in range(size - 1, 0, -1):
        winners[node], losers[node] = play(winners[2 * node], winners[2 * node + 1])
    best = winners[1] if size > 1 else 0
    out: tuple[list[int], list[int], list[int]] = ([], [], [])
    while runs and shares[best] >= 0:
        out[0].append(best)
        out[1].append(place[best])
        out[2].append(shares[best])
        place[best] += 1
        shared, keys = runs[best]
        if place[best] < len(keys):
            key[best], shares[best] = keys[place[best]], shared[place[best]]
        else:
            shares[best] = -1
        node = (size + best) >> 1
        while node:
            best, losers[node] = play(best, losers[node])
            node >>= 1
    return out


def _find_anchors(length: int, gram: int):
    def find(batches):
        for batch in pieces(batches, most=_STRETCH):
            data, offsets = utf8(batch.column("text"))
            rows = anchors(data, offsets, length, gram)
            text = np.searchsorted(offsets, rows[:, 1], side="right") - 1
            keys = batch.column("key").take(pa.array(text))
            yield pa.RecordBatch.from_arrays(
                [pa.array(rows[:, 0]), keys, *(pa.array(x) for x in (rows[:, 1] - offsets[text], rows[:, 2], rows[:, 3]))],
                ["gram", "key", "place", "least", "most"],
            )

    return find


def _runs(length: int, parts: int):
    """Front-coded runs of what lies right and left of the anchors that come with each text, a pair for each part.

    What is held is put in the order of the parts once and then sliced, so an anchor costs the same however many parts there are.
    """

    def emit(held: list):
        for part, group in groupby(sorted(held, key=itemgetter(0)), itemgetter(0)):
            own = list(group)
            right = sorted(range(len(own)), key=lambda i: own[i][1])
            left = sorted(range(len(own)), key=lambda i: own[i][2])
            meta = np.array([[h[4], h[5], h[6]] for h in own], "<i8")
            yield (
                part,
                front_coded([own[i][1] for i in right]),
                front_coded([own[i][2] for i in left]),
                np.array([right, left], "<u4").tobytes(),
                b"".join(h[3] for h in own),
                meta.tobytes(),
            )

    names = ["part", "right", "left", "orders", "keys", "meta"]
    kinds = [pa.int32(), *[pa.binary()] * 5]

    def run(batches):
        held, size = [], 0
        for batch in pieces(batches):
            for key, text, own in zip(*(batch.column(c).to_pylist() for c in ("key", "text", "anchors")), strict=True):
                raw = text.encode()
                for a in own:
                    gram, place, least, most = a["gram"], a["place"], a["least"], a["most"]
                    head = gram.to_bytes(8, "big", signed=True)
                    right = head + raw[place : place + length - least]
                    left = head + raw[place - most : place][::-1]
                    held.append((gram % parts, right, left, key, place, least, most))
                    size += len(right) + len(left)
            if size >= RUN_BYTES:
                yield _rows(emit(held), names, kinds)
                held, size = [], 0
        if held:
            yield _rows(emit(held), names, kinds)

    return run


def _rows(rows, names, kinds) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True))
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)


def repeated(right: tuple, left: tuple, least: np.ndarray, most: np.ndarray, length: int) -> np.ndarray:
    """For each anchor and each number of bytes before it whether the window that begins there is found twice.

    `right` and `left` are the anchors' places in sorted order and what each shares with the one before.
    """
    n, widest = len(least), int(most.max(initial=0))
    found = np.zeros((n, widest + 1), bool)
    to_right, to_left = np.empty(n, np.int64), np.empty(n, np.int64)
    for before in range(widest + 1):
        some = np.flatnonzero((least <= before) & (before <= most))
        if len(some) < 2:
            continue
        # Anchors that lack the bytes compared lie between no two that share them, so a class is one stretch of the order.
        to_right[right[0]] = np.cumsum(right[1] < length - before)
        to_left[left[0]] = np.cumsum(left[1] < before)
        both = to_right[some] * (n + 1) + to_left[some]
        order = np.argsort(both, kind="stable")
        same = np.diff(both[order]) == 0
        twice = np.zeros(len(some), bool)
        twice[order[1:]] |= same
        twice[order[:-1]] |= same
        found[some, before] = twice
    return found


def _merge(length: int):
    def merge(table: pa.Table) -> pa.Table:
        sizes = [len(m) // 24 for m in table.column("meta").to_pylist()]
        base = np.cumsum([0, *sizes])
        place, least, most = np.frombuffer(b"".join(table.column("meta").to_pylist()), "<i8").reshape(-1, 3).T
        keys = b"".join(table.column("keys").to_pylist())
        orders = [np.frombuffer(o, "<u4").reshape(2, -1) for o in table.column("orders").to_pylist()]
        sides = []
        for side, name in enumerate(("right", "left")):
            run, at, shared = merged([decoded(r) for r in table.column(name).to_pylist()])
            order = np.zeros(len(run), np.int64)
            run, at = np.array(run, np.int64), np.array(at, np.int64)
            for r, own in enumerate(orders):
                mine = run == r
                order[mine] = base[r] + own[side][at[mine]]
            sides.append((order, np.array(shared, np.int64) - 8))  # without the hash in front
        found = repeated(*sides, least, most, length)
        edges = np.diff(np.pad(found, ((0, 0), (1, 1))).astype(np.int8), axis=1)
        own, begin = np.nonzero(edges == 1)
        _, end = np.nonzero(edges == -1)
        start, stop = place[own] - (end - 1), place[own] - begin + length
        named = [keys[16 * i : 16 * i + 16] for i in own.tolist()]
        return pa.table({"key": pa.array(named, pa.binary()), "start": pa.array(start), "stop": pa.array(stop)})

    return merge


def _windows(length: int):
    """The digest of every window at the anchors that come with each text."""

    def digest(batches):
        for batch in pieces(batches):
            for key, text, own in zip(*(batch.column(c).to_pylist() for c in ("key", "text", "anchors")), strict=True):
                raw = text.encode()
                starts = [p for a in own for p in range(a["place"] - a["most"], a["place"] - a["least"] + 1)]
                for first in range(0, len(starts), 50_000):
                    some = starts[first : first + 50_000]
                    digests = [hashlib.blake2b(raw[p : p + length], digest_size=16).digest() for p in some]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([key] * len(some), pa.binary()), pa.array(some, pa.int64()), pa.array(digests, pa.binary())],
                        ["key", "start", "digest"],
                    )

    return digest


def _removed(length: int):
    def cut(batches):
        for batch in pieces(batches):
            out = []
            for key, text, copies, spans in zip(*(batch.column(c).to_pylist() for c in ("key", "text", "copies", "spans")), strict=True):
                raw = text.encode()
                if copies > 1 and len(raw) >= length:
                    spans = [{"start": 0, "stop": len(raw)}]
                kept, at, gone, runs = [], 0, 0, 0
                end = -1
                for span in sorted(spans or [], key=lambda s: s["start"]):
                    if span["start"] > end:  # a new run; what touches is one
                        kept.append(raw[at : span["start"]])
                        runs += 1
                        end = span["start"]
                    gone += max(0, span["stop"] - end)
                    end = at = max(end, span["stop"])
                kept.append(raw[at:])
                out.append((key, len(raw), gone, runs, b"".join(kept)))
            names = ["key", "n_bytes", "n_removed", "n_spans", "kept"]
            yield _rows(out, names, [pa.binary(), pa.int64(), pa.int64(), pa.int64(), pa.binary()])

    return cut


def strip_repeats(docs: DataFrame, length: int = LENGTH, gram: int | None = None, hot: int = HOT_ANCHORS) -> DataFrame:
    """One row per document, repeated ones too: doc_id, n_bytes, n_removed, n_spans, kept (the bytes that are left).

    A byte goes if it is covered by a string of `length` bytes that begins anywhere else too, in the same text or another;
    strings are judged on the input. NULL and empty texts have no bytes. A NULL doc_id stays NULL, other columns are not
    looked at, an empty table gives no rows.
    """
    return _stripped(docs, length, gram, hot, F.col("kept"), "kept")


def digests(docs: DataFrame) -> DataFrame:
    """As `strip_repeats`, with the SHA-256 of what is left."""
    return _stripped(docs, LENGTH, None, HOT_ANCHORS, F.sha2("kept", 256), "kept_sha256")


def _stripped(docs: DataFrame, length: int, gram: int | None, hot: int, result, name: str) -> DataFrame:
    spark, gram = docs.sparkSession, gram or max(1, length // 2)
    text = F.coalesce("text", F.lit(""))
    plain = docs.select(F.col("doc_id").cast("long"), F.substring(F.unhex(F.sha2(text, 256)), 1, 16).alias("key"), text.alias("text"))
    texts = unique_name("tierlake_texts_")
    # Each distinct text once, bucketed so that it is not shuffled again when anchors and spans come back to it.
    distinct = plain.groupBy("key").agg(F.first("text").alias("text"), F.count("*").alias("copies"))
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    folder = scratch_folder(spark)
    distinct.write.bucketBy(buckets, "key").option("path", folder).option("compression", "zstd").saveAsTable(texts)
    try:
        spans = _spans(spark.table(texts), length, gram, hot)
        by_text = spans.groupBy("key").agg(F.collect_list(F.struct("start", "stop")).alias("spans"))
        left = spark.table(texts).join(by_text, "key", "left").select("key", "text", "copies", "spans")
        kept = left.mapInArrow(_removed(length), "key binary, n_bytes long, n_removed long, n_spans long, kept binary")
        kept = kept.select("key", "n_bytes", "n_removed", "n_spans", result.alias(name))
        return stored(plain.select("doc_id", "key").join(kept, "key").drop("key"))
    finally:
        spark.sql(f"DROP TABLE {texts}")


def _spans(texts: DataFrame, length: int, gram: int, hot: int) -> DataFrame:
    """Rows (key, start, stop) of bytes that are covered by repeated windows."""
    spark = texts.sparkSession
    found = texts.filter(F.octet_length("text") >= length).select("key", "text").mapInArrow(
        _find_anchors(length, gram), "gram long, key binary, place long, least long, most long"
    )
    found, where = stored(found), F.xxhash64("key", "place", "least")
    several = found.groupBy("gram").agg(F.min(where).alias("low"), F.max(where).alias("high"), F.count("*").alias("n"))
    several = several.filter("low <> high").select(F.col("gram").alias("shared"), "n")
    # Written out because adaptive execution can only split the anchors of a hot string between two plain shuffles.
    found = stored(found.join(stored(several), F.col("gram") == F.col("shared")).drop("shared"))
    count = found.count()
    parts = max(1, -(-count // PART_ANCHORS))
    anchor = F.struct("gram", "place", "least", "most")

    def beside(rows: DataFrame) -> DataFrame:
        own = rows.groupBy("key").agg(F.collect_list(anchor).alias("anchors"))  # as many as a text has
        return texts.select("key", "text").join(own, "key").select("key", "text", "anchors")

    runs = beside(found.filter(F.col("n") <= hot)).mapInArrow(
        _runs(length, parts), "part int, right binary, left binary, orders binary, keys binary, meta binary"
    )
    spans = runs.groupBy("part").applyInArrow(_merge(length), "key binary, start long, stop long")
    often = found.filter(F.col("n") > hot)
    if often.isEmpty():
        return spans
    windows = beside(often).mapInArrow(_windows(length), "key binary, start long, digest binary")
    twice = stored(windows.groupBy("digest").agg(F.count("*").alias("n")).filter("n > 1").select("digest"))
    more = windows.join(twice, "digest").select("key", "start", (F.col("start") + length).alias("stop"))
    return spans.union(more)
