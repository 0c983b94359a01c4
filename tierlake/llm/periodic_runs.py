"""Periodic runs of words: stretches that repeat a period, found by branching tandem repeats in an enhanced suffix array.

The suffix array of the words of many texts is made by prefix doubling, in which every word also carries the number of its
text, so that no two texts share a prefix. Each doubling leaves one rank per suffix; together these give the length of any
common prefix, and with it the LCP array, without a scan over characters.

A square uu of depth d = |u| at i that its next word does not go on is branching: i and i + d lie in one LCP interval of
value d, in different children of it. So for each LCP interval, every suffix i outside its largest child is asked whether
ISA[i + d] or ISA[i - d] lies in the interval; a suffix is asked at most log n times. Intervals are pairs of places in
arrays, found by the nearest smaller LCP values on both sides; there are no tree nodes. A branching square is the
last of its run; it is rotated to the left, by common prefixes again, to where the period begins, and squares with the same
borders are merged into one run with the smallest period.

Texts are independent of each other: nothing is shuffled. A task looks at about a megabyte of text together, and a longer
text alone, which takes some 200 bytes a word and more where words repeat.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tierlake.llm.common import pieces
from tierlake.llm.words import joined, word_ids, words_of

#: A run has at least this many words, and at least this many times its period.
LEAST_WORDS, LEAST_PERIODS = 6, 4


def suffix_order(symbols: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
    """All suffixes in order, and their ranks by their first 1, 2, 4, ... symbols, of which the last ones all differ.

    No suffix may be a prefix of another one that lies in the same text, so the last symbol of each text occurs once.
    """
    n = len(symbols)
    order = np.argsort(symbols, kind="stable")
    group = symbols[order]
    new = np.concatenate([[True], group[1:] != group[:-1]])[:n]
    rank = np.empty(n, np.int64)
    rank[order] = np.maximum.accumulate(np.where(new, np.arange(n), 0))
    ranks, step = [rank], 1
    lone = new & np.concatenate([new[1:], [True]])[:n]
    left = np.flatnonzero(~lone)
    while len(left):
        at = order[left]
        pair = rank[at] * n + rank[at + step]
        by_pair = np.argsort(pair, kind="stable")  # groups lie side by side, so each stays in its places
        at, pair = at[by_pair], pair[by_pair]
        order[left] = at
        new = np.concatenate([[True], pair[1:] != pair[:-1]])
        rank = rank.copy()
        rank[at] = np.maximum.accumulate(np.where(new, left, 0))
        ranks.append(rank)
        left = left[~(new & np.concatenate([new[1:], [True]]))]
        step *= 2
    return order, ranks


def common_prefixes(order: np.ndarray, ranks: list[np.ndarray]) -> np.ndarray:
    """The length of the prefix that each suffix shares with the one before it in order; 0 for the first."""
    lcp = np.zeros(len(order), np.int64)
    some = np.flatnonzero(ranks[0][order[1:]] == ranks[0][order[:-1]]) + 1
    a, b = order[some - 1], order[some]
    begin = b.copy()
    for k in reversed(range(len(ranks) - 1)):
        same = ranks[k][a] == ranks[k][b]
        a, b = a + (same << k), b + (same << k)
    lcp[some] = b - begin
    return lcp


def nearest_smaller(values: np.ndarray) -> np.ndarray:
    """For each place with a value over 0 the last place before it with a smaller one; the first value must be 0."""
    before = np.arange(len(values)) - 1
    left = np.flatnonzero(values > 0)
    while len(left):
        at = before[left]
        on = values[at] >= values[left]  # all that lies between a place and the one it points to is as large as it is
        left = left[on]
        before[left] = before[at[on]]
    return before


def branching_squares(symbols: np.ndarray, order: np.ndarray, lcp: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and depths of the branching tandem repeats, some of them twice."""
    n = len(order)
    place = np.empty(n, np.int64)
    place[order] = np.arange(n)
    cuts = np.flatnonzero(lcp)
    first = nearest_smaller(lcp)[cuts]
    last = n - 1 - nearest_smaller(np.concatenate([[0], lcp[:0:-1]]))[n - cuts]  # the same from the other end
    by_interval = np.argsort(first * (n + 1) + last, kind="stable")
    cuts, first, last = cuts[by_interval], first[by_interval], last[by_interval]
    if not len(cuts):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    new = np.concatenate([[True], (first[1:] != first[:-1]) | (last[1:] != last[:-1])])
    heads = np.flatnonzero(new)
    interval = np.cumsum(new) - 1
    low, high, depth = first[heads], last[heads], lcp[cuts[heads]]
    # Children: what lies before each cut of an interval, and what lies behind its last one.
    counts = np.diff(np.append(heads, len(cuts)))
    begin = np.empty(len(cuts) + len(heads), np.int64)
    end = begin.copy()
    child = np.arange(len(cuts)) + interval
    end[child], begin[child + 1] = cuts, cuts
    begin[heads + np.arange(len(heads))] = low
    end[heads + np.arange(len(heads)) + counts] = high + 1
    own = np.repeat(np.arange(len(heads)), counts + 1)
    size = end - begin
    largest = np.maximum.reduceat(size, heads + np.arange(len(heads)))[own] == size
    widest = np.flatnonzero(largest)
    once = np.concatenate([[True], own[widest][1:] != own[widest][:-1]])
    small = np.ones(len(size), bool)
    small[widest[once]] = False
    begin, size, own = begin[small], size[small], own[small]
    at = np.repeat(begin - (np.cumsum(size) - size), size) + np.arange(size.sum())
    own = np.repeat(own, size)
    suffix, d = order[at], depth[own]
    found = []
    other = suffix + d
    inside = (place[other] >= low[own]) & (place[other] <= high[own])
    found.append((suffix[inside], d[inside]))
    other = suffix - d
    inside = (other >= 0) & (place[other] >= low[own]) & (place[other] <= high[own])
    found.append((other[inside], d[inside]))
    start, d = (np.concatenate(x) for x in zip(*found, strict=True))
    branching = symbols[start + d] != symbols[start + 2 * d]
    return start[branching], d[branching]


def maximal_runs(ids: np.ndarray, border: np.ndarray) -> np.ndarray:
    """Rows (text, start, end, period) of all maximal runs of at least two periods, by text, start and period.

    ids: word numbers of all texts end to end; border: where each text begins, and the end.
    """
    texts = len(border) - 1
    if not len(ids):
        return np.zeros((0, 4), np.int64)
    text = np.repeat(np.arange(texts), np.diff(border))
    symbols = np.empty(len(ids) + texts, np.int64)  # each text's words and then an end of its own
    stops = border[1:] + np.arange(texts)
    symbols[np.arange(len(ids)) + text] = text * (ids.max() + 2) + ids + 1
    symbols[stops] = np.arange(texts) * (ids.max() + 2)
    order, ranks = suffix_order(symbols)
    start, period = branching_squares(symbols, order, common_prefixes(order, ranks))
    end = start + 2 * period
    for k in reversed(range(len(ranks) - 1)):
        to = start - (1 << k)
        same = (to >= 0) & (ranks[k][to] == ranks[k][np.maximum(to + period, 0)])
        start = start - (same << k)
    by_borders = np.lexsort((period, end, start))
    start, end, period = start[by_borders], end[by_borders], period[by_borders]
    new = np.concatenate([[True], (start[1:] != start[:-1]) | (end[1:] != end[:-1])])[: len(start)]
    start, end, period = start[new], end[new], period[new]
    own = np.searchsorted(stops, start)
    before = border[own] + own
    rows = np.stack([own, start - before, end - before, period], axis=1)
    return rows[np.lexsort((rows[:, 3], rows[:, 1], rows[:, 0]))]


def _find(least_words: int, least_periods: int):
    def find(batches):
        for batch in pieces(batches):
            data, starts, ends, border = words_of(batch.column("text"))
            rows = maximal_runs(word_ids(data, starts, ends), border)
            length = rows[:, 2] - rows[:, 1]
            rows = rows[(length >= least_words) & (length >= least_periods * rows[:, 3])]
            text, first, last, period = rows.T
            gone = np.zeros(len(starts) + 1, np.int64)
            np.add.at(gone, border[text] + first + period, 1)
            np.add.at(gone, border[text] + last, -1)
            kept = joined(data, starts, ends, border, np.cumsum(gone)[:-1] == 0)
            offsets = pa.array(np.searchsorted(text, np.arange(batch.num_rows + 1)), pa.int32())
            parts = [pa.array(x, pa.int64()) for x in (first, last - first, period)]
            found = pa.ListArray.from_arrays(offsets, pa.StructArray.from_arrays(parts, ["start", "length", "period"]))
            columns = [batch.column("doc_id"), pa.array(np.diff(border), pa.int64()), found, kept]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_words", "runs", "collapsed"])

    return find


def find(docs: DataFrame, least_words: int = LEAST_WORDS, least_periods: int = LEAST_PERIODS) -> DataFrame:
    """One row per document, repeated ones too: doc_id, n_words, runs (start, length and period of each, by start, then period)
    and collapsed: the words joined by a blank, without those that a run has after its first period.

    A run has its smallest period, is as long as that period allows, and has at least `least_words` words and `least_periods`
    (2 or more) periods. NULL and empty texts have no words and no runs, and collapse to an empty text. A NULL doc_id stays
    NULL, other columns are not looked at, an empty table gives no rows.
    """
    if least_periods < 2:
        raise ValueError("a run has at least two periods")
    plain = docs.select(F.col("doc_id").cast("long"), "text")
    kind = "doc_id long, n_words long, runs array<struct<start: long, length: long, period: long>>, collapsed string"
    return plain.mapInArrow(_find(least_words, least_periods), kind)


def digests(docs: DataFrame) -> DataFrame:
    """Per document: number of runs, the longest one (of equally long ones the first, then that of the smallest period) with
    its length in thousandths of its period, and the SHA-256 of all runs and of the collapsed text."""
    ranked = F.transform("runs", lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("start"), (-r["period"]).alias("period")))
    best = find(docs).withColumn("best", F.array_max(ranked))
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    return best.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        (-F.col("best.start")).alias("start"),
        F.col("best.length").alias("length"),
        (-F.col("best.period")).alias("period"),
        F.floor(1000 * F.col("best.length") / -F.col("best.period")).cast("long").alias("exponent_milli"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


def with_periods(docs: DataFrame) -> DataFrame:
    """`docs`' doc_id and text, every tenth text of which, by a hash of its id, repeats a stretch from some word on to its end."""
    words = F.array_remove(F.split("text", r"[\x20\x09-\x0D]+"), "")
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    chosen = docs.select(F.col("doc_id").cast("long"), "text", F.floor(h / 10).alias("g"), F.coalesce(h % 10 == 0, F.lit(False)).alias("some"))
    chosen = chosen.withColumn("words", F.when(F.col("some"), words)).withColumn("n", F.size(F.coalesce("words", F.array().cast("array<string>"))))
    g, n = F.col("g"), F.col("n")
    a = F.when(n > 0, g % n)
    p = 1 + F.floor((n - a) / (3 + g % 8))
    chosen = chosen.select("doc_id", "text", "words", "some", "n", a.cast("int").alias("a"), p.cast("int").alias("p"))
    a, p = F.col("a"), F.col("p")
    period = F.slice("words", a + 1, p)
    times = F.ceil((n - a) / p).cast("int")
    again = F.slice(F.flatten(F.array_repeat(period, times)), F.lit(1), n - a)
    changed = F.array_join(F.concat(F.slice("words", F.lit(1), a), again), " ")
    return chosen.select("doc_id", F.when(F.col("some") & (n > 0), changed).otherwise(F.col("text")).alias("text"))
