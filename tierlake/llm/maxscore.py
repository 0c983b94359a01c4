"""Exact top-k inner products by MaxScore over posting lists.

A term is a dimension with a sign; its posting list holds the vectors whose component there has that sign, the largest first. A
query's terms are the dimensions where it is not zero, with its own sign: only these add to a score. Terms are taken by falling
bound, which is the query's component times the list's largest. What some terms add together is at most the sum of their bounds,
and also at most the length of the query there times that of the vector. Terms that together cannot reach the k-th best score so
far, the bar, are non-essential: their lists are never traversed. An essential list is traversed in blocks and only as far as
its components, with all that later terms may add, reach the bar. A block's vectors are probed term by term as long as they
can still compete; then the bar rises, and with it the lists to come are shortened or become non-essential.

Vectors are dealt into shards and queries into blocks; each pair of them is a task of bounded size, and the shards' best
are merged.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Components of a shard's vectors and of a block's queries, at most on average. Less where that leaves the cluster idle.
SHARD_CELLS, LEAST_ROWS, BLOCK_CELLS = 1 << 23, 4096, 1 << 20
_FIRST, _MOST = 512, 8192  # vectors of the first block of a list, and of a later one at most
_PROBED = 16  # dimensions that lie together and are probed between two looks at the bar
_EXACT = 2.0**53  # up to here sums of whole numbers are exact as doubles


def _at_most(squares: np.ndarray | float) -> np.ndarray | float:
    """Roots of products of sums of squares, rounded up."""
    return np.sqrt(squares) * (1 + 1e-9) + 1


class Shard:
    """The posting lists of some vectors, given as a matrix of integers; short vectors are filled up with zeros."""

    def __init__(self, ids: np.ndarray, values: np.ndarray):
        self.ids, self.width = ids, values.shape[1]
        squares = np.square(values.astype(np.float64))
        borders = np.arange(0, self.width, _PROBED)
        kind = np.float64 if not values.size or np.abs(values).max() < _EXACT else np.int64
        self.slabs = [np.ascontiguousarray(values[:, at : at + _PROBED], kind) for at in borders]
        self.squares = np.stack([squares[:, at : at + _PROBED].sum(axis=1) for at in borders], axis=1) if len(borders) else squares
        self.square = squares.sum(axis=1)
        self.longest = float(self.square.max(initial=0.0))
        self.lists = {}
        for d in range(self.width):
            rows = np.argsort(values[:, d], kind="stable").astype(np.int32)
            column = values[rows, d]
            below, above = np.searchsorted(column, [0, 1])
            for sign, listed, sizes in ((1, rows[above:][::-1], column[above:][::-1]), (-1, rows[:below], -column[:below])):
                if len(listed):
                    self.lists[d, sign] = listed, sizes

    def best(self, own: int, query: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, int]:
        """Rows and scores of the k best vectors but the query's own, and how many were probed."""
        query = np.pad(query[: self.width], (0, max(0, self.width - len(query))))
        terms = [(d, 1 if q > 0 else -1) for d, q in enumerate(query.tolist()) if q]
        bound = {t: abs(int(query[t[0]])) * int(self.lists[t][1][0]) if t in self.lists else 0 for t in terms}
        terms.sort(key=lambda t: -bound[t])
        # of the terms from here on: the sum of their bounds, and what the query's squares allow
        sums = np.cumsum([0.0, *(bound[t] for t in reversed(terms))])[::-1]
        squares = np.cumsum([0.0, *(float(query[d]) ** 2 for d, _ in reversed(terms))])[::-1]
        rest = np.minimum(sums * (1 + 1e-12) + 1, _at_most(squares * self.longest))
        probe = self._prober(query, bound)

        seen = self.ids == own
        rows, scores, probed = np.zeros(0, np.int64), np.zeros(0, np.int64), 0
        bar = -np.inf

        def look(some: np.ndarray) -> None:
            nonlocal rows, scores, probed, bar
            probed += len(some)
            found, reached = probe(some, bar)
            if len(found):
                found, reached = np.concatenate([rows, found]), np.concatenate([scores, reached])
                first = np.lexsort((self.ids[found], -reached))[:k]
                rows, scores = found[first], reached[first]
                bar = int(scores[-1]) if len(scores) == k else bar

        for i, term in enumerate(terms):
            if rest[i] < bar:  # this one and all later ones are non-essential
                break
            if term not in self.lists:
                continue
            listed, sizes = self.lists[term]
            each, step, at = abs(int(query[term[0]])), _FIRST, 0
            unseen = np.flatnonzero(~seen[listed])
            while at < len(unseen):
                # without a larger component here, a vector that no earlier list has brought up is below the bar
                least = (bar - rest[i + 1]) / each * (1 - 1e-9) - 1
                some = unseen[at : at + step]
                if least > 0:
                    some = some[: np.searchsorted(-sizes[some], -least, side="right")]
                if not len(some):
                    break
                seen[listed[some]] = True
                look(listed[some])
                at, step = at + len(some), min(step * 2, _MOST)
        if bar <= 0:  # then even a vector without any term may be among the best
            look(np.flatnonzero(~seen))
        return rows, scores, probed

    def _prober(self, query: np.ndarray, bound: dict[tuple[int, int], int]):
        """A function that gives those of some vectors that reach a bar, and their scores.

        Dimensions that lie together are probed together, those that the terms' bounds speak most for first.
        """
        sums = np.zeros(len(self.slabs))
        for (d, _), most in bound.items():
            sums[d // _PROBED] += most
        parts = [query[at : at + _PROBED] for at in range(0, self.width, _PROBED)]
        order = [i for i in np.argsort(-sums, kind="stable").tolist() if parts[i].any()]
        later = np.cumsum([0.0, *(sums[i] for i in reversed(order))])[::-1] * (1 + 1e-12) + 1
        square = [float(np.square(parts[i].astype(np.float64)).sum()) for i in order]
        lengths = np.cumsum([0.0, *reversed(square)])[::-1]
        exact = _at_most(self.longest * lengths[0]) < _EXACT
        kind = np.float64 if exact and all(slab.dtype == np.float64 for slab in self.slabs) else np.int64
        parts = [part.astype(kind) for part in parts]

        def probe(rows: np.ndarray, bar: float) -> tuple[np.ndarray, np.ndarray]:
            score, left = np.zeros(len(rows), kind), self.square[rows]
            slack = abs(bar) * 1e-12 if bar != -np.inf else 0.0
            for n, i in enumerate(order, 1):
                score = score + self.slabs[i].take(rows, axis=0).astype(kind, copy=False) @ parts[i]
                if bar == -np.inf or n == len(order):
                    continue
                # what is left may have lost its last digits, as far as these go in the whole
                left = left - self.squares[rows, i]
                more = _at_most((np.maximum(left, 0) + 1e-12 * self.longest) * lengths[n])
                keep = np.flatnonzero(score + np.minimum(more, later[n]) + slack >= bar)
                if len(keep) < 0.8 * len(rows):
                    rows, score, left = rows[keep], score[keep], left[keep]
            score = score.astype(np.int64)
            keep = score >= bar
            return rows[keep], score[keep]

        return probe


def _matrix(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """Ids and components, filled up with zeros to the longest vector."""
    lists = table.column("v").combine_chunks()
    sizes = lists.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    flat = lists.flatten().to_numpy(zero_copy_only=False)
    values = np.zeros((len(sizes), int(sizes.max(initial=0))), np.int64)
    values[np.arange(values.shape[1]) < sizes[:, None]] = flat
    return table.column("id").to_numpy(), values


def _search(k: int):
    def search(left: pa.Table, right: pa.Table) -> pa.Table:
        ids, values = _matrix(left)
        asked, queries = _matrix(right)
        shard, out = Shard(ids, values), ([], [], [])
        for own, query in zip(asked.tolist(), queries, strict=True):
            rows, scores, _ = shard.best(own, query, k)
            out[0].append(np.full(len(rows), own))
            out[1].append(ids[rows])
            out[2].append(scores)
        flat = [pa.array(np.concatenate([np.zeros(0, np.int64), *part]).astype(np.int64)) for part in out]
        return pa.Table.from_arrays(flat, ["query_id", "vec_id", "score"])

    return search


def top_k(vectors: DataFrame, is_query: Column, k: int = 10, scale: int = 1024) -> DataFrame:
    """Each query's k best vectors: query_id, rank, vec_id, score.

    `vectors` has vec_id and embedding; `is_query` is a condition on vec_id. Components become floor(scale * x); scores are
    exact as long as they fit 64 bits. Ties go to the smaller vec_id. A vector that is NULL or holds a NULL or a
    non-finite component takes no part, nor does one with a NULL id. Components that the shorter of two vectors lacks
    count as 0. Rows that repeat an id are one vector, the one whose list of components is least; they are reduced to it before
    vectors are dealt, so an id may have any number of rows. Other columns are not looked at, and an empty table gives no rows.
    """
    x = F.col("embedding")
    whole = F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) != float("inf")))
    rows = vectors.filter(F.col("vec_id").isNotNull() & x.isNotNull() & whole)
    rows = rows.select(F.col("vec_id").cast("long").alias("id"), F.transform(x, lambda c: F.floor(c.cast("double") * scale)).alias("v"))
    rows = rows.groupBy("id").agg(F.min("v").alias("v"))
    query = is_query.alias("is_query")
    named = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.size(x).alias("size"))
    n, asked, width = named.select(F.count("*"), F.count_if(query), F.max("size")).first()
    cells = max(1, width or 0)
    idle = min(vectors.sparkSession.sparkContext.defaultParallelism, -(-n // LEAST_ROWS))
    shards, blocks = max(1, -(-n * cells // SHARD_CELLS), idle), max(1, -(-asked * cells // BLOCK_CELLS))
    every_block, every_shard = (F.sequence(F.lit(0), F.lit(m - 1)) for m in (blocks, shards))
    left = rows.withColumns({"shard": F.pmod(F.xxhash64("id"), F.lit(shards)).cast("int"), "block": F.explode(every_block)})
    right = rows.withColumn("vec_id", F.col("id")).filter(is_query).drop("vec_id")
    right = right.withColumns({"block": F.pmod(F.xxhash64("id"), F.lit(blocks)).cast("int"), "shard": F.explode(every_shard)})
    pairs = left.groupBy("shard", "block").cogroup(right.groupBy("shard", "block"))
    found = pairs.applyInArrow(_search(k), "query_id long, vec_id long, score long")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", rank).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
