"""Exact top-k search, byte-level BPE, the registered queries and the pipeline."""

from __future__ import annotations

import base64
import glob
import hashlib
import math
import os
import random

import duckdb
import numpy as np
import public_tokenizers
import pytest
import tiktoken
from conftest import SF_DIR
from llm_cases import LONG, awkward, documents, plain
from pyspark.sql import functions as F

import __spark_entry__ as contract
import corpus_pipeline
from tierlake.llm import bpe, maxscore
from tierlake.llm.queries import ORACLES, QUERIES

VECTORS = "vec_id long, embedding array<float>, score string, id int"
PATH = public_tokenizers.path("byte_bpe_50k.tiktoken")


def top(rows, k=10):
    kept = {}
    for i, v in rows:
        if i is None or v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        whole = [math.floor(1024 * float(np.float32(x))) for x in v]
        kept[i] = min(kept.get(i, whole), whole)
    found = set()
    for q, v in kept.items():
        if q % 100 == 0:
            scores = sorted((-sum(a * b for a, b in zip(v, w, strict=False)), i) for i, w in kept.items() if i != q)
            found |= {(q, rank, i, -s) for rank, (s, i) in enumerate(scores[:k], 1)}
    return found


@pytest.mark.parametrize("n, d, values", [(300, 8, "few"), (1500, 12, "normal"), (700, 6, "positive"), (5, 3, "few"), (1500, 30, "sparse")])
def test_top_k_is_that_of_brute_force(spark, conf, n, d, values):
    random_ = np.random.default_rng(n + d)
    vectors = {"few": random_.integers(-2, 3, (n, d)) / 1024, "normal": random_.normal(size=(n, d)), "positive": random_.random((n, d))}.get(values)
    if vectors is None:
        vectors = np.where(random_.random((n, d)) < 0.1, random_.normal(size=(n, d)), 0)
    rows = [(int(i), [float(x) for x in v]) for i, v in zip(random_.permutation(n), vectors, strict=True)]
    frame = spark.createDataFrame([(*r, "x", 1) for r in rows], VECTORS)
    got = {tuple(r) for r in maxscore.top_k(frame, F.col("vec_id") % 100 == 0).collect()}
    assert got == top(rows)


def test_top_k_over_several_blocks(spark, monkeypatch):
    monkeypatch.setattr(maxscore, "BLOCK_CELLS", 15)
    monkeypatch.setattr(maxscore, "LEAST_ROWS", 100)
    random_ = np.random.default_rng(9)
    rows = [(i, random_.normal(size=5).tolist()) for i in range(1000)]
    frame = spark.createDataFrame([(*r, "x", 1) for r in rows], VECTORS)
    assert {tuple(r) for r in maxscore.top_k(frame, F.col("vec_id") % 100 == 0).collect()} == top(rows)


def test_top_k_of_awkward_vectors(spark):
    rows = [(0, [1.0, 2.0]), (1, None), (2, [None, 1.0]), (3, [math.nan, 1.0]), (4, [math.inf, 1.0]), (5, []), (6, [3.0]), (None, [1.0, 1.0])]
    rows += [(7, [1.0, 1.0]), (7, [1.0, 0.5]), (7, [1.0, 0.5]), (100, [-1.0, -1.0]), (200, [0.0, 0.0]), (8, [2.0, 0.0, 9.0])]
    frame = spark.createDataFrame([(*r, "x", 1) for r in rows], VECTORS)
    assert {tuple(r) for r in maxscore.top_k(frame, F.col("vec_id") % 100 == 0).collect()} == top(rows)
    assert maxscore.top_k(frame.filter("false"), F.col("vec_id") % 100 == 0).collect() == []


def test_non_essential_lists_are_not_traversed():
    random_ = np.random.default_rng(2)
    values = np.where(random_.random((20_000, 100)) < 0.02, random_.integers(1, 50, (20_000, 100)), 0)
    query = np.zeros(100, np.int64)
    query[:6] = [900, 800, 3, 2, 1, 1]
    rows, scores, probed = maxscore.Shard(np.arange(20_000), values).best(-1, query, 10)
    assert probed < 2000  # most vectors are in no essential list
    assert scores.tolist() == sorted(values @ query, reverse=True)[:10]


@pytest.mark.parametrize("strong, most", [(2, 0.5), (3, 0.5)])
def test_the_bar_rises_over_dense_vectors_with_a_few_strong_components(strong, most):
    random_ = np.random.default_rng(strong)
    values = random_.integers(-40, 41, (20_000, 64))
    at = random_.permuted(np.tile(np.arange(64), (20_000, 1)), axis=1)[:, :strong]
    np.put_along_axis(values, at, random_.integers(-1000, 1001, (20_000, strong)), axis=1)
    shard = maxscore.Shard(np.arange(20_000), values)
    touched = []
    for own in range(0, 20_000, 1000):
        rows, scores, probed = shard.best(own, values[own], 10)
        every = sorted(zip((-(values @ values[own])).tolist(), range(20_000), strict=True))
        expected = [(i, -s) for s, i in every if i != own][:10]
        assert list(zip(rows.tolist(), scores.tolist(), strict=True)) == expected
        touched.append(probed)
    assert np.mean(touched) < most * 20_000


@pytest.mark.parametrize("values", ["ties", "wide", "huge", "negative"])
def test_a_shard_answers_as_brute_force(values):
    random_ = np.random.default_rng(11)
    matrix = {
        "ties": random_.integers(-1, 2, (3000, 6)),
        "wide": random_.integers(-100, 101, (600, 768)),
        "huge": random_.integers(-(2**28), 2**28, (2000, 9)),
        "negative": -random_.integers(0, 50, (2000, 5)),
    }[values]
    ids = random_.permutation(len(matrix))
    shard = maxscore.Shard(ids, matrix)
    for at in range(0, len(matrix), 50):
        for query in (matrix[at], -matrix[at], matrix[at] * 0):
            rows, scores, _ = shard.best(int(ids[at]), query, 10)
            every = sorted(zip((-(matrix @ query)).tolist(), ids.tolist(), strict=True))
            assert list(zip(ids[rows].tolist(), scores.tolist(), strict=True)) == [(i, -s) for s, i in every if i != ids[at]][:10]


def test_shards_follow_the_components(spark, monkeypatch):
    monkeypatch.setattr(maxscore, "LEAST_ROWS", 10**6)
    monkeypatch.setattr(maxscore, "SHARD_CELLS", 4000)
    random_ = np.random.default_rng(12)
    rows = [(i, random_.normal(size=40).tolist()) for i in range(500)]
    frame = spark.createDataFrame([(*r, "x", 1) for r in rows + rows[:1] * 300], VECTORS)
    assert {tuple(r) for r in maxscore.top_k(frame, F.col("vec_id") % 100 == 0).collect()} == top(rows)


@pytest.fixture(scope="module")
def library():
    with open(PATH, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def round_trip(texts, library):
    found = []
    for i, text in texts:
        ids = library.encode_ordinary(text or "")
        digest = hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        found.append((i, len(ids), digest, hashlib.sha256((text or "").encode()).hexdigest()))
    return sorted(found, key=str)


def test_ids_are_those_of_the_library(spark, library):
    texts = [(r[0], r[1]) for r in awkward()] + [(50, "<|endoftext|> and don't  stop\n\n\t é́ １２３ " + "z" * 3000)]
    rows = [(i, t, None, None, None, None, None, None) for i, t in texts]
    got = bpe.round_trip(documents(spark, rows), PATH, public_tokenizers.PATTERN).collect()
    assert sorted(map(tuple, got), key=str) == round_trip(texts, library)
    assert bpe.round_trip(documents(spark, []), PATH, public_tokenizers.PATTERN).collect() == []


def test_small_blocks_and_forgetful_tasks_give_the_same_ids(spark, library, monkeypatch):
    pick = random.Random(1)
    texts = list(enumerate(" ".join(pick.choice(LONG.split(" ")) for _ in range(pick.randint(0, 80))) for _ in range(400)))
    frame = plain(spark, [t for _, t in texts])
    encoded = bpe.encode(frame, PATH, public_tokenizers.PATTERN, block_chars=2000)
    rows = bpe.decode(encoded, PATH).collect()
    assert {r.doc_id: np.frombuffer(bytes(r.ids), "<u4").tolist() for r in rows} == {i: library.encode_ordinary(t) for i, t in texts}
    assert {r.doc_id: bytes(r.bytes).decode() for r in rows} == dict(texts)


def test_the_vocabulary_is_sent_once(spark):
    plan = bpe.encode(plain(spark, ["a b", "b c"]), PATH, public_tokenizers.PATTERN)
    plan.collect()
    assert "ReusedExchange" in plan._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("numbers", [[], [0], [127, 128, 0, 16383, 16384, 2097151, 2097152, 2**28 - 1, 5]])
def test_packed_numbers(numbers):
    assert bpe.unpacked(bpe.packed(np.array(numbers, np.int64))).tolist() == numbers


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_against_its_sql(spark, name):
    link = duckdb.connect()
    for file in glob.glob(f"{SF_DIR}/*.parquet"):
        link.execute(f"CREATE VIEW {os.path.splitext(os.path.basename(file))[0]} AS SELECT * FROM '{file}'")
    expected = link.execute(ORACLES[name])
    names = [column[0] for column in expected.description]
    got = QUERIES[name](spark, SF_DIR)
    assert sorted(got.columns) == sorted(names)
    assert sorted(map(repr, map(tuple, got.select(names).collect()))) == sorted(map(repr, expected.fetchall()))


def test_every_operator_is_registered():
    assert [f"op{n}_" for n in range(1, 14)] == [name[: name.index("_") + 1] for name in QUERIES]
    assert QUERIES.keys() | {"pipeline"} <= contract.queries().keys()
    assert set(ORACLES) <= contract.oracle_sql().keys()


def test_pipeline_stages_take_effect_one_after_the_other(spark, library):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    before, kept = docs, []
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = stage(spark, before, SF_DIR)
        assert after.dtypes == docs.dtypes, name
        after = spark.createDataFrame(after.collect(), docs.schema)
        assert {tuple(r) for r in after.collect()} <= {tuple(r) for r in before.collect()}
        if name == "exact dedup":
            largest = {}
            for r in before.collect():
                largest[r.text] = max(r.doc_id, largest.get(r.text, r.doc_id))
            assert {r.doc_id for r in after.collect()} == set(largest.values())
        kept.append(after.count())
        before = after
    texts = [(r.doc_id, r.text) for r in before.collect()]
    assert kept[1] < kept[0] and len(texts) > 0.5 * docs.count()
    out = corpus_pipeline.STAGES[-1][1](spark, before, SF_DIR).collect()
    assert sorted(map(tuple, out), key=str) == round_trip(texts, library)


def test_pipeline_of_awkward_rows(spark):
    docs = documents(spark, awkward())
    identified = ["1", "11", "2", "2", "6", "7", "8", "9", "9", "None"]  # neither NULL and empty texts nor those without a letter
    single = ["11", "2", "6", "8", "9", "9", "None"]  # the two texts of id 9 differ, and the one without an id is like no other
    for (_, stage), ids in zip(corpus_pipeline.STAGES, [identified, single, single, single, single], strict=True):
        docs = stage(spark, docs, SF_DIR)
        assert sorted(str(r.doc_id) for r in docs.select("doc_id").collect()) == ids
