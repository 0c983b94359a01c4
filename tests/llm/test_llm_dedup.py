"""Exact and near duplicates, and repeated byte strings, against brute force."""

from __future__ import annotations

import collections
import hashlib
import random
import re
import string
import time

import numpy as np
import pyarrow as pa
import pytest
from llm_cases import LONG, awkward, documents, plain, prose
from pyspark.sql import functions as F

from tierlake.llm import chunk_dedup, components, minhash, suffix_dedup


def sha(text):
    return hashlib.sha256((text or "").encode()).hexdigest()


def exact(rows):
    groups = collections.defaultdict(list)
    for i, text in rows:
        groups[text or ""].append(i)
    return groups


def test_exact_copies_of_awkward_rows(spark):
    rows = [(r[0], r[1]) for r in awkward()]
    got = chunk_dedup.duplicates(documents(spark, awkward())).collect()
    assert len(got) == len(rows)
    for text, ids in exact(rows).items():
        own = [r for r in got if r.text_sha256 == sha(text)]
        best = max((i for i in ids if i is not None), default=None)
        assert sorted(map(str, (r.doc_id for r in own))) == sorted(map(str, ids))
        assert {(r.keep_id, r.group_size) for r in own} == {(best, len(ids))}
        assert [r.doc_id for r in own if r.kept] == [best]


def test_chunks_that_share_a_name_are_told_apart(spark):
    texts = prose(60, 1, words=(200, 900)) + [LONG, LONG[:-1], LONG + "!"]
    docs = plain(spark, texts)
    good = {tuple(r) for r in chunk_dedup.duplicates(docs).collect()}
    weak = {tuple(r) for r in chunk_dedup.duplicates(docs, lambda c: F.pmod(F.xxhash64(c), F.lit(3))).collect()}
    assert good == weak
    groups = exact(enumerate(texts))
    assert {(i, max(ids), len(ids)) for ids in groups.values() for i in ids} == {r[:3] for r in good}


@pytest.mark.parametrize("size", [0, 1, 1000, 5000, 200_000])
def test_chunks_cover_the_text_and_follow_its_content(size):
    data = np.frombuffer(random.Random(size).randbytes(size), np.uint8)
    (ends,) = chunk_dedup.cuts(data, np.array([0, size]))
    assert (ends[-1] if ends else 0) == size
    lengths = np.diff([0, *ends])
    assert all(lengths[:-1] >= chunk_dedup.LEAST_BYTES) and all(lengths <= chunk_dedup.MOST_BYTES)
    twice, again = chunk_dedup.cuts(np.concatenate([data, data]), np.array([0, size, 2 * size]))
    assert twice == ends and [e - size for e in again] == ends
    if size == 200_000:  # a byte in front moves only the first cuts
        (moved,) = chunk_dedup.cuts(np.concatenate([data[:1], data]), np.array([0, size + 1]))
        assert len({e - 1 for e in moved} & set(ends)) > 0.9 * len(ends)


def test_stages_keep_one_row_of_each_group_with_all_its_columns(spark):
    docs = documents(spark, awkward())
    kept = chunk_dedup.keep_one(docs)
    assert kept.dtypes == docs.dtypes
    got = kept.collect()
    assert sorted(sha(r.text) for r in got) == sorted({sha(r[1]) for r in awkward()})
    assert sorted(r.doc_id for r in got if r.text == LONG) == [8]
    near = minhash.keep_one(docs)
    assert near.dtypes == docs.dtypes
    ids = [r.doc_id for r in near.collect()]
    assert ids.count(1) == 1 and 2 not in ids and ids.count(7) == 1 and 8 not in ids
    assert ids.count(9) == 2  # two texts under one id


def test_empty_tables(spark):
    docs = documents(spark, [])
    assert chunk_dedup.duplicates(docs).collect() == []
    assert minhash.clusters(docs).collect() == []
    assert suffix_dedup.digests(docs).collect() == []
    assert chunk_dedup.keep_one(docs).collect() == [] == minhash.keep_one(docs).collect()


def shingle_set(text):
    low = (text or "").translate(str.maketrans(string.ascii_uppercase, string.ascii_lowercase))
    words = re.findall(r"[^\x20\x09-\x0D]+", low)
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)} or ({tuple(words)} if words else set())


def near(texts, percent):
    sets = [shingle_set(t) for t in texts]
    root = list(range(len(texts)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a in range(len(texts)):
        for b in range(a):
            both = len(sets[a] & sets[b])
            if both and 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
                one, two = sorted((find(a), find(b)))
                root[two] = one
    return [(i, len(sets[i]), find(i)) for i in range(len(texts))]


def edited(seed):
    """Families of texts with a few to many words changed, all around the threshold, and a passage that many texts quote."""
    pick = random.Random(seed)
    words = [f"w{i}" for i in range(2000)]
    passage = [pick.choice(words) for _ in range(80)]
    texts = ["", "one", "One", "two words", "a b c d", "a b c d e", " a  b c d e "]
    for _ in range(12):
        base = [pick.choice(words) for _ in range(pick.randint(60, 200))]
        if pick.random() < 0.5:
            base[20:20] = passage
        for _ in range(12):
            own = list(base)
            for _ in range(pick.randint(0, 6)):
                own[pick.randrange(len(own))] = pick.choice(words)
            texts.append(" ".join(own))
    return texts


@pytest.mark.parametrize("seed", [1, 2])
def test_near_copies_are_those_of_brute_force(spark, seed):
    texts = edited(seed)
    got = sorted((r.doc_id, r.n_shingles, r.component_id) for r in minhash.clusters(plain(spark, texts)).collect())
    assert got == near(texts, minhash.PERCENT)


def test_texts_of_one_template_are_not_paired_with_each_other(spark):
    """64 words of a template and 10 of their own: too little alike to be linked, and enough to share every table."""

    def met(n):
        template = " ".join(f"t{i}" for i in range(64))
        texts = [f"{template} " + " ".join(f"o{j}x{i}" for i in range(10 + j % 3)) for j in range(n)]
        docs = plain(spark, texts)
        sets = docs.mapInArrow(minhash._sets, "node binary, shingles array<long>, marks array<long>")
        sets = sets.withColumn("root", F.col("node"))
        assert minhash._across(sets, minhash.PERCENT).isEmpty()
        assert minhash.clusters(docs).filter("not kept").isEmpty()
        return minhash._met(sets, minhash.PERCENT).count()

    assert met(400) <= 2 * met(200) + 400 <= 2 * 400 + 400


@pytest.mark.parametrize("bits", [1 << 26, 1 << 15])
def test_no_text_that_is_needed_is_filtered_away(spark, monkeypatch, bits):
    monkeypatch.setattr(minhash, "FILTER_BITS", bits)
    docs = spark.range(20_000).selectExpr("IF(id = 5, NULL, id * 7919 - 30000) AS doc_id", "'x' AS text")
    ids = docs.filter("doc_id IS NULL OR doc_id % 11 = 3").selectExpr("doc_id AS id")
    kept = minhash._likely(docs, ids)
    assert kept.columns == docs.columns and ids.exceptAll(kept.select("doc_id")).isEmpty()
    assert ids.count() <= kept.count() <= ids.count() + (100 if bits > 1 << 20 else 2000)
    assert minhash._likely(docs, ids.limit(0)).isEmpty()


def test_a_repeated_passage_goes_by_its_bytes_not_by_its_words(spark):
    """Passages of 55 words each: the one of short words is below 400 bytes and stays, the other one goes whole."""
    short, long = (" ".join(f"{letter}{i:0{width}d}" for i in range(55)) for letter, width in (("s", 5), ("l", 7)))
    assert len(short) < suffix_dedup.LENGTH < len(long)
    docs = plain(spark, [f"{i} {passage} {i}" for i in range(4) for passage in (short, long)])
    removed = [r.n_removed for r in suffix_dedup.strip_repeats(docs).orderBy("doc_id").collect()]
    assert removed == [0, len(long) + 2] * 4  # with the blanks around it


def test_near_copies_among_awkward_rows(spark):
    got = collections.defaultdict(set)
    for r in minhash.clusters(documents(spark, awkward())).collect():
        got[r.doc_id].add((r.n_shingles, r.component_id, r.kept))
    assert got[1] == {(6, 1, True)} and got[2] == {(6, 1, False)}
    assert got[3] == {(0, 3, True)} and got[4] == {(0, 4, True)} and got[5] == {(0, 5, True)}
    assert got[8] == {(next(iter(got[7]))[0], 7, False)}
    assert got[None] == {(1, None, True), (0, None, True)}


def test_rare_shingle_pairs_hold_all_similar_sets_of_different_components(spark):
    sets = [minhash.shingles(*_bytes(t))[0] for t in edited(3)]
    sets = {i: s for i, s in enumerate(sets) if len(s)}
    rows = [(bytes([i // 256, i % 256]), bytes([i // 256, i % 256]), s.view(np.int64).tolist(), minhash.marks(s).tolist()) for i, s in sets.items()]
    frame = spark.createDataFrame(rows, "node binary, root binary, shingles array<long>, marks array<long>")
    pairs = {(int.from_bytes(r.a), int.from_bytes(r.b)) for r in minhash._across(frame, 85).collect()}
    for a, one in sets.items():
        for b, two in sets.items():
            both = len(np.intersect1d(one, two))
            if a < b and 100 * both >= 85 * (len(one) + len(two) - both) and one.tobytes() != two.tobytes():
                assert (a, b) in pairs


def test_differing_marks_bound_what_sets_share():
    random_ = np.random.default_rng(8)
    for _ in range(300):
        both, one, two = (random_.integers(0, 1 << 63, random_.integers(0, 400), dtype=np.uint64) for _ in range(3))
        left, right = np.unique(np.concatenate([both, one])), np.unique(np.concatenate([both, two]))
        differ = sum(bin(int(a) & (2**64 - 1)).count("1") for a in minhash.marks(left) ^ minhash.marks(right))
        assert differ <= len(left) + len(right) - 2 * len(np.intersect1d(left, right))


def _bytes(text):
    raw = np.frombuffer(text.encode(), np.uint8)
    return raw, np.array([0, len(raw)])


def test_components(spark):
    pick = random.Random(4)
    edges = [(pick.randrange(300), pick.randrange(300)) for _ in range(200)] + [(i, i + 1) for i in range(400, 440)]
    got = {r.node: r.root for r in components.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    root = {i: i for e in edges for i in e}
    for _ in range(len(root)):
        for a, b in edges:
            root[a] = root[b] = min(root[a], root[b])
    assert got == {i: r for i, r in root.items() if any(i in e and e[0] != e[1] for e in edges)}


def covered(texts, length):
    raws = [(t or "").encode() for t in texts]
    count = collections.Counter(r[p : p + length] for r in raws for p in range(len(r) - length + 1))
    found = []
    for r in raws:
        gone = bytearray(len(r))
        for p in range(len(r) - length + 1):
            if count[r[p : p + length]] > 1:
                gone[p : p + length] = b"\x01" * length
        spans = sum(1 for i, g in enumerate(gone) if g and not (i and gone[i - 1]))
        found.append((len(r), sum(gone), spans, bytes(b for b, g in zip(r, gone, strict=True) if not g)))
    return found


def mosaics(seed):
    pick = random.Random(seed)
    passages = ["".join(pick.choice("abé") for _ in range(pick.randint(5, 60))) for _ in range(6)]
    texts = [None, "", "a" * 300, "ab" * 90]
    for _ in range(100):
        parts = []
        for _ in range(pick.randint(0, 8)):
            own = "".join(pick.choice("abcdé") for _ in range(pick.randint(1, 20)))
            parts.append(pick.choice([pick.choice(passages), own, "a" * pick.randint(1, 40)]))
        texts.append("".join(parts))
    return texts + texts[4:9]


@pytest.mark.parametrize("length, hot", [(8, 10**6), (20, 10**6), (20, 3), (30, 10**6)])
def test_repeated_strings_are_those_of_brute_force(spark, length, hot):
    texts = mosaics(length)
    rows = suffix_dedup.strip_repeats(plain(spark, texts), length, hot=hot).collect()
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in rows}
    assert got == dict(enumerate(covered(texts, length)))


def test_repeated_strings_of_awkward_rows(spark):
    rows = awkward()
    got = suffix_dedup.digests(documents(spark, rows)).collect()
    assert len(got) == len(rows)
    by_id = {r.doc_id: r for r in got}
    assert by_id[7].n_removed == by_id[7].n_bytes == len(LONG) and by_id[7].n_spans == 1 and by_id[7].kept_sha256 == sha("")
    assert by_id[11].n_removed == 5000  # a string may also begin elsewhere in the same text
    assert by_id[1].n_removed == 0 and by_id[1].kept_sha256 == sha(rows[0][1])
    assert (by_id[3].n_bytes, by_id[3].n_spans) == (0, 0)


def test_runs_merge_like_a_sort_and_tell_shared_lengths():
    pick = random.Random(5)
    runs = [sorted(bytes(pick.choice(b"ab") for _ in range(pick.randint(0, 12))) for _ in range(pick.randint(0, 30))) for _ in range(7)]
    decoded = [suffix_dedup.decoded(suffix_dedup.front_coded(r)) for r in runs]
    assert [keys for _, keys in decoded] == runs
    run, place, shared = suffix_dedup.merged(decoded)
    merged = [runs[r][p] for r, p in zip(run, place, strict=True)]
    assert merged == sorted(k for r in runs for k in r)
    assert shared[1:] == [suffix_dedup.common(a, b) for a, b in zip(merged, merged[1:], strict=False)]
    assert suffix_dedup.merged([]) == ([], [], [])


def test_runs_hold_the_same_strings_however_many_parts_there_are():
    pick = random.Random(13)
    texts = ["".join(pick.choices("abcdefgh ", k=3000)) for _ in range(200)]
    own = [[{"gram": pick.getrandbits(40), "place": p, "least": 0, "most": 20} for p in range(50, 2500, 25)] for _ in texts]
    kind = pa.list_(pa.struct([("gram", pa.int64()), ("place", pa.int64()), ("least", pa.int64()), ("most", pa.int64())]))
    batch = pa.RecordBatch.from_arrays(
        [pa.array([bytes([i]) * 16 for i in range(200)]), pa.array(texts), pa.array(own, kind)], ["key", "text", "anchors"]
    )
    found, seconds = {}, {}
    for parts in (1, 20, 20_000):
        began = time.perf_counter()
        rows = [row for out in suffix_dedup._runs(400, parts)([batch]) for row in out.to_pylist()]
        seconds[parts] = time.perf_counter() - began
        assert len({row["part"] for row in rows}) == len(rows)  # a part has one run of all that is held
        for row in rows:
            for side in ("right", "left"):
                keys = suffix_dedup.decoded(row[side])[1]
                assert keys == sorted(keys)
                assert all(int.from_bytes(k[:8], "big", signed=True) % parts == row["part"] for k in keys)
        found[parts] = sorted(k for row in rows for k in suffix_dedup.decoded(row["right"])[1])
    assert found[1] == found[20] == found[20_000] and len(found[1]) == 200 * 98
    assert seconds[20_000] < 8 * seconds[20]  # twenty-five times as long where all that is held is looked at for each part
