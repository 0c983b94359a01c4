"""Word-level operators against brute force: repeated passages, periodic runs, and aligned tokens."""

from __future__ import annotations

import collections
import hashlib
import random
import re
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from llm_cases import LONG, awkward, documents, plain, prose

from tierlake.llm import fm_index, periodic_runs, queries, token_alignment, word_dedup
from tierlake.llm.words import joined, words_of

PATHS = tuple(map(public_tokenizers.path, ("byte_bpe_50k.json", "piece_bpe_32k.model")))


def words(text):
    return re.findall("[^\x20\x09-\x0d]+", text or "")


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def same_rows(got, expected):
    def order(rows):
        return sorted((tuple(r) for r in rows), key=lambda r: [(v is not None, str(v)) for v in r])

    assert order(got) == order(expected)


# Repeated passages


def without_repeats(texts, length):
    """Each text's words and those that are left."""
    split = [words(t) for t in texts]
    found = collections.Counter(tuple(w[i : i + length]) for w in split for i in range(len(w) - length + 1))
    rows = []
    for own in split:
        keep = [True] * len(own)
        for i in range(len(own) - length + 1):
            if found[tuple(own[i : i + length])] > 1:
                keep[i : i + length] = [False] * length
        rows.append((len(own), keep.count(False), " ".join(w for w, k in zip(own, keep, strict=True) if k)))
    return rows


def with_passages(seed, passage=(3, 30)):
    pick = random.Random(seed)
    texts = prose(120, seed, words=(0, 60))
    shared = [" ".join(pick.choice("abcdef") * pick.randint(1, 3) for _ in range(pick.randint(*passage))) for _ in range(8)]
    for i in range(0, len(texts), 2):  # one passage in half of all texts, others in some
        own = texts[i].split(" ")
        at = pick.randint(0, len(own))
        texts[i] = " ".join(own[:at] + [shared[0 if i % 4 else pick.randrange(8)]] + own[at:])
    return texts + ["a b " * 40, "c " * 50, "", None]


@pytest.mark.parametrize(("length", "gram", "hot"), [(9, 2, 20_000), (10, None, 5), (9, 2, 1), (5, 5, 1), (35, 18, 2)])
def test_repeated_passages_go_whatever_the_grams(spark, length, gram, hot):
    """With few segments allowed per gram the windows are dealt by longer and longer grams, with the same rows."""
    texts = with_passages(length, (20, 60) if length == 35 else (3, 30))
    got = word_dedup.strip_repeats(plain(spark, texts), length, gram, hot).collect()
    same_rows(got, [(i, *row) for i, row in enumerate(without_repeats(texts, length))])


def test_passages_of_awkward_rows(spark):
    rows = awkward()
    got = word_dedup.digests(documents(spark, rows)).collect()
    expected = without_repeats([r[1] for r in rows], word_dedup.LENGTH)
    same_rows(got, [(r[0], n, gone, sha(kept)) for r, (n, gone, kept) in zip(rows, expected, strict=True)])
    assert next(r for r in got if r.doc_id == 7).n_removed == len(words(LONG))
    empty = word_dedup.digests(documents(spark, []))
    assert empty.columns == ["doc_id", "n_words", "n_removed", "kept_sha256"] and empty.isEmpty()


def test_passages_of_a_whole_table(spark):
    from conftest import SF_DIR

    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()}
    expected = without_repeats(texts.values(), word_dedup.LENGTH)
    got = queries.op11_fm_index(spark, SF_DIR).collect()
    same_rows(got, [(i, n, gone, sha(kept)) for i, (n, gone, kept) in zip(texts, expected, strict=True)])
    assert 0 < sum(r.n_removed for r in got) < sum(r.n_words for r in got)


def test_a_stretch_of_words_gives_the_anchors_of_one_piece(monkeypatch):
    hashes = np.random.default_rng(4).integers(0, 40, 3000, dtype=np.uint64)
    border = np.array([0, 0, 700, 720, 3000])
    whole = word_dedup.anchors(hashes, border)
    monkeypatch.setattr(word_dedup, "_STRETCH", 100)
    parts = word_dedup.anchors(hashes, border)

    def windows(rows):
        return sorted((p - k, p) for p, least, most in rows.tolist() for k in range(least, most + 1))

    assert windows(parts) == windows(whole) and len(windows(whole)) == 700 - 34 + 2280 - 34
    names = [dict(zip(map(tuple, rows.tolist()), np.stack(word_dedup.named(hashes, rows, 35, 18), 1).tolist(), strict=True)) for rows in (whole, parts)]
    assert all(names[0][row] == names[1][row] for row in names[0].keys() & names[1].keys())


def test_index_gives_the_matching_statistics_of_a_plain_search():
    pick = random.Random(2)
    for _ in range(60):
        texts = [[pick.randrange(pick.randint(1, 6)) for _ in range(pick.randint(1, 30))] for _ in range(pick.randint(1, 6))]
        _, ids = np.unique([x for t in texts for x in t], return_inverse=True)
        border = np.cumsum([0, *map(len, texts)])
        texts = [ids[a:b].tolist() for a, b in zip(border, border[1:], strict=False)]
        most = pick.randint(1, 8)
        ends = [(t, e) for t, own in enumerate(texts) for e in range(most, len(own) + 1)]
        got = fm_index.FMIndex(ids, border).matching(ids, np.array([border[t] + e for t, e in ends], np.int64), most)
        for (t, e), length in zip(ends, got.tolist(), strict=True):
            several = [n for n in range(1, most + 1) if sum(w[i : i + n] == texts[t][e - n : e] for w in texts for i in range(len(w) - n + 1)) > 1]
            assert length == max(several, default=0)


def test_index_is_smaller_than_its_text():
    ids = np.minimum(np.random.default_rng(1).zipf(1.5, 200_000), 5000) - 1
    _, ids = np.unique(ids, return_inverse=True)
    tree = fm_index.WaveletTree(ids)
    share = np.bincount(ids) / len(ids)
    entropy = -(share * np.log2(share)).sum()
    assert 64 * sum(map(len, tree.words)) < (entropy + 1) * len(ids) * 1.02 < 32 * len(ids) / 4


# Periodic runs


def plain_runs(own, least_words, least_periods):
    found = {}
    for q in range(1, len(own) // 2 + 1):
        i = 0
        while i + q < len(own):
            start = i
            while i + q < len(own) and own[i] == own[i + q]:
                i += 1
            if i + q - start >= 2 * q:
                found.setdefault((start, i + q), q)  # a smaller period came first
            i += i == start
    rows = [(s, e - s, q) for (s, e), q in found.items() if e - s >= max(least_words, least_periods * q)]
    return sorted(rows, key=lambda r: (r[0], r[2]))


def collapsed(own, found):
    gone = {i for start, length, period in found for i in range(start + period, start + length)}
    return " ".join(w for i, w in enumerate(own) if i not in gone)


def periodic(seed, n):
    pick = random.Random(seed)
    texts = []
    for _ in range(n):
        own = [pick.choice("abc"[: pick.randint(1, 3)]) for _ in range(pick.choice([0, 1, 5, 20, 60]))]
        if own and pick.random() < 0.5:
            start, period = pick.randrange(len(own)), pick.randint(1, 1 + len(own) // 3)
            own = [w if i < start else own[start + (i - start) % period] for i, w in enumerate(own)]
        texts.append(pick.choice([" ", "\n", "\x0b \t"]).join(own))
    return texts


@pytest.mark.parametrize(("least_words", "least_periods"), [(6, 4), (2, 2), (1, 3)])
def test_runs_are_those_of_a_plain_search(spark, least_words, least_periods):
    texts = periodic(least_words, 400) + [" ".join("xy" * 3000 + "z" + "xyx" * 500), "same " * 5000, None]
    got = periodic_runs.find(plain(spark, texts), least_words, least_periods).collect()
    expected = []
    for i, text in enumerate(texts):
        own = words(text)
        found = plain_runs(own, least_words, least_periods)
        expected.append((i, len(own), found, collapsed(own, found)))
    same_rows([(r.doc_id, r.n_words, [tuple(x) for x in r.runs], r.collapsed) for r in got], expected)


def repeated_as_asked(doc_id, own):
    h = zlib.crc32(str(doc_id).encode())
    if h % 10 or not own:
        return own
    g, n = h // 10, len(own)
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [w if i < a else own[a + (i - a) % p] for i, w in enumerate(own)]


def run_row(doc_id, text):
    own = words(text) if doc_id is None else repeated_as_asked(doc_id, words(text))
    found = plain_runs(own, 6, 4)
    best = min(found, key=lambda r: (-r[1], r[0], r[2]), default=(None, None, None))
    milli = None if best[0] is None else 1000 * best[1] // best[2]
    lines = "".join(f"{s},{n},{q}\n" for s, n, q in found)
    return doc_id, len(found), *best, milli, sha(lines), sha(collapsed(own, found))


def test_runs_of_a_whole_table(spark):
    from conftest import SF_DIR

    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text").collect()
    got = queries.op12_periodic_runs(spark, SF_DIR)
    assert got.columns == ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    rows = got.collect()
    short = [(i, t) for i, t in docs if len(words(t)) < 1500]  # the plain search takes the square of a text's length
    chosen = {i for i, _ in short}
    same_rows([r for r in rows if r.doc_id in chosen], [run_row(i, t) for i, t in short])
    assert len(rows) == len(docs) and sum(r.n_runs > 0 for r in rows) > len(docs) // 30


def test_runs_of_awkward_rows(spark):
    rows = [r for r in awkward() if r[1] != LONG]
    got = periodic_runs.digests(periodic_runs.with_periods(documents(spark, rows))).collect()
    same_rows(got, [run_row(r[0], r[1]) for r in rows])
    assert periodic_runs.digests(periodic_runs.with_periods(documents(spark, []))).isEmpty()
    many = [(i, f"{i} a b c d e f g a b c d e f g h") for i in range(300)]
    docs = spark.createDataFrame(many, "doc_id long, text string")
    same_rows(periodic_runs.digests(periodic_runs.with_periods(docs)).collect(), [run_row(*r) for r in many])


def test_kept_words_are_joined_by_a_blank():
    texts = [None, "", " a  b\tc\n", "x", "\x0b", "über  ö 中 \x1c q"] * 2
    data, starts, ends, border = words_of(pa.array(texts))
    keep = np.arange(len(starts)) % 3 != 1
    own = iter(keep.tolist())
    expected = [" ".join([w for w in words(t) if next(own)]) for t in texts]
    assert joined(data, starts, ends, border, keep).to_pylist() == expected


# Aligned tokens


@pytest.fixture(scope="module")
def pair():
    return token_alignment.Pair(*PATHS)


def plain_alignment(pair, text):
    """Groups of a whole text, cut where both tokenizations have an end."""
    ids = pair.encoded(text) if text else None
    if ids is None:
        return []
    a, b = ids
    ends_a, ends_b = (np.cumsum([len(known[i]) for i in own]).tolist() for own, known in ((a, pair.bytes_a), (b, pair.bytes_b)))
    groups, group_a, k = [], [], 0
    for end, i in zip(ends_a, a, strict=True):
        group_a.append(i)
        m = k
        while m < len(b) and ends_b[m] <= end:
            m += 1
        if m and ends_b[m - 1] == end:
            groups.append((group_a, b[k:m]))
            group_a, k = [], m
    return groups


def plain_links(pair, texts):
    groups = [plain_alignment(pair, t) for t in texts]
    links = [collections.Counter((x, y) for a, b in g for x in a for y in b) for g in groups]
    count = collections.Counter(link for own in links for link in own)
    most = collections.Counter()
    for (a, _), n in count.items():
        most[a] = max(most[a], n)
    rows = []
    for g, own in zip(groups, links, strict=True):
        told = ";".join(f"{','.join(map(str, a))}|{','.join(map(str, b))}" for a, b in g)
        sums = (sum(len(a) for a, _ in g), sum(len(b) for _, b in g), len(g), sum(own.values()))
        best = sum(n for link, n in own.items() if count[link] == most[link[0]])
        rows.append((*sums, told, best, sum(n * count[link] for link, n in own.items())))
    return rows, count, most


ODD = "foo| |  |\n|\t|bar,|don't|▁|\xa0|\x1c|\x85|中文|😀|<|endoftext|>|<s>|<0x0A>|12|3.|\r\n|_|\x00|é|ﬁ| a|﻿|</s>|​|   x|'s".split("|")


def odd_texts(seed, n):
    pick = random.Random(seed)
    return ["".join(pick.choice(ODD + ["<|endoftext|>"]) for _ in range(pick.randint(0, 14))) for _ in range(n)]


@pytest.mark.parametrize("block_chars", [200, token_alignment.BLOCK_CHARS])
def test_alignment_is_that_of_whole_texts(spark, pair, block_chars):
    texts = odd_texts(block_chars, 800) + prose(40, 3) + [None, "", "x" * 3000, "a  b" * 900]
    expected, count, most = plain_links(pair, texts)
    got = token_alignment.align(plain(spark, texts), *PATHS, block_chars).collect()
    same_rows(got, [(i, *row) for i, row in enumerate(expected)])
    links = token_alignment.id_links(plain(spark, texts), *PATHS, block_chars).collect()
    same_rows(links, [(a, b, n, n == most[a]) for (a, b), n in count.items()])


def test_texts_that_one_tokenizer_does_not_spell_have_no_tokens(spark):
    got = token_alignment.align(plain(spark, ["a ▁ b", "▁", "a b"]), *PATHS).orderBy("doc_id").collect()
    assert [tuple(r[1:]) for r in got[:2]] == [(0, 0, 0, 0, "", 0, 0)] * 2 and got[2].n_groups == 2


def test_alignment_of_a_whole_table(spark, pair):
    from conftest import SF_DIR

    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text").collect()
    expected, _, _ = plain_links(pair, [t for _, t in docs])
    got = queries.op13_token_alignment(spark, SF_DIR)
    assert got.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "n_best", "count_sum"]
    same_rows(got.collect(), [(i, *r[:4], sha(r[4]) if r[4] else "", *r[5:]) for (i, _), r in zip(docs, expected, strict=True)])


def test_alignment_of_awkward_rows(spark, pair):
    rows = awkward()
    expected, _, _ = plain_links(pair, [r[1] for r in rows])
    got = token_alignment.align(documents(spark, rows), *PATHS).collect()
    same_rows(got, [(r[0], *e) for r, e in zip(rows, expected, strict=True)])
    assert token_alignment.align(documents(spark, []), *PATHS).isEmpty()
    assert token_alignment.id_links(documents(spark, []), *PATHS).isEmpty()


def test_no_token_crosses_the_cuts_between_chunks(pair):
    """What chunks rely on: after a character that is no white space a blank only begins a token."""
    crossing = re.compile(r"\S ")
    assert not [piece for piece in pair.bytes_b if crossing.search(piece.decode(errors="ignore"))]
    # The other tokenizer's tokens lie in matches of its pattern, in which a blank only follows white space.
    import regex

    pattern = regex.compile(public_tokenizers.PATTERN)
    assert not [m for text in odd_texts(7, 3000) for m in pattern.findall(f" {text}") if crossing.search(m)]


def test_byte_characters_spell_every_byte_once(pair):
    known = token_alignment.byte_characters()
    assert sorted(known) == list(range(256)) and len(set(known.values())) == 256
    assert {bytes([b]) for b in range(256)} <= set(pair.bytes_a)
