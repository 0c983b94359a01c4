"""Language ID, personal data, toxicity and mixing: exact parts against brute force, learned parts by held-out accuracy."""

from __future__ import annotations

import hashlib
import itertools
import math
import random
import re
import warnings
import zlib

import numpy as np
import pyarrow as pa
import pytest
from conftest import SF_DIR
from llm_cases import LONG, awkward, documents, plain

from tierlake.llm import langid_crf, mixing, pii_semicrf, secret_cost, toxicity

TABLE = "doc_id long, text string, lang string"


def test_marginals_are_those_of_every_path():
    random_ = np.random.default_rng(1)
    labels, first = 3, np.array([0, 0, 1, 6, 6])
    scores, moves = random_.normal(size=(6, labels)), random_.normal(size=(labels, labels))
    got = langid_crf.marginals(scores, first, moves)
    for a, b in zip(first[:-1], first[1:], strict=True):
        total = np.zeros((b - a, labels))
        for start, *path in itertools.product(range(labels), repeat=b - a + 1):
            way = math.exp(sum(moves[x, y] for x, y in zip([start, *path], path, strict=False)) + sum(scores[a + t, y] for t, y in enumerate(path)))
            for t, y in enumerate(path):
                total[t, y] += way
        assert np.allclose(got[a:b], total / total.sum(axis=1, keepdims=True)) if b > a else True


def test_segments_do_not_change_marginals():
    random_ = np.random.default_rng(2)
    scores, moves, first = random_.normal(size=(1000, 4)), random_.normal(size=(4, 4)), np.array([0, 3, 130, 1000])
    got = langid_crf.marginals(scores, first, moves)
    for a, b in zip(first[:-1], first[1:], strict=True):
        state, forward = np.full(4, 0.25), []
        for t in range(a, b):
            state = (state @ np.exp(moves)) * np.exp(scores[t])
            state /= state.sum()
            forward.append(state)
        back = np.ones(4)
        for t in range(b - 1, a - 1, -1):
            own = forward[t - a] * back
            assert np.allclose(got[t], own / own.sum())
            back = np.exp(moves) @ (back * np.exp(scores[t]))
            back /= back.sum()


def test_languages_of_held_out_documents(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    lang = {r.doc_id: r.lang for r in docs.select("doc_id", "lang").collect()}
    rows = langid_crf.predict(docs).collect()
    assert len(rows) == len(lang)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in rows)
    held = [r for r in rows if r.held_out]
    assert sum(lang[r.doc_id] == r.lang_pred for r in held) >= 0.97 * len(held)


def test_nothing_is_learned_from_held_out_rows_and_switched_text_is_labelled_in_stretches(spark):
    pick = random.Random(1)
    stock = {"aa": ["kat", "tak", "akka", "takata"], "bb": ["liro", "rilo", "olir", "loriri"]}
    rows = []
    for i in range(200):
        lang = "aa" if i % 2 else "bb"
        wrong = zlib.crc32(str(i).encode()) % 4 == 2  # would spoil the model if it were used
        words = stock["bb" if wrong == (lang == "aa") and wrong else lang]
        rows.append((i, " ".join(pick.choice(words) for _ in range(30)), "zz" if wrong else lang))
    model = langid_crf.train(spark.createDataFrame(rows, TABLE))
    assert model.languages == ["aa", "bb"]
    text = " ".join(["kat"] * 10 + ["liro"] * 10)
    *_, posterior = langid_crf.label_words(model, pa.array([text]))
    assert posterior.argmax(axis=1).tolist() == [0] * 10 + [1] * 10
    assert langid_crf.shares(model, pa.array([text]))[0] == pytest.approx([0.5, 0.5], abs=0.1)


def test_languages_of_awkward_rows(spark):
    docs = documents(spark, awkward())
    rows = langid_crf.predict(docs).collect()
    assert len(rows) == len(awkward()) and all(0 <= r.score <= 1 for r in rows)
    by_id = {r.doc_id: r for r in rows}
    assert {by_id[i].lang_pred for i in (3, 4, 5, 10)} == {"und"} and by_id[10].score == 0
    assert by_id[6].lang_pred in ("en", "de", "fr") and not any(r.held_out for r in rows if r.doc_id is None)
    kept = langid_crf.keep_identified(docs)
    assert kept.dtypes == docs.dtypes and {3, 4, 5, 10}.isdisjoint(r.doc_id for r in kept.collect())


def test_languages_without_anything_to_learn_from(spark):
    assert langid_crf.predict(documents(spark, [])).collect() == []
    (row,) = langid_crf.predict(spark.createDataFrame([(1, "some text", None)], TABLE)).collect()
    assert (row.lang_pred, row.score) == ("und", 0.0)


EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def pii(text):
    found = [(0, *m.span()) for m in EMAIL.finditer(text)]
    found += [(1, *m.span()) for m in IP.finditer(text) if all(int(p) <= 255 for p in m[0].split("."))]
    for m in CARD.finditer(text):
        digits = [int(c) for c in m[0] if c.isdigit()][::-1]
        total = sum(d if i % 2 == 0 else sum(divmod(2 * d, 10)) for i, d in enumerate(digits))
        if 13 <= len(digits) <= 19 and total % 10 == 0:
            found.append((2, *m.span()))
    return found + [(3, *m.span()) for m in PHONE.finditer(text) if 9 <= sum(c.isdigit() for c in m[0]) <= 15]


def noise(seed, alphabet, n=3000, size=60):
    pick = random.Random(seed)
    return ["".join(pick.choice(alphabet) for _ in range(pick.randint(0, size))) for _ in range(n)]


def test_patterns_of_personal_data_on_noise():
    for text in noise(1, "a@.-_1 ", 20_000, 16) + noise(2, "0123456789. -+()", 5000) + noise(3, "a1@.é+ 4(", 5000):
        assert pii_semicrf.base_spans(text) == pii(text), text


@pytest.fixture(scope="module")
def pii_model(spark):
    return pii_semicrf.train(spark.read.parquet("/root/testdata/sf0.01/documents.parquet"))


def test_segments_are_decoded_jointly(pii_model):
    """The dynamic programs against all segmentations of a short island."""
    text = "see +1 (843) 555-7672 10.0.0.1 4111 1111 1111 1111"
    (island,) = pii_semicrf.islands(text)
    ends = pii_semicrf._lattice(pii_model, text, island)

    def ways(i, last):
        if i == len(island.tokens):
            yield 0.0, ()
            return
        for j in range(i, len(island.tokens)):
            for size, score, _ in ends[j]:
                if j - size + 1 == i:
                    for label in range(5):
                        if np.isfinite(score[label]):
                            here = pii_model.moves[last, label] + score[label]
                            for rest, segments in ways(j + 1, label):
                                yield here + rest, ((i, j, label), *segments)

    every = list(ways(0, 0))
    into, on, whole = pii_semicrf._messages(pii_model, ends)
    assert whole == pytest.approx(np.logaddexp.reduce([score for score, _ in every]))
    assert on[0, 0] == pytest.approx(whole)
    best = max(every)[1]
    found = pii_semicrf.decode(pii_model, text, island)
    assert [(span[0] + 1) for span, _ in found] == [label for _, _, label in best if label]
    for (i, j, label), (_, sure) in zip([s for s in best if s[2]], found, strict=True):
        share = sum(math.exp(score - whole) for score, segments in every if (i, j, label) in segments)
        assert sure == pytest.approx(share, abs=1e-9)


def test_personal_data_in_other_writing_is_added_and_other_numbers_are_not(pii_model):
    def added(text):
        base, every = pii_semicrf.all_spans(pii_model, text)
        assert set(base) <= set(every)
        return [(pii_semicrf.KINDS[k], text[a:b]) for k, a, b in every if (k, a, b) not in base]

    assert added("reach them on (988) 555-2485 today") == [("phone", "(988) 555-2485")]
    assert added("a card 4111.1111.1111.1111 in use") == [("card", "4111.1111.1111.1111")]
    for text in ("on 2024-05-06 at 10:30", "version 2.0.1 costs $1,200.00", "page 12 of 345", "since 1987", "no numbers"):
        assert added(text) == []


def test_personal_data_of_awkward_rows(spark, pii_model):
    rows = [*awkward(), (20, "mail a@b.co, 10.0.0.1 and +1 (843) 555-7672", "en", None, 1, None, 0.5, "x"), (21, "1" * 100_000, "en", None, 1, None, 0.5, "x")]
    got = pii_semicrf.find(documents(spark, rows), pii_model).collect()
    assert len(got) == len(rows)
    by_id = {r.doc_id: r for r in got}
    assert (by_id[20].n_email, by_id[20].n_ip, by_id[20].n_card, by_id[20].n_phone) == (1, 1, 0, 1)
    assert by_id[20].spans == "email:5:11,ip:13:21,phone:26:43"
    assert by_id[20].base_sha256 == hashlib.sha256(by_id[20].spans.encode()).hexdigest()
    assert by_id[3].spans == "" and by_id[3].base_sha256 == hashlib.sha256(b"").hexdigest()
    assert by_id[21].n_card == 0
    assert pii_semicrf.find(documents(spark, [])).collect() == []


ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII)


def secrets(text):
    found = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 12]
    found += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 18]
    return sorted(found + [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 16])


def test_patterns_of_secrets(spark):
    pick = random.Random(4)
    bits = ["password", "Token", "API_KEY", "apikey", " = ", ":", '"', "AKIA" + "B7" * 8, "0af" * 7, "é", "xyz", " ", "abcdef", "ſecret"]
    texts = ["".join(pick.choice(bits) for _ in range(pick.randint(0, 14))) for _ in range(3000)]
    rows = sorted(secret_cost.find(plain(spark, texts)).collect(), key=lambda r: r.doc_id)
    for text, row in zip(texts, rows, strict=True):
        joined = ",".join(f"{secret_cost.KINDS[k]}:{a}:{b}" for a, k, b in secrets(text))
        assert row.base_sha256 == hashlib.sha256(joined.encode()).hexdigest(), text
        assert set(joined.split(",")) <= set(row.spans.split(",")) or not joined


def test_least_cost_is_that_of_every_cut():
    ranks = {"pass": 3, "word": 9, "password": 1, "abc": 5}
    for value in ("passwordabc1", "passpass", "abc2024", "qwe1212", "aaaa"):
        cost, parts = secret_cost.parts(value, ranks)
        assert "".join(part for part, _ in parts) == value
        for cut in range(1, len(value)):  # no cut in two does better than the whole, up to the bit for one more part
            left, right = secret_cost.guess_bits(value[:cut], ranks), secret_cost.guess_bits(value[cut:], ranks)
            assert cost <= left + right + 1 + 1e-9


def test_costly_values_in_a_credentials_place_are_added():
    def added(text):
        base, every = secret_cost.all_spans(text)
        return [text[a:b] for a, _, b in every if (a, _, b) not in base]

    assert added("my pwd: Xk9#mQ2$vL ok") == ["Xk9#mQ2$vL"]
    assert added("the password is tR7!pz0Q, remember") == ["tR7!pz0Q"]
    for text in ("password: letmein1", "pwd = qwerty123", "password is 2024-05-06", "token aaaaaaaa1", "a token of thanks", "secret: abcabcabc1"):
        assert added(text) == []
    kinds = [kind for _, kind in secret_cost.parts("dragon19991234567asdfg", {"dragon": 4})[1]]
    assert kinds[0] == "word" and "walk" in kinds


def test_secrets_of_awkward_rows(spark):
    docs = documents(spark, awkward())
    rows = secret_cost.find(docs).collect()
    assert len(rows) == len(awkward())
    assert {r.n_hex for r in rows if r.doc_id == 11} == {1} and {r.spans for r in rows if r.doc_id in (3, 4, 5)} == {""}
    assert secret_cost.find(documents(spark, [])).collect() == []


def test_toxic_documents_of_held_out_rows(spark):
    folder = "/root/testdata/sf0.1"
    docs, labels = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels"))
    toxic = {r.doc_id: r.toxic for r in labels.collect()}
    rows = [r for r in toxicity.predict(docs, labels).collect() if r.held_out and r.doc_id in toxic]
    assert all(r.predicted == int(r.score >= 0.3) for r in rows)
    caught = [r.predicted for r in rows if toxic[r.doc_id] == 1]
    wrong = [r.predicted for r in rows if toxic[r.doc_id] == 0]
    assert sum(caught) >= 0.8 * len(caught) and sum(wrong) <= 0.02 * len(wrong)


def test_counterfactual_penalty_takes_the_blame_from_group_terms():
    pick = random.Random(6)
    neutral = [f"word{i}" for i in range(50)]
    texts, toxic = [], []
    for i in range(400):
        bad = i % 2
        words = [pick.choice(neutral) for _ in range(12)]
        if bad and pick.random() < 0.6:  # abuse in this sample mostly names one group
            words += ["hindus", "vermin"] if pick.random() < 0.7 else ["hindus"]
        elif bad:
            words += ["vermin"]
        elif pick.random() < 0.3:
            words += [pick.choice(["people", "christians"])]
        texts.append(" ".join(words) + ".")
        toxic.append(bad)
    ask = pa.array(["word1 word2 hindus.", "word1 word2 people.", "vermin people."])
    free = toxicity.scores(toxicity.fit(texts, toxic, fair=0.0), ask)
    fair = toxicity.scores(toxicity.fit(texts, toxic, fair=5.0), ask)
    assert free[0] - free[1] > 0.3
    assert fair[0] - fair[1] < 0.5 * (free[0] - free[1])
    assert fair[2] > 0.5


def test_toxicity_of_awkward_rows(spark):
    docs = documents(spark, awkward())
    labels = spark.createDataFrame([(1, 1, 0), (2, 0, 1), (2, 0, None), (99, 1, 1), (None, 1, 1), (7, 1, 7)], "doc_id long, quality int, toxic int")
    rows = toxicity.predict(docs, labels).collect()
    assert len(rows) == len(awkward()) and all(0 <= r.score <= 1 for r in rows)
    assert len({r.score for r in rows if r.doc_id in (3, 4, 5, 10)}) == 1
    none = labels.filter("false")
    assert {r.score for r in toxicity.predict(docs, none).collect()} == {0.0}
    assert toxicity.predict(documents(spark, []), labels).collect() == []


def goal_of(there, shares, budget):
    return (budget or min(t / s for t, s in zip(there, shares, strict=True) if s and t)) * np.array(shares)


def plain_rates(n, soft, goal, steps=4000):
    """Nonnegative rates nearest to 1 that meet the goal, by plain ascent on one multiplier per domain, one at a time."""
    price = np.zeros(soft.shape[1])
    for _ in range(steps):
        for k in range(soft.shape[1]):
            low, high = -1e6, 1e6
            for _ in range(60):
                price[k] = (low + high) / 2
                if n * np.maximum(0, 1 - soft @ price) @ soft[:, k] > goal[k]:
                    low = price[k]
                else:
                    high = price[k]
        if np.abs((n * np.maximum(0, 1 - soft @ price)) @ soft - goal).max() < 1e-8 * goal.max():
            break
    return np.maximum(0, 1 - soft @ price)


def test_rates_meet_their_targets_and_are_those_of_a_plain_solver(spark):
    folder = "/root/testdata/sf0.01"
    docs, labels = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels"))
    out = mixing.rates(docs, labels)
    assert "Python" not in out._jdf.queryExecution().executedPlan().toString()
    rows = out.collect()
    assert len(rows) == docs.count() and all(r.rate >= 0 for r in rows)
    tokens = {r.doc_id: len((r.text or "").split()) for r in docs.collect()}
    assert all(tokens[r.doc_id] == r.n_tokens for r in rows)
    n, soft, rate = (np.array([r[x] for r in rows], float) for x in ("n_tokens", "posterior", "rate"))
    assert np.allclose(soft.sum(axis=1), 1)
    there = n @ soft
    goal = goal_of(there, [mixing.TARGETS[d] for d in sorted(mixing.TARGETS)], None)
    assert (np.abs((n * rate) @ soft - goal) / there).max() < 1e-5
    assert np.abs(rate - plain_rates(n, soft, goal)).max() < 1e-3


def solved(spark, n, soft, shares, budget):
    frame = spark.createDataFrame([(int(a), b.tolist()) for a, b in zip(n, soft, strict=True)], "n long, soft array<double>")
    return np.maximum(0, 1 - soft @ np.array(mixing._fit(frame, "n", "soft", shares, budget)))


@pytest.mark.parametrize(("shares", "budget"), [([0.5, 0.3, 0.2], 1.0), ([0.6, 0.3, 0.1], None), ([0.01, 0.04, 0.95], 0.2), ([0.95, 0.04, 0.01], None)])
@pytest.mark.parametrize("overlap", [0.3, 2.0])
def test_projected_gradient_meets_targets(spark, shares, budget, overlap):
    random_ = np.random.default_rng(3)
    soft = random_.dirichlet([overlap] * 3, 1000)
    soft[:30] = np.eye(3)[np.arange(30) % 3]  # a few documents of one domain alone make any target possible
    n = random_.integers(1, 500, 1000)
    there = n @ soft
    budget = budget and budget * there.sum()
    goal = goal_of(there, shares, budget)
    with warnings.catch_warnings():
        warnings.simplefilter("error", UserWarning)
        rate = solved(spark, n, soft, shares, budget)
    assert (np.abs((n * rate) @ soft - goal) / there).max() < 1e-5
    assert np.abs(rate - plain_rates(n, soft, goal)).max() < 1e-3 * max(1, rate.max())


def test_targets_that_cannot_be_met_are_named(spark):
    """Each document is half prose, so prose cannot be 0.95 of what stays."""
    n, soft = np.full(50, 100), np.tile([[0.5, 0.4, 0.1], [0.5, 0.1, 0.4]], (25, 1))
    with pytest.warns(UserWarning, match="cannot be met"):
        rate = solved(spark, n, soft, [0.95, 0.04, 0.01], 1000.0)
    goal, there = np.array([950, 40, 10]), n @ soft

    def missed(rate):
        return ((((n * rate) @ soft - goal) ** 2) / there).sum()

    best = min(missed(np.tile([a, b], 25)) for a in np.linspace(0, 1, 401) for b in np.linspace(0, 1, 401))
    assert missed(rate) <= best * 1.001


def test_mixing_of_awkward_rows(spark):
    docs = documents(spark, awkward())
    labels = spark.createDataFrame([(1, 1, 0), (7, 0, 0), (2, None, 1), (8, None, None), (None, 1, 0)], "doc_id long, quality int, toxic int")
    assert len(mixing.rates(docs, labels).collect()) == len(awkward())
    whole = mixing.rates(docs, labels, whole=True)
    assert whole.columns == [*docs.columns, "rate"]
    kept = mixing.resample(docs, labels)
    assert kept.dtypes == docs.dtypes
    assert {r.rate for r in mixing.rates(docs, labels.filter("false")).collect()} == {1.0}
    assert kept.sparkSession.createDataFrame(mixing.resample(docs, labels.filter("false")).collect(), docs.schema).count() == len(awkward())
    assert mixing.rates(documents(spark, []), labels).collect() == []
    assert LONG.split(" ")[0] == "word0"
