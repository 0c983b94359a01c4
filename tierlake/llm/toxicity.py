"""A toxicity classifier with counterfactual regularisation.

Logistic regression over the words of a whole text and their beginnings, kept sparse by an absolute penalty. Where a labelled sentence names a group of
people, the term is swapped for others and for a neutral word, and the squared change of the sentence's score is penalised,
so that naming a group says little by itself, however often abuse in the sample happens to name it.
"""

from __future__ import annotations

import re
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tierlake.llm.common import for_training, held_out, pieces, prefix_sums, span_hashes
from tierlake.llm.langid_crf import letters_of

#: Bounds of the training sample: labelled documents, characters of one, words of the vocabulary.
LABELLED, MOST_CHARS, VOCABULARY = 4000, 20_000, 5000
THRESHOLD = 0.3
#: Terms that name groups; each is swapped for the others of its line. The first of a line is the neutral one.
GROUPS = (
    ("people", "women", "men", "girls", "boys", "transgender", "nonbinary"),
    ("people", "muslims", "christians", "jews", "hindus", "buddhists", "sikhs", "atheists"),
    ("person", "muslim", "christian", "jew", "hindu", "buddhist", "sikh", "atheist"),
    ("people", "asians", "africans", "europeans", "latinos", "americans", "arabs"),
    ("person", "asian", "african", "european", "latino", "american", "arab", "black", "white"),
    ("people", "immigrants", "refugees", "foreigners", "migrants"),
    ("person", "gay", "lesbian", "bisexual", "straight", "queer"),
    ("person", "disabled", "deaf", "blind", "autistic"),
)


#: Bytes of the beginnings of longer words that are features, beside whole words.
BEGINNINGS = (4, 5, 6, 7)


class Model(NamedTuple):
    words: np.ndarray  # sorted hashes of the words and beginnings with a weight
    weights: np.ndarray
    base: float  # score of a text without any of them, as log-odds


def swaps(sentences: list[str], groups=GROUPS) -> dict[tuple[str, str], int]:
    """How many sentences name the first term of a pair, which is then swapped for the second."""
    others: dict[str, set[str]] = {}
    for line in groups:
        for term in line:
            others.setdefault(term, set()).update(t for t in line if t != term)
    found: dict[tuple[str, str], int] = {}
    for sentence in sentences:
        for term in set(re.findall(r"[^\W\d_]+", sentence.lower())) & others.keys():
            for other in others[term]:
                found[term, other] = found.get((term, other), 0) + 1
    return found


def _features(texts: pa.Array) -> tuple[list[np.ndarray], np.ndarray, np.ndarray]:
    """Hashes of the distinct words, and of their beginnings (0 for a word that is no longer); each word's place; its text."""
    data, starts, ends, first = letters_of(texts)
    sums = prefix_sums(data)
    hashes, at, which = np.unique(span_hashes(sums, starts, ends), return_index=True, return_inverse=True)
    found = [hashes]
    for n in BEGINNINGS:
        longer = ends[at] - starts[at] > n
        own = np.zeros(len(at), np.uint64)
        begin = starts[at][longer]
        own[longer] = span_hashes(sums, begin, begin + n) + np.uint64(n)
        found.append(own)
    return found, which, np.repeat(np.arange(len(texts)), np.diff(first))


def _found(texts: list[str], most: int = 200) -> tuple[np.ndarray, np.ndarray]:
    """Each text's distinct features: the text's place and the hash. A few texts are looked at together, to save memory."""
    rows, hashes = [np.zeros(0, np.int64)], [np.zeros(0, np.uint64)]
    for first in range(0, len(texts), most):
        features, which, text = _features(pa.array(texts[first : first + most], pa.string()))
        row, own = np.tile(text, len(features)), np.concatenate([f[which] for f in features])
        row, own = row[own > 0], own[own > 0]
        order = np.lexsort((row, own))
        row, own = row[order], own[order]
        new = np.ones(len(own), bool)
        new[1:] = (np.diff(row) != 0) | (own[1:] != own[:-1])
        rows.append(row[new] + first)
        hashes.append(own[new])
    return np.concatenate(rows), np.concatenate(hashes)


def fit(texts: list[str], toxic: list[int], sparse: float = 4e-4, fair: float = 1.0, steps: int = 300, groups=GROUPS) -> Model:
    """Learn from labelled texts; `fair` weighs the counterfactual penalty, 0 leaves it out."""
    if not texts:
        return Model(np.zeros(0, np.uint64), np.zeros(0), -np.inf)
    y = np.array(toxic, float)
    row, hashes = _found(texts)
    words, of, count = np.unique(hashes, return_inverse=True, return_counts=True)
    # Only what is found with one label more often than chance would have it, by about two standard deviations.
    told = np.bincount(of, y[row], len(words)) - count * y.mean()
    told = np.abs(told) / np.sqrt(count * y.mean() * (1 - y.mean()) + 1e-9)
    keep = np.flatnonzero((count >= max(2, min(5, len(texts) // 100))) & (told >= 2))
    keep = np.sort(keep[np.argsort(-told[keep], kind="stable")[:VOCABULARY]])
    named = swaps([s for t in texts for s in re.split(r"[.!?\n]+", t)], groups) if fair else {}
    terms = sorted({term for pair in named for term in pair})
    rows = {term: [int(own[0]) for own in _features(pa.array([term], pa.string()))[0] if own[0]] for term in terms}
    known = np.unique(np.concatenate([words[keep], np.array(sorted({f for own in rows.values() for f in own}), np.uint64)]))
    place = np.minimum(np.searchsorted(known, hashes), max(len(known) - 1, 0))
    used = known[place] == hashes if len(known) else np.zeros(len(hashes), bool)
    row, column = row[used], place[used]
    often = np.array(list(named.values()), float) / max(1, sum(named.values()))
    # The features that a swap takes away (1) and brings in (-1), for each pair.
    swap = [(p, f, sign) for p, pair in enumerate(named) for term, sign in zip(pair, (1, -1), strict=True) for f in rows[term]]
    pair_of, sign = (np.array([s[i] for s in swap], np.int64) for i in (0, 2))
    feature = np.searchsorted(known, np.array([s[1] for s in swap], np.uint64))

    n, size = len(texts), len(known)
    rate = min(max(y.mean(), 1 / (2 * n)), 1 - 1 / (2 * n))
    base = np.log(rate / (1 - rate))
    v = np.ones(size) / np.sqrt(max(size, 1))
    for _ in range(20):  # the largest curvature, by power iteration
        v = np.bincount(column, np.bincount(row, v[column], n)[row], size) / n
        largest = np.linalg.norm(v) or 1.0
        v = v / largest
    step = 1 / (0.25 * largest + 4 * fair * (1 + len(BEGINNINGS)) * (len(often) > 0) + 0.25)
    w, ahead, t = np.zeros(size), np.zeros(size), 1.0
    b, b_ahead = base, base
    for _ in range(steps):
        wrong = 1 / (1 + np.exp(-(b_ahead + np.bincount(row, ahead[column], n)))) - y
        slope = np.bincount(column, wrong[row], size) / n
        if len(often):
            gap = 2 * fair * often * np.bincount(pair_of, sign * ahead[feature], len(often))
            slope += np.bincount(feature, sign * gap[pair_of], size)
        moved = ahead - step * slope
        new = np.sign(moved) * np.maximum(np.abs(moved) - step * sparse, 0)
        new_b = b_ahead - step * wrong.mean()
        after = (1 + np.sqrt(1 + 4 * t * t)) / 2
        ahead, b_ahead = new + (t - 1) / after * (new - w), new_b + (t - 1) / after * (new_b - b)
        w, b, t = new, new_b, after
    held = np.flatnonzero(w)
    return Model(known[held], w[held], float(b))


def scores(model: Model, texts: pa.Array) -> np.ndarray:
    """The probability that each text is toxic; a word counts once, wherever in the text it is."""
    logit = np.full(len(texts), model.base)
    if len(model.words):
        features, which, text = _features(texts)
        found = []
        for own in features:
            place = np.minimum(np.searchsorted(model.words, own), len(model.words) - 1)
            known = model.words[place] == own
            hit = np.flatnonzero(known[which])
            found.append(text[hit] * len(model.words) + place[which[hit]])
        both = np.unique(np.concatenate(found))
        logit += np.bincount(both // len(model.words), model.weights[both % len(model.words)], len(texts))
    with np.errstate(over="ignore"):
        return 1 / (1 + np.exp(-logit))


def train(docs: DataFrame, labels: DataFrame) -> Model:
    """A model from a bounded sample of labelled rows that are not held out."""
    known = for_training(labels.select(F.col("doc_id").cast("long").alias("doc_id"), "toxic").filter("toxic in (0, 1)"))
    known = known.groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
    texts = for_training(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"))
    usable = texts.filter(f"length(text) between 1 and {MOST_CHARS}")
    chosen = known.join(usable.select("doc_id").distinct(), "doc_id", "left_semi")
    chosen = chosen.orderBy(F.xxhash64("doc_id"), "doc_id").limit(LABELLED)
    sample = usable.join(F.broadcast(chosen), "doc_id").dropDuplicates(["doc_id"]).collect()  # LABELLED rows at most
    rows = sorted(sample, key=lambda row: row.doc_id)
    return fit([row.text for row in rows], [row.toxic for row in rows])


def predict(docs: DataFrame, labels: DataFrame | None = None, model: Model | None = None) -> DataFrame:
    """One row per document: doc_id, held_out, score, predicted (1 from a score of 0.3).

    NULL, empty and wordless texts get the score of a text that says nothing. Only the text goes into a score. A label other
    than 0 or 1 is none; a document labelled twice is toxic if one label says so. With nothing to learn from every score
    is 0. Repeated rows get equal scores, a NULL doc_id is not held out and nothing is learned from it, an empty table gives
    no rows, and other columns are not looked at.
    """
    sent = docs.sparkSession.sparkContext.broadcast(train(docs, labels) if model is None else model)

    def score(batches):
        for batch in pieces(batches):
            found = scores(sent.value, batch.column("text"))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("held_out"), pa.array(found), pa.array((found >= THRESHOLD).astype(np.int32))],
                ["doc_id", "held_out", "score", "predicted"],
            )

    plain = docs.select(F.col("doc_id").cast("long"), held_out().alias("held_out"), "text")
    return plain.mapInArrow(score, "doc_id long, held_out boolean, score double, predicted int")
