"""Language identification with a linear-chain conditional random field over words.

Each word is labelled with a language: its score comes from affixes, character n-grams and a lexicon, and learned
transitions tie neighbours together, so a text that switches between languages is labelled in stretches. Marginals come
from the forward-backward algorithm; a text's language is the one with the largest share of its words.

Texts are looked at whole. Words of a few megabytes of text are handled together as arrays: word scores are computed once for
each distinct word, and texts are cut into segments whose transfer matrices carry the exact forward and backward
messages across, so a very long text takes as many steps as its segments, not its words.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tierlake.llm.common import columns, for_training, fresh, held_out, pieces, prefix_sums, runs, span_hashes, utf8

#: Bounds of the training sample: documents for each language, characters of one of them, languages (the most frequent).
DOCS_PER_LANGUAGE, MOST_CHARS, MOST_LANGUAGES = 200, 20_000, 64
#: Rows of the weight table that hashed features share, and words of the lexicon for each language.
BUCKETS, LEXICON = 1 << 17, 4000
UNKNOWN = "und"

_SEGMENT = 64
_LETTER = np.zeros(256, bool)
_LETTER[97:123] = True
_LETTER[128:] = True


class Model(NamedTuple):
    languages: list[str]
    lexicon: np.ndarray  # sorted hashes of words
    weights: np.ndarray  # a row per feature, a column per language
    transitions: np.ndarray


def letters_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Lower-case bytes of all texts, starts and ends of their words, and each text's first word (one more than texts)."""
    data, offsets = utf8(pc.utf8_lower(texts.cast(pa.large_string())))
    starts, ends = runs(_LETTER[data], offsets)
    return data, starts, ends, np.searchsorted(starts, offsets)


def features(sums: np.ndarray, starts: np.ndarray, ends: np.ndarray, lexicon: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows of the weight table for each word, end to end, and how many each word has."""
    size = ends - starts
    words, rows = [], []

    def add(word, hashes, tag):
        words.append(word)
        rows.append(((hashes + np.uint64(tag * 0x9E3779B1)) % np.uint64(BUCKETS)).astype(np.int64))

    every = np.arange(len(starts))
    for n in (1, 2, 3, 4):
        has = every[size >= n]
        add(has, span_hashes(sums, starts[has], starts[has] + n), 2 * n)  # prefixes
        add(has, span_hashes(sums, ends[has] - n, ends[has]), 2 * n + 1)  # suffixes
    for n in (2, 3):
        count = np.maximum(size - n + 1, 0)
        word = np.repeat(every, count)
        at = starts[word] + np.arange(len(word)) - np.repeat(np.cumsum(count) - count, count)
        add(word, span_hashes(sums, at, at + n), 100 + n)
    if len(lexicon):
        whole = span_hashes(sums, starts, ends)
        place = np.minimum(np.searchsorted(lexicon, whole), len(lexicon) - 1)
        known = every[lexicon[place] == whole]
        words.append(known)
        rows.append(BUCKETS + place[known])
    word = np.concatenate(words)
    order = np.argsort(word, kind="stable")
    return np.concatenate(rows)[order], np.bincount(word, minlength=len(starts))


def word_scores(model_weights: np.ndarray, rows: np.ndarray, counts: np.ndarray) -> np.ndarray:
    if not len(counts):
        return np.zeros((0, model_weights.shape[1]))
    sums = np.add.reduceat(model_weights[rows], np.cumsum(counts) - counts, axis=0)
    return sums / np.sqrt(counts)[:, None]


def marginals(scores: np.ndarray, first: np.ndarray, transitions: np.ndarray) -> np.ndarray:
    """Posterior of each word's label; text i has the words first[i] .. first[i + 1]."""
    n, labels = scores.shape
    out = np.zeros((n, labels))
    if not n:
        return out
    move = np.exp(transitions - transitions.max())
    likely = np.exp(scores - scores.max(axis=1, keepdims=True))
    count = np.diff(first)
    segments = -(-count // _SEGMENT)
    text = np.repeat(np.arange(len(count)), segments)
    rank = np.arange(len(text)) - np.repeat(np.cumsum(segments) - segments, segments)
    begin = first[text] + rank * _SEGMENT
    length = np.minimum(_SEGMENT, first[text + 1] - begin)
    order = np.argsort(-length, kind="stable")  # so that those with a word at step t come first
    active = [int(np.searchsorted(-length[order], -t, side="left")) for t in range(_SEGMENT)]

    transfer = np.broadcast_to(np.eye(labels), (len(text), labels, labels)).copy()
    for t in range(_SEGMENT):
        some = order[: active[t]]
        if not len(some):
            break
        step = (transfer[some] @ move) * likely[begin[some] + t][:, None, :]
        transfer[some] = step / step.max(axis=(1, 2), keepdims=True)
    into, onward = np.full((len(text), labels), 1 / labels), np.ones((len(text), labels))
    by_rank = np.argsort(rank, kind="stable")
    border = np.searchsorted(rank[by_rank], np.arange(int(rank.max()) + 2))
    last = rank == segments[text] - 1
    for r in range(int(rank.max())):
        some = by_rank[border[r] : border[r + 1]]
        some = some[~last[some]]
        message = np.einsum("ni,nij->nj", into[some], transfer[some])
        into[some + 1] = message / message.sum(axis=1, keepdims=True)
    for r in range(int(rank.max()), 0, -1):
        some = by_rank[border[r] : border[r + 1]]
        message = np.einsum("nij,nj->ni", transfer[some], onward[some])
        onward[some - 1] = message / message.sum(axis=1, keepdims=True)

    state = into.copy()
    for t in range(_SEGMENT):
        some = order[: active[t]]
        if not len(some):
            break
        step = (state[some] @ move) * likely[begin[some] + t]
        state[some] = step / step.sum(axis=1, keepdims=True)
        out[begin[some] + t] = state[some]
    state = onward.copy()
    for t in range(_SEGMENT - 1, -1, -1):
        some = order[: active[t]]
        if not len(some):
            continue
        at = begin[some] + t
        both = out[at] * state[some]
        out[at] = both / both.sum(axis=1, keepdims=True)
        step = (state[some] * likely[at]) @ move.T
        state[some] = step / step.sum(axis=1, keepdims=True)
    return out


def fit(texts: list[str], langs: list[str], steps: int = 300, batch: int = 64, seed: int = 1) -> Model:
    """Learn from texts of one language each, joined into sequences that switch between languages every few words."""
    languages = sorted(set(langs))
    data, starts, ends, first = letters_of(pa.array(texts, pa.string()))
    own = np.array([languages.index(lang) for lang in langs], np.int64)
    label = np.repeat(own, np.diff(first))
    if not len(starts):
        return Model([], np.zeros(0, np.uint64), np.zeros((BUCKETS, 0)), np.zeros((0, 0)))
    n = len(languages)
    sums = prefix_sums(data)
    hashes = span_hashes(sums, starts, ends)
    often = []
    for k in range(n):
        words, count = np.unique(hashes[label == k], return_counts=True)
        often.append(words[np.lexsort((words, -count))][:LEXICON])
    lexicon = np.unique(np.concatenate(often))
    _, at, which = np.unique(hashes, return_index=True, return_inverse=True)
    rows, counts = features(sums, starts[at], ends[at], lexicon)
    begin = np.cumsum(counts) - counts
    weights, transitions = np.zeros((BUCKETS + len(lexicon), n)), np.zeros((n, n))
    seen, seen_moves = np.full_like(weights, 1e-3), np.full_like(transitions, 1e-3)
    random = np.random.default_rng(seed)
    of_language = [np.flatnonzero((own == k) & (np.diff(first) > 0)) for k in range(n)]
    usable = [k for k in range(n) if len(of_language[k])]
    for _ in range(steps):
        words = np.zeros((batch, _SEGMENT), np.int64)
        for b in range(batch):
            filled = 0
            while filled < _SEGMENT:
                text = random.choice(of_language[random.choice(usable)])
                take = min(int(random.integers(4, 48)), _SEGMENT - filled, int(first[text + 1] - first[text]))
                start = int(random.integers(first[text], first[text + 1] - take + 1))
                words[b, filled : filled + take] = np.arange(start, start + take)
                filled += take
        gold = label[words]
        distinct, place = np.unique(which[words], return_inverse=True)
        place = place.reshape(words.shape)
        size = counts[distinct]
        owner = np.repeat(np.arange(len(distinct)), size)
        row = rows[begin[distinct][owner] + np.arange(len(owner)) - np.repeat(np.cumsum(size) - size, size)]
        scores = word_scores(weights, row, size)[place]
        move = np.exp(transitions)
        likely = np.exp(scores - scores.max(axis=2, keepdims=True))
        forward, backward = np.zeros_like(likely), np.ones_like(likely)
        state = np.full((batch, n), 1 / n)
        for t in range(_SEGMENT):
            state = (state @ move) * likely[:, t]
            state /= state.sum(axis=1, keepdims=True)
            forward[:, t] = state
        for t in range(_SEGMENT - 1, 0, -1):
            step = (backward[:, t] * likely[:, t]) @ move.T
            backward[:, t - 1] = step / step.sum(axis=1, keepdims=True)
        wrong = forward * backward
        wrong /= wrong.sum(axis=2, keepdims=True)
        both = forward[:, :-1, :, None] * move * (likely * backward)[:, 1:, None, :]
        both /= both.sum(axis=(2, 3), keepdims=True)
        moves = both.sum(axis=(0, 1))
        np.subtract.at(moves, (gold[:, :-1].ravel(), gold[:, 1:].ravel()), 1)
        wrong[np.arange(batch)[:, None], np.arange(_SEGMENT), gold] -= 1
        of_word = np.stack([np.bincount(place.ravel(), wrong[..., k].ravel(), len(distinct)) for k in range(n)], axis=1)
        of_word /= np.sqrt(size)[:, None]
        touched, inverse = np.unique(row, return_inverse=True)
        slope = np.stack([np.bincount(inverse, of_word[owner, k], len(touched)) for k in range(n)], axis=1)
        slope = slope / batch + 1e-4 * weights[touched]
        seen[touched] += slope**2
        weights[touched] -= 0.3 * slope / np.sqrt(seen[touched])
        moves = moves / batch + 1e-3 * transitions
        seen_moves += moves**2
        transitions -= 0.1 * moves / np.sqrt(seen_moves)
    return Model(languages, lexicon, weights.astype(np.float32), transitions)


def train(docs: DataFrame) -> Model:
    """A model from a bounded sample of the rows of `docs` that are not held out and have a language."""
    known = for_training(docs).filter("lang is not null and length(text) between 1 and " + str(MOST_CHARS))
    known = known.select(F.col("doc_id").cast("long"), F.col("lang").cast("string"), "text")
    counts = known.groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(MOST_LANGUAGES).collect()
    order = Window.partitionBy("lang").orderBy(F.xxhash64("doc_id"), "doc_id")
    chosen = known.filter(F.col("lang").isin([row.lang for row in counts])).select("doc_id", "lang")
    chosen = chosen.withColumn("n", F.row_number().over(order)).filter(F.col("n") <= DOCS_PER_LANGUAGE)
    # At most MOST_LANGUAGES * DOCS_PER_LANGUAGE ids.
    sample = known.join(F.broadcast(chosen.select("doc_id", "lang").distinct()), ["doc_id", "lang"])
    rows = sorted(sample.dropDuplicates(["doc_id", "lang"]).collect(), key=lambda row: (row.lang, row.doc_id))
    return fit([row.text for row in rows], [row.lang for row in rows])


def label_words(model: Model, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of all words in the lower-case bytes, each text's first word, and each word's posteriors."""
    data, starts, ends, first = letters_of(texts)
    sums = prefix_sums(data)
    _, at, which = np.unique(span_hashes(sums, starts, ends), return_index=True, return_inverse=True)
    scores = word_scores(model.weights, *features(sums, starts[at], ends[at], model.lexicon))
    return starts, ends, first, marginals(scores[which], first, model.transitions)


def shares(model: Model, texts: pa.Array) -> np.ndarray:
    """The expected share of each language among a text's words; zeros for a text without a letter."""
    out = np.zeros((len(texts), len(model.languages)))
    if model.languages:
        _, _, first, posterior = label_words(model, texts)
        has = np.flatnonzero(np.diff(first) > 0)
        if len(has):
            out[has] = np.add.reduceat(posterior, first[has], axis=0) / np.diff(first)[has][:, None]
        letter = pc.fill_null(pc.match_substring_regex(texts, r"\pL"), False).to_numpy(zero_copy_only=False)
        out[~letter] = 0
    return out


def annotate(docs: DataFrame, names: tuple[str, str], model: Model | None = None) -> DataFrame:
    """All columns of `docs` and two more, named by `names`: the language and its score."""
    sent = docs.sparkSession.sparkContext.broadcast(train(docs) if model is None else model)

    def label(batches):
        own = sent.value
        known = [*own.languages, UNKNOWN]
        for batch in pieces(batches):
            share = shares(own, batch.column("text"))
            best = share.argmax(axis=1) if own.languages else np.zeros(batch.num_rows, int)
            score = share.max(axis=1, initial=0.0)
            best[score == 0] = len(own.languages)
            found = [pa.array([known[b] for b in best], pa.string()), pa.array(np.minimum(score, 1.0), pa.float64())]
            yield pa.RecordBatch.from_arrays([*batch.columns, *found], [*batch.schema.names, *names])

    # Arrow functions take no names with dots, so columns go by number meanwhile.
    numbered = [f"c{i}" if name != "text" else name for i, name in enumerate(docs.columns)]
    kinds = T.StructType([T.StructField(c, field.dataType) for c, field in zip(numbered, docs.schema, strict=True)])
    kinds = kinds.add(names[0], T.StringType()).add(names[1], T.DoubleType())
    return docs.toDF(*numbered).mapInArrow(label, kinds).toDF(*docs.columns, *names)


def predict(docs: DataFrame, model: Model | None = None) -> DataFrame:
    """One row per document: doc_id, held_out, lang_pred, score.

    lang_pred is `und`, with score 0, for a NULL text, a text without a letter, and every text if no row could be learned
    from. Only the text goes into a prediction. Repeated rows get equal results, ties go to the language that sorts
    first, an empty table gives no rows; a NULL doc_id is not held out and nothing is learned from it. Other columns than
    doc_id, text and lang are not looked at.
    """
    model = train(docs) if model is None else model
    plain = docs.select(F.col("doc_id").cast("long"), held_out().alias("held_out"), "text")
    return annotate(plain, ("lang_pred", "score"), model).drop("text")


def keep_identified(docs: DataFrame, least: float = 0.3) -> DataFrame:
    """The rows of `docs`, all columns, whose language is identified and holds a share of at least `least` of their words.

    Rows with a NULL text or one without a letter go. Repeated rows share one fate, a row without an id is judged as any other,
    texts may have any length, an empty table gives no rows, and columns may have any names.
    """
    lang, score = fresh(docs, "lang_pred", "score")
    found = annotate(docs, (lang, score), train(docs))
    return found.filter((F.col(lang) != UNKNOWN) & (F.col(score) >= least)).select(*columns(docs))
