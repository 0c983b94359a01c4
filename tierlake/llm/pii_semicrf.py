"""Personal data by fixed patterns, and by a semi-Markov conditional random field beside them.

The field looks at stretches of neighbouring tokens that hold a digit or an at sign. Candidate segments, of at most `LONGEST`
tokens, are scored as wholes by their shape, their digits and the word before them, and a dynamic program over the segments
picks boundaries and kinds together. It learns from spans that the patterns find in a bounded sample, from the same
spans written in ways the patterns do not know, and from numbers of other kinds. What it finds outside the patterns'
spans is added where it is nearly sure.
"""

from __future__ import annotations

import bisect
import hashlib
import re
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tierlake.llm.common import pieces, utf8

KINDS = ("email", "ip", "card", "phone")
#: Bounds: tokens and characters of a segment, texts and characters of the training sample.
LONGEST, MOST_CHARS, SAMPLE, SAMPLE_CHARS = 6, 64, 2000, 20_000
#: How sure a segment must be to be added.
SURE = 0.9

# Equal to the patterns of the contract, but linear in time: a match can only begin where a run of digits does.
_LOCAL = re.compile(r"[A-Za-z0-9._%+-]+")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")
_TOKEN = re.compile(r"\S+")
_WORD = re.compile(r"\w")
_FIELD = re.compile(r"""[^"'`,;&=]+""")  # of a token too long for a segment, as in compact JSON, CSV lines and URLs

Span = tuple[int, int, int]  # kind's place in KINDS, start, end


def emails(text: str) -> list[tuple[int, int]]:
    found, at = [], 0
    while (sign := text.find("@", at)) >= 0:
        start = sign
        while start > at and _LOCAL.match(text, start - 1, start):
            start -= 1
        match = _DOMAIN.match(text, sign + 1) if start < sign else None
        at = sign + 1
        if match:
            found.append((start, match.end()))
            at = match.end()
    return found


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (1 + i % 2)
        total += n - 9 * (n > 9)
    return total % 10 == 0


def is_ip(text: str) -> bool:
    return all(len(part.lstrip("0")) <= 3 and int(part.lstrip("0") or "0") <= 255 for part in text.split("."))


def is_card(text: str) -> bool:
    digits = re.sub(r"[^0-9]", "", text)
    return 13 <= len(digits) <= 19 and luhn(digits)


def base_spans(text: str) -> list[Span]:
    """What the patterns find, by kind and start."""
    found = [(0, *span) for span in emails(text)]
    found += [(1, *m.span()) for m in _IP.finditer(text) if is_ip(m[0])]
    found += [(2, *m.span()) for m in _CARD.finditer(text) if is_card(m[0])]
    found += [(3, *m.span()) for m in _PHONE.finditer(text) if 9 <= len(_DIGIT.findall(m[0])) <= 15]
    return found


class Island(NamedTuple):
    """Neighbouring tokens (start, end) and the word before them."""

    tokens: list[tuple[int, int]]
    before: str


def _tokens(text: str) -> Iterator[tuple[int, int]]:
    """Words between blanks, and of one with more than MOST_CHARS characters its fields."""
    for match in _TOKEN.finditer(text):
        start, end = match.span()
        if end - start <= MOST_CHARS:
            yield start, end
        else:
            yield from (m.span() for m in _FIELD.finditer(text, start, end) if _WORD.search(m[0]))


def islands(text: str) -> list[Island]:
    """The stretches of tokens that hold a digit or an at sign, with one space or the like between two of them."""
    found, before, last = [], "", -2
    for start, end in _tokens(text):
        token = text[start:end]
        if end - start <= MOST_CHARS and re.search(r"[0-9@]", token):
            if last == start - 1 and text[last].isspace() and text[last] != "\n":
                found[-1].tokens.append((start, end))
            else:
                found.append(Island([(start, end)], before))
            last = end
        before = token[-20:].lower()
    return found


def trimmed(text: str, start: int, end: int) -> tuple[int, int]:
    """The span without quotes, stops and brackets around it."""
    while start < end and text[start] in "\"'<[{":
        start += 1
    while start < end and text[end - 1] in ".,;:!?\"'>]}":
        end -= 1
    inside = text[start:end]
    if inside.startswith("(") and ")" not in inside:
        start += 1
    if inside.endswith(")") and "(" not in inside:
        end -= 1
    return start, end


def features(text: str, start: int, end: int, before: str) -> list[str]:
    """What is looked at in a candidate segment."""
    start, end = trimmed(text, start, end)
    span = text[start:end]
    groups = re.findall(r"[0-9]+", span)
    digits = "".join(groups)
    outside = re.sub(r"[0-9]+", "9", span)
    letters = len(re.findall(r"[^\W\d_]", span))
    found = [
        "groups=" + "-".join(str(len(g)) for g in groups[:8]),
        f"digits={min(len(digits), 20)}",
        "shape=" + re.sub(r"[^\W\d_]+", "a", outside)[:24],
        f"at={span.count('@')}",
        f"letters={min(letters, 4)}",
        f"plus={span.startswith('+')}",
        "before=" + re.sub(r"[^\w]+$", "", before)[-8:],
    ]
    if re.fullmatch(r"[^@\s]+@[^@\s]+\.[^\W\d_]{2,}", span):
        found.append("address")
    if 13 <= len(digits) <= 19 and not letters:
        found.append(f"luhn={luhn(digits)}")
    if re.fullmatch(r"[0-9]+(\.[0-9]+){3}(:[0-9]+)?", span):
        found.append(f"quad={is_ip(span.split(':')[0])}")
    if 9 <= len(digits) <= 15 and not letters and not set(span) - set("+() .-0123456789"):
        found.append("dialled")
    return found


class Model(NamedTuple):
    weights: dict[str, np.ndarray]  # for each feature a score by kind
    moves: np.ndarray  # from each label to each, 0 is none and 1.. are KINDS


def _lattice(model: Model, text: str, island: Island) -> list[list[tuple[int, np.ndarray, list[str]]]]:
    """For each token where a segment may end: tokens it takes, scores by label, features. Label 0 takes one token."""
    ends: list[list[tuple[int, np.ndarray, list[str]]]] = []
    for i, (_, end) in enumerate(island.tokens):
        own = []
        for size in range(1, min(LONGEST, i + 1) + 1):
            start = island.tokens[i - size + 1][0]
            if end - start > MOST_CHARS:
                break
            last = text[island.tokens[i - size][0] : island.tokens[i - size][1]].lower() if size <= i else island.before
            names = features(text, start, end, last)
            score = np.zeros(len(KINDS) + 1)
            for name in names:
                if name in model.weights:
                    score[1:] += model.weights[name]
            if size > 1:
                score[0] = -np.inf
            own.append((size, score, names))
        ends.append(own)
    return ends


def _add(scores: np.ndarray, axis=None):
    top = scores.max(axis=axis, keepdims=True)
    top[~np.isfinite(top)] = 0
    with np.errstate(divide="ignore"):
        return np.squeeze(top, axis) + np.log(np.exp(scores - top).sum(axis=axis)) if axis is not None else float(top.max() + np.log(np.exp(scores - top).sum()))


def _messages(model: Model, ends) -> tuple[np.ndarray, np.ndarray, float]:
    """Log sums over all ways up to, and on from, each border with each label of the segment that ends there."""
    n, labels = len(ends), len(KINDS) + 1
    into = np.full((n + 1, labels), -np.inf)
    into[0, 0] = 0
    for i, own in enumerate(ends, 1):
        ways = [_add(into[i - size][:, None] + model.moves, 0) + score for size, score, _ in own]
        into[i] = _add(np.stack(ways), 0)
    on = np.full((n + 1, labels), -np.inf)
    on[n] = 0
    for i in range(n - 1, -1, -1):
        ways = []
        for j in range(i, min(n, i + LONGEST)):
            for size, score, _ in ends[j]:
                if j - size + 1 == i:
                    ways.append(_add(model.moves + (score + on[j + 1])[None, :], 1))
        on[i] = _add(np.stack(ways), 0)
    return into, on, _add(into[n])


def decode(model: Model, text: str, island: Island) -> list[tuple[Span, float]]:
    """The best joint choice of boundaries and kinds, and how sure each of its segments is."""
    ends = _lattice(model, text, island)
    into, on, whole = _messages(model, ends)
    best = np.full((len(ends) + 1, len(KINDS) + 1), -np.inf)
    best[0, 0] = 0
    back = {}
    for i, own in enumerate(ends, 1):
        for size, score, _ in own:
            ways = best[i - size][:, None] + model.moves + score[None, :]
            for label in range(len(KINDS) + 1):
                came = int(ways[:, label].argmax())
                if ways[came, label] > best[i, label]:
                    best[i, label] = ways[came, label]
                    back[i, label] = size, came, score[label]
    found, i, label = [], len(ends), int(best[-1].argmax())
    while i > 0:
        size, came, score = back[i, label]
        if label:
            sure = _add(into[i - size] + model.moves[:, label]) + score + on[i, label] - whole
            start, end = trimmed(text, island.tokens[i - size][0], island.tokens[i - 1][1])
            found.append(((label - 1, start, end), float(np.exp(min(sure, 0.0)))))
        i, label = i - size, came
    return found[::-1]


def fit(texts: list[str], passes: int = 6, seed: int = 1) -> Model:
    """Learn from what the patterns find in these texts, that in other writing, and numbers of other kinds."""
    random = np.random.default_rng(seed)
    examples = []
    for text in texts:
        spans = {(s, e): kind for kind, s, e in base_spans(text)}
        for island in islands(text):
            examples.append((text, island, spans))
            for (start, end), kind in spans.items():
                if island.tokens[0][0] <= start and end <= island.tokens[-1][1]:
                    for other in _rewritten(KINDS[kind], text[start:end]):
                        changed = f"{island.before} {other} and"
                        where = len(island.before) + 1
                        examples += [(changed, i, {(where, where + len(other)): kind}) for i in islands(changed)]
    for _ in range(max(400, len(examples) // 4)):
        other = f"{random.choice(_WORDS)} {_other_number(random)} and"
        examples += [(other, i, {}) for i in islands(other)]
    for i in range(_MADE * len(KINDS)):  # a small sample may lack a kind
        kind = i % len(KINDS)
        made = _made(KINDS[kind], random)
        for span in (made, *_rewritten(KINDS[kind], made)):
            text = f"{random.choice(_WORDS)} {span} and"
            at = text.index(" ") + 1
            examples += [(text, i, {(at, at + len(span)): kind}) for i in islands(text)]
    model = Model({}, np.zeros((len(KINDS) + 1, len(KINDS) + 1)))
    if not texts or len(examples) > 40_000:
        examples = [examples[i] for i in random.permutation(len(examples))[:40_000]]
    for number in range(passes):
        rate = 0.5 / (1 + number)
        for i in random.permutation(len(examples)):
            _learn(model, *examples[i], rate)
    return model


#: Made-up spans of each kind that are learned from, beside those of the sample.
_MADE = 60


def _made(kind: str, random) -> str:
    def number(n: int) -> str:
        return "".join(map(str, random.integers(0, 10, n)))

    if kind == "email":
        letters = "".join(random.choice(list("abcdefghijklmnopqrstuvwxyz"), int(random.integers(3, 9))))
        return f"{letters}{random.choice(['', '.', '_'])}{number(2)}@{letters[::-1]}.{random.choice(['com', 'org', 'net', 'de'])}"
    if kind == "ip":
        return ".".join(str(x) for x in random.integers(0, 256, 4))
    if kind == "phone":
        return random.choice([f"+{number(1)} ({number(3)}) {number(3)}-{number(4)}", f"+{number(2)} {number(3)} {number(7)}"])
    body = "4" + number(14)
    digits = body + next(d for d in "0123456789" if luhn(body + d))
    return random.choice([digits, " ".join(re.findall("....", digits)), "-".join(re.findall("....", digits))])


_WORDS = ("on", "version", "page", "at", "about", "since", "for", "costs", "no", "the")


def _other_number(random) -> str:
    a, b, c, d = (int(x) for x in random.integers(1, 100, 4))
    return (
        f"{1900 + a}-{b % 12 + 1:02d}-{c % 28 + 1:02d}",
        f"{b % 12 + 1}/{c % 28 + 1}/{1900 + a}",
        f"{a % 24}:{b % 60:02d}",
        f"${a},{b * 10:03d}.{c:02d}",
        f"v{a % 9}.{b}.{c}",
        f"{a % 9}.{b % 9}",
        str(1900 + a),
        str(a),
        f"{a * 1000 + b}{c * 1000 + d:06d}",
        f"{a}x{b}",
        f"{a}-{b}",
        f"978-{a % 9}-{b:02d}-{c:06d}-{d % 9}",
    )[int(random.integers(12))]


def _rewritten(kind: str, span: str) -> list[str]:
    if kind == "phone":
        groups = re.findall(r"[0-9]+", span)
        if len(groups) > 2:
            own = groups[1:]
            return ["-".join(own), ".".join(own), f"({own[0]}) " + "-".join(own[1:]), " ".join(["00" + groups[0], *own])]
    if kind == "card":
        digits = re.sub(r"[^0-9]", "", span)
        return [".".join(re.findall("....|.+", digits)), "/".join(re.findall("....|.+", digits))]
    if kind == "ip":
        return [span + ":8080"]
    if kind == "email":
        name, host = span.split("@")
        return [f"{name}[@]{host}", f"{name}(@){host}"]
    return []


def _learn(model: Model, text: str, island: Island, spans: dict[tuple[int, int], int], rate: float) -> None:
    """A step towards the segments of `spans`, up the gradient of their log probability."""
    gold, i = {}, 0
    while i < len(island.tokens):
        for j in range(min(len(island.tokens), i + LONGEST) - 1, i - 1, -1):
            kind = spans.get(trimmed(text, island.tokens[i][0], island.tokens[j][1]))
            if kind is not None:
                gold[j] = (j - i + 1, kind + 1)
                i = j
                break
        else:
            gold[i] = (1, 0)
        i += 1
    ends = _lattice(model, text, island)
    into, on, whole = _messages(model, ends)
    moves = np.zeros_like(model.moves)
    came = 0
    for i, own in enumerate(ends):
        for size, score, names in own:
            ways = np.exp(np.minimum(into[i + 1 - size][:, None] + model.moves + (score + on[i + 1])[None, :] - whole, 0))
            moves -= ways
            step = -ways.sum(axis=0)
            if i in gold and gold[i][0] == size:
                step[gold[i][1]] += 1
                moves[came, gold[i][1]] += 1
                came = gold[i][1]
            if np.abs(step[1:]).max() > 1e-4:
                for name in names:
                    weight = model.weights.setdefault(name, np.zeros(len(KINDS)))
                    weight += rate * (step[1:] - 1e-4 * weight)
    model.moves[:] += 0.1 * rate * moves


def all_spans(model: Model, text: str) -> tuple[list[Span], list[Span]]:
    """The patterns' spans, and all of them with what the field adds outside; both by kind and start."""
    base = base_spans(text)
    starts, ends = _merged(base)

    def touches(start: int, end: int) -> bool:
        i = bisect.bisect_left(starts, end)
        return i > 0 and ends[i - 1] > start

    added = []
    for island in islands(text):
        if all(touches(*token) for token in island.tokens):
            continue  # nothing of it is outside
        for span, sure in _decoded(model, text, island):
            if sure >= SURE and span[1] < span[2] and not touches(*span[1:]):
                added.append(span)
    return base, sorted(base + added)


def _merged(spans: list[Span]) -> tuple[list[int], list[int]]:
    """Starts and ends of what the spans cover."""
    starts, ends = [], []
    for start, end in sorted((s, e) for _, s, e in spans):
        if ends and start <= ends[-1]:
            ends[-1] = max(ends[-1], end)
        else:
            starts.append(start)
            ends.append(end)
    return starts, ends


def _decoded(model: Model, text: str, island: Island, most: int = 500, beside: int = 64) -> Iterator[tuple[Span, float]]:
    """As `decode`; a very long island in parts, so that memory follows the part.

    A part is decoded with `beside` tokens more on either side and the true word before them, and gives the segments that
    begin in it, so segments cross from one part into the next.
    """
    tokens, done = island.tokens, 0
    for i in range(0, len(tokens), most):
        low = max(0, i - beside)
        before = text[slice(*tokens[low - 1])].lower() if low else island.before
        part = Island(tokens[low : i + most + beside], before)
        until = tokens[i + most][0] if i + most < len(tokens) else len(text)
        for (kind, start, end), sure in decode(model, text, part):
            if max(tokens[i][0], done) <= start < until:
                yield (kind, start, end), sure
                done = end


def train(docs: DataFrame) -> Model:
    """A model from the patterns' finds in a bounded sample of the texts that hold a digit or an at sign."""
    usable = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    usable = usable.filter(F.col("text").rlike("[0-9@]") & (F.length("text") <= SAMPLE_CHARS) & F.col("doc_id").isNotNull())
    # Ids are chosen first: each task sends the driver as many rows as the limit.
    chosen = usable.select("doc_id").orderBy(F.xxhash64("doc_id"), "doc_id").limit(SAMPLE).distinct()
    sample = usable.join(F.broadcast(chosen), "doc_id").groupBy("doc_id").agg(F.min("text").alias("text")).orderBy("doc_id")
    return fit([row.text for row in sample.collect()])


def _joined(spans: list[Span]) -> str:
    return ",".join(f"{KINDS[kind]}:{start}:{end}" for kind, start, end in spans)


def find(docs: DataFrame, model: Model | None = None) -> DataFrame:
    """One row per document: doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans.

    Counts and the digest are of the patterns' spans; `spans` also has those that the field adds. Spans are kind:start:end
    in code points, by kind and start. NULL and empty texts have none. Repeated rows get equal results, a NULL doc_id
    stays NULL, an empty table gives no rows, other columns are not looked at.
    """
    sent = docs.sparkSession.sparkContext.broadcast(train(docs) if model is None else model)
    nothing = hashlib.sha256(b"").hexdigest()

    def search(batches):
        for batch in pieces(batches):
            n = batch.num_rows
            counts = np.zeros((len(KINDS), n), np.int64)
            digests, spans = [nothing] * n, [""] * n
            for i in _with_mark(batch.column("text")).tolist():
                base, every = all_spans(sent.value, batch.column("text")[i].as_py())
                for kind, _, _ in base:
                    counts[kind, i] += 1
                digests[i] = hashlib.sha256(_joined(base).encode()).hexdigest()
                spans[i] = _joined(every)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *map(pa.array, counts), pa.array(digests, pa.string()), pa.array(spans, pa.string())],
                ["doc_id", *(f"n_{kind}" for kind in KINDS), "base_sha256", "spans"],
            )

    counts = ", ".join(f"n_{kind} long" for kind in KINDS)
    plain = docs.select(F.col("doc_id").cast("long"), "text")
    return plain.mapInArrow(search, f"doc_id long, {counts}, base_sha256 string, spans string")


def _with_mark(texts: pa.Array) -> np.ndarray:
    """The texts that hold an ASCII digit or an at sign; no other can have a span."""
    data, offsets = utf8(texts)
    marks = np.flatnonzero(((data >= 48) & (data <= 57)) | (data == 64))
    return np.unique(np.searchsorted(offsets, marks, side="right") - 1)
