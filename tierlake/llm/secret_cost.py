"""Secrets by fixed patterns, and by how many guesses a value in a credential's place would take.

The cost of a value is the least sum, over all ways to cut it into words, dates, repeats, keyboard walks and characters that
must be tried one by one, of the logarithms of the guesses that each part takes; dynamic programming finds it. Words are
common password words, those that the text repeats beside such values, and the most frequent ones of all documents, by rank; of
a value that is all letters, also whatever can be spoken, as an even larger dictionary has it. A value that follows a word such
as `password` or `DB_PWD`, however long, is added to what the patterns find if it is costly enough, so `password: letmein1` is not.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tierlake.llm.common import pieces, runs, stored, utf8

KINDS = ("assign", "access", "hex")
#: Bits of guessing from which a value counts as a secret; characters that it has at least.
SECRET_BITS, LEAST_CHARS = 28.0, 6
#: Bits of a large dictionary, which has every word that can be spoken.
SPOKEN_BITS = 17.0
#: Words of the dictionary that is learned, how often each of them occurs at least, and its least and most letters.
MOST_WORDS, LEAST_TIMES, WORD_CHARS = 50_000, 3, (3, 24)
#: Different words that a task counts before it hands them on.
_HELD_WORDS = 1 << 18
#: Characters of a repeat or walk up to which every part of it is tried; of a longer one also those that end near its end.
_EVERY, _NEAR = 128, 24

_ASCII = re.ASCII | re.IGNORECASE
_ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", _ASCII)
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"[0-9a-f]{16,}")  # a run of 16 or more; shorter ones do not count
_CREDENTIAL = r"(?:pass(?:word|wd|phrase|code)|pwd|secret|token|api[_-]?key|access[_-]?key|private[_-]?key|credentials?|bearer)"
#: A credential's word in a longer name needs a sign before the value; one by itself does not.
_CONTEXT = re.compile(
    rf"""(?:{_CREDENTIAL}[A-Za-z0-9_.-]{{0,64}}+(?:\\*["'])?[\x20\t]*(?:=>|:=|[:=])"""
    rf"""|\b{_CREDENTIAL}\b(?:\\*["'])?[\x20\t]*(?:(?:is|was)\b)?)"""
    r"""[\x20\t]*((?:\\*["'`])?)(?=[!-~])""",
    _ASCII,
)
_RUN = re.compile(r"[!-~]*+")
#: A stop in an unquoted value after which another field begins, as in JSON, query strings and connection strings.
_FIELD = re.compile(r"""[,;&][\[{(]*\\*["'`]?[A-Z_][A-Z0-9_.-]{0,63}\\*["'`]?[:=]""", _ASCII)
_CLOSED = {quote: re.compile(rf"(?:[^\\{quote}]|\\.)*+{quote}") for quote in "\"'`"}
_MOST_KEY = 128  # characters from a credential's word up to its value in one run, at most
#: Lower-case words; every text that has an assignment or a credential's place has one of them or a match of _KEYS.
_NEEDLES = (b"password", b"passwd", b"passphrase", b"passcode", b"pwd", b"secret", b"token", b"credential", b"bearer")
_KEYS = re.compile(rb"api[_-]?key|access[_-]?key|private[_-]?key")

COMMON = (
    "password pass passwd admin administrator root user login guest test testing welcome letmein qwerty dragon monkey master "
    "shadow sunshine princess football baseball superman batman iloveyou love secret token key default changeme hello "
    "abc access server system service backup oracle cisco summer winter spring autumn monday friday january october "
    "example sample demo temp temporary public private internal company office computer internet none null true false"
).split()
_LEET = str.maketrans("@4310$5!7", "aaeiossit")
_ROWS = ("`1234567890-=", "qwertyuiop[]", "asdfghjkl;'", "zxcvbnm,./")
_BESIDE = {a + b for row in _ROWS for a, b in zip(row, row[1:], strict=False)}
_BESIDE |= {b + a for a, b in map(tuple, _BESIDE)}
_DATE = re.compile(r"(?:19|20)[0-9]{2}(?:[-/._]?[01]?[0-9](?:[-/._]?[0-3]?[0-9])?)?|[0-3]?[0-9][-/._]?[01]?[0-9][-/._]?(?:(?:19|20)?[0-9]{2})")

_SPOKEN = re.compile(r"(?=[a-z]*[aeiouy])[a-z]{4,20}")
_UNSPOKEN = re.compile(r"q(?!u)|[jv](?![aeiouy])|x[bdfgjkmnqrsvwz]|z[bcdfgjkmnpqrstvwx]|[bcdfghjklmnpqrstvwxz]{5}|[bcfgjkpqvwxz]{4}|[aeiou]{4}")

Span = tuple[int, int, int]  # start, kind's place in KINDS, end


def _brute_bits(char: str) -> float:
    if char.isdigit():
        return math.log2(10)
    return math.log2(26) if char.isalpha() else math.log2(33)


def guess_bits(value: str, ranks: dict[str, int], enough: float = math.inf) -> float:
    """The base-2 logarithm of the guesses that `value` takes; `ranks` has words by how soon they are tried, from 1.

    From `enough` on it may be a lower bound. It is the least of all ways to cut the value, but that no word has over 24
    characters, no block that is repeated over 8, and that of a repeat or walk of over 128 characters only the beginnings of up
    to 128 and those that end near its end are parts of their own; there it may be above the least.
    """
    return _least(value, ranks, enough)[0]


def _is_spoken(value: str) -> bool:
    """Whether letters look like one word, in one case or with a capital."""
    low = value.lower()
    return value in (low, low.upper(), low.capitalize()) and bool(_SPOKEN.fullmatch(low)) and not _UNSPOKEN.search(low)


def _sizes(most: int, least: int, step: int = 1) -> list[int]:
    """Of the parts of a run with `least` to `most` units of `step` characters those that are tried."""
    some = min(most, max(_EVERY // step, least))
    return [*range(least, some + 1), *range(max(some + 1, most - _NEAR), most + 1)]


def _least(value: str, ranks: dict[str, int], enough: float = math.inf) -> tuple[float, list[tuple[int, str]]]:
    """The least cost, and for each border the last part before it; no parts once the cost is sure to reach `enough`."""
    n = len(value)
    low = value.lower()
    plain = low.translate(_LEET)
    mixed_case = low != value and value != value.upper()
    letters = value.isalpha()
    # the least cost up to each border, and that of the cuts whose last part is tried one by one, with where it began
    cost, back = [0.0] + [math.inf] * n, [(0, "")] * (n + 1)
    each, began = [math.inf] * (n + 1), [0] * (n + 1)

    def offer(i: int, j: int, bits: float, kind: str) -> None:
        total = cost[i] + bits + (1.0 if i else 0.0)  # and which kind of part comes next
        if total < cost[j]:
            cost[j], back[j] = total, (i, kind)

    last, walks, repeats = 0, (0, 0), [(0, 0)] * 9  # start and end of the run at hand, also for each size of block
    for i in range(n):
        # every way on leads over a border from here on, and what leads there is known
        if i % 64 == 0 and i and min(cost[i : last + 1]) >= enough:
            return min(cost[i : last + 1]), []
        for j in range(i + 1, min(n, i + 24) + 1):
            word = plain[i:j] if plain[i:j] in ranks else low[i:j]
            if j - i >= 3 and word in ranks:
                odd = sum(a != b for a, b in zip(value[i:j], low[i:j], strict=True)) + sum(
                    a != b for a, b in zip(low[i:j], word, strict=True)
                )
                offer(i, j, math.log2(ranks[word] + 1) + (math.log2(math.comb(j - i, min(odd, (j - i) // 2)) + 1) if odd else 0), "word")
            if 4 <= j - i <= 10 and _DATE.fullmatch(value, i, j):
                offer(i, j, math.log2(365 * 120), "date")
            if letters and _is_spoken(value[i:j]):
                offer(i, j, SPOKEN_BITS, "word")
        last = max(last, min(n, i + 24))
        if i >= walks[1] - 1:
            end = i + 1
            while end < n and low[end - 1 : end + 1] in _BESIDE:
                end += 1
            walks = i, end
        if i - walks[0] <= _EVERY:
            for walk in _sizes(walks[1] - i, 3):
                offer(i, i + walk, math.log2(47 * 2) + 1.5 * math.log2(walk), "walk")
        last = max(last, walks[1])
        for size in range(1, min(8, (n - i) // 2) + 1):
            if i + size >= repeats[size][1]:
                end = i + size
                while end < n and low[end] == low[end - size]:
                    end += 1
                repeats[size] = i, end
            start, end = repeats[size]
            if i - start <= _EVERY and end - i >= 2 * size:
                block = sum(_brute_bits(c) for c in low[i : i + size])
                for times in _sizes((end - i) // size, 2, size):
                    if size * times >= 3:
                        offer(i, i + size * times, block + math.log2(times) + 1, "repeat")
                last = max(last, end)
        # one character more of what is tried one by one
        bits = _brute_bits(value[i]) + (1.0 if mixed_case and value[i].isalpha() else 0.0)
        opened = cost[i] + (1.0 if i else 0.0)
        each[i + 1], began[i + 1] = (each[i] + bits, began[i]) if each[i] <= opened else (opened + bits, i)
        if each[i + 1] < cost[i + 1]:
            cost[i + 1], back[i + 1] = each[i + 1], (began[i + 1], "each")
    return cost[n], back


def parts(value: str, ranks: dict[str, int]) -> tuple[float, list[tuple[str, str]]]:
    """The least cost and the parts it comes from, each with its kind."""
    n = len(value)
    least, back = _least(value, ranks)
    found, at = [], n
    while at > 0:
        start, kind = back[at]
        found.append((value[start:at], kind))
        at = start
    return least, found[::-1]


def base_spans(text: str) -> list[Span]:
    """What the patterns find, by start and kind."""
    found = [(m.start(), 0, m.end()) for m in _ASSIGN.finditer(text) if len(m[2]) >= 12]
    found += [(m.start(), 1, m.end()) for m in _ACCESS.finditer(text) if len(m[0]) >= 18]
    found += [(m.start(), 2, m.end()) for m in _HEX.finditer(text)]
    return sorted(found)


def candidates(text: str) -> list[tuple[int, int, int]]:
    """The values in a credential's place, of any length: where the credential's word begins, and the value's start and end.

    A quoted value ends at its closing quote, another one at a blank or before another field.
    """
    found, at, run, stop = [], 0, 0, 0
    while match := _CONTEXT.search(text, at):
        start = match.end()
        if start >= run:
            run, stop = _RUN.match(text, start).end(), -1
        if stop < start:
            field = _FIELD.search(text, start, run)
            stop = field.start() if field else run
        end = _closing(text, match[1], start, run) if match[1] else -1
        if end < 0:
            end = stop
        stripped = start + len(text[start:end].rstrip("\"'`,;.)]}>"))
        found.append((match.start(), start, stripped))
        at = max(start, end - _MOST_KEY)  # its last word may be another credential's
    return found


def _closing(text: str, quote: str, start: int, end: int) -> int:
    """Where the quote, which may be an escaped one, is closed; -1 if it is not."""
    if len(quote) > 1:
        return text.find(quote, start, end)
    closed = _CLOSED[quote].match(text, start, end)
    return closed.end() - 1 if closed else -1


def ranked(words: Sequence[str]) -> dict[str, int]:
    """The ranks of a dictionary: common password words, then `words` in their order."""
    return {word: i for i, word in enumerate(dict.fromkeys([*COMMON, *words]), 1)}


def all_spans(text: str, bits: float = SECRET_BITS, dictionary: dict[str, int] | None = None) -> tuple[list[Span], list[Span]]:
    """The patterns' spans, and all of them with the costly values in a credential's place, as kind assign."""
    base = base_spans(text)
    ranks: dict[str, int] = {}
    added, at, done = [], 0, 0
    places = candidates(text)
    for word, start, end in places:
        while at < len(base) and base[at][2] <= word:
            at += 1
        covered = any(s < end and word < e for s, _, e in base[at : at + len(KINDS)])
        if covered or start < done or end - start < LEAST_CHARS:
            continue
        if not ranks:
            counted = Counter(re.findall(r"[a-z]{3,24}", _without(text, places).lower()))
            ranks = (dictionary or {}) | ranked([w for w, n in counted.most_common() if n > 1])
        if guess_bits(text[start:end], ranks, bits) >= bits:
            added.append((start, 0, end))
            done = end
    return base, sorted(base + added)


def _without(text: str, places: list[tuple[int, int, int]]) -> str:
    """The text without the values in a credential's place, which are no words that it repeats."""
    left, at = [], 0
    for _, start, end in places:
        left.append(text[at : max(at, start)])
        at = max(at, end)
    return " ".join([*left, text[at:]])


def learned_words(docs: DataFrame, most: int = MOST_WORDS) -> list[str]:
    """The words that occur most often in all texts, `most` at most, by falling frequency and then by the alphabet.

    Of words that are equally frequent all are taken or none, so the list may be shorter than `most`. Words are runs of ASCII
    letters, in lower case. Values in a credential's place do not count, so no secret becomes a word because its document has
    many copies. Each task hands on sums of its own; the driver gets `most` frequencies at most, and the words that are returned.
    """
    least, longest = WORD_CHARS

    def sums(counted: Counter) -> pa.RecordBatch:
        some = [(word.decode(), n) for word, n in counted.items() if least <= len(word) <= longest]
        return pa.RecordBatch.from_arrays([pa.array([w for w, _ in some], pa.string()), pa.array([n for _, n in some], pa.int64())], ["word", "n"])

    def count(batches):
        counted: Counter = Counter()
        for batch in pieces(batches):
            texts = batch.column("text")
            marked = np.zeros(len(texts), bool)
            marked[_with_mark(texts)] = True
            plain = utf8(texts.filter(pa.array(~marked)))
            bounds = plain[1].tolist()
            raw = plain[0].tobytes()
            every = [raw[a:b] for a, b in zip(bounds, bounds[1:], strict=False)]
            for text in texts.filter(pa.array(marked)).to_pylist():
                every.append(_without(text, candidates(text)).encode())
            counted.update(re.findall(rb"[a-z]+", b"\n".join(every).lower()))
            if len(counted) > _HELD_WORDS:
                yield sums(counted)
                counted = Counter()
        yield sums(counted)

    found = docs.select("text").mapInArrow(count, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
    found = stored(found.filter(F.col("n") >= LEAST_TIMES))
    left, enough = most, None
    for n, words in found.groupBy("n").count().orderBy(F.desc("n")).limit(most).collect():
        left -= words
        if left < 0:
            break
        enough = n
    if enough is None:
        return []
    return [row.word for row in sorted(found.filter(F.col("n") >= enough).collect(), key=lambda row: (-row.n, row.word))]


def _joined(spans: list[Span]) -> str:
    return ",".join(f"{KINDS[kind]}:{start}:{end}" for start, kind, end in spans)


def find(docs: DataFrame, bits: float = SECRET_BITS, words: Sequence[str] | None = None) -> DataFrame:
    """One row per document: doc_id, n_assign, n_access, n_hex, base_sha256, spans.

    Counts and the digest are of the patterns' spans; `spans` also has those found by cost. Spans are kind:start:end in code
    points, by start and kind. NULL and empty texts have none. Repeated rows get equal results, a NULL doc_id stays NULL, an
    empty table gives no rows, other columns are not looked at. `words` are those of the dictionary, most frequent first; without
    them they are learned from `docs`, which reads all texts once more.
    """
    dictionary = ranked(learned_words(docs) if words is None else words)
    nothing = hashlib.sha256(b"").hexdigest()

    def search(batches):
        for batch in pieces(batches):
            n = batch.num_rows
            counts = np.zeros((len(KINDS), n), np.int64)
            digests, spans = [nothing] * n, [""] * n
            for i in _with_mark(batch.column("text")).tolist():
                base, every = all_spans(batch.column("text")[i].as_py(), bits, dictionary)
                for _, kind, _ in base:
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


_IS_HEX = np.zeros(256, bool)
_IS_HEX[[*b"0123456789abcdef"]] = True


def _with_mark(texts: pa.Array) -> np.ndarray:
    """The texts that hold a long hexadecimal run, an access key's beginning or a credential's word; no other has a span."""
    data, offsets = utf8(texts)
    starts, ends = runs(_IS_HEX[data], offsets)
    marks = starts[ends - starts >= 16].tolist()
    raw = data.tobytes()
    low = raw.lower()
    for needle, where in [(b"AKIA", raw), *((n, low) for n in _NEEDLES)]:
        at = where.find(needle)
        while at >= 0:
            marks.append(at)
            at = where.find(needle, at + 1)
    marks += [m.start() for m in _KEYS.finditer(low)]
    return np.unique(np.searchsorted(offsets, np.array(marks, np.int64), side="right") - 1)
