"""Words of many texts as numpy arrays: where they are, exact ids, hashes, and texts put together from some of them.

A word is a longest stretch of bytes other than blank, tab, line feed, vertical tab, form feed and carriage return.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

from tierlake.llm.common import prefix_sums, runs, span_hashes, utf8

_IS_WORD = np.ones(256, bool)
_IS_WORD[[9, 10, 11, 12, 13, 32]] = False
#: Bytes that are hashed together; a longer word comes alone.
_HASHED = 1 << 20


def words_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The bytes of all texts, starts and ends of their words, and where each text's words begin (one more than texts)."""
    data, offsets = utf8(texts)
    starts, ends = runs(_IS_WORD[data], offsets)
    return data, starts, ends, np.searchsorted(starts, offsets)


def spelled(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> pa.Array:
    """The words as binary values."""
    size = ends - starts
    offsets = np.concatenate([[0], np.cumsum(size)])
    return pa.Array.from_buffers(pa.large_binary(), len(size), [None, pa.py_buffer(offsets), pa.py_buffer(_taken(data, starts, offsets))])


def word_ids(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A number for each word; equal words, and only they, have the same one."""
    return spelled(data, starts, ends).dictionary_encode().indices.to_numpy().astype(np.int64)


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each word."""
    found, first = np.empty(len(starts), np.uint64), 0
    while first < len(starts):
        last = max(first + 1, int(np.searchsorted(ends, starts[first] + _HASHED, side="right")))
        begin = starts[first]
        sums = prefix_sums(data[begin : ends[last - 1]])
        found[first:last] = span_hashes(sums, starts[first:last] - begin, ends[first:last] - begin)
        first = last
    return found


def joined(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, border: np.ndarray, keep: np.ndarray) -> pa.Array:
    """For each text its kept words, joined by one blank."""
    some = np.flatnonzero(keep)
    size = ends[some] - starts[some] + 1  # with a blank behind each
    offsets = np.concatenate([[0], np.cumsum(size)])
    out = np.full(offsets[-1], 32, np.uint8)
    at = np.ones(offsets[-1], bool)
    at[offsets[1:] - 1] = False
    out[at] = _taken(data, starts[some], np.concatenate([[0], np.cumsum(size - 1)]))
    bound = np.searchsorted(some, border)
    first, last = offsets[bound[:-1]], offsets[bound[1:]]
    last = np.maximum(first, last - 1)  # no blank after a text's last word
    # What lies between texts is a single blank, which belongs to none: cut it out by copying.
    length = last - first
    ends_out = np.concatenate([[0], np.cumsum(length)])
    flat = _taken(out, first, ends_out)
    whole = pa.Array.from_buffers(pa.large_string(), len(length), [None, pa.py_buffer(ends_out), pa.py_buffer(flat)])
    return whole.cast(pa.string())


def _taken(data: np.ndarray, starts: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Stretches of `data` end to end: each from its start, with the lengths that `offsets` leave."""
    step = np.ones(offsets[-1], np.int32 if len(data) < 1 << 31 else np.int64)
    size = np.diff(offsets)
    some = np.flatnonzero(size)
    if not len(some):
        return np.zeros(0, np.uint8)
    begin, count = starts[some], size[some]
    step[0] = begin[0]
    step[offsets[some[1:]]] = begin[1:] - (begin[:-1] + count[:-1] - 1)
    return data[np.cumsum(step, dtype=step.dtype)]
