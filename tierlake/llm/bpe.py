"""Byte-level BPE over a whole corpus, with each distinct word encoded once.

Texts are split into pre-tokens. A task gathers a block of texts, numbers the block's distinct pre-tokens by how frequent
they are, and writes each text as a list of these numbers, which is its pre-tokens by position. The distinct pre-tokens of
all blocks meet in one shuffle, where each is encoded once; their ids go back to the blocks, and texts are put together by
position. What moves is a byte or two per pre-token and the blocks' vocabularies, many words to a row, not a row per pre-token.

Decoding looks ids up in the table of token bytes. The ranks and that table are as large as the vocabulary file, which
does not grow with the data, so they are broadcast.
"""

from __future__ import annotations

import base64
import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tierlake.llm.common import pieces, utf8

#: Characters of text that share a vocabulary (a longer text is a block of its own), texts of a row, and the parts that
#: words are dealt to, of which a task may take several.
BLOCK_CHARS, ROW_TEXTS, WORD_PARTS = 32 << 20, 500, 512
#: Words that a task remembers the ids of; beyond that it forgets them all and encodes a word again.
_REMEMBERED = 500_000
_WORDS, _TEXTS = 0, 1


def read_ranks(path: str) -> dict[bytes, int]:
    """Token bytes and ranks of a vocabulary file with a base64 token and a rank per line."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in lines if line.strip())}


def packed(numbers: np.ndarray) -> bytes:
    """Numbers below 2^28 in one to four bytes each, small ones in fewer; the last byte of each has its high bit clear."""
    numbers = numbers.astype(np.uint32)
    length = 1 + (numbers >= 1 << 7) + (numbers >= 1 << 14) + (numbers >= 1 << 21)
    end = np.cumsum(length)
    out = np.zeros(int(end[-1]) if len(end) else 0, np.uint8)
    for k in range(4):
        some = length > k
        out[end[some] - 1 - k] = (numbers[some] >> np.uint32(7 * k)) & np.uint32(127) | (np.uint32(128) if k else np.uint32(0))
    return out.tobytes()


def unpacked(data: bytes) -> np.ndarray:
    raw = np.frombuffer(data, np.uint8)
    end = np.flatnonzero(raw < 128)
    length = np.diff(end, prepend=-1)
    numbers = np.zeros(len(end), np.int64)
    for k in range(int(length.max(initial=0))):
        some = length > k
        numbers[some] |= (raw[end[some] - k].astype(np.int64) & 127) << (7 * k)
    return numbers


def _blocks(pattern: str, block_chars: int):
    def split(batches):
        import regex

        find = regex.compile(pattern).findall
        task, made = TaskContext.get().partitionId(), 0
        local: defaultdict[str, int] = defaultdict()
        local.default_factory = local.__len__
        ids, texts, chars = [], [], 0

        def flush():
            block = (task << 32) + made
            flat = np.concatenate([np.zeros(0, np.int32), *texts])
            often = np.bincount(flat, minlength=len(local))
            by_count = np.argsort(-often, kind="stable")
            rank = np.empty(len(local), np.int64)
            rank[by_count] = np.arange(len(local))
            words = list(local)
            for first in range(0, len(words), 200_000):
                part = [words[i].encode() for i in by_count[first : first + 200_000].tolist()]
                number = np.arange(first, first + len(part), dtype=np.int32)
                yield _row(block, _WORDS, {"word": pa.array(part, pa.binary()), "number": pa.array(number)})
            for at in range(0, len(texts), ROW_TEXTS):
                codes = pa.array([packed(rank[t]) for t in texts[at : at + ROW_TEXTS]], pa.binary())
                yield _row(block, _TEXTS, {"doc_id": pa.array(ids[at : at + ROW_TEXTS], pa.int64()), "codes": codes})

        for batch in pieces(batches):
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist(), strict=True):
                found = find(text)
                if chars and chars + len(text) > block_chars:
                    yield from flush()
                    made, chars = made + 1, 0
                    local.clear()
                    ids, texts = [], []
                texts.append(np.fromiter(map(local.__getitem__, found), np.int32, len(found)))
                ids.append(doc_id)
                chars += len(text)
        if texts:
            yield from flush()

    return split


def _payload(columns: dict[str, pa.Array]) -> bytes:
    """A small table as compressed bytes."""
    rows = pa.RecordBatch.from_pydict(columns)
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, rows.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
        out.write_batch(rows)
    return sink.getvalue().to_pybytes()


def _opened(payload: bytes) -> pa.Table:
    return pa.ipc.open_stream(payload).read_all()


def _row(block: int, kind: int, columns: dict[str, pa.Array]) -> pa.RecordBatch:
    payload = pa.array([_payload(columns)], pa.binary())
    return pa.RecordBatch.from_arrays([pa.array([block], pa.int64()), pa.array([kind], pa.int32()), payload], ["block", "kind", "payload"])


def _dealt(batches):
    """The words of each block by the part that they belong to."""
    for batch in batches:
        for block, kind, payload in zip(*(batch.column(c).to_pylist() for c in ("block", "kind", "payload")), strict=True):
            if kind != _WORDS:
                continue
            words = _opened(payload).combine_chunks()
            part = np.fromiter((zlib.crc32(w) % WORD_PARTS for w in words.column("word").to_pylist()), np.int32, len(words))
            order = np.argsort(part, kind="stable")
            border = np.searchsorted(part[order], np.arange(WORD_PARTS + 1))
            for p in np.unique(part).tolist():
                own = words.take(pa.array(order[border[p] : border[p + 1]]))
                held = _payload({name: own.column(name).combine_chunks() for name in own.column_names})
                yield pa.RecordBatch.from_arrays(
                    [pa.array([p], pa.int32()), pa.array([block], pa.int64()), pa.array([held], pa.binary())],
                    ["part", "block", "payload"],
                )


def _encoded(ranks, pattern: str):
    """The ids of each block's words of one part; a word's ids are found once, whichever blocks have it."""

    def encode(batches):
        import tiktoken

        one = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks.value, special_tokens={})._core_bpe.encode_single_piece
        known: dict[bytes, bytes] = {}
        for batch in batches:
            for block, payload in zip(*(batch.column(c).to_pylist() for c in ("block", "payload")), strict=True):
                words = _opened(payload)
                ids = []
                for word in words.column("word").to_pylist():
                    found = known.get(word)
                    if found is None:
                        if len(known) >= _REMEMBERED:
                            known.clear()
                        found = known[word] = np.array(one(word), "<u4").tobytes()
                    ids.append(found)
                numbers = words.column("number").combine_chunks()
                held = _payload({"number": numbers, "ids": pa.array(ids, pa.binary())})
                yield pa.RecordBatch.from_arrays([pa.array([block], pa.int64()), pa.array([held], pa.binary())], ["block", "payload"])

    return encode


def _whole(left: pa.Table, right: pa.Table) -> pa.Table:
    """The texts of one block as ids."""
    words = pa.concat_tables([_opened(p) for p in right.column("payload").to_pylist()] or [_NO_WORDS])
    flat, start = utf8(words.sort_by("number").column("ids").combine_chunks())
    flat, start = flat.view("<u4"), start // 4
    size = np.diff(start)
    names, numbers = [], []
    for kind, payload in zip(left.column("kind"), left.column("payload"), strict=True):
        if kind.as_py() == _TEXTS:
            texts = _opened(payload.as_py())
            names += texts.column("doc_id").chunks
            numbers += [unpacked(codes).astype(np.int32) for codes in texts.column("codes").to_pylist()]
    offsets = np.cumsum([0, *(int(size[own].sum()) for own in numbers)])
    ids = np.empty(offsets[-1], "<u4")
    for own, first, end in zip(numbers, offsets, offsets[1:], strict=False):
        sizes = size[own]
        ids[first:end] = flat[np.arange(end - first) + np.repeat(start[own] - np.cumsum(sizes) + sizes, sizes)]
    held = pa.Array.from_buffers(pa.large_binary(), len(numbers), [None, pa.py_buffer(4 * offsets.astype(np.int64)), pa.py_buffer(ids)])
    return pa.table({"doc_id": pa.chunked_array(names, pa.int64()), "ids": held.cast(pa.binary())})


_NO_WORDS = pa.table({"number": pa.array([], pa.int32()), "ids": pa.array([], pa.binary())})


def encode(docs: DataFrame, path: str, pattern: str, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """One row per document, repeated ones too: doc_id, and ids as binary of little-endian unsigned 32-bit integers.

    NULL and empty texts have no ids, a NULL doc_id stays NULL, other columns are not looked at, an empty table gives no
    rows. Characters that spell special tokens are ordinary text.
    """
    spark = docs.sparkSession
    ranks = spark.sparkContext.broadcast(read_ranks(path))
    plain = docs.select(F.col("doc_id").cast("long"), F.coalesce("text", F.lit("")).alias("text"))
    # Both uses below read this one exchange.
    blocks = plain.mapInArrow(_blocks(pattern, block_chars), "block long, kind int, payload binary").repartition("block")
    dealt = blocks.mapInArrow(_dealt, "part int, block long, payload binary").repartition("part")
    numbered = dealt.mapInArrow(_encoded(ranks, pattern), "block long, payload binary")
    return blocks.groupBy("block").cogroup(numbered.groupBy("block")).applyInArrow(_whole, "doc_id long, ids binary")


def decode(encoded: DataFrame, path: str) -> DataFrame:
    """`encoded` with a column `bytes`: the bytes that its ids stand for. NULL ids give NULL; an unknown id is an error."""
    spark = encoded.sparkSession
    tokens = spark.sparkContext.broadcast({rank: token for token, rank in read_ranks(path).items()})

    def look_up(batches):
        known = tokens.value
        for batch in pieces(batches, "ids", 1 << 20):
            rows = batch.column("ids").to_pylist()
            found = [None if r is None else b"".join(map(known.__getitem__, np.frombuffer(r, "<u4").tolist())) for r in rows]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found, pa.binary())], [*batch.schema.names, "bytes"])

    names = ", ".join(f"`{name}` {kind}" for name, kind in encoded.dtypes)
    return encoded.mapInArrow(look_up, f"{names}, bytes binary")


def round_trip(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """Per document: doc_id, n_tokens, and the SHA-256 of its ids and of the bytes they decode to.

    NULL and empty texts have no tokens and the digest of nothing. Each repeated row gives a row, a NULL doc_id stays NULL, texts
    may have any length, an empty table gives no rows, and other columns are not looked at.
    """
    both = decode(encode(docs, path, pattern), path)
    return both.select(
        "doc_id",
        (F.length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("bytes", 256).alias("decoded_sha256"),
    )


def vocabulary_path(spark: SparkSession, name: str = "byte_bpe_50k.tiktoken") -> str:
    """Where the vocabulary lies: `spark.tierlake.bpe.path`, or the public package's file."""
    import public_tokenizers

    return spark.conf.get("spark.tierlake.bpe.path", None) or public_tokenizers.path(name)
