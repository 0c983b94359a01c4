"""Alignment of two tokenizers over a corpus: which ids of one stand for the same bytes as which ids of the other.

Both tokenizations of a text end a token at some of the same byte offsets; these cut both id lists into groups, and every
pair of ids in a group is a link. The offsets are found by intersecting the key sets of two dictionaries from cumulative end
to index; the sorted common keys slice both lists, and links are expanded per slice.

No token of either vocabulary reaches from a character that is no white space to a blank behind it, so a text can be cut
there into chunks that are tokenized and aligned on their own, and each distinct chunk of a block of texts is done once. Chunks
end where both tokenizations do, so a text's groups are those of its chunks.

How many documents hold a link is known only after the whole corpus has been seen. A block numbers its distinct links by how
frequent they are, and keeps each text as packed numbers. The distinct links of all blocks are counted in one aggregation,
joined with the counts, and return to their blocks, so that no row per document and link is ever shuffled.
"""

from __future__ import annotations

import re
from collections import defaultdict
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tierlake.llm.bpe import packed, unpacked
from tierlake.llm.common import pieces, stored

#: Characters of text that share their chunks and links (a longer text is a block of its own); bytes of chunks that are
#: tokenized together; texts and links of a row; links of texts that are counted together.
BLOCK_CHARS, TOGETHER, ROW_TEXTS, ROW_LINKS, COUNTED = 16 << 20, 1 << 17, 200, 10_000, 4_000_000

_IRREGULAR = re.compile(r"\s ")
_BETWEEN = re.compile(r"(?<=\S)(?= )")


def chunks(text: str) -> list[str]:
    """The chunks of a blank and `text`, each without the blank that it begins with. An empty text has none.

    A single blank at the end stays with the chunk before it: on its own it would be an empty text, which has no tokens.
    """
    if not text:
        return []
    if text[0] != " " and not _IRREGULAR.search(text):
        found = text.split(" ")
    else:
        found = [chunk[1:] for chunk in _BETWEEN.split(f" {text}")]
    if not found[-1]:
        found[-2:] = [f"{found[-2]} "]
    return found


class Pair:
    """Both tokenizers, and the bytes of each id."""

    def __init__(self, path_a: str, path_b: str):
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(path_a)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=path_b)
        known = {character: byte for byte, character in byte_characters().items()}
        own = self.a.get_vocab(with_added_tokens=True)
        self.bytes_a = [b""] * (1 + max(own.values()))
        for token, number in own.items():
            self.bytes_a[number] = bytes(known[c] for c in token) if all(c in known for c in token) else token.encode()
        self.bytes_b = []
        for number in range(self.b.get_piece_size()):
            piece = self.b.id_to_piece(number)
            self.bytes_b.append(bytes([int(piece[3:5], 16)]) if self.b.is_byte(number) else piece.replace("▁", " ").encode())
        self.names = list(map(str, range(max(len(self.bytes_a), len(self.bytes_b)))))

    def encoded(self, text: str) -> tuple[list[int], list[int]] | None:
        """The ids of a blank and `text`; None if the tokens of one do not spell it."""
        a, b = self.a.encode(f" {text}", add_special_tokens=False).ids, self.b.encode(text)
        raw = f" {text}".encode()
        if b"".join(map(self.bytes_a.__getitem__, a)) != raw or b"".join(map(self.bytes_b.__getitem__, b)) != raw:
            return None
        return a, b


def byte_characters() -> dict[int, str]:
    """The character by which byte-level vocabularies write each byte: printable ones as they are, others from 256 on."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    rest = [byte for byte in range(256) if byte not in plain]
    return {byte: chr(byte) for byte in plain} | {byte: chr(256 + i) for i, byte in enumerate(rest)}


@cache
def _pair(path_a: str, path_b: str) -> Pair:
    return Pair(path_a, path_b)


def common_ends(a: list[int], b: list[int]) -> tuple[list[int], list[int], list[int]]:
    """The offsets at which both lists of cumulative ends have one, in order, and how many ends each list has up to there."""
    in_a, in_b = dict(zip(a, range(1, len(a) + 1), strict=True)), dict(zip(b, range(1, len(b) + 1), strict=True))
    both = sorted(in_a.keys() & in_b.keys())
    return both, list(map(in_a.__getitem__, both)), list(map(in_b.__getitem__, both))


def links(ids_a: np.ndarray, ids_b: np.ndarray, upto_a: np.ndarray, upto_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All links of groups that end at the given indices, as a << 32 | b, and how many each group has."""
    size_a, size_b = np.diff(upto_a, prepend=0), np.diff(upto_b, prepend=0)
    count = size_a * size_b
    group = np.repeat(np.arange(len(count)), count)
    nth = np.arange(len(group)) - np.repeat(np.cumsum(count) - count, count)
    wide = size_b[group]
    a = ids_a[(upto_a - size_a)[group] + nth // wide]
    b = ids_b[(upto_b - size_b)[group] + nth % wide]
    return a << 32 | b, count


def aligned(pair: Pair, wanted: list[str]):
    """For each chunk the numbers of tokens (two), groups and links, its groups as text, and whether its tokens spell it; and
    all links end to end."""
    size, told, spelt, found = [np.zeros((0, 4), np.int64)], [], [], [np.zeros(0, np.int64)]
    for some, ids in _tokenized(pair, wanted):
        told_here = len(told)
        if ids is None:  # a single chunk that is not spelt
            size.append(np.zeros((1, 4), np.int64))
            told.append("")
            spelt.append(False)
            continue
        a, b = (np.array(x, np.int64) for x in ids)
        ends_a = np.cumsum(np.fromiter(map(len, map(pair.bytes_a.__getitem__, ids[0])), np.int64, len(a)))
        ends_b = np.cumsum(np.fromiter(map(len, map(pair.bytes_b.__getitem__, ids[1])), np.int64, len(b)))
        both, upto_a, upto_b = common_ends(ends_a.tolist(), ends_b.tolist())
        own, count = links(a, b, np.array(upto_a), np.array(upto_b))
        names_a, names_b = (list(map(pair.names.__getitem__, x)) for x in ids)
        slices = zip([0, *upto_a], upto_a, [0, *upto_b], upto_b)
        groups = [f"{','.join(names_a[i:j])}|{','.join(names_b[k:m])}" for i, j, k, m in slices]
        stop = np.cumsum([1 + len(chunk.encode()) for chunk in some])
        last = np.searchsorted(both, stop) + 1  # groups up to the end of each chunk
        done = np.stack([np.array(upto_a)[last - 1], np.array(upto_b)[last - 1], last, np.cumsum(count)[last - 1]], axis=1)
        size.append(np.diff(done, axis=0, prepend=0))
        told += [";".join(groups[i:j]) for i, j in zip([0, *last.tolist()], last.tolist())]
        spelt += [True] * (len(told) - told_here)
        found.append(own)
    return np.concatenate(size), told, np.array(spelt, bool), np.concatenate(found)


def _tokenized(pair: Pair, wanted: list[str]):
    """The ids of many chunks at a time, which tokenize as they do alone; of some chunks singly, None where they are not spelt."""
    together, held = [], 0

    def out():
        ids = pair.encoded(" ".join(together))
        return [(together, ids)] if ids else [([chunk], pair.encoded(chunk)) for chunk in together]

    for chunk in wanted:
        alone = not chunk or chunk[-1].isspace() or "▁" in chunk  # white space at the end looks at what comes next
        if together and (alone or held > TOGETHER):
            yield from out()
            together, held = [], 0
        if alone:
            yield [chunk], pair.encoded(chunk)
        else:
            together.append(chunk)
            held += len(chunk) + 1
    if together:
        yield from out()


_NAMES = ["block", "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups", "codes", "first", "links", "held"]
_KINDS = [*[pa.int64()] * 6, pa.string(), pa.binary(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64())]
_SCHEMA = "block long, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups string, codes binary, first long, links array<long>, held array<long>"


def _aligned(path_a: str, path_b: str, block_chars: int, told_as):
    def align(batches):
        pair, task, made = _pair(path_a, path_b), TaskContext.get().partitionId(), 0
        local: defaultdict[str, int] = defaultdict()
        local.default_factory = local.__len__
        ids, texts, chars = [], [], 0
        for batch in pieces(batches):
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist(), strict=True):
                if chars and chars + len(text) > block_chars:
                    yield from _block((task << 32) + made, pair, list(local), ids, texts, told_as)
                    made, chars = made + 1, 0
                    local.clear()
                    ids, texts = [], []
                own = chunks(text)
                texts.append(np.fromiter(map(local.__getitem__, own), np.int32, len(own)))
                ids.append(doc_id)
                chars += len(text)
        if texts:
            yield from _block((task << 32) + made, pair, list(local), ids, texts, told_as)

    return align


def _block(block: int, pair: Pair, wanted: list[str], ids: list, texts: list[np.ndarray], told_as):
    """The rows of a block: its texts, with their links as packed numbers, and its distinct links."""
    size, told, spelt, found = aligned(pair, wanted)
    own, number = np.unique(found, return_inverse=True)
    n_links, at = size[:, 3], np.cumsum(size[:, 3]) - size[:, 3]
    texts = [t if spelt[t].all() else t[:0] for t in texts]
    counts, held = [], np.zeros(len(own), np.int64)
    first = 0
    while first < len(texts):  # distinct links of each text, some texts at a time
        last, many = first, 0
        while last < len(texts) and (last == first or many < COUNTED):
            many += int(n_links[texts[last]].sum())
            last += 1
        flat = np.concatenate(texts[first:last])
        text = np.repeat(np.arange(last - first), [len(t) for t in texts[first:last]])
        each = n_links[flat]
        of = np.repeat(text, each)
        link = number[np.repeat(at[flat] - (np.cumsum(each) - each), each) + np.arange(each.sum())]
        both, times = np.unique(of * len(own) + link if len(own) else of, return_counts=True)
        counts.append((np.searchsorted(both, np.arange(last - first + 1) * len(own)), both % max(1, len(own)), times))
        held += np.bincount(counts[-1][1], minlength=len(own))
        first = last
    order = np.argsort(-held, kind="stable")
    rank = np.empty(len(own), np.int64)
    rank[order] = np.arange(len(own))
    codes = []
    for bounds, link, times in counts:
        for i, j in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
            by_rank = np.argsort(rank[link[i:j]])
            gaps = np.diff(rank[link[i:j]][by_rank], prepend=0)
            codes.append(packed(np.stack([gaps, times[i:j][by_rank]], axis=1).ravel()))
    sums = np.array([size[t].sum(axis=0) for t in texts]).reshape(-1, 4)
    for i in range(0, len(texts), ROW_TEXTS):
        part = texts[i : i + ROW_TEXTS]
        columns = [[block] * len(part), ids[i : i + ROW_TEXTS], *sums[i : i + ROW_TEXTS].T]
        columns += [[told_as(";".join(map(told.__getitem__, t.tolist()))) for t in part], codes[i : i + ROW_TEXTS]]
        yield _batch(len(part), columns + [None] * 3)
    order = order[: np.count_nonzero(held)]  # others are only in texts that count for nothing
    for i in range(0, len(order), ROW_LINKS):
        some = order[i : i + ROW_LINKS]
        yield _batch(1, [[block], *[None] * 7, [i], [own[some]], [held[some]]])


def _batch(rows: int, columns: list) -> pa.RecordBatch:
    parts = [pa.nulls(rows, kind) if c is None else pa.array(c, kind) for c, kind in zip(columns, _KINDS, strict=True)]
    return pa.RecordBatch.from_arrays(parts, _NAMES)


def _summed(texts: pa.Table, known: pa.Table) -> pa.Table:
    """The sums of each text of one block over its links."""
    n = known.num_rows  # numbers run from 0 on without a gap
    count, best = np.zeros(n, np.int64), np.zeros(n, bool)
    number = known.column("number").to_numpy()
    count[number], best[number] = known.column("count").to_numpy(), known.column("best").to_numpy(zero_copy_only=False)
    n_best, total = [], []
    for codes in texts.column("codes").to_pylist():
        gaps, times = unpacked(codes).reshape(-1, 2).T
        link = np.cumsum(gaps)
        n_best.append(int(times[best[link]].sum()))
        total.append(int((times * count[link]).sum()))
    kept = texts.select(["doc_id", "n_a", "n_b", "n_groups", "n_links", "groups"])
    return kept.append_column("n_best", pa.array(n_best, pa.int64())).append_column("count_sum", pa.array(total, pa.int64()))


def _blocks(docs: DataFrame, path_a: str, path_b: str, block_chars: int, told_as) -> DataFrame:
    plain = docs.select(F.col("doc_id").cast("long"), F.coalesce("text", F.lit("")).alias("text"))
    return stored(plain.mapInArrow(_aligned(path_a, path_b, block_chars, told_as), _SCHEMA))


def _own_links(blocks: DataFrame) -> DataFrame:
    """Rows (block, number, a, b, held) of the distinct links of each block."""
    rows = blocks.filter("links IS NOT NULL").select("block", "first", F.arrays_zip("links", "held").alias("own"))
    rows = rows.select("block", "first", F.posexplode("own").alias("nth", "own"))
    link = F.col("own.links")
    return rows.select(
        "block",
        (F.col("first") + F.col("nth")).cast("int").alias("number"),
        F.shiftright(link, 32).cast("int").alias("a"),
        link.bitwiseAND(F.lit((1 << 32) - 1)).cast("int").alias("b"),
        F.col("own.held").alias("held"),
    )


def _counted(own: DataFrame) -> DataFrame:
    """For each link its number of documents, and whether no other link of its id `a` has more."""
    counts = stored(own.groupBy("a", "b").agg(F.sum("held").alias("count")))
    most = counts.groupBy("a").agg(F.max("count").alias("most"))
    return counts.join(most, "a").select("a", "b", "count", (F.col("count") == F.col("most")).alias("best"))


def id_links(docs: DataFrame, path_a: str, path_b: str, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """The table of links of a corpus: a, b, count (documents that hold the link), best (no link of this a has a larger count).

    Which documents have links is said at `align`; an empty table gives no rows.
    """
    return _counted(_own_links(_blocks(docs, path_a, path_b, block_chars, _nothing)))


def align(docs: DataFrame, path_a: str, path_b: str, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """One row per document, repeated ones too: doc_id, n_a, n_b, n_groups, n_links, groups, n_best and count_sum.

    groups: `a1,a2|b1;a3|b2,b3`, the ids of both tokenizers in order; n_best: links that no other link of the same id of the
    first tokenizer exceeds in its number of documents; count_sum: the sum over all links of these numbers. Both tokenizers
    get a blank in front of the text, and strings of special tokens are ordinary text. Texts that are NULL or empty, or that
    the tokens of one tokenizer do not spell, have no tokens: zeros, and empty groups. A NULL doc_id stays NULL, other columns
    are not looked at, an empty table gives no rows. A row counts as a document, whether or not its id or text is repeated.
    """
    return _align(docs, path_a, path_b, block_chars, str)


def digests(docs: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """As `align`, with the SHA-256 of the groups (nothing for none) in place of them."""
    return _align(docs, path_a, path_b, BLOCK_CHARS, _sha256).withColumnRenamed("groups", "groups_sha256")


def _align(docs: DataFrame, path_a: str, path_b: str, block_chars: int, told_as) -> DataFrame:
    blocks = _blocks(docs, path_a, path_b, block_chars, told_as)
    own = _own_links(blocks)
    # Written out because adaptive execution can only split a link of very many blocks between two plain shuffles.
    known = own.join(stored(_counted(own)), ["a", "b"]).select(F.col("block").alias("of"), "number", "count", "best")
    texts = blocks.filter("links IS NULL").drop("first", "links", "held")
    kind = "doc_id long, n_a long, n_b long, n_groups long, n_links long, groups string, n_best long, count_sum long"
    return texts.groupBy("block").cogroup(known.groupBy("of")).applyInArrow(_summed, kind)


def _sha256(groups: str) -> str:
    import hashlib

    return hashlib.sha256(groups.encode()).hexdigest() if groups else ""


def _nothing(groups: str) -> str:
    return ""


def vocabulary_paths(spark: SparkSession) -> tuple[str, str]:
    """Where the vocabularies lie: `spark.tierlake.alignment.path_a` and `.path_b`, or the public package's files."""
    import public_tokenizers

    a, b = (spark.conf.get(f"spark.tierlake.alignment.path_{x}", None) for x in "ab")
    return a or public_tokenizers.path("byte_bpe_50k.json"), b or public_tokenizers.path("piece_bpe_32k.model")
