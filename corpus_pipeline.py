"""A corpus in five stages, from raw documents to tokens: each stage works on what the one before it has kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tierlake.llm import bpe, chunk_dedup, langid_crf, minhash, mixing
from tierlake.llm.common import stored, table

#: Documents whose sets of five-word shingles are at least this similar are near copies; op10's contract has its own figure.
NEAR_PERCENT = 80


def identify(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a language of their own go, among them those without a text or a letter; repeated rows stay."""
    return langid_crf.keep_identified(docs)


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts one row stays, that with the largest id; a row without an id only if none with an id has its text."""
    return chunk_dedup.keep_one(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies one stays, that with the smallest id; texts that have no shingles are near to none."""
    return minhash.keep_one(docs, NEAR_PERCENT)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents are repeated or go as the rates of their domains say; prose stays, junk and toxic have their shares at most."""
    return mixing.resample(docs, table(spark, sf_dir, "labels"), keep="prose")


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Number of tokens of each document, repeated ones too, and digests of its ids and of what they decode to."""
    import public_tokenizers

    return bpe.round_trip(docs, bpe.vocabulary_path(spark), public_tokenizers.PATTERN)


STAGES = [
    ("language ID", identify),
    ("exact dedup", drop_copies),
    ("near dedup", drop_near_copies),
    ("mixing", mix),
    ("byte-level BPE", tokenize),
]

#: A learned classifier and MinHash are not SQL. Tests compare exact and near dedup, rates and tokens with plain versions, and the
#: marginals of language ID with those over every path.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows for `documents`; each stage's rows are stored before the next one reads them."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir))
    return docs
