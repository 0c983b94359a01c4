"""One query for each operator of this package, over its whole table, and SQL for those that SQL can express."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tierlake.llm import (
    bpe,
    chunk_dedup,
    langid_crf,
    maxscore,
    minhash,
    mixing,
    periodic_runs,
    pii_semicrf,
    secret_cost,
    suffix_dedup,
    token_alignment,
    toxicity,
    word_dedup,
)
from tierlake.llm.common import table


def op1_langid_crf(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid_crf.predict(table(spark, sf_dir, "documents"))


def op2_chunk_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chunk_dedup.duplicates(table(spark, sf_dir, "documents"))


def op3_maxscore(spark: SparkSession, sf_dir: str) -> DataFrame:
    return maxscore.top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)


def op4_pii_semicrf(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii_semicrf.find(table(spark, sf_dir, "documents"))


def op5_secret_cost(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_cost.find(table(spark, sf_dir, "documents"))


def op6_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return bpe.round_trip(table(spark, sf_dir, "documents"), bpe.vocabulary_path(spark), public_tokenizers.PATTERN)


def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.rates(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.predict(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op9_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.digests(table(spark, sf_dir, "documents"))


def op10_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.clusters(table(spark, sf_dir, "documents"))


def op11_fm_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return word_dedup.digests(table(spark, sf_dir, "documents"))


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periodic_runs.digests(periodic_runs.with_periods(table(spark, sf_dir, "documents")))


def op13_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_alignment.digests(table(spark, sf_dir, "documents"), *token_alignment.vocabulary_paths(spark))


QUERIES = {
    "op1_langid_crf": op1_langid_crf,
    "op2_chunk_dedup": op2_chunk_dedup,
    "op3_maxscore": op3_maxscore,
    "op4_pii_semicrf": op4_pii_semicrf,
    "op5_secret_cost": op5_secret_cost,
    "op6_byte_bpe": op6_byte_bpe,
    "op7_mixing": op7_mixing,
    "op8_toxicity": op8_toxicity,
    "op9_suffix_dedup": op9_suffix_dedup,
    "op10_minhash": op10_minhash,
    "op11_fm_index": op11_fm_index,
    "op12_periodic_runs": op12_periodic_runs,
    "op13_token_alignment": op13_token_alignment,
}

ORACLES = {
    "op3_maxscore": """
        WITH numbers AS (
            SELECT vec_id, unnest(embedding) AS x, generate_subscripts(embedding, 1) AS d FROM embeddings
        ),
        usable AS (
            SELECT vec_id FROM numbers GROUP BY vec_id HAVING count(x) = count(*) AND bool_and(isfinite(x))
        ),
        whole AS (
            SELECT n.vec_id, n.d, CAST(floor(1024 * CAST(n.x AS DOUBLE)) AS BIGINT) AS v
            FROM numbers n JOIN usable u ON n.vec_id = u.vec_id
        ),
        scores AS (
            SELECT a.vec_id AS query_id, b.vec_id AS vec_id, CAST(sum(a.v * b.v) AS BIGINT) AS score
            FROM whole a JOIN whole b ON a.d = b.d AND a.vec_id <> b.vec_id
            WHERE a.vec_id % 100 = 0
            GROUP BY a.vec_id, b.vec_id
        ),
        ranked AS (
            SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank,
                   vec_id, score
            FROM scores
        )
        SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 10
    """,
    "op2_chunk_dedup": """
        SELECT doc_id,
               max(doc_id) OVER (PARTITION BY coalesce(text, '')) AS keep_id,
               count(*) OVER (PARTITION BY coalesce(text, '')) AS group_size,
               doc_id = max(doc_id) OVER (PARTITION BY coalesce(text, '')) AS kept,
               sha256(coalesce(text, '')) AS text_sha256
        FROM documents
    """,
    "op11_fm_index": r"""
        WITH texts AS (
            SELECT row_number() OVER () AS nr, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words
            FROM documents
        ),
        windows AS (
            SELECT nr, first, array_to_string(words[first : first + 34], ' ') AS sequence
            FROM (SELECT nr, words, unnest(range(1, len(words) - 33)) AS first FROM texts)
        ),
        repeated AS (SELECT sequence FROM windows GROUP BY sequence HAVING count(*) > 1),
        covered AS (
            SELECT DISTINCT nr, unnest(range(first, first + 35)) AS place
            FROM windows WHERE sequence IN (SELECT sequence FROM repeated)
        ),
        placed AS (SELECT nr, unnest(words) AS word, generate_subscripts(words, 1) AS place FROM texts),
        kept AS (
            SELECT nr, count(*) AS n, string_agg(word, ' ' ORDER BY place) AS words
            FROM placed ANTI JOIN covered USING (nr, place) GROUP BY nr
        )
        SELECT doc_id, CAST(len(texts.words) AS BIGINT) AS n_words, CAST(len(texts.words) - coalesce(n, 0) AS BIGINT) AS n_removed,
               sha256(coalesce(kept.words, '')) AS kept_sha256
        FROM texts LEFT JOIN kept USING (nr)
    """,
}
