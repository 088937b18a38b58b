"""The queries opN_<name> and ``pipeline``: each applies its operator to a whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from pagewright.llm import bpe, embed_dedup, exact_dedup, html_text, lang_id, lm_score, minhash, mixing, token_counts, warc
from pagewright.llm.fixtures import MAIN_TEXT
from pagewright.session import ship


def _read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(_read(spark, sf_dir, "documents"), width=3, percent=85)


def op2_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = warc.round_trip(_read(spark, sf_dir, "pages"))
    return records.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op3_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embed_dedup.near_duplicates(_read(spark, sf_dir, "embeddings"))


def op4_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract(_read(spark, sf_dir, "pages"))


def main_text_fixtures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The operator of op4 over fixed pages that the tables do not hold."""
    ship(spark)
    pages = spark.createDataFrame([(i, "", html) for i, (html, _) in enumerate(MAIN_TEXT)], "page_id long, url string, html string")
    return html_text.extract(pages).select("page_id", "text", "n_chars")


def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lang_id.identify(_read(spark, sf_dir, "documents"))


def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(_read(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(_read(spark, sf_dir, "documents"))


def op8_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks = public_tokenizers.path("byte_bpe_50k.tiktoken")
    return bpe.encode_documents(_read(spark, sf_dir, "documents"), ranks, public_tokenizers.PATTERN, keep_ids=False)


def op9_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_dedup(_read(spark, sf_dir, "documents"))


def op10_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_score.score(_read(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_minhash_dedup": op1_minhash_dedup,
    "op2_warc": op2_warc,
    "op3_embedding_dedup": op3_embedding_dedup,
    "op4_html_text": op4_html_text,
    "main_text_fixtures": main_text_fixtures,
    "op5_language_id": op5_language_id,
    "op6_token_counts": op6_token_counts,
    "op7_mixing": op7_mixing,
    "op8_byte_bpe": op8_byte_bpe,
    "op9_exact_dedup": op9_exact_dedup,
    "op10_lm_score": op10_lm_score,
    "pipeline": pipeline,
}
