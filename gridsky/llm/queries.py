"""The operators of this package as named queries over the shared tables, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from gridsky.llm import sql
from gridsky.llm.conversations import damaged, repair_report
from gridsky.llm.decontaminate import benchmark_matches
from gridsky.llm.exact_dedup import exact_dedup
from gridsky.llm.grid_codes import compress_vectors
from gridsky.llm.hash_tree import shard_documents
from gridsky.llm.line_windows import dedup_lines
from gridsky.llm.ngram_join import jaccard_components
from gridsky.llm.quality_fm import score_documents
from gridsky.llm.repeats import dedup_substrings
from gridsky.llm.soft_mixing import label_domains, mix_documents
from gridsky.llm.token_fst import piece_scores, token_counts
from gridsky.llm.unit_dedup import dedup_units
from gridsky.llm.warc import read_warc, write_warc
from gridsky.session import fresh_dir

#: Token shares that the mixture aims at.
TARGETS = {"clean": 0.94, "toxic": 0.03, "junk": 0.03}

Query = Callable[[SparkSession, str], DataFrame]


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup_lines(_table(spark, sf_dir, "documents"), with_kept=False)


def op2_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup_units(_table(spark, sf_dir, "documents"), with_kept=False)


def op3_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup_substrings(_table(spark, sf_dir, "documents"), with_kept=False)


def op4_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_documents(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op5_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_components(_table(spark, sf_dir, "documents"))


def op6_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return benchmark_matches(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op7_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard_documents(_table(spark, sf_dir, "documents"))


def op8_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(_table(spark, sf_dir, "documents"))


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    domains = label_domains(_table(spark, sf_dir, "labels"))
    return mix_documents(_table(spark, sf_dir, "documents"), domains, TARGETS)


def op10_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = fresh_dir(spark, "warc")
    write_warc(_table(spark, sf_dir, "pages"), path)
    read = read_warc(spark, path, payload=False)
    return read.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    conversations = _table(spark, sf_dir, "conversations")
    return repair_report(damaged(conversations), conversations)


def op12_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return compress_vectors(_table(spark, sf_dir, "embeddings"))


def op13_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(_table(spark, sf_dir, "documents"), piece_scores(tokenizer_file("piece_bpe_32k.model")))


def tokenizer_file(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def all_queries() -> dict[str, Query]:
    named = (
        op1_line_dedup,
        op2_substring_dedup,
        op3_suffix_array_dedup,
        op4_quality_classifier,
        op5_ngram_jaccard_join,
        op6_benchmark_decontamination,
        op7_sharding,
        op8_exact_dedup,
        op9_mixing,
        op10_warc,
        op11_conversation_repair,
        op12_vector_codes,
        op13_token_counts,
    )
    return {f.__name__: f for f in named}


def all_oracles() -> dict[str, str]:
    return {
        "op1_line_dedup": sql.LINE_WINDOWS,
        "op2_substring_dedup": sql.UNITS,
        "op3_suffix_array_dedup": sql.REPEATS,
        "op5_ngram_jaccard_join": sql.JACCARD,
        "op6_benchmark_decontamination": sql.DECONTAMINATION,
        "op8_exact_dedup": sql.EXACT_DEDUP,
        "op10_warc": sql.WARC,
        "op11_conversation_repair": sql.CONVERSATIONS,
        "op12_vector_codes": sql.VECTOR_CODES,
    }
