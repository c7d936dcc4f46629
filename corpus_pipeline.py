"""The corpus pipeline: from raw documents to shards of a training corpus.

Five stages, each by one operator of ``gridsky.llm``: drop documents that the quality
classifier rejects, keep one document of each near-duplicate group, drop documents
that hold benchmark items, mix the domains to target weights, and deal what is
left into shards. ``run`` applies them to the table ``documents``, staging each
result as Parquet in the shared working folder.

Cases: a null or empty text is scored like any other, belongs to no group and holds no item; null ids are rows of their
own, told apart by their texts; of rows that repeat in id and text one stays after the second stage; an
empty table runs through to an empty result with the columns of the last stage; other columns pass through all stages but
the last, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from gridsky.llm.common import staged
from gridsky.llm.decontaminate import drop_contaminated
from gridsky.llm.hash_tree import shard_documents
from gridsky.llm.ngram_join import one_per_component
from gridsky.llm.quality_fm import keep_good
from gridsky.llm.soft_mixing import label_domains, take_mixture

#: Token shares that the mixture aims at.
TARGETS = {"clean": 0.94, "toxic": 0.03, "junk": 0.03}


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score 0.5 or more."""
    return keep_good(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def ngram_jaccard_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of similar ones."""
    return one_per_component(docs)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without benchmark items."""
    return drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as its rate in the mixture says."""
    domains = label_domains(spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return take_mixture(docs, domains, TARGETS)


def sharding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The shard and slot of each row."""
    return shard_documents(docs)


STAGES = [
    ("quality classifier", quality_classifier),
    ("n-gram Jaccard join", ngram_jaccard_join),
    ("benchmark decontamination", benchmark_decontamination),
    ("mixing sources to target weights", mixing),
    ("sharding", sharding),
]

# A trained model and BM25 search are beyond SQL; tests hold each stage against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), f"pipeline-{name.replace(' ', '-')}")
    return STAGES[-1][1](spark, docs, sf_dir)
