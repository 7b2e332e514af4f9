"""The corpus pipeline: documents to token ids.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written
as Parquet and read again as the next stage's documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from finwater.llm import apportion, langid, mcd, simhash
from finwater.llm.queries import bpe_digests
from finwater.session import shared_scratch
from finwater.sources.tables import read_table


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is told with enough confidence."""
    return langid.keep_identified(docs)


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and are no robust outliers."""
    return mcd.keep_inliers(docs)


def simhash_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group (3-word shingles, 3 bits)."""
    return simhash.keep_first(docs, shingle=3, radius=3)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix's passes over the documents, cut where its blocks cut them."""
    return apportion.materialise(docs, length_col="n_chars")


def encode_bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of ids and decoded bytes."""
    return bpe_digests(docs)


STAGES = [
    ("language_id", identify_language),
    ("quality_rules", quality_rules),
    ("simhash_dedup", simhash_dedup),
    ("mix_sources", mix_sources),
    ("byte_bpe", encode_bpe),
]

#: Trained models, robust fits and merges are beyond SQL: tested against
#: brute-force versions of the stages instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            path = shared_scratch(spark, f"pipeline/{name}", unique=True)
            docs.write.parquet(path)
            docs = spark.read.parquet(path)
    return docs
