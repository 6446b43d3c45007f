"""The corpus pipeline: raw documents in, packed training sequences out.

Each stage takes what its predecessor kept and returns the columns of ``documents``; the
last returns the pieces of the packed sequences.  ``run`` stores every stage in the
shared folder before the next one reads it.  Mixing is no filter: documents of
over-represented sources may be drawn zero times, those of others several times, as
their target rate says.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from starbuild.llm import content_sort, mixing, outliers, packing, simhash
from starbuild.llm.common import stage
from starbuild.llm.queries import tokenizer_path


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return outliers.reject_outliers(docs)


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return content_sort.distinct_texts(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.keep_one(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mixed(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs, tokenizer_path())


STAGES = [
    ("quality rules", quality_rules),
    ("exact dedup", exact_dedup),
    ("simhash near-dedup", near_dedup),
    ("mixing", mix_sources),
    ("packing", pack_sequences),
]

#: Fingerprints and tokens are beyond SQL; the tests hold every stage against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, function in STAGES[:-1]:
        docs = stage(function(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
