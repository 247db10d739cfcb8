"""From raw documents to packed training sequences, in five stages.

Each stage reads the whole table that its predecessor wrote. All but the last
return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickloom.llm import exact_dedup, langid, packing, secret_scan, simhash
from clickloom.llm.queries import END_ID, tokenizer_path
from clickloom.session import materialize


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the documents whose language the models recognise."""
    return langid.keep_recognised(docs, langid.fit(docs))


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each group of equal texts."""
    return exact_dedup.drop_exact_duplicates(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each group of near-equal texts."""
    return simhash.drop_near_duplicates(docs)


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replace the secrets in the texts; ``n_chars`` follows."""
    found = secret_scan.redact(docs)
    return found.withColumn("n_chars", F.length("text").cast("long"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pack what is left into sequences."""
    return packing.pack(packing.token_pieces(docs, tokenizer_path(), END_ID))


STAGES = [
    ("language_id", language_id),
    ("exact_dedup", exact),
    ("near_dedup", near),
    ("secret_scan", secrets),
    ("packing", pack),
]

# Models, fingerprints and tokens are beyond SQL; tests compare with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage over ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
