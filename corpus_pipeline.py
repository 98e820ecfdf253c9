"""A corpus from documents to sequences: toxic documents go, then copies, then near copies;
personal data is masked, and what is left is tokenised and packed.

Each stage takes (spark, docs, sf_dir) and works on all that the stage before kept. All but
the last return the columns of ``docs``.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from answerloom.llm import exact_dedup, jaccard_join, packing, pii, toxicity
from answerloom.shared import fresh_path, ship_package

NEAR_WORDS, NEAR_PERCENT = 5, 80
VOCABULARY = "byte_bpe_50k.json"


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, fitted on the labels for ``docs``, does not reject."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "toxic")
    return toxicity.drop_toxic(docs, labels)


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the one with the smallest id."""
    return exact_dedup.drop_copies(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of similar texts the one with the smallest id."""
    return jaccard_join.drop_similar(docs, NEAR_WORDS, NEAR_PERCENT)


def mask_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts with personal data masked; ``n_chars`` follows the text."""
    masked = pii.mask(docs, pii.fit_field(docs))
    if "n_chars" in docs.columns:
        masked = masked.withColumn("n_chars", F.coalesce(F.length("text").cast("long"), F.col("n_chars")))
    return masked.select(*docs.columns)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents and their places in sequences."""
    return packing.pack_documents(docs, public_tokenizers.path(VOCABULARY))


STAGES = [
    ("toxicity", drop_toxic),
    ("exact_dedup", drop_copies),
    ("near_dedup", drop_near_copies),
    ("pii", mask_personal_data),
    ("packing", pack),
]

ORACLE_SQL = None  # a fitted classifier and a tokenizer are not to be had in SQL


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``, each written and read again."""
    ship_package(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = fresh_path(spark, f"stage-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
