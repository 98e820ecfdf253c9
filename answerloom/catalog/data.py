"""The given tables in the shapes the engine works on."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.rerank import collect_contexts
from ..operators.search import search
from ..plans.qa import find_hits, word_encoder
from ..shared import spread  # the given tables are single files with one row group


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def passages(spark: SparkSession, sf_dir: str, key: str = "pid") -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    return spread(documents.select(F.col("doc_id").alias(key), F.col("text").alias("passage")))


def records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """User turns with the assistant turn after each as gold, and the one after that as
    prediction. The joins are on single turns, so a long conversation skews nothing."""
    turns = table(spark, sf_dir, "conversations")

    def side(role, back, name):
        qid = F.concat_ws("-", "conv_id", F.col("turn") - back).alias("qid")
        return turns.filter(F.col("role") == role).select(qid, F.col("text").alias(name))

    return (
        side("user", 0, "question")
        .join(side("assistant", 1, "gold"), "qid", "left")
        .join(side("assistant", 3, "prediction"), "qid", "left")
    )


def questions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return records(spark, sf_dir).select("qid", "question", F.col("gold").alias("answer"))


def vectors(spark: SparkSession, sf_dir: str, key: str) -> DataFrame:
    embeddings = table(spark, sf_dir, "embeddings")
    return spread(embeddings.select(F.col("vec_id").alias(key), "embedding"))


def found(spark: SparkSession, sf_dir: str, k: int) -> DataFrame:
    """The k closest passages of each question."""
    asked, texts = questions(spark, sf_dir), passages(spark, sf_dir)
    return find_hits(texts, asked, k, word_encoder(), search)


def records_with_contexts(spark: SparkSession, sf_dir: str, k: int = 5) -> DataFrame:
    """Records with the ids of the k passages found for their question."""
    contexts = collect_contexts(found(spark, sf_dir, k))
    ids = contexts.select("qid", F.transform("contexts", lambda c: c["pid"]).alias("context_ids"))
    return records(spark, sf_dir).join(ids, "qid", "left")


def six(column: Column) -> Column:
    """Rounded half up to six places, in steps other engines repeat exactly."""
    return F.floor(column * 1000000.0 + 0.5) / 1000000.0


def listed(column: Column) -> Column:
    """An array as text, for comparison."""
    return F.array_join(column, "|")
