"""Topic model over bags of words, and the leading topic of each document."""

from __future__ import annotations

from pyspark.ml.clustering import LDA, LDAModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import fixed_values as fixed
from .tokens import word_table


def fit_topics(
    vectors: DataFrame,
    topics: int = fixed.TOPICS,
    seed: int = fixed.TOPIC_SEED,
    passes: int = fixed.TOPIC_PASSES,
    batch_share: float = fixed.TOPIC_BATCH_SHARE,
) -> LDAModel:
    """Online LDA with a learnt document prior.

    Each step draws ``batch_share`` of the rows; ``passes`` is how often a row is drawn on average.
    """
    steps = max(1, round(passes / batch_share))
    lda = LDA(
        k=topics,
        seed=seed,
        maxIter=steps,
        optimizer="online",
        subsamplingRate=batch_share,
        optimizeDocConcentration=True,
        featuresCol="features",
    )
    return lda.fit(vectors.select("features"))


def topic_words(
    model: LDAModel, names: list[str], words: int = fixed.TOPIC_WORDS
) -> DataFrame:
    """The heaviest words of each topic: ``(topic, rank, token, weight)``."""
    described = model.describeTopics(words)
    terms = described.select(
        "topic", F.posexplode(F.arrays_zip("termIndices", "termWeights")).alias("at", "term")
    ).select("topic", (F.col("at") + 1).alias("rank"), "term.*")
    table = word_table(described.sparkSession, names)
    return terms.join(table, F.col("termIndices") == F.col("position")).select(
        "topic", "rank", "token", F.col("termWeights").alias("weight")
    )


def leading_topic(distribution: Column, least: float = fixed.MIN_TOPIC_SHARE) -> Column:
    """Struct (topic, share) of the largest share that reaches ``least``, else (null, 0)."""
    candidates = F.transform(
        vector_to_array(distribution),
        lambda share, i: F.struct(share.alias("share"), (-i).alias("back")),
    )
    best = F.array_max(F.filter(candidates, lambda c: c["share"] >= least))
    return F.struct(
        (-best["back"]).alias("topic"), F.coalesce(best["share"], F.lit(0.0)).alias("share")
    )


def dominant_topics(model: LDAModel, vectors: DataFrame, key: str = "id") -> DataFrame:
    scored = model.transform(vectors.select(key, "features"))
    return scored.withColumn("lead", leading_topic(F.col("topicDistribution"))).select(
        key, "lead.topic", "lead.share"
    )
