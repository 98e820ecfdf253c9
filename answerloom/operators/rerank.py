"""Second-stage ranking, confidence and abstention.

Frames: pairs ``(qid, rank, pid, passage)`` with the question's columns, candidates
``(qid, rank, pid, rerank_score)``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import fixed_values as fixed
from ..functions import text as tx


def with_passages(hits: DataFrame, passages: DataFrame) -> DataFrame:
    """Attach the passage columns to hits by id.

    Passage ids are unique, so only the hit side can be skewed (one passage found by
    many questions); adaptive execution splits such partitions of it.
    """
    return hits.join(passages, "pid")


def found_passages(hits: DataFrame, passages: DataFrame) -> DataFrame:
    """The passages that occur among the hits, each once."""
    return passages.join(hits.select("pid").distinct(), "pid", "left_semi")


def add_words(passages: DataFrame) -> DataFrame:
    """Add the distinct words that :func:`score_overlap` compares."""
    return passages.withColumn("passage_words", F.array_distinct(tx.words(F.col("passage"))))


def add_question_words(questions: DataFrame) -> DataFrame:
    """Replace ``question`` by its distinct words, which :func:`score_overlap` compares."""
    words = F.array_distinct(tx.words(F.col("question")))
    return questions.withColumn("question_words", words).drop("question")


def score_overlap(pairs: DataFrame) -> DataFrame:
    """Default pair scorer: the share of question words found in the passage.

    Needs ``question_words`` and ``passage_words``, so that each text is split once, not once
    per pair.
    """
    score = tx.overlap_score(F.col("question_words"), F.col("passage_words"))
    return pairs.withColumn("rerank_score", score).drop("question_words", "passage_words")


def rerank(candidates: DataFrame, k: int = fixed.RERANK_TOP_K) -> DataFrame:
    """Keep the k best by ``rerank_score``; equal scores keep their earlier order.

    Adds ``rerank_rank``, and the ``conf`` (best score) and ``margin`` (its lead over the
    runner-up) of the whole candidate list, all from one sort per question.
    """
    by_score = Window.partitionBy("qid").orderBy(F.desc("rerank_score"), F.asc("rank"))
    ranked = candidates.withColumns(
        {
            "rerank_rank": F.row_number().over(by_score),
            "_next": F.lead("rerank_score").over(by_score),
        }
    )
    kept = ranked.filter(F.col("rerank_rank") <= k)
    best = F.col("rerank_rank") == 1
    lead = F.col("rerank_score") - F.coalesce("_next", F.lit(fixed.NO_RUNNER_UP))
    return kept.withColumns(
        {
            "conf": F.when(best, F.col("rerank_score")),
            "margin": F.when(best, lead),
        }
    ).drop("_next")


def confidence(questions: DataFrame, reranked: DataFrame) -> DataFrame:
    """``conf`` and ``margin`` of every question; 0 for those without candidates."""
    found = reranked.filter(F.col("rerank_rank") == 1).select("qid", "conf", "margin")
    joined = questions.join(found, "qid", "left")
    return joined.withColumns(
        {
            "conf": F.coalesce("conf", F.lit(0.0)),
            "margin": F.coalesce("margin", F.lit(0.0)),
        }
    )


def low_confidence(
    conf: Column, margin: Column,
    min_conf: float = fixed.MIN_CONF, min_margin: float = fixed.MIN_MARGIN,
) -> Column:
    return (conf < min_conf) | (margin < min_margin)


def collect_contexts(hits: DataFrame, rank: str = "rank", *extra: Column) -> DataFrame:
    """One row per question with its hits in rank order as ``contexts``.

    Each list holds the k hits kept before, so its size is bounded.
    """
    fields = [F.col(rank).alias("rank"), F.col("pid").alias("pid")]
    if "passage" in hits.columns:
        fields.append(F.col("passage").alias("passage"))
    lists = F.array_sort(F.collect_list(F.struct(*fields)))
    return hits.groupBy("qid").agg(lists.alias("contexts"), *extra)
