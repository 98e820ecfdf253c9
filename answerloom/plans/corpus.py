"""Corpus preparation and profile."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import fixed_values as fixed
from ..functions import text as tx
from ..operators import corpus, lda, profile, tokens
from ..shared import write_through
from ..sources import tables


def prepare_corpus(passages: DataFrame) -> DataFrame:
    """From raw rows to the corpus ``(id, passage)``: complete, without copies, not too short.

    A row with a missing value in any column is incomplete.
    """
    complete = corpus.drop_missing(passages).select("id", "passage")
    return corpus.drop_short(corpus.drop_all_copies(complete)).select("id", "passage")


def prepare_corpus_file(spark: SparkSession, source: str, target: str, layout: str = "parquet") -> None:
    """From a stored table of passages (``layout`` parquet or csv) to a CSV corpus."""
    if layout == "csv":
        passages = tables.read_csv(spark, source, ["id", "passage"], {"id": "long"})
    else:
        passages = tables.load_parquet(spark, source)
    tables.write_csv(prepare_corpus(passages), target)


def measure_corpus(passages: DataFrame, text: str = "passage") -> DataFrame:
    """Length and quality columns of each text, stored: the texts are measured once."""
    return write_through(corpus.quality_ratios(passages, text).select(*fixed.PROFILE_COLUMNS), "measures")


def profile_corpus(passages: DataFrame, text: str = "passage") -> DataFrame:
    """Summary of the length and quality columns of a text column, raw or normalised."""
    return profile.describe(measure_corpus(passages, text), fixed.PROFILE_COLUMNS)


def topic_report(
    passages: DataFrame,
    stop_words: list[str] | None = None,
    topics: int = fixed.TOPICS,
    passes: int = fixed.TOPIC_PASSES,
    seed: int = fixed.TOPIC_SEED,
) -> tuple[DataFrame, DataFrame]:
    """Topic words ``(topic, rank, token, weight)``, and the dominant topic of each passage
    ``(id, topic, share)``.

    Batch variational Bayes over word counts; the words stay in tables, see ``operators.lda``.
    """
    documents = tokens.content_words(passages, stop_words=stop_words).select("id", "tokens")
    documents = write_through(documents, "tokens")
    words = lda.number_words(tokens.vocabulary(documents))
    counts = lda.word_counts(tokens.count_words(documents, "id"), words, "id")
    model = lda.fit(counts, words, lda.Settings(topics=topics, passes=passes, seed=seed))
    described = lda.topic_words(model.table, words, topics, fixed.TOPIC_WORDS)
    leads = lda.leading_topics(model.gammas(), documents, "id", fixed.MIN_TOPIC_SHARE)
    return described, leads


def length_histograms(passages: DataFrame, bins: int = 10) -> DataFrame:
    """Histograms of the raw length, the normalised length and the token count, by ``column``."""
    text = F.col("passage")
    sizes = passages.select(
        tx.char_len(text).alias("char_len"),
        tx.char_len(tx.normalize_text(text)).alias("norm_len"),
        tx.token_count(text).alias("token_count"),
    )
    sizes = write_through(sizes, "sizes")
    parts = [
        profile.histogram(sizes, c, bins).select(F.lit(c).alias("column"), "*") for c in sizes.columns
    ]
    return parts[0].unionAll(parts[1]).unionAll(parts[2])
