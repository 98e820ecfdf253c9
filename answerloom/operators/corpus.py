"""Corpus cleaning: missing values, copies, passages that are too short."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import fixed_values as fixed
from ..functions import text as tx


def passage_features(passages: DataFrame, text: str = "passage") -> DataFrame:
    """Add the normalised text, its length and the estimated tokens."""
    column = F.col(text)
    return passages.withColumns(
        {
            "passage_norm": tx.normalize_text(column),
            "char_len": tx.char_len(column),
            "tok_est": tx.approx_token_count(column),
        }
    )


def drop_missing(df: DataFrame) -> DataFrame:
    return df.na.drop("any")


def _copy_digest(text: str):
    """Groups copies by a fixed-width digest instead of shipping whole keys."""
    return F.sha2(tx.corpus_key(F.col(text)), 256)


def count_copies(passages: DataFrame, text: str = "passage") -> DataFrame:
    """One row: passages in all, passages that have a copy, passages that have none.

    Counting per digest combines on the map side, so a text with any number of copies
    reaches the reducer as one row per task.
    """
    groups = passages.groupBy(_copy_digest(text).alias("digest")).count()
    copies = F.sum(F.when(F.col("count") > 1, F.col("count")).otherwise(0))
    return groups.agg(
        F.coalesce(F.sum("count"), F.lit(0)).alias("passages"),
        F.coalesce(copies, F.lit(0)).alias("duplicates"),
        F.coalesce(F.sum(F.when(F.col("count") == 1, 1).otherwise(0)), F.lit(0)).alias("uniques"),
    )


def drop_all_copies(passages: DataFrame, text: str = "passage") -> DataFrame:
    """Keep only passages without a copy; of a group of copies none stays.

    Only digests are counted, combined before the shuffle. Texts are kept by an anti join
    on the digests that occur more than once, which leaves them in place if those are few.
    """
    digest = F.coalesce(_copy_digest(text), F.lit(""))
    copied = passages.groupBy(digest.alias("_copied")).count().filter("count > 1").select("_copied")
    return passages.join(copied, digest == F.col("_copied"), "left_anti")


def drop_short(passages: DataFrame, text: str = "passage") -> DataFrame:
    return passages.filter(tx.token_count(F.col(text)) >= fixed.MIN_PASSAGE_TOKENS)


def quality_ratios(passages: DataFrame, text: str = "passage") -> DataFrame:
    """Add lengths and the shares of non-ASCII, punctuation and digit characters."""
    column = F.col(text)
    return passages.withColumns(
        {
            "char_len": tx.char_len(column),
            "word_len": tx.word_len(column),
            "token_count": tx.token_count(column),
            "non_ascii_pct": tx.non_ascii_share(column),
            "punct_pct": tx.punctuation_share(column),
            "digits_pct": tx.digit_share(column),
        }
    )
