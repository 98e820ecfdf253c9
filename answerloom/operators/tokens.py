"""Content words, vocabulary and bags of words."""

from __future__ import annotations

import pyarrow as pa
from pyspark.ml.feature import CountVectorizer, RegexTokenizer, StopWordsRemover
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import fixed_values as fixed
from ..functions import text as tx


def content_words(
    passages: DataFrame, text: str = "passage", stop_words: list[str] | None = None
) -> DataFrame:
    """Add ``tokens``: alphabetic words of three letters or more that are no stop words.

    Words are taken from the corpus key of the text. The default stop words are Spark's
    English list.
    """
    keyed = passages.withColumn("_key", tx.corpus_key(F.col(text)))
    # A word with a digit in it is no word, so its letters must not match either.
    tokenizer = RegexTokenizer(
        inputCol="_key",
        outputCol="_words",
        gaps=False,
        pattern="(?<![a-z0-9])[a-z]{3,}(?![a-z0-9])",
    )
    remover = StopWordsRemover(inputCol="_words", outputCol="tokens")
    if stop_words is not None:
        remover = remover.setStopWords(stop_words)
    return remover.transform(tokenizer.transform(keyed)).drop("_key", "_words")


def vocabulary(
    documents: DataFrame,
    tokens: str = "tokens",
    min_docs: int = fixed.MIN_DOCS,
    max_share: float = fixed.MAX_DOC_SHARE,
    keep: int | None = None,
) -> DataFrame:
    """Words in at least ``min_docs`` documents and at most ``max_share`` of them.

    With ``keep``, only the ``keep`` of them that most documents hold.
    """
    # The outer form keeps the optimizer from adding an emptiness filter, for which the
    # whole tokenization would be computed a second time.
    found = documents.select(F.explode_outer(F.array_distinct(tokens)).alias("token"))
    counts = found.filter(F.col("token").isNotNull()).groupBy("token").agg(
        F.count(F.lit(1)).alias("docs")
    )
    most = documents.agg(F.floor(F.count(F.lit(1)) * max_share).alias("most")).scalar()
    kept = counts.filter((F.col("docs") >= min_docs) & (F.col("docs") <= most))
    return kept if keep is None else kept.orderBy(F.desc("docs"), F.asc("token")).limit(keep)


def count_vectors(
    documents: DataFrame, words: DataFrame, tokens: str = "tokens", output: str = "features"
) -> tuple[DataFrame, list[str]]:
    """Add sparse counts of the vocabulary words; also returns the word of each position.

    For models over count vectors, whose words the driver holds: give the vocabulary a
    ``keep`` where its size is not known. Counting is row by row. The counter is fitted on the vocabulary, one word per row, so
    that it knows exactly these words without their passing through Python.
    """
    counter = CountVectorizer(inputCol=tokens, outputCol=output, minDF=1.0, vocabSize=1 << 30)
    model = counter.fit(words.select(F.array("token").alias(tokens)))
    return model.transform(documents), model.vocabulary


def bag_of_words(
    documents: DataFrame, words: DataFrame, key: str = "id", tokens: str = "tokens"
) -> DataFrame:
    """Count of each vocabulary word per document, as rows ``(key, token, n)``.

    A document's words are counted in its own task before the shuffle. The vocabulary may
    have any size: it is joined by word, and a word is one row a document there.
    """
    counted = count_words(documents, key, tokens)
    return counted.join(words.select("token"), "token", "left_semi").select(key, "token", "n")


def count_words(documents: DataFrame, key: str = "id", tokens: str = "tokens") -> DataFrame:
    """Count of each word per document, in the vocabulary or not, as rows ``(key, token, n)``."""
    spread_out = documents.select(key, F.explode_outer(tokens).alias("token"))
    return spread_out.groupBy(key, "token").agg(F.count(F.lit(1)).alias("n"))


def word_table(spark: SparkSession, names: list[str]) -> DataFrame:
    """The words of a bounded vocabulary by ``position``."""
    positions = pa.array(range(len(names)), pa.int32())
    return spark.createDataFrame(
        pa.table({"position": positions, "token": pa.array(names, pa.string())})
    )
