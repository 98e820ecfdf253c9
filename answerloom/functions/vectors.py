"""Column expressions over vectors, and the default text encoder."""

from __future__ import annotations

from pyspark.ml.feature import CountVectorizerModel, Normalizer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .text import words


def l2_normalize(vector: Column) -> Column:
    """Unit-length copy of an array column; a zero vector stays zero."""
    squares = F.aggregate(vector, F.lit(0.0), lambda total, x: total + x * x)
    norm = F.sqrt(squares)
    return F.transform(vector, lambda x: F.when(norm > 0, F.try_divide(x, norm)).otherwise(x))


def word_bucket(word: Column, dim: int) -> Column:
    """Bucket of a word: the first 32 bits of its MD5 modulo the dimension."""
    return F.conv(F.substring(F.md5(word), 1, 8), 16, 10).cast("long") % dim


def encode_words(df: DataFrame, text: str, output: str, dim: int) -> DataFrame:
    """Add unit-length hashed word counts of ``text``: one pass, no fit, no shuffle.

    This is the encoder used when the caller has no model of their own.
    """
    raw, counts, unit = f"_{output}_buckets", f"_{output}_counts", f"_{output}_unit"
    model = CountVectorizerModel.from_vocabulary(
        [str(i) for i in range(dim)], inputCol=raw, outputCol=counts
    )
    bucketed = df.withColumn(
        raw, F.transform(words(F.coalesce(F.col(text), F.lit(""))), lambda w: word_bucket(w, dim).cast("string"))
    )
    scaled = Normalizer(p=2.0, inputCol=counts, outputCol=unit).transform(model.transform(bucketed))
    return scaled.withColumn(output, vector_to_array(unit)).drop(raw, counts, unit)
