"""Parquet table of passages and their vectors: ``id, passage, embedding`` and extras."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..shared import write_through


def check_rows(
    rows: DataFrame, dim: int, max_chars: int | None = None
) -> DataFrame:
    """Add ``problem``: why a row cannot be stored, or null when it can."""
    problem = (
        F.when(F.col("id").isNull(), "no id")
        .when(F.col("passage").isNull(), "no passage")
        .when(F.length("passage") > F.lit(max_chars), "passage too long")
        .when(F.col("embedding").isNull(), "no vector")
        .when(F.size("embedding") != dim, "wrong dimension")
    )
    return rows.withColumn("problem", problem)


def write_vectors(
    rows: DataFrame,
    path: str,
    dim: int,
    drop_if_exists: bool = False,
    max_chars: int | None = None,
    rejects: str | None = None,
) -> None:
    """Append rows to the table, or replace it.

    Rows that cannot be stored are appended to the Parquet table ``rejects`` with their
    ``problem``; without one the write fails and stores nothing. Ids are taken as given:
    nothing is merged or dropped by id. Further columns are kept.
    """
    checked = write_through(check_rows(rows, dim, max_chars), "checked")  # vectors may be dear
    bad = checked.filter(F.col("problem").isNotNull())
    if rejects is not None:
        bad.write.mode("append").parquet(rejects)
    elif first := bad.first():
        raise ValueError(f"row {first['id']} cannot be stored: {first['problem']}")
    vectors = F.col("embedding").cast("array<float>")
    stored = checked.filter(F.col("problem").isNull()).drop("problem")
    mode = "overwrite" if drop_if_exists else "append"
    stored.withColumn("embedding", vectors).write.mode(mode).parquet(path)


def read_vectors(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.option("mergeSchema", "true").parquet(path)


def vector_stats(vectors: DataFrame) -> DataFrame:
    """One row: stored rows, and the smallest and largest vector dimension."""
    return vectors.agg(
        F.count(F.lit(1)).alias("row_count"),
        F.min(F.size("embedding")).alias("min_dim"),
        F.max(F.size("embedding")).alias("max_dim"),
    )


def describe_columns(vectors: DataFrame) -> list[tuple[str, str]]:
    """Column names and types of the table."""
    return [(f.name, f.dataType.simpleString()) for f in vectors.schema.fields]
