"""Row positions over data of any size, without pulling it into one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..shared import write_through


def number_rows(
    df: DataFrame, order_by: list[Column], output: str = "pos", within: str | None = None
) -> DataFrame:
    """Add the 0-based position of each row in ``order_by``, optionally per ``within``.

    The rows are range-partitioned and sorted once and written out; a row's position is
    its place in its partition plus the rows of earlier partitions. Only the
    per-partition counts (one row per partition and group) meet in one task.
    """
    keys = ([F.col(within)] if within else []) + list(order_by)
    group = F.col(within) if within else F.lit(0)
    placed = df.orderBy(*keys).select(
        "*",
        F.monotonically_increasing_id().alias("_place"),
        F.spark_partition_id().alias("_part"),
        group.alias("_group"),
    )
    placed = write_through(placed, "numbered")

    # Every partition holds one run of each group, so its first place is its offset.
    runs = placed.groupBy("_group", "_part").agg(
        F.count(F.lit(1)).alias("_rows"), F.min("_place").alias("_first")
    )
    earlier = Window.partitionBy("_group").orderBy("_part").rowsBetween(
        Window.unboundedPreceding, -1
    )
    offsets = runs.select(
        "_group",
        "_part",
        "_first",
        F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_before"),
    )
    matched = placed.withColumnRenamed("_group", "_g").withColumnRenamed("_part", "_p").join(
        offsets, F.col("_g").eqNullSafe(F.col("_group")) & (F.col("_p") == F.col("_part"))
    )
    position = F.col("_before") + F.col("_place") - F.col("_first")
    return matched.withColumn(output, position).select(*df.columns, output)


def file_order() -> list[Column]:
    """Order of rows as they stand in the files a frame was read from."""
    return [
        F.col("_metadata.file_path"),
        F.col("_metadata.file_block_start"),
        F.monotonically_increasing_id(),
    ]


def with_position(scan: DataFrame, output: str = "id") -> DataFrame:
    """Replace or add ``output`` as the row position of a freshly read file table."""
    path, block, row = file_order()
    ordered = scan.drop(output).select(
        "*", path.alias("_path"), block.alias("_block"), row.alias("_row")
    )
    numbered = number_rows(ordered, [F.col("_path"), F.col("_block"), F.col("_row")], output)
    return numbered.drop("_path", "_block", "_row")
