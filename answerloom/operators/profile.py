"""Column summaries, histograms and tag counts."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..shared import write_through

QUARTILES = (0.25, 0.5, 0.75)


def _melt(df: DataFrame, columns: list[str]) -> DataFrame:
    pairs = [
        F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("value"))
        for c in columns
    ]
    melted = df.select(F.explode(F.array(*pairs)).alias("pair")).select("pair.*")
    # Missing values take no part, in whichever way they are marked.
    return melted.filter(F.col("value").isNotNull() & ~F.isnan("value"))


def describe(df: DataFrame, columns: list[str], quantiles=QUARTILES) -> DataFrame:
    """Count, mean, std, min, exact interpolated quantiles and max of each column.

    Different values with their row counts are range-partitioned and stored; the rows of
    earlier partitions give each its first rank, and the values at the ranks looked for
    are picked. No partition holds a whole column, whatever its size.
    """
    columns = list(columns)
    values = _melt(df, columns)
    counted = values.groupBy("column", "value").agg(F.count(F.lit(1)).alias("rows"))
    ranged = counted.repartitionByRange("column", "value").withColumn("part", F.spark_partition_id())
    ranged = write_through(ranged, "values")
    runs = ranged.groupBy("column", "part").agg(F.sum("rows").alias("rows"))
    earlier = Window.partitionBy("column").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    before = runs.select("column", "part", F.coalesce(F.sum("rows").over(earlier), F.lit(0)).alias("before"))
    summary = values.groupBy("column").agg(
        F.count("value").alias("n"),
        F.avg("value").alias("mean"),
        F.stddev_samp("value").alias("std"),
        F.min("value").alias("min"),
        F.max("value").alias("max"),
    )
    wanted = F.array(*[F.struct(F.lit(i).alias("i"), F.lit(float(q)).alias("q")) for i, q in enumerate(quantiles)])
    # A row for each column and quantile; both are parameters.
    targets = summary.select("column", "n", F.explode(wanted).alias("w")).select(
        "column", "w.i", (F.col("w.q") * (F.col("n") - 1)).alias("at")
    )
    within = Window.partitionBy("column", "part").orderBy("value").rowsBetween(Window.unboundedPreceding, -1)
    placed = ranged.withColumn("within", F.coalesce(F.sum("rows").over(within), F.lit(0)))
    first = F.col("before") + F.col("within")
    ranks = placed.join(before, ["column", "part"]).select(
        "column", "value", first.alias("first"), (first + F.col("rows")).alias("end")
    )
    left, right = F.floor("at"), F.ceil("at")
    holds = lambda rank: (F.col("first") <= rank) & (rank < F.col("end"))
    reached = ranks.join(F.broadcast(targets), "column").filter(holds(left) | holds(right))
    reached = reached.groupBy("column", "i").agg(
        F.max(F.when(holds(left), F.col("value"))).alias("left"),
        F.max(F.when(holds(right), F.col("value"))).alias("right"),
        F.max(F.col("at") - left).alias("part"),
    )
    value = F.col("left") + (F.col("right") - F.col("left")) * F.col("part")
    names = [_quantile_name(q) for q in quantiles]
    table = reached.groupBy("column").agg(
        *[F.max(F.when(F.col("i") == i, value)).alias(name) for i, name in enumerate(names)]
    )
    return summary.join(F.broadcast(table), "column").select(
        "column", "n", "mean", "std", "min", *names, "max"
    )


def _quantile_name(q: float) -> str:
    return f"p{q * 100:g}".replace(".", "_")


def histogram(df: DataFrame, column: str, bins: int = 10) -> DataFrame:
    """Counts in equal-width bins from the smallest to the largest value.

    Every bin is listed, also empty ones; the last one includes its upper edge. A
    constant column is given the unit range around its value.
    """
    values = df.select(F.col(column).cast("double").alias("value")).filter(
        F.col("value").isNotNull() & ~F.isnan("value")
    )
    # One pass over the input; edges and bins are taken from its distinct values.
    counted = values.groupBy("value").agg(F.count(F.lit(1)).alias("rows"))
    counted = write_through(counted, "values")
    edges = counted.agg(F.min("value").alias("lo"), F.max("value").alias("hi"))
    flat = F.col("lo") == F.col("hi")
    edges = edges.select(
        F.when(flat, F.col("lo") - 0.5).otherwise(F.col("lo")).alias("lo"),
        F.when(flat, F.col("hi") + 0.5).otherwise(F.col("hi")).alias("hi"),
    )
    lo, hi = edges.select("lo").scalar(), edges.select("hi").scalar()
    slot = F.floor(F.try_divide((F.col("value") - lo) * bins, hi - lo)).cast("int")
    counts = counted.groupBy(F.least(slot, F.lit(bins - 1)).alias("bin")).agg(
        F.sum("rows").alias("n")
    )
    ladder = edges.select(
        F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bin"),
        ((F.col("hi") - F.col("lo")) / bins).alias("step"),
        "lo",
    ).filter(F.col("lo").isNotNull())
    return ladder.join(F.broadcast(counts), "bin", "left").select(
        "bin",
        (F.col("lo") + F.col("bin") * F.col("step")).alias("bin_from"),
        (F.col("lo") + (F.col("bin") + 1) * F.col("step")).alias("bin_to"),
        F.coalesce("n", F.lit(0)).alias("n"),
    )


def count_tags(df: DataFrame, tags: str) -> DataFrame:
    """Corpus totals of a map column of counts per tag, largest first."""
    # Outer, so that the map is not computed once more for an emptiness filter.
    exploded = df.select(F.explode_outer(tags).alias("tag", "times"))
    exploded = exploded.filter(F.col("tag").isNotNull())
    totals = exploded.groupBy("tag").agg(F.sum("times").alias("n"))
    return totals.orderBy(F.desc("n"), F.asc("tag"))


def count_labels(df: DataFrame, entities: str) -> DataFrame:
    """Corpus totals per label of an array of (text, label), largest first."""
    exploded = df.select(F.explode_outer(entities).alias("entity"))
    exploded = exploded.filter(F.col("entity").isNotNull())
    totals = exploded.groupBy(F.col("entity.label").alias("label")).agg(
        F.count(F.lit(1)).alias("n")
    )
    return totals.orderBy(F.desc("n"), F.asc("label"))
