"""Only the sets that are in pairs move, whatever the tasks they come from."""

import pytest
from pyspark.sql import functions as F

from answerloom.llm import jaccard_join


@pytest.mark.parametrize("tasks, rows", [(4, 30_000), (150, 2_000)])
def test_few_other_sets_are_marked(spark, tasks, rows):
    place = F.col("id") % rows + F.shiftleft((F.col("id") / rows).cast("long"), 40)
    sets = spark.range(tasks * rows).select(place.alias("row"), F.lit(b"x").alias("grams"))
    own = sets.filter("row < shiftleft(1L, 40)")
    pairs = own.filter("row % 2 = 0").select(F.col("row").alias("a"), (F.col("row") + 1).alias("b"))
    held = jaccard_join._held_sets(sets, jaccard_join._marks(pairs))
    assert held.count() == rows
    assert held.join(own, "row", "left_anti").count() == 0


def test_a_row_with_a_mark_is_held(spark):
    rows = [0, 7, (3 << 40) + 5, (900 << 40) + 12_345_678, (70_000 << 40) + 1]
    sets = spark.createDataFrame([(r, b"x") for r in [*rows, 99]], "row long, grams binary")
    pairs = spark.createDataFrame([(rows[0], r) for r in rows[1:]], "a long, b long")
    held = jaccard_join._held_sets(sets, jaccard_join._marks(pairs))
    assert sorted(r.row for r in held.collect()) == sorted(rows)
