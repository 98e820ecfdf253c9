"""Mixing sources to target weights by a time-varying curriculum.

Every source gets a weight, and the words of all documents are shared out by weight: a
source's target is its share of all words, at most ``cap`` times its own words; what a capped
source cannot take goes to the others by weight until no target is above its cap.

Each source also has a schedule: its weight over training time from 0 to 1, a piecewise linear
curve. Integrated, the schedule says what part of the source's target is due by each time.
The source's documents, in a fixed order by the digest of their id, make a stream that is
read again from the start while the target is not met (a document is so taken at most
``cap`` times, the last time maybe in part). Each document's first word in the stream has a
cumulative demand; inverting the integrated schedule at that demand gives its training
position, and the documents are range-sorted by position.

All of it is DataFrame work. Cumulative words are summed in blocks of about ``block_rows``
documents of one source, by a digest range that the source's size fixes, and the blocks'
sums are added in a second, small step; so a source of a third of all rows spreads over many
tasks. Copies of one row (same source, id and size) are counted where they stand and numbered
in their input partitions, so that a group of copies is no hot key either.

Defined cases: a null text has size 0; a null source is a source, ordered last; a null id is
ordered first. Repeated rows are documents each, taken one after another. An empty table,
or one without words, gives targets 0 and nothing taken. Other columns are not read. Reruns
over the same files agree.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SEPARATORS = r"[\x20\x09-\x0D]+"
WORDS = r"[^\x20\x09-\x0D]+"


@dataclass(frozen=True)
class Schedule:
    """Weight over training time as knots (time, value), times from 0 to 1 rising; values
    are scaled so that the curve's area is 1."""

    knots: tuple[tuple[float, float], ...] = ((0.0, 1.0), (1.0, 1.0))

    def segments(self) -> list[tuple[float, float, float, float]]:
        """(start time, start value, slope, share due at start) of each segment, values scaled."""
        area = sum((t1 - t0) * (v0 + v1) / 2 for (t0, v0), (t1, v1) in zip(self.knots, self.knots[1:]))
        out, due = [], 0.0
        for (t0, v0), (t1, v1) in zip(self.knots, self.knots[1:]):
            if t1 > t0:
                out.append((t0, v0 / area, (v1 - v0) / area / (t1 - t0), due))
                due += (t1 - t0) * (v0 + v1) / 2 / area
        return out


def position(due: Column, schedule: Schedule) -> Column:
    """Time at which the share ``due`` (0 to 1) of a source's target is reached."""
    result = None
    for t0, v0, slope, before in reversed(schedule.segments()):
        c = due - F.lit(before)
        # v0 x + slope x^2 / 2 = c, in the form that also holds for slope 0
        x = F.try_divide(F.lit(2.0) * c, F.lit(v0) + F.sqrt(F.greatest(F.lit(v0 * v0) + F.lit(2.0 * slope) * c, F.lit(0.0))))
        here = F.lit(t0) + F.coalesce(x, F.lit(0.0))
        result = here if result is None else F.when(due >= F.lit(before), here).otherwise(result)
    return F.least(F.greatest(result, F.lit(0.0)), F.lit(1.0))


def word_count(text: Column) -> Column:
    marked = F.regexp_replace(F.coalesce(text, F.lit("")), WORDS, "x")
    return F.length(F.regexp_replace(marked, SEPARATORS, "")).cast("long")


def source_targets(sized: DataFrame, weights: tuple[int, ...], cap: float) -> DataFrame:
    """(source, src, source_size, weight, target, schedule_of) of every source.

    One row a source: what meets in one task is the list of sources, not of documents.
    """
    stats = sized.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("rows"))
    everything = Window.partitionBy()
    by_name = Window.partitionBy().orderBy(F.col("source").asc_nulls_last())
    ranked = stats.select("*", (F.row_number().over(by_name) - 1).alias("src"))
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), (F.col("src") % len(weights) + 1).cast("int")).cast("long")
    limit = F.floor(F.lit(cap) * F.col("source_size")).cast("long")  # whole words
    ranked = ranked.select("*", weight.alias("weight"), limit.alias("limit"), F.sum("source_size").over(everything).alias("total"))
    # Sources in order of limit over weight; those before the first that its fair share does not
    # push over its limit are capped.
    by_room = Window.partitionBy().orderBy(F.col("limit") / F.col("weight"), "src")
    before = by_room.rowsBetween(Window.unboundedPreceding, -1)
    after = by_room.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    ranked = ranked.select(
        "*",
        (F.col("total") - F.coalesce(F.sum("limit").over(before), F.lit(0))).alias("left"),
        F.sum("weight").over(after).alias("rest"),
        F.row_number().over(by_room).alias("room_rank"),
    )
    fits = F.col("limit") * F.col("rest") >= F.col("left") * F.col("weight")  # exact in integers
    ranked = ranked.select("*", F.min(F.when(fits, F.col("room_rank"))).over(everything).alias("first_fit"))
    share = F.max(F.when(F.col("room_rank") == F.col("first_fit"), F.col("left") / F.col("rest"))).over(everything)
    target = F.when(F.col("room_rank") < F.col("first_fit"), F.col("limit").cast("double")).otherwise(share * F.col("weight"))
    return ranked.select("source", "src", "source_size", "rows", "weight", F.coalesce(target, F.lit(0.0)).alias("target"))


def plan_mix(documents: DataFrame, weights: tuple[int, ...] = (1, 2, 3), cap: float = 3.0,
             schedules: tuple[Schedule, ...] = (Schedule(),), block_rows: int = 200_000,
             text: str = "text", id_column: str = "doc_id", source: str = "source") -> DataFrame:
    """(doc_id, source, size, source_size, weight, target, taken, first_position, copies_taken) of every document,
    range-sorted by first position (documents not taken last).

    Sources are ordered by code point, null last, and take ``weights`` and ``schedules`` in
    turn. ``taken`` counts the words the mix takes of the document, repeats counted;
    ``first_position`` is the training time of its first word, null if nothing is taken.
    """
    sized = documents.select(
        F.col(id_column).alias("doc_id"), F.col(source).alias("source"), word_count(F.col(text)).alias("size"),
        F.spark_partition_id().alias("part"), F.monotonically_increasing_id().alias("tag"),
    )
    targets = source_targets(sized, weights, cap)
    entry = ["src", "doc_id", "size"]

    # Copies of a row counted in each input partition, then numbered across partitions.
    local = sized.join(targets.select("source", "src"), sized["source"].eqNullSafe(targets["source"])).drop(targets["source"])
    counted = local.groupBy(*entry, "part").agg(F.count(F.lit(1)).alias("cnt"))
    copies = Window.partitionBy(*entry).orderBy("part")
    counted = counted.select(
        "*",
        F.coalesce(F.sum("cnt").over(copies.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("earlier"),
        F.sum("cnt").over(Window.partitionBy(*entry)).alias("copies"),
        F.row_number().over(copies).alias("nth"),
    )

    # One row a different entry; cumulative words by blocks of the digest order.
    key = F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    entries = counted.filter("nth = 1").select(*entry, "copies", key.alias("key")).join(
        targets.select("src", "rows"), "src"
    )
    blocks = F.greatest(F.lit(1), F.ceil(F.col("rows") / F.lit(block_rows)))
    entries = entries.select(
        *entry, "copies", "key",
        F.floor(F.conv(F.substring("key", 1, 8), 16, 10).cast("double") * blocks / F.lit(2.0**32)).alias("block"),
    )
    order = [F.col("key"), F.col("doc_id").asc_nulls_first(), F.col("size")]
    in_block = Window.partitionBy("src", "block").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    entries = entries.select("*", F.coalesce(F.sum(F.col("copies") * F.col("size")).over(in_block), F.lit(0)).alias("inside"))
    sums = entries.groupBy("src", "block").agg(F.sum(F.col("copies") * F.col("size")).alias("words"))
    earlier_blocks = Window.partitionBy("src").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select("src", "block", F.coalesce(F.sum("words").over(earlier_blocks), F.lit(0)).alias("ahead"))
    entries = entries.join(sums, ["src", "block"]).select(*entry, (F.col("ahead") + F.col("inside")).alias("at"))

    told = entries.select(*[F.col(c).alias(f"e_{c}") for c in entry], "at")
    same = [F.col(c).eqNullSafe(F.col(f"e_{c}")) for c in entry]
    bases = counted.join(told, same[0] & same[1] & same[2]).select(
        *[F.col(f"e_{c}").alias(f"b_{c}") for c in entry], F.col("part").alias("b_part"),
        (F.col("at") + F.col("earlier") * F.col("size")).alias("base"),
    )
    nth = F.row_number().over(Window.partitionBy(*entry, "part").orderBy("tag")) - 1
    placed = local.select(*entry, "part", nth.alias("nth"))
    match = [F.col(c).eqNullSafe(F.col(f"b_{c}")) for c in [*entry, "part"]]
    placed = placed.join(bases, match[0] & match[1] & match[2] & match[3]).select(
        *entry, (F.col("base") + F.col("nth") * F.col("size")).alias("at")
    )

    rows = placed.join(targets, "src")
    demand = F.floor(F.col("target"))
    takes = [F.greatest(F.lit(0), F.least(F.col("size"), demand - e * F.col("source_size") - F.col("at"))) for e in range(int(cap) + 1)]
    taken = sum(takes[1:], takes[0])
    due = F.try_divide(F.col("at"), F.col("target"))
    timing = None
    for i, schedule in enumerate(schedules):
        here = position(due, schedule)
        timing = here if timing is None else F.when(F.col("src") % len(schedules) == i, here).otherwise(timing)
    first = F.when(taken > 0, timing)
    result = rows.select(
        "doc_id", "source", "size", "source_size", "weight", "target", taken.alias("taken"),
        first.alias("first_position"), "src", "at",
    )
    return result.orderBy(F.col("first_position").asc_nulls_last(), "src", F.col("doc_id").asc_nulls_first(), "at")


def mixture(plan: DataFrame, cap: float = 3.0, schedules: tuple[Schedule, ...] = (Schedule(),)) -> DataFrame:
    """The mixed stream: (position, doc_id, source, pass, words) of every taken pass over a
    document, range-sorted by position; ``words`` is less than the size only for a cut pass."""
    demand = F.floor(F.col("target"))
    passes = []
    for e in range(int(cap) + 1):
        start = F.col("at") + e * F.col("source_size")
        words = F.greatest(F.lit(0), F.least(F.col("size"), demand - start))
        timing = None
        for i, schedule in enumerate(schedules):
            here = position(F.try_divide(start, F.col("target")), schedule)
            timing = here if timing is None else F.when(F.col("src") % len(schedules) == i, here).otherwise(timing)
        passes.append(F.struct(timing.alias("position"), F.lit(e).alias("pass"), words.alias("words")))
    exploded = plan.select("doc_id", "source", "src", F.explode(F.array(*passes)).alias("p")).filter("p.words > 0")
    return exploded.select("p.position", "doc_id", "source", "p.pass", "p.words").orderBy("position", "doc_id")
