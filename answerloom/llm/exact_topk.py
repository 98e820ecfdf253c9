"""Exact top-k search by inner product with a three-phase uniform threshold.

The components are cut into a few ranges. A task with a block of vectors has, for each query
and range, a list of local scores, and a total score is the sum over the ranges.

Phase 1 takes the best k of every list, scores those vectors in full, and gathers the k best
full scores of each query over all tasks; the least of them is a safe cutoff. A vector whose
total reaches the cutoff reaches the cutoff divided by the number of ranges in one range at
least. Phase 2 hands the cutoffs to the tasks, and each list gives every entry at or above
that uniform threshold. Phase 3 scores these entries in full, which settles the rest: those at
or above the cutoff, k a query and task at most, are ranked.

Queries and vectors meet in blocks: each block of vectors meets each block of queries once. A
block of queries and its cutoffs have a fixed number of rows, whatever the data.

Components x become floor(scale * x), as 64-bit whole numbers; scores are exact. Ties go to
the smaller id. Defined cases: vectors that are null, or hold a null, a NaN or an infinity,
take no part; a shorter vector counts as padded with zeros. Ids that repeat are vectors each,
and a query meets no vector with its own id; repeated queries give one set of rows. Rows with
a null id take no part. Fewer than k candidates give fewer rows; empty tables none. Other
columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..shared import write_through

SCALE = 256
RANGES = 2  # ranges of components that have lists of their own
QUERY_BLOCK = 65_536  # rows of a block
VECTOR_BLOCK = 65_536
QUERIES_AT_ONCE = 128  # of a block, so that their scores with a block of vectors fit into memory
WHOLE = 1 << 52  # sums of products below this are exact in floating point
FOUND = "query_id long, vec_id long, score long"


def usable(vectors: DataFrame, id_column: str, vector: str) -> DataFrame:
    """(id, values) of the vectors that take part, as double."""
    rows = vectors.select(F.col(id_column).cast("long").alias("id"), F.col(vector).cast("array<double>").alias("values"))
    finite = F.forall("values", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    return rows.filter(F.col("id").isNotNull() & F.col("values").isNotNull() & finite)


def quantised(values: pd.Series, width: int, scale: float) -> np.ndarray:
    """Matrix of floor(scale * x), shorter rows padded with zeros."""
    told = np.zeros((len(values), width))
    for i, v in enumerate(values):
        told[i, : len(v)] = v
    return np.floor(scale * told)


def _products(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Exact inner products as 64-bit whole numbers, or Python's where those do not hold them."""
    top = float(np.abs(q).max(initial=0)) * float(np.abs(x).max(initial=0)) * max(1, q.shape[1])
    if top < WHOLE:
        return q @ x.T
    told = np.array([[sum(int(a) * int(b) for a, b in zip(r, c)) for c in x] for r in q], object)
    if told.size and max(abs(told.min()), abs(told.max())) >= 1 << 63:
        raise OverflowError("a score does not fit into 64 bits")
    return told


def _best(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Places of the k best entries, ties to the smaller id."""
    if len(scores) > k:
        edge = np.partition(scores, len(scores) - k)[len(scores) - k]
        at = np.flatnonzero(scores >= edge)
    else:
        at = np.arange(len(scores))
    order = np.lexsort((ids[at], -scores[at]))
    return at[order[:k]]


def _cuts(width: int, ranges: int) -> list[tuple[int, int]]:
    edges = np.linspace(0, width, min(ranges, max(1, width)) + 1).astype(int)
    return list(zip(edges, edges[1:]))


def _meet(queries: pd.DataFrame, vectors: pd.DataFrame, k: int, scale: float, ranges: int) -> Iterator[tuple]:
    """For some queries at a time: their rows, the ids and others than their own, the lists, the totals."""
    vectors = vectors.sort_values("id", kind="stable")
    width = max([len(v) for v in queries["values"]] + [len(v) for v in vectors["values"]], default=0)
    x, ids = quantised(vectors["values"], width, scale), vectors["id"].to_numpy()
    for s in range(0, len(queries), QUERIES_AT_ONCE):
        some = queries.iloc[s : s + QUERIES_AT_ONCE]
        q = quantised(some["values"], width, scale)
        lists = [_products(q[:, a:b], x[:, a:b]) for a, b in _cuts(width, ranges)]
        yield some, ids, lists, sum(lists[1:], lists[0])


def _told(rows: list[tuple[np.ndarray, ...]]) -> pd.DataFrame:
    columns = [np.concatenate(c) for c in zip(*rows)] if rows else [[], [], []]
    return pd.DataFrame({n: np.asarray(c).astype("int64") for n, c in zip(("query_id", "vec_id", "score"), columns)})


def _local_lists(queries: pd.DataFrame, vectors: pd.DataFrame, k: int, scale: float, ranges: int) -> pd.DataFrame:
    """Phase 1: full scores of the k best entries of each list; the k best of these a query."""
    rows = []
    for some, ids, lists, total in _meet(queries, vectors, k, scale, ranges):
        for i, query in enumerate(some["id"]):
            others = np.flatnonzero(ids != query)
            at = np.unique(np.concatenate([others[_best(part[i][others], ids[others], k)] for part in lists]))
            at = at[_best(total[i][at], ids[at], k)]
            rows.append((np.full(len(at), query), ids[at], total[i][at]))
    return _told(rows)


def _sufficient(queries: pd.DataFrame, vectors: pd.DataFrame, k: int, scale: float, ranges: int) -> pd.DataFrame:
    """Phases 2 and 3: entries of each list at or above the uniform threshold, scored in full."""
    rows = []
    for some, ids, lists, total in _meet(queries, vectors, k, scale, ranges):
        for i, (query, cutoff) in enumerate(zip(some["id"], some["cutoff"])):
            enough = ids != query
            if not pd.isna(cutoff):  # else fewer than k candidates are known, and every entry may be needed
                enough &= np.logical_or.reduce([part[i] * len(lists) >= cutoff for part in lists])
            at = np.flatnonzero(enough)
            if not pd.isna(cutoff):
                at = at[total[i][at] >= cutoff]
            at = at[_best(total[i][at], ids[at], k)]
            rows.append((np.full(len(at), query), ids[at], total[i][at]))
    return _told(rows)


def top_k(
    vectors: DataFrame, queries: DataFrame, k: int, vector: str = "embedding", id_column: str = "vec_id", scale: float = SCALE, ranges: int = RANGES
) -> DataFrame:
    """(query_id, rank, vec_id, score): the k best vectors for each of ``queries`` (same columns).

    Vectors are stored once by block. Each block of vectors is sent to each block of queries
    and the other way round; both sides of a meeting have a bounded number of rows.
    """
    spark = vectors.sparkSession
    least = int(spark.conf.get("spark.sql.shuffle.partitions"))
    asked = usable(queries, id_column, vector).groupBy("id").agg(F.min("values").alias("values"))
    asked, stored = write_through(asked, "queries"), write_through(usable(vectors, id_column, vector), "vectors")
    query_blocks = -(-asked.count() // QUERY_BLOCK) or 1
    vector_blocks = max(least, -(-stored.count() // VECTOR_BLOCK))

    def dealt(rows: DataFrame, blocks: int, name: str, others: int, other: str) -> DataFrame:
        own = F.pmod(F.xxhash64("id"), F.lit(blocks)).cast("int").alias(name)
        return rows.withColumn(name, own).withColumn(other, F.explode(F.sequence(F.lit(0), F.lit(others - 1))))

    def meeting(asking: DataFrame, function) -> DataFrame:
        def run(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
            return function(left, right, k, scale, ranges)

        left = dealt(asking, query_blocks, "qb", vector_blocks, "vb").groupBy("qb", "vb")
        right = dealt(stored, vector_blocks, "vb", query_blocks, "qb").groupBy("qb", "vb")
        return left.cogroup(right).applyInPandas(run, FOUND)

    local = meeting(asked, _local_lists).groupBy("query_id")
    cutoffs = local.agg(F.get(F.sort_array(F.collect_list("score"), asc=False), F.lit(k - 1)).alias("cutoff"))
    cut = asked.join(cutoffs, asked["id"] == cutoffs["query_id"], "left").select("id", "values", "cutoff")
    found = meeting(write_through(cut, "cutoffs"), _sufficient)
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", rank).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
