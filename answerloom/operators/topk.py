"""Arrow-batch scoring of query vectors against passage vectors, used inside tasks.

Scores are put on a grid of 1e-9 before they are compared, so that ties are ties
whatever the batch sizes and the order of summation, and then broken by id.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import pyarrow.compute

GRID = 1e9
SCORE_CELLS = 4_000_000  # scores held at once: 32 MB of doubles
SLICE = 2048  # passages scored at once
SINGLE_SQUARE = 1e30  # squared lengths up to which products stay within single precision
CROWDED = 20  # of so many scores at most one may reach the bar to be scored by pairs


def dense(column) -> np.ndarray:
    """Matrix of a list column; all lists must have the same length."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if not len(column):
        return np.zeros((0, 0))
    lengths = np.unique(pa.compute.list_value_length(column).to_numpy(zero_copy_only=False))
    if len(lengths) > 1:
        raise ValueError(f"vectors of different lengths: {lengths[0]:g} and {lengths[-1]:g}")
    return np.asarray(column.flatten(), dtype="float64").reshape(len(column), -1)


def closeness(queries: np.ndarray, passages: np.ndarray, metric: str) -> np.ndarray:
    """Score matrix on the grid, larger is closer (L2: negative squared distance)."""
    scores = queries @ passages.T
    if metric == "L2":
        scores *= 2.0
        scores -= np.einsum("ij,ij->i", queries, queries)[:, None]
        scores -= np.einsum("ij,ij->i", passages, passages)[None, :]
        np.minimum(scores, 0.0, out=scores)
    scores *= GRID
    return np.rint(scores, out=scores)


def published(scores: np.ndarray, metric: str) -> np.ndarray:
    """Scores as users see them: inner product, or Euclidean distance."""
    return np.sqrt(-scores / GRID) if metric == "L2" else scores / GRID


def best_per_row(scores: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions of the k best of each row; equal scores go to the leftmost columns."""
    n = scores.shape[1]
    if n <= k:
        rows, columns = np.indices(scores.shape)
        return rows.ravel(), columns.ravel()
    kth = np.partition(scores, n - k, axis=1)[:, n - k, None]
    above, level = scores > kth, scores == kth
    room = k - above.sum(axis=1, keepdims=True)
    crowded = level.sum(axis=1, keepdims=True) > room
    if crowded.any():
        level &= ~crowded | (np.cumsum(level, axis=1) <= room)
    return np.nonzero(above | level)


def best_hits(rows: np.ndarray, ids: pa.Array, scores: np.ndarray, k: int) -> tuple[np.ndarray, pa.Array, np.ndarray]:
    """The k best hits of each row, by score on the grid and then by id."""
    by_id = pa.compute.sort_indices(ids).to_numpy()
    order = by_id[np.lexsort((-scores[by_id], rows[by_id]))]
    rows = rows[order]
    kept = np.arange(len(rows)) - np.searchsorted(rows, rows, side="left") < k
    order = order[kept]
    return rows[kept], ids.take(pa.array(order)), scores[order]


class Shortlist:
    """Running k best passages per query over any number of passage batches.

    Once a query has k passages, its k-th score is a bar. Scores are then taken in single
    precision, lowered bars (by more than the rounding can amount to) leave few pairs, and
    only these are scored in double precision. Slices where many pairs are left, or whose
    numbers single precision does not hold, are scored in double precision at once.
    """

    def __init__(self, queries: np.ndarray, k: int, metric: str):
        self.queries, self.k, self.metric = queries, k, metric
        self.rows = np.zeros(0, dtype="int64")
        self.scores = np.zeros(0)
        self.ids: np.ndarray | None = None
        self.bars = np.full(len(queries), -np.inf)  # k-th score on the grid, -inf before there are k
        self.squares = np.einsum("ij,ij->i", queries, queries)
        self.quick = bool(len(queries)) and bool((self.squares < SINGLE_SQUARE).all())
        self.singles = queries.astype("float32") if self.quick else None

    def add(self, ids: pa.Array, vectors: np.ndarray) -> None:
        if isinstance(ids, pa.ChunkedArray):
            ids = ids.combine_chunks()
        order = pa.compute.sort_indices(ids).to_numpy()
        ids, vectors = ids.to_numpy(zero_copy_only=False)[order], vectors[order]
        for start in range(0, len(ids), SLICE):
            self._add_slice(ids[start : start + SLICE], vectors[start : start + SLICE])

    def _add_slice(self, ids: np.ndarray, vectors: np.ndarray) -> None:
        step = max(1, SCORE_CELLS // len(ids))
        squares = np.einsum("ij,ij->i", vectors, vectors)
        quick = self.quick and bool((squares < SINGLE_SQUARE).all())
        singles = vectors.astype("float32") if quick else None
        rows, scores, found = [], [], []
        for start in range(0, len(self.queries), step):
            part = slice(start, start + step)
            pairs = self._above_bars(part, singles, squares) if quick else None
            if pairs is None:
                block = closeness(self.queries[part], vectors, self.metric)
                r, c = best_per_row(block, self.k)
                value = block[r, c]
            else:
                r, c = pairs
                value = self._pair_scores(r + start, vectors, c, squares)
            keep = value >= self.bars[r + start]
            rows.append((r + start)[keep])
            scores.append(value[keep])
            found.append(ids[c[keep]])
        self._merge(np.concatenate(rows), np.concatenate(scores), np.concatenate(found))

    def _above_bars(self, part: slice, singles: np.ndarray, squares: np.ndarray) -> tuple[np.ndarray, np.ndarray] | None:
        """Pairs whose score may reach the query's bar; None when they are too many to pick out."""
        bars, own = self.bars[part], self.squares[part]
        if not np.isfinite(bars).all():
            return None
        longest = math.sqrt(squares.max(initial=0.0))
        # Rounding of the products and sums is at most this share of the two lengths' product.
        share = (singles.shape[1] + 16) * 2.0**-23
        slack = share * np.sqrt(own) * longest + 2.0 / GRID
        level = bars / GRID
        products = self.singles[part] @ singles.T
        if self.metric == "L2":
            slack += 2.0**-22 * (own + longest * longest)
            products -= (squares / 2).astype("float32")[None, :]
            level = (level + own) / 2
        lowered = np.nextafter((level - slack).astype("float32"), np.float32(-np.inf))
        at = np.flatnonzero(products >= lowered[:, None])
        if len(at) > products.size // CROWDED:
            return None
        return np.divmod(at, products.shape[1])

    def _pair_scores(self, rows: np.ndarray, vectors: np.ndarray, columns: np.ndarray, squares: np.ndarray) -> np.ndarray:
        """Scores of single pairs, on the grid."""
        scores = np.empty(len(rows))
        step = max(1, SCORE_CELLS // max(1, vectors.shape[1]))
        for start in range(0, len(rows), step):
            r, c = rows[start : start + step], columns[start : start + step]
            some = np.einsum("ij,ij->i", self.queries[r], vectors[c])
            if self.metric == "L2":
                some = np.minimum(2.0 * some - self.squares[r] - squares[c], 0.0)
            scores[start : start + step] = np.rint(some * GRID)
        return scores

    def _merge(self, rows: np.ndarray, scores: np.ndarray, ids: np.ndarray) -> None:
        """Take up new pairs; only queries that have some are sorted again."""
        if self.ids is None:
            self._keep(rows, scores, ids)
        elif len(rows):
            touched = np.zeros(len(self.queries), dtype=bool)
            touched[rows] = True
            old = touched[self.rows]
            rest = (self.rows[~old], self.scores[~old], self.ids[~old])
            self._keep(*(np.concatenate(pair) for pair in zip((self.rows[old], self.scores[old], self.ids[old]), (rows, scores, ids))))
            changed = (self.rows, self.scores, self.ids)
            self.rows, self.scores, self.ids = (np.concatenate(pair) for pair in zip(rest, changed))

    def _keep(self, rows: np.ndarray, scores: np.ndarray, ids: np.ndarray) -> None:
        by_id = np.argsort(ids, kind="stable")
        rows, scores, ids = rows[by_id], scores[by_id], ids[by_id]
        order = np.lexsort((-scores, rows))
        rows, scores, ids = rows[order], scores[order], ids[order]
        first = np.searchsorted(rows, rows, side="left")
        keep = np.arange(len(rows)) - first < self.k
        self.rows, self.scores, self.ids = rows[keep], scores[keep], ids[keep]
        full = (np.arange(len(rows)) - first)[keep] == self.k - 1
        self.bars[self.rows[full]] = self.scores[full]

    def table(self, query_ids: pa.Array, schema: pa.Schema) -> pa.RecordBatch:
        if self.ids is None:
            return pa.RecordBatch.from_arrays([pa.array([], f.type) for f in schema], schema=schema)
        columns = [
            query_ids.take(pa.array(self.rows)),
            pa.array(self.ids, schema.field(1).type),
            pa.array(published(self.scores, self.metric), pa.float64()),
        ]
        return pa.RecordBatch.from_arrays(columns, schema=schema)
