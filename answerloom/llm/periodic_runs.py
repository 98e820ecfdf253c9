"""Periodic runs of words: stretches that repeat one block of words at least three times.

A run is a stretch of consecutive words with smallest period q (words q apart are equal), at
least three periods long, that no neighbouring word extends with period q. Runs are found by
string synchronising sets, scale by scale: at scale t (t = 1, 2, 4, ...) every window of t
words gets a hash, and a position is selected when the smallest hash among the t + 1 windows
starting from it to t words later stands at either end. Selection depends only on the 2t words
from the position on, so two places with equal context are selected alike; inside a run of
period q in [3t, 6t) some selected position lies in the first period and one q later, with
equal context. Equal-context pairs of selected positions that far apart propose a period;
each proposal is extended word by word to its maximal stretch and kept if it is a run of
smallest period. Windows that repeat a period of at most t/3 would make selection dense and
are never selected; they are exactly the windows inside runs of such small periods, which the
lower scales found already. Periods 1 and 2 are compared directly. Once no 2t words repeat
anywhere in the text, no longer context repeats either, and the scales stop.

Each document is handled in its task, with numpy; texts are whole and stay where they are.
All work of a scale is linear in the words of the text, so a text costs its length times the
number of scales.

Defined cases: a null text has no words. A null id is not planted upon. Equal rows give equal
results. An empty table gives an empty result. Other columns are not read.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from collections.abc import Iterator
from fractions import Fraction
from itertools import compress

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LEAST_LENGTH = 24  # a reported run has at least so many words, and three periods
MODULUS = 2147483647  # a prime below 2^31 for window hashes; equal hashes are only proposals
BASE = 1_000_003
INF = np.iinfo(np.int64).max
SLICE_ROWS = 64  # texts turned into Python strings at a time
RESULT = (
    "doc_id long, n_runs long, start long, length long, period long, exponent_milli long, "
    "runs_sha256 string, collapsed_sha256 string"
)


def planted(words: list[str], doc_id: int | None) -> list[str]:
    """The words with a periodic tail planted where the id's crc32 ends in 0."""
    n = len(words)
    if doc_id is None or n == 0:
        return words
    h = zlib.crc32(str(doc_id).encode())
    if h % 10:
        return words
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + [words[a + (i - a) % p] for i in range(a, n)]


def word_ids(words: list[str]) -> np.ndarray:
    if not words:
        return np.zeros(0, dtype=np.int64)
    return pd.factorize(np.array(words, dtype=object))[0].astype(np.int64)


class Hashes:
    """Hashes of every window of the words, for any window length, from prefix sums."""

    def __init__(self, ids: np.ndarray):
        n, m = len(ids), MODULUS
        value = (ids * 2654435761 + 97) % m
        power = _powers(BASE, n + 1, m)
        self.inverse = _powers(pow(BASE, m - 2, m), n + 1, m)
        self.prefix = np.concatenate([[0], np.cumsum(value * power[:n] % m)])  # below 2^63 for n < 2^32

    def windows(self, t: int) -> np.ndarray:
        """Hash of the t words from each position, for positions 0 to n - t."""
        count = len(self.prefix) - t
        return (self.prefix[t:] - self.prefix[:-t]) % MODULUS * self.inverse[:count] % MODULUS


def _powers(base: int, count: int, m: int) -> np.ndarray:
    out = np.ones(max(count, 1), dtype=np.int64)
    have = 1
    while have < count:
        step = pow(base, have, m)
        take = min(have, count - have)
        out[have : have + take] = out[:take] * step % m
        have += take
    return out


def sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each ``width`` consecutive values, in linear time (blocks of ``width``)."""
    n = len(values)
    count = n - width + 1
    if count <= 0:
        return np.zeros(0, dtype=values.dtype)
    blocks = -(-n // width)
    padded = np.full(blocks * width, INF, dtype=values.dtype)
    padded[:n] = values
    shaped = padded.reshape(blocks, width)
    ahead = np.minimum.accumulate(shaped, axis=1).ravel()  # from each block's start
    behind = np.minimum.accumulate(shaped[:, ::-1], axis=1)[:, ::-1].ravel()  # to each block's end
    return np.minimum(behind[:count], ahead[width - 1 : width - 1 + count])


def _true_stretches(flags: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    edges = np.diff(np.concatenate([[0], flags.astype(np.int8), [0]]))
    return np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)


def _prime_factors(q: int) -> list[int]:
    out, f = [], 2
    while f * f <= q:
        if q % f == 0:
            out.append(f)
            while q % f == 0:
                q //= f
        f += 1
    return out + ([q] if q > 1 else [])


def _smallest(ids: np.ndarray, start: int, end: int, q: int) -> bool:
    """Whether q is the smallest period of the words from start to end (three periods or more)."""
    for f in _prime_factors(q):
        p = q // f
        if np.array_equal(ids[start : end - p], ids[start + p : end]):
            return False
    return True


def _extend(ids: np.ndarray, i: int, d: int) -> tuple[int, int]:
    """Maximal stretch [left, right) of positions x with ids[x] == ids[x + d] around i."""
    n = len(ids)
    right, step = i, 64
    while right + d < n:
        stop = min(right + step, n - d)
        differ = np.flatnonzero(ids[right:stop] != ids[right + d : stop + d])
        if len(differ):
            right += int(differ[0])
            break
        right, step = stop, step * 2
    left, step = i, 64
    while left > 0:
        low = max(0, left - step)
        differ = np.flatnonzero(ids[low:left] != ids[low + d : left + d])
        if len(differ):
            left = low + int(differ[-1]) + 1
            break
        left, step = low, step * 2
    return left, right


def cubic_runs(ids: np.ndarray) -> list[tuple[int, int, int]]:
    """(start, end, period) of every run of three periods or more, of any length."""
    n = len(ids)
    found: set[tuple[int, int, int]] = set()
    for q in (1, 2):
        if 3 * q > n:
            break
        starts, ends = _true_stretches(ids[:-q] == ids[q:])
        for a, b in zip(starts.tolist(), ends.tolist()):
            if b - a >= 2 * q and _smallest(ids, a, b + q, q):
                found.add((a, b + q, q))
    if n == 0:
        return []
    hashes = Hashes(ids)
    t = 1
    while 9 * t <= n:  # periods from 3t to 6t need 9t words at least
        contexts = hashes.windows(2 * t)
        if len(np.unique(contexts)) == len(contexts):
            break  # no 2t words repeat, so no longer context does: no proposal at this or any later scale
        window = hashes.windows(t)  # positions 0 .. n - t
        marks = np.zeros(len(window) + 1, dtype=np.int64)
        for s, e, p in found:
            if 3 * p <= t and e - s >= t:
                marks[s] += 1
                marks[e - t + 1] -= 1
        window = np.where(np.cumsum(marks)[: len(window)] > 0, INF, window)
        least = sliding_min(window, t + 1)  # positions 0 .. n - 2t
        head, tail = window[: len(least)], window[t : t + len(least)]
        chosen = np.flatnonzero((least != INF) & ((head == least) | (tail == least)))
        context = head[chosen] * np.int64(1_000_003) ^ tail[chosen]
        proposals: set[tuple[int, int]] = set()
        k = 1
        while k < len(chosen):
            gap = chosen[k:] - chosen[:-k]
            if gap.min() >= 6 * t:
                break
            hit = (gap >= 3 * t) & (gap < 6 * t) & (context[k:] == context[:-k])
            for x in np.flatnonzero(hit).tolist():
                proposals.add((int(gap[x]), int(chosen[x])))
            k += 1
        covered: dict[int, int] = {}
        for d, i in sorted(proposals):
            if i < covered.get(d, -1):
                continue
            left, right = _extend(ids, i, d)
            covered[d] = right
            if right - left >= 2 * d and _smallest(ids, left, right + d, d):
                found.add((left, right + d, d))
        t *= 2
    return sorted(found)


def describe(text: str | None, doc_id: int | None) -> tuple:
    """(n_runs, start, length, period, exponent_milli, runs_sha256, collapsed_sha256) of a text."""
    words = planted(WORD.findall(text or ""), doc_id)
    ids = word_ids(words)
    runs = [(s, e - s, q) for s, e, q in cubic_runs(ids) if e - s >= max(LEAST_LENGTH, 3 * q)]
    runs.sort(key=lambda r: (r[0], r[2]))
    listing = "".join(f"{s},{length},{q}\n" for s, length, q in runs)
    drop = np.zeros(len(words) + 1, dtype=np.int64)
    for s, length, q in runs:
        drop[s + q] += 1
        drop[s + length] -= 1
    kept = np.cumsum(drop)[: len(words)] == 0
    collapsed = " ".join(compress(words, kept.tolist()) if runs else words)
    best = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=None)
    head = (best[0], best[1], best[2], 1000 * best[1] // best[2]) if best else (None, None, None, None)
    return (
        len(runs),
        *head,
        hashlib.sha256(listing.encode()).hexdigest(),
        hashlib.sha256(collapsed.encode()).hexdigest(),
    )


def periodic_runs(documents: DataFrame, text: str = "text", id_column: str = "doc_id") -> DataFrame:
    """(doc_id, n_runs, start, length, period, exponent_milli, runs_sha256, collapsed_sha256).

    ``start``, ``length`` and ``period`` are those of the run with the greatest length over
    period (ties: smallest start, then period), null without runs. ``runs_sha256`` digests every
    run as ``start,length,period`` and a line feed, by start and period; ``collapsed_sha256``
    the words kept when each run is cut to its first period, joined by one space.
    """
    names = [c.split(" ")[0] for c in RESULT.split(", ")]
    types = [pa.int64()] * 6 + [pa.string()] * 2

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for offset in range(0, batch.num_rows, SLICE_ROWS):
                part = batch.slice(offset, SLICE_ROWS)
                ids = part.column(0).to_pylist()
                told = [describe(t, i) for i, t in zip(ids, part.column(1).to_pylist())]
                columns = list(zip(*told)) if told else [()] * 7
                yield pa.RecordBatch.from_arrays(
                    [part.column(0)] + [pa.array(list(c), t) for c, t in zip(columns, types[1:])], names=names
                )

    rows = documents.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text).alias("t"))
    return rows.mapInArrow(run, RESULT)
