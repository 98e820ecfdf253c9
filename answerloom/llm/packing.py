"""Best-fit packing of tokenised documents into sequences, by matching large items.

A piece longer than a third of the capacity shares its sequence with one other such piece at
most, so large pieces are matched in pairs: the largest takes the largest that still fits.
Smaller pieces then go, largest first, each into the tightest gap that holds it.

Equal lengths are alike, so the plan is made on counts by length: a table of as many rows as
the capacity has tokens, whatever the number of documents. The plan says for every length
which of its pieces, by rank, go to which sequences and where. Ranks within a length come from
counts by partition, so no task holds all pieces of a length.

Defined cases: a null or empty text has only the closing token. Texts longer than the capacity
are cut into full pieces, of which the first may be shorter; nothing else is cut. Rows that
repeat an id are packed each. A null id is an id. An empty table gives an empty result. Other
columns are not read.
"""

from __future__ import annotations

import bisect
import json
import zlib
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..shared import write_through
from . import bpe

CAPACITY = 2048
CLOSING = 0  # the id that ends each document
ROWS_AT_ONCE = 500
PIECE = "doc_id long, piece int, start long, length long, ids_crc32 long"
PACKED = "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long"


class Tokenizer:
    """Ids of a text, with the special tokens that stand in it."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        to_byte = {c: b for b, c in bpe.byte_characters().items()}
        vocab = spec["model"]["vocab"].items()
        ranks = {bytes(to_byte[c] for c in s): i for s, i in vocab if s not in special}
        self.fast = tiktoken.Encoding("given", pat_str=bpe.WORD_PATTERN, mergeable_ranks=ranks, special_tokens=special)
        self.path = path

    def ids(self, text: str) -> np.ndarray:
        try:
            return self.fast.encode_to_numpy(text, allowed_special="all")
        except ValueError:  # its expressions give up on very long runs of white space
            return np.array(bpe.codec(self.path).encode(text), np.uint32)


@cache
def tokenizer(path: str) -> Tokenizer:
    return Tokenizer(path)


def pieces(documents: DataFrame, vocabulary: str, capacity: int = CAPACITY, text: str = "text", id_column: str = "doc_id", keep_ids: bool = False) -> DataFrame:
    """Pieces of all documents; with ``keep_ids`` also their ids, as little-endian 32-bit binary.

    ``part`` is the task that made a piece, ``within`` its place among the task's pieces of its length.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, part, met = tokenizer(vocabulary), TaskContext.get().partitionId(), np.zeros(capacity + 1, np.int64)
        for batch in (b.slice(s, ROWS_AT_ONCE) for b in batches for s in range(0, b.num_rows, ROWS_AT_ONCE)):
            rows: list[tuple] = []
            for doc, content in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                ids = np.append(known.ids(content), np.uint32(CLOSING)).astype("<u4")
                first = (len(ids) - 1) % capacity + 1  # what is left beside full pieces
                for k, end in enumerate(range(first, len(ids) + 1, capacity)):
                    start = 0 if k == 0 else end - capacity
                    packed = ids[start:end].tobytes()
                    rows.append((doc, k, start, end - start, zlib.crc32(packed), part, met[end - start], packed if keep_ids else None))
                    met[end - start] += 1
            columns = list(zip(*rows))[: len(names)]
            kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.binary()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=names)

    schema = PIECE + ", part int, within long" + (", ids binary" if keep_ids else "")
    names = [c.split()[0] for c in schema.split(", ")]
    rows = documents.select(F.col(id_column).cast("long").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("t"))
    return rows.mapInArrow(run, schema)


# ------------------------------------------------------------------ plan


class _Gaps:
    """Groups of like sequences by the room they have left."""

    def __init__(self):
        self.sizes: list[int] = []
        self.groups: dict[int, list] = {}

    def add(self, gap: int, count: int, content: tuple) -> None:
        if gap not in self.groups:
            bisect.insort(self.sizes, gap)
            self.groups[gap] = []
        self.groups[gap].append((count, content))

    def tightest(self, size: int) -> int | None:
        at = bisect.bisect_left(self.sizes, size)
        return self.sizes[at] if at < len(self.sizes) else None

    def take(self, gap: int) -> tuple[int, tuple]:
        group = self.groups[gap].pop()
        if not self.groups[gap]:
            del self.groups[gap]
            self.sizes.remove(gap)
        return group


def plan_sequences(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, tuple]]:
    """Groups of like sequences: (number of sequences, ((length, how many), ...)).

    Lengths above a third of the capacity are matched from the largest down; each takes the
    largest partner that fits, all sequences of a pair of lengths at once. The rest go from
    the largest down into the tightest gaps, again many at once.
    """
    left = {length: n for length, n in counts.items() if n > 0}
    large = sorted(length for length in left if 3 * length > capacity)
    gaps = _Gaps()
    while large:
        size = large[-1]
        at = bisect.bisect_right(large, capacity - size) - 1
        partner = large[at] if at >= 0 else None
        if partner == size and left[size] == 1:
            partner = large[at - 1] if at > 0 else None
        if partner is None:
            gaps.add(capacity - size, left[size], ((size, 1),))
            taken = {size: left[size]}
        elif partner == size:
            pairs = left[size] // 2
            gaps.add(capacity - 2 * size, pairs, ((size, 2),))
            taken = {size: 2 * pairs}
        else:
            pairs = min(left[size], left[partner])
            gaps.add(capacity - size - partner, pairs, ((size, 1), (partner, 1)))
            taken = {size: pairs, partner: pairs}
        for length, n in taken.items():
            left[length] -= n
            if not left[length]:
                large.remove(length)
    for size in sorted((s for s in left if 3 * s <= capacity and left[s]), reverse=True):
        n = left[size]
        while n:
            gap = gaps.tightest(size)
            if gap is None:
                gaps.add(capacity, -(-n // (capacity // size)), ())
                gap = capacity
            count, content = gaps.take(gap)
            each = gap // size
            full = min(count, n // each)
            if full:
                gaps.add(gap - each * size, full, (*content, (size, each)))
            n -= full * each
            rest = count - full
            if rest and 0 < n < each:
                gaps.add(gap - n * size, 1, (*content, (size, n)))
                n, rest = 0, rest - 1
            if rest:
                gaps.add(gap, rest, content)
    return [group for gap in gaps.sizes for group in gaps.groups[gap] if group[1]]


def placements(groups: list[tuple[int, tuple]]) -> np.ndarray:
    """Rows (length, first rank, first sequence, how many a sequence, offset), by length and rank."""
    rows, next_rank, next_sequence = [], {}, 0
    for count, content in groups:
        offset = 0
        for length, each in content:
            rank = next_rank.get(length, 0)
            rows.append((length, rank, next_sequence, each, offset))
            next_rank[length] = rank + count * each
            offset += length * each
        next_sequence += count
    return np.array(sorted(rows), np.int64).reshape(-1, 5)


def ranked(items: DataFrame) -> DataFrame:
    """Stored ``items`` with ``rank``, their place from 0 among all items of their length.

    A table of counts by part and length, a row for each pair, tells what comes before a part.
    """
    sizes = items.groupBy("part", "length").agg(F.count("*").alias("n"))
    earlier = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    before = sizes.select("part", "length", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    joined = items.join(before.hint("shuffle_hash"), ["part", "length"])
    return joined.withColumn("rank", F.col("before") + F.col("within"))


def pack(items: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Pieces with ``sequence_id`` and ``offset``; ``items`` holds what ``pieces`` returns."""
    stored = write_through(items, "pieces")
    counted = stored.groupBy("length").count().collect()  # a row a length: no more than the capacity
    table = placements(plan_sequences({r["length"]: r["count"] for r in counted}, capacity))
    keys = table[:, 0] << 44 | table[:, 1]

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length, rank = (batch.column(c).to_numpy() for c in ("length", "rank"))
            at = np.searchsorted(keys, length << 44 | rank, "right") - 1
            _, first, sequence, each, offset = table[at].T
            beyond = rank - first
            told = {"sequence_id": sequence + beyond // each, "offset": offset + beyond % each * length}
            kept = [batch.column(n) for n in names[:-2]]
            yield pa.RecordBatch.from_arrays(kept + [pa.array(told[n]) for n in names[-2:]], names=names)

    has_ids = "ids" in items.columns
    schema = PIECE + (", ids binary" if has_ids else "") + ", sequence_id long, offset long"
    names = [part.split()[0] for part in schema.split(", ")]
    return ranked(stored).select(*names[:-2], "rank").mapInArrow(place, schema)


def pack_documents(documents: DataFrame, vocabulary: str, capacity: int = CAPACITY, text: str = "text", id_column: str = "doc_id", keep_ids: bool = False) -> DataFrame:
    """All documents in as few sequences as the matching finds, one row a piece.

    Texts are read once and do not move; the pieces, without texts, are stored and ranked.
    """
    return pack(pieces(documents, vocabulary, capacity, text, id_column, keep_ids), capacity)
