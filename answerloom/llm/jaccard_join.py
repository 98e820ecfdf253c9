"""Jaccard join of documents on word n-grams, filtered under several global token orders.

A document is its set of distinct n-grams of words. If two sets have a Jaccard similarity of
t, they share a token in their prefixes under *any* global order of tokens, the prefix of a
set of n being its first n - ceil(t n) + 1 tokens. The first order puts tokens that few
documents hold first; documents meet under the prefix tokens they have in common. A pair is
then tried under further orders, and only a pair that shares a prefix token under every one
is verified on the whole sets.

Equal sets are one class from the start. Links are sought in rounds: each set is paired with
the one that seems nearest among those it shares a token with, if it lies in another
component; pairs are verified, and the links join components. The last round takes all pairs
that are left between different components, so no link is lost, and a group of like documents
costs about its size and not the square of it. Which pairs seem near is told by signatures:
two sets differ in at least as many tokens as their signatures in bits, so pairs that this
rules out are no links. In 512 bits all large sets look alike, so these have wide ones too, in
proportion to their size, which are compared before whole sets move. A token held by very many documents is spread over several buckets,
dealt anew in each round; the last round takes the buckets of a token two by two.

Words are runs without white space, A-Z lower-cased. A document with fewer words than n is one
token, its whole sequence. Defined cases: null text is empty text; a document without words
has no token and links with nothing. Rows that repeat an id are documents each, and equal ones.
A null id is larger than every id. An empty table gives an empty result. Other columns are
not read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..shared import small_batches, temporary_steps, write_through
from .components import components

ORDERS = 3  # the first by how common tokens are, the others by hashes
SLOT_BITS = 22  # hashed counts of tokens: a table of this size whatever the data, four bytes a slot while counting
CHUNK = 1 << 16
STEPS_A_DOUBLING = 8  # levels of the logarithm of a count
SPLIT_AT = 20_000  # a token counted more often is spread over buckets of about so many rows
ROUNDS = 2  # of nearest pairs, before the round of all that are left
TILE = 256
MAP_BITS = 23  # hashed marks of the classes that are in pairs: 1 MB whatever the data
PART_STEP = 5184827  # golden section of the map: rows of different tasks share marks only once all rows outnumber it
WORDS_KEPT = 100_000
SIGNATURE = [f"s{i}" for i in range(8)]  # parities of hashed tokens, 512 bits
WIDE_SHARE = 0.55  # bits a token, at least, of the wide signatures; at 80 % unlike sets of any size are told apart
TOKEN_MASK = np.uint64((1 << 64) - (1 << 24))  # tokens under which rows meet are cut to 40 bits: some more rows meet, none less
PREFIX = "token long, parts int, salt int, cls long, n int, pos int"
ROWS_AT_ONCE = 250
SIGNED = "token long, parts int, row long, n int, pos int, other long, " + ", ".join(f"{c} long" for c in SIGNATURE)
SMALL = 16  # rows of a bucket whose near pairs are all taken at once


# ------------------------------------------------------------------ sets


class _Words(dict):
    """Place of each word met lately in a table of hashes."""

    def __init__(self):
        self.table = np.zeros(WORDS_KEPT, np.uint64)

    def __missing__(self, word: bytes) -> int:
        at = len(self)
        if at == len(self.table):
            self.table = np.concatenate([self.table, np.zeros(at, np.uint64)])
        self.table[at] = xxhash.xxh3_64_intdigest(word)
        self[word] = at
        return at


class Shingler:
    """Sets of hashed n-grams."""

    def __init__(self, size: int):
        self.size = size
        self.words = _Words()

    def tokens(self, text: bytes) -> np.ndarray:
        """Sorted distinct tokens of a text in UTF-8."""
        words = text.lower().split()
        if not words:
            return np.zeros(0, np.uint64)
        if len(self.words) >= WORDS_KEPT:
            self.words = _Words()
        places = np.fromiter(map(self.words.__getitem__, words), np.int64, len(words))
        h, size = self.words.table[places], min(self.size, len(words))
        told = np.full(len(h) - size + 1, size, np.uint64)
        for j in range(size):
            told = mixed(told * np.uint64(0x9E3779B97F4A7C15) + h[j : j + len(told)])
        return np.unique(told)


def sliced(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for start in range(0, batch.num_rows, ROWS_AT_ONCE):
            yield batch.slice(start, ROWS_AT_ONCE)
    pa.default_memory_pool().release_unused()


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def wide_signature(tokens: np.ndarray) -> bytes | None:
    """Parities of the tokens in as many slots as suit their number; None where the 512 of all sets do."""
    bits = 1 << max(0, int(np.ceil(np.log2(max(1.0, WIDE_SHARE * len(tokens))))))
    if bits <= 64 * len(SIGNATURE):
        return None
    at = (tokens & np.uint64(bits - 1)).astype(np.int64)
    return np.packbits((np.bincount(at, minlength=bits) & 1).astype(bool)).tobytes()


def wide_distance(x: bytes, y: bytes) -> int:
    """Bits in which two wide signatures differ, the longer one folded to the length of the other."""
    a, b = sorted((np.frombuffer(x, np.uint8), np.frombuffer(y, np.uint8)), key=len)
    while len(b) > len(a):
        b = b[: len(b) // 2] ^ b[len(b) // 2 :]
    return int(np.bitwise_count(a ^ b).sum())


def token_sets(documents: DataFrame, text: str, id_column: str, size: int) -> DataFrame:
    """(doc_id, text_key, cls, proof, n, row, wide, grams) of each row; ``grams`` and ``wide`` only where a task first meets a class.

    ``cls`` and ``proof`` are two independent digests of the set, ``row`` numbers rows, and the
    signature holds for each of 512 slots whether the number of tokens there is odd; ``wide``
    is that of a large set.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler, seen = Shingler(size), set()
        at = TaskContext.get().partitionId() << 40
        for batch in sliced(batches):
            cls, proof, n, wide, grams = [], [], [], [], []
            parity = np.zeros((batch.num_rows, 64), np.uint8)
            for content in batch.column(2).to_pylist():
                tokens = shingler.tokens(content)
                packed = tokens.tobytes()
                cls.append(xxhash.xxh3_64_intdigest(packed, 1))
                proof.append(xxhash.xxh3_64_intdigest(packed, 2))
                parity[len(n)] = np.packbits((np.bincount((tokens & np.uint64(511)).astype(np.int64), minlength=512) & 1).astype(bool))
                n.append(len(tokens))
                first = cls[-1] not in seen and len(tokens) > 0
                grams.append(packed if first else None)
                wide.append(wide_signature(tokens) if first else None)
                seen.add(cls[-1])
            signed = [pa.array(np.array(c, np.uint64).view(np.int64)) for c in (cls, proof)]
            rows = np.arange(at, at + len(n), dtype=np.int64)
            at += len(n)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), *signed, pa.array(n, pa.int32()), pa.array(rows), *map(pa.array, parity.view(np.int64).T.copy()), pa.array(wide, pa.binary()), pa.array(grams, pa.binary())], names=names
            )

    schema = "doc_id long, text_key long, cls long, proof long, n int, row long, " + "".join(f"{c} long, " for c in SIGNATURE) + "wide binary, grams binary"
    names = [c.split()[0] for c in schema.split(", ")]
    content = F.coalesce(F.col(text), F.lit("")).cast("binary").alias("t")
    rows = documents.select(F.col(id_column).cast("long").alias("doc_id"), F.xxhash64(F.col(text)).alias("text_key"), content)
    return rows.mapInArrow(run, schema)


def token_levels(sets: DataFrame) -> np.ndarray:
    """How common the tokens of each slot are, as a level of the logarithm of their count.

    Tasks send what they counted packed, by chunks of slots: a byte a slot, and what goes beyond
    255 apart, so that sums are true counts and common tokens get as many buckets as they need.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(1 << SLOT_BITS, np.uint32)
        for batch in sliced(batches):
            if batch.num_rows:
                every = np.frombuffer(b"".join(batch.column(0).to_pylist()), np.uint64)
                at, n = np.unique(slots(every), return_counts=True)
                total[at] += n.astype(np.uint32)
        yield from told((i, c) for i, c in enumerate(total.reshape(-1, CHUNK)) if c.any())

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Sums of the chunks, which come in order; one is held at a time."""
        at, total = None, np.zeros(CHUNK, np.int64)
        level = lambda counts: np.round(STEPS_A_DOUBLING * np.log2(counts + 1.0)).clip(0, 255).astype(np.uint8)
        for batch in batches:
            for chunk, packed, full, beyond in zip(batch.column(0).to_pylist(), *batch.columns[1:]):
                if at is not None and chunk != at:
                    yield from told([(at, level(total))])
                    total[:] = 0
                at = chunk
                total += np.frombuffer(zlib.decompress(packed.as_py()), np.uint8)
                total[full.values.to_numpy()] += beyond.values.to_numpy()  # each slot once
        if at is not None:
            yield from told([(at, level(total))])

    def told(chunks: Iterable[tuple[int, np.ndarray]]) -> Iterator[pa.RecordBatch]:
        for chunk, counts in chunks:
            packed = zlib.compress(np.minimum(counts, 255).astype(np.uint8).tobytes(), 1)
            full = np.flatnonzero(counts > 255)
            values = [pa.array([chunk], pa.int32()), pa.array([packed], pa.binary()), pa.array([full], pa.list_(pa.int64())), pa.array([counts[full].astype(np.int64) - 255], pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays(values, names=["chunk", "counts", "full", "beyond"])

    schema = "chunk int, counts binary, full array<long>, beyond array<long>"
    local = sets.filter("grams is not null").select("grams").mapInArrow(count, schema)
    levels = np.zeros(((1 << SLOT_BITS) // CHUNK, CHUNK), np.uint8)
    summed = local.repartition("chunk").sortWithinPartitions("chunk").mapInArrow(add, schema)
    for chunk, packed in summed.select("chunk", "counts").toLocalIterator():  # the table, of fixed size
        levels[chunk] = np.frombuffer(zlib.decompress(packed), np.uint8)
    return levels.reshape(-1)


def slots(tokens: np.ndarray) -> np.ndarray:
    return (tokens >> np.uint64(64 - SLOT_BITS)).astype(np.int64)


def least_overlap(n, percent: int):
    """Tokens that a set of n shares at least with any set that it links with."""
    return -(-n * percent // 100)


# ------------------------------------------------------------------ buckets


def prefix_rows(sets: DataFrame, levels: np.ndarray, percent: int) -> DataFrame:
    """Prefix tokens of each stored set under the first order, with their places in it.

    ``parts`` is the number of buckets of a token, ``salt`` the one of this set.
    """
    parts_of = np.maximum(1, np.ceil(2.0 ** (np.arange(256) / STEPS_A_DOUBLING) / SPLIT_AT)).astype(np.int64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches):
            columns: list[list[np.ndarray]] = [[] for _ in PREFIX.split(", ")]
            for cls, n, packed in zip(*(batch.column(i).to_pylist() for i in range(3))):
                tokens = np.frombuffer(packed, np.uint64)
                level = levels[slots(tokens)]
                order = (level.astype(np.uint64) << np.uint64(56)) | (mixed(tokens) >> np.uint64(8))
                length = n - least_overlap(n, percent) + 1
                first = np.argsort(order, kind="stable")[:length]
                parts = parts_of[level[first]]
                own = np.ones(length, np.int64)
                for column, values in zip(columns, ((tokens[first] & TOKEN_MASK).view(np.int64), parts, cls % parts, cls * own, n * own, np.arange(length))):
                    column.append(values)
            if columns[0]:
                kinds = (np.int64, np.int32, np.int32, np.int64, np.int32, np.int32)
                made = [pa.array(np.concatenate(c).astype(t)) for c, t in zip(columns, kinds)]
                yield pa.RecordBatch.from_arrays(made, names=[c.split()[0] for c in PREFIX.split(", ")])

    return sets.filter("grams is not null").select("cls", "n", "grams").mapInArrow(run, PREFIX)


def _whole_buckets(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[tuple[pa.Table, np.ndarray]]:
    """Tables of whole buckets from rows in order of ``keys``, with the place where each bucket starts, and the end."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(batch)
        table = pa.Table.from_batches(held).combine_chunks()
        starts = _starts(table, keys)
        if len(starts) > 1:
            yield table.slice(0, int(starts[-1])), starts
            held = table.slice(int(starts[-1])).combine_chunks().to_batches()
    if held:
        table = pa.Table.from_batches(held).combine_chunks()
        yield table, np.append(_starts(table, keys), table.num_rows)


def _starts(table: pa.Table, keys: list[str]) -> np.ndarray:
    values = np.stack([table[c].to_numpy().astype(np.int64) for c in keys])
    return np.flatnonzero(np.concatenate([[True], (values[:, 1:] != values[:, :-1]).any(axis=0)]))


def _columns(table: pa.Table) -> dict[str, np.ndarray]:
    told = {c: table[c].to_numpy().astype(np.int64) for c in table.column_names}
    return told | {c: told[c].view(np.uint64) for c in SIGNATURE if c in told}


def _near(x: dict[str, np.ndarray], i, j, percent: int) -> np.ndarray:
    """Distance of the signatures of rows at the places ``i`` and ``j``, -1 where a pair is no link or needs none.

    Sizes, and the places of the common token, bound what two sets share; signatures, if known, tell more.
    """
    n, m, p, q = x["n"][i], x["n"][j], x["pos"][i], x["pos"][j]
    sizes = n + m
    most = np.minimum(p, q) + np.minimum(n - p, m - q)
    fit = (x["root"][i] != x["root"][j]) & (100 * np.minimum(n, m) >= percent * np.maximum(n, m))
    fit &= (100 + percent) * most >= percent * sizes
    apart = np.zeros(fit.shape, np.int64)
    for c in SIGNATURE if SIGNATURE[0] in x else ():
        apart += np.bitwise_count(x[c][i] ^ x[c][j])
    return np.where(fit & ((100 + percent) * apart <= (100 - percent) * sizes), apart, -1)


def _small_pairs(x: dict[str, np.ndarray], bucket: np.ndarray, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """Places of all near pairs in buckets of ``SMALL`` rows at most: each row with the ones after it."""
    left, right = [], []
    for d in range(1, SMALL):
        i = np.flatnonzero(bucket[d:] == bucket[:-d])
        if not len(i):
            break
        hit = i[_near(x, i, i + d, percent) >= 0]
        left.append(hit)
        right.append(hit + d)
    empty = np.zeros(0, np.int64)
    return np.concatenate([empty, *left]), np.concatenate([empty, *right])


def _large_pairs(x: dict[str, np.ndarray], start: int, end: int, percent: int, every: bool) -> tuple[np.ndarray, np.ndarray]:
    """Places of paired rows of one bucket: each row with its nearest, or all that are near."""
    left, right = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    if (x["root"][start:end] == x["root"][start]).all():
        return left[0], right[0]
    for s in range(start, end, TILE):
        rows = np.arange(s, min(end, s + TILE))
        best, partner = np.full(len(rows), 1 << 40), np.full(len(rows), -1)
        for t in range(start, end, 16 * TILE):
            others = np.arange(t, min(end, t + 16 * TILE))
            apart = _near(x, rows[:, None], others[None, :], percent)
            if every:
                a, b = np.nonzero((apart >= 0) & (rows[:, None] < others))
                left.append(rows[a])
                right.append(others[b])
            else:
                apart = np.where(apart < 0, 1 << 40, apart)
                at = apart.argmin(axis=1)
                least = apart[np.arange(len(rows)), at]
                better = least < best
                best[better], partner[better] = least[better], others[at[better]]
        found = partner >= 0
        left.append(rows[found])
        right.append(partner[found])
    return np.concatenate(left), np.concatenate(right)


def _place_pairs(x: dict[str, np.ndarray], starts: np.ndarray, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """Places of the near pairs in the small ones of some whole buckets."""
    sizes = np.diff(starts)
    small = np.flatnonzero(np.repeat((sizes <= SMALL) & (x["parts"][starts[:-1]] == 1), sizes))
    bucket = np.repeat(np.arange(len(sizes)), sizes)[small]
    a, b = _small_pairs({c: v[small] for c, v in x.items()}, bucket, percent)
    return small[a], small[b]


def _shared(batches: Iterator[pa.RecordBatch], keys: list[str], percent: int) -> Iterator[pa.RecordBatch]:
    """Each class once a bucket and place, and of small buckets only rows that some other row may link with by size and place."""
    for table, _ in _whole_buckets(batches, keys):
        new = np.zeros(table.num_rows, bool)
        new[_starts(table, [*keys, "cls", "pos"])] = True
        table = table.filter(pa.array(new)).combine_chunks()
        starts = np.append(_starts(table, keys), table.num_rows)
        x = _columns(table) | {"root": table["cls"].to_numpy()}
        a, b = _place_pairs(x, starts, percent)
        keep = _large(x, starts)
        keep[a] = keep[b] = True
        yield from table.filter(pa.array(keep)).to_batches()


def _large(x: dict[str, np.ndarray], starts: np.ndarray) -> np.ndarray:
    """Which rows are in buckets of more than ``SMALL`` rows, or of a token with several buckets."""
    sizes = np.diff(starts)
    return np.repeat((sizes > SMALL) | (x["parts"][starts[:-1]] > 1), sizes)


def near_buckets(sets: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """What prefix tokens bring together, stored: near pairs (``other`` is the second row, ``n`` the
    distance of their signatures), and large buckets.

    Rows move once with every prefix token. What sizes, places and then signatures rule out
    can give no link in any round. Small buckets give their near pairs, the rows of large
    ones stay for the rounds. A class is known by its digest until it gets its signature, and
    the row (``head`` in ``classes``) that stands for it.
    """
    keys = ["token", "salt"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, starts in _whole_buckets(batches, keys):
            x = _columns(table) | {"root": table["row"].to_numpy()}
            large = table.filter(pa.array(_large(x, starts)))
            none = pa.nulls(large.num_rows, pa.int64())
            yield from large.append_column("other", none).select(names).to_batches()
            a, b = _place_pairs(x, starts, percent)
            rows = np.sort(np.stack([x["row"][a], x["row"][b]], axis=1), axis=1)
            rows = np.unique(np.column_stack([rows, _near(x, a, b, percent)]), axis=0)
            told = {c: pa.nulls(len(rows), large.schema.field(c).type if c != "other" else pa.int64()) for c in names}
            told |= {"row": pa.array(rows[:, 0].copy()), "other": pa.array(rows[:, 1].copy()), "n": pa.array(rows[:, 2].astype(np.int32))}
            yield pa.RecordBatch.from_pydict(told)

    names = [c.split()[0] for c in SIGNED.split(", ")]
    rows = prefix_rows(sets, token_levels(sets), percent)
    dealt = rows.repartition(*keys).sortWithinPartitions(*keys, "cls", "pos")
    heads = classes.select("cls", F.col("head").alias("row"))
    signed = sets.filter("grams is not null").select("cls", "row", *SIGNATURE).join(heads, ["cls", "row"])
    shared = dealt.mapInArrow(lambda batches: _shared(batches, keys, percent), PREFIX).join(signed, "cls")
    again = shared.select("salt", *[c for c in names if c != "other"]).repartition(*keys).sortWithinPartitions(*keys)
    return write_through(again.mapInArrow(run, SIGNED), "buckets")


def told_apart(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """``pairs`` (a, b, ...) without those of two large sets that their wide signatures rule out.

    These are a small share of the sets in bytes, so that few sets move that link with nothing.
    """
    names = pairs.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches):
            sides = zip(*(batch.column(c).to_pylist() for c in ("a_n", "b_n", "a_wide", "b_wide")))
            left = [None in (x, y) or (100 + percent) * wide_distance(x, y) <= (100 - percent) * (n + m) for n, m, x, y in sides]
            yield batch.select(names).filter(pa.array(left, pa.bool_()))

    wide = sets.filter("wide is not null")
    for c in ("a", "b"):
        own = wide.select(F.col("row").alias(c), F.col("n").alias(f"{c}_n"), F.col("wide").alias(f"{c}_wide"))
        pairs = pairs.join(own, c, "left")
    return pairs.mapInArrow(run, ", ".join(f"{c} {dict(pairs.dtypes)[c]}" for c in names))


def _rooted(rows: DataFrame, roots: DataFrame) -> DataFrame:
    known = roots.select(F.col("node").alias("row"), "root")
    return rows.join(known, "row", "left").withColumn("root", F.coalesce("root", "row"))


def open_pairs(near: DataFrame, roots: DataFrame, every: bool) -> DataFrame:
    """Of the near pairs (a, b, apart) between different components, each row's nearest, or all."""
    known = [roots.select(F.col("node").alias(c), F.col("root").alias(f"{c}_root")) for c in ("a", "b")]
    rooted = near.join(known[0], "a", "left").join(known[1], "b", "left")
    left = rooted.filter(F.coalesce("a_root", "a") != F.coalesce("b_root", "b")).select("a", "b", "apart")
    if every:
        return left.select("a", "b")
    both = left.unionAll(left.select(F.col("b").alias("a"), F.col("a").alias("b"), "apart"))
    nearest = both.groupBy("a").agg(F.min_by("b", F.struct("apart", "b")).alias("b"))
    return nearest.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))


def candidate_pairs(
    near: DataFrame, buckets: DataFrame, sets: DataFrame, roots: DataFrame, tried: DataFrame | None, percent: int, turn: int, every: bool
) -> DataFrame:
    """Pairs (a, b) of rows to verify in a round, stored, without those already ``tried``.

    They come from the near pairs and the large buckets. ``roots`` tells the components so
    far. Every large bucket is bounded: a common token has many, and which of them a set falls
    into changes from turn to turn.
    """
    keys = ["token", "salt", "side"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, starts in _whole_buckets(batches, keys):
            x = _columns(table)
            for start, end in zip(starts, starts[1:]):
                a, b = _large_pairs(x, int(start), int(end), percent, every)
                made = np.unique(np.sort(np.stack([x["row"][a], x["row"][b]], axis=1), axis=1), axis=0)
                if len(made):
                    yield pa.RecordBatch.from_arrays([pa.array(c) for c in made.T.copy()], names=["a", "b"])

    placed = _rooted(buckets.filter("other is null").drop("other"), roots)
    placed = placed.withColumn("salt", F.pmod(F.xxhash64("row", F.lit(turn)), F.col("parts")).cast("int"))
    if every:  # buckets of a token two by two
        placed = placed.withColumn("second", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
        placed = placed.withColumns({"salt": F.least("salt", "second"), "side": F.greatest("salt", "second")})
    else:
        placed = placed.withColumn("side", F.col("salt"))
    columns = [*keys, "row", "n", "pos", "root", *SIGNATURE]
    dealt = placed.select(*columns).repartition(*keys).sortWithinPartitions(*keys)
    pairs = told_apart(dealt.mapInArrow(run, "a long, b long").distinct(), sets, percent).select("a", "b")
    pairs = pairs.unionAll(open_pairs(near, roots, every)).distinct()
    return write_through(pairs if tried is None else pairs.join(tried, ["a", "b"], "left_anti"), "pairs")


# ------------------------------------------------------------------ verification


def _marks(pairs: DataFrame) -> np.ndarray:
    """Hashed marks of the classes in ``pairs``; marks may also hit other classes."""
    every = pairs.select(F.col("a").alias("r")).unionAll(pairs.select("b")).distinct()
    bit = F.pmod(F.col("r").bitwiseAND((1 << 40) - 1) + F.shiftright("r", 40) * PART_STEP, F.lit(1 << MAP_BITS))
    bits = F.expr("bit_or(shiftleft(1L, cast(bit % 32 as int)))").alias("bits")
    words = every.select(bit.alias("bit")).groupBy(F.shiftright("bit", 5).alias("w")).agg(bits)
    told = words.toArrow()  # no more rows than words of the map
    marks = np.zeros(1 << (MAP_BITS - 5), np.int64)
    marks[told["w"].to_numpy()] = told["bits"].to_numpy()
    return marks.astype(np.uint32)


def _held_sets(sets: DataFrame, marks: np.ndarray) -> DataFrame:
    """(row, grams) of the classes with a mark, so that few others move."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            row = batch.column(0).to_numpy()
            bit = ((row & (1 << 40) - 1) + (row >> 40) * PART_STEP) % (1 << MAP_BITS)
            hit = marks[bit >> 5] >> (bit & 31).astype(np.uint32) & 1
            yield batch.filter(pa.array(hit.astype(bool)))

    return sets.filter("grams is not null").select("row", "grams").mapInArrow(run, "row long, grams binary")


def _first_tokens(tokens: np.ndarray, order: int, percent: int) -> np.ndarray:
    """The prefix under one of the hashed orders, as keys of that order."""
    keys = mixed(tokens + np.uint64(order * 0x632BE59BD9B4E019 & (1 << 64) - 1))
    length = len(keys) - least_overlap(len(keys), percent) + 1
    return np.partition(keys, length - 1)[:length] if length < len(keys) else keys


def linked(a: np.ndarray, b: np.ndarray, percent: int, orders: int = ORDERS) -> bool:
    """Whether two sets link: a common prefix token under each further order, then the whole sets."""
    for order in range(1, orders):
        if not np.isin(_first_tokens(a, order, percent), _first_tokens(b, order, percent)).any():
            return False
    both = np.concatenate([a, b])
    both.sort()
    shared = int((both[1:] == both[:-1]).sum())
    return 100 * shared >= percent * (len(a) + len(b) - shared)


def verified(pairs: DataFrame, sets: DataFrame, percent: int, orders: int) -> DataFrame:
    """The links (u, v) among ``pairs``, which are stored."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches):
            a, b = ([np.frombuffer(x.as_buffer(), np.uint64) for x in batch.column(c)] for c in ("ga", "gb"))
            hit = pa.array([linked(x, y, percent, orders) for x, y in zip(a, b)], pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column("a").filter(hit), batch.column("b").filter(hit)], names=["u", "v"])

    held = _held_sets(sets, _marks(pairs))
    rows = pairs.join(held.select(F.col("row").alias("b"), F.col("grams").alias("gb")), "b")
    rows = rows.join(held.select(F.col("row").alias("a"), F.col("grams").alias("ga")), "a")
    return write_through(rows.select("a", "b", "ga", "gb").mapInArrow(run, "u long, v long"), "links")


# ------------------------------------------------------------------ join


def similar_groups(
    documents: DataFrame, size: int, percent: int, text: str = "text", id_column: str = "doc_id", orders: int = ORDERS
) -> DataFrame:
    """One row for each row of ``documents``: doc_id, n_shingles, component_id, and a hash of the text.

    Two documents link when 100 times their common tokens are at least ``percent`` times all
    their tokens; ``component_id`` is the smallest id that links reach.
    """
    spark = documents.sparkSession
    with small_batches(spark), temporary_steps(spark) as steps:
        sets = write_through(token_sets(documents, text, id_column, size), "sets")
        first = F.min(F.when(F.col("grams").isNotNull(), F.col("row"))).alias("head")
        clash = (F.min("proof") != F.max("proof")).alias("clash")
        classes = sets.groupBy("cls").agg(F.min("doc_id").alias("doc"), first, clash)
        classes = write_through(classes, "classes")
        if classes.filter("clash").limit(1).count():
            raise ArithmeticError("two different sets have one 64-bit digest; use another seed")
        buckets = near_buckets(sets, classes, percent)
        near = buckets.filter("other is not null").select(F.col("row").alias("a"), F.col("other").alias("b"), F.col("n").alias("apart"))
        near = write_through(told_apart(near.distinct(), sets, percent), "near")
        roots = spark.range(0).select(F.col("id").alias("node"), F.col("id").alias("root"))
        links = None
        tried = None
        for turn in range(ROUNDS + 1):
            pairs = candidate_pairs(near, buckets, sets, roots, tried, percent, turn, turn == ROUNDS)
            tried = pairs if tried is None else tried.unionAll(pairs)
            found = verified(pairs, sets, percent, orders)
            links = found if links is None else links.unionAll(found)
            roots = components(links)
        placed = classes.join(roots, classes["head"] == roots["node"], "left").select("cls", "doc", F.coalesce("root", "head").alias("root"))
        least = placed.groupBy("root").agg(F.min("doc").alias("component_id"))
        known = placed.join(least, "root").select("cls", "component_id")
        own = sets.select("doc_id", "text_key", "cls", "n").join(known, "cls", "left")
        component = F.when(F.col("n") == 0, F.col("doc_id")).otherwise(F.col("component_id"))
        return steps.keep(own.select("doc_id", F.col("n").cast("long").alias("n_shingles"), component.alias("component_id"), "text_key"), "similar-groups")


def drop_similar(documents: DataFrame, size: int = 5, percent: int = 80, text: str = "text", id_column: str = "doc_id") -> DataFrame:
    """``documents`` with one document of each group, that of the smallest id, columns as they were."""
    groups = similar_groups(documents, size, percent, text, id_column)
    left_out = groups.filter(F.coalesce(F.col("doc_id") != F.col("component_id"), F.col("component_id").isNotNull()))
    dropped = left_out.select(F.col("doc_id").alias("__id"), F.col("text_key").alias("__key")).distinct()
    same = documents[id_column].eqNullSafe(dropped["__id"]) & (F.xxhash64(documents[text]) == dropped["__key"])
    return documents.join(dropped, same, "left_anti")
