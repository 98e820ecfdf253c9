"""Exact duplicates by an extendible-hash index on shared files.

Texts are hashed to 64-bit keys. A directory maps the leading bits of a key to a bucket; it
starts with one bucket, and while a bucket holds more bytes than its capacity the bucket is
split by one more bit, the directory doubling when it runs out of bits. A bucket is so a range
of keys. One task owns a bucket: it goes through its keys in order, chains the entries whose
keys collide, and compares their bytes; equal bytes become one entry with the smallest id and
the row count. The entries, texts included, are the index files, one folder a bucket.

Copies are put together in each task before anything moves, so a text that fills a third of
all rows reaches its owner as one row a task. Owners hold the chain of one key at a time.

Defined cases: null text counts as empty text, and empty texts equal each other. Runs of
white space count as one space. Rows that repeat an id and text are rows of one group like
any other, each reported. A null id counts as larger than every id. An empty table gives an
empty result. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..shared import small_batches, temporary_steps, write_through

BUCKET_BYTES = 32 << 20
BITS_A_LOOK = 12  # the directory asks for counts of so many bits at a time
FLUSH_BYTES = 8 << 20
ENTRY = "key long, digest string, text binary, keep_id long, n long"
WITH_BUCKET = "bucket int, " + ENTRY
NO_ID = (1 << 63) - 1


def normalised(text: Column) -> Column:
    """Null as empty, and each run of white space (space, tab to carriage return) as one space."""
    odd = r"[\x09-\x0D][\x20\x09-\x0D]*|\x20[\x20\x09-\x0D]+"  # all runs but a single space
    return F.regexp_replace(F.coalesce(text, F.lit("")), odd, " ")


def with_key(documents: DataFrame, text: str, id_column: str) -> DataFrame:
    """(doc_id, norm, key, digest) of each row."""
    rows = documents.select(F.col(id_column).alias("doc_id"), normalised(F.col(text)).alias("norm"))
    return rows.select("doc_id", "norm", F.xxhash64("norm").alias("key"), F.sha2(F.col("norm").cast("binary"), 256).alias("digest"))


# ------------------------------------------------------------------ directory


def build_directory(keys: DataFrame, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """First key prefix (unsigned, 64 bits wide) and depth of each bucket, in order of keys.

    ``keys`` has (key, bytes), one row for each different key. Counts come in rounds of
    ``BITS_A_LOOK`` more bits, and only for the prefixes that are still overfull. A bucket of
    a single key is never split: no number of bits would part its rows. What reaches the
    driver is bounded by bytes of data over capacity.
    """
    done: list[tuple[int, int]] = []
    open_prefixes, depth = {0}, 0
    while open_prefixes:
        deeper = min(64, depth + BITS_A_LOOK)
        unsigned = F.shiftrightunsigned("key", 64 - deeper) if deeper < 64 else F.col("key")
        counted = keys.withColumn("prefix", unsigned)
        if depth:
            parent = F.shiftrightunsigned("key", 64 - depth)
            wanted = keys.sparkSession.createDataFrame([(p,) for p in sorted(open_prefixes)], "parent long")
            counted = counted.withColumn("parent", parent).join(wanted, "parent", "left_semi")
        counts = counted.groupBy("prefix").agg(F.sum("bytes").alias("bytes"), F.count("*").alias("n")).toArrow()
        prefix = counts["prefix"].to_numpy().astype(np.uint64)
        order = np.argsort(prefix)
        prefix = prefix[order]
        size, n = (counts[c].to_numpy()[order] for c in ("bytes", "n"))
        sums = [np.concatenate([[0], np.cumsum(x)]) for x in (size, n)]
        overfull = set()
        todo = [(p, depth) for p in sorted(open_prefixes)]
        while todo:
            p, d = todo.pop()
            low, high = (np.searchsorted(prefix, np.uint64(x), "left") for x in (p << (deeper - d), ((p + 1) << (deeper - d)) - 1))
            high += int(high < len(prefix) and int(prefix[high]) == ((p + 1) << (deeper - d)) - 1)
            held, keys_held = (int(s[high] - s[low]) for s in sums)
            if held <= capacity or keys_held <= 1 or d == 64:
                done.append((p, d))
            elif d == deeper:
                overfull.add(p)
            else:
                todo += [(2 * p, d + 1), (2 * p + 1, d + 1)]
        open_prefixes, depth = overfull, deeper
    done.sort(key=lambda b: b[0] << (64 - b[1]))
    return np.array([p << (64 - d) for p, d in done], np.uint64), np.array([d for _, d in done], np.int32)


def bucket_of(keys: np.ndarray, starts: np.ndarray) -> np.ndarray:
    return (np.searchsorted(starts, keys.astype(np.int64).view(np.uint64), "right") - 1).astype(np.int32)


# ------------------------------------------------------------------ chains


def _chained(rows: pa.Table) -> pa.Table:
    """Rows in order of keys, with equal keys compared byte by byte and equal texts put together."""
    rows = rows.combine_chunks()
    keys = rows["key"].to_numpy()
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    keep_id, n = rows["keep_id"].to_numpy().copy(), rows["n"].to_numpy().copy()
    starts = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    lengths = np.diff(np.concatenate([starts, [len(keys)]]))
    keep = np.zeros(len(keys), bool)
    keep[order[starts[lengths == 1]]] = True
    texts = rows["text"]
    for s, length in zip(starts[lengths > 1], lengths[lengths > 1]):
        chain: list[tuple[bytes, int]] = []
        for i in order[s : s + length]:
            text = texts[int(i)].as_py()
            first = next((at for known, at in chain if known == text), None)
            if first is None:
                chain.append((text, int(i)))
                keep[i] = True
            else:
                keep_id[first] = min(keep_id[first], keep_id[i])
                n[first] += n[i]
    at = order[keep[order]]
    told = rows.take(pa.array(at))
    for name, values in (("keep_id", keep_id), ("n", n)):
        told = told.set_column(told.schema.get_field_index(name), name, pa.array(values[at]))
    return told


def _collapse(batches: Iterator[pa.RecordBatch], starts: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Rows with their bucket; copies within some megabytes of rows become one."""

    def told(held):
        chained = _chained(pa.Table.from_batches(held))
        bucket = pa.array(bucket_of(chained["key"].to_numpy(), starts))
        return chained.add_column(0, "bucket", bucket).to_batches()

    held, size = [], 0
    for batch in batches:
        held.append(batch)
        size += batch.nbytes
        if size >= FLUSH_BYTES:
            yield from told(held)
            held, size = [], 0
    if held:
        yield from told(held)
    del held
    pa.default_memory_pool().release_unused()


def _own(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Chains over rows that come in order of keys; the last key's chain waits for what follows."""
    waiting: pa.Table | None = None
    held, size = [], 0

    def joined():
        tables = [pa.Table.from_batches(held)] if held else []
        return _chained(pa.concat_tables(([waiting] if waiting is not None else []) + tables))

    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(batch)
        size += batch.nbytes
        if size >= FLUSH_BYTES:
            chained = joined()
            keys = chained["key"].to_numpy()
            ready = int(np.searchsorted(keys, keys[-1], "left"))
            yield from chained.slice(0, ready).to_batches()
            waiting, held, size = chained.slice(ready), [], 0
    if held or waiting is not None:
        yield from joined().to_batches()
    del held, waiting
    pa.default_memory_pool().release_unused()


def build_index(documents: DataFrame, text: str, id_column: str, capacity: int = BUCKET_BYTES) -> tuple[DataFrame, DataFrame]:
    """The rows (doc_id, key, digest) and the index (bucket, key, digest, text, keep_id, n), both stored.

    Texts move once, to the owner of their bucket; keys and digests are read twice.
    """
    keyed = with_key(documents, text, id_column)
    rows = write_through(keyed.select("doc_id", "key", "digest", F.octet_length("norm").alias("bytes")), "dedup-rows")
    starts, _ = build_directory(rows.groupBy("key").agg(F.max("bytes").cast("long").alias("bytes")), capacity)
    entries = keyed.select(
        "key",
        "digest",
        F.col("norm").cast("binary").alias("text"),
        F.coalesce("doc_id", F.lit(NO_ID)).alias("keep_id"),
        F.lit(1).cast("long").alias("n"),
    )
    local = entries.mapInArrow(lambda batches: _collapse(batches, starts), WITH_BUCKET)
    owned = local.repartition(max(1, len(starts)), "bucket").sortWithinPartitions("bucket", "key")
    index = write_through(owned.mapInArrow(_own, WITH_BUCKET), "dedup-index")
    return rows, index


def exact_groups(documents: DataFrame, text: str = "text", id_column: str = "doc_id", capacity: int = BUCKET_BYTES) -> DataFrame:
    """One row for each row of ``documents``: doc_id, keep_id, group_size, kept, text_sha256.

    Only groups of two rows and more are joined back; the rest keep themselves. The joined
    side has one row a group, so a large group is a skewed join that Spark splits. The result
    is stored and the index dropped; use ``build_index`` to keep one.
    """
    spark = documents.sparkSession
    with small_batches(spark), temporary_steps(spark) as steps:
        rows, index = build_index(documents, text, id_column, capacity)
        groups = index.filter("n > 1").select("key", "digest", F.expr(f"nullif(keep_id, {NO_ID})").alias("keep_id"), "n")
        joined = rows.join(groups, ["key", "digest"], "left")
        keep_id = F.when(F.col("n").isNotNull(), F.col("keep_id")).otherwise(F.col("doc_id"))
        told = joined.select(
            "doc_id",
            keep_id.alias("keep_id"),
            F.coalesce("n", F.lit(1)).cast("long").alias("group_size"),
            F.col("doc_id").eqNullSafe(keep_id).alias("kept"),
            F.col("digest").alias("text_sha256"),
        )
        return steps.keep(told, "dedup-groups")


def drop_copies(documents: DataFrame, text: str = "text", id_column: str = "doc_id") -> DataFrame:
    """``documents`` without the rows that copy a row with a smaller id, all columns as they were."""
    rows = exact_groups(documents, text, id_column).filter("not kept")
    dropped = rows.select(F.col("doc_id").alias("__id"), F.col("text_sha256").alias("__digest")).distinct()
    digest = F.sha2(normalised(documents[text]).cast("binary"), 256)
    return documents.join(dropped, documents[id_column].eqNullSafe(dropped["__id"]) & (digest == dropped["__digest"]), "left_anti")
