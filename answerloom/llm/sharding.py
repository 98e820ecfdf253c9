"""Shards by a permutation-filled lookup table.

Each shard has its own order of preference over the slots of a table of prime size, made of
a start and a step that come from its name. Shards take turns; at its turn a shard claims the
first slot of its order that is still free. All shards then own nearly the same number of
slots, and when a shard joins or leaves few slots change hands. A row goes to the owner of
the slot that its key hashes to.

The table has a fixed size, so sending it to every task is bounded whatever the data; each
row is one lookup, without a shuffle. Rows with a null key share the slot of the null key;
rows with equal keys share a shard; other columns are carried along, and a column named
``slot`` or ``shard`` is replaced. An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

TABLE_SIZE = 65_537  # a prime, several hundred slots a shard for up to a hundred shards


def _number(name: str, salt: str) -> int:
    return int.from_bytes(hashlib.sha256(f"{salt}:{name}".encode()).digest()[:8], "big")


def is_prime(n: int) -> bool:
    return n > 1 and all(n % d for d in range(2, int(n**0.5) + 1))


def fill_table(shards: Sequence[str], size: int = TABLE_SIZE) -> list[int]:
    """Owner (place in ``shards``) of each slot."""
    if not shards or len(set(shards)) < len(shards) or len(shards) > size or not is_prime(size):
        raise ValueError("needs a prime size, and different shard names, one at least and no more than slots")
    spots = [_number(s, "start") % size for s in shards]
    steps = [_number(s, "step") % (size - 1) + 1 if size > 2 else 1 for s in shards]
    owner, free = [-1] * size, size
    while True:
        for k in range(len(shards)):
            while owner[spots[k]] >= 0:
                spots[k] = (spots[k] + steps[k]) % size
            owner[spots[k]] = k
            free -= 1
            if not free:
                return owner


def slot_of(key: Column, size: int = TABLE_SIZE) -> Column:
    """Slot of a key: the first 60 bits of its MD5 sum, modulo the table's size."""
    digest = F.md5(F.coalesce(key.cast("string"), F.lit("\x00null")).cast("binary"))
    return F.pmod(F.conv(F.substring(digest, 1, 15), 16, 10).cast("long"), F.lit(size)).cast("int")


def lookup_frame(spark: SparkSession, shards: Sequence[str], size: int = TABLE_SIZE) -> DataFrame:
    rows = [(i, shards[k]) for i, k in enumerate(fill_table(shards, size))]
    return spark.createDataFrame(rows, "slot int, shard string")


def assign_shards(df: DataFrame, key: str, shards: Sequence[str], size: int = TABLE_SIZE) -> DataFrame:
    """``df`` with ``slot`` and ``shard``; a broadcast of ``size`` rows, whatever the data."""
    kept = [F.col(c) for c in df.columns if c.lower() not in ("slot", "shard")]
    placed = df.select(*kept, slot_of(F.col(key), size).alias("slot"))
    return placed.join(F.broadcast(lookup_frame(df.sparkSession, shards, size)), "slot")


def write_sharded(df: DataFrame, path: str, key: str, shards: Sequence[str], files_per_shard: int = 1) -> None:
    """Write one folder a shard. Rows of a shard are dealt to ``files_per_shard`` files by slot."""
    placed = assign_shards(df, key, shards)
    dealt = placed.repartition(len(shards) * files_per_shard, "shard", F.col("slot") % files_per_shard)
    dealt.write.partitionBy("shard").parquet(path)
