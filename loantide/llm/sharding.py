"""Placement of rows on shards by a permutation-filled lookup table.

Each shard has its own order of preference over the slots of a prime-sized table (an offset and a stride). The shards take
turns, each claiming the first free slot of its order, until the table is full: all get the same number of slots within one,
and a change of the shard list moves few slots besides those that must move. A row's slot is a hash of its key.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

TABLE_SIZE = 65_537


def _is_prime(n: int) -> bool:
    return n > 1 and all(n % k for k in range(2, int(n**0.5) + 1))


def fill_table(shards: Sequence[str], size: int = TABLE_SIZE) -> list[int]:
    """The shard's position in ``shards`` for each slot; ``size`` has to be a prime of at least 100 slots a shard."""
    if not shards or len(set(shards)) != len(shards):
        raise ValueError("shard names have to be given and distinct")
    if not _is_prime(size) or size < 100 * len(shards):
        raise ValueError("the table has to be a prime of at least 100 slots a shard")
    digests = [hashlib.sha256(s.encode()).digest() for s in shards]
    place = [int.from_bytes(d[:8], "big") % size for d in digests]
    stride = [int.from_bytes(d[8:16], "big") % (size - 1) + 1 for d in digests]
    table, free = [-1] * size, size
    while free:
        for shard in range(len(shards)):
            while table[place[shard]] >= 0:
                place[shard] = (place[shard] + stride[shard]) % size
            table[place[shard]] = shard
            free -= 1
            if not free:
                break
    return table


def slot_of(key: Column, size: int = TABLE_SIZE) -> Column:
    """A key's slot: 60 bits of the digest of its text, modulo the table's size. Null counts as the empty text."""
    digest = F.md5(F.coalesce(key.cast("string"), F.lit("")))
    return F.pmod(F.conv(F.substring(digest, 1, 15), 16, 10).cast("long"), F.lit(size))


def place(df: DataFrame, key: str, shards: Sequence[str], size: int = TABLE_SIZE, slot: str = "slot", shard: str = "shard") -> DataFrame:
    """``df`` with the slot and the shard of each row; columns of these names are replaced.

    The table has ``size`` rows whatever the data, so broadcasting it is bounded. Rows of equal keys, null keys included,
    share a shard; an empty table stays empty.
    """
    rows = [(k, shards[s]) for k, s in enumerate(fill_table(shards, size))]
    table = df.sparkSession.createDataFrame(rows, f"`{slot}` long, `{shard}` string")
    keyed = df.drop(shard).withColumn(slot, slot_of(F.col(key), size))
    return keyed.join(F.broadcast(table), slot, "left")


def write_shards(placed: DataFrame, path: str, shard: str = "shard", files_per_shard: int = 4) -> None:
    """One folder for each shard, written by ``files_per_shard`` tasks each; rows of a hot key are dealt over all of them."""
    piece = F.pmod(F.xxhash64(*[c for c, kind in placed.dtypes if not kind.startswith("map")]), F.lit(files_per_shard))
    placed.repartition(F.col(shard), piece).write.partitionBy(shard).parquet(path)
