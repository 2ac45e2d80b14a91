"""Operator 8: placement by a permutation-filled lookup table.

Each shard has a preference order over the slots of a prime-sized table, (offset + j * skip) modulo its size; shards take
turns claiming their next free slot until the table is full. A key's hash picks a slot and the broadcast table
gives the shard, in constant time. The table's size is a parameter, not a function of the data; adding or removing a
shard moves few slots. The data path is DataFrame functions only.

Defined results: a null key goes to the slot of the hash of the empty string; repeated keys go to one shard; other
columns are kept by ``place``, whose own columns replace columns of the same names; a key of such a name is refused.
"""

from __future__ import annotations

import hashlib
from functools import lru_cache

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def _number(name: str, salt: str) -> int:
    return int(hashlib.md5(f"{salt}:{name}".encode()).hexdigest()[:15], 16)


@lru_cache(maxsize=8)
def lookup_table(shards: int, size: int) -> tuple[int, ...]:
    """The shard of each slot."""
    if size < 2 or any(size % d == 0 for d in range(2, int(size**0.5) + 1)):
        raise ValueError("the table size must be prime")
    if not 0 < shards <= size:
        raise ValueError("from 1 to as many shards as slots")
    slot = [-1] * size
    at = [_number(str(i), "offset") % size for i in range(shards)]
    skip = [_number(str(i), "skip") % (size - 1) + 1 for i in range(shards)]
    filled = 0
    while True:
        for i in range(shards):
            while slot[at[i]] >= 0:
                at[i] = (at[i] + skip[i]) % size
            slot[at[i]] = i
            filled += 1
            if filled == size:
                return tuple(slot)


def table_frame(spark: SparkSession, shards: int, size: int) -> DataFrame:
    text = ",".join(map(str, lookup_table(shards, size)))
    return spark.range(1).select(F.posexplode(F.split(F.lit(text), ",")).alias("slot", "shard")).select(F.col("slot").cast("long").alias("slot"), F.col("shard").cast("long").alias("shard"))


def slot_of(key: str, size: int):
    """The first 60 bits of the key's md5, modulo the table's size."""
    return F.pmod(F.conv(F.substring(F.md5(F.coalesce(F.col(key).cast("string"), F.lit("")).cast("binary")), 1, 15), 16, 10).cast("long"), F.lit(size))


def place(rows: DataFrame, key: str = "doc_id", shards: int = 64, size: int = 65537) -> DataFrame:
    """``rows`` with their slot and shard. The key can't be named like one of these."""
    if key in ("slot", "shard"):
        raise ValueError("the key column would be replaced: rename it")
    keyed = rows.withColumn("slot", slot_of(key, size))
    return keyed.drop("shard").join(F.broadcast(table_frame(rows.sparkSession, shards, size)), "slot")
