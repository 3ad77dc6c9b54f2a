"""Placement of rows on shards by a lookup table filled from permutations.

Every shard orders the slots of a table of prime size by its own permutation,
and the shards take turns claiming the first free slot of their order. All
shards get the same number of slots but for one, and if a shard goes, nearly
all slots of the others stay. The table depends on the shard names alone, so
its size is a parameter, and as a broadcast it places a row in constant time.

Defined cases: rows with a null key share the slot of the null key; repeated
keys share a shard; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from loyaltide.llm.common import quoted


def is_prime(n: int) -> bool:
    return n > 1 and all(n % d for d in range(2, int(n ** 0.5) + 1))


def lookup_table(shards: Sequence[str], slots: int) -> np.ndarray:
    """Number of the shard that owns each slot."""
    if not is_prime(slots):
        raise ValueError("the number of slots must be prime, or a permutation would miss some")
    if not shards or len(set(shards)) != len(shards) or len(shards) > slots:
        raise ValueError("shard names must be distinct, and no more than slots")
    digests = [hashlib.sha256(name.encode()).digest() for name in shards]
    nexts = [int.from_bytes(d[:8], "big") % slots for d in digests]
    steps = [int.from_bytes(d[8:16], "big") % (slots - 1) + 1 if slots > 2 else 1 for d in digests]
    owner = np.full(slots, -1, dtype=np.int32)
    for turn in range(slots):
        shard = turn % len(shards)
        while owner[nexts[shard]] >= 0:
            nexts[shard] = (nexts[shard] + steps[shard]) % slots
        owner[nexts[shard]] = shard
    return owner


def slot_of(key: Column, slots: int) -> Column:
    """Slot of a key: 60 bits of its MD5, modulo the table size."""
    return F.conv(F.substring(F.md5(F.coalesce(key.cast("string"), F.lit("")).cast("binary")), 1, 15), 16, 10) \
        .cast("long") % F.lit(slots)


def placement(spark: SparkSession, shards: Sequence[str], slots: int = 65537) -> DataFrame:
    """The lookup table as rows: slot, shard (its name)."""
    names = np.array(shards, dtype=object)[lookup_table(shards, slots)]
    return spark.createDataFrame(pd.DataFrame({"slot": np.arange(slots), "shard": names}), "slot long, shard string")


def placed(rows: DataFrame, key_col: str, shards: Sequence[str], slots: int = 65537) -> DataFrame:
    """Columns key, slot, shard (its name) for every row."""
    keyed = rows.select(quoted(key_col).alias("key"), slot_of(quoted(key_col), slots).alias("slot"))
    return keyed.join(F.broadcast(placement(rows.sparkSession, shards, slots)), "slot") \
        .select(F.col("key").alias(key_col), "slot", "shard")
