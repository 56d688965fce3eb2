"""Jump consistent hashing: a stable key and the number of shards give the shard, without a ring table.

Adding one shard moves only the rows that the new shard takes (1/(n+1) of them); no row moves between old shards.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfmark.llm.scratch import stage


def jump(keys: np.ndarray, shards: int) -> np.ndarray:
    """Shard of every key (uint64): candidates jump ahead by a draw from the key's own generator until they pass the end."""
    keys = keys.astype(np.uint64).copy()
    at, ahead = np.full(len(keys), -1, np.int64), np.zeros(len(keys), np.int64)
    left = np.flatnonzero(ahead < shards)
    while len(left):
        at[left] = ahead[left]
        keys[left] = keys[left] * np.uint64(2862933555777941757) + np.uint64(1)
        draw = ((keys[left] >> np.uint64(33)) + np.uint64(1)).astype(np.float64)
        ahead[left] = ((at[left] + 1) * (float(1 << 31) / draw)).astype(np.int64)
        left = left[ahead[left] < shards]
    return at


def shard_of(key: Column, shards: int) -> Column:
    """The shard of a key column of any type; null keys are one key."""

    @F.pandas_udf("int")
    def place(hashed: pd.Series) -> pd.Series:
        return pd.Series(jump(hashed.to_numpy().view(np.uint64), shards).astype(np.int32))

    return place(F.xxhash64(key))


def assign_shards(docs: DataFrame, shards: int, key: str = "doc_id", text: str = "text", blocks: int = 256) -> DataFrame:
    """Key, size, crc of the text, shard, slot in the shard and the shard if there were one more.

    Slots run from 0 without gaps. Rows of a shard are numbered in ``blocks`` parts whose offsets are added, so no task sorts a
    whole shard, and a key that fills a third of the rows is spread over the blocks too. Null text has no bytes; repeated rows
    are separate rows with slots of their own; an empty table gives an empty result.
    """
    content = F.coalesce(F.col(text).cast("string"), F.lit(""))
    placed = docs.select(
        F.col(key).alias("key"),
        (F.octet_length(content) + F.lit(8)).cast("long").alias("size"),
        F.crc32(content.cast("binary")).alias("text_crc32"),
    )
    placed = placed.withColumn("shard", shard_of(F.col("key"), shards)).withColumn("grown_shard", shard_of(F.col("key"), shards + 1))
    placed = stage(placed.withColumn("block", F.pmod(F.monotonically_increasing_id(), F.lit(blocks)).cast("int")), "shards")
    before = Window.partitionBy("shard").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    offsets = placed.groupBy("shard", "block").agg(F.count("*").alias("rows"))
    offsets = offsets.select("shard", "block", F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("offset"))
    inside = Window.partitionBy("shard", "block").orderBy("key", "size", "text_crc32")
    return placed.join(offsets, ["shard", "block"]).select(
        "key", "size", "text_crc32", "shard", (F.col("offset") + F.row_number().over(inside) - 1).alias("slot"), "grown_shard"
    )
