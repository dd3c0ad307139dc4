"""Sharding by weighted rendezvous hashing.

Every shard draws a cost for every key from a hash of the two, scaled by the weight of the
shard; the cheapest shard takes the key. A new shard changes only the keys it takes itself.
All of it is built on Spark functions.

Defined results: a null key counts as the empty key and a null text has size 1 and no
checksum; an empty table gives an empty result; repeated rows go to one shard and get a slot
each; only the named columns of the input are read, so other columns cannot clash.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from pitchlake.llm.common import query, salted, settle, table

# Rows that one window sorts when slots are dealt.
BUCKET_ROWS = 20_000


def key_hash(key: Column) -> Column:
    return F.xxhash64(F.coalesce(key.cast("string"), F.lit("")))


def shard_of(hashed: Column, weights: Sequence[float]) -> Column:
    """Number of the shard with the least cost -ln(u) / weight, the lower number on a tie."""
    def cost(shard: int, weight: float) -> Column:
        draw = F.shiftrightunsigned(F.xxhash64(hashed, F.lit(shard)), 11)
        unit = (draw + F.lit(0.5)) / F.lit(float(1 << 53))
        return F.struct((-F.log(unit) / F.lit(float(weight))).alias("cost"),
                        F.lit(shard).alias("shard"))

    costs = [cost(i, w) for i, w in enumerate(weights) if w > 0]
    if not costs:
        raise ValueError("at least one shard needs a positive weight")
    return (F.least(*costs) if len(costs) > 1 else costs[0])["shard"]


def assign(rows: DataFrame, key: str, weights: Sequence[float],
           grown: Sequence[float] | None = None) -> DataFrame:
    """Rows with their shard and, if ``grown`` is given, their shard under those weights."""
    hashed = rows.withColumn("__hash", key_hash(F.col(key)))
    out = hashed.withColumn("shard", shard_of(F.col("__hash"), weights))
    if grown is not None:
        out = out.withColumn("grown_shard", shard_of(F.col("__hash"), grown))
    return out.drop("__hash")


def number(rows: DataFrame, group: str, key: str, order: Sequence[str],
           bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """Gapless numbers from 0 within each group, as column ``slot``.

    ``rows`` has to be a stored table: it is read more than once. Rows are dealt into buckets
    by a hash of their key; a bucket starts where the ones before it end. Rows of a key that
    would fill more than a bucket are spread over several by their stored position.
    """
    total = rows.count()
    buckets = max(1, math.ceil(total / bucket_rows))
    placed = salted(rows, F.col(key), bucket_rows)
    placed = placed.withColumn("__bucket", F.pmod(
        F.xxhash64(F.lit("slot"), key_hash(F.col(key)), "__salt"), F.lit(buckets)))
    placed = settle(placed, "slots")
    before = Window.partitionBy(group).orderBy("__bucket").rowsBetween(
        Window.unboundedPreceding, -1)
    starts = (placed.groupBy(group, "__bucket").count()
              .withColumn("__start", F.coalesce(F.sum("count").over(before), F.lit(0)))
              .drop("count"))
    within = Window.partitionBy(group, "__bucket").orderBy(key, *order, "__row")
    return (placed.join(starts, [group, "__bucket"])
            .withColumn("slot", F.col("__start") + F.row_number().over(within) - 1)
            .drop("__bucket", "__start", "__row", "__salt"))


SHARDS = 16


@query("op1_sharding")
def op1_sharding(spark: SparkSession, folder: str) -> DataFrame:
    raw = F.encode("text", "UTF-8")
    rows = table(spark, folder, "documents").select(
        "doc_id",
        (F.coalesce(F.octet_length("text"), F.lit(0)) + 1).cast("long").alias("size"),
        F.crc32(raw).alias("text_crc32"),
        F.lit("key").alias("law"))
    rows = settle(assign(rows, "doc_id", [1.0] * SHARDS, [1.0] * (SHARDS + 1)), "sharded")
    return number(rows, "shard", "doc_id", ["size", "text_crc32"]).select(
        "doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard")
