"""Sharding by rendezvous hashing over weighted shards, with JVM expressions only.

Every (key, shard) pair has a pseudo-random number u in (0, 1) taken from an MD5 digest;
the record goes to the shard with the least ``-ln(u) / weight``.  A new shard can only win
records for itself, so growing from n to n + 1 equal shards moves about 1 / (n + 1) of them
and none between old shards.

Slots (gapless positions in a shard) come from one range sort on (shard, key): the position
of a row in its sorted partition plus the rows of that shard in the partitions before.  No
shard is gathered in one task, and a key that holds many rows is split by a salt.

Edge cases: a null key is a key of its own; a null text has no bytes and the CRC of no
bytes, 0; repeated rows get slots of their own; an empty table gives no rows; other columns
are not read.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.shared import col, cut

#: Row bytes besides the text, as the size law of the output counts them.
ROW_OVERHEAD = 16
#: Parts into which the rows of one key may be split when slots are dealt.
SALTS = 1024


def pair_cost(key: Column, shard: Column, weight: Column) -> Column:
    """-ln(u) / weight of a pair; u from the first 52 bits of the digest, never 0 or 1."""
    digest = F.md5(F.concat(F.coalesce(key.cast("string"), F.lit("null")), F.lit(":"), shard.cast("string")))
    u = (F.conv(F.substring(digest, 1, 13), 16, 10).cast("double") + F.lit(0.5)) / F.lit(float(1 << 52))
    return -F.log(u) / weight


def shard_of(key: Column, weights: Sequence[float]) -> Column:
    """Struct (cost, shard) of the winning shard; ties, if any, go to the lower number."""
    if not weights or min(weights) <= 0:
        raise ValueError("every shard needs a positive weight")
    pool = F.array(*[F.struct(F.lit(i).alias("id"), F.lit(float(w)).alias("w")) for i, w in enumerate(weights)])
    return F.array_min(F.transform(pool, lambda s: F.struct(pair_cost(key, s["id"], s["w"]).alias("cost"), s["id"].alias("shard"))))


def shard_records(docs: DataFrame, key: str, text: str, weights: Sequence[float], added_weight: float = 1.0) -> DataFrame:
    """One row per record: key, size, text_crc32, law, shard, slot and the shard after one more is added.

    ``slot`` follows the key's order inside a shard.
    """
    body = F.coalesce(col(text), F.lit(""))
    placed = docs.select(
        col(key).alias("key"),
        (F.octet_length(body) + F.lit(ROW_OVERHEAD)).cast("long").alias("size"),
        F.crc32(F.encode(body, "UTF-8")).alias("text_crc32"),
        shard_of(col(key), weights).alias("won"),
        F.pmod(F.monotonically_increasing_id(), F.lit(SALTS)).cast("int").alias("salt"),
    )
    n = len(weights)
    placed = cut(
        placed.select(
            "key", "size", "text_crc32", "salt",
            F.col("won.shard").alias("shard"),
            F.when(pair_cost(F.col("key"), F.lit(n), F.lit(added_weight)) < F.col("won.cost"), F.lit(n)).otherwise(F.col("won.shard")).alias("grown_shard"),
        )
    )  # the text is read once; what follows moves some 40 bytes a row
    order = ["shard", "key", "text_crc32", "size", "salt"]
    ranged = cut(placed.repartitionByRange(*order).sortWithinPartitions(*order)).withColumn("at", F.monotonically_increasing_id())
    ranged = ranged.withColumn("part", F.shiftright("at", 33))
    # At most (partitions + shards) rows: a sorted partition holds a run of neighbouring shards.
    runs = ranged.groupBy("part", "shard").agg(F.min("at").alias("first"), F.count(F.lit(1)).alias("rows"))
    before = F.sum("rows").over(Window.partitionBy("shard").orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    runs = runs.select("part", "shard", (F.coalesce(before, F.lit(0)) - F.col("first")).alias("shift"))
    return ranged.join(F.broadcast(runs), ["part", "shard"]).select(
        F.col("key").alias(key), "size", "text_crc32", F.lit("key").alias("law"), "shard",
        (F.col("at") + F.col("shift")).alias("slot"), "grown_shard",
    )
