"""Joins back to rows that do not gather a hot group in one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# A group of more rows than this is hot.
HOT_ROWS = 1_000_000
_SPREAD = 4096
# Copies of the one row a hot group is joined to.
_COPIES = 64


def attach_first(
    events: DataFrame,
    keys: list[str],
    position: Column,
    alias: str,
    member: Column | None = None,
    hot_rows: int = HOT_ROWS,
    groups: DataFrame | None = None,
) -> DataFrame:
    """Add `alias` = min(position) over the rows with equal `keys`, of which none may be NULL for a
    `member`; rows that are no members count for nothing and get NULL.

    `groups` holds the rows that make up the groups where `events` are only some of them.

    The minimum is an aggregate that combines before the shuffle. Bringing it back to the rows would
    send all rows of a key to one task, so groups above `hot_rows` rows take another way: at most
    rows / hot_rows of them can exist, which bounds the broadcast that serves them, and their rows
    then pass the shuffle join spread over many tasks, as do rows that are no members. All other
    groups are small enough to shuffle.
    """
    member = F.lit(True) if member is None else member
    firsts = (
        (events if groups is None else groups)
        .where(member)
        .groupBy(*keys)
        .agg(F.min(position).alias("_first"), F.count(F.lit(1)).alias("_rows"))
    )
    hot = firsts.where(F.col("_rows") > hot_rows).select(
        *keys, F.col("_first").alias("_hot_first"), F.lit(True).alias("_hot")
    )
    # Always 0, yet no literal: a constant would leave the join keys, and with it the partitioning.
    zero = F.least(F.col("_rows"), F.lit(0)).cast("int")
    cold = firsts.where(F.col("_rows") <= hot_rows).select(*keys, "_first", zero.alias("_part"))
    scattered = 1 + F.pmod(F.xxhash64("seq"), F.lit(_SPREAD)).cast("int")
    part = F.when(F.col("_hot").isNull() & member, 0).otherwise(scattered)
    joined = events.join(F.broadcast(hot), keys, "left").withColumn("_part", part).join(cold, [*keys, "_part"], "left")
    first = F.when(member, F.coalesce("_hot_first", "_first"))
    return joined.withColumn(alias, first).drop("_part", "_hot", "_hot_first", "_first")


def join_unique(rows: DataFrame, unique: DataFrame, key: str, hot_rows: int = HOT_ROWS) -> DataFrame:
    """Inner join of rows, whose `key` may repeat, with a side where it does not.

    Keys of more than `hot_rows` rows, of which at most rows / hot_rows exist, are marked on both sides
    by a broadcast: their rows are spread over copies of the one row they meet.
    """
    counts = rows.groupBy(key).agg(F.count(F.lit(1)).alias("_rows"))
    hot = F.broadcast(counts.where(F.col("_rows") > hot_rows).select(key, F.lit(True).alias("_hot")))
    # The partition id tells apart rows that are equal in every column; it is the same when a task is repeated.
    spread = 1 + F.pmod(F.xxhash64(*rows.columns, F.spark_partition_id()), F.lit(_COPIES)).cast("int")
    left = rows.join(hot, key, "left").withColumn("_part", F.when(F.col("_hot"), spread).otherwise(0)).drop("_hot")
    copies = F.when(F.col("_hot"), F.sequence(F.lit(1), F.lit(_COPIES))).otherwise(F.array(F.lit(0)))
    right = unique.join(hot, key, "left").withColumn("_part", F.explode(copies)).drop("_hot")
    return left.join(right, [key, "_part"]).drop("_part")
