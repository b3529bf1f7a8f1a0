"""Top-k operators; none of them ranks the whole data in one task."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from perennia.session import cut

# Up to this many rank values are broadcast; more are joined by shuffle.
BROADCAST_RANKS = 100_000
_COPIES = 32


def top_x(rows: DataFrame, x: int, by: str = "ltv", ties: tuple[str, ...] = ("first_seq", "customer_id")) -> DataFrame:
    """The x rows with the highest `by`, fewer if there are fewer.

    Equal values keep the order in which their customers first appeared. Runs as
    TakeOrderedAndProject: each task keeps x rows, no full sort.
    """
    order = [F.desc(by), *[F.asc(c) for c in ties if c in rows.columns]]
    return rows.orderBy(*order).limit(x)


def dense_rank_x(
    rows: DataFrame,
    k: int,
    by: str = "ltv",
    rank: str = "rank",
    spread_by: str = "customer_id",
    broadcast_ranks: int = BROADCAST_RANKS,
) -> DataFrame:
    """All rows whose dense rank by `by` descending is at most k, with that rank.

    Ranks the k highest distinct values only and joins them back. A window over all rows would
    bring every row tied within the k ranks, however many, to one task.
    """
    values = rows.select(by).where(F.col(by).isNotNull()).distinct().orderBy(F.desc(by)).limit(k)
    ranked = values.withColumn(rank, F.dense_rank().over(Window.orderBy(F.desc(by))).cast("bigint"))
    if k <= broadcast_ranks:
        return rows.join(F.broadcast(ranked), by, "inner")
    # Very many rows may share one value: each rank is repeated, and those rows are spread over the copies.
    copies = ranked.withColumn("_part", F.explode(F.sequence(F.lit(0), F.lit(_COPIES - 1))))
    part = F.pmod(F.xxhash64(spread_by), F.lit(_COPIES)).cast("int")
    return rows.withColumn("_part", part).join(copies, [by, "_part"], "inner").drop("_part")


def dense_rank_all(rows: DataFrame, by: str = "ltv", rank: str = "rank") -> DataFrame:
    """All rows with the dense rank of `by` descending; no task sees all values.

    The distinct values are range-partitioned and stored; each partition numbers its own, and what lies
    before it is a sum over at most as many counts as there are partitions. Rows meet their value by a join
    whose large partitions AQE splits, so many rows of one value do no harm. A NULL has no rank.
    """
    values = rows.select(by).where(F.col(by).isNotNull()).distinct().repartitionByRange(F.desc(by))
    parted = cut(values.withColumn("_part", F.spark_partition_id()))
    before, offsets = 0, []
    for part in parted.groupBy("_part").count().orderBy("_part").collect():
        offsets += [F.lit(part["_part"]), F.lit(before)]
        before += part["count"]
    if not offsets:
        return rows.withColumn(rank, F.lit(None).cast("bigint"))
    place = F.row_number().over(Window.partitionBy("_part").orderBy(F.desc(by)))
    ranked = parted.select(by, (F.try_element_at(F.create_map(*offsets), F.col("_part")) + place).cast("bigint").alias(rank))
    return rows.join(ranked, by, "left")


def top_per_group(rows: DataFrame, group: str, k: int, by: str = "ltv", tie: str = "customer_id") -> DataFrame:
    """The k highest rows of each group with their position.

    Each task first cuts to k per group (for k up to `windowGroupLimitThreshold`, see `session`).
    """
    window = Window.partitionBy(group).orderBy(F.desc(by), F.asc(tie))
    return rows.withColumn("position", F.row_number().over(window)).where(F.col("position") <= k)
