"""Exact duplicates by content sort, with DataFrame functions only.

Rows are range-partitioned by their normalised text (Spark samples the splitters), each partition
is sorted externally, and equal texts then lie side by side: the window compares the whole text of
each row with that of its neighbour.

* The range keys are the first `PREFIX` characters, then a hash of the whole text, so the sample of
  splitters that reaches the driver stays small however long the texts, and texts that begin alike
  are still dealt out.
* A text held by more rows than a task should sort is found first by counting hashes. Its rows get
  a third range key, a slice of their identifier, so splitters may fall inside the group. The
  slices (one row each) are then put together. At most `4 * partitions` texts can be that frequent,
  which bounds what is broadcast.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from perennia.llm.common import ascii_lower, cut, filled, partitions, sha256

PREFIX = 32
#: A text is never called frequent with fewer rows.
LEAST_FREQUENT = 64


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: str = "min") -> DataFrame:
    """One row per row of `docs`: id, keep_id, group_size, kept, text_sha256.

    Texts are equal when identical after lower-casing A-Z; null counts as the empty text. `keep`
    names the row of a group that stays: the one with the "min" or the "max" identifier. Of rows
    repeated with that identifier one stays. Null identifiers stay only where the group has no
    other. Other columns of `docs` are not looked at; an empty table gives an empty result.
    """
    spark = docs.sparkSession
    tasks = partitions(spark)
    rows = docs.select(F.col(id_col).alias("id"), filled(F.col(text_col)).alias("text"))
    # Rows that are equal after A-Z lower-casing are equal after lower() as well, which is cheaper.
    mark = F.xxhash64(F.lower("text"))
    threshold = max(LEAST_FREQUENT, rows.count() // (4 * tasks))
    frequent = cut(rows.groupBy(mark.alias("frequent")).count().where(F.col("count") > threshold).select("frequent"))
    dealt = (
        rows.withColumn("mark", mark)
        .join(F.broadcast(frequent), F.col("mark") == F.col("frequent"), "left")
        .withColumn("slice", F.when(F.col("frequent").isNotNull(), F.pmod(F.xxhash64("id"), F.lit(tasks))))
        .withColumn("prefix", F.substring(F.lower("text"), 1, PREFIX))
        .select("id", "text", "prefix", "mark", "slice")
        .repartitionByRange("prefix", "mark", "slice")
    )
    group = Window.partitionBy("prefix", "mark", "slice", "content")
    best = {"min": F.min, "max": F.max}[keep]
    order = {"min": F.asc_nulls_last, "max": F.desc_nulls_last}[keep]("id")
    sorted_rows = dealt.select("id", "prefix", "mark", "slice", ascii_lower(F.col("text")).alias("content")).select(
        "id",
        F.col("slice").isNotNull().alias("sliced"),
        sha256(F.col("content")).alias("text_sha256"),
        F.row_number().over(group.orderBy(order)).alias("place"),
        best("id").over(group).alias("slice_keep"),
        F.count(F.lit(1)).over(group).alias("slice_size"),
    )
    out = (F.col("id").alias(id_col), "keep_id", "group_size", "kept", "text_sha256")
    first = (F.col("place") == 1) & F.col("id").eqNullSafe(F.col("keep_id"))
    if frequent.isEmpty():
        whole = sorted_rows.withColumns({"keep_id": F.col("slice_keep"), "group_size": F.col("slice_size")})
        return whole.withColumn("kept", first).select(*out)
    # Slices of one text are put together by its digest; within a slice texts were compared whole.
    sorted_rows = cut(sorted_rows)
    groups = (
        sorted_rows.where("sliced and place = 1")
        .groupBy(F.col("text_sha256").alias("digest"))
        .agg(best("slice_keep").alias("all_keep"), F.sum("slice_size").alias("all_size"))
    )
    return (
        sorted_rows.join(F.broadcast(groups), F.col("sliced") & (F.col("text_sha256") == F.col("digest")), "left")
        .withColumns(
            {
                "keep_id": F.when(F.col("sliced"), F.col("all_keep")).otherwise(F.col("slice_keep")),
                "group_size": F.when(F.col("sliced"), F.col("all_size")).otherwise(F.col("slice_size")),
            }
        )
        .withColumn("kept", first)
        .select(*out)
    )
