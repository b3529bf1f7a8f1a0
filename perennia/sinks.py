"""Result and rejects sinks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from perennia.operators.rank import top_x
from perennia.schema import CUSTOMER_FIELDS


def result_document(scored: DataFrame, x: int) -> DataFrame:
    """The x highest customers as one JSON text `value`.

    Shape: [[customer_id, [last name, city, state, revenue per visit, visits per week, ltv]], ...],
    highest first. The x rows are the whole of it, so one row may hold them.
    """
    order = [c for c in ("first_seq", "customer_id") if c in scored.columns]
    numbers = ("revenue_per_visit", "visits_per_week", "ltv")
    row = F.struct((-F.col("ltv")).alias("rank"), *order, *CUSTOMER_FIELDS, *numbers)
    rows = top_x(scored, x).agg(F.array_sort(F.collect_list(row)).alias("rows"))

    def pair(r):
        texts = [r[c].cast("variant") for c in CUSTOMER_FIELDS]
        values = F.array(*texts, *[r[c].cast("double").cast("variant") for c in numbers])
        return F.array(r["customer_id"].cast("variant"), values.cast("variant"))

    return rows.select(F.to_json(F.transform("rows", pair)).alias("value"))


def write_result(scored: DataFrame, x: int, path: str) -> None:
    """Replace `path` by the JSON document of the x highest customers."""
    result_document(scored, x).write.mode("overwrite").text(path)


def write_rejects(rejected: DataFrame, path: str) -> None:
    """Replace the rejects table."""
    rejected.write.mode("overwrite").partitionBy("reason").parquet(path)
