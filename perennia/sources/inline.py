"""Small relations stated as rows, registered for SQL."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession


def inline_relation(spark: SparkSession, rows: Iterable[tuple], schema: str, view: str | None = None) -> DataFrame:
    """Rows as a DataFrame, and as a temp view when a name is given."""
    relation = spark.createDataFrame(list(rows), schema)
    if view:
        relation.createOrReplaceTempView(view)
    return relation
