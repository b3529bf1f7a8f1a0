"""Site-visit tags: an array of objects or one object, both read as array<map>."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def normalise_tags(tags: Column) -> Column:
    """Raw JSON text of either shape to ARRAY<MAP<STRING,STRING>>; NULL stays NULL."""
    many = F.from_json(tags, "array<map<string,string>>")
    one = F.array(F.from_json(tags, "map<string,string>"))
    return F.when(F.ltrim(tags).startswith("["), many).when(tags.isNotNull(), one)


def explode_tags(visits: DataFrame, key: str = "key", tags: str = "tags") -> DataFrame:
    """One row (key, name, value) per tag."""
    maps = visits.select(F.col(key), F.explode(normalise_tags(F.col(tags))).alias("tag"))
    return maps.select(F.col(key), F.explode("tag").alias("name", "value"))
