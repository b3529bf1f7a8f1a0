"""Helpers that several operators share."""

from __future__ import annotations

import string
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from perennia.session import work_folder


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def cut(rows: DataFrame) -> DataFrame:
    """The same rows, stored below the shared checkpoint folder, without their lineage."""
    context = rows.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(work_folder(rows.sparkSession, "checkpoints"))
    return rows.checkpoint()


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def filled(text: Column) -> Column:
    return F.coalesce(text, F.lit(""))


def ascii_lower(text: Column) -> Column:
    """A-Z lower-cased, everything else as it is; texts without other letters take the quick way."""
    plain = F.octet_length(text) == F.char_length(text)
    return F.when(plain, F.lower(text)).otherwise(
        F.translate(text, string.ascii_uppercase, string.ascii_lowercase)
    )


def sha256(text: Column) -> Column:
    return F.sha2(F.encode(text, "UTF-8"), 256)


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """`body(value)` with the value worked out once, however often the body names it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


#: Characters of one block of a text, as a power of two.
_BLOCK_BITS = 11


def unused(name: str, rows: DataFrame) -> str:
    """`name`, made longer until no column of `rows` is called so."""
    taken = {c.lower() for c in rows.columns}
    while name.lower() in taken:
        name += "_"
    return name


def blocks_of(text: Column) -> Column:
    """A text as an array of blocks of equally many characters, the last one shorter."""
    return F.regexp_extract_all(text, F.lit(f"(?s).{{1,{1 << _BLOCK_BITS}}}+"), F.lit(0))


def between(blocks: Column, start: Column, end: Column) -> Column:
    """The characters from `start` to `end` (exclusive) of a text given as `blocks_of` it.

    `substring` of a text walks to its place from the beginning, this one from the beginning of a block.
    """
    first, last = F.shiftright(start, _BLOCK_BITS), F.shiftright(end - 1, _BLOCK_BITS)
    held = F.array_join(F.slice(blocks, (first + 1).cast("int"), (last - first + 1).cast("int")), "")
    place = (start - F.shiftleft(first, _BLOCK_BITS) + 1).cast("int")
    return F.when(start < end, F.substring(held, place, (end - start).cast("int"))).otherwise("")


def _running(values: Column, step: Callable[[Column, Column], Column], block: int) -> Column:
    """For each element of an array of longs what `step`, begun with 0, makes of those before it.

    Appending to one array copies it each time, so it is done in blocks: time stays near the
    length of the array.
    """
    zero = F.lit(0).cast("long")
    none = F.array().cast("array<bigint>")

    def before(array, start):
        return F.aggregate(
            array,
            F.struct(start.alias("at"), none.alias("out")),
            lambda acc, x: F.struct(step(acc["at"], x).alias("at"), F.array_append(acc["out"], acc["at"]).alias("out")),
            lambda acc: acc["out"],
        )

    def total(array):
        return F.aggregate(array, zero, step)

    def blocks(array):
        last = F.floor((F.size(array) - 1) / block).cast("int")
        return F.transform(F.sequence(F.lit(0), last), lambda b: F.slice(array, b * block + 1, block))

    def all_before(parts):
        return F.flatten(F.zip_with(parts, before(F.transform(parts, total), zero), before))

    return let(values, lambda array: F.when(F.size(array) > 0, let(blocks(array), all_before)).otherwise(none))


def running_sums(values: Column, block: int = 256) -> Column:
    """For each element of an array of longs the sum of those before it."""
    return _running(values, lambda acc, x: acc + x, block)


def running_maxima(values: Column, block: int = 256) -> Column:
    """For each element of an array of longs the largest of those before it, and at least 0."""
    return _running(values, lambda acc, x: F.greatest(acc, x), block)
