"""Raw events from JSON, batch or streaming.

The total order of events is a struct column `seq`: raw event time first (compared as text), then
file and position. It is global over all files, so an UPDATE in one file finds its NEW in another.
No sort is run for it; `min_by` and `max_by` consume the order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from perennia.functions.money import parse_amount
from perennia.functions.times import event_date, event_timestamp
from perennia.schema import CORRUPT_COLUMN, RAW, RAW_FIELDS


def position(file: Column, block: Column, pos: Column, item: Column) -> Column:
    return F.struct(
        F.col("event_time").alias("event_time"),
        file.alias("file"),
        block.cast("bigint").alias("block"),
        pos.cast("bigint").alias("pos"),
        item.cast("bigint").alias("item"),
    )


def typed(raw: DataFrame) -> DataFrame:
    """Add the parsed `event_date`, `ts` and `amount`; the raw texts stay."""
    return raw.withColumns(
        {
            "event_date": event_date(F.col("event_time")),
            "ts": event_timestamp(F.col("event_time")),
            "amount": parse_amount(F.col("total_amount")),
        }
    )


def parsed_array(json: Column, kind: T.DataType) -> Column:
    """Struct (events, corrupt record) of `json` as the value of one field: whatever follows the
    value, or is missing from it, makes the whole corrupt."""
    schema = T.StructType([T.StructField("events", kind), T.StructField(CORRUPT_COLUMN, T.StringType())])
    text = F.concat(F.lit('{"events":['), json, F.lit("]}"))
    return F.from_json(text, schema, {"columnNameOfCorruptRecord": CORRUPT_COLUMN})


def explode_arrays(files: DataFrame) -> DataFrame:
    """Typed events of whole JSON array files given as (value, file).

    A file that is not exactly one JSON array, however laid out over lines, gives one row that
    carries its text as corrupt record, and none of its events; a file of no bytes gives none at all.
    """
    parsed = files.select("file", "value", parsed_array(F.col("value"), T.ArrayType(T.ArrayType(RAW))).alias("parsed"))
    good = F.col(f"parsed.{CORRUPT_COLUMN}").isNull() & (F.size("parsed.events") == 1) & F.get("parsed.events", F.lit(0)).isNotNull()
    events = parsed.select(
        "file",
        F.when(good, F.lit(None)).otherwise(F.col("value")).alias(CORRUPT_COLUMN),
        F.when(good, F.get("parsed.events", F.lit(0))).alias("events"),
    )
    rows = events.where(F.col("events").isNull() | (F.size("events") > 0)).select(
        "file", CORRUPT_COLUMN, F.posexplode_outer("events").alias("pos", "event")
    )
    flat = rows.select("file", "pos", CORRUPT_COLUMN, *[F.col(f"event.{name}") for name in RAW_FIELDS])
    zero = F.lit(0)
    ordered = flat.withColumn("seq", position(F.col("file"), zero, F.coalesce("pos", zero), zero))
    return typed(ordered.drop("file", "pos"))


def read_events(spark: SparkSession, path: str | list[str], glob: str = "*") -> DataFrame:
    """Every file of a folder (not of its subfolders), each one JSON array, however laid out.

    Such a file cannot be split: one task holds its text and its events, and Spark refuses files of 2 GB and
    more. Where each element stands on lines of its own, `read_event_lines` reads any size in parallel. A
    missing folder raises, an empty one gives an empty typed DataFrame.
    """
    files = spark.read.option("pathGlobFilter", glob).text(path, wholetext=True)
    return explode_arrays(files.select("value", F.col("_metadata.file_path").alias("file")))


def _body(line: Column) -> Column:
    """A line without the bracket before its events and the comma and bracket behind them.

    Nearly all lines are one event, with or without a comma, and need no pattern.
    """
    open_ = F.regexp_replace(line, r"^\s*\[?\s*", "")
    bare = F.rtrim(open_, F.lit(" \t\n\x0b\f\r,]"))
    behind = F.substring(open_, F.char_length(bare) + 1, F.lit(1 << 30))
    # More than one bracket, or a comma too many, is left for the parser to refuse.
    other = F.when(behind.rlike(r"^\s*,?\s*\]?\s*,?\s*$"), bare).otherwise(open_)
    starts = line.startswith("{")
    return (
        F.when(starts & line.endswith("}"), line)
        .when(starts & line.endswith("},"), F.substring(line, F.lit(1), F.char_length(line) - 1))
        .otherwise(other)
    )


def read_event_lines(spark: SparkSession, path: str | list[str], glob: str = "*") -> DataFrame:
    """One or more whole events per line; splittable at any size.

    That is JSON lines, and JSON arrays whose elements do not run over line ends: the brackets that begin and
    end a line and the comma after it are passed over. A line that is anything else, or has more
    behind its events, becomes one corrupt record.

    The position of a line is that within its split of the file, and a cluster that grows may split the
    file otherwise for a second scan. So store the events with `write_event_log` (as `ingest` does) before
    work that scans them twice, such as dispositions; a fold scans each event once.
    """
    text = spark.read.option("pathGlobFilter", glob).text(path)
    # The id grows with the rows of one split, which is all the order needs after file and split.
    lines = text.select(
        "value",
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("line"),
    )
    parsed = lines.select("file", "block", "line", "value", parsed_array(_body(F.col("value")), T.ArrayType(RAW)).alias("parsed"))
    bad = F.col(f"parsed.{CORRUPT_COLUMN}").isNotNull() | F.col("parsed.events").isNull()
    rows = parsed.select(
        "file",
        "block",
        "line",
        F.when(bad, F.col("value")).alias(CORRUPT_COLUMN),
        F.posexplode_outer(F.when(~bad, F.col("parsed.events"))).alias("item", "event"),
    )
    # Lines of brackets or white space have neither. A filter on the generated rows stays behind the parser.
    some = rows.where(F.col("item").isNotNull() | F.col(CORRUPT_COLUMN).isNotNull())
    flat = some.select("file", "block", "line", "item", CORRUPT_COLUMN, "event.*")
    place = position(F.col("file"), F.col("block"), F.col("line"), F.coalesce("item", F.lit(0)))
    return typed(flat.withColumn("seq", place).drop("file", "block", "line", "item"))


def stream_events(spark: SparkSession, path: str, files_per_trigger: int = 1000) -> DataFrame:
    """JSON array files as they arrive, with the same columns as `read_events`."""
    files = spark.readStream.option("maxFilesPerTrigger", files_per_trigger).text(path, wholetext=True)
    return explode_arrays(files.select("value", F.col("_metadata.file_path").alias("file")))


def to_json_lines(events: DataFrame, *keep: str) -> DataFrame:
    """Events as one JSON text column `value`, besides the columns to keep; missing fields are left out."""
    present = [F.col(name).cast("string").alias(name) for name in RAW_FIELDS if name in events.columns]
    return events.select(*keep, F.to_json(F.struct(*present)).alias("value"))


def from_json_lines(lines: DataFrame) -> DataFrame:
    """Inverse of `to_json_lines`: typed raw fields from a text column `value`, other columns kept."""
    rest = [c for c in lines.columns if c != "value"]
    event = F.from_json(F.col("value"), RAW)
    return typed(lines.select(*rest, event.alias("event")).select(*rest, "event.*"))
