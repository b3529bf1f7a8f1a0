"""JSON array files of any size and layout, read by many tasks.

The text reader cuts a file at every closing brace, so even an array on one line is split by byte range. Whether a
brace is structure or text depends on all that stands before it, but only through two numbers: how many quotation
marks (odd: inside a string) and how deep the nesting. Both are sums, so they compose over the ranges:

1. quotation marks per range, from counts alone, tell whether each range begins inside a string;
2. with that, nesting per range, again from counts alone, tells how deep each range begins;
3. with both, each range finds its elements by itself: one ends at each brace that leads back to depth one.

An element that runs over ranges is put together from the end of one, whole ranges between, and the
beginning of the next. Text moves once, to have the pieces of a range in order; the first two steps move counts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from perennia.schema import CORRUPT_COLUMN, RAW
from perennia.session import cut
from perennia.sources.json_events import parsed_array, position, typed

_RANGE = ("file", "block")


def _pieces(spark: SparkSession, path: str | list[str], glob: str) -> DataFrame:
    """(file, block, line, value): the text up to each closing brace, in the order of its range."""
    text = spark.read.option("pathGlobFilter", glob).option("lineSep", "}").text(path)
    return text.select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("line"),
        "value",
    )


def _segments(value: Column) -> Column:
    """The text between quotation marks, without escaped characters; the brace behind the piece included."""
    return F.split(F.regexp_replace(F.concat(value, F.lit("}")), r"(?s)\\.", ""), '"', -1)


def _nesting(segments: Column, inside: Column) -> Column:
    """By how much a piece that begins inside a string (1) or not (0) deepens the nesting."""
    outside = F.array_join(F.filter(segments, lambda _, i: (i + inside) % 2 == 0), "")
    opened = F.char_length(outside) - F.char_length(F.translate(outside, "{[", ""))
    return opened - F.char_length(outside) + F.char_length(F.translate(outside, "}]", ""))


def _before(column: str, window) -> Column:
    """Sum of the rows before this one."""
    return F.coalesce(F.sum(column).over(window.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))


def _measured(pieces: DataFrame, *columns: str) -> DataFrame:
    """Quotation marks of each piece, and its nesting for both ways it can begin."""
    cut_up = pieces.withColumn("segments", _segments(F.col("value")))
    return cut_up.select(
        *_RANGE,
        "line",
        *columns,
        (F.size("segments") - 1).alias("quotes"),
        _nesting(F.col("segments"), F.lit(0)).alias("nesting_0"),
        _nesting(F.col("segments"), F.lit(1)).alias("nesting_1"),
    )


def _nested(pieces: DataFrame) -> DataFrame:
    """With `nesting` of each piece, given `inside_first` of its range."""
    in_range = Window.partitionBy(*_RANGE).orderBy("line")
    inside = (F.col("inside_first") + _before("quotes", in_range)) % 2
    return pieces.withColumn("inside", inside).withColumn(
        "nesting", F.when(F.col("inside") == 0, F.col("nesting_0")).otherwise(F.col("nesting_1"))
    )


def range_starts(spark: SparkSession, path: str | list[str], glob: str = "*") -> DataFrame:
    """(file, block, inside_first, depth_first, last): how each range of the files begins. One small row per range."""
    along = Window.partitionBy("file").orderBy("block")
    quotes = _pieces(spark, path, glob).select(*_RANGE, (F.size(_segments(F.col("value"))) - 1).alias("quotes"))
    marks = quotes.groupBy(*_RANGE).agg(F.sum("quotes").alias("quotes"))
    marks = cut(marks.select(*_RANGE, (_before("quotes", along) % 2).alias("inside_first")))
    counts = _nested(_measured(_pieces(spark, path, glob)).join(F.broadcast(marks), list(_RANGE)))
    deep = counts.groupBy(*_RANGE).agg(F.sum("nesting").alias("nesting"), F.first("inside_first").alias("inside_first"))
    return cut(
        deep.select(
            *_RANGE,
            "inside_first",
            _before("nesting", along).alias("depth_first"),
            (F.col("block") == F.max("block").over(Window.partitionBy("file"))).alias("last"),
        )
    )


def _elements(spark: SparkSession, path: str | list[str], glob: str) -> DataFrame:
    """(file, block, line, text) of each element, at the place where it ends, and of what stands behind the last."""
    starts = range_starts(spark, path, glob)
    pieces = _measured(_pieces(spark, path, glob), "value").join(F.broadcast(starts), list(_RANGE), "left")
    # Ranges follow from the session's settings; if they changed between two scans nothing may be read wrongly.
    known = F.when(F.col("inside_first").isNull(), F.raise_error(F.lit("the ranges of the files changed while they were read")))
    pieces = pieces.withColumn("inside_first", F.coalesce(known.cast("int"), F.col("inside_first")))
    in_range = Window.partitionBy(*_RANGE).orderBy("line")
    nested = _nested(pieces).withColumn("nesting_before", _before("nesting", in_range))
    # The last piece of a file has no brace behind it.
    is_last = F.col("last") & F.lead("line").over(in_range).isNull()
    depth = F.col("depth_first") + F.col("nesting_before") + F.col("nesting")
    ends = ~is_last & ((F.col("inside") + F.col("quotes")) % 2 == 0) & (depth == 1)
    marked = nested.select(
        *_RANGE,
        "line",
        F.when(is_last, F.col("value")).otherwise(F.concat("value", F.lit("}"))).alias("text"),
        ends.cast("int").alias("ends"),
    )
    numbered = marked.withColumn("element", _before("ends", in_range))
    found = numbered.groupBy(*_RANGE, "element").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("line", "text"))), lambda p: p["text"]), "").alias("text"),
        F.max("line").alias("line"),
        F.max("ends").alias("ends"),
    )
    # The first of a range may have begun before it, the one without an end may go on behind it.
    found = cut(found.withColumn("whole", (F.col("element") > 0) & (F.col("ends") == 1)))
    whole = found.where("whole").select(*_RANGE, "line", "text")
    along = Window.partitionBy("file").orderBy("block", "element")
    parts = found.where("not whole").withColumn("joined", _before("ends", along))
    over = parts.groupBy("file", "joined").agg(
        F.array_sort(F.collect_list(F.struct("block", "element", "line", "text"))).alias("parts")
    )
    last = F.element_at("parts", -1)
    return whole.unionByName(
        over.select(
            "file",
            last["block"].alias("block"),
            last["line"].alias("line"),
            F.array_join(F.transform("parts", lambda p: p["text"]), "").alias("text"),
        )
    )


def read_event_arrays(spark: SparkSession, path: str | list[str], glob: str = "*") -> DataFrame:
    """Files of one JSON array each, of any size and layout, with the columns of `read_events`.

    Where every file is one array of objects the events and their order are those of `read_events`. Where it is not,
    that reader refuses the whole file; this one cannot hold it, and refuses what is wrong: an element that is no
    object, or has junk before it, is one corrupt record, as is what follows the array, or an end that is missing (with
    the last element, if the file ends at its brace). The n good elements around a bad one are n events. A quotation mark too many turns text into structure, so
    elements behind it may be lost in one record up to the next odd one.

    Files are scanned three times, twice for counts. Memory is bounded by one element, and by one range for sorting.
    """
    elements = _elements(spark, path, glob)
    # A bracket stands before the first element of a file, a comma before all others.
    body = F.regexp_replace("text", r"^\s*[\[,]?\s*", "")
    placed = elements.select(*_RANGE, "line", F.col("text").alias("value"), body.alias("body"))
    # Behind the last element there must be the closing bracket, or the whole of an empty array.
    rest = placed.where(~F.col("value").rlike(r"^\s*(\[\s*)?\]\s*$"))
    parsed = rest.select(*_RANGE, "line", "value", parsed_array(F.col("body"), T.ArrayType(RAW)).alias("parsed"))
    event = F.get("parsed.events", F.lit(0))
    good = F.col(f"parsed.{CORRUPT_COLUMN}").isNull() & (F.size("parsed.events") == 1) & event.isNotNull()
    rows = parsed.select(*_RANGE, "line", F.when(~F.coalesce(good, F.lit(False)), F.col("value")).alias(CORRUPT_COLUMN), F.when(good, event).alias("event"))
    flat = rows.select(*_RANGE, "line", CORRUPT_COLUMN, "event.*")
    return typed(flat.withColumn("seq", position(F.col("file"), F.col("block"), F.col("line"), F.lit(0))).drop(*_RANGE, "line"))
