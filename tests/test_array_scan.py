"""Array files read by many tasks against the reader of whole files."""

import json
import random

import pytest
from fixtures import D1_EVENTS, customer
from helpers import LAYOUTS, array_text, write_array
from pyspark.sql import functions as F

from perennia import entities, read_events
from perennia.schema import RAW_FIELDS
from perennia.sources.array_scan import range_starts, read_event_arrays


@pytest.fixture
def small_ranges(spark):
    """Ranges of a few hundred bytes, so that elements and strings run over them."""
    before = spark.conf.get("spark.sql.files.maxPartitionBytes"), spark.conf.get("spark.sql.files.openCostInBytes")

    def set_to(size):
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
        spark.conf.set("spark.sql.files.openCostInBytes", size)

    yield set_to
    spark.conf.set("spark.sql.files.maxPartitionBytes", before[0])
    spark.conf.set("spark.sql.files.openCostInBytes", before[1])


def rows(log):
    """Raw fields in the order of the events."""
    return [tuple(r) for r in log.orderBy("seq").select("_corrupt_record", *RAW_FIELDS).collect()]


def tricky(n, seed):
    """Events whose texts hold braces, brackets, quotation marks and back-slashes, and nested tags."""
    rng = random.Random(seed)
    junk = ['{"', '"}', "}", "{", "[", "],", "\\", '\\"', "é", "\n", "\t", "}{", '"', "end\\"]
    out = []
    for i in range(n):
        name = "".join(rng.choice(junk) for _ in range(rng.randint(0, 12)))
        event = customer(f"c{i}", "2018-01-01T00:00:00.000Z", name, "X", "Y")
        if rng.random() < 0.5:
            event["tags"] = rng.choice([{}, [], {name: name}, [{"a": {"b": [name, {"c": "}"}]}}, {}]])
        out.append(event)
    return out


@pytest.mark.parametrize("layout", LAYOUTS)
@pytest.mark.parametrize("size", [97, 1000, 1 << 20])
def test_equals_the_reader_of_whole_files(spark, folder, small_ranges, layout, size):
    write_array(folder, tricky(60, size), "a.txt", layout)
    write_array(folder, tricky(25, size + 1), "b.txt", layout)
    write_array(folder, D1_EVENTS, "c.txt", layout)
    write_array(folder, [], "d.txt", layout)
    write_array(folder, "[ {} , {} ]", "e.txt")
    write_array(folder, "", "f.txt")
    small_ranges(size)
    split = read_event_arrays(spark, folder)
    assert rows(split) == rows(read_events(spark, folder))
    assert split.select("seq").distinct().count() == split.count() == 117
    if size == 97:
        ranges = range_starts(spark, folder)
        assert ranges.count() > 50 and ranges.where("inside_first = 1").count() > 3


def test_one_element_over_many_ranges(spark, folder, small_ranges):
    long = customer("c", "2018-01-01T00:00:00.000Z", "}{" * 3000, "X", "Y")
    write_array(folder, [D1_EVENTS[0], long, D1_EVENTS[1]], "a.txt", "one line")
    small_ranges(200)
    assert rows(read_event_arrays(spark, folder)) == rows(read_events(spark, folder))


def test_many_tasks_read_one_file(spark, folder, small_ranges):
    time = "2018-01-01T00:00:00.000Z"
    events = [customer("c", time, "first", "X", "Y")] + [customer("c", time, f"n{i}", "X", "Y", "UPDATE") for i in range(3000)]
    write_array(folder, events, "a.txt", "indented")
    small_ranges(20_000)
    log = read_event_arrays(spark, folder)
    assert spark.read.option("lineSep", "}").text(folder).rdd.getNumPartitions() > 10
    assert entities(log).customer.first().last_name == "n2999"
    assert log.count() == 3001


GOOD = '{"type": "IMAGE", "key": "%d"}'


@pytest.mark.parametrize(
    "bad", ["7", '"x"', "null", "[1]", '{"type": }', '{"type" "IMAGE"}', "[[]]", '{"a": {"b": 1}'[:6] + "}"]
)
def test_good_elements_around_a_bad_one(spark, folder, small_ranges, bad):
    """Salvage: what is bad is refused, what follows it is read."""
    elements = [GOOD % i for i in range(10)]
    write_array(folder, "[" + ", ".join([*elements[:5], bad, *elements[5:]]) + "]", "a.txt")
    small_ranges(60)
    found = read_event_arrays(spark, folder).collect()
    keys = sorted(r.key for r in found if r.key)
    corrupt = [r._corrupt_record for r in found if r._corrupt_record]
    assert len(corrupt) == 1 and bad in corrupt[0]
    # What has no brace of its own shares its record with the element behind it.
    assert keys == [str(i) for i in range(10) if bad.startswith("{") or i != 5]


@pytest.mark.parametrize("text, keys", [("[" + GOOD % 1, []), ("[" + GOOD % 1 + "\n", ["1"]), ("[" + GOOD % 1 + "] xx", ["1"]), ("null", []), ("{}", []), ("[" + GOOD % 1 + ", {", ["1"])])
def test_wrong_ends_are_reported(spark, folder, text, keys):
    write_array(folder, text, "a.txt")
    found = read_event_arrays(spark, folder).collect()
    assert [r.key for r in found if r.key] == keys
    assert sum(r._corrupt_record is not None for r in found) == 1


def test_no_files(spark, folder):
    assert read_event_arrays(spark, folder).count() == 0
    assert json.loads(array_text([])) == []
    assert read_event_arrays(spark, folder).columns == read_events(spark, folder).columns
    assert read_event_arrays(spark, folder).where(F.col("seq").isNotNull()).count() == 0
