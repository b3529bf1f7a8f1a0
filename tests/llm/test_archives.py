import gzip
import hashlib
import random

import pytest

from perennia.llm import archives
from perennia.llm.archives import convert, parse_arc, parse_warc, read_arc, read_warc, warc_date, write_arc

DATE = "20240229010203"


def arc(version, *records):
    return archives.member(archives.arc_head(version, DATE)) + b"".join(map(archives.member, records))


@pytest.mark.parametrize("version", [1, 2])
def test_arc_round_trip(version):
    contents = [b"", b"x", b"line\nhttp://a 0.0.0.0 20240101000000 text/html 3\nabc\n", bytes(range(256)) * 40]
    data = arc(version, *[archives.arc_record(version, f"http://a/{i} b", DATE, "text/html", c) for i, c in enumerate(contents)])
    found = list(parse_arc(data + b"\n"))
    assert found[0].url.startswith("filedesc:") and [r.content for r in found[1:]] == contents
    assert [r.url for r in found[1:]] == [f"http://a/{i} b" for i in range(4)]
    assert all(r.fields["date"] == DATE and not r.truncated for r in found)


def test_one_member_for_a_whole_archive_and_damage():
    records = [archives.arc_record(1, f"http://a/{i}", DATE, "text/plain", b"abc") for i in range(3)]
    whole = archives.arc_head(1, DATE) + records[0] + b"damaged line\n" + records[1] + records[2][:-2]
    found = list(parse_arc(gzip.compress(whole)))
    assert [r.content for r in found[1:]] == [b"abc", b"abc", b"ab"] and [r.truncated for r in found] == [False, False, False, True]
    assert list(parse_arc(b"")) == []


def test_dates():
    assert warc_date(DATE) == "2024-02-29T01:02:03Z"
    assert warc_date("20240101") == "2024-01-01T00:00:00Z"
    assert warc_date("20240101235960") == "2024-01-02T00:00:00Z"
    assert warc_date("00000000000000") == "0001-01-01T00:00:00Z"


def test_warc_record_keeps_any_block():
    block = b"\r\n\r\nWARC/1.1\r\n" + bytes(range(256))
    data = archives.member(archives.warc_record([("WARC-Type", "resource"), ("X", "a\r\nb")], block))
    [(fields, got)] = parse_warc(data)
    assert got == block and fields["x"] == "a%0D%0Ab" and fields["warc-type"] == "resource"
    with pytest.raises(ValueError):
        list(parse_warc(archives.member(b"nothing")))


def test_archives_end_when_full(monkeypatch):
    monkeypatch.setattr(archives, "ARCHIVE", 50)
    made = list(archives.archives([bytes([i]) * 20 for i in range(9)], archives.member(b"head")))
    assert len(made) > 2
    assert [r for a in made for _, r in archives.members(a + b"\n") if r != b"head"] == [bytes([i]) * 20 for i in range(9)]
    assert list(archives.archives([], b"head")) == []


def test_pages_to_warc(spark, folder):
    rng = random.Random(2)
    texts = [None, "", "short", "é" * 50, "x" * 99, "x" * 100, "HTTP/1.1 200\r\n\r\n" + "y" * 200, "\r\n\r\nWARC/1.1\r\n" * 30, "long é " * 100_000]
    rows = [(i, rng.choice([None, "http://a b/\n", f"http://h/{i}"]), rng.choice(texts), "p") for i in range(80)]
    rows += [(7, "u", "x" * 100, "p"), (None, "u", "x" * 100, "p")]
    rng.shuffle(rows)
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, payload string").repartition(3)
    write_arc(pages, f"{folder}/arc")
    assert read_arc(spark, f"{folder}/arc").where("url like 'filedesc:%'").count() >= 2
    convert(spark, f"{folder}/arc", f"{folder}/warc")
    found = read_warc(spark, f"{folder}/warc").where("record_type <> 'warcinfo'").collect()
    assert len(found) == len(rows)
    by_digest = {}
    for id_, _, html, _ in rows:
        data = (html or "").encode()
        by_digest.setdefault(hashlib.sha256(data).hexdigest(), []).append((id_, len(data)))
    ids = {r["source_id"]: r["record_id"] for r in found if r["record_type"] == "response"}
    assert len({r["record_id"] for r in found}) == len(found)
    for digest, members in by_digest.items():
        mine = [r for r in found if r["payload_digest"] == digest]
        assert len(mine) == len(members) and {r["payload_bytes"] for r in mine} == {members[0][1]}
        stored = [r for r in mine if r["record_type"] == "response"]
        assert all(hashlib.sha256(r["payload"]).hexdigest() == digest for r in stored)
        if members[0][1] < 100:
            assert len(stored) == len(members)
            continue
        first = min(i for i, _ in members if i is not None)
        assert [r["source_id"] for r in stored] == [first]
        assert all(r["refers_to"] == first and r["refers_to_id"] == ids[first] for r in mine if r["record_type"] == "revisit")


def test_empty_table(spark, folder):
    pages = spark.createDataFrame([], "page_id long, url string, html string")
    write_arc(pages, f"{folder}/arc")
    convert(spark, f"{folder}/arc", f"{folder}/warc")
    assert read_warc(spark, f"{folder}/warc").count() == 0


def test_urls_that_look_like_version_blocks(spark, folder):
    rows = [(i, "filedesc://page" if i % 5 == 2 else f"http://h/{i}", f"html {i} " * 30) for i in range(20)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(2)
    write_arc(pages, f"{folder}/arc")
    assert read_arc(spark, f"{folder}/arc").where("kind = 'version'").count() == 2
    convert(spark, f"{folder}/arc", f"{folder}/warc")
    found = read_warc(spark, f"{folder}/warc").where("record_type = 'response'").collect()
    assert sorted((r["source_id"], r["uri"]) for r in found) == [(i, url) for i, url, _ in rows]


def test_nothing_is_lost_without_a_word(spark, folder, tmp_path):
    """Plain archives, junk between members, a broken member, one cut inside its record line."""
    records = [archives.arc_record(1, f"http://a/{i}", DATE, "text/plain", b"abc%d" % i) for i in range(4)]
    plain = archives.arc_head(1, DATE) + b"".join(records)
    assert [r.content for r in parse_arc(plain)][1:] == [b"abc%d" % i for i in range(4)]
    packed = [archives.member(r) for r in (archives.arc_head(1, DATE), *records)]
    broken = packed[2][:12] + b"\xff\xff\xff" + packed[2][15:]
    cut = archives.member(b"http://a/9 0.0.0.0 2024")
    damage = []
    found = list(parse_arc(packed[0] + packed[1] + b"some junk" + broken + packed[3] + cut, damage))
    assert [r.content for r in found if r.url in ("http://a/0", "http://a/2")] == [b"abc0", b"abc2"]
    assert b"some junk" in b"".join(x for _, x in damage) and damage[-1][1] == b"http://a/9 0.0.0.0 2024"
    assert len(damage) == 3 and damage[0][0] == len(packed[0] + packed[1])
    with pytest.raises(ValueError):
        list(archives.members(b"junk"))
    (tmp_path / "arc").mkdir()
    (tmp_path / "arc" / "plain.arc").write_bytes(plain)
    (tmp_path / "arc" / "bad.arc.gz").write_bytes(packed[0] + b"junk" + packed[1])
    kinds = sorted(r["kind"] for r in read_arc(spark, str(tmp_path / "arc")).collect())
    assert kinds == ["damage"] + ["record"] * 5 + ["version"] * 2
    convert(spark, str(tmp_path / "arc"), f"{folder}/warc")
    types = sorted(r["record_type"] for r in read_warc(spark, f"{folder}/warc").collect())
    assert types == ["metadata"] + ["resource"] * 5 + ["warcinfo"] * 2


def test_members_are_walked_in_linear_time():
    import time

    took = []
    for n in (4_000, 16_000):
        data = archives.member(archives.arc_record(1, "http://a", DATE, "text/plain", random.Random(1).randbytes(300))) * n
        start = time.process_time()
        assert sum(1 for _ in archives.members(data)) == n
        took.append(time.process_time() - start)
    assert took[1] < 10 * took[0] + 0.2
