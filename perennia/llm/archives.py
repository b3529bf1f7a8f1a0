"""Legacy ARC archives, WARC archives, and the conversion of the first to the second.

Archives are files of gzip members, one per record, as is usual for both formats. Spark writes one file
per row with its text writer (binary content passes through it unchanged; the line feed after the last
member is skipped on reading) and reads whole files of about `ARCHIVE` bytes; records are
parsed one after the other by the lengths that they declare, so a task holds one archive and one record.
"""

from __future__ import annotations

import hashlib
import re
import uuid
import zlib
from collections.abc import Iterable, Iterator
from datetime import datetime, timedelta
from typing import NamedTuple

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from perennia.llm.common import cut

#: Compressed bytes after which an archive ends.
ARCHIVE = 4_000_000
LEVEL = 3
#: Shorter payloads are always stored.
LEAST_REVISIT = 100
NAMESPACE = uuid.uuid5(uuid.NAMESPACE_URL, "urn:perennia:archives")
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
#: Fields of a record line after the URL, by version of the format: fixed by the ARC specification.
ARC_FIELDS = {
    1: ("ip", "date", "type", "length"),
    2: ("ip", "date", "type", "code", "checksum", "location", "offset", "filename", "length"),
}
ARC_NAMES = {
    1: "URL IP-address Archive-date Content-type Archive-length",
    2: "URL IP-address Archive-date Content-type Result-code Checksum Location Offset Filename Archive-length",
}


class ArcRecord(NamedTuple):
    offset: int
    url: str
    fields: dict[str, str]
    content: bytes
    truncated: bool
    #: Whether it is the block that begins the archive and names its version.
    heads: bool = False


def member(record: bytes) -> bytes:
    packer = zlib.compressobj(LEVEL, wbits=31)
    return packer.compress(record) + packer.flush()


#: How much of an archive is unpacked at a time.
SLICE = 1 << 16
MAGIC = b"\x1f\x8b\x08"


def members(data: bytes, damage: list[tuple[int, bytes]] | None = None) -> Iterator[tuple[int, bytes]]:
    """(place, record) of each gzip member; line feeds between members and after the last are skipped.

    What is no member up to the next one, or behind a break in one, goes to `damage` with its place; without such a
    list it raises. A member that is cut off gives what there is of it.
    """
    view, at = memoryview(data), 0
    while at < len(data):
        if data[at] in b"\r\n":
            at += 1
            continue
        unpacker, parts, end = zlib.decompressobj(wbits=31), [], at
        try:
            while end < len(data) and not unpacker.eof:
                piece = view[end : end + SLICE]
                parts.append(unpacker.decompress(piece))
                end += len(piece)
            end -= len(unpacker.unused_data)
        except zlib.error as error:
            if damage is None:
                raise ValueError(f"no gzip member at {at}") from error
            end = data.find(MAGIC, at + 1)
            end = len(data) if end < 0 else end
            damage.append((at, data[at:end]))
        if any(parts) or end == len(data):
            yield at, b"".join(parts)
        at = end


def archives(records: Iterable[bytes], head: bytes = b"") -> Iterator[bytes]:
    """Whole archives of about ARCHIVE bytes, each beginning with the member `head`."""
    parts, size = [], 0
    for record in records:
        if not parts:
            parts, size = [head] * bool(head), 0
        parts.append(member(record))
        size += len(parts[-1])
        if size >= ARCHIVE:
            yield b"".join(parts)
            parts = []
    if parts:
        yield b"".join(parts)


# --- ARC ---------------------------------------------------------------------------------------


def arc_head(version: int, date: str) -> bytes:
    """The version block that begins an archive."""
    body = f"{version} 0 perennia\n{ARC_NAMES[version]}\n\n".encode()
    rest = {1: "text/plain", 2: "text/plain 200 - - 0 archive.arc"}[version]
    return f"filedesc://archive.arc 0.0.0.0 {date} {rest} {len(body)}\n".encode() + body + b"\n"


def arc_record(version: int, url: str, date: str, kind: str, content: bytes) -> bytes:
    rest = {1: kind, 2: f"{kind} 200 - - 0 archive.arc"}[version]
    return f"{url} 0.0.0.0 {date} {rest} {len(content)}\n".encode() + content + b"\n"


def _arc_line(line: bytes, version: int) -> tuple[str, dict[str, str]] | None:
    """URL and fields of a record line, or None; a URL may hold spaces, the other fields may not."""
    names = ARC_FIELDS[version]
    parts = line.decode("utf-8", "replace").rstrip("\r").rsplit(" ", len(names))
    if len(parts) != len(names) + 1 or not re.fullmatch("[0-9]{1,12}", parts[-1]) or not re.fullmatch("[0-9]{8,17}", parts[2]):
        return None
    return parts[0], dict(zip(names, parts[1:]))


def parse_arc(data: bytes, damage: list[tuple[int, bytes]] | None = None) -> Iterator[ArcRecord]:
    """The records of one archive, gzipped by record or as a whole, or plain; damaged lines are passed over up to the next good one.

    What is passed over goes to `damage`, with its place. The first line says which fields follow: it is read by
    version 1, then by version 2, and the block below it names the version for all further lines. Only
    the first record can be that block, whatever the URLs of others say.
    """
    lost = [] if damage is None else damage
    version, first = None, True
    packed = data.startswith(MAGIC) or not data.strip()
    for place, record in members(data, lost) if packed else [(0, data)]:
        at = 0
        while at < len(record):
            end = record.find(b"\n", at)
            end = len(record) if end < 0 else end
            line = record[at:end]
            tried = [version] if version else [2, 1]
            parsed = next((p for v in tried if line.strip() and (p := _arc_line(line, v))), None)
            if parsed is None:
                if line.strip():
                    lost.append((place + at, record[at : end + 1]))
                at = end + 1
                continue
            url, fields = parsed
            length = int(fields["length"])
            content = record[end + 1 : end + 1 + length]
            said = re.match(rb"([12]) ", content) if first and url.startswith("filedesc:") else None
            if said:
                version = int(said[1])
            yield ArcRecord(place + at, url, fields, content, len(content) < length, bool(said))
            first = False
            at = end + 1 + length


# --- WARC --------------------------------------------------------------------------------------


def warc_date(date: str) -> str:
    """An ARC date of 8 to 17 digits as a WARC timestamp; impossible parts are counted on."""
    digits = (date + "0" * 14)[:14]
    year, month, day, hour, minute, second = (int(digits[a:b]) for a, b in ((0, 4), (4, 6), (6, 8), (8, 10), (10, 12), (12, 14)))
    start = datetime(min(max(year, 1), 9990), min(max(month, 1), 12), 1)
    when = start + timedelta(days=max(day, 1) - 1, hours=hour, minutes=minute, seconds=second)
    return when.strftime("%Y-%m-%dT%H:%M:%SZ") if when.year > 999 else f"{when.year:04d}" + when.strftime("-%m-%dT%H:%M:%SZ")


def record_id(key: str) -> str:
    """The same key always gives the same identifier."""
    return f"<urn:uuid:{uuid.uuid5(NAMESPACE, key)}>"


def split_http(content: bytes) -> tuple[bytes, bytes]:
    """Head and payload of a stored HTTP message; what is no such message is all payload."""
    if not content.startswith(b"HTTP/"):
        return b"", content
    head, found, payload = content.partition(b"\r\n\r\n")
    return (head + found, payload) if found else (content, b"")


def warc_record(fields: list[tuple[str, str]], block: bytes) -> bytes:
    lines = "".join(f"{name}: {_one_line(value)}\r\n" for name, value in fields)
    return f"WARC/1.1\r\n{lines}Content-Length: {len(block)}\r\n\r\n".encode() + block + b"\r\n\r\n"


def _one_line(value: str) -> str:
    return re.sub(r"[\x00-\x1f\x7f]", lambda m: f"%{ord(m[0]):02X}", value)


def parse_warc(data: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """Header fields (names in lower case) and block of each record, by declared lengths."""
    for place, record in members(data):
        at = 0
        while at < len(record):
            if not record.startswith(b"WARC/", at):
                raise ValueError(f"no record at {place} + {at}")
            end = record.index(b"\r\n\r\n", at)
            lines = record[at:end].decode("utf-8").split("\r\n")[1:]
            fields = {name.lower(): value.strip() for name, _, value in (x.partition(":") for x in lines)}
            length = int(fields["content-length"])
            yield fields, record[end + 4 : end + 4 + length]
            at = end + 4 + length + 4


# --- on Spark ----------------------------------------------------------------------------------


def _write(archives_: DataFrame, folder: str) -> None:
    """Each row's `content` as a file of its own."""
    text = archives_.select(F.col("content").cast("string"))
    text.write.option("maxRecordsPerFile", 1).option("lineSep", "\n").text(folder)


def _read(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.format("binaryFile").load(folder).select(F.col("path").alias("archive"), "content")


def write_arc(
    pages: DataFrame, folder: str, date: str = "20240101000000", id_col: str = "page_id", url_col: str = "url", html_col: str = "html"
) -> None:
    """Pages as ARC archives of both versions, one HTTP response per row; null html is an empty payload.

    The head of each response carries the page's identifier, a null one none; a null URL is `urn:page`.
    """
    rows = pages.select(F.col(id_col).cast("long").alias("id"), F.col(url_col).alias("url"), F.col(html_col).alias("html"))

    def written(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        version = 1 + TaskContext.get().partitionId() % 2

        def records() -> Iterator[bytes]:
            for batch in batches:
                for id_, url, html in zip(*(batch.column(k) for k in range(3))):
                    id_, url, html = id_.as_py(), url.as_py(), html.as_py() or ""
                    source = "" if id_ is None else f"X-Source-Id: {id_}\r\n"
                    head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=UTF-8\r\n{source}\r\n"
                    name = re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url or "urn:page")
                    yield arc_record(version, name, date, "text/html", (head + html).encode())

        for archive in archives(records(), member(arc_head(version, date))):
            yield pa.RecordBatch.from_arrays([pa.array([archive], pa.binary())], ["content"])

    _write(rows.mapInArrow(written, "content binary"), folder)


ARC_SCHEMA = (
    "archive string, offset long, kind string, url string, ip string, date string, type string, truncated boolean, source_id long, "
    "head binary, payload binary, payload_digest string, payload_bytes long"
)


def read_arc(spark: SparkSession, folder: str, packed: bool = False) -> DataFrame:
    """The records of all ARC archives of a folder, with digest and length of each payload.

    `kind` is "version" for the block that begins an archive, "record", or "damage" for what could not be read, with its
    bytes as payload and no URL. Archives are gzipped or plain. One archive and its records are held by a task. An
    empty folder gives no rows. `packed` payloads are compressed by zlib, for moving them.
    """
    names = [part.split()[0] for part in ARC_SCHEMA.split(", ")]
    kinds = [pa.string(), pa.int64(), *[pa.string()] * 5, pa.bool_(), pa.int64(), pa.binary(), pa.binary(), pa.string(), pa.int64()]

    def described(archive: str, kind: str, r: ArcRecord) -> tuple:
        head, payload = split_http(r.content) if kind == "record" else (b"", r.content)
        source = re.search(rb"^X-Source-Id: (-?[0-9]+)\r$", head, re.M)
        return (
            archive, r.offset, kind, r.url, r.fields.get("ip"), r.fields.get("date"), r.fields.get("type"), r.truncated,
            int(source[1]) if source else None, head, zlib.compress(payload, LEVEL) if packed else payload,
            hashlib.sha256(payload).hexdigest(), len(payload),
        )

    def parsed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for archive, content in zip(batch.column(0), batch.column(1)):
                rows, size, damage = [], 0, []
                for r in parse_arc(content.as_py(), damage):
                    rows.append(described(archive.as_py(), "version" if r.heads else "record", r))
                    size += len(r.content)
                    if size > ARCHIVE:
                        yield _batch(rows, names, kinds)
                        rows, size = [], 0
                rows += [described(archive.as_py(), "damage", ArcRecord(at, "", {}, lost, True)) for at, lost in damage]
                yield _batch(rows, names, kinds)

    return _read(spark, folder).mapInArrow(parsed, ARC_SCHEMA)


def _batch(rows: list[tuple], names: list[str], kinds: list) -> pa.RecordBatch:
    columns = zip(*rows) if rows else [()] * len(names)
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names)


def convert(spark: SparkSession, arc_folder: str, warc_folder: str) -> None:
    """ARC archives to WARC archives: identifiers, timestamps, types and digests are made from the old records.

    Version blocks become warcinfo records, HTTP messages responses, what could not be read metadata (its bytes, and the place
    it had), anything else resources. Of responses with equal payloads of
    at least LEAST_REVISIT bytes, the one with the smallest source identifier (then archive and
    place; no identifier comes last) is stored and the others become revisits of it. Only identifiers
    and digests are grouped; payloads move only to meet that decision.
    """
    records = read_arc(spark, arc_folder, packed=True)
    responses = cut(
        records.where((F.col("payload_bytes") >= LEAST_REVISIT) & (F.length("head") > 0)).select(
            "payload_digest",
            F.struct(F.col("source_id").isNull().alias("none"), "source_id", "archive", "offset", "url", "date").alias("r"),
        )
    )
    first = responses.groupBy("payload_digest").agg(F.min("r").alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1")
    revisits = (
        responses.join(first.drop("n"), "payload_digest")
        .where("r <> first")
        .select(F.col("r.archive").alias("archive"), F.col("r.offset").alias("offset"), "first")
    )
    decided = records.join(revisits, ["archive", "offset"], "left").select(
        "archive", "offset", "kind", "url", "ip", "date", "type", "truncated", "source_id", "head", "payload", "payload_digest", "payload_bytes",
        *[F.col(f"first.{k}").alias(f"first_{k}") for k in ("archive", "offset", "source_id", "url", "date")],
    )

    def written(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def records_() -> Iterator[bytes]:
            for batch in batches:
                for row in zip(*(batch.column(k) for k in range(batch.num_columns))):
                    yield _converted(*[x.as_py() for x in row])

        for archive in archives(records_()):
            yield pa.RecordBatch.from_arrays([pa.array([archive], pa.binary())], ["content"])

    _write(decided.mapInArrow(written, "content binary"), warc_folder)


def _key(source: int | None, archive: str, offset: int) -> str:
    return f"{archive.rsplit('/', 1)[-1]}:{offset}" if source is None else f"source:{source}"


def _converted(
    archive, offset, role, url, ip, date, kind, truncated, source, head, payload, digest, size,
    first_archive, first_offset, first_source, first_url, first_date,
) -> bytes:
    """One WARC record."""
    revisit = first_archive is not None
    other = "revisit" if revisit else "response" if head else "resource"
    made = {"version": "warcinfo", "damage": "metadata"}.get(role, other)
    block = head if revisit else head + zlib.decompress(payload)
    # Rows repeated under one identifier are told apart by their place.
    key = f"{_key(source, archive, offset)}:{archive.rsplit('/', 1)[-1]}:{offset}" if revisit else _key(source, archive, offset)
    # What is passed over has no date; several pieces may have been passed over at one place.
    unique = f"{key}:{role}:{digest}" if role == "damage" else key
    fields = [("WARC-Type", made), ("WARC-Record-ID", record_id(unique)), ("WARC-Date", warc_date(date or ""))]
    if made == "warcinfo":
        fields.append(("WARC-Filename", url.removeprefix("filedesc://")))
    elif made == "metadata":
        fields.append(("X-Passed-Over", f"{archive.rsplit('/', 1)[-1]}:{offset}"))
    else:
        fields += [("WARC-Target-URI", url), ("WARC-IP-Address", ip)]
        fields += [("WARC-Payload-Digest", f"sha256:{digest}"), ("X-Payload-Length", str(size))]
    if source is not None:
        fields.append(("X-Source-Id", str(source)))
    if revisit:
        first = _key(first_source, first_archive, first_offset)
        fields += [("WARC-Profile", PROFILE), ("WARC-Refers-To", record_id(first))]
        fields += [("WARC-Refers-To-Target-URI", first_url), ("WARC-Refers-To-Date", warc_date(first_date))]
        if first_source is not None:
            fields.append(("X-Refers-To-Source-Id", str(first_source)))
    if truncated:
        fields.append(("WARC-Truncated", "unspecified"))
    fields.append(("WARC-Block-Digest", f"sha256:{hashlib.sha256(block).hexdigest()}"))
    fields.append(("Content-Type", "application/http;msgtype=response" if head else "text/plain" if made == "warcinfo" else kind or "application/octet-stream"))
    return warc_record(fields, block)


WARC_SCHEMA = (
    "record_type string, record_id string, date string, uri string, source_id long, payload_bytes long, payload_digest string, "
    "refers_to_id string, refers_to long, payload binary"
)


def read_warc(spark: SparkSession, folder: str) -> DataFrame:
    """The records of all WARC archives of a folder; what a stored block says must agree with its digests.

    Length and digest are those of the full payload, for revisits too; their own payload is null.
    """
    names = [part.split()[0] for part in WARC_SCHEMA.split(", ")]
    kinds = [*[pa.string()] * 4, pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.binary()]

    def whole(text: str | None) -> int | None:
        return None if text is None else int(text)

    def parsed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for archive, content in zip(batch.column(0), batch.column(1)):
                rows, size = [], 0
                for fields, block in parse_warc(content.as_py()):
                    get = fields.get
                    digest = (get("warc-payload-digest") or "").removeprefix("sha256:")
                    if hashlib.sha256(block).hexdigest() != get("warc-block-digest", "").removeprefix("sha256:"):
                        raise ValueError(f"block of {get('warc-record-id')} in {archive} is damaged")
                    kind, payload, length = fields["warc-type"], None, whole(get("x-payload-length"))
                    if kind in ("response", "resource"):
                        payload = split_http(block)[1]
                        length = len(payload)
                        if hashlib.sha256(payload).hexdigest() != digest:
                            raise ValueError(f"payload of {get('warc-record-id')} in {archive} is damaged")
                    rows.append(
                        (kind, fields["warc-record-id"], fields["warc-date"], get("warc-target-uri"), whole(get("x-source-id")), length,
                         digest or None, get("warc-refers-to"), whole(get("x-refers-to-source-id")), payload)
                    )
                    size += len(block)
                    if size > ARCHIVE:
                        yield _batch(rows, names, kinds)
                        rows, size = [], 0
                yield _batch(rows, names, kinds)

    return _read(spark, folder).mapInArrow(parsed, WARC_SCHEMA)
