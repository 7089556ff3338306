"""WARC archives: written through Spark, read back by byte ranges.

Each record is one gzip member. The writer hands the finished members to Spark's text writer, so files get
Spark's commit protocol and file systems: the last byte of a member (the top byte of its size, zero below 16 MB)
is left to the line separator, a zero byte; after a longer member it is a zero byte of padding, which gzip allows.

The reader cuts all files into byte ranges. A task looks for the gzip magic in its range, validates a candidate by
decoding it up to a complete WARC header and on to the end of the member, and owns the records that begin inside the
range. A payload may hold a whole WARC member, and a range may begin inside it; such records lie within
another one, and files of more than one range are checked for that.
"""

from __future__ import annotations

import base64
import hashlib
import re
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lakelog.llm.common import salted_join

MAGIC = b"\x1f\x8b\x08"
RANGE = 64 << 20
READ = 1 << 20
DATE = "2000-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


# ---- writing

def digest(payload: bytes) -> str:
    """SHA-1 in upper-case base32."""
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record(name: str, uri: str | None, payload: bytes, refers_to: str | None, date: str = DATE, level: int = 6) -> bytes:
    """One gzip member: a response, or a revisit of the record named ``refers_to`` with the HTTP head only."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if refers_to is not None else http + payload
    head = ["WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}", f"WARC-Record-ID: <{name}>"]
    head += [f"WARC-Date: {date}", f"WARC-Payload-Digest: sha1:{digest(payload)}"]
    if uri is not None:
        head.append("WARC-Target-URI: " + re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", uri))
    if refers_to is not None:
        head += [f"WARC-Refers-To: <{refers_to}>", f"WARC-Profile: {PROFILE}"]
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}", "\r\n"]
    packer = zlib.compressobj(level, zlib.DEFLATED, 31)
    return packer.compress("\r\n".join(head).encode() + block + b"\r\n\r\n") + packer.flush()


def first_of_equal(pages: DataFrame, id_col: str, payload: Column, min_bytes: int = 0) -> DataFrame:
    """Columns of ``pages`` with ``refers_to``: the smallest id with the same payload where that is another id."""
    hashed = pages.withColumn("sha1", F.unhex(F.sha1(payload))).withColumn("size", F.octet_length(payload))
    narrow = hashed.where(F.col("size") >= min_bytes).select(F.col(f"`{id_col}`").alias("own"), "sha1")
    first = narrow.groupBy("sha1").agg(F.min("own").alias("first"), F.count("*").alias("n")).where("n > 1")
    repeats = salted_join(narrow.withColumn("spread", F.col("own")), first.select("sha1", "first"), ["sha1"], "spread")
    repeats = repeats.where(~F.col("own").eqNullSafe(F.col("first")) & F.col("first").isNotNull())
    repeats = repeats.select("own", F.col("sha1").alias("same"), F.col("first").alias("refers_to")).distinct()
    match = F.col(f"`{id_col}`").eqNullSafe(F.col("own")) & (F.col("sha1") == F.col("same"))
    return hashed.join(repeats.hint("shuffle_hash"), match, "left").drop("own", "same", "sha1", "size")


def write(
    pages: DataFrame,
    path: str,
    id_col: str = "page_id",
    uri_col: str | None = "url",
    text_col: str = "html",
    min_bytes: int = 0,
    date: str = DATE,
) -> None:
    """Write one record for each row of ``pages`` into archives in the folder ``path``.

    The payload is the text in UTF-8, empty if it is null. Of the rows with equal payloads of ``min_bytes`` bytes or
    more, those with the smallest id are responses and the others revisits of it; smaller payloads are all
    responses. Records are named ``urn:page:<id>``; rows that repeat an id are records of one name, and a row with
    a null id is named ``urn:page:`` and is nobody's first. No rows give no records. Other columns are ignored.
    """
    text = F.coalesce(pages[f"`{text_col}`"], F.lit(""))
    uri = F.lit(None).cast("string") if uri_col is None else pages[f"`{uri_col}`"]
    plain = pages.select(pages[f"`{id_col}`"].alias("id"), uri.alias("uri"), text.alias("payload"))

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for row in zip(*(batch.column(c).to_pylist() for c in ("id", "uri", "payload", "refers_to")), strict=True):
                own, link, body, other = row
                name = "urn:page:" + ("" if own is None else str(own))
                member = record(name, link, body.encode(), None if other is None else f"urn:page:{other}", date)
                out.append(member[:-1] if member.endswith(b"\0") else member)
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], ["member"])

    linked = first_of_equal(plain, "id", F.col("payload"), min_bytes).select("id", "uri", "payload", "refers_to")
    members = linked.mapInArrow(build, "member binary")
    members.select(F.col("member").cast("string").alias("value")).write.option("lineSep", "\0").text(path)


# ---- reading

class Source:
    """A file of any file system that pyarrow knows, read in blocks at any place."""

    def __init__(self, uri: str):
        from pyarrow import fs

        if re.match(r"file:/|/", uri):
            system, path = fs.LocalFileSystem(), re.sub(r"^file:/+", "/", uri)
        else:
            system, path = fs.FileSystem.from_uri(re.sub(r"^s3[an]:", "s3:", uri))
        self.file = system.open_input_file(path)
        self.size = self.file.size()
        self.begin, self.block = 0, b""

    def at(self, place: int) -> bytes:
        """Some bytes from ``place`` on; none at the end."""
        if not self.begin <= place < self.begin + len(self.block):
            self.begin, self.block = place, self.file.read_at(min(READ, max(0, self.size - place)), place)
        return self.block[place - self.begin :]

    def find(self, place: int, end: int) -> int | None:
        """Where the magic stands first, from ``place`` on and before ``end``."""
        while place < end:
            block = self.at(place)
            hit = block.find(MAGIC)
            if hit >= 0:
                return place + hit if place + hit < end else None
            if len(block) < len(MAGIC):
                block = self.file.read_at(READ, place)  # the magic may lie across two blocks
                self.begin, self.block = place, block
                if len(block) < len(MAGIC) or block.find(MAGIC) < 0 and place + len(block) >= self.size:
                    return None
                continue
            place += len(block) - len(MAGIC) + 1
        return None


def _heads(raw: bytes) -> tuple[dict[str, str], int] | None:
    """Header fields (lower-case names) of a WARC record and where its block begins."""
    end = raw.find(b"\r\n\r\n")
    if not raw.startswith(b"WARC/") or end < 0:
        return None
    lines = raw[:end].decode("utf-8", "replace").split("\r\n")[1:]
    fields = {k.strip().lower(): v.strip() for k, _, v in (line.partition(":") for line in lines)}
    return (fields, end + 4) if fields.get("content-length", "").isdigit() else None


def member(source: Source, place: int) -> tuple[bytes, int] | None:
    """The decoded gzip member at ``place`` and its end, if it holds WARC records; else nothing."""
    unpacker, out, at, seen = zlib.decompressobj(31), [], place, b""
    while not unpacker.eof:
        block = source.at(at)
        if not block:
            return None
        try:
            part = unpacker.decompress(block)
        except zlib.error:
            return None
        at += len(block) - len(unpacker.unused_data)
        out.append(part)
        if len(seen) < 5:
            seen = (seen + part)[:5]
            if not b"WARC/".startswith(seen):
                return None
    raw = b"".join(out)
    return None if _heads(raw) is None else (raw, at)


def records(raw: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """Header fields and block of each record of a member."""
    at = 0
    while (head := _heads(raw[at:] if at else raw)) is not None:
        fields, body = head
        end = at + body + int(fields["content-length"])
        yield fields, raw[at + body : end]
        at = end + 4


def _payload(fields: dict[str, str], block: bytes) -> tuple[bytes, int]:
    """The payload of a block and the length of the full one, which a revisit tells in its HTTP head."""
    if not fields.get("content-type", "").startswith("application/http"):
        return block, len(block)
    head, _, body = block.partition(b"\r\n\r\n")
    if fields.get("warc-type") == "revisit":
        told = re.search(rb"(?im)^content-length:\s*(\d+)", head)
        return body, int(told[1]) if told else len(body)
    return body, len(body)


SCHEMA = (
    "path string, start long, end long, record_type string, record_id string, target_uri string, date string,"
    " refers_to string, payload binary, payload_bytes long, payload_digest string"
)
NARROW = "path string, start long, end long"


def _scan(ranges: DataFrame, with_payload: bool, narrow: bool) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, low, high in zip(*(batch.column(k).to_pylist() for k in range(3)), strict=True):
                source, at, rows, held = Source(path), low, [], 0
                while (place := source.find(at, high)) is not None:
                    found = member(source, place)
                    if found is None:
                        at = place + 1
                        continue
                    raw, at = found
                    if narrow:
                        rows.append((path, place, at))
                    else:
                        for fields, block in records(raw):
                            body, size = _payload(fields, block)
                            revisit = fields.get("warc-type") == "revisit"
                            told = fields.get("warc-payload-digest", "").removeprefix("sha1:")
                            bare = lambda k: fields[k].strip("<>") if k in fields else None  # noqa: E731, B023
                            rows.append(
                                (path, place, at, fields.get("warc-type"), bare("warc-record-id"), bare("warc-target-uri"))
                                + (fields.get("warc-date"), bare("warc-refers-to"), body if with_payload else None, size)
                                + (told if revisit else digest(body),)
                            )
                    held += len(raw)
                    if held > 8 << 20 or len(rows) >= 10_000:
                        yield _batch(rows, narrow)
                        rows, held = [], 0
                yield _batch(rows, narrow)

    return ranges.mapInArrow(run, NARROW if narrow else SCHEMA)


def _batch(rows: list[tuple], narrow: bool) -> pa.RecordBatch:
    text, long = pa.string(), pa.int64()
    kinds = [text, long, long] if narrow else [text, long, long, *[text] * 5, pa.binary(), long, text]
    names = [x.split()[0] for x in (NARROW if narrow else SCHEMA).split(",")]
    columns = zip(*rows, strict=True) if rows else [[] for _ in kinds]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)


def read(spark: SparkSession, path: str, size: int = RANGE, with_payload: bool = True) -> DataFrame:
    """All records of the archives in the folder ``path``, whatever the files are called.

    ``start`` and ``end`` are the bytes of the record's gzip member. ``payload_digest`` is worked out from the payload;
    for a revisit, which has none, it is the one of its header, as ``payload_bytes`` is that of its HTTP head. Bytes
    that belong to no valid member are skipped. Records of a member that lies inside another one are not records.
    """
    files = spark.read.format("binaryFile").load(path).select("path", "length")
    low = F.explode(F.sequence(F.lit(0).cast("long"), F.greatest(F.col("length") - 1, F.lit(0)), F.lit(size).cast("long")))
    ranges = files.where("length > 0").select("path", low.alias("low"), "length")
    ranges = ranges.select("path", "low", F.least(F.col("low") + size, "length").alias("high"), "length")
    tasks = max(1, ranges.count())
    found = _scan(ranges.select("path", "low", "high").repartition(tasks, "path", "low"), with_payload, False)
    several = ranges.where(F.col("length") > size).select("path", "low", "high")
    if several.isEmpty():
        return found
    spans = _scan(several.repartition(tasks, "path", "low"), False, True)
    before = Window.partitionBy("path").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    inner = spans.withColumn("reach", F.max("end").over(before)).where("start < reach").select("path", "start")
    return found.join(inner, ["path", "start"], "left_anti")
