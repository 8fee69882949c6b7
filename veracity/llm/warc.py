"""WARC archives without repeated payloads: revisit resolution by payload digest.

Writing: one narrow header a page (digest, length, id, url) is shuffled by
digest; of equal payloads the page with the smallest id keeps its payload as a
``response``, every other page becomes a ``revisit`` that names it, and fresh
headers go into new gzip archives. Payloads meet in a map-side aggregate, so a
payload that a third of all pages share leaves a map task once.

Reading: archives are parsed as streams (a record at a time), payload digests
are computed again, and revisit headers are joined to the responses by digest
and record id.

The records are plain text columns written by Spark's own text writer with the
record separator CRLF CRLF, so any file system that Spark writes will do, and a
lost task attempt leaves nothing behind.

Defined cases: null html is the empty payload; null url leaves WARC-Target-URI
out, line ends in a url become spaces; null page ids come after all others and
stay null; equal payloads with equal ids are ordered by url, of rows equal in
all three one is the response and the rest revisit it; texts may have any length
that a Spark string may have; an empty table gives archives without records;
further columns are ignored. An archive that ends inside a record gives the
records before and one row of type ``damaged``; a response whose payload does
not fit its digest is ``damaged`` too.
"""

from __future__ import annotations

import base64
import hashlib
import re
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

EOL = "\r\n"
DATE = "2026-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
HTTP = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
#: Records an archive file holds at most.
PER_FILE = 20_000
SCHEMA = ("record_id string, record_type string, page_id long, target_uri string, date string, payload_digest string, "
          "payload_bytes long, refers_to_id string, payload binary, file string")


def digest_of(text: Column) -> Column:
    """Bare upper-case base32 SHA-1 of a string's UTF-8 bytes: five hexadecimal digits are four of base32."""
    hexa = F.sha1(text)
    digits = [F.lpad(F.conv(F.substring(hexa, 5 * i + 1, 5), 16, 32), 4, "0") for i in range(8)]
    return F.translate(F.concat(*digits), "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")


def _record_id(*parts: Column) -> Column:
    """A stable uuid of what a record holds."""
    h = F.md5(F.concat_ws("|", *[F.coalesce(p.cast("string"), F.lit("\0")) for p in parts]))
    return F.concat(F.lit("urn:uuid:"), F.concat_ws("-", *[F.substring(h, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]))


def deduplicate(pages: DataFrame, least: int = 0) -> DataFrame:
    """page_id, url, digest, payload_bytes, record_type, record_id, refers_id, refers_url, payload: one row a record.

    Payloads of fewer than ``least`` bytes are all kept as responses.
    """
    own = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
                       F.coalesce(F.col("html").cast("string"), F.lit("")).alias("payload"))
    own = own.select("page_id", "url", digest_of(F.col("payload")).alias("digest"),
                     F.octet_length("payload").cast("long").alias("payload_bytes"), "payload")
    key = ["digest", "payload_bytes"]
    large = own.filter(F.col("payload_bytes") >= least)
    order = [F.col("page_id").isNull().alias("none"), "page_id", "url"]
    kept = large.groupBy(*key).agg(F.min(F.struct(*order, "payload")).alias("first")).select(*key, "first.*").drop("none")
    first = large.groupBy(*key).agg(F.min(F.struct(*order)).alias("first"))
    headers = large.groupBy(*key, "page_id", "url").agg(F.count(F.lit(1)).alias("times"))
    is_first = F.col("page_id").eqNullSafe(F.col("first.page_id")) & F.col("url").eqNullSafe(F.col("first.url"))
    more = (headers.join(first, key).withColumn("times", F.col("times") - is_first.cast("int")).filter("times > 0")
            .withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("times")))))
    none = F.lit(None).cast("string")
    response_id = _record_id(F.col("digest"), F.col("page_id"), F.col("url"), F.lit("response"))
    responses = kept.select("page_id", "url", *key, F.lit("response").alias("record_type"), response_id.alias("record_id"),
                            none.alias("refers_id"), none.alias("refers_url"), "payload")
    revisits = more.select(
        "page_id", "url", *key, F.lit("revisit").alias("record_type"),
        _record_id(F.col("digest"), F.col("page_id"), F.col("url"), F.lit("revisit"), F.col("copy")).alias("record_id"),
        _record_id(F.col("digest"), F.col("first.page_id"), F.col("first.url"), F.lit("response")).alias("refers_id"),
        F.col("first.url").alias("refers_url"), none.alias("payload"))
    out = responses.unionByName(revisits)
    if least > 0:
        out = out.unionByName(own.filter(F.col("payload_bytes") < least).select(
            "page_id", "url", *key, F.lit("response").alias("record_type"), response_id.alias("record_id"),
            none.alias("refers_id"), none.alias("refers_url"), "payload"))
    return out


def _line(name: str, value: Column) -> Column:
    """A header line, or nothing for a null value."""
    one = F.regexp_replace(value.cast("string"), r"[\r\n]+", " ")
    return F.coalesce(F.concat(F.lit(name + ": "), one, F.lit(EOL)), F.lit(""))


def record_text(date: str = DATE) -> Column:
    """A whole record of ``deduplicate``'s columns, without the CRLF CRLF that ends it."""
    revisit = F.col("record_type") == "revisit"
    body = F.coalesce(F.col("payload"), F.lit(""))
    block = F.concat(F.lit(HTTP), _line("Content-Length", F.col("payload_bytes")), F.lit(EOL), body)
    return F.concat(
        F.lit("WARC/1.1" + EOL), _line("WARC-Type", F.col("record_type")),
        F.concat(F.lit("WARC-Record-ID: <"), F.col("record_id"), F.lit(">" + EOL)),
        _line("WARC-Date", F.lit(date)), _line("WARC-Target-URI", F.col("url")),
        _line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("digest"))),
        F.when(revisit, F.concat(F.lit(f"WARC-Profile: {PROFILE}{EOL}WARC-Refers-To: <"), F.col("refers_id"), F.lit(">" + EOL),
                                 _line("WARC-Refers-To-Target-URI", F.col("refers_url")),
                                 _line("WARC-Refers-To-Date", F.lit(date)))).otherwise(F.lit("")),
        _line("X-Page-Id", F.col("page_id")), F.lit("Content-Type: application/http; msgtype=response" + EOL),
        _line("Content-Length", F.octet_length(block)), F.lit(EOL), block)


def write(records: DataFrame, folder: str, date: str = DATE) -> None:
    """Archives (``*.gz``) of the records in a new folder."""
    (records.select(record_text(date).alias("record")).write.option("lineSep", EOL + EOL).option("compression", "gzip")
     .option("maxRecordsPerFile", PER_FILE).text(folder))


class Damaged(ValueError):
    """An archive that ends inside a record or is none."""


class _Bytes:
    """Bytes of an archive, unzipped in slices (several gzip members follow each other)."""

    def __init__(self, data: bytes, step: int = 1 << 20):
        self.data, self.at, self.step = memoryview(data), 0, step
        self.gzip = bytes(self.data[:2]) == b"\x1f\x8b"
        self.zip = zlib.decompressobj(31) if self.gzip else None
        self.have = bytearray()

    def more(self) -> bool:
        if self.at >= len(self.data):
            return False
        part = self.data[self.at: self.at + self.step]
        self.at += len(part)
        if not self.gzip:
            self.have += part
            return True
        try:
            if self.zip.eof:
                self.zip = zlib.decompressobj(31)
            self.have += self.zip.decompress(part)
        except zlib.error as e:
            raise Damaged(str(e)) from e
        self.at -= len(self.zip.unused_data)
        return True

    def until(self, mark: bytes) -> bytes | None:
        """Bytes before the next ``mark``, which is passed; None at the end of the archive."""
        seen = 0
        while (i := self.have.find(mark, seen)) < 0:
            seen = max(0, len(self.have) - len(mark) + 1)
            if not self.more():
                if self.have.strip() or (self.gzip and not self.zip.eof):
                    raise Damaged("ends inside a header")
                return None
        out = bytes(self.have[:i])
        del self.have[: i + len(mark)]
        return out

    def take(self, n: int) -> bytes:
        while len(self.have) < n:
            if not self.more():
                raise Damaged("ends inside a block")
        out = bytes(self.have[:n])
        del self.have[:n]
        return out


def parse(data: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """(header fields by lower-case name, block) of each record of an archive."""
    source = _Bytes(data)
    while (head := source.until(b"\r\n\r\n")) is not None:
        lines = head.decode("utf-8", "replace").lstrip("\r\n").split(EOL)
        fields = dict(line.split(": ", 1) for line in lines[1:] if ": " in line)
        fields = {k.lower(): v for k, v in fields.items()}
        if not lines[0].startswith("WARC/") or not re.fullmatch(r"\d+", fields.get("content-length", "")):
            raise Damaged("no WARC header")
        block = source.take(int(fields["content-length"]))
        if source.take(4) != b"\r\n\r\n":
            raise Damaged("block longer than its length")
        yield fields, block


def _rows(data: bytes, file: str, payloads: bool) -> Iterator[tuple]:
    try:
        for fields, block in parse(data):
            kind, said = fields.get("warc-type"), fields.get("warc-payload-digest", "").removeprefix("sha1:")
            page, payload, size = fields.get("x-page-id"), None, None
            if kind == "response":
                payload = block.split(b"\r\n\r\n", 1)[-1]
                size = len(payload)
                if base64.b32encode(hashlib.sha1(payload).digest()).decode() != said:
                    kind = "damaged"
            yield (fields.get("warc-record-id", "").strip("<>"), kind, int(page) if page else None, fields.get("warc-target-uri"),
                   fields.get("warc-date"), said, size, fields.get("warc-refers-to", "").strip("<>") or None,
                   payload if payloads else None, file)
    except Damaged:
        yield (None, "damaged", None, None, None, None, None, None, None, file)


def read(spark: SparkSession, folder: str, payloads: bool = False) -> DataFrame:
    """One row a record of the archives in a folder (columns of ``SCHEMA``); payloads only where asked for."""
    names = [f.split()[0] for f in SCHEMA.split(", ")]
    types = [pa.int64() if f.endswith(" long") else pa.binary() if f.endswith(" binary") else pa.string()
             for f in SCHEMA.split(", ")]

    def batch(rows):
        columns = zip(*rows) if rows else [[] for _ in names]
        return pa.record_batch([pa.array(c, t) for c, t in zip(columns, types)], names=names)

    def run(batches):
        for b in batches:
            for i in range(b.num_rows):
                held, size = [], 0
                for row in _rows(b.column(1)[i].as_py(), b.column(0)[i].as_py(), payloads):
                    held.append(row)
                    size += 200 + len(row[8] or b"")
                    if size > 8 << 20:
                        yield batch(held)
                        held, size = [], 0
                yield batch(held)

    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(folder).select("path", "content")
    return files.mapInArrow(run, SCHEMA)


def resolve(records: DataFrame) -> DataFrame:
    """page_id, payload_bytes, payload_digest, record_type, refers_to of response and revisit records.

    Revisits are joined to responses by payload digest and record id; one whose response is missing keeps null in
    payload_bytes and refers_to.
    """
    out = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    narrow = records.select("record_id", "record_type", "page_id", "payload_digest", "payload_bytes", "refers_to_id")
    responses = narrow.filter("record_type = 'response'").withColumn("refers_to", F.lit(None).cast("long"))
    original = responses.select("payload_digest", F.col("record_id").alias("refers_to_id"), F.col("page_id").alias("refers_to"),
                                F.col("payload_bytes").alias("_bytes")).distinct()
    revisits = narrow.filter("record_type = 'revisit'").join(original, ["payload_digest", "refers_to_id"], "left")
    return responses.select(*out).unionByName(revisits.withColumn("payload_bytes", F.col("_bytes")).select(*out))
