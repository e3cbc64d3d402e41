"""Operator 13: WARC archives, written as one gzip member a record and read back by byte ranges.

Reading: the files are cut into byte ranges and a task scans each. It looks for the gzip magic number, takes a place
for the start of a member only if what decodes from it is the header of a WARC record, and owns the records whose
member starts inside its range; the last one may end beyond it. Between members that follow one another nothing is
searched. A member that lies inside another one (an archive stored uncompressed in a record) can be found by a range
that begins there: :func:`genuine` drops what starts before the end of a member of an earlier range.

Writing: of records with equal payloads of at least ``min_bytes`` bytes, the one with the largest id (then the last
stored row) is a ``response``, the others are ``revisit`` records without payload that name it. A task writes files
named after its attempt, and only files in the manifest count, so the files of lost or repeated attempts are never
read. The folder is in ``spark.checkpoint.dir`` unless the caller names one.

A null body counts as empty. A null id is smaller than any other and comes back null; a null url leaves out its
header, and control characters in a url are percent-encoded. Rows that agree in everything are records of their own:
one is the response. An empty table gives an empty manifest and no records. Extra columns don't matter. A member that breaks off
after a good header gives a row with ``error`` and no payload; the scan goes on behind its magic number. A member with
several records gives each, numbered by ``place``. A task holds one block and one batch of ``BATCH_BYTES``.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from graphspark.llm.common import sized_broadcast, text_batches
from graphspark.session import ensure_checkpoint_dir, materialize

MAGIC = b"\x1f\x8b\x08"
#: Bytes of a range; as with any splittable file, a task's share.
SPLIT_BYTES = 32 << 20
#: A task starts another file after so many bytes.
FILE_BYTES = 1 << 30
#: Bytes read and decoded at once, bytes given to the decoder at once, and payload bytes of one Arrow batch.
CHUNK = 1 << 18
PIECE = 1 << 14
BATCH_BYTES = 8 << 20
#: A record's header is never longer; a candidate whose decoded bytes hold no end of a header so far is none.
HEADER_BYTES = 1 << 16
#: Decoded bytes at a time while a header is read, so that damage behind it isn't met before the header is known.
HEADER_STEP = 64
#: At most so many tasks read; beyond that a task takes several ranges, one after the other.
MAX_TASKS = 20_000
DATE = "2000-01-01T00:00:00Z"

RECORD = ("path string, range_start long, start long, end long, place int, type string, record_id string, uri string, "
          "date string, refers_to string, payload_digest string, payload_bytes long, payload binary, error string")
ARROW = pa.schema([(name, {"string": pa.string(), "long": pa.int64(), "int": pa.int32(), "binary": pa.binary()}[kind])
                   for name, kind in (column.split() for column in RECORD.split(", "))])


def digest(payload: bytes) -> str:
    """Base32 SHA-1, as WARC headers hold it."""
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


# ---- reading ----

class Bytes:
    """A file's bytes by place, read forward in chunks."""

    def __init__(self, file):
        self.file, self.size, self.base, self.held = file, file.size(), 0, b""

    def _at(self, place: int, least: int) -> int:
        """Where ``place`` is in what is held; ``least`` bytes follow there unless the file ends."""
        if not self.base <= place <= place + least <= self.base + len(self.held):
            self.file.seek(place)
            self.base, self.held = place, self.file.read(CHUNK)
        return place - self.base

    def piece(self, place: int) -> bytes:
        at = self._at(place, 1)
        return self.held[at:at + PIECE]

    def find(self, place: int, end: int) -> int:
        """The first magic number that starts in [place, end); -1 if there is none."""
        while place < end:
            at = self._at(place, len(MAGIC))
            found = self.held.find(MAGIC, at)
            if found >= 0:
                return self.base + found if self.base + found < end else -1
            if self.base + len(self.held) >= self.size:
                return -1
            place = self.base + len(self.held) - len(MAGIC) + 1
        return -1


class Member:
    """The decoded bytes of the gzip member that starts at a place, a bounded piece at a time."""

    def __init__(self, data: Bytes, start: int):
        self.data, self.next, self.decoder, self.held = data, start, zlib.decompressobj(31), b""

    def more(self, most: int = CHUNK) -> bool:
        """Decode another piece; False at the member's end. ``zlib.error`` if this is no member or a damaged one,
        ``EOFError`` if the file ends in it."""
        if self.decoder.eof:
            return False
        piece = self.decoder.unconsumed_tail
        if not piece:
            piece = self.data.piece(self.next)
            if not piece:
                raise EOFError("the file ends inside a member")
            self.next += len(piece)
        self.held += self.decoder.decompress(piece, most)
        return True

    def end(self) -> int:
        """Where the next member may start (once this one is decoded)."""
        return self.next - len(self.decoder.unused_data)

    def until(self, mark: bytes, most: int) -> bytes | None:
        """Bytes up to the mark, which goes too; None if the first ``most`` bytes don't hold it."""
        while (at := self.held.find(mark, 0, most)) < 0:
            if len(self.held) >= most or not self.more(HEADER_STEP):
                return None
        out, self.held = self.held[:at], self.held[at + len(mark):]
        return out

    def take(self, n: int) -> bytes:
        pieces, there = [], 0
        while there < n:
            if not self.held and not self.more():
                raise EOFError("a member ends inside a record")
            pieces.append(self.held[:n - there])
            there += len(pieces[-1])
            self.held = self.held[len(pieces[-1]):]
        return b"".join(pieces)

    def header(self) -> dict[str, str] | None:
        """The named fields of the record that begins here; None if none does."""
        return fields_of(self.until(b"\r\n\r\n", HEADER_BYTES))

    def goes_on(self) -> bool:
        """Whether anything but line ends follows; these go. At the member's end its check sum has been compared."""
        while True:
            self.held = self.held.lstrip(b"\r\n")
            if self.held or not self.more():
                return bool(self.held)


def fields_of(header: bytes | None) -> dict[str, str] | None:
    """A WARC header's named fields in lower case; None if these bytes are none."""
    if header is None or not header.startswith(b"WARC/"):
        return None
    fields = {}
    for line in header.decode("utf-8", "replace").split("\r\n")[1:]:
        name, colon, value = line.partition(":")
        if not colon:
            return None
        fields.setdefault(name.strip().lower(), value.strip())
    known = {"warc-type", "warc-record-id", "content-length"} <= fields.keys()
    return fields if known and re.fullmatch("[0-9]{1,18}", fields["content-length"]) else None


def record_of(fields: dict[str, str], block: bytes) -> dict:
    """A record's columns: the payload is what follows the HTTP header where there is one."""
    http, payload = b"", block
    if fields.get("content-type", "").replace(" ", "").startswith("application/http"):
        http, _, payload = block.partition(b"\r\n\r\n")
    known = {"payload_digest": digest(payload), "payload_bytes": len(payload), "payload": payload}
    if fields["warc-type"] == "revisit":  # the payload is elsewhere; headers tell what it was
        length = re.search(rb"(?im)^content-length:[ \t]*([0-9]{1,18})[ \t]*\r?$", http)
        known = {"payload_digest": fields.get("warc-payload-digest", "").removeprefix("sha1:") or None,
                 "payload_bytes": int(length[1]) if length else None, "payload": None}
    return {"type": fields["warc-type"], "record_id": fields["warc-record-id"], "uri": fields.get("warc-target-uri"),
            "date": fields.get("warc-date"), "refers_to": fields.get("warc-refers-to"), **known}


def scan(file, first: int, last: int) -> Iterator[dict]:
    """The records of all members that start in [first, last)."""
    data, place = Bytes(file), first
    while (start := data.find(place, last)) >= 0:
        member, n, place = Member(data, start), 0, start + 1
        try:
            fields = member.header()
        except (zlib.error, EOFError):
            continue
        try:
            while fields:
                block = member.take(int(fields["content-length"]))
                more = member.goes_on()
                yield {"start": start, "end": None if more else member.end(), "place": n, **record_of(fields, block)}
                n, fields = n + 1, member.header() if more else None
                if more and not fields:
                    raise EOFError("what follows a record in its member is none")
                if not more:
                    place = member.end()
        except (zlib.error, EOFError) as broken:
            yield {"start": start, "place": n, "error": str(broken)}


def files_in(spark: SparkSession, folder: str, pattern: str = "*.warc.gz") -> DataFrame:
    """path and length of the archives in a folder (their contents aren't read)."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", pattern).load(folder)
    return files.select("path", "length")


def read(files: DataFrame, split_bytes: int = SPLIT_BYTES) -> DataFrame:
    """Rows of ``RECORD`` for all records of ``files`` (path, length); each task takes byte ranges."""
    spark = files.sparkSession
    cuts = F.sequence(F.lit(0).cast("long"), F.col("length") - 1, F.lit(split_bytes).cast("long"))
    ranges = (files.where("length > 0").select("path", F.explode(cuts).alias("_first"))
              .withColumn("_last", F.col("_first") + F.lit(split_bytes)))
    n = files.agg(F.sum(F.ceil(F.col("length") / split_bytes))).first()[0] or 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, held = [], 0
        for batch in batches:
            for path, first, last in zip(*(column.to_pylist() for column in batch.columns)):
                system, place = fs.FileSystem.from_uri(path)
                with system.open_input_file(place) as file:
                    for row in scan(file, first, last):
                        rows.append({"path": path, "range_start": first, **row})
                        held += len(row.get("payload") or b"") + 500
                        if held > BATCH_BYTES:
                            yield pa.RecordBatch.from_pylist(rows, ARROW)
                            rows, held = [], 0
        yield pa.RecordBatch.from_pylist(rows, ARROW)

    return ranges.repartition(min(int(n), MAX_TASKS)).mapInArrow(run, RECORD)


def genuine(records: DataFrame) -> DataFrame:
    """Rows of a stored (and narrowed) :func:`read` without those whose member lies inside another one.

    Members of one range never overlap, as it is scanned in order; so a row goes if its member starts before the
    furthest end that any earlier range of its file saw. One number a range meets in a window by file."""
    ends = records.groupBy("path", "range_start").agg(F.max("end").alias("_end"))
    earlier = Window.partitionBy("path").orderBy("range_start").rowsBetween(Window.unboundedPreceding, -1)
    reach = ends.select("path", "range_start", F.max("_end").over(earlier).alias("_reach")).where("_reach > range_start")
    return (records.join(sized_broadcast(reach), ["path", "range_start"], "left")
            .where("_reach IS NULL OR start >= _reach").select(*records.columns))


# ---- writing ----

def member_of(fields: list[tuple[str, str | None]], block: bytes) -> bytes:
    """A record as one gzip member; fields without value are left out."""
    lines = ["WARC/1.1", *(f"{name}: {value}" for name, value in fields if value is not None),
             f"Content-Length: {len(block)}", "", ""]
    coder = zlib.compressobj(6, zlib.DEFLATED, 31)  # no name and no time in its header: equal bytes each time
    return coder.compress("\r\n".join(lines).encode("utf-8", "replace") + block + b"\r\n\r\n") + coder.flush()


def page_member(record_id: str, uri: str | None, body: bytes, refers_to: str | None) -> bytes:
    """The member of one page: a response, or a revisit of ``refers_to``."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(body)}\r\n\r\n".encode()
    if uri is not None:
        uri = re.sub("[\x00-\x20\x7f\x85\u2028\u2029]", lambda m: "".join(f"%{b:02X}" for b in m[0].encode()), uri)
    fields = [("WARC-Type", "revisit" if refers_to else "response"), ("WARC-Record-ID", record_id),
              ("WARC-Target-URI", uri), ("WARC-Date", DATE), ("WARC-Payload-Digest", f"sha1:{digest(body)}"),
              ("Content-Type", "application/http; msgtype=response")]
    if refers_to:
        fields += [("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"),
                   ("WARC-Refers-To", refers_to)]
    return member_of(fields, http if refers_to else http + body)


def archive(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", body_col: str = "html",
            min_bytes: int = 0, folder: str | None = None) -> DataFrame:
    """Write all pages as WARC files; their manifest (path, length, records).

    Only the hashes of the payloads are shuffled; the pages join those that have copies where these are proven few,
    else in a shuffle whose hot payloads the adaptive skew join splits."""
    spark = pages.sparkSession
    text_batches(spark)
    folder = folder or f"{ensure_checkpoint_dir(spark).rstrip('/')}/warc/{uuid.uuid4().hex}"
    body = F.coalesce(F.col(body_col).cast("string"), F.lit("")).cast("binary")
    stored = materialize(pages.select(F.col(id_col).cast("long").alias("_page"), F.col(url_col).alias("_url"), body.alias("_body"))
                         .withColumn("_sha", F.sha2("_body", 256)).withColumn("_row", F.monotonically_increasing_id()))
    copies = (stored.where(F.octet_length("_body") >= min_bytes).groupBy("_sha")
              .agg(F.max(F.struct("_page", "_row")).alias("_top"), F.count("*").alias("_n")).where("_n > 1")
              .select("_sha", "_top"))
    rows = stored.join(sized_broadcast(copies), "_sha", "left")

    def name(page, row):
        return F.concat(F.lit("<urn:page:"), F.coalesce(page.cast("string"), F.lit("")), F.lit(":"), row.cast("string"), F.lit(">"))

    rows = rows.select("_url", "_body", name(F.col("_page"), F.col("_row")).alias("_record"),
                       F.when(F.col("_top._row") != F.col("_row"), name(F.col("_top._page"), F.col("_top._row"))).alias("_of"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, base = fs.FileSystem.from_uri(folder)
        system.create_dir(base)
        attempt = TaskContext.get().taskAttemptId()
        done, out, length, records = [], None, 0, 0

        def close():
            out.close()
            done.append({"path": f"{folder}/{file}", "length": length, "records": records})

        for batch in batches:
            for url, page, record, of in zip(*(column.to_pylist() for column in batch.columns)):
                if out is None:
                    file = f"pages-{attempt:08d}-{len(done):05d}.warc.gz"
                    out, length, records = system.open_output_stream(f"{base}/{file}", compression=None), 0, 0
                    info = member_of([("WARC-Type", "warcinfo"), ("WARC-Record-ID", f"<urn:info:{file}>"),
                                      ("WARC-Date", DATE), ("Content-Type", "application/warc-fields")],
                                     b"format: WARC File Format 1.1\r\n")
                    length += out.write(info)
                length += out.write(page_member(record, url, page, of))
                records += 1
                if length >= FILE_BYTES:
                    close()
                    out = None
        if out is not None:
            close()
        yield pa.RecordBatch.from_pylist(done, pa.schema([("path", pa.string()), ("length", pa.int64()),
                                                          ("records", pa.int64())]))

    return materialize(rows.mapInArrow(run, "path string, length long, records long"))


def page_of(record_id):
    """The page id inside a record id that :func:`archive` made; null if there was none."""
    digits = F.regexp_extract(record_id, "^<urn:page:(-?[0-9]+):", 1)
    return F.when(digits != "", digits).cast("long")


def round_trip(pages: DataFrame, split_bytes: int = SPLIT_BYTES) -> DataFrame:
    """One row a page, from the archives that :func:`archive` wrote of them."""
    records = materialize(read(archive(pages), split_bytes).drop("payload"))
    records = genuine(records).where(F.col("type").isin("response", "revisit") | F.col("error").isNotNull())
    return records.select(page_of(F.col("record_id")).alias("page_id"), "payload_bytes", "payload_digest",
                          F.col("type").alias("record_type"), page_of(F.col("refers_to")).alias("refers_to"))


# ---- the same rows in SQL ----

def _base32_sql(hexadecimal: str) -> str:
    """Base32 of 40 hexadecimal digits: 32 groups of five bits, each looked up in the alphabet."""
    return (f"(SELECT string_agg(substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + "
            f"((CAST('0x' || substr({hexadecimal} || '0', 1 + (5 * k) // 4, 2) AS INTEGER) >> (3 - (5 * k) % 4)) & 31), 1), "
            f"'' ORDER BY k) FROM range(32) AS places(k))")


ORACLE_SQL = f"""
WITH p AS (SELECT page_id, coalesce(html, '') AS body FROM pages),
s AS (SELECT page_id, body, strlen(body) AS payload_bytes, sha1(body) AS sha,
             row_number() OVER (PARTITION BY body ORDER BY page_id DESC NULLS LAST) AS place,
             first_value(page_id) OVER (PARTITION BY body ORDER BY page_id DESC NULLS LAST) AS top FROM p)
SELECT page_id, payload_bytes, {_base32_sql('sha')} AS payload_digest,
       CASE WHEN place = 1 THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN place > 1 THEN top END AS refers_to
FROM s
"""
