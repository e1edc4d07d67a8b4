"""WARC archives: a writer with revisit records and a salvage reader.

Archives are files of gzip members, one record each, in the shared folder; a
manifest table names the files of the task attempts that Spark committed, so a
lost executor's half-written files are never read.

The reader checks every member: the gzip stream and its checksum, the version
line, the header, the length and the block digest.  After a failed check it
searches for the next gzip magic or version line, whichever comes first, goes
on where a member or record is sound, and logs the bytes between as a
quarantined gap with the reason.  Inflated bytes are searched for records too;
of a damaged member, those before the fault whose block digest is right count.

Defined results: a null html is an empty payload; equal payloads of at least
``least`` bytes are written once, by the smallest page_id, and revisited by the
others; rows without page_id never are what others refer to; repeated rows of
one page_id and payload are all responses; a null url has no target header;
extra columns are not read.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field
from urllib.parse import quote

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import scratch, written

ARCHIVE_BYTES = 16 << 20
#: Most tasks that read archives at once; each takes its share of any number of them.
MOST_READERS = 100_000
#: Of a member that inflates to more, the records up to there are read.
MOST_RECORD_BYTES = 1 << 30
#: Keys of repeated payloads that are broadcast.
BROADCAST_KEYS = 200_000

#: Fixed values of the format.
VERSION = b"WARC/1.1"
MAGIC = b"\x1f\x8b\x08"
PROFILE = "http://netpreservation.org/warc/1.1/revisit/identical-payload-digest"
DATE = "2024-01-01T00:00:00Z"
_VERSION_LINE = re.compile(rb"WARC/1\.[01]\r\n")


def digest_of(payload: bytes) -> str:
    """Bare upper-case base32 SHA-1."""
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record_id(page_id: int | None) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'page:{page_id}')}>"


def record_bytes(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None = None) -> bytes:
    """One record, uncompressed: the page's response, or a revisit of page refers_to."""
    revisit = refers_to is not None
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    block = http if revisit else http + payload
    lines = [VERSION.decode(), f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: {record_id(page_id)}", f"WARC-Date: {DATE}"]
    if url is not None:
        lines.append("WARC-Target-URI: " + quote(url, safe="".join(map(chr, range(0x21, 0x7F)))))
    if page_id is not None:
        lines.append(f"X-Page-ID: {page_id}")
    if revisit:
        lines += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: {record_id(refers_to)}", f"X-Refers-To-Page-ID: {refers_to}"]
    lines += [f"WARC-Payload-Digest: sha1:{digest_of(payload)}", f"WARC-Block-Digest: sha1:{digest_of(block)}", "Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def member(record: bytes) -> bytes:
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    return packer.compress(record) + packer.flush()


@dataclass
class Record:
    headers: dict[str, str]
    block: bytes

    def __getitem__(self, name: str) -> str | None:
        return self.headers.get(name.lower())

    @property
    def http(self) -> tuple[dict[str, str], bytes]:
        """Headers and body of the HTTP message in the block."""
        head, _, body = self.block.partition(b"\r\n\r\n")
        pairs = (line.partition(b":") for line in head.split(b"\r\n")[1:])
        return {k.strip().lower().decode("latin-1"): v.strip().decode("latin-1") for k, _, v in pairs}, body


@dataclass
class Salvage:
    """Records read, and gaps (start, end, reason) of the archive that gave none."""

    records: list[Record] = field(default_factory=list)
    gaps: list[tuple[int, int, str]] = field(default_factory=list)

    def lost(self, start: int, end: int, reason: str) -> None:
        if end > start:
            self.gaps.append((start, end, reason))


def _inflate(data: memoryview, start: int, most: int) -> tuple[bytes, int, str | None]:
    """What the member at start holds, where it ends, and what is wrong with it: then the bytes before the fault."""
    unpack, out, at, size = zlib.decompressobj(31), [], start, 0
    while not unpack.eof:
        if at >= len(data):
            return b"".join(out), at, "truncated member"
        step = data[at : at + 65536]
        try:
            out.append(unpack.decompress(step))
        except zlib.error as e:
            again = zlib.decompressobj(31)  # the failed call gave nothing: once more up to the fault
            for i in range(start, at, 65536):
                again.decompress(data[i : i + 65536])
            for i in range(len(step)):
                try:
                    out.append(again.decompress(step[i : i + 1]))
                except zlib.error:
                    break
            return b"".join(out), at, f"bad member: {e}"
        at += len(step)
        size += len(out[-1])
        if size > most:
            return b"".join(out), at, "member too large"
    return b"".join(out), at - len(unpack.unused_data), None


def _parse(data: bytes, start: int) -> tuple[Record, int] | str:
    """The record at start and where the next may begin, or what is wrong with it."""
    line = _VERSION_LINE.match(data, start)
    if not line:
        return "no version line"
    stop = data.find(b"\r\n\r\n", start)
    if stop < 0:
        return "header without end"
    if _VERSION_LINE.search(data, line.end(), stop + 2):
        return "header cut off by a record"
    headers: dict[str, str] = {}
    for row in data[line.end() : stop].split(b"\r\n"):
        name, colon, value = row.partition(b":")
        if not colon:
            return "bad header line"
        headers[name.strip().lower().decode("latin-1")] = value.strip().decode("utf-8", "replace")
    try:
        length = int(headers["content-length"])
    except (KeyError, ValueError):
        return "no length"
    begin, end = stop + 4, stop + 4 + length
    if length < 0 or data[end : end + 4] != b"\r\n\r\n":
        return "wrong length"
    block = data[begin:end]
    said = headers.get("warc-block-digest")
    if said is not None and said != f"sha1:{digest_of(block)}":
        return "wrong block digest"
    return Record(headers, block), end + 4


def _plain(data: bytes, offset: int, out: Salvage, locate=None) -> bool:
    """Reads records one after another; whether all bytes gave records."""
    at, bad, reason, clean = 0, None, "", True
    locate = locate or (lambda i: offset + i)
    while at < len(data):
        got = _parse(data, at)
        if isinstance(got, str):
            clean = False
            if bad is None:
                bad, reason = at, got
            nxt = _VERSION_LINE.search(data, at + 1)
            at = nxt.start() if nxt else len(data)
            continue
        if bad is not None:
            out.lost(locate(bad), locate(at), reason)
            bad = None
        record, at = got
        out.records.append(record)
    if bad is not None:
        out.lost(locate(bad), locate(len(data)), reason)
    return clean


def _next_start(data: bytes, at: int) -> int:
    """The first gzip magic or version line from at on, else the end."""
    magic = data.find(MAGIC, at)
    end = magic if magic >= 0 else len(data)
    line = _VERSION_LINE.search(data, at, end)
    return line.start() if line else end


def read_archive(data: bytes, most: int = MOST_RECORD_BYTES) -> Salvage:
    """All records of an archive that can be read, whatever else it holds; of a member that inflates to over most bytes, those up to there."""
    out, view = Salvage(), memoryview(data)
    at, bad, reason = 0, None, ""
    rescued: list[Record] = []  # of damaged members; bytes stored in one as they are come up once more

    def close(end: int) -> None:
        nonlocal bad
        if bad is not None:
            out.lost(bad, end, reason)
            bad = None

    while at < len(data):
        wrong, onward = "no member", at + 1
        if data[at : at + 3] == MAGIC:
            inner, end, wrong = _inflate(view, at, most)
            part = Salvage()
            _plain(inner, 0, part, lambda i, at=at, end=end: at if i == 0 else end)
            if wrong is None and (part.records or _VERSION_LINE.match(inner)):
                close(at)
                out.records += part.records
                out.gaps += part.gaps
                at = end
                continue
            if wrong is None:
                wrong, onward = "member without version line", end
            else:  # without a sound checksum only the block digest vouches for a record
                rescued = [r for r in part.records if r["WARC-Block-Digest"] is not None]
                out.records += rescued
        elif _VERSION_LINE.match(data, at):
            got = _parse(data, at)
            if not isinstance(got, str):
                close(at)
                if got[0] not in rescued:
                    out.records.append(got[0])
                at = got[1]
                continue
            wrong = got
        if bad is None:
            bad, reason = at, wrong
        at = _next_start(data, onward)
    close(len(data))
    return out


def _filesystem(uri: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(uri if "://" in uri else "file://" + uri.removeprefix("file:"))


def _with_origin(pages: DataFrame, least: int) -> DataFrame:
    """page_id, url, html and first: the page whose payload a row repeats, else null."""
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.coalesce(F.col("html").cast("string"), F.lit("")).alias("html"))
    rows = rows.withColumn("d", F.when(F.octet_length("html") >= least, F.sha1("html")))
    groups = rows.select("page_id", "d").filter("d is not null").groupBy("d").agg(F.min("page_id").alias("first"), F.count("*").alias("n"))
    groups = written(groups.filter("n > 1 and first is not null").select("d", "first"), "payload-origins")
    right = F.broadcast(groups) if groups.limit(BROADCAST_KEYS + 1).count() <= BROADCAST_KEYS else groups
    joined = rows.join(right, "d", "left")
    return joined.select("page_id", "url", "html", F.when(F.col("page_id").eqNullSafe(F.col("first")), F.lit(None)).otherwise(F.col("first")).alias("first"))


def write_archives(pages: DataFrame, folder: str, least: int = 0, archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Writes the archives of pages into folder and returns their manifest: path, records, bytes."""

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, base = _filesystem(folder)
        fs.create_dir(base, recursive=True)
        held: list[bytes] = []
        size = 0

        def out() -> pa.RecordBatch:
            name = f"{uuid.uuid4().hex}.warc.gz"
            with fs.open_output_stream(f"{base}/{name}", compression=None) as f:
                for x in held:
                    f.write(x)
            return pa.RecordBatch.from_arrays([pa.array([f"{folder}/{name}"]), pa.array([len(held)], pa.int64()), pa.array([size], pa.int64())], ["path", "records", "bytes"])

        for batch in batches:
            for page_id, url, html, first in zip(*(c for c in batch.columns)):
                x = member(record_bytes(page_id.as_py(), url.as_py(), html.as_py().encode("utf-8", "surrogatepass"), first.as_py()))
                held.append(x)
                size += len(x)
                if size >= archive_bytes:
                    yield out()
                    held, size = [], 0
        if held:
            yield out()

    return written(_with_origin(pages, least).mapInArrow(write, "path string, records long, bytes long"), "warc-manifest")


def read_archives(manifest: DataFrame, most: int = MOST_RECORD_BYTES) -> tuple[DataFrame, DataFrame]:
    """The records of the archives that manifest names, and the gaps that salvage left.

    Records: page_id, url, payload_bytes, payload_digest, record_type, refers_to.
    Gaps: path, gap_start, gap_end, reason.
    """

    def archives(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, Salvage]]:
        for batch in batches:
            for path in batch.column(0).to_pylist():
                fs, at = _filesystem(path)
                with fs.open_input_stream(at, compression=None) as f:
                    yield path, read_archive(f.read(), most)

    def number(x: str | None) -> int | None:
        return None if x is None else int(x)

    def records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, found in archives(batches):
            rows = []
            for r in found.records:
                http, body = r.http
                if r["WARC-Type"] == "response":
                    rows.append((number(r["X-Page-ID"]), r["WARC-Target-URI"], len(body), digest_of(body), "response", None))
                elif r["WARC-Type"] == "revisit":
                    rows.append((number(r["X-Page-ID"]), r["WARC-Target-URI"], int(http["content-length"]), (r["WARC-Payload-Digest"] or "").removeprefix("sha1:"), "revisit", number(r["X-Refers-To-Page-ID"])))
            if rows:
                kinds = (pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64())
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], ["page_id", "url", "payload_bytes", "payload_digest", "record_type", "refers_to"])

    def gaps(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for path, found in archives(batches):
            if found.gaps:
                a, b, why = zip(*found.gaps)
                yield pa.RecordBatch.from_arrays([pa.array([path] * len(a)), pa.array(a, pa.int64()), pa.array(b, pa.int64()), pa.array(why)], ["path", "gap_start", "gap_end", "reason"])

    # one partition for each archive: a few hundred bytes, which adaptive execution would read in one task
    files = manifest.select("path").repartition(max(1, min(MOST_READERS, manifest.count())))
    return (
        files.mapInArrow(records, "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long"),
        files.mapInArrow(gaps, "path string, gap_start long, gap_end long, reason string"),
    )


def query(spark, sf_dir: str) -> DataFrame:
    manifest = write_archives(spark.read.parquet(f"{sf_dir}/pages.parquet"), scratch(spark, "warc"))
    return read_archives(manifest)[0].select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


ORACLE = """
WITH p AS (
  SELECT page_id, coalesce(html, '') AS h FROM pages
), d AS (
  SELECT page_id, strlen(h) AS payload_bytes, sha1(h) AS x, min(page_id) OVER (PARTITION BY h) AS first FROM p
)
SELECT page_id, payload_bytes,
  array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', CAST(1 + ((CAST('0x' || substr(x, CAST(5 * (i // 4) + 1 AS BIGINT), 5) AS BIGINT) >> (15 - 5 * (i % 4))) & 31) AS BIGINT), 1)), '') AS payload_digest,
  CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id <> first THEN first END AS refers_to
FROM d
"""
