"""WARC archives: a writer with revisit records and a splittable reader.

Every record is a gzip member of its own. Tasks write archives below a shared folder and hand on their paths;
only what a finished task has handed on is read, so repeated or lost attempts leave nothing behind that counts.
The reader cuts archives into byte ranges. A task looks for the gzip magic in its range, decodes the header of
each place found (and the record's first line) to tell members from chance, and reads those that start inside the
range to their end, however far that lies behind it, part by part. A member can hold a whole other one unpacked (a
stored archive); such are no records of the archive: what starts before the end of a member of an earlier range is
left out. Archives by others are listed by Spark and read alike. Members that cannot be unpacked to their end are none.

Pages of equal payload share a digest: the one with the smallest id is the response, others are revisits that
refer to it. Missing payloads count as empty. Missing ids never are referred to; pages sharing the smallest id of
a group are all responses. Ids that are no whole numbers count as missing. Missing or odd URLs are written with their control characters encoded. An empty table
gives an empty table. Only the named columns are read.
"""

from __future__ import annotations

import base64
import hashlib
import re
import urllib.parse
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cardwarden.session import scratch_path, settle_table

MAGIC = b"\x1f\x8b\x08"
_PAGE = "urn:x-page:"
#: Bytes of a range, and of the reads behind its end.
RANGE = 4 << 20
AHEAD = 256 << 10
#: Tasks of a reading stage; beyond it a task reads several ranges.
MOST_TASKS = 100_000
RECORD = "record_id string, page_id bigint, record_type string, refers_to bigint, url string, payload_bytes bigint, payload_digest string"


def payload_digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _text(value: str | None) -> str:
    return urllib.parse.quote(value or "", safe="!#$&'()*+,/:;=?@[]~%-._")


def record(page: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None) -> bytes:
    """One uncompressed record. A revisit keeps the HTTP header, whose Content-Length is the full payload's."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    revisit = refers_to is not None
    block = http if revisit else http + payload
    name = f"{_PAGE}{page}" if page is not None else f"urn:uuid:{uuid.uuid4()}"
    lines = [
        "WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: <{name}>",
        "WARC-Date: 1970-01-01T00:00:00Z", f"WARC-Target-URI: {_text(url)}", f"WARC-Payload-Digest: sha1:{digest}",
    ]
    if revisit:
        lines += [
            "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
            f"WARC-Refers-To: <{_PAGE}{refers_to}>",
        ]
    lines += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}", "", ""]
    return "\r\n".join(lines).encode() + block + b"\r\n\r\n"


def member(data: bytes, level: int = 6) -> bytes:
    packer = zlib.compressobj(level, zlib.DEFLATED, 31)
    return packer.compress(data) + packer.flush()


# --------------------------------------------------------------------------- writing
def write_archives(
    pages: DataFrame, folder: str, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html",
    least_bytes: int = 0, level: int = 6,
) -> DataFrame:
    """Write all pages below ``folder``, which all executors share, and return the stored list
    ``(path, bytes, records)`` of finished archives."""
    payload = F.coalesce(F.col(f"`{payload_col}`").cast("string"), F.lit("")).cast("binary")
    rows = pages.select(
        F.col(f"`{id_col}`").try_cast("long").alias("page_id"), F.col(f"`{url_col}`").cast("string").alias("url"), payload.alias("payload")
    ).withColumn("sha", F.sha1("payload"))
    # Only digests are grouped; map-side sums keep a payload that a third of all pages share cheap.
    large = F.length("payload") >= least_bytes
    groups = rows.where(large).groupBy("sha").agg(F.min("page_id").alias("first"), F.count("*").alias("pages"))
    shared = groups.where("pages > 1 and first is not null").select("sha", "first")
    typed = rows.join(shared, "sha", "left").withColumn(
        "refers_to", F.when(large & ~F.col("page_id").eqNullSafe(F.col("first")), F.col("first"))
    )

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        filesystem, base = fs.FileSystem.from_uri(folder)
        filesystem.create_dir(base, recursive=True)
        path, out, records, size = f"{base}/{uuid.uuid4().hex}.warc.gz", None, 0, 0
        for batch in batches:
            pages, urls = batch.column("page_id").to_pylist(), batch.column("url").to_pylist()
            refers = batch.column("refers_to").to_pylist()
            for page, url, raw, sha, refers_to in zip(pages, urls, batch.column("payload"), batch.column("sha"), refers):
                digest = base64.b32encode(bytes.fromhex(sha.as_py())).decode()
                data = member(record(page, url, raw.as_py(), digest, refers_to), level)
                out = out or filesystem.open_output_stream(path, compression=None)
                out.write(data)
                records, size = records + 1, size + len(data)
        if out:
            out.close()
            prefix = folder[: folder.index(base)] if base in folder else ""
            yield pa.RecordBatch.from_pydict({"path": [prefix + path], "bytes": [size], "records": [records]})

    return settle_table(
        typed.select("page_id", "url", "payload", "sha", "refers_to").mapInArrow(write, "path string, bytes bigint, records bigint"),
        "archives",
    )


def list_archives(spark: SparkSession, folder: str) -> DataFrame:
    """``(path, bytes)`` of all files below a folder; contents are not read."""
    return (
        spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(folder).select("path", F.col("length").alias("bytes"))
    )


# --------------------------------------------------------------------------- reading
class _Window:
    """The bytes of a range, read as far as they are asked for."""

    def __init__(self, file, begin: int, size: int):
        self.file, self.size, self.begin = file, size, begin
        self.data = bytearray()

    def need(self, end: int) -> None:
        """Have everything up to file position ``end``, if the file is so long."""
        have = self.begin + len(self.data)
        if end > have and have < self.size:
            self.file.seek(have)
            self.data += self.file.read(min(self.size, max(end, have + AHEAD)) - have)

    def chunks(self, at: int) -> Iterator[bytes]:
        """The file from a position on; what lies behind the bytes in memory is passed on and not kept."""
        have = self.begin + len(self.data)
        while at < have:
            yield bytes(self.data[at - self.begin : at - self.begin + AHEAD])
            at = min(have, at + AHEAD)
        while at < self.size:
            self.file.seek(at)
            chunk = self.file.read(min(AHEAD, self.size - at))
            if not chunk:
                return
            yield chunk
            at += len(chunk)


class Record:
    """Reads a record's content part by part: header, digest and size; the payload is kept only if asked for."""

    def __init__(self, keep: bool = False):
        self.fields: dict[str, str] | None = None
        self._keep, self._head, self._http, self._left = keep, bytearray(), bytearray(), 0
        self._in_payload, self._sha, self._size, self._parts = False, hashlib.sha1(), 0, []

    def feed(self, part: bytes) -> None:
        if self.fields is None:
            tried = max(0, len(self._head) - 3)
            self._head += part
            end = self._head.find(b"\r\n\r\n", tried)
            if end < 0:
                return
            self._start(bytes(self._head[:end]))
            part, self._head = bytes(self._head[end + 4 :]), bytearray()
        part = part[: self._left]
        self._left -= len(part)
        if not self._in_payload:
            tried = max(0, len(self._http) - 3)
            self._http += part
            end = self._http.find(b"\r\n\r\n", tried)
            if end < 0:
                return
            self._in_payload, part = True, bytes(self._http[end + 4 :])
            del self._http[end:]
        self._sha.update(part)
        self._size += len(part)
        if self._keep and part:
            self._parts.append(part)

    def _start(self, head: bytes) -> None:
        found = re.findall(r"^([^:\r\n]+):[ \t]*(.*?)\r?$", head.decode("utf-8", "replace"), re.M)
        self.fields = {k.lower(): v for k, v in found}
        length = self.fields.get("content-length", "").strip()
        self._left = int(length) if re.fullmatch(r"[0-9]+", length) else 0

    def close(self) -> dict:
        """The columns of the record. Digest and size come from the payload itself where the record holds it."""
        if self.fields is None:
            self._start(bytes(self._head))
        fields, revisit = self.fields, self.fields.get("warc-type", "") == "revisit"
        size, digest = self._size, base64.b32encode(self._sha.digest()).decode()
        if revisit:
            length = re.search(rb"(?im)^content-length:[ \t]*(\d+)", self._http)
            size, digest = int(length[1]) if length else None, fields.get("warc-payload-digest", "").removeprefix("sha1:")

        def page(name: str) -> int | None:
            m = re.fullmatch(rf"<{_PAGE}(-?\d+)>", fields.get(name, ""))
            return int(m[1]) if m else None

        return {
            "record_id": fields.get("warc-record-id"), "page_id": page("warc-record-id"), "record_type": fields.get("warc-type", ""),
            "refers_to": page("warc-refers-to"), "url": fields.get("warc-target-uri"), "payload_bytes": size,
            "payload_digest": digest, "payload": None if revisit else b"".join(self._parts),
        }


class _Whole:
    """Keeps a member's content as it is."""

    def __init__(self):
        self._parts: list[bytes] = []
        self.feed = self._parts.append

    def close(self) -> bytes:
        return b"".join(self._parts)


def _inflate(window: _Window, at: int, sink) -> int | None:
    """Feed the member at a file position to ``sink``; where it ends, or None if there is none."""
    unpacker, place, seen = zlib.decompressobj(31), at, b""
    for chunk in window.chunks(at):
        place += len(chunk)
        while chunk and not unpacker.eof:
            try:
                # The first line tells members from chance before anything more is unpacked.
                part = unpacker.decompress(chunk, 5 - len(seen) if len(seen) < 5 else AHEAD)
            except zlib.error:
                return None
            chunk = unpacker.unconsumed_tail
            if len(seen) < 5:
                seen += part
                if not b"WARC/".startswith(seen):
                    return None
            sink.feed(part)
        while not unpacker.eof:  # output held back by the limit
            try:
                part = unpacker.decompress(b"", AHEAD)
            except zlib.error:
                return None
            if not part:
                break
            sink.feed(part)
        if unpacker.eof:
            return place - len(unpacker.unused_data) if len(seen) == 5 else None
    return None


def located_members(file, begin: int, end: int, size: int, sink=_Whole) -> Iterator[tuple[int, int, object]]:
    """``(start, end, what the sink made of it)`` of the members that start in ``[begin, end)``. Those inside a
    member that starts in the range too are skipped; those inside one that starts earlier cannot be told from here."""
    window, at = _Window(file, begin, size), begin
    window.need(min(end + len(MAGIC) - 1, size))
    while at < end:
        found = window.data.find(MAGIC, at - window.begin, min(end, size) - window.begin + len(MAGIC) - 1)
        if found < 0:
            return
        at = window.begin + found
        into = sink()
        until = _inflate(window, at, into)
        if until is None:
            at += 1
        else:
            yield at, until, into.close()
            at = until


def members(file, begin: int, end: int, size: int) -> Iterator[bytes]:
    """Contents of the members that start in ``[begin, end)``."""
    return (content for _, _, content in located_members(file, begin, end, size))


def parse(data: bytes) -> dict:
    """The columns of an unpacked record."""
    whole = Record(keep=True)
    whole.feed(data)
    return whole.close()


def _outermost(found: DataFrame, range_bytes: int) -> DataFrame:
    """Members of stored ``(path, begin, at, until, ...)`` that lie in no other member.

    Members lie beside or inside each other. Those of one range are told apart by its task, so one that is left lies in
    a member that starts before its range: each member is noted at the ranges that begin inside it. Only ranges
    whose first member starts before the farthest such end hold members to leave out; they are stored, and mostly none.
    """
    step = F.lit(range_bytes).cast("long")
    inside = F.sequence(F.col("begin") + step, F.col("until") - 1, step)
    reach = (
        found.where(F.col("begin") + step < F.col("until"))
        .select("path", F.explode(inside).alias("begin"), "until")
        .groupBy("path", "begin")
        .agg(F.max("until").alias("covered"))
    )
    first = found.groupBy("path", "begin").agg(F.min("at").alias("first"))
    open_ranges = settle_table(first.join(reach, ["path", "begin"]).where("first < covered").drop("first"), "covered-ranges")
    kept = found.join(open_ranges, ["path", "begin"], "left")
    return kept.where("covered IS NULL OR at >= covered")


def read_archives(archives: DataFrame, payloads: bool = False, range_bytes: int = RANGE) -> DataFrame:
    """One row per record of the archives ``(path, bytes)``: see ``RECORD``; the payload, if asked for."""
    columns = RECORD + ", payload binary" * payloads
    schema = columns + ", path string, begin bigint, at bigint, until bigint"
    names = [c.split()[0] for c in columns.split(", ")]
    kinds = {"bigint": pa.int64(), "string": pa.string(), "binary": pa.binary()}
    arrow = pa.schema([(c.split()[0], kinds[c.split()[1]]) for c in schema.split(", ")])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, begin, size in zip(*(batch.column(c).to_pylist() for c in ("path", "begin", "bytes"))):
                filesystem, inner = fs.FileSystem.from_uri(path)
                with filesystem.open_input_file(inner) as file:
                    rows, held = [], 0
                    found = located_members(file, begin, min(size, begin + range_bytes), size, lambda: Record(payloads))
                    for at, until, row in found:
                        rows.append({**{n: row[n] for n in names}, "path": path, "begin": begin, "at": at, "until": until})
                        held += 200 + len(row["payload"] or b"")
                        if held > 8 << 20:
                            yield pa.RecordBatch.from_pylist(rows, arrow)
                            rows, held = [], 0
                    if rows:
                        yield pa.RecordBatch.from_pylist(rows, arrow)

    starts = F.explode(F.sequence(F.lit(0).cast("long"), F.greatest(F.col("bytes") - 1, F.lit(0)), F.lit(range_bytes).cast("long")))
    ranges = archives.where("bytes > 0").select("path", "bytes", starts.alias("begin"))
    # A range is a few bytes here and megabytes of work, so tasks are counted, not sized by what is shuffled.
    tasks = min(max(1, ranges.count()), MOST_TASKS)
    found = settle_table(ranges.repartition(tasks, "path", "begin").mapInArrow(read, schema), "members")
    return _outermost(found, range_bytes).select(*names)


def round_trip(pages: DataFrame, least_bytes: int = 0, range_bytes: int = RANGE) -> DataFrame:
    """Pages written as archives in the shared folder and read back."""
    folder = scratch_path(pages.sparkSession, "warc")
    archives = write_archives(pages, folder, least_bytes=least_bytes)
    return read_archives(archives, range_bytes=range_bytes)
