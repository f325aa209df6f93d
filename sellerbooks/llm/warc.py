"""WARC writing with revisit records, and a salvage reader.

Writer: each task packs its rows into ``.warc.gz`` archives of bounded size, one gzip
member a record, and returns a manifest row for each archive it finished. An attempt
that is lost leaves files that no manifest names. Payloads of at least
``REVISIT_BYTES`` bytes that are equal are stored once: the record with the largest
page_id is the response, the others are revisits that refer to it (of equal page_ids,
the last row).

Reader: every record is checked (gzip member and checksum, version line, header,
block length, closing line breaks, payload digest). After a failed check it searches
for the next valid member or, in plain archives, the next valid version line, goes on
from there, and logs the bytes between as a quarantined gap. It reads an archive by
windows, so its memory follows the longest record.

Archives go to the shared folder through ``pyarrow.fs``, which opens the URIs that
Spark's shared folder commonly has (local, hdfs, s3, gs).

Rows are numbered once and written before any of them is compared, so a record and the
revisits that name it agree on its number whatever cores come or go in between. The
reader counts the records of each archive against the manifest: ``read_archives`` adds a
row of kind 'short' where they differ, ``round_trip`` fails.

Defined cases: a NULL payload is empty; a NULL page_id stays NULL and a NULL url is
left out of the header; equal rows are separate records; line breaks inside a url are
percent-encoded; a very long payload is one record, held whole by its task; an empty
table gives an empty manifest; columns other than page_id, url and html, whatever their
names, are not read.
"""

from __future__ import annotations

import base64
import hashlib
import io
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sellerbooks.llm.common import ROW, as_bytes, with_row
from sellerbooks.session import materialise, stage_folder

REVISIT_BYTES = 1000
ARCHIVE_BYTES = 8 << 20
WINDOW = 1 << 16
#: Fixed values of the format.
VERSION = b"WARC/1.1"
MAGIC = b"\x1f\x8b\x08"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

MANIFEST = "path string, records long, bytes long"
RECORDS = (
    "path string, start long, length long, kind string, record_type string, page_id long, url string, "
    "payload_bytes long, payload_digest string, refers_to long, payload binary, reason string"
)
RECORD_SCHEMA = pa.schema(
    [
        ("path", pa.string()), ("start", pa.int64()), ("length", pa.int64()), ("kind", pa.string()),
        ("record_type", pa.string()), ("page_id", pa.int64()), ("url", pa.string()), ("payload_bytes", pa.int64()),
        ("payload_digest", pa.string()), ("refers_to", pa.int64()), ("payload", pa.binary()), ("reason", pa.string()),
    ]
)


def open_folder(uri: str) -> tuple[pa.fs.FileSystem, str]:
    return pa.fs.FileSystem.from_uri(uri)


def _urn(page_id: int | None, row: int) -> str:
    return f"<urn:page:{'' if page_id is None else page_id}:{row}>"


def _page_of(urn: str | None) -> int | None:
    parts = (urn or "").strip("<>").split(":")
    return int(parts[2]) if len(parts) == 4 and parts[2] else None


def build_record(
    row: int, page_id: int | None, url: str | None, payload: bytes, size: int, digest: str, refers: str | None
) -> bytes:
    """One record. A revisit (``refers`` set) carries the header of its payload but not the payload."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n".encode()
    block = http if refers else http + payload
    shown = base64.b32encode(bytes.fromhex(digest)).decode()
    header = [
        ("WARC-Type", "revisit" if refers else "response"),
        ("WARC-Record-ID", _urn(page_id, row)),
        ("WARC-Date", "1970-01-01T00:00:00Z"),
        ("WARC-Payload-Digest", f"sha1:{shown}"),
        ("Content-Type", "application/http;msgtype=response"),
        ("Content-Length", str(len(block))),
    ]
    if url is not None:
        safe = "".join(f"%{ord(c):02X}" if ord(c) < 32 or c == "\x7f" else c for c in url)
        header.insert(1, ("WARC-Target-URI", safe))
    if refers:
        header += [("WARC-Profile", PROFILE), ("WARC-Refers-To", refers)]
    lines = "".join(f"{k}: {v}\r\n" for k, v in header).encode("utf-8", "replace")
    return VERSION + b"\r\n" + lines + b"\r\n" + block + b"\r\n\r\n"


def _member(record: bytes) -> bytes:
    squeeze = zlib.compressobj(4, zlib.DEFLATED, 31)
    return squeeze.compress(record) + squeeze.flush()


def _writer(folder: str, archive_bytes: int):
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = open_folder(folder)
        buffer, count = io.BytesIO(), 0

        def finish() -> pa.RecordBatch:
            name = f"{root.rstrip('/')}/{uuid.uuid4().hex}.warc.gz"
            content = buffer.getvalue()
            with fs.open_output_stream(name, compression=None) as out:
                out.write(content)
            columns = [pa.array([name]), pa.array([count], pa.int64()), pa.array([len(content)], pa.int64())]
            return pa.RecordBatch.from_arrays(columns, names=["path", "records", "bytes"])

        for batch in batches:
            data, offsets = as_bytes(batch.column("payload"))
            view = memoryview(data)
            names = ("_row", "page_id", "url", "size", "digest", "keeper_row", "keeper_page")
            for i, (row, page, url, size, digest, keeper, keeper_page) in enumerate(
                zip(*[batch.column(n).to_pylist() for n in names])
            ):
                payload = bytes(view[offsets[i] : offsets[i + 1]])
                refers = None if keeper is None else _urn(keeper_page, keeper)
                buffer.write(_member(build_record(row, page, url, payload, size, digest, refers)))
                count += 1
                if buffer.tell() >= archive_bytes:
                    yield finish()
                    buffer, count = io.BytesIO(), 0
        if count:
            yield finish()

    return write


def mark_revisits(pages: DataFrame, least: int = REVISIT_BYTES) -> DataFrame:
    """Rows with size and digest; revisits name their response and drop the payload."""
    rows = with_row(
        pages,
        F.col("page_id").cast("long").alias("page_id"),
        F.col("url").cast("string").alias("url"),
        F.coalesce(F.col("html").cast("string"), F.lit("")).alias("payload"),
    )
    sized = rows.withColumn("size", F.octet_length("payload").cast("long")).withColumn("digest", F.sha1("payload"))
    rows = materialise(sized)
    # Of fixed width, and read without the payloads.
    long = rows.filter(F.col("size") >= least).select(ROW, "page_id", "digest")
    repeated = (
        long.groupBy("digest")
        .agg(F.count(F.lit(1)).alias("n"), F.max(F.struct("page_id", ROW)).alias("keeper"))
        .filter("n > 1")
    )
    revisits = (
        long.join(repeated, "digest")
        .filter(F.col(f"keeper.{ROW}") != F.col(ROW))
        .select(F.col(ROW).alias("_revisit"), F.col(f"keeper.{ROW}").alias("keeper_row"), F.col("keeper.page_id").alias("keeper_page"))
    )
    # By row, not by digest: the copies of one page lie in as many tasks as all rows do.
    joined = rows.join(revisits, F.col(ROW) == F.col("_revisit"), "left")
    return joined.select(
        ROW, "page_id", "url", "size", "digest", "keeper_row", "keeper_page",
        F.when(F.col("_revisit").isNotNull(), F.lit("")).otherwise(F.col("payload")).alias("payload"),
    )


def write_archives(pages: DataFrame, archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Write a record for each row of (page_id, url, html); returns the manifest (path, records, bytes)."""
    folder = f"{stage_folder(pages.sparkSession)}/warc/{uuid.uuid4().hex}"
    fs, root = open_folder(folder)
    fs.create_dir(root, recursive=True)
    manifest = materialise(mark_revisits(pages).mapInArrow(_writer(folder, archive_bytes), MANIFEST))
    return manifest.withColumn("folder", F.lit(folder))


class _Broken(Exception):
    pass


class Archive:
    """An archive read by windows of bounded size."""

    def __init__(self, source):
        self.source, self.size = source, source.size()
        self.found: dict[bytes, tuple[int, int]] = {}
        self.window = (-1, b"")

    def at(self, offset: int, size: int) -> bytes:
        return self.source.read_at(min(size, max(0, self.size - offset)), offset) if offset < self.size else b""

    def _window(self, number: int) -> bytes:
        """One of the archive's windows with the start of the next, for matches across its end; the last one is kept."""
        if self.window[0] != number:
            self.window = number, self.at(number * WINDOW, WINDOW + len(MAGIC + VERSION))
        return self.window[1]

    def find(self, needle: bytes, offset: int) -> int:
        """The next place of ``needle``, no longer than a version line, at or after ``offset``, or -1.

        The last answer is kept, so that searches from rising offsets read the archive once.
        """
        if needle in self.found:
            since, place = self.found[needle]
            if since <= offset and (place < 0 or offset <= place):
                return place
        place = -1
        for number in range(offset // WINDOW, -(-self.size // WINDOW)):
            start = number * WINDOW
            place = self._window(number).find(needle, max(0, offset - start))
            if place >= 0:
                place += start
                break
        self.found[needle] = (offset, place)
        return place

    def member(self, offset: int) -> tuple[bytes, int]:
        """The content of the gzip member at ``offset`` and where it ends; its checksum has been verified."""
        if self.at(offset, 3) != MAGIC:
            raise _Broken("no gzip member")
        expand, parts, place = zlib.decompressobj(31), [], offset
        try:
            while not expand.eof:
                window = self.at(place, WINDOW)
                if not window:
                    raise _Broken("truncated member")
                parts.append(expand.decompress(window))
                place += len(window)
        except zlib.error as e:
            raise _Broken(f"bad member: {e}") from None
        return b"".join(parts), place - len(expand.unused_data)


def parse_header(head: bytes) -> dict[str, str]:
    lines = head.split(b"\r\n")
    if lines[0] not in (b"WARC/1.0", b"WARC/1.1"):
        raise _Broken("no version line")
    fields = {}
    for line in lines[1:]:
        name, colon, value = line.partition(b":")
        if not colon or not name.strip():
            raise _Broken("bad header line")
        fields[name.strip().decode("latin-1").lower()] = value.strip().decode("utf-8", "replace")
    if not fields.get("content-length", "").isdigit() or "warc-type" not in fields:
        raise _Broken("header lacks length or type")
    return fields


def check_block(fields: dict[str, str], block: bytes) -> tuple[bytes, int, str]:
    """Payload, its full size and its digest, verified against the header."""
    head, split, payload = block.partition(b"\r\n\r\n")
    if fields.get("content-type", "").startswith("application/http"):
        if not split:
            raise _Broken("no http header")
    else:
        head, payload = b"", block
    stated = fields.get("warc-payload-digest", "")
    said = None
    if stated.startswith("sha1:"):
        try:
            said = base64.b32decode(stated[5:]).hex()
        except ValueError:
            raise _Broken("bad digest field") from None
    if fields["warc-type"] == "revisit":
        sizes = [x.split(b":")[1] for x in head.split(b"\r\n") if x.lower().startswith(b"content-length:")]
        if not sizes or not sizes[0].strip().isdigit() or said is None:
            raise _Broken("revisit lacks size or digest")
        return b"", int(sizes[0]), said
    digest = hashlib.sha1(payload).hexdigest()
    if said is not None and said != digest:
        raise _Broken("payload digest differs")
    return payload, len(payload), digest


def parse_record(content: bytes) -> tuple[dict[str, str], bytes, int, str]:
    """The one record that a member holds."""
    head, split, rest = content.partition(b"\r\n\r\n")
    if not split:
        raise _Broken("header does not end")
    fields = parse_header(head)
    length = int(fields["content-length"])
    if len(rest) != length + 4 or rest[length:] != b"\r\n\r\n":
        raise _Broken("block length differs")
    return (fields, *check_block(fields, rest[:length]))


def _read_one(archive: Archive, offset: int, squeezed: bool):
    if squeezed:
        content, end = archive.member(offset)
        return parse_record(content), end
    if not archive.at(offset, 7).startswith(b"WARC/1."):
        raise _Broken("no version line")
    stop = archive.find(b"\r\n\r\n", offset)
    if stop < 0:
        raise _Broken("header does not end")
    fields = parse_header(archive.at(offset, stop - offset))
    length = int(fields["content-length"])
    start = stop + 4
    if start + length + 4 > archive.size or archive.at(start + length, 4) != b"\r\n\r\n":
        raise _Broken("block length differs")
    return (fields, *check_block(fields, archive.at(start, length))), start + length + 4


def salvage(archive: Archive) -> Iterator[tuple]:
    """('record', start, end, record) for each valid record and ('gap', start, end, reason) for what lies between."""
    squeezed = archive.at(0, 2) == MAGIC[:2] or archive.find(MAGIC, 0) >= 0 and archive.find(b"WARC/1.", 0) != 0
    mark = MAGIC if squeezed else b"WARC/1."
    offset, bad, reason = 0, None, ""
    while offset < archive.size:
        try:
            record, end = _read_one(archive, offset, squeezed)
        except _Broken as e:
            if bad is None:
                bad, reason = offset, str(e)
            following = archive.find(mark, offset + 1)
            if following < 0:
                break
            offset = following
            continue
        if bad is not None:
            yield "gap", bad, offset, reason
            bad = None
        yield "record", offset, end, record
        offset = end
    if bad is not None:
        yield "gap", bad, archive.size, reason


def _reader(folder_uri: str, with_payload: bool, whole: bool):
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, _ = open_folder(folder_uri)
        rows: list[tuple] = []
        held = 0

        def flush():
            nonlocal rows, held
            batch = pa.RecordBatch.from_arrays(
                [pa.array(list(c), type=f.type) for c, f in zip(zip(*rows), RECORD_SCHEMA)], schema=RECORD_SCHEMA
            )
            rows, held = [], 0
            return batch

        for batch in batches:
            for path, stated in zip(batch.column("path").to_pylist(), batch.column("records").to_pylist()):
                count = 0
                with fs.open_input_file(path) as source:
                    for kind, start, end, what in salvage(Archive(source)):
                        if kind == "gap":
                            rows.append((path, start, end - start, kind, *[None] * 7, what))
                        else:
                            fields, payload, size, digest = what
                            rows.append(
                                (
                                    path, start, end - start, kind, fields["warc-type"],
                                    _page_of(fields.get("warc-record-id")), fields.get("warc-target-uri"), size, digest,
                                    _page_of(fields.get("warc-refers-to")), payload if with_payload else None, None,
                                )
                            )
                            held += size * with_payload
                            count += 1
                        if len(rows) >= 10_000 or held >= ARCHIVE_BYTES:
                            yield flush()
                if stated is not None and count != stated:
                    reason = f"{count} of {stated} records"
                    if whole:
                        raise RuntimeError(f"{path}: {reason}")
                    rows.append((path, 0, 0, "short", *[None] * 7, reason))
        if rows:
            yield flush()

    return read


def read_archives(manifest: DataFrame, folder: str, with_payload: bool = True, whole: bool = False) -> DataFrame:
    """Records (kind 'record'), quarantined gaps (kind 'gap') and archives with another number of records than stated (kind 'short').

    ``manifest`` has a column path, and records where their number is known; ``folder``
    names their file system. With ``whole`` a short archive fails the job. Archives are
    dealt out at random, a few to a task.
    """
    stated = F.col("records") if "records" in manifest.columns else F.lit(None)
    paths = manifest.select("path", stated.cast("long").alias("records"))
    tasks = manifest.sparkSession.sparkContext.defaultParallelism * 4
    return paths.repartition(tasks).mapInArrow(_reader(folder, with_payload, whole), RECORDS)


def round_trip(pages: DataFrame, with_payload: bool = False) -> DataFrame:
    """Write ``pages`` to archives and read those back, every record of them."""
    folder = stage_folder(pages.sparkSession)
    return read_archives(write_archives(pages), folder, with_payload, whole=True)


#: The same result in check SQL.
CHECK_SQL = f"""
WITH p AS (
  SELECT page_id, CAST(octet_length(encode(coalesce(html, ''))) AS BIGINT) AS payload_bytes, sha1(coalesce(html, '')) AS payload_digest
  FROM pages),
m AS (SELECT payload_digest, max(page_id) AS keeper FROM p WHERE payload_bytes >= {REVISIT_BYTES} GROUP BY payload_digest)
SELECT p.page_id, p.payload_bytes, p.payload_digest,
  CASE WHEN m.keeper IS NULL OR m.keeper = p.page_id THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN m.keeper <> p.page_id THEN m.keeper END AS refers_to
FROM p LEFT JOIN m ON p.payload_digest = m.payload_digest AND p.payload_bytes >= {REVISIT_BYTES}
"""
