"""WARC archives: a writer, and a splittable reader.

Writer: tasks write gzip members, one per record, to archives of their own in
the shared folder.  A file counts only if the task that wrote it ended well:
each attempt picks a new name and reports it as a row, and those rows are
committed as a table, the *manifest*.  A lost executor leaves files that no
manifest names.  Of records with equal payloads of at least ``REVISIT_BYTES``,
the one with the smallest id holds the payload and the others are ``revisit``
records that refer to it.

Reader: archives are cut into byte ranges without looking into them.  A task
looks for gzip magic in its range, *validates* a candidate by decoding it (it
must inflate with a correct checksum and begin with a WARC version line), and from
there goes from member to member.  It owns the records whose member begins in its
range, and reads past the range's end to finish the last one.  What follows a valid
member must be another, the end of the file or NUL padding; anything else is a
*damaged* place, which is an error or, if asked for, a row.  The task that owns the
member before it finds it, so each place is found once and none is passed over.

Ranges are dealt to tasks by their number, not by the bytes of the rows that name
them: a range row is tiny, the work behind it is not.
"""

from __future__ import annotations

import hashlib
import uuid
import zlib
from collections.abc import Iterator
from functools import partial

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tessera.llm.common import pick, written
from tessera.session import scratch_path, ship_package

REVISIT_BYTES = 100
#: Bytes of an archive after which the writer begins another.
ARCHIVE_BYTES = 1 << 30
#: Bytes of a reader's range.
SPLIT_BYTES = 4 << 20
#: Most tasks that a reader deals its ranges to.
MAX_TASKS = 20_000
#: Most repeated payloads (40 bytes each) that are broadcast to the writer.
MAX_BROADCAST_DIGESTS = 100_000
#: Capture date of records whose table names none.
DATE = "2000-01-01T00:00:00Z"

MAGIC = b"\x1f\x8b\x08"
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def _filesystem(uri: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri)


def _header_text(value: str) -> str:
    """A header value on one line: control characters become percent escapes."""
    return "".join(c if c >= " " and c != "\x7f" else f"%{ord(c):02X}" for c in value)


def record(kind: str, headers: dict[str, str], block: bytes) -> bytes:
    """One gzip member with one WARC record."""
    lines = ["WARC/1.1", f"WARC-Type: {kind}", *(f"{k}: {_header_text(v)}" for k, v in headers.items()),
             f"Content-Length: {len(block)}"]
    squeeze = zlib.compressobj(1, zlib.DEFLATED, 31)
    return squeeze.compress("\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n") + squeeze.flush()


def page_record(page_id: int | None, url: str | None, payload: bytes, digest: str,
                refers_to: int | None, revisit: bool) -> bytes:
    """Response with the payload, or revisit that keeps the HTTP headers alone."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    headers = {"WARC-Record-ID": f"<urn:page:{'' if page_id is None else page_id}>", "WARC-Date": DATE,
               "Content-Type": "application/http; msgtype=response", "WARC-Payload-Digest": f"sha256:{digest}"}
    if url is not None:
        headers["WARC-Target-URI"] = url
    if revisit:
        headers |= {"WARC-Profile": _PROFILE, "WARC-Refers-To": f"<urn:page:{refers_to}>"}
    return record("revisit" if revisit else "response", headers, http if revisit else http + payload)


def _write(batches: Iterator[pa.RecordBatch], folder: str) -> Iterator[pa.RecordBatch]:
    store, path = _filesystem(folder)
    store.create_dir(path, recursive=True)
    name, out, done = None, None, []

    def close() -> None:
        nonlocal out
        if out is not None:
            out.close()
            done.append((f"{folder}/{name}", store.get_file_info(f"{path}/{name}").size))
            out = None

    for batch in batches:
        for row in batch.to_pylist():
            if out is None:
                name = f"part-{uuid.uuid4().hex}.warc.gz"
                out = store.open_output_stream(f"{path}/{name}", compression=None)
                out.write(record("warcinfo", {"WARC-Record-ID": f"<urn:uuid:{uuid.uuid4()}>", "WARC-Date": DATE,
                                              "Content-Type": "application/warc-fields"},
                                 b"software: tessera\r\nformat: WARC File Format 1.1\r\n"))
            out.write(page_record(row["page_id"], row["url"], row["payload"], row["digest"],
                                  row["refers_to"], row["revisit"]))
            if out.tell() >= ARCHIVE_BYTES:
                close()
    close()
    yield pa.RecordBatch.from_arrays([pa.array([p for p, _ in done], pa.string()),
                                      pa.array([n for _, n in done], pa.int64())], names=["path", "bytes"])


def write_archives(spark: SparkSession, pages: DataFrame, folder: str) -> DataFrame:
    """Write a record per row of ``pages`` below ``folder``; the manifest (path, bytes).

    A null html has an empty payload.  Rows that repeat the smallest id of a
    payload are all responses; a null id is larger than any, and a payload that
    no row with an id has is always a response.
    """
    rows = pick(pages, page_id="page_id", url="url", html="html").select(
        F.col("page_id").cast("bigint").alias("page_id"), "url",
        F.encode(F.coalesce("html", F.lit("")), "UTF-8").alias("payload"))
    rows = rows.withColumn("digest", F.sha2("payload", 256))
    twice = written(spark, rows.filter(F.octet_length("payload") >= REVISIT_BYTES).groupBy("digest")
                    .agg(F.min("page_id").alias("refers_to"), F.count("*").alias("k"))
                    .filter("k > 1 AND refers_to IS NOT NULL").select("digest", "refers_to"), "warc-twice")
    small = twice.count() <= MAX_BROADCAST_DIGESTS
    marked = rows.join(F.broadcast(twice) if small else twice, "digest", "left").withColumn(
        "revisit", F.col("refers_to").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("refers_to")))
    return written(spark, marked.select("page_id", "url", "payload", "digest", "refers_to", "revisit")
                   .mapInArrow(partial(_write, folder=folder), "path string, bytes bigint"), "warc-manifest")


class _Archive:
    """Bytes of an archive through a window that moves forward."""

    def __init__(self, uri: str, chunk: int = 1 << 20):
        store, path = _filesystem(uri)
        self.file, self.chunk = store.open_input_file(path), chunk
        self.size, self.base, self.data = self.file.size(), 0, b""

    def ahead(self, at: int, n: int) -> bytes:
        """At least ``n`` bytes from ``at``, fewer only at the end of the file."""
        if at < self.base or at + n > self.base + len(self.data):
            self.base, self.data = at, self.file.read_at(max(n, self.chunk), at)
        return self.data[at - self.base:]

    def member(self, at: int) -> tuple[bytes, int] | None:
        """Content and end of the member that begins here, if it is a WARC record."""
        inflate, out, here = zlib.decompressobj(31), [], at
        try:
            while not inflate.eof:
                part = self.ahead(here, 1 << 16)
                if not part:
                    return None
                out.append(inflate.decompress(part))
                here += len(part) - len(inflate.unused_data)
                if here - at >= 64 and not b"".join(out[:2])[:5] in (b"WARC/", b""):
                    return None
        except zlib.error:
            return None
        content = b"".join(out)
        return (content, here) if content.startswith(b"WARC/") else None

    def after_padding(self, at: int) -> int:
        """The first byte from ``at`` that is not NUL, or the end of the file."""
        while at < self.size:
            part = self.ahead(at, 1)
            rest = len(part.lstrip(b"\0"))
            if rest:
                return at + len(part) - rest
            at += len(part)
        return at

    def followed(self, end: int) -> bool:
        """Whether a further member's magic or the end of the file follows, after padding."""
        at = self.after_padding(end)
        return at >= self.size or self.ahead(at, 3)[:3] == MAGIC

    def chained(self, at: int) -> bool:
        """Whether a member begins here, by going from member to member from the file's beginning."""
        return any(found == at for found, content in self.records(0, at + 1, sure=True) if content is not None)

    def records(self, start: int, end: int, sure: bool = False) -> Iterator[tuple[int, bytes | None]]:
        """(offset, content) of the members that begin in [start, end); content is None for a
        damaged place right after one of them (or at the file's beginning).

        The first member of a range is found by scanning.  One that nothing valid follows may
        be the content of a member around it, or stand before a damaged place: then the file is
        read from its beginning to tell (``sure``: that is what is being done)."""
        at, before = start, start == 0
        while at < self.size:
            found = None
            if before:                       # a member must begin here, be it of the next range
                at = self.after_padding(at)
                if at >= self.size:
                    return
            if (before or at < end) and self.ahead(at, 3)[:3] == MAGIC:
                found = self.member(at)
                if found and not before and not sure and not self.followed(found[1]) and not self.chained(at):
                    found = None
            if before and found is None:
                yield at, None
            if at >= end:
                return
            if found is not None:
                yield at, found[0]
                at, before = found[1], True
                continue
            before = False
            window = self.ahead(at + 1, min(self.chunk, max(end + 2 - at - 1, 3)))
            hit = window.find(MAGIC)
            at = at + 1 + (hit if hit >= 0 else max(len(window) - 2, 1))


def parse(content: bytes) -> tuple[dict[str, str], bytes]:
    """Headers (lower-case names) and block of a record; a short block is an error."""
    head, _, rest = content.partition(b"\r\n\r\n")
    headers = {}
    for line in head.decode("utf-8", "replace").split("\r\n")[1:]:
        k, _, v = line.partition(":")
        headers[k.strip().lower()] = v.strip()
    size = int(headers["content-length"])
    if len(rest) < size:
        raise ValueError(f"record {headers.get('warc-record-id')} is shorter than it says")
    return headers, rest[:size]


def _page(urn: str | None) -> int | None:
    tail = (urn or "").removeprefix("<urn:page:").removesuffix(">")
    return int(tail) if tail.lstrip("-").isdigit() else None


_RECORDS = ("path string, at bigint, page_id bigint, url string, payload_bytes bigint, "
            "payload_digest string, record_type string, refers_to bigint, payload binary")


def _read(batches: Iterator[pa.RecordBatch], with_payload: bool, damaged: str) -> Iterator[pa.RecordBatch]:
    names = [c.split()[0] for c in _RECORDS.split(", ")]
    types = [{"string": pa.string(), "bigint": pa.int64(), "binary": pa.binary()}[c.split()[1]] for c in _RECORDS.split(", ")]

    def flush(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(types)], names=names)

    for batch in batches:
        for split in batch.to_pylist():
            rows, held = [], 0
            for at, content in _Archive(split["path"]).records(split["start"], split["end"]):
                if content is None:
                    if damaged == "raise":
                        raise ValueError(f"{split['path']} at {at}: no valid member follows the one before")
                    rows.append((split["path"], at, None, None, None, None, "damaged", None, None))
                    continue
                headers, block = parse(content)
                kind = headers.get("warc-type")
                if kind not in ("response", "revisit"):
                    continue
                http, _, payload = block.partition(b"\r\n\r\n")
                stated = headers.get("warc-payload-digest")
                digest = (stated or "").removeprefix("sha256:") or None
                if kind == "response":
                    size, digest = len(payload), hashlib.sha256(payload).hexdigest()
                    if (stated or "").startswith("sha256:") and stated != f"sha256:{digest}":
                        raise ValueError(f"{split['path']} at {at}: the payload does not have the stated digest")
                else:
                    size = next((int(x.split(b":")[1]) for x in http.split(b"\r\n")
                                 if x.lower().startswith(b"content-length:")), None)
                rows.append((split["path"], at, _page(headers.get("warc-record-id")), headers.get("warc-target-uri"),
                             size, digest, kind, _page(headers.get("warc-refers-to")),
                             payload if with_payload and kind == "response" else None))
                held += len(payload) * with_payload
                if len(rows) >= 5000 or held >= 16 << 20:
                    yield flush(rows)
                    rows, held = [], 0
            if rows:
                yield flush(rows)


def list_archives(spark: SparkSession, folder: str) -> DataFrame:
    """(path, bytes) of the archives below a folder, listed by Spark."""
    return (spark.read.format("binaryFile").option("recursiveFileLookup", "true")
            .option("pathGlobFilter", "*.warc.gz").load(folder).select("path", F.col("length").alias("bytes")))


def read_archives(archives: DataFrame, split_bytes: int = SPLIT_BYTES, with_payload: bool = True,
                  damaged: str = "raise") -> DataFrame:
    """Records of archives (path, bytes), each range of ``split_bytes`` in a row of its own.

    As many tasks as there are ranges (at most ``MAX_TASKS``, which take turns) read them, so
    one large archive is read by many.  ``payload_digest`` is the SHA-256 of the payload,
    whatever digest a response states (a stated SHA-256 that differs is an error); of a
    revisit it is what it states, without the prefix ``sha256:``.  ``damaged="report"`` gives
    a row of record_type ``damaged`` for each place that should hold a member and does not.
    """
    if damaged not in ("raise", "report"):
        raise ValueError(f"unknown damaged={damaged!r}")
    ship_package(archives.sparkSession)
    n = F.ceil(F.col("bytes") / split_bytes)
    ranges = archives.filter("bytes > 0").agg(F.sum(n)).first()[0] or 0
    tasks = int(max(1, min(ranges, MAX_TASKS)))
    # a row for each archive: numbering them in one task is bounded by their count
    before = F.sum(n).over(Window.orderBy("path").rowsBetween(Window.unboundedPreceding, -1))
    splits = (archives.filter("bytes > 0").withColumn("first", F.coalesce(before, F.lit(0)))
              .withColumn("start", F.explode(F.sequence(F.lit(0), F.col("bytes") - 1, F.lit(split_bytes))))
              .select("path", "start", F.least(F.col("start") + split_bytes, "bytes").alias("end"),
                      F.pmod(F.col("first") + F.floor(F.col("start") / split_bytes), F.lit(tasks)).cast("int").alias("task")))
    return (splits.repartitionById(tasks, F.col("task")).select("path", "start", "end")
            .mapInArrow(partial(_read, with_payload=with_payload, damaged=damaged), _RECORDS))


def op6_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contract query: ``pages`` written as WARC and read back."""
    folder = scratch_path(spark, "warc")
    archives = write_archives(spark, spark.read.parquet(f"{sf_dir}/pages.parquet"), folder)
    return read_archives(archives, with_payload=False).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


ORACLE = f"""
WITH p AS (SELECT page_id, coalesce(html, '') AS html, octet_length(encode(coalesce(html, ''))) AS n FROM pages),
m AS (SELECT *, min(page_id) OVER (PARTITION BY html) AS first_id FROM p)
SELECT page_id, n::BIGINT AS payload_bytes, sha256(html) AS payload_digest,
       CASE WHEN n >= {REVISIT_BYTES} AND page_id <> first_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN n >= {REVISIT_BYTES} AND page_id <> first_id THEN first_id END AS refers_to
FROM m"""
