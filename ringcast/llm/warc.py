"""Web archives (WARC/1.1, one gzip member per record): a writer and a splittable reader.

The writer makes one archive per task, under a name of its own, in the folder all
executors share; only the archives of tasks that ended well are in the list it returns,
so a task that is run again leaves no double records.  Of pages with equal payloads of
``MIN_REVISIT`` bytes or more, that with the smallest id is a response and the others are
revisits of it; a page without id is never the one referred to, unless all are.

The reader cuts archives into byte ranges.  A task looks for the gzip magic in its range,
takes a candidate for a member only if it decodes to a record's header, and owns the
records that start inside, reading on beyond the end for the last.  The payload of every
response is hashed again and held against its header.

A null payload is empty; urls may be null.  Repeated rows are each written; those that
share the smallest id are all responses.  An empty table makes no archive.  Pages are
read by the named columns, whatever other columns they have.
"""

from __future__ import annotations

import hashlib
import uuid
import zlib
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ringcast.llm.texts import importable
from ringcast.session import shared_dir, stage

MIN_REVISIT = 100
MAX_ARCHIVE = 512 << 20
SPLIT = 16 << 20
BLOCK = 256 << 10
MAGIC = b"\x1f\x8b\x08"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
FILES = "path string, bytes bigint, records bigint"
RECORDS = (
    "page_id bigint, payload_bytes bigint, payload_digest string, record_type string, "
    "refers_to bigint, url string, path string, offset bigint"
)


def _record(page: dict, date: str) -> bytes:
    payload = (page["html"] or "").encode()
    http = (
        "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
        f"Content-Length: {len(payload)}\r\n\r\n"
    ).encode()
    revisit = page["first"] is not None
    block = http if revisit else http + payload
    known = page["page_id"] is not None
    name = f"urn:page:{page['page_id']}" if known else f"urn:uuid:{uuid.uuid4()}"
    lines = [
        "WARC/1.1",
        f"WARC-Type: {'revisit' if revisit else 'response'}",
        f"WARC-Record-ID: <{name}>",
        f"WARC-Date: {date}",
        f"WARC-Payload-Digest: sha256:{page['digest']}",
        "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    if known:
        lines.append(f"X-Page-Id: {page['page_id']}")
    if page["url"] is not None:
        lines.append(f"WARC-Target-URI: {quote(page['url'], safe=':/?#[]@!$&()*+,;=%~')}")
    if revisit:
        lines += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: <urn:page:{page['first']}>"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def _file_system(uri: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(uri)


def with_firsts(pages: DataFrame, min_revisit: int = MIN_REVISIT) -> DataFrame:
    """Pages with their payload's digest and, for revisits, the id they refer to.

    The table of payloads that occur twice or more is staged, so that Spark knows its
    size and can split the tasks of a payload that very many pages share.
    """
    payload = F.coalesce(F.col("html"), F.lit(""))
    read = pages.select(
        F.col("page_id").cast("long").alias("page_id"),
        F.col("url").cast("string").alias("url"),
        F.col("html"),
        F.sha2(payload.cast("binary"), 256).alias("digest"),
        F.octet_length(payload).alias("size"),
    )
    firsts = (
        read.where(F.col("size") >= min_revisit)
        .groupBy("digest")
        .agg(F.min("page_id").alias("first"), F.count("*").alias("n"))
        .where("n > 1")
        .select("digest", "first")
    )
    firsts = stage(firsts, "warc-firsts")
    own = F.col("page_id").eqNullSafe(F.col("first"))
    return (
        read.join(firsts, "digest", "left")
        .withColumn("first", F.when(~own, F.col("first")))
        .select("page_id", "url", "html", "digest", "first")
    )


def write_archives(
    decided: DataFrame, folder: str, date: str = "2024-01-01T00:00:00Z",
    max_bytes: int = MAX_ARCHIVE,
) -> DataFrame:
    """Writes the records; a staged list of the archives, their sizes and record counts."""
    importable(decided.sparkSession)

    def run(batches):
        out = path = None
        size = records = 0

        def closed():
            out.close()
            return pa.RecordBatch.from_arrays(
                [pa.array([path]), pa.array([size]), pa.array([records])],
                ["path", "bytes", "records"],
            )

        for batch in batches:
            for i in range(len(batch)):
                page = batch.slice(i, 1).to_pylist()[0]
                if out is not None and size >= max_bytes:
                    yield closed()
                    out = None
                if out is None:
                    path = f"{folder}/{uuid.uuid4().hex}.warc.gz"
                    system, place = _file_system(path)
                    system.create_dir(place.rpartition("/")[0])
                    out, size, records = system.open_output_stream(place, compression=None), 0, 0
                member = zlib.compressobj(6, zlib.DEFLATED, 31)
                raw = member.compress(_record(page, date)) + member.flush()
                out.write(raw)
                size += len(raw)
                records += 1
        if out is not None:
            yield closed()

    return stage(decided.mapInArrow(run, FILES), "warc-files")


class _Archive:
    """Blocks of a file by position."""

    def __init__(self, path: str):
        system, place = _file_system(path)
        self.file = system.open_input_file(place)
        self.size = self.file.size()

    def read(self, at: int) -> bytes:
        return self.file.read_at(min(BLOCK, self.size - at), at) if at < self.size else b""

    def find(self, at: int, end: int) -> int | None:
        """First place of the magic that starts in [at, end)."""
        while at < end:
            block = self.read(at)
            found = block.find(MAGIC)
            if found >= 0:
                return at + found if at + found < end else None
            if at + len(block) >= self.size:
                return None
            at += len(block) - len(MAGIC) + 1
        return None

    def inflated(self, at: int) -> Iterator[tuple[bytes, int | None]]:
        """Decoded parts of the member at ``at``; with the last one, where it ends."""
        decoder = zlib.decompressobj(31)
        while not decoder.eof:
            block = self.read(at)
            if not block:
                raise zlib.error("the file ends inside a member")
            at += len(block)
            part = decoder.decompress(block)
            yield part, at - len(decoder.unused_data) if decoder.eof else None

    def starts_record(self, at: int) -> bool:
        """Whether a member that starts here decodes to a record's header, of any length."""
        version, head = b"WARC/", b""
        try:
            for part, _ in self.inflated(at):
                seen = max(0, len(head) - 3)
                head += part
                if not head.startswith(version[: len(head)]):
                    return False
                if b"\r\n\r\n" in head[seen:]:
                    return True
        except zlib.error:
            return False
        return False

    def record(self, at: int) -> tuple[bytes, int]:
        parts, end = [], None
        for part, end in self.inflated(at):
            parts.append(part)
        return b"".join(parts), end


def _headers(raw: bytes) -> dict[str, str]:
    lines = raw.decode("utf-8").split("\r\n")[1:]
    return {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines)}


def parse_record(raw: bytes) -> dict:
    """Fields of a response or revisit record."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    fields = _headers(head)
    block = rest[: int(fields["content-length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    digest = fields["warc-payload-digest"].removeprefix("sha256:")
    kind = fields["warc-type"]
    if kind == "response":
        size = len(payload)
        if hashlib.sha256(payload).hexdigest() != digest:
            raise ValueError("a payload differs from its digest")
    else:
        size = int(_headers(http)["content-length"])
    page, refers = fields.get("x-page-id"), fields.get("warc-refers-to")
    return {
        "page_id": int(page) if page is not None else None,
        "payload_bytes": size,
        "payload_digest": digest,
        "record_type": kind,
        "refers_to": int(refers.strip("<>").rpartition(":")[2]) if refers else None,
        "url": fields.get("warc-target-uri"),
    }


def records_starting_in(path: str, start: int, end: int) -> Iterator[dict]:
    """Records whose member starts in [start, end), with their place."""
    archive = _Archive(path)
    at = start
    while (at := archive.find(at, end)) is not None:
        if not archive.starts_record(at):
            at += 1
            continue
        raw, after = archive.record(at)
        yield parse_record(raw) | {"path": path, "offset": at}
        at = after


def read_archives(files: DataFrame, split: int = SPLIT) -> DataFrame:
    """All records of the archives listed in ``files`` (path, bytes), by byte ranges."""
    importable(files.sparkSession)
    starts = F.sequence(F.lit(0).cast("long"), F.col("bytes") - 1, F.lit(split).cast("long"))
    ranges = files.where("bytes > 0").select(
        "path", "bytes", F.explode(starts).alias("start")
    )
    ranges = ranges.select(
        "path", "start", F.least(F.col("start") + split, F.col("bytes")).alias("end")
    )
    # one range is one task's work; their number is known from the list of files
    n = files.agg(F.sum(F.ceil(F.col("bytes") / split))).first()[0] or 1
    names = [x.split()[0] for x in RECORDS.split(", ")]
    kinds = [pa.string() if x.endswith("string") else pa.int64() for x in RECORDS.split(", ")]

    def run(batches):
        def made(rows):
            columns = [
                pa.array([r[c] for r in rows], k) for c, k in zip(names, kinds, strict=True)
            ]
            return pa.RecordBatch.from_arrays(columns, names)

        for batch in batches:
            for r in batch.to_pylist():
                rows = []
                for record in records_starting_in(r["path"], r["start"], r["end"]):
                    rows.append(record)
                    if len(rows) == 1000:
                        yield made(rows)
                        rows = []
                yield made(rows)

    return ranges.repartition(int(n)).mapInArrow(run, RECORDS)


def archives_under(spark: SparkSession, pattern: str) -> DataFrame:
    """The files of a path or pattern, for ``read_archives``; contents are not read."""
    files = spark.read.format("binaryFile").load(pattern)
    return files.select("path", F.col("length").alias("bytes"))


def archive_round_trip(pages: DataFrame, split: int = SPLIT) -> DataFrame:
    """Writes all pages to archives in the shared folder and reads them back.

    Raises if the number of records read is not what the writers counted.
    """
    folder = f"{shared_dir(pages.sparkSession)}/ringcast/warc-{uuid.uuid4().hex}"
    files = write_archives(with_firsts(pages), folder)
    return complete(read_archives(files, split), files)


def complete(records: DataFrame, files: DataFrame) -> DataFrame:
    """The records, staged, if they are as many as the list of files says."""
    staged = stage(records, "warc-records")
    read, written = staged.count(), files.agg(F.sum("records")).first()[0] or 0
    if read != written:
        raise ValueError(f"{written} records were written, {read} were read")
    return staged
