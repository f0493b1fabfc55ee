"""WARC archives, index first.

Writing: every task writes one archive (WARC/1.1, one gzip member per record)
into the shared folder and returns an index row per record: file, offset, length,
URL and payload digest. The index is the table that everything else works on; a
file of a failed or repeated task attempt is in no index row and so never read.

Reading: the index rows that are wanted are sorted by file and offset and
coalesced into byte ranges (neighbours at most ``GAP`` bytes apart, ranges of at
most ``RANGE`` bytes or one record). A task reads a range at once and parses the
records at their offsets.

A response's block is an HTTP response: status line, headers, then the payload. A
revisit's block holds the HTTP headers alone; it names the response it stands for
by record id, URI and date, so standard readers can resolve it, and by page id.

Of equal payloads of at least ``LEAST_REVISIT`` bytes the record of largest
page_id is a response and the others are revisits of it; smaller payloads are
all responses.

Defined cases: a null html is an empty payload; a null url is an empty target; a
null page_id sorts below all others; repeated rows with the largest page_id are
all responses (revisits name the one of greatest URL; equal rows have equal record
ids); an empty table gives an empty index; other columns are ignored.
"""

from __future__ import annotations

import gzip
import hashlib
import io
import uuid
from collections.abc import Iterator
from datetime import datetime, timezone

import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F, types as T

from ..session import materialize, scratch_path

LEAST_REVISIT = 1000
GAP = 64 * 1024
RANGE = 8 * 1024 * 1024
# Archive bytes that a reading task gets, about.
TASK_BYTES = 16 * 1024 * 1024
_VERSION = b"WARC/1.1"
_END = b"\r\n\r\n"

INDEX = T.StructType([
    T.StructField("file", T.StringType()), T.StructField("offset", T.LongType()), T.StructField("length", T.LongType()),
    T.StructField("url", T.StringType()), T.StructField("digest", T.StringType()),
    T.StructField("record_type", T.StringType())])
RECORD = T.StructType([
    T.StructField("page_id", T.LongType()), T.StructField("url", T.StringType()),
    T.StructField("record_type", T.StringType()), T.StructField("refers_to", T.LongType()),
    T.StructField("payload_bytes", T.LongType()), T.StructField("payload_digest", T.StringType()),
    T.StructField("payload", T.BinaryType()), T.StructField("intact", T.BooleanType())])


def file_system(path: str) -> tuple[fs.FileSystem, str]:
    """The Arrow file system of a URI or plain path, usable in tasks."""
    return fs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (fs.LocalFileSystem(), path)


def _one_line(url: str | None) -> str:
    return " ".join((url or "").split("\n")).replace("\r", " ")


def record_id(page_id: int | None, url: str | None, digest: str) -> str:
    """The same id wherever it is computed: revisits name their response by it."""
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{page_id} {digest} {_one_line(url)}')}>"


def record_bytes(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None,
                 refers_url: str | None, revisit: bool, date: str) -> bytes:
    """One WARC record. A revisit holds no payload, but its full length and digest."""
    headers = [("WARC-Type", "revisit" if revisit else "response"), ("WARC-Record-ID", record_id(page_id, url, digest)),
               ("WARC-Date", date), ("WARC-Target-URI", _one_line(url)), ("WARC-Payload-Digest", f"sha1:{digest}"),
               ("WARC-Payload-Length", str(len(payload)))]
    if page_id is not None:
        headers.append(("WARC-Page-ID", str(page_id)))
    if revisit:
        headers += [("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"),
                    ("WARC-Refers-To", record_id(refers_to, refers_url, digest)),
                    ("WARC-Refers-To-Target-URI", _one_line(refers_url)), ("WARC-Refers-To-Date", date),
                    ("WARC-Refers-To-Page-ID", str(refers_to))]
    block = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    if not revisit:
        block += payload
    headers += [("Content-Type", "application/http; msgtype=response"), ("Content-Length", str(len(block)))]
    head = "".join(f"{k}: {v}\r\n" for k, v in headers).encode("utf-8", "replace")
    return _VERSION + b"\r\n" + head + b"\r\n" + block + _END


def parse_record(data: bytes) -> tuple[dict[str, str], bytes]:
    """Headers and block of one uncompressed record; the block is cut by Content-Length alone."""
    head, _, rest = data.partition(b"\r\n\r\n")
    lines = head.decode("utf-8", "replace").split("\r\n")
    if lines[0] != _VERSION.decode():
        raise ValueError("not a WARC record")
    headers = dict(line.split(": ", 1) if ": " in line else (line.rstrip(":"), "") for line in lines[1:])
    size = int(headers["Content-Length"])
    if rest[size:] != _END:
        raise ValueError("a WARC record does not end after its block")
    return headers, rest[:size]


def plan_records(pages: DataFrame, least: int = LEAST_REVISIT) -> DataFrame:
    """``pages`` (page_id, url, html) with payload, digest, revisit and refers_to.

    Only ids, digests and sizes are grouped; payloads are joined to the rows that
    are revisits by (page_id, digest), a key without hot values.
    """
    payload = F.coalesce(F.col("html").cast("binary"), F.lit("").cast("binary"))
    rows = pages.select("page_id", "url", payload.alias("payload")).withColumn("digest", F.sha1("payload"))
    large = rows.where(F.octet_length("payload") >= least).select("page_id", "url", "digest")
    winners = (large.groupBy("digest").agg(F.max(F.struct("page_id", "url")).alias("last"), F.count("*").alias("n"))
               .where("n > 1").select("digest", F.col("last.page_id").alias("refers_to"), F.col("last.url").alias("refers_url")))
    revisits = (large.select("page_id", "digest").distinct().join(winners, "digest")
                .where(~F.col("page_id").eqNullSafe(F.col("refers_to")))
                .select(F.col("page_id").alias("__page"), F.col("digest").alias("__digest"), "refers_to", "refers_url"))
    return (rows.join(revisits, F.col("page_id").eqNullSafe(F.col("__page")) & (F.col("digest") == F.col("__digest")),
                      "left")
            .select("page_id", "url", "payload", "digest", F.col("__digest").isNotNull().alias("revisit"), "refers_to",
                    "refers_url"))


def write_archives(pages: DataFrame, folder: str, least: int = LEAST_REVISIT) -> DataFrame:
    """Write all ``pages`` as archives under ``folder`` and return the index, itself written once."""
    date = datetime.now(timezone.utc).strftime("%Y-%m-%dT%H:%M:%SZ")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = None
        try:
            for batch in batches:
                if not batch.num_rows:
                    continue
                if out is None:
                    context = TaskContext.get()
                    files, base = file_system(folder)
                    files.create_dir(base, recursive=True)
                    name = f"part-{context.partitionId():06d}-{context.taskAttemptId()}.warc.gz"
                    out, at = files.open_output_stream(f"{base}/{name}", compression=None), 0
                index: list[list] = [[] for _ in INDEX]
                for page, url, payload, digest, revisit, refers, refers_url in zip(*(c.to_pylist() for c in batch.columns)):
                    member = gzip.compress(record_bytes(page, url, payload, digest, refers, refers_url, revisit, date),
                                           compresslevel=3, mtime=0)
                    out.write(member)
                    for column, value in zip(index, (name, at, len(member), url, digest,
                                                     "revisit" if revisit else "response")):
                        column.append(value)
                    at += len(member)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(index, (pa.string(), pa.int64(), pa.int64(), pa.string(),
                                                            pa.string(), pa.string()))], names=INDEX.names)
        finally:
            if out is not None:
                out.close()

    return materialize(plan_records(pages, least).mapInArrow(write, INDEX), "warc-index")


def byte_ranges(index: DataFrame, gap: int = GAP, most: int = RANGE) -> DataFrame:
    """(file, first, last, offsets, lengths) of coalesced reads of the index rows, sorted by offset.

    A file is cut into stretches of ``most`` bytes; a record belongs to the stretch
    its offset lies in, so a range is never much longer than ``most``. Stretches are
    dealt to as many tasks as the archives' bytes ask for: index rows are too
    small to tell Spark how much is read for them.
    """
    stretch = F.floor(F.col("offset") / most)
    w = Window.partitionBy("file", "stretch").orderBy("offset")
    size = index.agg(F.sum("length")).first()[0] or 0
    parted = (index.select("file", "offset", "length").withColumn("stretch", stretch)
              .repartition(1 + size // TASK_BYTES, "file", "stretch").distinct()
              .withColumn("apart", F.col("offset") - F.lag(F.col("offset") + F.col("length")).over(w) > gap)
              .withColumn("run", F.sum(F.coalesce(F.col("apart"), F.lit(False)).cast("int")).over(w)))
    members = F.array_sort(F.collect_list(F.struct("offset", "length")))
    return (parted.groupBy("file", "stretch", "run")
            .agg(F.min("offset").alias("first"), F.max(F.col("offset") + F.col("length")).alias("last"),
                 members.alias("members"))
            .select("file", "first", "last", F.col("members.offset").alias("offsets"),
                    F.col("members.length").alias("lengths")))


def read_records(index: DataFrame, folder: str, gap: int = GAP, most: int = RANGE,
                 payloads: bool = True) -> DataFrame:
    """Read the records of the (selected) ``index`` rows back from ``folder``.

    Lengths and digests of responses are those of the payload read, those of
    revisits stand in their headers; ``intact`` tells if the headers agree.
    """
    types = (pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.binary(), pa.bool_())

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, base = file_system(folder)
        for batch in batches:
            for name, first, last, offsets, lengths in zip(*(c.to_pylist() for c in batch.columns)):
                with files.open_input_file(f"{base}/{name}") as source:
                    data = memoryview(source.read_at(last - first, first))
                rows: list[list] = [[] for _ in RECORD]
                for offset, length in zip(offsets, lengths):
                    member = data[offset - first:offset - first + length]
                    headers, block = parse_record(gzip.GzipFile(fileobj=io.BytesIO(member)).read())
                    body = block.partition(b"\r\n\r\n")[2]                  # after the HTTP headers
                    kind, digest = headers["WARC-Type"], headers["WARC-Payload-Digest"].removeprefix("sha1:")
                    size, intact = int(headers["WARC-Payload-Length"]), True
                    if kind == "response":
                        stated = size, digest
                        size, digest = len(body), hashlib.sha1(body).hexdigest()
                        intact = stated == (size, digest)
                    page, refers = headers.get("WARC-Page-ID"), headers.get("WARC-Refers-To-Page-ID")
                    for column, value in zip(rows, (
                            None if page is None else int(page), headers["WARC-Target-URI"], kind,
                            None if refers is None else int(refers), size, digest,
                            body if payloads and kind == "response" else None, intact)):
                        column.append(value)
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(rows, types)], names=RECORD.names)

    return byte_ranges(index, gap, most).mapInArrow(read, RECORD)


def round_trip(pages: DataFrame, least: int = LEAST_REVISIT) -> DataFrame:
    """Write ``pages`` as archives in the shared folder and read every record back, without the payloads."""
    folder = scratch_path(pages.sparkSession, "warc")
    return read_records(write_archives(pages, folder, least), folder, payloads=False)
