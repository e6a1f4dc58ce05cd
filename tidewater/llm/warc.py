"""WARC archives: a PySpark data source (``warc``) that reads and writes them.

Writing: one file per task, one gzip member per record, as the format asks. A member
says in its extra field how long it is, so a reader can step over it.

Reading: file partitions are planned on the driver from file names and sizes.
Filters on ``record_type`` and on the header columns are pushed down. A task
inflates only the headers of a record first, judges them, and either steps over the
rest of the member by its length or, if the payload column is wanted, inflates it.
Files of other writers, without lengths, are read too: the end of a member is then
found by inflating it.

Repeated payloads: the page with the largest id keeps its payload as a ``response``;
the others are ``revisit`` records that refer to it.
"""

from __future__ import annotations

import datetime
import struct
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import (DataSource, DataSourceArrowWriter, DataSourceReader, EqualTo, In, InputPartition,
                                    IsNotNull, IsNull, WriterCommitMessage)

from ..session import scratch_path
from .tables import python_ready

#: Payloads shorter than this are never written as revisits.
MIN_REVISIT_BYTES = 1000
#: Bytes of archives that one read task takes, unless the ``readBytes`` option says otherwise.
READ_BYTES = 128 << 20
#: Header columns: name of the column and of the WARC header.
HEADERS = {
    "record_id": "WARC-Record-ID", "record_type": "WARC-Type", "target_uri": "WARC-Target-URI",
    "date": "WARC-Date", "payload_digest": "WARC-Payload-Digest", "refers_to": "WARC-Refers-To",
    "payload_length": "X-Payload-Length", "content_type": "Content-Type"}
SCHEMA = ", ".join(f"{c} string" for c in HEADERS) + ", payload binary"
#: Two letters that mark the gzip extra field holding the member's length.
LENGTH_FIELD = b"WL"
HTTP_HEAD = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"


def filesystem(path: str) -> tuple[pafs.FileSystem, str]:
    """The file system of a path or URI, as every task opens it."""
    if "://" in path or path.startswith("file:"):
        return pafs.FileSystem.from_uri(path if "://" in path else "file://" + path[len("file:"):])
    return pafs.LocalFileSystem(), path


# ---- records ----------------------------------------------------------------------

def gzip_member(data: bytes) -> bytes:
    """``data`` as one gzip member whose extra field gives the member's length."""
    packer = zlib.compressobj(6, zlib.DEFLATED, -15)
    body = packer.compress(data) + packer.flush()
    total = 10 + 2 + 4 + 8 + len(body) + 8
    head = struct.pack("<BBBBLBB", 0x1F, 0x8B, 8, 4, 0, 0, 255)
    extra = struct.pack("<H2sHQ", 12, LENGTH_FIELD, 8, total)
    return head + extra + body + struct.pack("<LL", zlib.crc32(data), len(data) & 0xFFFFFFFF)


def record(headers: dict[str, str | None], block: bytes) -> bytes:
    lines = ["WARC/1.1", *(f"{k}: {v}" for k, v in headers.items() if v is not None),
             f"Content-Length: {len(block)}"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse_headers(raw: bytes) -> dict[str, str]:
    """The named fields of a record's head; of repeated ones the last, names in lower case."""
    out = {}
    for line in raw.split(b"\r\n")[1:]:
        name, colon, value = line.partition(b":")
        if colon:
            out[name.decode("utf-8", "replace").strip().lower()] = value.decode("utf-8", "replace").strip()
    return out


def http_payload(block: bytes, content_type: str | None) -> bytes:
    """The payload of a record's block: without the HTTP head if it has one."""
    if content_type and content_type.startswith("application/http"):
        return block.partition(b"\r\n\r\n")[2]
    return block


class GzipRecords:
    """The records of a gzip archive, headers first."""

    #: Compressed bytes read at once, and bytes inflated at once while looking for the headers' end.
    CHUNK, STEP = 1 << 13, 1 << 10

    def __init__(self, source):
        self.source = source
        self.size = source.size()

    def __iter__(self) -> Iterator[tuple[dict[str, str], callable]]:
        at = 0
        while at < self.size:
            self.source.seek(at)
            head = self.source.read(26)
            if not head.startswith(b"\x1f\x8b"):
                raise ValueError(f"no gzip member at byte {at}")
            known = None
            if head[3] & 4 and head[12:14] == LENGTH_FIELD and len(head) >= 24:
                known = struct.unpack("<Q", head[16:24])[0]
            self.source.seek(at)
            self.unpack = zlib.decompressobj(31)
            data = b""
            while b"\r\n\r\n" not in data:
                more = self._more(self.STEP)
                if not more:
                    break
                data += more
            raw, _, rest = data.partition(b"\r\n\r\n")
            body = self._body(rest)
            yield parse_headers(raw), body
            if known:
                at += known
            else:
                body()
                at = self.source.tell() - len(self.unpack.unused_data)

    def _more(self, most: int = 0) -> bytes:
        """Some more inflated bytes of the member (at most ``most`` if given), none at its end."""
        out = b""
        while not out and not self.unpack.eof:
            data = self.unpack.unconsumed_tail or self.source.read(self.CHUNK)
            if not data:
                break
            out = self.unpack.decompress(data, most)
        return out

    def _body(self, rest: bytes):
        done: list[bytes] = []

        def body() -> bytes:
            if not done:
                done.append(b"".join([rest, *iter(self._more, b"")]))
            return done[0]
        return body


class PlainRecords:
    """The records of an archive without compression, headers first."""

    def __init__(self, source):
        self.source = source
        self.size = source.size()

    def __iter__(self):
        at = 0
        while at < self.size:
            self.source.seek(at)
            data = b""
            while b"\r\n\r\n" not in data:
                more = self.source.read(1 << 14)
                if not more:
                    return
                data += more
            raw, _, rest = data.partition(b"\r\n\r\n")
            headers = parse_headers(raw)
            length, start = int(headers.get("content-length", 0)), at + len(raw) + 4

            def body(start=start, length=length):
                self.source.seek(start)
                return self.source.read(length)
            yield headers, body
            at = start + length + 4


# ---- the data source ----------------------------------------------------------------

class FilePartition(InputPartition):
    def __init__(self, paths: list[str]):
        self.paths = paths


class WarcReader(DataSourceReader):
    def __init__(self, options):
        self.path = options.get("path")
        self.most = int(options.get("readBytes", READ_BYTES))
        #: payload = false: the payload column is null and no payload is ever inflated.
        self.payload = options.get("payload", "true").lower() == "true"
        self.wanted: list[tuple[str, str, tuple]] = []

    def pushFilters(self, filters):
        """Take equality, IN and null tests on header columns; leave all others to Spark."""
        for f in filters:
            name = f.attribute[0] if len(f.attribute) == 1 else None
            if name in HEADERS and type(f) in (EqualTo, In, IsNotNull, IsNull):
                values = ((f.value,) if isinstance(f, EqualTo) else tuple(f.value) if isinstance(f, In) else ())
                self.wanted.append((name, type(f).__name__, values))
            else:
                yield f

    def partitions(self):
        """Files, largest first, dealt into partitions of about ``readBytes`` bytes."""
        system, root = filesystem(self.path)
        found = system.get_file_info(pafs.FileSelector(root, recursive=True, allow_not_found=True))
        files = sorted(((f.size, f.path) for f in found if f.is_file and f.base_name[:1] not in "._"
                        and f.base_name.endswith((".warc", ".warc.gz"))), reverse=True)
        out, held, size = [], [], 0
        for n, path in files:
            if held and size + n > self.most:
                out.append(FilePartition(held))
                held, size = [], 0
            held.append(path)
            size += n
        return out + [FilePartition(held)] if held else out or [FilePartition([])]

    def _keeps(self, values: dict[str, str | None]) -> bool:
        for name, kind, wanted in self.wanted:
            v = values[name]
            if kind == "IsNull":
                if v is not None:
                    return False
            elif v is None or (kind != "IsNotNull" and v not in wanted):
                return False
        return True

    def read(self, partition):
        system, _ = filesystem(self.path)
        rows, held = [], 0
        for path in partition.paths:
            with system.open_input_file(path) as source:
                records = GzipRecords(source) if path.endswith(".gz") else PlainRecords(source)
                for headers, body in records:
                    values = {c: headers.get(h.lower()) for c, h in HEADERS.items()}
                    if not self._keeps(values):
                        continue
                    payload = None
                    if self.payload:
                        block = body()[:int(headers.get("content-length", 0))]
                        payload = http_payload(block, values["content_type"])
                        held += len(payload)
                    rows.append((*values.values(), payload))
                    if held > 8 << 20 or len(rows) >= 4096:
                        yield _batch(rows)
                        rows, held = [], 0
        if rows:
            yield _batch(rows)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    *texts, payloads = zip(*rows)
    return pa.record_batch([*(pa.array(c, pa.string()) for c in texts), pa.array(payloads, pa.binary())],
                           names=[*HEADERS, "payload"])


class Written(WriterCommitMessage):
    def __init__(self, path: str, target: str):
        self.path, self.target = path, target


class WarcWriter(DataSourceArrowWriter):
    """Writes a file per task under a name of its own; the job's commit gives it its name.

    A task that is run again writes another file, and what no commit names is
    never read, so lost executors leave no repeated records.
    """

    def __init__(self, options):
        self.path = options["path"]

    def write(self, iterator):
        system, root = filesystem(self.path)
        system.create_dir(root, recursive=True)
        name = uuid.uuid4().hex
        path, n = f"{root}/_{name}", 0
        with system.open_output_stream(path) as out:
            info = record({"WARC-Type": "warcinfo", "WARC-Record-ID": f"<urn:uuid:{uuid.uuid4()}>",
                           "WARC-Date": _now(), "Content-Type": "application/warc-fields"}, b"format: WARC/1.1\r\n")
            out.write(gzip_member(info))
            for batch in iterator:
                for row in batch.to_pylist():
                    n += 1
                    headers = {h: row.get(c) for c, h in HEADERS.items()}
                    headers["WARC-Date"] = headers["WARC-Date"] or _now()
                    block = row["payload"] or b""
                    if (row.get("content_type") or "").startswith("application/http"):
                        block = HTTP_HEAD + block
                    out.write(gzip_member(record(headers, block)))
        return Written(path, f"{root}/part-{name}.warc.gz")

    def commit(self, messages):
        system, _ = filesystem(self.path)
        for m in messages:
            if m is not None:
                system.move(m.path, m.target)

    def abort(self, messages):
        system, _ = filesystem(self.path)
        for m in messages:
            if m is not None and system.get_file_info(m.path).is_file:
                system.delete_file(m.path)


def _now() -> str:
    return datetime.datetime.now(datetime.timezone.utc).strftime("%Y-%m-%dT%H:%M:%SZ")


class WarcSource(DataSource):
    """``spark.read.format("warc").load(path)`` and ``df.write.format("warc").mode("append").save(path)``."""

    @classmethod
    def name(cls):
        return "warc"

    def schema(self):
        return SCHEMA

    def reader(self, schema):
        return WarcReader(self.options)

    def writer(self, schema, overwrite):
        return WarcWriter(self.options)


def register(spark: SparkSession) -> None:
    """Make the source known to the session and let filters reach it."""
    python_ready(spark)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(WarcSource)


# ---- pages to archives and back -------------------------------------------------------

def page_uri(page: "F.Column"):
    return F.concat(F.lit("<urn:page:"), page.cast("string"), F.lit(">"))


def page_records(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
                 min_bytes: int = MIN_REVISIT_BYTES) -> DataFrame:
    """One row per page in the source's schema; repeated payloads as revisits without their bytes.

    A null html is an empty payload, a null url an absent header. Of rows that
    repeat the largest page_id with an equal payload, every one is a response.
    Rows with a null page_id are responses without an id, and no revisit refers to them.
    """
    payload = F.coalesce(F.col(html_col), F.lit("")).cast("binary")
    rows = pages.select(F.col(id_col).cast("long").alias("page"), F.col(url_col).alias("url"), payload.alias("payload"))
    rows = rows.withColumn("digest", F.sha1("payload")).withColumn("length", F.octet_length("payload"))
    # Digests with one holder need no look-up: only repeated ones are joined back.
    holders = (rows.where((F.col("length") >= min_bytes) & F.col("page").isNotNull())
                   .groupBy(F.col("digest").alias("d"), F.col("length").alias("l"))
                   .agg(F.max("page").alias("holder"), F.min("page").alias("other")).where("holder <> other"))
    marked = rows.join(holders, (F.col("digest") == F.col("d")) & (F.col("length") == F.col("l"))
                       & (F.col("page") != F.col("holder")), "left")
    revisit = F.col("holder").isNotNull()
    return marked.select(
        page_uri(F.col("page")).alias("record_id"),
        F.when(revisit, "revisit").otherwise("response").alias("record_type"),
        F.regexp_replace("url", r"[\r\n]+", " ").alias("target_uri"), F.lit(None).cast("string").alias("date"),
        F.concat(F.lit("sha1:"), "digest").alias("payload_digest"),
        F.when(revisit, page_uri(F.col("holder"))).alias("refers_to"),
        F.col("length").cast("string").alias("payload_length"),
        F.lit("application/http; msgtype=response").alias("content_type"),
        F.when(~revisit, F.col("payload")).alias("payload"))


def write_archives(records: DataFrame, path: str) -> str:
    """Append records to the archives under ``path``."""
    register(records.sparkSession)
    records.write.format("warc").mode("append").save(path)
    return path


def read_archives(spark: SparkSession, path: str, payload: bool = True) -> DataFrame:
    """The records under ``path``; tasks take as many bytes as other file sources' do in this session."""
    register(spark)
    most = spark._jsparkSession.sessionState().conf().filesMaxPartitionBytes()
    reader = spark.read.format("warc").option("payload", str(payload).lower()).option("readBytes", most)
    return reader.load(path)


def archived_pages(pages: DataFrame, path: str | None = None, **how) -> DataFrame:
    """Write ``pages`` to archives and read them back: (page_id, payload_bytes, payload_digest, record_type, refers_to).

    Responses are measured and hashed from the payload read back; of revisits the
    headers tell, and no payload is inflated for them.
    """
    spark = pages.sparkSession
    path = write_archives(page_records(pages, **how), path or scratch_path(spark, "warc"))

    def number(c):
        return F.regexp_extract(c, r"<urn:page:(-?\d+)>", 1).try_cast("long")
    responses = read_archives(spark, path).where(F.col("record_type") == "response").select(
        number("record_id").alias("page_id"), F.octet_length("payload").cast("long").alias("payload_bytes"),
        F.sha1("payload").alias("payload_digest"), "record_type", F.lit(None).cast("long").alias("refers_to"))
    revisits = read_archives(spark, path, payload=False).where(F.col("record_type") == "revisit").select(
        number("record_id").alias("page_id"), F.col("payload_length").cast("long").alias("payload_bytes"),
        F.substring_index("payload_digest", ":", -1).alias("payload_digest"), "record_type",
        number("refers_to").alias("refers_to"))
    return responses.union(revisits)


WARC_SQL = """
WITH p AS (
  SELECT page_id, coalesce(html, '') AS body, sha1(coalesce(html, '')) AS digest,
    octet_length(encode(coalesce(html, ''))) AS bytes FROM pages),
h AS (SELECT body, max(page_id) AS holder FROM p WHERE bytes >= 1000 GROUP BY body)
SELECT page_id, bytes AS payload_bytes, digest AS payload_digest,
  CASE WHEN holder <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN holder <> page_id THEN holder END AS refers_to
FROM p LEFT JOIN h ON p.body = h.body AND bytes >= 1000
"""
