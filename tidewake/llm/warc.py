"""WARC archives: a writer and a splittable reader.

Writing: a data source of Spark's. Each task writes one file, a warcinfo record and then
one for each row, each record one gzip member whatever its length, below a folder that readers pass over. When all tasks have
ended the driver moves the files that they named, so those of tasks that failed or ran twice never count.

Reading: files are cut into byte ranges. A task looks for the gzip magic in its
range, takes a candidate for a record if it decodes to a WARC header and is followed by another member or the file's end, reads on to
the record's end, even beyond the range, and goes on from there while records
begin inside. Bytes are read and written through pyarrow's file systems, files listed through
Hadoop's. A run of stored (not deflated) WARC members inside a payload may be taken for records
if a range begins inside that payload.

Null html is an empty payload, a null url leaves WARC-Target-URI out, a row with a
null page_id gets a record without a number and is always a response. Of rows with
the same largest page_id and payload, all are responses. An empty table makes an
archive without records of pages. A payload is held by one task, however long. Other columns are ignored, so none can clash.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage

from tidewake.llm.common import attach, shared_path, spread

MAGIC = b"\x1f\x8b\x08"
LEAST_BYTES = 1000
RANGE_BYTES = 16 << 20
STEP = 1 << 17
RECORD_URN = "urn:x-page:"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def with_originals(pages: DataFrame, least_bytes: int = LEAST_BYTES) -> DataFrame:
    """page_id, url, payload, payload_digest, refers_to: the page whose record a page's own refers to, or null for a response."""
    rows = pages.select("page_id", "url", F.coalesce(F.col("html"), F.lit("")).cast("binary").alias("payload"))
    rows = rows.withColumn("payload_digest", F.sha1("payload"))
    rows = rows.withColumn("_equal", F.when(F.octet_length("payload") >= least_bytes, F.col("payload_digest")))
    groups = rows.where("_equal IS NOT NULL").groupBy("_equal").agg(F.max("page_id").alias("last"), F.count("*").alias("n")).where("n > 1")
    rows = attach(rows, groups, "_equal", spread(F.col("page_id"), F.col("url")), pages.count())
    return rows.select("page_id", "url", "payload", "payload_digest", F.when(F.col("last") > F.col("page_id"), F.col("last")).alias("refers_to"))


def record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None, date: str) -> bytes:
    """One record, not compressed."""
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    block = http + payload if refers_to is None else http
    name = lambda i: f"<{RECORD_URN}{'' if i is None else i}>"
    fields = [
        ("WARC-Type", "response" if refers_to is None else "revisit"),
        ("WARC-Record-ID", name(page_id)),
        ("WARC-Date", date),
        ("WARC-Payload-Digest", "sha1:" + base64.b32encode(bytes.fromhex(digest)).decode()),
        ("Content-Type", "application/http;msgtype=response"),
        ("Content-Length", str(len(block))),
    ]
    if url is not None:
        fields.append(("WARC-Target-URI", re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url)))
    if refers_to is not None:
        fields += [("WARC-Refers-To", name(refers_to)), ("WARC-Profile", PROFILE)]
    return b"WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields).encode() + b"\r\n" + block + b"\r\n\r\n"


def member(data: bytes, level: int = 6) -> bytes:
    """data as one gzip member."""
    z = zlib.compressobj(level, zlib.DEFLATED, 31)
    return z.compress(data) + z.flush()


def info(date: str) -> bytes:
    """The record that a file begins with, not compressed."""
    block = b"format: WARC File Format 1.1\r\n"
    fields = [("WARC-Type", "warcinfo"), ("WARC-Record-ID", f"<urn:uuid:{uuid.uuid4()}>"), ("WARC-Date", date), ("Content-Type", "application/warc-fields"), ("Content-Length", str(len(block)))]
    return b"WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields).encode() + b"\r\n" + block + b"\r\n\r\n"


def _store(uri: str) -> tuple:
    """A file system of pyarrow's, and the place in it."""
    from pyarrow import fs

    if uri.startswith(("file:", "/")):
        return fs.LocalFileSystem(), "/" + uri.removeprefix("file:").lstrip("/")
    return fs.FileSystem.from_uri(re.sub(r"^s3[an]:", "s3:", uri))


def _open(uri: str):
    store, path = _store(uri)
    return store.open_input_file(path)


@dataclass
class Written(WriterCommitMessage):
    name: str


class WarcWriter(DataSourceArrowWriter):
    """Files of records of rows (page_id, url, payload, payload_digest, refers_to)."""

    def __init__(self, path: str, date: str):
        self.path, self.date, self.job = path, date, f"_writing-{uuid.uuid4().hex}"

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        from pyspark import TaskContext

        store, path = _store(self.path)
        name = f"part-{TaskContext.get().partitionId():05d}-{uuid.uuid4().hex}.warc.gz"
        store.create_dir(f"{path}/{self.job}", recursive=True)
        with store.open_output_stream(f"{path}/{self.job}/{name}", compression=None) as out:
            out.write(member(info(self.date)))
            for b in iterator:
                for at in range(0, b.num_rows, 500):
                    for row in zip(*(c.to_pylist() for c in b.slice(at, 500).columns), strict=True):
                        out.write(member(record(*row, self.date)))
        return Written(name)

    def commit(self, messages: list[Written]) -> None:
        store, path = _store(self.path)
        for m in messages:
            if m is not None:
                store.move(f"{path}/{self.job}/{m.name}", f"{path}/{m.name}")
        self.abort(messages)

    def abort(self, messages: list[Written]) -> None:
        from pyarrow import fs

        store, path = _store(self.path)
        if store.get_file_info(f"{path}/{self.job}").type != fs.FileType.NotFound:
            store.delete_dir(f"{path}/{self.job}")


class WarcSink(DataSource):
    @classmethod
    def name(cls) -> str:
        return "tidewake_warc"

    def writer(self, schema, overwrite: bool) -> WarcWriter:
        if overwrite:
            raise ValueError("archives are only added to")
        return WarcWriter(self.options["path"], self.options["date"])


def write_warc(pages: DataFrame, path: str, date: str = "1970-01-01T00:00:00Z", least_bytes: int = LEAST_BYTES) -> None:
    """Writes a record for each page to new files in the folder path."""
    pages.sparkSession.dataSource.register(WarcSink)
    with_originals(pages, least_bytes).write.format(WarcSink.name()).mode("append").option("date", date).save(path)


def files(spark: SparkSession, path: str) -> list[tuple[str, int]]:
    """The files below path and their sizes, as Hadoop lists them."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    store = place.getFileSystem(spark._jsc.hadoopConfiguration())
    found, todo = [], [place]
    while todo:
        for s in store.listStatus(todo.pop()):
            if s.getPath().getName()[0] not in "_.":
                todo.append(s.getPath()) if s.isDirectory() else found.append((s.getPath().toString(), s.getLen()))
    return sorted(found)


class Bytes:
    """Random access to a file, some of which is at hand."""

    def __init__(self, file, at: int, size: int):
        self.file, self.at, self.held = file, at, file.read_at(size, at)

    def get(self, at: int, size: int) -> bytes:
        inside = at - self.at
        if 0 <= inside < len(self.held):
            return self.held[inside : inside + size]
        return self.file.read_at(size, at)


def decode(source: Bytes, at: int) -> tuple[bytes, dict[str, str], bytes, int] | None:
    """Version, fields and block of the record that begins at a place, and where it ends; None if none does."""
    data, need, head = bytearray(), None, 0
    try:
        while need is None or len(data) < need:
            z = zlib.decompressobj(31)
            while not z.eof:
                chunk = source.get(at, STEP if need else 1024)
                if not chunk:
                    return None
                data += z.decompress(chunk)
                at += len(chunk)
                if need is None:
                    if len(data) >= 7 and not data.startswith(b"WARC/1."):
                        return None
                    if (head := data.find(b"\r\n\r\n") + 4) > 3:
                        length = re.search(rb"(?i)\r\ncontent-length:\s*(\d+)", data[:head])
                        if not length:
                            return None
                        need = head + int(length[1]) + 4
            at -= len(z.unused_data)
    except zlib.error:
        return None
    version, *lines = data[: head - 4].decode("utf-8", "replace").split("\r\n")
    fields = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines)}
    return version.encode(), fields, bytes(data[head : need - 4]), at


def records_of(file, start: int, end: int) -> Iterator[tuple[int, dict[str, str], bytes]]:
    """Place, fields and block of each record that begins in [start, end)."""
    source, at, sure = Bytes(file, start, end - start + STEP), start, start == 0
    while at < end:
        if source.get(at, 3) != MAGIC:
            at, sure = (source.at + found if (found := source.held.find(MAGIC, at - source.at)) >= 0 else end), False
            continue
        if (got := decode(source, at)) is None or not sure and not MAGIC.startswith(source.get(got[3], 3)):
            at += 1
            continue
        yield at, got[1], got[2]
        at, sure = got[3], True


SCHEMA = "file string, offset bigint, record_type string, record_id string, target_uri string, warc_date string, refers_to string, payload_digest string, http_length bigint, payload binary"


def read_warc(spark: SparkSession, path: str, range_bytes: int = RANGE_BYTES, payload: bool = True) -> DataFrame:
    """A row for each record below path (SCHEMA). payload_digest: lower-case hex SHA-1, of the payload itself for all but revisits, whose header is taken."""
    listed = files(spark, path)
    ranges = sum(-(-size // range_bytes) for _, size in listed)
    df = spark.createDataFrame(listed, "file string, size bigint").where("size > 0")
    df = df.select("file", "size", F.explode(F.sequence(F.lit(0).cast("long"), F.col("size") - 1, F.lit(range_bytes).cast("long"))).alias("start"))
    df = df.repartition(max(ranges, 1), "file", "start")

    def row(name: str, at: int, f: dict[str, str], block: bytes) -> tuple:
        http, length, body = b"", None, block
        if f.get("content-type", "").replace(" ", "").lower().startswith("application/http") and (cut := block.find(b"\r\n\r\n")) >= 0:
            http, body = block[: cut + 4], block[cut + 4 :]
            length = int(m[1]) if (m := re.search(rb"(?i)\r\ncontent-length:\s*(\d+)", http)) else None
        digest = hashlib.sha1(body).hexdigest()
        if f.get("warc-type") == "revisit":
            label = f.get("warc-payload-digest", "")
            digest = base64.b32decode(label[5:]).hex() if re.fullmatch(r"sha1:[A-Z2-7]{32}", label) else label.partition(":")[2] or None
        return name, at, f.get("warc-type"), f.get("warc-record-id"), f.get("warc-target-uri"), f.get("warc-date"), f.get("warc-refers-to"), digest, length, body if payload else None

    kinds = pa.schema([(n, {"string": pa.string(), "bigint": pa.int64(), "binary": pa.binary()}[k]) for n, k in (x.split() for x in SCHEMA.split(", "))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for name, size, start in zip(*(c.to_pylist() for c in b.columns), strict=True):
                rows, held = [], 0
                with _open(name) as file:
                    for at, fields, block in records_of(file, start, min(start + range_bytes, size)):
                        rows.append(row(name, at, fields, block))
                        held += len(block)
                        if held > 8 << 20:
                            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds.types, strict=True)], schema=kinds)
                            rows, held = [], 0
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds.types, strict=True)], schema=kinds)

    return df.mapInArrow(run, SCHEMA)


def archived(pages: DataFrame) -> DataFrame:
    """pages, written to the shared folder as archives and read back."""
    path = shared_path(pages.sparkSession, "warc")
    write_warc(pages, path)
    return read_warc(pages.sparkSession, path, payload=False).where("record_type <> 'warcinfo'")


def page_number(urn: F.Column) -> F.Column:
    """The page_id in a record's name."""
    return F.nullif(F.regexp_extract(urn, RECORD_URN + r"(-?\d*)>", 1), F.lit("")).cast("bigint")
