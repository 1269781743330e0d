"""Seekable Zstandard bundles of WARC records.

Each task writes its rows to bundle files: records are grouped into independent
Zstandard frames of about ``FRAME_BYTES``, a seek table of all frames closes the
file (a skippable frame in the seekable format), and an index maps every record
to (path, frame, offset inside the frame). Payloads are deduplicated first by
digest over narrow rows; equal ones become revisit records that refer to the
record of the smallest page id. Bundles are written below another name and then
renamed, so a repeated task attempt replaces a file by the same bytes.

Files go through Arrow's file systems (local or shared folders, HDFS, object
stores) from the tasks themselves; payloads never pass the driver, and readers
hold one frame at a time.

Defined cases: null html is an empty payload; null urls are left out; control
characters in urls are percent-encoded; payloads under ``least`` bytes are
always responses; repeated rows each give a record (those with the smallest page
id are responses under one record id); null page ids are written without an id
and never referred to unless all ids of the payload are null (then all are
responses); an empty table gives no bundles; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import io
import struct
import uuid

import pyarrow as pa
import zstandard
from pyarrow import fs as arrow_fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lokum.llm.common import col, stable, with_uid, work_path, work_table

LEAST_BYTES = 100
FRAME_BYTES = 1 << 20
BUNDLE_BYTES = 256 << 20
READ_BYTES = 16 << 20  # compressed frames that a reading task gets
DATE = "1970-01-01T00:00:00Z"  # the tables hold no capture time
# fixed values: magic numbers of the seekable format, profile of the WARC standard
SEEK_FRAME, SEEK_FOOTER = 0x184D2A5E, 0x8F92EAB1
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
NAMESPACE = uuid.UUID(int=0x6C6F6B756D)
INDEX = "page_id long, record_id string, path string, frame int, offset long, length long"


def record_id(page_id, digest: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(NAMESPACE, f'{page_id}:{digest}')}>"


def record(page_id, url: str | None, payload: bytes, digest: str, refers_to) -> tuple[str, bytes]:
    """(record id, bytes) of one record; a revisit if ``refers_to`` is a page id."""
    own = record_id(page_id, digest)
    http = (f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
            f"Content-Length: {len(payload)}\r\n\r\n").encode()
    head = ["WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}", f"WARC-Record-ID: {own}",
            f"WARC-Date: {DATE}", f"WARC-Payload-Digest: sha256:{digest}",
            "Content-Type: application/http; msgtype=response"]
    if page_id is not None:
        head.append(f"WARC-Page-ID: {page_id}")
    if url is not None:
        safe = "".join(f"%{ord(c):02X}" if ord(c) < 33 or ord(c) == 127 else c for c in url)
        head.append(f"WARC-Target-URI: {safe}")
    if refers_to is not None:
        head += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: {record_id(refers_to, digest)}"]
        payload = b""
    head.append(f"Content-Length: {len(http) + len(payload)}")
    return own, "\r\n".join(head).encode("utf-8", "surrogatepass") + b"\r\n\r\n" + http + payload + b"\r\n\r\n"


class Bundle:
    """Writes frames and the closing seek table to one file."""

    def __init__(self, system: arrow_fs.FileSystem, folder: str, name: str, attempt: str):
        self.system, self.path, self.part = system, f"{folder}/{name}", f"{folder}/.{name}.{attempt}"
        self.out = system.open_output_stream(self.part)
        self.pack = zstandard.ZstdCompressor(level=3)
        self.frames: list[tuple[int, int]] = []
        self.buffer, self.size, self.written = [], 0, 0

    def add(self, data: bytes) -> tuple[int, int]:
        """(frame, offset in it)"""
        if self.size and self.size + len(data) > FRAME_BYTES:
            self.flush()
        at = (len(self.frames), self.size)
        self.buffer.append(data)
        self.size += len(data)
        return at

    def flush(self) -> None:
        if self.size:
            frame = self.pack.compress(b"".join(self.buffer))
            self.out.write(frame)
            self.frames.append((len(frame), self.size))
            self.written += len(frame)
            self.buffer, self.size = [], 0

    def close(self) -> None:
        self.flush()
        table = b"".join(struct.pack("<II", *f) for f in self.frames)
        table += struct.pack("<IBI", len(self.frames), 0, SEEK_FOOTER)
        self.out.write(struct.pack("<II", SEEK_FRAME, len(table)) + table)
        self.out.close()
        if self.system.get_file_info(self.path).type != arrow_fs.FileType.NotFound:
            self.system.delete_file(self.path)
        self.system.move(self.part, self.path)


def open_folder(uri: str) -> tuple[arrow_fs.FileSystem, str]:
    return arrow_fs.FileSystem.from_uri(uri if "://" in uri or uri.startswith("/") else uri.replace(":/", ":///", 1))


def write_bundles(pages: DataFrame, folder: str, id_col: str = "page_id", url_col: str = "url",
                  html_col: str = "html", least: int = LEAST_BYTES) -> DataFrame:
    """Writes the bundles to ``folder`` (a URI that all workers see); returns the
    index, a row per record."""
    pages = stable(pages)
    payload = F.coalesce(col(html_col), F.lit(""))
    own = pages.select(col(id_col).cast("long").alias("page_id"), col(url_col).alias("url"), payload.alias("html"),
                       F.sha2(payload, 256).alias("digest"), F.octet_length(payload).alias("bytes"))
    narrow = work_table(with_uid(own, "uid").where(F.col("bytes") >= least)
                        .select("uid", "page_id", F.unhex("digest").alias("digest")), "payloads")
    first = (narrow.groupBy("digest").agg(F.min("page_id").alias("first"), F.count(F.lit(1)).alias("n"))
             .where("n > 1 and first is not null").drop("n"))
    revisits = work_table(narrow.join(first, "digest").where("not page_id <=> first").select("uid", "first"), "revisits")
    rows = (with_uid(own, "uid").join(revisits, "uid", "left")
            .select("page_id", "url", "html", "digest", "first"))

    def run(batches):
        system, at = open_folder(folder)
        system.create_dir(at, recursive=True)
        task = TaskContext.get()
        bundle, made = None, 0
        for b in batches:
            out: list[tuple] = []
            for page_id, url, html, digest, refers in zip(*(b.column(i) for i in range(5))):
                if bundle is None or bundle.written > BUNDLE_BYTES:
                    if bundle:
                        bundle.close()
                    bundle = Bundle(system, at, f"{task.partitionId():06d}-{made:04d}.warc.zst", str(task.taskAttemptId()))
                    made += 1
                rid, data = record(page_id.as_py(), url.as_py(), html.as_py().encode("utf-8", "surrogatepass"),
                                   digest.as_py(), refers.as_py())
                out.append((page_id.as_py(), rid, bundle.path, *bundle.add(data), len(data)))
            if out:
                cols = list(zip(*out))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(cols, (pa.int64(), pa.string(), pa.string(), pa.int32(),
                                                           pa.int64(), pa.int64()))],
                    ["page_id", "record_id", "path", "frame", "offset", "length"])
        if bundle:
            bundle.close()

    return work_table(rows.mapInArrow(run, INDEX), "index")


def seek_table(system: arrow_fs.FileSystem, path: str) -> list[tuple[int, int, int]]:
    """(start in the file, compressed size, size) of a bundle's frames."""
    with system.open_input_file(path) as f:
        end = f.size()
        f.seek(end - 9)
        n, _, magic = struct.unpack("<IBI", f.read(9))
        if magic != SEEK_FOOTER:
            raise ValueError(f"no seek table: {path}")
        f.seek(end - 9 - 8 * n)
        sizes = list(struct.iter_unpack("<II", f.read(8 * n)))
    out, at = [], 0
    for packed, size in sizes:
        out.append((at, packed, size))
        at += packed
    return out


def records(data: bytes):
    """(offset, headers, payload) of a frame's records."""
    f, end = io.BytesIO(data), len(data)
    while f.tell() < end:
        at = f.tell()
        head = {}
        f.readline()
        while (line := f.readline()) not in (b"\r\n", b""):
            k, _, v = line.decode("utf-8", "surrogatepass").rstrip("\r\n").partition(": ")
            head[k] = v
        block = f.read(int(head["Content-Length"]))
        f.read(4)
        yield at, head, block[block.index(b"\r\n\r\n") + 4:]


def read_record(folder: str, path: str, frame: int, offset: int) -> tuple[dict, bytes]:
    """One record by its index entry: decompresses its frame only."""
    system, _ = open_folder(folder)
    start, packed, _ = seek_table(system, path)[frame]
    with system.open_input_file(path) as f:
        f.seek(start)
        data = zstandard.ZstdDecompressor().decompress(f.read(packed))
    return next((h, p) for at, h, p in records(data) if at == offset)


def read_bundles(spark: SparkSession, paths: DataFrame, folder: str) -> DataFrame:
    """Reads bundles (``path`` column) frame by frame: record_id, page_id, type,
    refers_to (a record id), payload_bytes and payload_digest of the payload that
    the record holds (for revisits: the digest it states)."""

    def frames(batches):
        system, _ = open_folder(folder)
        for b in batches:
            for p in b.column(0).to_pylist():
                t = seek_table(system, p)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([p] * len(t), pa.string()), pa.array([x[0] for x in t], pa.int64()),
                     pa.array([x[1] for x in t], pa.int64())], ["path", "start", "packed"])

    def read(batches):
        system, _ = open_folder(folder)
        unpack = zstandard.ZstdDecompressor()
        for b in batches:
            for path, start, packed in zip(*(c.to_pylist() for c in b.columns)):
                with system.open_input_file(path) as f:
                    f.seek(start)
                    data = unpack.decompress(f.read(packed))
                out = []
                for _, h, payload in records(data):
                    page = h.get("WARC-Page-ID")
                    response = h["WARC-Type"] == "response"
                    out.append((h["WARC-Record-ID"], None if page is None else int(page), h["WARC-Type"],
                                h.get("WARC-Refers-To"), len(payload) if response else None,
                                hashlib.sha256(payload).hexdigest() if response
                                else h["WARC-Payload-Digest"].removeprefix("sha256:")))
                kinds = (pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, k) for c, k in zip(zip(*out), kinds)],
                    ["record_id", "page_id", "type", "refers_to", "payload_bytes", "payload_digest"])

    table = work_table(paths.select("path").distinct().mapInArrow(
        frames, "path string, start long, packed long"), "frames")
    packed = table.agg(F.sum("packed")).first()[0] or 0
    return (table.repartition(max(1, -(-packed // READ_BYTES)), "path", "start")
            .mapInArrow(read, "record_id string, page_id long, type string, refers_to string, "
                              "payload_bytes long, payload_digest string"))


def archive(pages: DataFrame, folder: str | None = None, **options) -> DataFrame:
    """Write, read back and resolve revisits: page_id, payload_bytes,
    payload_digest, record_type, refers_to (a page id), a row per page."""
    spark = pages.sparkSession
    folder = folder or work_path(spark, "warc")
    index = write_bundles(pages, folder, **options)
    got = work_table(read_bundles(spark, index, folder), "records")
    responses = got.where("type = 'response'")
    target = (responses.groupBy(F.col("record_id").alias("refers_to"))
              .agg(F.min("page_id").alias("target"), F.min("payload_bytes").alias("full")))
    revisits = (got.where("type = 'revisit'").join(target, "refers_to", "left")
                .select("page_id", F.col("full").alias("payload_bytes"), "payload_digest",
                        F.col("type").alias("record_type"), F.col("target").alias("refers_to")))
    return responses.select("page_id", "payload_bytes", "payload_digest", F.col("type").alias("record_type"),
                            F.lit(None).cast("long").alias("refers_to")).unionByName(revisits)
