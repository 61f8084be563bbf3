"""WARC records in seekable Zstandard bundles.

Each task writes its records to one bundle: independent Zstandard frames of
whole records, then a skippable frame with the seek table (sizes of every
frame). An index table maps record identifiers to bundle, frame and the offset
inside the frame, so a reader fetches one frame for one record. Bundles lie in
the shared folder; a lost task's file is never listed in the index.
"""

from __future__ import annotations

import base64
import hashlib
import re
import struct
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from vigil.llm.common import importable, written
from vigil.session import shared_dir

# Fixed values of the seekable format: magic numbers of the skippable frame
# and of its footer.
SKIPPABLE_MAGIC = 0x184D2A5E
SEEKABLE_MAGIC = 0x8F92EAB1

INDEX = "bundle string, frame long, offset long, length long, page_id long"
RECORDS = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, payload binary"


def _header(fields: list[tuple[str, object]]) -> bytes:
    return ("WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields) + "\r\n").encode()


def _safe(url: str) -> str:
    return re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url)


def record_bytes(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None, revisit: bool, date: str) -> bytes:
    """One WARC record; a revisit carries the digest and length of the payload
    but not the payload."""
    digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
    block = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    fields = [("WARC-Type", "revisit" if revisit else "response"), ("WARC-Record-ID", f"<urn:page:{'' if page_id is None else page_id}>"),
              ("WARC-Target-URI", _safe(url or "about:blank")), ("WARC-Date", date),
              ("WARC-Payload-Digest", f"sha1:{digest}"), ("X-Payload-Length", len(payload))]
    if revisit:
        fields += [("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"),
                   ("WARC-Refers-To", f"<urn:page:{refers_to}>")]
    else:
        block += payload
    fields += [("Content-Type", "application/http; msgtype=response"), ("Content-Length", len(block))]
    return _header(fields) + block + b"\r\n\r\n"


def parse_record(raw: bytes) -> dict:
    """The fields of a record and its payload (None for a revisit); checks the
    lengths and, for a response, the digest."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    if lines[0] != "WARC/1.1":
        raise ValueError("not a WARC record")
    field = dict(x.split(": ", 1) for x in lines[1:])
    block = rest[:int(field["Content-Length"])]
    if rest[len(block):] != b"\r\n\r\n":
        raise ValueError("record length and block differ")
    page = lambda k: int(x) if (x := field.get(k, "<urn:page:>")[len("<urn:page:"):-1]) else None
    payload = block.partition(b"\r\n\r\n")[2] if field["WARC-Type"] == "response" else None
    digest, size = field["WARC-Payload-Digest"].removeprefix("sha1:"), int(field["X-Payload-Length"])
    if payload is not None:
        size, found = len(payload), base64.b32encode(hashlib.sha1(payload).digest()).decode()
        if found != digest:
            raise ValueError("payload digest differs")
    return {"page_id": page("WARC-Record-ID"), "payload_bytes": size, "payload_digest": digest,
            "record_type": field["WARC-Type"], "refers_to": page("WARC-Refers-To"), "payload": payload}


class BundleWriter:
    """Frames of about ``frame_bytes`` with a footer seek table."""

    def __init__(self, out, frame_bytes: int, level: int):
        import zstandard
        self.out, self.frame_bytes = out, frame_bytes
        self.zip = zstandard.ZstdCompressor(level=level)
        self.sizes: list[tuple[int, int]] = []
        self.held, self.held_bytes = [], 0

    def add(self, raw: bytes) -> tuple[int, int, int]:
        """(frame, offset in the frame, length)"""
        if self.held and self.held_bytes + len(raw) > self.frame_bytes:
            self.flush()
        at = (len(self.sizes), self.held_bytes, len(raw))
        self.held.append(raw)
        self.held_bytes += len(raw)
        return at

    def flush(self) -> None:
        if self.held:
            packed = self.zip.compress(b"".join(self.held))
            self.out.write(packed)
            self.sizes.append((len(packed), self.held_bytes))
            self.held, self.held_bytes = [], 0

    def close(self) -> None:
        self.flush()
        table = b"".join(struct.pack("<II", *x) for x in self.sizes)
        footer = struct.pack("<IBI", len(self.sizes), 0, SEEKABLE_MAGIC)
        self.out.write(struct.pack("<II", SKIPPABLE_MAGIC, len(table) + len(footer)) + table + footer)
        self.out.close()


class BundleReader:
    """Reads single frames by the seek table at the end of the file."""

    def __init__(self, file):
        import zstandard
        self.file, self.unzip = file, zstandard.ZstdDecompressor()
        end = file.size()
        n, _, magic = struct.unpack("<IBI", self._at(end - 9, 9))
        if magic != SEEKABLE_MAGIC:
            raise ValueError("no seek table")
        sizes = np.frombuffer(self._at(end - 9 - 8 * n, 8 * n), "<u4").reshape(n, 2).astype(np.int64)
        self.packed, self.plain = sizes[:, 0], sizes[:, 1]
        self.start = np.concatenate([[0], np.cumsum(self.packed)])

    def _at(self, start: int, length: int) -> bytes:
        self.file.seek(int(start))
        return self.file.read(int(length))

    def frame(self, i: int) -> bytes:
        return self.unzip.decompress(self._at(self.start[i], self.packed[i]), max_output_size=int(self.plain[i]))


def _writer(root: str, frame_bytes: int, level: int, date: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs
        system, folder = fs.FileSystem.from_uri(root)
        bundle = None
        for b in batches:
            if not len(b):
                continue
            if bundle is None:
                system.create_dir(folder, recursive=True)
                name = f"part-{uuid.uuid4().hex}.warc.zst"
                bundle = BundleWriter(system.open_output_stream(f"{folder}/{name}", compression=None), frame_bytes, level)
            rows = zip(*(b.column(c).to_pylist() for c in ("page_id", "url", "payload", "refers_to", "revisit")), strict=True)
            at = [bundle.add(record_bytes(i, url, (html or "").encode(), to, again, date)) for i, url, html, to, again in rows]
            frame, offset, length = (pa.array(x, pa.int64()) for x in zip(*at, strict=True))
            yield pa.RecordBatch.from_arrays([pa.array([name] * len(b)), frame, offset, length, b.column("page_id")],
                                             ["bundle", "frame", "offset", "length", "page_id"])
        if bundle:
            bundle.close()
    return run


def _reader(root: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs
        system, folder = fs.FileSystem.from_uri(root)
        name = reader = frame = data = None
        schema = pa.schema([("page_id", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()),
                            ("record_type", pa.string()), ("refers_to", pa.int64()), ("payload", pa.binary())])
        for b in batches:
            out, held = [], 0
            for bundle, i, offset, length in zip(*(b.column(c).to_pylist() for c in ("bundle", "frame", "offset", "length")), strict=True):
                if bundle != name:
                    name, frame = bundle, None
                    reader = BundleReader(system.open_input_file(f"{folder}/{name}"))
                if i != frame:
                    frame, data = i, reader.frame(i)
                out.append(parse_record(data[offset:offset + length]))
                held += length
                if held > 1 << 24:
                    yield pa.RecordBatch.from_pylist(out, schema)
                    out, held = [], 0
            yield pa.RecordBatch.from_pylist(out, schema)
    return run


def write_pages(pages: DataFrame, root: str, min_bytes: int = 0, frame_bytes: int = 1 << 18, level: int = 3,
                date: str = "2000-01-01T00:00:00Z") -> DataFrame:
    """Write a WARC record per row of ``pages`` (page_id, url, html; other
    columns are ignored) to bundles under ``root`` and return the index table.

    The payload is the html in UTF-8 (null: empty). Of records with equal
    payloads of at least ``min_bytes`` bytes the one with the largest page_id is
    the response and the others revisit it; smaller ones are all responses. A
    null page_id is below every id (a group with null ids only: all
    responses); of rows repeated with the largest page_id the first by url (null
    last) is the response; a null url is written as about:blank; an empty table
    writes no bundle.
    """
    importable(pages.sparkSession)
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), "url",
                        F.coalesce(F.col("html"), F.lit("")).alias("payload"))
    rows = rows.withColumn("sha", F.unhex(F.sha2("payload", 256)))
    ids = rows.where(F.octet_length("payload") >= min_bytes).groupBy("sha", "page_id").agg(F.count(F.lit(1)).alias("n"))
    keep = written(ids.groupBy("sha").agg(F.max("page_id").alias("refers_to"), F.sum("n").alias("n"),
                                          F.max_by("n", "page_id").alias("n_top")).where(F.col("n") > 1), "warc-repeated")
    top = F.col("refers_to").eqNullSafe(F.col("page_id")) & F.col("refers_to").isNotNull()
    joined = rows.join(keep, "sha", "left").withColumn("tied", F.coalesce(top & (F.col("n_top") > 1), F.lit(False)))
    revisit = F.col("refers_to").isNotNull() & (F.col("page_id").isNull() | (F.col("page_id") < F.col("refers_to")))
    linked = joined.where("not tied").withColumn("revisit", revisit)
    if not keep.where(F.col("refers_to").isNotNull() & (F.col("n_top") > 1)).isEmpty():
        # only rows that repeat the largest id of their payload are numbered
        first = Window.partitionBy("sha").orderBy(F.col("url").asc_nulls_last())
        linked = linked.unionByName(joined.where("tied").withColumn("revisit", F.row_number().over(first) > 1))
    linked = linked.select("page_id", "url", "payload", F.when(F.col("revisit"), F.col("refers_to")).alias("refers_to"), "revisit")
    return written(linked.mapInArrow(_writer(root, frame_bytes, level, date), INDEX), "warc-index")


def read_records(index: DataFrame, root: str) -> DataFrame:
    """The records that ``index`` lists, read frame by frame from the bundles:
    page_id, payload_bytes, payload_digest (bare base32 SHA-1), record_type,
    refers_to and payload (null for a revisit). Filter the index first to read
    single records."""
    # a stated number of tasks: the index rows are few, the frames behind them are not
    spark = index.sparkSession
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)
    dealt = index.repartition(tasks, "bundle").sortWithinPartitions("bundle", "frame", "offset")
    return dealt.mapInArrow(_reader(root), RECORDS)


def archive_pages(pages: DataFrame, **options) -> DataFrame:
    """Write ``pages`` to bundles in the shared folder and read all of them back."""
    root = shared_dir(pages.sparkSession, "warc")
    return read_records(write_pages(pages, root, **options), root)
