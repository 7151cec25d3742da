"""Web archives in Zstandard frames: a writer with revisit records, and the reader.

An archive begins with a skippable frame that holds the dictionary; every record is a frame of
its own. The reader takes the dictionary from there, decodes frame by frame, and checks the
headers, lengths and digests of each record.
"""

from __future__ import annotations

import base64
import hashlib
import struct
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyarrow import fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_dir
from . import common

DICTIONARY_MAGIC = 0x184D2A5D
FRAME_MAGIC = 0xFD2FB528
ARCHIVE_BYTES = 8 << 20         # an archive is closed at this size
SAMPLE_PAGES = 200              # bound of the sample that the dictionary is trained on
SAMPLE_BYTES = 16 << 10         # of each of its pages
DICTIONARY_BYTES = 64 << 10
LEVEL = 3
DATE = "1970-01-01T00:00:00Z"   # the pages carry no date
REQUIRED = ("warc-type", "warc-record-id", "warc-date", "content-length")
_CHUNK = 64 << 10

READ = ("record_id string, record_type string, refers_to string, target string, "
        "payload_bytes long, payload_digest string, payload binary, error string")


def digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record_id(page: int | None) -> str:
    return f"<urn:page:{'' if page is None else page}>"


def train(pages: DataFrame, html: str = "html") -> bytes:
    """A dictionary from a bounded sample of the pages; empty if they are too few or too alike."""
    begins = pages.select(F.substring(F.col(html), 1, SAMPLE_BYTES).alias("t"))
    rows = common.hashed_sample(begins, "t", SAMPLE_PAGES)
    samples = [r["t"].encode() for r in rows if r["t"]]
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, samples).as_bytes()
    except (zstandard.ZstdError, ValueError):
        return b""


def record(page: int | None, url: str | None, payload: bytes, first: int | None,
           revisit: bool) -> bytes:
    """One record; a revisit names the response that has its payload and leaves it out."""
    http = (f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
            f"Content-Length: {len(payload)}\r\n\r\n").encode()
    block = http if revisit else http + payload
    target = "".join(c if c > " " and c != "\x7f" else f"%{ord(c):02X}" for c in url or "")
    lines = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}",
             f"WARC-Record-ID: {record_id(page)}", f"WARC-Date: {DATE}",
             f"WARC-Target-URI: {target or f'urn:page:{page}'}",
             f"WARC-Payload-Digest: sha1:{digest(payload)}",
             f"WARC-Block-Digest: sha1:{digest(block)}",
             "Content-Type: application/http; msgtype=response",
             f"Content-Length: {len(block)}"]
    if revisit:
        lines += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/"
                  "identical-payload-digest", f"WARC-Refers-To: {record_id(first)}"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def open_folder(folder: str) -> tuple[pafs.FileSystem, str]:
    if "://" in folder or folder.startswith("file:"):
        return pafs.FileSystem.from_uri(folder)
    return pafs.LocalFileSystem(), folder


def write(pages: DataFrame, folder: str, page_id: str = "page_id", url: str = "url",
          html: str = "html") -> int:
    """Write the pages as archives into `folder`; returns the number of records.

    Null pages have an empty payload. Of equal payloads the smallest page id is the response
    and other ids revisit it; equal rows of one id are one capture, all responses. Rows without
    an id revisit the response with an id, if there is one, and are responses otherwise.
    Files are named by partition and written whole or not at all, and the rows of a partition
    have a fixed order, so a repeated task replaces its own files.
    """
    spark = pages.sparkSession
    rows = pages.select(F.col(page_id).cast("long").alias("page"), F.col(url).alias("url"),
                        F.coalesce(F.col(html), F.lit("")).alias("html"))
    trained = spark.sparkContext.broadcast(train(rows))
    rows = rows.withColumn("digest", F.sha1(F.col("html").cast("binary")))
    firsts = common.store(rows.groupBy("digest").agg(F.min("page").alias("first")), "firsts")
    rows = rows.join(firsts, "digest", "left").sortWithinPartitions("page", "digest", "url")
    system, base = open_folder(folder)
    system.create_dir(base, recursive=True)

    def save(batches):
        store, root = open_folder(folder)
        context = TaskContext.get()
        words = zstandard.ZstdCompressionDict(trained.value) if trained.value else None
        packer = zstandard.ZstdCompressor(level=LEVEL, dict_data=words)
        head = struct.pack("<II", DICTIONARY_MAGIC, len(trained.value)) + trained.value \
            if trained.value else b""
        held, size, count, k = [], 0, 0, 0

        def close() -> None:
            nonlocal held, size, k
            name = f"{root}/part-{context.partitionId():06d}-{k:04d}.warc.zst"
            scratch = f"{root}/_{context.partitionId()}-{k}-{context.taskAttemptId()}"
            with store.open_output_stream(scratch, compression=None) as f:
                f.write(head + b"".join(held))
            store.move(scratch, name)
            held, size, k = [], 0, k + 1

        for batch in batches:
            columns = [batch.column(c) for c in ("page", "url", "html", "first")]
            for i in range(batch.num_rows):
                page, link, text, first = (c[i].as_py() for c in columns)
                revisit = first is not None and page != first
                held.append(packer.compress(record(page, link, text.encode(), first, revisit)))
                size += len(held[-1])
                count += 1
                if size >= ARCHIVE_BYTES:
                    close()
        if held:
            close()
        yield pa.RecordBatch.from_arrays([pa.array([count], pa.int64())], ["n"])

    return rows.mapInArrow(save, "n long").agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]


def frames(data: bytes) -> Iterator[bytes]:
    """The decoded frames of an archive, with the dictionary of its leading frame."""
    at, words = 0, None
    while at < len(data):
        if len(data) - at < 8:
            raise ValueError("the archive ends inside a frame")
        magic, size = struct.unpack_from("<II", data, at)
        if magic & 0xFFFFFFF0 == 0x184D2A50:
            if at + 8 + size > len(data):
                raise ValueError("a skippable frame is cut off")
            if at == 0 and magic == DICTIONARY_MAGIC:
                raw = data[8:8 + size]
                if raw[:4] == struct.pack("<I", FRAME_MAGIC):
                    raw = zstandard.ZstdDecompressor().decompress(raw)
                words = zstandard.ZstdCompressionDict(raw)
            at += 8 + size
            continue
        if magic != FRAME_MAGIC:
            raise ValueError(f"no frame begins at byte {at}")
        decoder, out = zstandard.ZstdDecompressor(dict_data=words).decompressobj(), []
        while not decoder.eof:
            chunk = data[at:at + _CHUNK]
            if not chunk:
                raise ValueError("the last frame is cut off")
            out.append(decoder.decompress(chunk))
            at += len(chunk)
        at -= len(decoder.unused_data)
        yield b"".join(out)


def parse(frame: bytes) -> dict:
    """The record in a frame, checked; ValueError if a header, length or digest is wrong."""
    head, found, rest = frame.partition(b"\r\n\r\n")
    lines = head.decode("utf-8", "replace").split("\r\n")
    if not found or not lines[0].startswith("WARC/"):
        raise ValueError("no record header")
    fields = {}
    for line in lines[1:]:
        name, colon, value = line.partition(":")
        if not colon:
            raise ValueError(f"bad header line {line[:60]!r}")
        fields[name.strip().lower()] = value.strip()
    missing = [x for x in REQUIRED if x not in fields]
    if missing:
        raise ValueError(f"missing {', '.join(missing)}")
    if not fields["content-length"].isdigit():
        raise ValueError("Content-Length is no number")
    length = int(fields["content-length"])
    if len(rest) != length + 4 or rest[length:] != b"\r\n\r\n":
        raise ValueError(f"Content-Length {length}, {len(rest) - 4} bytes found")
    block = rest[:length]
    given = fields.get("warc-block-digest")
    if given is not None and given != f"sha1:{digest(block)}":
        raise ValueError("the block digest differs")
    kind = fields["warc-type"]
    http, found, payload = block.partition(b"\r\n\r\n")
    out = {"record_id": fields["warc-record-id"], "record_type": kind,
           "refers_to": fields.get("warc-refers-to"), "target": fields.get("warc-target-uri"),
           "payload_bytes": None, "payload_digest": None, "payload": None, "error": None}
    named = fields.get("warc-payload-digest", "").removeprefix("sha1:") or None
    if kind == "response":
        sizes = [x.partition(b":")[2] for x in http.split(b"\r\n")
                 if x.lower().startswith(b"content-length:")]
        if not found or sizes and int(sizes[0]) != len(payload):
            raise ValueError("the payload is not as long as its header says")
        out |= {"payload": payload, "payload_bytes": len(payload),
                "payload_digest": digest(payload)}
        if named is not None and named != out["payload_digest"]:
            raise ValueError("the payload digest differs")
    elif kind == "revisit":
        if out["refers_to"] is None or named is None:
            raise ValueError("a revisit without digest or reference")
        out["payload_digest"] = named
    return out


def read(spark: SparkSession, folder: str, payloads: bool = True) -> DataFrame:
    """The records of the archives in `folder`, one row each, with `error` where one is broken.

    A file that breaks off gives its sound records and one row with the error. An archive is
    read whole by one task; the writer bounds its size.
    """
    def run(batches):
        for batch in batches:
            for scalar in batch.column("content"):
                for rows in _checked(scalar.as_py()):
                    if not payloads:
                        for r in rows:
                            r["payload"] = None
                    yield pa.RecordBatch.from_pylist(rows, _SCHEMA)

    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.warc.zst").load(folder)
    return files.select("content").mapInArrow(run, READ)


_SCHEMA = pa.schema([("record_id", pa.string()), ("record_type", pa.string()),
                     ("refers_to", pa.string()), ("target", pa.string()),
                     ("payload_bytes", pa.int64()), ("payload_digest", pa.string()),
                     ("payload", pa.binary()), ("error", pa.string())])


def _checked(data: bytes, rows_at_once: int = 64) -> Iterator[list[dict]]:
    rows: list[dict] = []
    try:
        for frame in frames(data):
            try:
                rows.append(parse(frame))
            except ValueError as e:
                rows.append({"error": str(e)})
            if len(rows) == rows_at_once:
                yield rows
                rows = []
    except (ValueError, zstandard.ZstdError) as e:
        rows.append({"error": str(e)})
    if rows:
        yield rows


def resolved(records: DataFrame) -> DataFrame:
    """Records with the payload length of revisits, taken from the response they refer to.

    `error` says if that response is missing or has another digest.
    """
    small = common.store(records.drop("payload", "target"), "records")
    responses = common.store(small.where("record_type = 'response'").groupBy(
        F.col("record_id").alias("refers_to"), "payload_digest").agg(
            F.max("payload_bytes").alias("length")), "responses")
    out = small.join(responses, ["refers_to", "payload_digest"], "left")
    wrong = (F.col("record_type") == "revisit") & F.col("length").isNull()
    return out.select(
        "record_id", "record_type", "refers_to",
        F.coalesce("payload_bytes", "length").alias("payload_bytes"), "payload_digest",
        F.coalesce("error", F.when(wrong, "the response of a revisit is missing or another"))
        .alias("error"))


def round_trip(pages: DataFrame, page_id: str = "page_id", url: str = "url",
               html: str = "html") -> DataFrame:
    """Write the pages as archives, read them back: a row per page; broken records are errors."""
    spark = pages.sparkSession
    folder = scratch_dir(spark, "archives")
    written = write(pages, folder, page_id, url, html)
    if not written:
        return spark.createDataFrame([], "page_id long, payload_bytes long, "
                                     "payload_digest string, record_type string, refers_to long")
    found = resolved(read(spark, folder, payloads=False))
    page = F.regexp_extract("record_id", r"^<urn:page:(-?\d+)>$", 1)
    return found.select(
        F.when(F.col("error").isNotNull(), F.raise_error(F.col("error")))
        .otherwise(F.when(page != "", page.cast("long"))).cast("long").alias("page_id"),
        "payload_bytes", "payload_digest", "record_type",
        F.regexp_extract("refers_to", r"^<urn:page:(-?\d+)>$", 1).try_cast("long")
        .alias("refers_to"))
