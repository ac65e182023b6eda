"""Dictionary-compressed WARC archives (.warc.zst).

Each archive starts with a skippable frame (magic 0x184D2A5D) that holds a Zstandard dictionary
built from its own first records (trained, or raw content where there is too little to train on); then every record is one Zstandard frame compressed with that
dictionary, so a reader needs nothing but the file and can start at any record.

Pages are marked as response or revisit first (payload digests are grouped with map-side
combination and met again on the digest; Spark splits a hot digest's pages).  Every task then
writes archives of about ``ARCHIVE_BYTES`` of payload into the shared folder, under names that
carry its attempt, and returns a manifest row for each.  The manifest is a table: files of lost
or repeated attempts are in no manifest and are never read.
"""

from __future__ import annotations

import base64
import contextlib
import hashlib
import struct
import uuid
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs as pafs
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cinerank.session import checkpoint_root, materialize

ARCHIVE_BYTES = 32 << 20
DICTIONARY_BYTES = 64 << 10
SAMPLE_BYTES = 1 << 20  # records that a dictionary is built from, per archive
REVISIT_BYTES = 1000
LEVEL = 3
DATE = "2024-01-01T00:00:00Z"
#: Fixed values of the formats.
DICTIONARY_MAGIC = 0x184D2A5D
ZSTD_MAGIC = 0xFD2FB528
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

MANIFEST_SCHEMA = "path string, records long, bytes long"
RECORD_SCHEMA = ("page_id long, url string, record_type string, payload binary, payload_bytes long, "
                 "payload_digest string, refers_to long, intact boolean")


def mark_revisits(pages: DataFrame, *, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
                  revisit_bytes: int = REVISIT_BYTES) -> DataFrame:
    """(page_id, url, payload, digest, refers_to): refers_to is set on revisits.

    Of rows with equal payloads of at least ``revisit_bytes`` the largest id is the response and
    the others revisit it; rows that repeat the response's id, and rows whose group has null ids
    only, are responses.
    """
    rows = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"),
                        F.coalesce(F.col(html_col).cast("string"), F.lit("")).cast("binary").alias("payload")) \
        .withColumn("digest", F.sha1("payload"))
    large = F.octet_length("payload") >= revisit_bytes
    again = rows.filter(large).groupBy("digest").agg(F.max("page_id").alias("last"), F.count(F.lit(1)).alias("n")) \
        .filter("n > 1").select("digest", "last")
    met = rows.join(again, "digest", "left")
    return met.select("page_id", "url", "payload", "digest",
                      F.when(F.coalesce(F.col("page_id"), F.lit(-1)) != F.col("last"), F.col("last")).alias("refers_to"))


def _line(value: str) -> str:
    return value.replace("\r", "%0D").replace("\n", "%0A")


def record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None) -> bytes:
    """One WARC record; a revisit has the HTTP header only."""
    http = ("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
            f"Content-Length: {len(payload)}\r\n\r\n").encode()
    block = http if refers_to is not None else http + payload
    head = ["WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
            f"WARC-Record-ID: <urn:page:{'' if page_id is None else page_id}>", f"WARC-Date: {DATE}"]
    if url is not None:
        head.append(f"WARC-Target-URI: {_line(url)}")
    head.append("WARC-Payload-Digest: sha1:" + base64.b32encode(bytes.fromhex(digest)).decode())
    if refers_to is not None:
        head += [f"WARC-Refers-To: <urn:page:{refers_to}>", f"WARC-Profile: {REVISIT_PROFILE}"]
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def build_dictionary(records: list[bytes]) -> bytes:
    """A Zstandard dictionary from a bounded sample of records.

    Few, small or uniform records can't be trained on; the heads of the sample are the dictionary's raw
    content then (empty only below the 8 bytes that a dictionary takes).
    """
    sample, size = [], 0
    for r in records:
        if size >= SAMPLE_BYTES:
            break
        sample.append(r[:SAMPLE_BYTES])
        size += len(sample[-1])
    if len(sample) >= 8 and size >= 8 * 1024:
        with contextlib.suppress(zstandard.ZstdError):  # too uniform to train on
            return zstandard.train_dictionary(min(DICTIONARY_BYTES, size // 8), sample, k=256, d=8).as_bytes()
    if size < 8:
        return b""
    heads = [r for r in sample if r][:8]
    share = max(8, min(DICTIONARY_BYTES, size // 8) // len(heads))
    raw = b"".join(r[:share] for r in heads)
    return raw if len(raw) >= 8 else b"".join(sample)[:DICTIONARY_BYTES]


def encode_archive(records: list[bytes]) -> bytes:
    """The dictionary frame and one compressed frame per record."""
    raw = build_dictionary(records)
    packed = zstandard.ZstdCompressor(level=19).compress(raw) if raw else b""
    own = zstandard.ZstdCompressionDict(raw) if raw else None
    press = zstandard.ZstdCompressor(level=LEVEL, dict_data=own)
    out = [struct.pack("<II", DICTIONARY_MAGIC, len(packed)) + packed] if raw else []
    out += [press.compress(r) for r in records]
    return b"".join(out)


def decode_archive(data: bytes) -> Iterator[bytes]:
    """The records of an archive, one at a time."""
    at, own = 0, None
    if len(data) >= 8:
        magic, size = struct.unpack_from("<II", data)
        if magic == DICTIONARY_MAGIC:
            raw = data[8:8 + size]
            if raw[:4] == struct.pack("<I", ZSTD_MAGIC):  # the dictionary may be compressed itself
                raw = zstandard.ZstdDecompressor().decompress(raw)
            own = zstandard.ZstdCompressionDict(raw)
            at = 8 + size
    read = zstandard.ZstdDecompressor(dict_data=own) if own else zstandard.ZstdDecompressor()
    rest = memoryview(data)[at:]
    while len(rest):
        one = read.decompressobj()
        yield one.decompress(rest)
        rest = rest[len(rest) - len(one.unused_data):] if one.unused_data else rest[len(rest):]


def parse_record(raw: bytes) -> tuple:
    """A row of ``RECORD_SCHEMA`` from one record."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    field = dict(x.split(": ", 1) for x in head.decode().split("\r\n")[1:])
    block = rest[:int(field["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    size = int(dict(x.split(": ", 1) for x in http.decode().split("\r\n")[1:])["Content-Length"])
    digest = base64.b32decode(field["WARC-Payload-Digest"].removeprefix("sha1:")).hex()
    page = field["WARC-Record-ID"][len("<urn:page:"):-1]
    refers = field.get("WARC-Refers-To")
    revisit = field["WARC-Type"] == "revisit"
    intact = revisit or (len(payload) == size and hashlib.sha1(payload).hexdigest() == digest)
    return (int(page) if page else None, field.get("WARC-Target-URI"), field["WARC-Type"],
            None if revisit else payload, size, digest, int(refers[len("<urn:page:"):-1]) if refers else None, intact)


def write_archives(marked: DataFrame, folder: str, *, archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Writes ``mark_revisits`` rows into ``folder`` (a shared path or URI); returns the manifest table.

    Null payloads are empty records; an empty table writes no file and gives an empty manifest.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        context = TaskContext.get()
        fs, root = pafs.FileSystem.from_uri(folder)
        records: list[bytes] = []
        size = number = 0

        def flush() -> pa.RecordBatch:
            nonlocal records, size, number
            data = encode_archive(records)
            name = f"pages-{context.partitionId():05d}-{number:03d}-{context.taskAttemptId()}-{uuid.uuid4().hex[:8]}.warc.zst"
            fs.create_dir(root, recursive=True)
            with fs.open_output_stream(f"{root}/{name}") as f:
                f.write(data)
            row = pa.RecordBatch.from_arrays([pa.array([name]), pa.array([len(records)]), pa.array([len(data)])],
                                             names=["path", "records", "bytes"])
            records, size, number = [], 0, number + 1
            return row

        for b in batches:
            for r in zip(*(c.to_pylist() for c in b.columns)):
                records.append(record(*r))
                size += len(records[-1])
                if size >= archive_bytes:
                    yield flush()
        if records:
            yield flush()

    return materialize(marked.select("page_id", "url", "payload", "digest", "refers_to")
                       .mapInArrow(run, MANIFEST_SCHEMA), "warc-manifest")


def read_archives(manifest: DataFrame, folder: str) -> DataFrame:
    """The records of the manifest's archives: page_id, url, record_type, payload (responses), its
    size and digest, refers_to, and whether a response's payload has that size and digest."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = pafs.FileSystem.from_uri(folder)
        types = [pa.int64(), pa.string(), pa.string(), pa.binary(), pa.int64(), pa.string(), pa.int64(), pa.bool_()]
        names = [f.split()[0] for f in RECORD_SCHEMA.split(", ")]
        for b in batches:
            for path in b.column(0).to_pylist():
                with fs.open_input_stream(f"{root}/{path}") as f:
                    data = f.read()
                rows: list[tuple] = []
                size = 0
                for raw in decode_archive(data):
                    rows.append(parse_record(raw))
                    size += len(raw)
                    if size > 4 << 20:
                        yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(zip(*rows), types)], names=names)
                        rows, size = [], 0
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(zip(*rows), types)], names=names)

    files = max(1, manifest.count())
    return manifest.select("path").repartition(files).mapInArrow(run, RECORD_SCHEMA)


def archive_folder(pages: DataFrame) -> str:
    """A new folder for archives under the cluster's shared checkpoint folder."""
    return f"{checkpoint_root(pages.sparkSession)}/cinerank/warc-{uuid.uuid4().hex}"


def round_trip(pages: DataFrame, *, folder: str | None = None, **options) -> DataFrame:
    """Archives ``pages`` and reads them back (see ``read_archives``).

    Null html is an empty payload, a null url has no target line, a null id no number; repeated
    rows are archived each; other columns are not read; an empty table gives no rows.
    """
    folder = folder or archive_folder(pages)
    return read_archives(write_archives(mark_revisits(pages, **options), folder), folder)
