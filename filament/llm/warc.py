"""Operator 2, WARC: dictionary-compressed archives.

Each archive is a ``.warc.zst`` file: a leading skippable frame (magic 0x184D2A5D) that
holds a Zstandard dictionary built from the archive's own records, then one Zstandard
frame per WARC record, each compressed on its own with that dictionary and so readable on
its own.  Payloads are deduplicated: of records with equal payloads of at least
``MIN_REVISIT`` bytes, the one with the smallest id is a ``response``, the others are
``revisit`` records that carry no payload and refer to it.

Tasks write their archives to the shared folder through ``pyarrow.fs`` (any scheme it
knows) under names of their own attempt; the manifest, written by Spark's committer, names
the archives of the attempts that succeeded, and only these are read back.  An archive is
rolled at ``ARCHIVE_BYTES`` of records, so none grows with the data.  A dictionary is built
from at most ``SAMPLE_BYTES`` of its archive's first records; all records are compressed with it.

Defined results: a null payload is empty; payloads under ``MIN_REVISIT`` bytes are all
responses; rows with equal id and equal payload are responses all; a null id is larger than
any other when the first of equal payloads is chosen; an empty table gives no archive.
"""

from __future__ import annotations

import hashlib
import struct
import uuid

import pyarrow.fs as pafs
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import arrow_map, shared_folder, staged

MIN_REVISIT = 100
ARCHIVE_BYTES = 64 << 20
SAMPLE_BYTES = 4 << 20
DICT_BYTES = 64 << 10
SKIPPABLE = 0x184D2A5D  # the magic number of the dictionary frame
WARC_DATE = "1970-01-01T00:00:00Z"


def open_fs(path: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(path if "://" in path else "file://" + path.removeprefix("file:"))


def record_bytes(page_id, url, payload: bytes, digest: str, revisit: bool, refers_to) -> bytes:
    """One WARC/1.1 record; a revisit has an empty block and names the record it repeats."""
    head = [
        "WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: <urn:page:{'' if page_id is None else page_id}>",
        f"WARC-Target-URI: {' '.join((url or '').split())}", f"WARC-Date: {WARC_DATE}", f"WARC-Payload-Digest: sha256:{digest}",
        f"X-Payload-Length: {len(payload)}",
    ]
    if revisit:
        head += [f"WARC-Refers-To: <urn:page:{refers_to}>", "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"]
    block = b"" if revisit else payload
    head.append(f"Content-Length: {len(block)}")
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse_record(raw: bytes) -> dict:
    end = raw.index(b"\r\n\r\n")
    head = dict(x.split(": ", 1) if ": " in x else (x.rstrip(":"), "") for x in raw[:end].decode().split("\r\n")[1:])
    size = int(head["Content-Length"])
    block = raw[end + 4:end + 4 + size]
    if raw[end + 4 + size:] != b"\r\n\r\n":
        raise ValueError("a record's length is not the one in its header")
    return {"head": head, "block": block}


def build_dictionary(records: list[bytes]) -> bytes:
    """Dictionary of up to ``DICT_BYTES`` from the first records; raw content where training
    has too little to work on (few or tiny records)."""
    sample, size = [], 0
    for r in records:
        sample.append(r)
        size += len(r)
        if size >= SAMPLE_BYTES:
            break
    try:
        return zstandard.train_dictionary(DICT_BYTES, sample, k=256, d=8).as_bytes()
    except zstandard.ZstdError:
        return b"".join(sample)[:DICT_BYTES]


def archive_bytes(records: list[bytes], level: int = 3) -> bytes:
    d = build_dictionary(records)
    c = zstandard.ZstdCompressor(level=level, dict_data=zstandard.ZstdCompressionDict(d), write_checksum=True)
    return struct.pack("<II", SKIPPABLE, len(d)) + d + b"".join(map(c.compress, records))


def frame_end(data: bytes, at: int) -> int:
    """Where the Zstandard frame at ``at`` ends: header, blocks by their sizes, checksum."""
    checksum = data[at + 4] >> 2 & 1
    at += zstandard.frame_header_size(data[at:at + 18])
    last = 0
    while not last:
        block = int.from_bytes(data[at:at + 3], "little")
        last, kind, size = block & 1, block >> 1 & 3, block >> 3
        at += 3 + (1 if kind == 1 else size)  # a repeated byte takes one
    return at + 4 * checksum


def read_archive(data: bytes):
    """Yields the records of an archive, each frame decompressed on its own."""
    magic, size = struct.unpack_from("<II", data)
    if magic != SKIPPABLE:
        raise ValueError("no dictionary frame in front")
    d = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(data[8:8 + size]))
    at, view = 8 + size, memoryview(data)
    while at < len(data):
        end = frame_end(data, at)
        yield d.decompress(view[at:end])
        at = end


def write_archives(df: DataFrame, folder: str, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html") -> DataFrame:
    """Writes every row as a record and returns the manifest: ``path, records, bytes``."""
    spark = df.sparkSession
    rows = df.select(F.col(id_col).alias("id"), F.col(url_col).alias("url"),
                     F.coalesce(F.col(payload_col).cast("binary"), F.lit(b"")).alias("payload"))
    rows = rows.withColumn("digest", F.sha2("payload", 256))
    #: payloads that stand more than once, with the id that keeps them; partial aggregation, payloads are not moved
    repeated = staged(rows.where(F.octet_length("payload") >= MIN_REVISIT).groupBy("digest")
                      .agg(F.min("id").alias("keeps"), F.count("*").alias("n")).where("n > 1").select("digest", "keeps"), spark)
    rows = rows.join(repeated, "digest", "left")
    revisit = F.col("keeps").isNotNull() & ~F.col("id").eqNullSafe(F.col("keeps"))
    rows = rows.select("id", "url", "payload", "digest", F.coalesce(revisit, F.lit(False)).alias("revisit"), "keeps")

    def run(batches):
        fs, base = open_fs(folder)
        fs.create_dir(base, recursive=True)
        held, size = [], 0

        def close():
            name = f"{base}/{uuid.uuid4().hex}.warc.zst"
            data = archive_bytes(held)
            with fs.open_output_stream(name) as out:
                out.write(data)
            return {"path": [name], "records": [len(held)], "bytes": [len(data)]}

        for b in batches:
            for one in zip(*(c.to_pylist() for c in b.columns)):
                held.append(record_bytes(*one))
                size += len(held[-1])
                if size >= ARCHIVE_BYTES:
                    yield close()
                    held, size = [], 0
        if held:
            yield close()

    return staged(arrow_map(rows, run, "path string, records long, bytes long"), spark)


def read_archives(manifest: DataFrame, folder: str, id_type: str = "bigint") -> DataFrame:
    """Reads archives back: ``page_id, url, payload (null in revisits), payload_bytes,
    payload_digest, record_type, refers_to``; a response's digest is that of the payload read."""
    ident = lambda s: int(s[10:-1]) if s[10:-1] else None  # noqa: E731  <urn:page:ID>

    def run(batches):
        fs, _ = open_fs(folder)
        for b in batches:
            for path in b.column(0).to_pylist():
                with fs.open_input_stream(path) as f:
                    data = f.read()
                out: dict = {k: [] for k in ("page_id", "url", "payload", "payload_bytes", "payload_digest", "record_type", "refers_to")}
                size = 0
                for raw in read_archive(data):
                    r = parse_record(raw)
                    h, revisit = r["head"], r["head"]["WARC-Type"] == "revisit"
                    digest = h["WARC-Payload-Digest"].removeprefix("sha256:") if revisit else hashlib.sha256(r["block"]).hexdigest()
                    for k, v in (("page_id", ident(h["WARC-Record-ID"])), ("url", h["WARC-Target-URI"]),
                                 ("payload", None if revisit else r["block"]),
                                 ("payload_bytes", int(h["X-Payload-Length"]) if revisit else len(r["block"])),
                                 ("payload_digest", digest), ("record_type", h["WARC-Type"]),
                                 ("refers_to", ident(h["WARC-Refers-To"]) if revisit else None)):
                        out[k].append(v)
                    size += len(raw)
                    if size > 8 << 20:
                        yield out
                        out, size = {k: [] for k in out}, 0
                if out["page_id"]:
                    yield out

    n = max(1, manifest.count())
    return arrow_map(manifest.select("path").repartition(n), run,
                     f"page_id {id_type}, url string, payload binary, payload_bytes long, payload_digest string, record_type string, refers_to {id_type}")


def warc_roundtrip(df: DataFrame, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html") -> DataFrame:
    """Writes all rows to archives in the shared folder and returns what reading them gives."""
    folder = shared_folder(df.sparkSession) + "/archives"
    return read_archives(write_archives(df, folder, id_col, url_col, payload_col), folder, df.schema[id_col].dataType.simpleString())
