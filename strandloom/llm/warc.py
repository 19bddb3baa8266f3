"""WARC archives compressed with Zstandard: one frame per record, the dictionary in a leading skippable frame.

An archive (``*.warc.zst``) is a skippable frame with magic number 0x184D2A5D whose content is the dictionary, then a
Zstandard frame for each record, compressed with that dictionary. A record is a WARC/1.1 header block and a block with an
HTTP response: status line and headers, then (for ``response``) the payload. ``revisit`` records carry the headers only.
"""

from __future__ import annotations

import hashlib
import struct
import uuid
from collections.abc import Iterable, Iterator

import pyarrow as pa
import pyarrow.fs
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strandloom.llm.common import bounded, columns_of, in_arrow, work_folder, written

#: Fixed values of the formats: the dictionary frame's magic number and the shortest payload that is deduplicated.
SKIPPABLE_DICTIONARY = 0x184D2A5D
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
RECORD_DATE = "1970-01-01T00:00:00Z"  # records are the same however often a lost task writes them
HTTP_STATUS = b"HTTP/1.1 200 OK\r\n"


class CorruptArchive(ValueError):
    """An archive that is not what its headers and lengths say."""


def _head(first: bytes, fields: Iterable[tuple[str, object]]) -> bytes:
    return first + b"".join(f"{k}: {v}\r\n".encode() for k, v in fields if v is not None) + b"\r\n"


def record_id(page_id: int | None, payload_sha: str) -> str:
    return f"<urn:page:{'null' if page_id is None else page_id}:{payload_sha[:16]}>"


def record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None = None, revisit: bool = False) -> bytes:
    """A whole record, uncompressed."""
    sha = hashlib.sha256(payload).hexdigest()
    block = _head(HTTP_STATUS, [("Content-Type", "text/html; charset=utf-8"), ("Content-Length", len(payload))])
    block += b"" if revisit else payload
    fields = [
        ("WARC-Type", "revisit" if revisit else "response"),
        ("WARC-Record-ID", record_id(page_id, sha)),
        ("WARC-Date", RECORD_DATE),
        ("WARC-Target-URI", None if url is None else "".join(c if c.isprintable() and c != " " else "%20" for c in url)),
        ("WARC-Profile", PROFILE if revisit else None),
        ("WARC-Refers-To", record_id(refers_to, sha) if revisit else None),
        ("WARC-Payload-Digest", f"sha256:{sha}"),
        ("WARC-Block-Digest", f"sha256:{hashlib.sha256(block).hexdigest()}"),
        ("Content-Type", "application/http; msgtype=response"),
        ("Content-Length", len(block)),
    ]
    return _head(b"WARC/1.1\r\n", fields) + block + b"\r\n\r\n"


def _fields(head: bytes) -> dict[str, str]:
    lines = head.decode("utf-8").split("\r\n")
    out = {}
    for line in lines[1:]:
        name, colon, value = line.partition(":")
        if not colon:
            raise CorruptArchive(f"a header line without a colon: {line[:80]!r}")
        out[name.strip().lower()] = value.strip()
    return out


def parse_record(data: bytes) -> dict:
    """Fields of one uncompressed record; raises CorruptArchive where a header, a length or a digest is wrong."""
    head, gap, rest = data.partition(b"\r\n\r\n")
    if not gap or not head.startswith(b"WARC/1."):
        raise CorruptArchive("no WARC header")
    fields = _fields(head)
    if missing := {"warc-type", "warc-record-id", "warc-date", "content-length"} - fields.keys():
        raise CorruptArchive(f"headers are missing: {sorted(missing)}")
    n = int(fields["content-length"])
    if len(rest) != n + 4 or rest[n:] != b"\r\n\r\n":
        raise CorruptArchive(f"Content-Length says {n}, the block has {len(rest) - 4}")
    block = rest[:n]
    if fields.get("warc-block-digest", f"sha256:{(sha := hashlib.sha256(block).hexdigest())}") != f"sha256:{hashlib.sha256(block).hexdigest()}":
        raise CorruptArchive("the block digest is wrong")
    http, gap, payload = block.partition(b"\r\n\r\n")
    if not gap or not http.startswith(b"HTTP/"):
        raise CorruptArchive("no HTTP header in the block")
    length, digest = int(_fields(http)["content-length"]), fields["warc-payload-digest"].removeprefix("sha256:")
    kind = fields["warc-type"]
    if kind == "response" and (len(payload) != length or hashlib.sha256(payload).hexdigest() != digest):
        raise CorruptArchive("the payload has another length or digest than its headers say")
    if kind == "revisit" and (payload or "warc-refers-to" not in fields):
        raise CorruptArchive("a revisit record with a payload or without the record it refers to")
    number = lambda urn: None if (x := urn.split(":")[2]) == "null" else int(x)
    return {
        "page_id": number(fields["warc-record-id"]), "url": fields.get("warc-target-uri"), "payload_bytes": length,
        "payload_digest": digest, "record_type": kind, "refers_to": number(fields["warc-refers-to"]) if kind == "revisit" else None,
        "payload": payload if kind == "response" else None,
    }


def frames(data: bytes) -> Iterator[bytes]:
    """The uncompressed records of an archive, one a frame."""
    view, at, known = memoryview(data), 0, None
    if len(view) >= 8 and struct.unpack_from("<I", view)[0] == SKIPPABLE_DICTIONARY:
        size = struct.unpack_from("<I", view, 4)[0]
        if 8 + size > len(view):
            raise CorruptArchive("the dictionary frame ends after the file")
        raw = bytes(view[8 : 8 + size])
        if raw[:4] == b"\x28\xb5\x2f\xfd":  # a dictionary may itself be compressed
            raw = zstandard.ZstdDecompressor().decompress(raw)
        known, at = zstandard.ZstdCompressionDict(raw), 8 + size
    reader = zstandard.ZstdDecompressor(dict_data=known) if known else zstandard.ZstdDecompressor()
    while at < len(view):
        if 0x184D2A50 <= struct.unpack_from("<I", view, at)[0] <= 0x184D2A5F:
            at += 8 + struct.unpack_from("<I", view, at + 4)[0]
            continue
        one = reader.decompressobj()
        parts, step = [], 1 << 16
        try:
            while not one.eof:
                if at >= len(view):
                    raise CorruptArchive("the last frame is cut off")
                chunk = view[at : at + step]
                parts.append(one.decompress(chunk))
                at += len(chunk)
        except zstandard.ZstdError as e:
            raise CorruptArchive(f"not a valid frame: {e}") from e
        at -= len(one.unused_data)
        yield b"".join(parts)


def train_dictionary(pages: DataFrame, max_rows: int = 2000, max_bytes: int = 1 << 14, size: int = 1 << 15) -> bytes:
    """A compression dictionary from at most max_rows payloads, at most max_bytes of each; empty if there are too few."""
    rows = pages.select(F.substring("html", 1, max_bytes).alias("html")).where("html IS NOT NULL").limit(max_rows).collect()
    try:
        return zstandard.train_dictionary(size, [r.html.encode() for r in rows]).as_bytes()
    except zstandard.ZstdError:
        return b""


def with_revisits(pages: DataFrame, least: int = 100) -> DataFrame:
    """page_id, url, html, refers_to: the smallest page_id with an equal payload of at least ``least`` bytes, for all others.

    Only digests are grouped (with partial sums before the shuffle), and only rows of a digest that occurs more than once
    go through the join; payloads move once, by the even key of a row's own number.
    """
    digests = pages.select("page_id", F.sha2(F.encode(F.coalesce("html", F.lit("")), "UTF-8"), 256).alias("sha"), F.octet_length("html").alias("n"))
    digests = digests.where((F.col("n") >= least) & F.col("page_id").isNotNull())
    again = digests.groupBy("sha").agg(F.min("page_id").alias("refers_to"), F.count("*").alias("n")).where("n > 1").drop("n")
    later = digests.join(again, "sha").where("page_id > refers_to").select("page_id", F.col("sha").alias("_sha"), "refers_to").distinct()
    # a page_id that occurs with several payloads: a revisit only for the payload that is repeated
    own = pages.select("page_id", "url", "html", F.sha2(F.encode(F.coalesce("html", F.lit("")), "UTF-8"), 256).alias("_sha"))
    unnamed = own.where("page_id is null").withColumn("refers_to", F.lit(None).cast("long"))  # never a revisit, so not part of the join
    return own.where("page_id is not null").join(later, ["page_id", "_sha"], "left").unionByName(unnamed).drop("_sha")


def write_archives(records: DataFrame, folder: str, dictionary: bytes, max_bytes: int = 8 << 20) -> DataFrame:
    """Writes page_id, url, html, refers_to as archives of about max_bytes in a folder; returns path, records, bytes of each.

    A file appears under its name when it is whole, and only files of tasks that succeeded are in the result. A task that
    is lost may leave whole archives in the folder, which its repetition writes again under other names: readers must go
    by the result's paths, not by the folder.
    """
    lead = struct.pack("<II", SKIPPABLE_DICTIONARY, len(dictionary)) + dictionary if dictionary else b""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = pyarrow.fs.FileSystem.from_uri(folder)
        store.create_dir(root, recursive=True)
        writer = zstandard.ZstdCompressor(level=3, dict_data=zstandard.ZstdCompressionDict(dictionary)) if dictionary else zstandard.ZstdCompressor(level=3)
        done, out, size, n, name = [], None, 0, 0, ""

        def close() -> None:
            out.close()
            store.move(f"{root}/_{name}", f"{root}/{name}")
            done.append((f"{folder}/{name}", n, size))

        for batch in columns_of(batches, 8 << 20):
            for page_id, url, html, refers_to in zip(*(batch.column(c).to_pylist() for c in ("page_id", "url", "html", "refers_to")), strict=True):
                if out is None:
                    name, n, size = f"{uuid.uuid4().hex}.warc.zst", 0, len(lead)
                    out = store.open_output_stream(f"{root}/_{name}", compression=None)
                    out.write(lead)
                frame = writer.compress(record(page_id, url, (html or "").encode(), refers_to, refers_to is not None))
                out.write(frame)
                n, size = n + 1, size + len(frame)
                if size >= max_bytes:
                    close()
                    out = None
        if out is not None:
            close()
        if done:
            yield pa.RecordBatch.from_arrays([pa.array([d[i] for d in done]) for i in range(3)], ["path", "records", "bytes"])

    return in_arrow(records.select("page_id", "url", "html", "refers_to"), run, "path string, records long, bytes long")


def _only(files: DataFrame, made: DataFrame, max_strays_sent: int = 10_000) -> DataFrame:
    """Those of a folder's files that made lists (by name, which is unique). The few others are found by names alone."""
    name = F.substring_index("path", "/", -1).alias("_name")
    stray = written(files.select(name).join(made.select(name), "_name", "left_anti"))
    return files.select("*", name).join(bounded(stray, max_strays_sent), "_name", "left_anti")


def read_archives(spark: SparkSession, paths: str | list[str], with_payload: bool = False, made: DataFrame | None = None) -> DataFrame:
    """Records of the archives at paths, read through Spark's own file readers: a row each, validated.

    made: write_archives' result as a written table; other files at paths are then left out.

    page_id, payload_bytes, payload_digest, record_type, refers_to, url; with_payload adds payload (null for revisits).
    An archive without a dictionary frame is read as well; a damaged one raises CorruptArchive.
    """
    schema = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, url string" + ", payload binary" * with_payload
    names = [c.split()[0] for c in schema.split(", ")]
    types = {"string": pa.string(), "long": pa.int64(), "binary": pa.binary()}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def batch(rows: list[dict]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([r[c] for r in rows], types[k]) for c, k in (x.split() for x in schema.split(", "))], names)

        for files in batches:
            for content in files.column("content"):
                rows, held = [], 0
                for data in frames(content.as_py()):
                    rows.append(parse_record(data))
                    held += len(data)
                    if held > 16 << 20:
                        yield batch(rows)
                        rows, held = [], 0
                if rows:
                    yield batch(rows)

    files = spark.read.format("binaryFile").load(paths)
    return in_arrow((files if made is None else _only(files, made)).select("content"), run, schema)


def round_trip(spark: SparkSession, pages: DataFrame, least: int = 100) -> DataFrame:
    """Writes all pages as archives, reads them back: page_id, payload_bytes, payload_digest, record_type, refers_to, url.

    Null html is an empty payload, null urls are left out of the header, a null page_id never takes part in
    deduplication (its record is a response). Empty payloads and those under ``least`` bytes are all responses. Rows that
    repeat a page_id with the same payload are all written, and all of the smallest page_id are responses, as none of them
    has another to refer to. A payload of any length is one record. An empty table gives an
    empty result. Other columns of pages are ignored.
    """
    folder = f"{work_folder(spark)}/archives"
    made = written(write_archives(with_revisits(pages, least), folder, train_dictionary(pages)))
    if not made.select(F.sum("records")).first()[0]:
        return spark.createDataFrame([], "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, url string")
    return read_archives(spark, folder, made=made)
