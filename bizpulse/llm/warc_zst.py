"""Web archives in Zstandard form: one frame per record, and the dictionary in a skippable frame before them.

Archives are written and read by tasks, through the file system the folder's address names, a stream at a time. A
task that is lost leaves a file that no manifest lists; only files in the manifest are read.
"""

from __future__ import annotations

import base64
import hashlib
import os
import re
import struct
import uuid
from collections.abc import Iterator
from typing import BinaryIO

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bizpulse.llm.common import hash_sample, text_batches
from bizpulse.session import materialize, scratch_path

#: Magic number of the skippable frame that holds the dictionary, and of a Zstandard frame.
DICTIONARY_MAGIC, FRAME_MAGIC = 0x184D2A5D, 0xFD2FB528
VERSION = b"WARC/1.1"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
#: The dictionary is trained on at most so many pages, chosen by a hash of the id, and has at most so many bytes.
SAMPLE_PAGES, DICTIONARY_BYTES = 200, 65_536
#: A new archive is begun once one has so many bytes.
ARCHIVE_BYTES = 256 << 20
READ_BYTES = 1 << 20

RECORD_SCHEMA = (
    "archive string, record_id string, record_type string, target_uri string, payload_digest string, refers_to string,"
    " payload_bytes long, block_bytes long, payload binary"
)


class BadArchive(ValueError):
    """An archive that breaks the format."""


def _clean(value: str) -> str:
    return re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m.group()):02X}", value)


def record(page_id, url: str | None, payload: bytes, digest: str, original=None) -> bytes:
    """One WARC record. A response carries the payload; a revisit its headers only, and names the response."""
    kind = "response" if original is None else "revisit"
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http + (payload if original is None else b"")
    head = [
        ("WARC-Type", kind),
        ("WARC-Record-ID", f"<urn:page:{page_id}>"),
        ("WARC-Date", "1970-01-01T00:00:00Z"),  # the tables have no time of capture
        ("WARC-Target-URI", _clean(url or "about:blank")),
        ("WARC-Payload-Digest", f"sha1:{digest}"),
        ("WARC-Block-Digest", f"sha1:{base64.b32encode(hashlib.sha1(block).digest()).decode()}"),
        ("Content-Type", "application/http; msgtype=response"),
        ("Content-Length", str(len(block))),
    ]
    if original is not None:
        head += [("WARC-Profile", PROFILE), ("WARC-Refers-To", f"<urn:page:{original}>")]
    lines = b"".join(f"{name}: {value}\r\n".encode() for name, value in head)
    return VERSION + b"\r\n" + lines + b"\r\n" + block + b"\r\n\r\n"


def dictionary_frame(dictionary: bytes) -> bytes:
    """The skippable frame, the dictionary compressed within it."""
    packed = zstandard.ZstdCompressor(level=10).compress(dictionary)
    return struct.pack("<II", DICTIONARY_MAGIC, len(packed)) + packed


def _headers(block: bytes, first: bytes) -> tuple[dict[str, str], bytes]:
    head, gap, rest = block.partition(b"\r\n\r\n")
    lines = head.split(b"\r\n")
    if not gap or not lines[0].startswith(first):
        raise BadArchive(f"no {first.decode()} header block")
    out: dict[str, str] = {}
    for line in lines[1:]:
        name, colon, value = line.partition(b":")
        if not colon or not name or name != name.strip():
            raise BadArchive(f"bad header line {line[:80]!r}")
        out.setdefault(name.decode("utf-8").lower(), value.strip().decode("utf-8"))
    return out, rest


def _length(headers: dict[str, str]) -> int:
    text = headers.get("content-length", "")
    if not re.fullmatch("[0-9]+", text):
        raise BadArchive("no Content-Length")
    return int(text)


def parse(data: bytes) -> dict:
    """A record's fields, its headers, lengths and digests checked."""
    head, rest = _headers(data, VERSION)
    for name in ("warc-type", "warc-record-id", "warc-date", "content-length"):
        if name not in head:
            raise BadArchive(f"no {name}")
    size = _length(head)
    if len(rest) != size + 4 or rest[size:] != b"\r\n\r\n":
        raise BadArchive(f"block of {len(rest) - 4} bytes, {size} stated")
    block = rest[:size]
    sha1 = lambda x: "sha1:" + base64.b32encode(hashlib.sha1(x).digest()).decode()
    if "warc-block-digest" in head and head["warc-block-digest"] != sha1(block):
        raise BadArchive("block digest differs")
    http, payload = _headers(block, b"HTTP/")
    stated, kind = _length(http), head["warc-type"]
    if kind == "response" and (len(payload) != stated or head.get("warc-payload-digest", sha1(payload)) != sha1(payload)):
        raise BadArchive("payload differs from its length or digest")
    if kind == "revisit" and (payload or "warc-refers-to" not in head or "warc-payload-digest" not in head):
        raise BadArchive("a revisit with a payload, or without what it refers to")
    name = lambda x: re.sub(r"^<urn:page:|>$", "", x) if x else None
    return {
        "record_id": name(head["warc-record-id"]), "record_type": kind, "target_uri": head.get("warc-target-uri"),
        "payload_digest": (head.get("warc-payload-digest") or sha1(payload)).removeprefix("sha1:"),
        "refers_to": name(head.get("warc-refers-to")), "payload_bytes": stated, "block_bytes": size,
        "payload": payload if kind == "response" else None,
    }


def frames(stream: BinaryIO) -> Iterator[bytes]:
    """Contents of an archive's frames, one record each, read as a stream."""
    buffer = stream.read(READ_BYTES)
    context = zstandard.ZstdDecompressor()

    def more() -> bool:
        nonlocal buffer
        new = stream.read(READ_BYTES)
        buffer += new
        return bool(new)

    if len(buffer) >= 8 and struct.unpack("<I", buffer[:4])[0] == DICTIONARY_MAGIC:
        size = struct.unpack("<I", buffer[4:8])[0]
        while len(buffer) < 8 + size:
            if not more():
                raise BadArchive("dictionary frame cut off")
        content, buffer = buffer[8 : 8 + size], buffer[8 + size :]
        if content[:4] == struct.pack("<I", FRAME_MAGIC):
            content = context.decompress(content)
        context = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(content))
    while buffer or more():
        decoder, parts = context.decompressobj(), []
        while True:
            try:
                parts.append(decoder.decompress(buffer))
            except zstandard.ZstdError as error:
                raise BadArchive(f"bad frame: {error}") from error
            if decoder.eof:
                buffer = decoder.unused_data
                break
            buffer = b""
            if not more():
                raise BadArchive("frame cut off")
        yield b"".join(parts)


def _filesystem(address: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(address if re.match(r"[a-z0-9+.-]+:", address) else os.path.abspath(address))


def _written(folder: str, dictionary: bytes, most: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, root = _filesystem(folder)
        shared = zstandard.ZstdCompressionDict(dictionary) if dictionary else None
        packer = zstandard.ZstdCompressor(level=3, dict_data=shared, write_checksum=True)
        done: list[tuple[str, int, int]] = []
        out, name, size, count = None, "", 0, 0
        for batch in batches:
            for row in batch.to_pylist():
                if out is None:
                    name, size, count = f"{uuid.uuid4().hex}.warc.zst", 0, 0
                    out = system.open_output_stream(f"{root}/{name}")
                    if dictionary:
                        out.write(dictionary_frame(dictionary))
                digest = base64.b32encode(row["sha"]).decode()
                frame = packer.compress(record(row["page_id"], row["url"], row["payload"], digest, row["original"]))
                out.write(frame)
                size, count = size + len(frame), count + 1
                if size >= most:
                    out.close()
                    done.append((name, count, size))
                    out = None
        if out is not None:
            out.close()
            done.append((name, count, size))
        names, counts, sizes = zip(*done) if done else ((), (), ())
        yield pa.RecordBatch.from_arrays(
            [pa.array(names, pa.string()), pa.array(counts, pa.int64()), pa.array(sizes, pa.int64())], ["archive", "records", "bytes"]
        )

    return run


def train_dictionary(pages: DataFrame, id_col: str, html_col: str, sample: int = SAMPLE_PAGES) -> bytes:
    """A dictionary from at most `sample` whole pages of up to 50 000 characters; empty if they are too few or too short to train one."""
    rows = pages.select(F.col(id_col).alias("i"), F.col(html_col).alias("t")).filter("length(t) BETWEEN 1 AND 50000")
    texts = [r["t"].encode() for r in hash_sample(rows, ["i", "t"], sample).collect()]
    if len(texts) < 50:
        return b""
    try:
        return zstandard.train_dictionary(min(DICTIONARY_BYTES, sum(map(len, texts)) // 10), texts).as_bytes()
    except zstandard.ZstdError:
        return b""


def write_archives(
    pages: DataFrame, folder: str, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", least_bytes: int = 0, archive_bytes: int = ARCHIVE_BYTES
) -> DataFrame:
    """Write one record per row into archives in `folder`, an address that every machine reaches; return the manifest
    (archive, records, bytes).

    Who revisits whom is found from digests and ids alone and stored; payloads stay in the rows they came in, or meet their
    original by id and digest, so that a payload that many pages share is written by as many tasks as its pages fill.

    Of rows with equal payloads of at least `least_bytes`, the one with the largest id is a response and the others revisit
    it; shorter payloads are responses all. Null html: an empty payload. Null url: about:blank. Rows that repeat the largest
    id are responses too. Rows with a null id revisit the largest id, and are responses where there is none.
    """
    spark = pages.sparkSession
    text_batches(spark, 256)
    html = F.coalesce(F.col(html_col), F.lit(""))
    rows = pages.select(
        F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"), F.encode(html, "UTF-8").alias("payload")
    )
    rows = rows.withColumn("sha", F.unhex(F.sha1("payload")))
    found = materialize(originals(rows.filter(F.octet_length("payload") >= least_bytes).select("page_id", "sha")), "originals")
    same = F.col("page_id").eqNullSafe(F.col("_id")) & (F.col("sha") == F.col("_sha"))
    rows = rows.join(found.withColumnsRenamed({"page_id": "_id", "sha": "_sha"}), same, "left").drop("_id", "_sha")
    dictionary = train_dictionary(pages, id_col, html_col)
    system, root = _filesystem(folder)
    system.create_dir(root, recursive=True)
    written = rows.select("page_id", "url", "payload", "sha", "original").mapInArrow(
        _written(folder, dictionary, archive_bytes), "archive string, records long, bytes long"
    )
    return materialize(written, "manifest")


def originals(rows: DataFrame) -> DataFrame:
    """Rows (page_id, sha, original) for the different (page_id, sha) of `rows` that revisit another page: `original` is the
    largest id with that digest. Counts of digests are combined before they move; of a digest that many pages share, the pages
    meet its one owner in a join that adaptive execution can split."""
    each = materialize(rows.distinct(), "digests")
    owners = each.groupBy("sha").agg(F.max("page_id").alias("original"), F.count("*").alias("pages"))
    owners = materialize(owners.filter("pages > 1 AND original IS NOT NULL").drop("pages"), "owners")
    return each.join(owners, "sha").filter(~F.col("page_id").eqNullSafe(F.col("original")))


def _read(folder: str):
    names = [x.split()[0] for x in RECORD_SCHEMA.split(",")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, root = _filesystem(folder)
        kinds = [pa.int64() if n.endswith("bytes") else pa.binary() if n == "payload" else pa.string() for n in names]

        def packed(rows: list[dict]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([r[n] for r in rows], k) for n, k in zip(names, kinds)], names)

        for batch in batches:
            for archive, records in zip(batch.column("archive").to_pylist(), batch.column("records").to_pylist()):
                rows, held, seen = [], 0, 0
                with system.open_input_stream(f"{root}/{archive}") as stream:
                    for data in frames(stream):
                        rows.append({"archive": archive, **parse(data)})
                        seen, held = seen + 1, held + len(data)
                        if len(rows) >= 1024 or held >= 16 << 20:
                            yield packed(rows)
                            rows, held = [], 0
                if seen != records:
                    raise BadArchive(f"{archive}: {seen} records, {records} in the manifest")
                yield packed(rows)

    return run


def read_archives(manifest: DataFrame, folder: str) -> DataFrame:
    """The records of the archives that the manifest lists, one row each (see RECORD_SCHEMA). Ids are those that the records
    name; a revisit has no payload, and payload_bytes is the full payload's length. Broken archives raise BadArchive."""
    spread = manifest.repartition(max(1, int(manifest.sparkSession.conf.get("spark.sql.shuffle.partitions"))), "archive")
    return spread.mapInArrow(_read(folder), RECORD_SCHEMA)


def archive_round_trip(pages: DataFrame, **names) -> DataFrame:
    """Write `pages` to archives in the shared scratch folder and read them back."""
    folder = scratch_path(pages.sparkSession, "archives")
    return read_archives(write_archives(pages, folder, **names), folder)
