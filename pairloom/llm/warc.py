"""WARC archives compressed record by record with Zstandard and a dictionary of their own.

An archive begins with a skippable frame (0x184D2A5D) that holds the dictionary; every
record after it is one frame.  The writer trains the dictionary on the first records of the
archive; the reader loads it, decodes one frame at a time, and checks each record's headers
and lengths.  Files are written and read by the tasks, in pieces, through the file system
that the path names, so no archive is ever whole in memory; a file appears under its name
only when it is complete, and a task that runs again writes the same bytes.

Of records with equal payloads of at least 1000 bytes, the one with the largest id is
``response`` and the others ``revisit`` it, without a payload of their own.

Defined cases: a null payload is empty; a null id is written as no id and never revisited;
rows with the id of the response beside equal payloads are responses too; an empty table
makes no archive and reads as no rows.
"""

from __future__ import annotations

import hashlib
import struct
import uuid
from collections.abc import Iterator
from itertools import groupby
from operator import itemgetter

import pandas as pd
import zstandard
from pyarrow import fs  # its streams would unpack .zst names by themselves
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SKIPPABLE = 0x184D2A5D
REVISIT_BYTES = 1000
ARCHIVE_BYTES = 64 << 20  # payload after which a task begins its next archive
SAMPLE_RECORDS = 256  # records that an archive's dictionary is trained on,
SAMPLE_BYTES = 8192  # with so many bytes of each
DICTIONARY_BYTES = 32 << 10
LEVEL = 3
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


class InvalidRecord(ValueError):
    """A frame that is not a whole, valid record."""


# Records ---------------------------------------------------------------------------

def record(page_id, uri: str | None, payload: bytes, size: int, digest: str, refers_to) -> bytes:
    kind = "response" if refers_to is None else "revisit"
    lines = [
        "WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: <urn:page:{'' if page_id is None else page_id}>",
        "WARC-Date: 1970-01-01T00:00:00Z", f"WARC-Target-URI: {_one_line(uri)}",
        f"WARC-Payload-Digest: sha1:{digest}", f"X-Payload-Length: {size}", "Content-Type: text/html",
    ]
    if refers_to is not None:
        lines += [f"WARC-Refers-To: <urn:page:{refers_to}>", f"WARC-Profile: {PROFILE}"]
        payload = b""
    lines.append(f"Content-Length: {len(payload)}")
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + payload + b"\r\n\r\n"


def _one_line(text: str | None) -> str:
    return (text or "").replace("\r", "%0D").replace("\n", "%0A")


def parse(data: bytes) -> dict:
    """The parts of one record; raises ``InvalidRecord`` if a header or a length is wrong."""
    head, mark, body = data.partition(b"\r\n\r\n")
    lines = head.decode("utf-8", "strict").split("\r\n")
    if not mark or lines[0] != "WARC/1.1":
        raise InvalidRecord("no version line or no end of headers")
    headers = {}
    for line in lines[1:]:
        name, colon, value = line.partition(": ")
        if not colon or name in headers:
            raise InvalidRecord(f"header line {line[:80]!r}")
        headers[name] = value
    try:
        kind, length = headers["WARC-Type"], int(headers["Content-Length"])
        page_id = headers["WARC-Record-ID"].removeprefix("<urn:page:").removesuffix(">")
        digest, size = headers["WARC-Payload-Digest"].removeprefix("sha1:"), int(headers["X-Payload-Length"])
    except (KeyError, ValueError) as problem:
        raise InvalidRecord(f"header missing or unreadable: {problem}") from None
    if len(body) != length + 4 or body[length:] != b"\r\n\r\n":
        raise InvalidRecord(f"Content-Length {length}, but {len(body) - 4} bytes follow")
    payload = body[:length]
    refers_to = None
    if kind == "revisit":
        if length or headers.get("WARC-Profile") != PROFILE or "WARC-Refers-To" not in headers:
            raise InvalidRecord("a revisit with a payload, or without its profile or target")
        refers_to = int(headers["WARC-Refers-To"].removeprefix("<urn:page:").removesuffix(">"))
    elif kind != "response":
        raise InvalidRecord(f"type {kind!r}")
    elif length != size or hashlib.sha1(payload).hexdigest() != digest:
        raise InvalidRecord("payload length or digest differs")
    return {
        "page_id": int(page_id) if page_id else None, "url": headers["WARC-Target-URI"], "payload_bytes": size,
        "payload_digest": digest, "record_type": kind, "refers_to": refers_to, "payload": payload,
    }


# Frames ----------------------------------------------------------------------------

def trained(samples: list[bytes], size: int = DICTIONARY_BYTES) -> zstandard.ZstdCompressionDict | None:
    """A dictionary, or None where the samples are too few or too alike to train one."""
    if len(samples) < 8:
        return None
    try:
        return zstandard.train_dictionary(size, [s[:SAMPLE_BYTES] for s in samples], level=LEVEL)
    except zstandard.ZstdError:
        return None


def write_archive(out, records: Iterator[bytes]) -> int:
    held = []
    for one in records:
        held.append(one)
        if len(held) == SAMPLE_RECORDS:
            break
    dictionary = trained(held)
    content = dictionary.as_bytes() if dictionary else b""
    out.write(struct.pack("<II", SKIPPABLE, len(content)) + content)
    packer = zstandard.ZstdCompressor(level=LEVEL, dict_data=dictionary, write_content_size=True, write_checksum=True)
    n = 0
    for some in (held, records):
        for one in some:
            out.write(packer.compress(one))
            n += 1
    return n


def read_archive(source, piece: int = 1 << 20) -> Iterator[bytes]:
    """The records of an archive: one frame each, decoded as the bytes come in."""
    head = source.read(8)
    if len(head) < 8 or (mark := struct.unpack("<II", head))[0] != SKIPPABLE:
        raise InvalidRecord("the archive does not begin with its dictionary's frame")
    content = source.read(mark[1])
    if len(content) != mark[1]:
        raise InvalidRecord("the dictionary's frame is cut")
    unpacker = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(content) if content else None)
    left = source.read(piece)
    while left:
        frame, parts = unpacker.decompressobj(), []
        while True:
            parts.append(frame.decompress(left))
            if frame.eof:
                left = frame.unused_data or source.read(piece)
                break
            left = source.read(piece)
            if not left:
                raise InvalidRecord("the last frame is cut")
        yield b"".join(parts)


def _place(path: str):
    return fs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:/") else (fs.LocalFileSystem(), path)


def _local_uri(path: str) -> str:
    return "file://" + path[5:] if path.startswith("file:/") and not path.startswith("file://") else path


# Tables ----------------------------------------------------------------------------

def classified(pages: DataFrame, least: int = REVISIT_BYTES) -> DataFrame:
    """page_id, url, html with payload_bytes, payload_digest, refers_to (null for a response)."""
    body = F.coalesce("html", F.lit(""))
    pages = pages.select("page_id", "url", body.alias("html")).withColumns(
        {"payload_bytes": F.octet_length("html").cast("bigint"), "payload_digest": F.sha1(F.col("html").cast("binary"))}
    )
    copies = (
        pages.where(F.col("payload_bytes") >= least).groupBy("payload_digest", "payload_bytes")
        .agg(F.max("page_id").alias("last"), F.count("*").alias("n")).where("n > 1").select(F.col("payload_digest").alias("copied"), "last")
    )
    # A small payload gets a key of its own, which no copy has: nulls would meet in one task.
    own = F.when(F.col("payload_bytes") >= least, F.col("payload_digest")).otherwise(F.concat(F.lit("-"), F.col("payload_digest"), F.coalesce(F.col("page_id").cast("string"), F.lit(""))))
    joined = pages.withColumn("own", own).join(copies, F.col("own") == F.col("copied"), "left")
    return joined.select(
        "page_id", "url", "payload_digest", "payload_bytes",
        F.when(F.col("last").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("last")), F.col("last")).alias("refers_to"), "html",
    ).withColumn("html", F.when(F.col("refers_to").isNull(), F.col("html")).otherwise(""))


def write_archives(pages: DataFrame, folder: str, archive_bytes: int = ARCHIVE_BYTES) -> int:
    """Writes every row of ``pages`` as one record into archives below ``folder``; their number of records.

    A task writes the rows it has after the search for equal payloads, so payloads move once at most; it
    begins a new archive when the one at hand has come to ``archive_bytes`` of payload.
    """
    folder = _local_uri(folder)
    dealt = classified(pages).sortWithinPartitions("page_id", "payload_digest", "url")

    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        def records() -> Iterator[tuple[int, bytes]]:
            """The records, each with the number of the archive it belongs to."""
            archive = used = 0
            for batch in batches:
                columns = (batch[c].astype(object).where(batch[c].notna(), None) for c in
                           ("page_id", "url", "html", "payload_bytes", "payload_digest", "refers_to"))
                for page_id, url, html, n, digest, target in zip(*columns):
                    if used >= archive_bytes:
                        archive, used = archive + 1, 0
                    payload = html.encode()
                    used += len(payload)
                    yield archive, record(_whole(page_id), url, payload, n, digest, _whole(target))

        place, path = _place(folder)
        task = TaskContext.get().partitionId()
        n = 0
        for archive, some in groupby(records(), itemgetter(0)):
            place.create_dir(path, recursive=True)
            draft = f"{path}/.{uuid.uuid4().hex}.part"
            with place.open_output_stream(draft, compression=None) as out:
                n += write_archive(out, (data for _, data in some))
            place.move(draft, f"{path}/pages-{task:06d}-{archive:04d}.warc.zst")
        yield pd.DataFrame({"records": [n]})

    return dealt.mapInPandas(write, "records bigint").agg(F.sum("records")).first()[0] or 0


def _whole(value) -> int | None:
    return None if value is None else int(value)


def read_archives(spark: SparkSession, folder: str, payloads: bool = False) -> DataFrame:
    """One row per record of all archives below ``folder``; an invalid record fails the job."""
    folder = _local_uri(folder)
    place, path = _place(folder)
    schema = "page_id bigint, url string, payload_bytes bigint, payload_digest string, record_type string, refers_to bigint"
    schema += ", html string" if payloads else ""
    found = place.get_file_info(fs.FileSelector(path, allow_not_found=True))
    names = sorted(f.path for f in found if f.path.endswith(".warc.zst"))
    files = spark.createDataFrame([(n,) for n in names], "path string")
    if names:
        files = files.repartitionByRange(len(names), "path")

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        place, _ = _place(folder)
        for batch in batches:
            for name in batch["path"]:
                with place.open_input_stream(name, compression=None, buffer_size=1 << 20) as source:
                    rows = []
                    for data in read_archive(source):
                        one = parse(data)
                        one["html"] = one.pop("payload").decode() if payloads else None
                        rows.append(one)
                        if len(rows) == 500:
                            yield _frame(rows, payloads)
                            rows = []
                    if rows:
                        yield _frame(rows, payloads)

    return files.mapInPandas(read, schema)


def _frame(rows: list[dict], payloads: bool) -> pd.DataFrame:
    frame = pd.DataFrame(rows)
    for name in ("page_id", "payload_bytes", "refers_to"):
        frame[name] = frame[name].astype("Int64")
    return frame if payloads else frame.drop(columns="html")
