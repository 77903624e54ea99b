"""WARC archives compressed with a dictionary of their own.

A Zstandard dictionary is built from records of the table and stands in a skippable frame at the
head of every archive; each record is a frame by itself, so any record can be read alone.  Pages
with equal payloads become one response and revisits that refer to it.
"""

from __future__ import annotations

import base64
import hashlib
import re
import struct
import uuid
from collections.abc import Iterator
from urllib.parse import quote, unquote

import pyarrow as pa
import pyarrow.fs
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.tables import new_folder, spread_lookup, stored

#: Fixed values of the archive formats: the skippable frame that holds a dictionary, and the
#: profile of a revisit with an identical payload.
DICTIONARY_FRAME = 0x184D2A5D
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

#: The dictionary is built from at most so many records, at most so many bytes of each.
SAMPLE_RECORDS, SAMPLE_BYTES, DICTIONARY_BYTES = 1000, 16_384, 112_640

#: Compressed bytes after which a task begins a new archive.
ARCHIVE_BYTES = 256 << 20

DATE = "1970-01-01T00:00:00Z"


def base32_sha1(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload, usedforsecurity=False).digest()).decode()


def record_name(page_id: str | None, digest: str) -> str:
    name = "null id" if page_id is None else quote(page_id)  # a quoted id has no space
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{name} {digest}')}>"


def one_line(value: str) -> str:
    """``value`` fit for a header: control characters and spaces are percent-encoded."""
    return re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", value)


def write_record(page_id: str | None, url: str | None, payload: bytes, refers_to: str | None) -> bytes:
    digest, revisit = base32_sha1(payload), refers_to is not None
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n"
    block = http.encode() + (b"" if revisit else payload)
    headers = {
        "WARC-Type": "revisit" if revisit else "response",
        "WARC-Record-ID": record_name(page_id, digest),
        "WARC-Date": DATE,
        "WARC-Target-URI": None if url is None else one_line(url),
        "WARC-Payload-Digest": f"sha1:{digest}",
        "WARC-Profile": REVISIT_PROFILE if revisit else None,
        "WARC-Refers-To": record_name(refers_to, digest) if revisit else None,
        "X-Page-ID": None if page_id is None else quote(page_id),
        "X-Refers-To-Page-ID": None if refers_to is None else quote(refers_to),
        "Content-Type": "application/http; msgtype=response",
        "Content-Length": str(len(block)),
    }
    lines = "".join(f"{name}: {value}\r\n" for name, value in headers.items() if value is not None)
    return f"WARC/1.1\r\n{lines}\r\n".encode() + block + b"\r\n\r\n"


def read_record(record: bytes) -> tuple[dict[str, str], bytes, int]:
    """Headers, payload (empty for a revisit) and length of the full payload."""
    head, _, rest = record.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")[1:]
    headers = dict(line.split(": ", 1) for line in lines)
    block = rest[: int(headers["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    length = int(re.search(rb"Content-Length: (\d+)", http)[1])
    if headers["WARC-Type"] == "response" and f"sha1:{base32_sha1(payload)}" != headers["WARC-Payload-Digest"]:
        raise ValueError(f"payload of {headers['WARC-Record-ID']} does not fit its digest")
    return headers, payload, length


def build_dictionary(pages: DataFrame, text_col: str = "html", records: int = SAMPLE_RECORDS) -> bytes:
    """A dictionary from a sample of at most ``records`` records; empty for an empty table."""
    share = min(1.0, 2.0 * records / max(1, pages.count()))
    # Cut before they are collected; a character is a byte at least.
    payloads = pages.select(F.substring(F.coalesce(F.col(text_col), F.lit("")), 1, SAMPLE_BYTES).alias("payload"))
    drawn = payloads.sample(share, seed=7).limit(records).collect() or payloads.limit(records).collect()
    samples = [write_record("0", "http://", row["payload"].encode(), None)[:SAMPLE_BYTES] for row in drawn]
    if not samples:
        return b""
    try:
        size = min(DICTIONARY_BYTES, max(1024, sum(map(len, samples)) // 8))
        return zstandard.train_dictionary(size, samples).as_bytes()
    except zstandard.ZstdError:  # too few samples to train on: their end serves as it is
        return b"".join(samples)[-DICTIONARY_BYTES:]


def payload_key(payload: Column, page_id: Column) -> Column:
    """What tells a page and its payload from all others."""
    return F.concat_ws(" ", F.sha2(payload, 256), F.coalesce(F.concat(F.lit("="), page_id.cast("string")), F.lit("-")))


def page_roles(pages: DataFrame, least_bytes: int, id_col: str, text_col: str) -> DataFrame:
    """``_key`` (page and payload) and ``refers_to`` of every page, found by payload digest."""
    payload = F.coalesce(F.col(text_col), F.lit(""))
    digests = pages.select(
        F.col(id_col).alias("page_id"),
        F.sha2(payload, 256).alias("digest"),
        payload_key(payload, F.col(id_col)).alias("_key"),
        (F.octet_length(payload) >= least_bytes).alias("counts"),
    )
    groups = (
        digests.where("counts")
        .groupBy("digest")
        .agg(F.max("page_id").alias("response"), F.count("*").alias("pages"))
        .where("pages > 1")
    )
    other = F.col("response").isNotNull() & ~F.col("response").eqNullSafe(F.col("page_id"))
    return (
        spread_lookup(digests, groups, ["digest"], by="page_id")
        .select("_key", F.when(other, F.col("response")).alias("refers_to"))
        .distinct()
    )


def write_archives(
    pages: DataFrame,
    folder: str,
    least_bytes: int = 0,
    archive_bytes: int = ARCHIVE_BYTES,
    id_col: str = "page_id",
    url_col: str = "url",
    text_col: str = "html",
) -> DataFrame:
    """Write a record per page below ``folder`` and return the stored list of archives.

    Of pages whose payloads are equal and have ``least_bytes`` or more, the largest id is the
    response and the others revisit it.  A null html is an empty payload, a null URL leaves its
    header out and so does a null id; ids are percent-encoded, whatever they hold.  Rows that
    repeat the response's id are responses too.  Every attempt of a task writes names of its own and only those of attempts that
    succeeded are listed, so a lost executor leaves no half archive behind.
    """
    dictionary = build_dictionary(pages, text_col)
    payload = F.coalesce(F.col(text_col), F.lit(""))
    key = payload_key(payload, F.col(id_col))
    roles = page_roles(pages, least_bytes, id_col, text_col)
    records = pages.select(
        key.alias("_key"), F.col(id_col).cast("string").alias("page_id"), F.col(url_col).alias("url"), payload.alias("payload")
    ).join(roles, "_key").select("page_id", "url", "payload", F.col("refers_to").cast("string"))

    def written(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place, path = pyarrow.fs.FileSystem.from_uri(folder)
        place.create_dir(path, recursive=True)
        trained = zstandard.ZstdCompressionDict(dictionary)
        compressor = zstandard.ZstdCompressor(level=6, dict_data=trained)
        frame = struct.pack("<II", DICTIONARY_FRAME, len(dictionary)) + dictionary
        attempt = f"{TaskContext.get().partitionId():06d}-{uuid.uuid4().hex}"
        archives, sink, size, count = [], None, 0, 0

        def close() -> None:
            nonlocal sink
            if sink is not None:
                sink.close()
                archives.append((current, count, size))
                sink = None

        for batch in batches:
            for start in range(0, batch.num_rows, 100):
                for row in batch.slice(start, 100).to_pylist():
                    if sink is None:
                        current = f"pages-{attempt}-{len(archives):04d}.warc.zst"
                        sink, size, count = place.open_output_stream(f"{path}/{current}", compression=None), len(frame), 0
                        sink.write(frame)
                    record = write_record(row["page_id"], row["url"], row["payload"].encode(), row["refers_to"])
                    data = compressor.compress(record)
                    sink.write(data)
                    size, count = size + len(data), count + 1
                    if size >= archive_bytes:
                        close()
        close()
        names, counts, sizes = zip(*archives, strict=True) if archives else ([], [], [])
        arrays = [pa.array(names, pa.string()), pa.array(counts, pa.int64()), pa.array(sizes, pa.int64())]
        yield pa.RecordBatch.from_arrays(arrays, ["archive", "records", "bytes"])

    return stored(records.mapInArrow(written, "archive string, records long, bytes long"), "warc-list")


def frames(source, block: int = 1 << 16) -> Iterator[bytes]:
    """The records of an open archive, one decompressed frame after the other."""
    magic, length = struct.unpack("<II", source.read(8))
    if magic != DICTIONARY_FRAME:
        raise ValueError("the archive does not begin with a dictionary")
    reader = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(source.read(length)))
    left = b""
    while True:
        frame, parts = reader.decompressobj(), []
        while not frame.eof:
            left = left or source.read(block)
            if not left:
                if parts:
                    raise ValueError("the archive ends within a record")
                return
            parts.append(frame.decompress(left))
            left = frame.unused_data
        yield b"".join(parts)


def read_archives(archives: DataFrame, folder: str) -> DataFrame:
    """Every record of the listed archives: ``page_id`` (text), ``url``, ``payload`` (null for
    a revisit), ``payload_bytes``, ``payload_digest``, ``record_type``, ``refers_to`` (text).
    Payloads are checked against their digests."""
    schema = pa.schema([
        ("page_id", pa.string()), ("url", pa.string()), ("payload", pa.binary()), ("payload_bytes", pa.int64()),
        ("payload_digest", pa.string()), ("record_type", pa.string()), ("refers_to", pa.string()),
    ])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place, path = pyarrow.fs.FileSystem.from_uri(folder)
        for batch in batches:
            for name in batch.column(0).to_pylist():
                rows, size = [], 0
                with place.open_input_stream(f"{path}/{name}", compression=None) as source:
                    for record in frames(source):
                        headers, payload, length = read_record(record)
                        revisit = headers["WARC-Type"] == "revisit"
                        rows.append((
                            unquoted(headers.get("X-Page-ID")), headers.get("WARC-Target-URI"), None if revisit else payload, length,
                            headers["WARC-Payload-Digest"].removeprefix("sha1:"), headers["WARC-Type"],
                            unquoted(headers.get("X-Refers-To-Page-ID")),
                        ))
                        size += len(payload)
                        if size > 4 << 20 or len(rows) >= 5000:
                            yield batch_of(rows, schema)
                            rows, size = [], 0
                yield batch_of(rows, schema)

    columns = "page_id string, url string, payload binary, payload_bytes long, payload_digest string, record_type string, refers_to string"
    # One archive a task: the list is short, the archives are not.
    tasks = max(1, archives.count())
    return archives.select("archive").repartition(tasks, "archive").mapInArrow(read, columns)


def unquoted(value: str | None) -> str | None:
    return None if value is None else unquote(value)


def batch_of(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = zip(*rows, strict=True) if rows else [[] for _ in schema]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, schema.types, strict=True)], schema=schema)


def archive_round_trip(spark: SparkSession, pages: DataFrame, least_bytes: int = 0) -> DataFrame:
    """Write ``pages`` to archives in the shared folder and return what is read from them."""
    folder = new_folder(spark, "warc")
    id_type = pages.schema["page_id"].dataType
    read = read_archives(write_archives(pages, folder, least_bytes), folder)
    return read.withColumns({"page_id": F.col("page_id").cast(id_type), "refers_to": F.col("refers_to").cast(id_type)})
