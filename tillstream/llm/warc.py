"""WARC archives with records compressed one by one against a shared dictionary."""

from __future__ import annotations

import hashlib
import re
import struct
import uuid
from collections.abc import Iterable, Iterator

import pyarrow as pa
import zstandard
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillstream.llm.common import cut, scratch_path

# Payloads shorter than this are archived whole, however often they occur.
MIN_REVISIT_BYTES = 100
# Payload bytes of one archive; a task goes on to another file beyond it.
ARCHIVE_BYTES = 32 << 20
# The dictionary and the bytes of records it is made from, evenly over the archive.
DICTIONARY_BYTES, SAMPLE_BYTES = 16 << 10, 1 << 20

# Fixed values of the formats: a skippable frame that holds a dictionary, and the names
# and version line of the records.
DICTIONARY_FRAME = 0x184D2A5D
VERSION = b"WARC/1.1"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
RECORD_DATE = "1970-01-01T00:00:00Z"
CONTENT_TYPE = "text/html"

MANIFEST = "path string, records bigint, payload_bytes bigint, file_bytes bigint"
RECORDS = (
    "page_id string, record_type string, refers_to string, payload_digest string, "
    "payload_bytes bigint, url string, payload binary"
)


def mark_revisits(
    pages: DataFrame,
    id_col: str = "page_id",
    url_col: str = "url",
    payload_col: str = "html",
    min_bytes: int = MIN_REVISIT_BYTES,
) -> DataFrame:
    """``pages`` as records to write: ``_id``, ``_url``, ``_payload``, ``_digest``, ``_first``.

    ``_first`` is the page a revisit refers to, null for a response. Of pages with equal
    payloads of at least ``min_bytes`` the smallest id is the response. A null payload
    is empty. Rows that repeat the smallest id are responses too; a null id revisits
    the smallest that is not null, and is a response where there is none.
    """
    payload = F.coalesce(F.col(f"`{payload_col}`").cast("binary"), F.lit(b""))
    records = pages.select(
        F.col(f"`{id_col}`").alias("_id"),
        F.col(f"`{url_col}`").cast("string").alias("_url"),
        payload.alias("_payload"),
        F.sha2(payload, 256).alias("_digest"),
    )
    # Grouped as a struct: the join deals both sides out, and a payload that very many
    # pages share can be split over tasks.
    firsts = (
        pages.select(F.col(f"`{id_col}`").alias("_id"), payload.alias("_payload"))
        .filter(F.octet_length("_payload") >= min_bytes)
        .select("_id", F.struct(F.sha2("_payload", 256).alias("digest")).alias("_key"))
        .groupBy("_key")
        .agg(F.min("_id").alias("_least"), F.count("*").alias("_n"))
        .filter("_n > 1")
        .select(F.col("_key.digest").alias("_digest"), "_least")
    )
    first = F.when(~F.col("_id").eqNullSafe(F.col("_least")), F.col("_least"))
    return records.join(firsts, "_digest", "left").select(
        "_id", "_url", "_payload", "_digest", first.alias("_first")
    )


def _line(name: str, value: str) -> bytes:
    # A header ends with its line, so line breaks within a value are encoded.
    return f"{name}: {value}".replace("\r", "%0D").replace("\n", "%0A").encode() + b"\r\n"


def record_id(page_id: str | None, digest: str) -> str:
    """Follows from page and payload, so a revisit can name its response before it is written."""
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{page_id}|{digest}')}>"


def record_bytes(
    page_id: str | None, url: str | None, payload: bytes, digest: str, first: str | None
) -> bytes:
    """One record, uncompressed: version, headers, block and the two empty lines.

    Rows that are equal make records with equal ids.
    """
    revisit = first is not None
    block = b"" if revisit else payload
    head = [
        VERSION + b"\r\n",
        _line("WARC-Type", "revisit" if revisit else "response"),
        _line("WARC-Record-ID", record_id(page_id, digest)),
        _line("WARC-Date", RECORD_DATE),
        _line("WARC-Payload-Digest", f"sha256:{digest}"),
        _line("X-Payload-Length", str(len(payload))),
    ]
    if page_id is not None:
        head.append(_line("X-Page-ID", page_id))
    if url is not None:
        head.append(_line("WARC-Target-URI", url))
    if revisit:
        head.append(_line("WARC-Profile", REVISIT_PROFILE))
        # The response's record has the same digest; its page is named for our own reading.
        head.append(_line("WARC-Refers-To", record_id(first, digest)))
        head.append(_line("X-Refers-To-Page-ID", first))
    else:
        head.append(_line("Content-Type", CONTENT_TYPE))
    head.append(_line("Content-Length", str(len(block))))
    return b"".join(head) + b"\r\n" + block + b"\r\n\r\n"


def parse_record(record: bytes) -> dict[str, object]:
    """The fields of one record; a response's payload is held against its digest."""
    head, _, rest = record.partition(b"\r\n\r\n")
    version, *lines = head.split(b"\r\n")
    if version != VERSION:
        raise ValueError(f"not a record: {version[:20]!r}")
    fields = dict(line.decode().split(": ", 1) for line in lines)
    payload = rest[: int(fields["Content-Length"])]
    digest = fields["WARC-Payload-Digest"].removeprefix("sha256:")
    kind = fields["WARC-Type"]
    if kind == "response" and hashlib.sha256(payload).hexdigest() != digest:
        raise ValueError(f"payload of {fields['WARC-Record-ID']} differs from its digest")
    return {
        "page_id": fields.get("X-Page-ID"),
        "record_type": kind,
        "refers_to": fields.get("X-Refers-To-Page-ID"),
        "payload_digest": digest,
        "payload_bytes": int(fields["X-Payload-Length"]),
        "url": fields.get("WARC-Target-URI"),
        "payload": payload if kind == "response" else None,
    }


def build_dictionary(records: list[bytes]) -> zstandard.ZstdCompressionDict:
    """A dictionary from records spread evenly over the archive, ``SAMPLE_BYTES`` at most.

    Too few or too small records to train on make a dictionary of their raw bytes.
    """
    total = sum(map(len, records))
    step = max(1, -(-total // SAMPLE_BYTES))
    samples = [r[: SAMPLE_BYTES // 8] for r in records[::step]]
    if len(samples) >= 16 and sum(map(len, samples)) >= 8 * DICTIONARY_BYTES:
        try:
            return zstandard.train_dictionary(DICTIONARY_BYTES, samples, k=256, d=8)
        except zstandard.ZstdError:
            pass
    return zstandard.ZstdCompressionDict(
        b"".join(samples)[:DICTIONARY_BYTES], dict_type=zstandard.DICT_TYPE_RAWCONTENT
    )


def archive_bytes(records: list[bytes]) -> bytes:
    """An archive: the dictionary in a skippable frame, then a frame per record."""
    dictionary = build_dictionary(records)
    raw = dictionary.as_bytes()
    compressor = zstandard.ZstdCompressor(level=3, dict_data=dictionary, write_content_size=True)
    head = struct.pack("<II", DICTIONARY_FRAME, len(raw)) + raw
    return head + b"".join(map(compressor.compress, records))


def archive_records(archive: bytes) -> Iterator[bytes]:
    """The records of an archive, one frame at a time."""
    magic, length = struct.unpack_from("<II", archive)
    if magic != DICTIONARY_FRAME:
        raise ValueError("the archive does not begin with its dictionary")
    dictionary = zstandard.ZstdCompressionDict(archive[8 : 8 + length])
    decompressor = zstandard.ZstdDecompressor(dict_data=dictionary)
    rest = memoryview(archive)[8 + length :]
    while len(rest):
        # Stops at the end of the frame and keeps what follows it.
        frame = decompressor.decompressobj()
        record, size = [], 0
        while not frame.eof:
            part = rest[size : size + (1 << 16)]
            if not len(part):
                raise ValueError("the archive ends within a record")
            record.append(frame.decompress(part))
            size += len(part)
        rest = rest[size - len(frame.unused_data) :]
        yield b"".join(record)


def _filesystem(folder: str) -> tuple[fs.FileSystem, str]:
    if re.match(r"[a-z][a-z0-9+.-]*:", folder):
        return fs.FileSystem.from_uri(folder)
    return fs.LocalFileSystem(), folder


def write_archives(
    records: DataFrame, folder: str, archive_size: int = ARCHIVE_BYTES
) -> DataFrame:
    """Write the records of ``mark_revisits`` to ``folder``; returns the manifest.

    Each task writes the records it holds to files of about ``archive_size`` payload
    bytes. File names hold the task attempt, and the manifest, written to the shared
    folder, lists those of successful attempts only: files that a lost executor or a
    repeated attempt has left are never read. ``folder`` must be shared storage.
    """

    def written(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, path = _filesystem(folder)
        store.create_dir(path, recursive=True)
        task = TaskContext.get()
        name = f"{path}/part-{task.partitionId():06d}-{task.taskAttemptId()}"
        held: list[bytes] = []
        done, size = 0, 0

        def close() -> pa.RecordBatch:
            data = archive_bytes(held)
            file = f"part-{task.partitionId():06d}-{task.taskAttemptId()}-{done:04d}.warc.zst"
            with store.open_output_stream(f"{path}/{file}", compression=None) as out:
                out.write(data)
            row = [f"{folder.rstrip('/')}/{file}"], [len(held)], [size], [len(data)]
            return pa.RecordBatch.from_arrays(
                [pa.array(row[0])] + [pa.array(x, pa.int64()) for x in row[1:]],
                names=["path", "records", "payload_bytes", "file_bytes"],
            )

        for batch in batches:
            for row in zip(*(batch.column(k) for k in range(5)), strict=True):
                record = record_bytes(*(x.as_py() for x in row))
                held.append(record)
                size += len(record)
                if size >= archive_size:
                    yield close()
                    held, size, done = [], 0, done + 1
        if held:
            yield close()

    plain = records.select(
        F.col("_id").cast("string"),
        "_url",
        "_payload",
        "_digest",
        F.col("_first").cast("string"),
    )
    return cut(plain.mapInArrow(written, MANIFEST))


def read_archives(manifest: DataFrame) -> DataFrame:
    """The records of the archives a manifest lists, as ``RECORDS``.

    Each task that wrote files has a part of the manifest, so as many tasks read, one
    file at a time. Response payloads are decompressed whole and checked against their
    digests.
    """

    def parsed(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [x.split()[0] for x in RECORDS.split(", ")]
        kinds = dict(payload_bytes=pa.int64(), payload=pa.binary())
        schema = pa.schema([(n, kinds.get(n, pa.string())) for n in names])
        for batch in batches:
            for path in batch.column(0).to_pylist():
                store, at = _filesystem(path)
                with store.open_input_file(at) as file:
                    archive = file.read()
                rows, size = [], 0
                for record in archive_records(archive):
                    rows.append(parse_record(record))
                    size += len(record)
                    if size >= 1 << 23:
                        yield pa.RecordBatch.from_pylist(rows, schema=schema)
                        rows, size = [], 0
                yield pa.RecordBatch.from_pylist(rows, schema=schema)

    return manifest.select("path").mapInArrow(parsed, RECORDS)


def archive_pages(
    pages: DataFrame,
    folder: str | None = None,
    id_col: str = "page_id",
    url_col: str = "url",
    payload_col: str = "html",
) -> DataFrame:
    """Archive pages below ``folder`` (else the shared folder) and read them back.

    Returns ``RECORDS`` with ``page_id`` and ``refers_to`` of the type of ``id_col``. A
    null payload is an empty one; a null url has no header and comes back null. An
    empty table writes no archive.
    """
    folder = folder or scratch_path(pages.sparkSession, "warc")
    manifest = write_archives(mark_revisits(pages, id_col, url_col, payload_col), folder)
    kind = pages.schema[id_col].dataType
    return read_archives(manifest).withColumns(
        {c: F.col(c).cast(kind) for c in ("page_id", "refers_to")}
    )
