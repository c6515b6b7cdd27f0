"""Web archives of individually compressed records that share a Zstandard dictionary.

Every page becomes one record: the first page with a payload is a response, later ones
with an equal payload are revisits that name it. Each task writes archives of bounded
size. An archive begins with a skippable frame that holds a dictionary, built from
records of that archive; every record after it is a Zstandard frame of its own, so that
a reader can start at any of them.

Payloads are grouped by SHA-1 and length before anything moves, one row per payload and
task. The join that hands the first page to all others is a plain one, in which Spark
splits the partition of a payload that very many pages share.

Archives are written under a temporary name and renamed when complete; a task that is
run again writes the same names. Reading takes one task per archive.

Defined results: NULL html is an empty payload. A NULL page_id is larger than any other.
Rows that repeat both page_id and payload are written once each with the same type. A
NULL url is left out of the record. An empty table gives no archives and no rows.
"""

import base64
import datetime
import hashlib
import io
import struct

import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quizloom.operators.storage import materialise, new_folder

MIN_DEDUP_BYTES = 0
# Payload bytes in one archive, held in memory until its dictionary is built.
ARCHIVE_BYTES = 32 << 20
DICTIONARY_BYTES = 64 << 10
# Of an archive, evenly spaced slices of at most this many bytes train the dictionary.
TRAINING_BYTES = 4 << 20
SLICE_BYTES = 16 << 10
LEVEL = 3
_LAST = (1 << 63) - 1
_READ_BYTES = 256 << 10

# The magic number of the skippable frame that holds a dictionary, the
# archive version and the profile of a revisit.
DICTIONARY_MAGIC = 0x184D2A5D
VERSION = "WARC/1.1"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_PAGE = "urn:quizloom:page:"


def file_system(uri: str):
    """File system and path of a folder or file that all executors share."""
    from pyarrow import fs

    if uri.startswith("file:/") and not uri.startswith("file://"):
        uri = "file://" + uri.removeprefix("file:")
    return fs.FileSystem.from_uri(uri)


def with_first_page(pages: DataFrame, min_bytes: int = MIN_DEDUP_BYTES) -> DataFrame:
    """``page_id, url, html, first_id, is_first`` for payloads of several pages.

    ``first_id`` is the smallest page_id with the same payload; payloads shorter than
    ``min_bytes`` are always first.
    """
    html = F.coalesce("html", F.lit(""))
    rows = pages.select(
        "page_id",
        "url",
        html.alias("html"),
        F.sha1(html).alias("_digest"),
        F.octet_length(html).alias("_bytes"),
        F.coalesce("page_id", F.lit(_LAST)).alias("_order"),
    )
    firsts = (
        rows.filter(F.col("_bytes") >= min_bytes)
        .groupBy("_digest", "_bytes")
        .agg(F.min("_order").alias("_first"), F.count("*").alias("_pages"))
        .filter("_pages > 1")
        .drop("_pages")
    )
    first = F.coalesce("_first", "_order")
    return rows.join(firsts, ["_digest", "_bytes"], "left").select(
        "page_id",
        "url",
        "html",
        F.when(first != _LAST, first).alias("first_id"),
        (F.col("_order") == first).alias("is_first"),
    )


def _record(kind: str, fields: list[tuple[str, str]], block: bytes) -> bytes:
    head = [VERSION, f"WARC-Type: {kind}"]
    head += [f"{name}: {value}" for name, value in fields]
    head.append(f"Content-Length: {len(block)}")
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def _page_urn(page_id: int | None) -> str:
    return f"<{_PAGE}{'none' if page_id is None else page_id}>"


def payload_digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def page_record(page_id, url, payload: bytes, first_id, is_first: bool, date: str) -> bytes:
    fields = [("WARC-Record-ID", _page_urn(page_id)), ("WARC-Date", date)]
    if url is not None:
        fields.append(("WARC-Target-URI", " ".join(url.split())))
    fields.append(("WARC-Payload-Digest", f"sha1:{payload_digest(payload)}"))
    if not is_first:
        fields.append(("WARC-Refers-To", _page_urn(first_id)))
        fields.append(("WARC-Profile", REVISIT_PROFILE))
    fields.append(("Content-Type", "application/http; msgtype=response"))
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html\r\nContent-Length: {len(payload)}\r\n\r\n"
    block = http.encode() + (payload if is_first else b"")
    return _record("response" if is_first else "revisit", fields, block)


def _training_slices(records: list[bytes]) -> list[bytes]:
    """Evenly spaced slices of all records, ``TRAINING_BYTES`` at most."""
    total = sum(map(len, records))
    size = max(64, min(SLICE_BYTES, total // 16))
    slices = [r[at : at + size] for r in records for at in range(0, len(r), size)]
    limit, sample, past, taken = min(total, TRAINING_BYTES), [], 0, 0
    for piece in slices:
        # Taken as soon as the sample has no more than its share of the bytes passed.
        past += len(piece)
        if taken + len(piece) <= past * limit // total:
            sample.append(piece)
            taken += len(piece)
    return sample


def build_dictionary(records: list[bytes]):
    """Dictionary of evenly spaced slices; their plain bytes where training finds nothing.

    None only for records of fewer than 64 bytes in all.
    """
    size = min(DICTIONARY_BYTES, sum(map(len, records)) // 8)
    if size < 8:
        return None
    sample = _training_slices(records)
    try:
        return zstandard.train_dictionary(size, sample, k=256, d=8)
    except zstandard.ZstdError:
        return zstandard.ZstdCompressionDict(
            b"".join(sample)[:size], dict_type=zstandard.DICT_TYPE_RAWCONTENT
        )


def archive_bytes(records: list[bytes]) -> bytes:
    dictionary = build_dictionary(records)
    out = io.BytesIO()
    if dictionary is not None:
        content = dictionary.as_bytes()
        out.write(struct.pack("<II", DICTIONARY_MAGIC, len(content)) + content)
    worker = zstandard.ZstdCompressor(level=LEVEL, dict_data=dictionary)
    for record in records:
        out.write(worker.compress(record))
    return out.getvalue()


def write_archives(
    pages: DataFrame,
    folder: str,
    min_bytes: int = MIN_DEDUP_BYTES,
    archive_size: int = ARCHIVE_BYTES,
    date: str | None = None,
) -> DataFrame:
    """Write one record per page; a stored table of ``path, records, bytes``.

    ``folder`` must be shared by all executors.
    """
    date = date or datetime.datetime.now(datetime.UTC).strftime("%Y-%m-%dT%H:%M:%SZ")

    def write(batches):
        context = TaskContext.get()
        files, root = file_system(folder)
        files.create_dir(root, recursive=True)
        records, size, number = [], 0, 0

        def close():
            name = f"pages-{context.partitionId():06d}-{number:05d}.warc.zst"
            hidden = f"{root}/.{name}.{context.taskAttemptId()}"
            head = _record(
                "warcinfo",
                [
                    ("WARC-Record-ID", f"<urn:quizloom:archive:{name}>"),
                    ("WARC-Date", date),
                    ("WARC-Filename", name),
                    ("Content-Type", "application/warc-fields"),
                ],
                b"software: quizloom\r\nformat: WARC File Format 1.1\r\n",
            )
            content = archive_bytes([head, *records])
            with files.open_output_stream(hidden, compression=None) as out:
                out.write(content)
            files.move(hidden, f"{root}/{name}")
            return {"path": [f"{folder}/{name}"], "records": [len(records)], "bytes": [len(content)]}

        for batch in batches:
            for row in zip(*(batch.column(c) for c in batch.schema.names)):
                page_id, url, html, first_id, is_first = (v.as_py() for v in row)
                records.append(page_record(page_id, url, html.encode(), first_id, is_first, date))
                size += len(records[-1])
                if size >= archive_size:
                    yield pa.RecordBatch.from_pydict(close())
                    records, size, number = [], 0, number + 1
        if records:
            yield pa.RecordBatch.from_pydict(close())

    rows = with_first_page(pages, min_bytes)
    return materialise(rows.mapInArrow(write, "path STRING, records BIGINT, bytes BIGINT"))


def _frames(stream):
    """Content of the frames of an archive, one at a time."""
    buffer = stream.read(_READ_BYTES)
    dictionary = None
    if len(buffer) >= 8 and struct.unpack("<I", buffer[:4])[0] == DICTIONARY_MAGIC:
        size = struct.unpack("<I", buffer[4:8])[0]
        while len(buffer) < 8 + size:
            buffer += stream.read(_READ_BYTES)
        dictionary = zstandard.ZstdCompressionDict(buffer[8 : 8 + size])
        buffer = buffer[8 + size :]
    worker = zstandard.ZstdDecompressor(dict_data=dictionary)
    while buffer or (buffer := stream.read(_READ_BYTES)):
        frame, parts = worker.decompressobj(), []
        while True:
            parts.append(frame.decompress(buffer))
            if frame.eof:
                break
            buffer = stream.read(_READ_BYTES)
            if not buffer:
                raise ValueError("archive ends inside a record")
        buffer = frame.unused_data
        yield b"".join(parts)


def parse_record(record: bytes) -> tuple[dict[str, str], bytes]:
    head, _, rest = record.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    if lines[0] != VERSION:
        raise ValueError(f"not a record: {lines[0][:40]}")
    fields = dict(line.split(": ", 1) for line in lines[1:])
    return fields, rest[: int(fields["Content-Length"])]


def _page_of(urn: str | None) -> int | None:
    tail = (urn or "").strip("<>").removeprefix(_PAGE)
    return int(tail) if tail.lstrip("-").isdigit() else None


READ = (
    "page_id BIGINT, url STRING, payload_bytes BIGINT, payload_digest STRING,"
    " record_type STRING, refers_to BIGINT, payload BINARY"
)


def read_archives(spark: SparkSession, archives: DataFrame, payloads: bool = True) -> DataFrame:
    """One row per page record of the ``archives`` (a table with ``path``).

    The payload of a response is held against its digest. Revisits have none of their
    own; their length and digest are those of the payload they refer to.
    """

    def read(batches):
        for batch in batches:
            for path in batch.column("path").to_pylist():
                files, root = file_system(path)
                rows = {name.split()[0]: [] for name in READ.split(", ")}
                held = 0
                with files.open_input_stream(root, compression=None) as stream:
                    for record in _frames(stream):
                        fields, block = parse_record(record)
                        kind = fields["WARC-Type"]
                        if kind not in ("response", "revisit"):
                            continue
                        http, _, payload = block.partition(b"\r\n\r\n")
                        length = int(http.rpartition(b"Content-Length: ")[2].split(b"\r\n")[0])
                        digest = fields["WARC-Payload-Digest"].removeprefix("sha1:")
                        if kind == "response" and (
                            len(payload) != length or payload_digest(payload) != digest
                        ):
                            raise ValueError(f"{path}: damaged payload in {fields['WARC-Record-ID']}")
                        rows["page_id"].append(_page_of(fields["WARC-Record-ID"]))
                        rows["url"].append(fields.get("WARC-Target-URI"))
                        rows["payload_bytes"].append(length)
                        rows["payload_digest"].append(digest)
                        rows["record_type"].append(kind)
                        rows["refers_to"].append(_page_of(fields.get("WARC-Refers-To")))
                        keep = payloads and kind == "response"
                        rows["payload"].append(payload if keep else None)
                        held += len(payload) if keep else 0
                        if held > ARCHIVE_BYTES or len(rows["page_id"]) >= 10_000:
                            yield pa.RecordBatch.from_pydict(rows, schema=_READ_ARROW)
                            rows, held = {name: [] for name in rows}, 0
                if rows["page_id"]:
                    yield pa.RecordBatch.from_pydict(rows, schema=_READ_ARROW)

    count = max(1, archives.count())
    return archives.select("path").repartition(count).mapInArrow(read, READ)


_READ_ARROW = pa.schema(
    [
        ("page_id", pa.int64()),
        ("url", pa.string()),
        ("payload_bytes", pa.int64()),
        ("payload_digest", pa.string()),
        ("record_type", pa.string()),
        ("refers_to", pa.int64()),
        ("payload", pa.binary()),
    ]
)


def archive_round_trip(pages: DataFrame) -> DataFrame:
    """Write all pages to a new folder of archives and read the records back."""
    spark = pages.sparkSession
    archives = write_archives(pages, new_folder(spark, "warc"))
    return read_archives(spark, archives, payloads=False)
