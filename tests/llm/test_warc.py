import hashlib
import random
import struct

import pytest
import zstandard

from quizloom.llm import warc
from quizloom.llm.warc import (
    DICTIONARY_MAGIC,
    archive_bytes,
    payload_digest,
    read_archives,
    write_archives,
)
from quizloom.operators.storage import new_folder

SCHEMA = "page_id BIGINT, url STRING, html STRING, extra STRING"


def round_trip(spark, rows, **settings):
    pages = spark.createDataFrame(rows, SCHEMA)
    archives = write_archives(pages, new_folder(spark, "warc"), **settings)
    return archives, [r.asDict() for r in read_archives(spark, archives).collect()]


def test_round_trip(spark):
    rows = [(i, f"http://a/{i}", f"<p>{i % 5} {'text ' * 50} é</p>", "e") for i in range(40)]
    rows += [(50, None, None, None), (51, "u\r\nX: y", "", None), (None, "n", "<p>solo</p>", None)]
    rows += [(3, "http://a/3", rows[3][2], "again")]
    archives, found = round_trip(spark, rows, archive_size=2_000)
    assert archives.count() > 1
    assert len(found) == len(rows)
    first = {}
    for page_id, _, html, _ in sorted(rows, key=lambda r: (r[0] is None, r[0] or 0)):
        first.setdefault(html or "", page_id)
    html_of = {page_id: html or "" for page_id, _, html, _ in rows}
    for row in found:
        html = html_of[row["page_id"]]
        assert row["payload_bytes"] == len(html.encode())
        assert row["payload_digest"] == payload_digest(html.encode())
        if first[html] == row["page_id"]:
            assert (row["record_type"], row["refers_to"]) == ("response", None)
            assert bytes(row["payload"]) == html.encode()
        else:
            assert (row["record_type"], row["refers_to"]) == ("revisit", first[html])
            assert row["payload"] is None
    assert {r["url"] for r in found if r["page_id"] == 51} == {"u X: y"}


def test_records_are_frames_behind_a_dictionary():
    records = [f"record {i} with shared words and phrases {hashlib.md5(bytes([i])).hexdigest()}".encode() * 5 for i in range(200)]
    data = archive_bytes(records)
    magic, size = struct.unpack("<II", data[:8])
    assert magic == DICTIONARY_MAGIC
    dictionary = zstandard.ZstdCompressionDict(data[8 : 8 + size])
    worker = zstandard.ZstdDecompressor(dict_data=dictionary)
    rest, found = data[8 + size :], []
    while rest:
        frame = worker.decompressobj()
        found.append(frame.decompress(rest))
        rest = frame.unused_data
    assert found == records


def test_empty_and_damaged(spark):
    archives, found = round_trip(spark, [])
    assert archives.count() == 0 and found == []
    archives, _ = round_trip(spark, [(1, "u", "<p>hello</p>" * 50, None)])
    path = archives.first().path
    local = path.replace("file:", "").replace("//", "/")
    with open(local, "rb") as f:
        data = f.read()
    with open(local, "wb") as f:
        f.write(data[:-3])
    with pytest.raises(Exception, match="archive ends inside a record"):
        read_archives(spark, archives).collect()


@pytest.mark.parametrize(
    "pages",
    [
        [b"<p>short</p>"],
        [random.Random(i).randbytes(3000).hex().encode() for i in range(3)],
        [random.Random(i).randbytes(600_000).hex().encode() for i in range(8)],
        [b"a" * 40_000] * 20,
    ],
)
def test_few_or_large_records_have_a_dictionary(pages):
    records = [warc.page_record(i, None, p, i, True, "2024-01-01T00:00:00Z") for i, p in enumerate(pages)]
    assert sum(map(len, warc._training_slices(records))) <= warc.TRAINING_BYTES
    data = warc.archive_bytes(records)
    magic, size = struct.unpack("<II", data[:8])
    assert magic == warc.DICTIONARY_MAGIC and 8 <= size <= warc.DICTIONARY_BYTES
    worker = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(data[8 : 8 + size]))
    at = 8 + size
    for record in records:
        frame = worker.decompressobj()
        assert frame.decompress(data[at:]) == record
        at = len(data) - len(frame.unused_data)
    assert at == len(data)
