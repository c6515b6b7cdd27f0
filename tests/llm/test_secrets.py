import json
import lzma
import time
import zipfile
import base64
import bz2
import gzip
import hashlib
import io
import random
import re
import tarfile
import urllib.parse
import zlib

import pytest
import zstandard
from helpers import edge_documents, empty_documents
from hypothesis import given
from hypothesis import strategies as st

from quizloom.llm import secrets
from quizloom.llm.secrets import all_spans, base_spans, joined, scan_secrets

SECRET = "password=abcdef123456"


def brute_base(text):
    kinds = (
        ("assign", r"""([pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""),
        ("access", r"(AKIA[A-Z0-9]+)"),
        ("hex", r"([0-9a-f]+)"),
    )
    least = {"assign": 6, "access": 20, "hex": 24}
    out = []
    for kind, pattern in kinds:
        for m in re.finditer(pattern, text):
            part = m.group(m.lastindex)
            if len(part) >= least[kind]:
                out.append((m.start(), kind, m.end()))
    return sorted(out)


@given(
    st.lists(
        st.sampled_from(
            ["password", "API_KEY", "token", "=", ": ", '"', "abc", "0123456789abcdef", "AKIA",
             "ABCDEFGHIJ", " ", "é", "ſecret", "-", "toKen", "\n", "Z9"]
        ),
        max_size=14,
    ).map("".join)
)
def test_base_spans(text):
    assert sorted(base_spans(text)) == brute_base(text)


def spans(text):
    base, deeper = all_spans(text)
    return base, {kind: (start, end) for start, kind, end in deeper}


def test_nested_layers_map_back():
    inner = urllib.parse.quote(SECRET, safe="")
    packed = base64.b64encode(gzip.compress(inner.encode())).decode()
    twice = base64.b64encode(f"see {SECRET} there".encode()).decode()
    text = f"é start {inner} mid {packed} end {twice}"
    _, deeper = spans(text)
    start, end = deeper["assign@url"]
    assert text[start:end] == inner
    start, end = deeper["assign@base64+packed+url"]
    assert text[start:end] == packed
    start, end = deeper["assign@base64"]
    piece = text[start:end]
    assert piece in twice and len(piece) <= -(-len(SECRET) * 4 // 3) + 4


def test_unicode_escapes_and_wrapped_base64():
    escaped = "".join(f"\\u{ord(c):04x}" for c in SECRET)
    assert spans(f"a {escaped} b")[1]["assign@unicode"] == (2, 2 + len(escaped))
    raw = base64.encodebytes((" filler" * 20 + SECRET + " tail" * 10).encode()).decode()
    assert "assign@base64" in spans(f"x\n{raw}\ny")[1]


@pytest.mark.parametrize(
    "text,way",
    [
        (r"\u0070assword = hunter22", "unicode"),
        ("password%3A hunter22", "url"),
        (r"api_key = \x68\x75\x6e\x74\x65\x72\x32\x32", "unicode"),
        (r"pass%77ord \u003d hunter22", "url+unicode"),
        ("%E2%82%70assword = hunter22", "url"),
    ],
)
def test_escapes_are_read_with_their_neighbours(text, way):
    secret = text[text.index("%70") :] if "%70" in text else text
    for before in ("", "é one\n\ntoken=abcdef "):
        start = len(before) + len(text) - len(secret)
        base, deeper = all_spans(f"{before}{text}, on\nlast")
        assert deeper == [(start, f"assign@{way}", start + len(secret))]
        assert len(base) == bool(before)
    packed = base64.b64encode(f"see {text}, on".encode()).decode()
    assert f"assign@base64+{way}" in spans(f"a {packed} b")[1]


def test_escapes_in_some_lines_of_wrapped_base64():
    raw = base64.encodebytes((" filler>" * 20 + SECRET + " tail" * 40).encode()).decode().splitlines()
    raw[0] = "%" + f"{ord(raw[0][0]):02x}" + raw[0][1:]
    assert "assign@url+base64" in spans("x\n" + "\n".join(raw) + "\ny")[1]


@pytest.mark.parametrize(
    "raw,way",
    [
        (f"a\xa0{SECRET} tail".encode(), "base64"),
        (f"\ufeffa\u3000\u200b{SECRET}\f\0\x1b".encode(), "base64"),
        (f"été {SECRET} été".encode("latin-1"), "base64"),
        (f"été {SECRET} \u0119".encode("utf-16"), "base64+utf16"),
        (f"été {SECRET} \u0119".encode("utf-16-be"), "base64+utf16"),
        (f"été {SECRET}".encode("utf-32-le"), "base64+utf32"),
    ],
)
def test_any_bytes_are_read(raw, way):
    start, end = spans(f"x {base64.b64encode(raw).decode()} y")[1][f"assign@{way}"]
    width = len(raw.split(SECRET[0].encode(), 1)[0])
    assert start == 2 + width * 4 // 3
    assert end <= 2 + -(-len(raw) * 4 // 3)


def packed_spans(raw):
    return spans(base64.b64encode(raw).decode())[1]


def test_tar_and_all_members():
    tar = io.BytesIO()
    with tarfile.open(fileobj=tar, mode="w:gz") as files:
        info = tarfile.TarInfo("a")
        info.size = len(SECRET)
        files.addfile(info, io.BytesIO(SECRET.encode()))
    assert "assign@base64+packed" in packed_spans(tar.getvalue())
    for pack in (gzip.compress, zlib.compress, bz2.compress, zstandard.compress):
        # The second member begins inside the secret.
        both = pack(b"first passw") + pack(b"ord=abcdef123456")
        assert "assign@base64+packed" in packed_spans(both)
        many = b"".join(pack(bytes([c])) for c in SECRET.encode())
        assert "assign@base64+packed" in packed_spans(many + b"rest")
        nested = gzip.compress(pack(SECRET.encode()) + b"\0")
        assert "assign@base64+packed+packed" in packed_spans(nested)
    cut = gzip.compress(SECRET.encode() + b" " + random.Random(1).randbytes(9000))[:-2000]
    assert "assign@base64+packed" in packed_spans(cut)
    skippable = b"\x50\x2a\x4d\x18\x02\0\0\0ab"
    assert "assign@base64+packed" in packed_spans(
        zstandard.compress(b"x") + skippable + zstandard.compress(SECRET.encode())
    )


@pytest.mark.parametrize("pack", [gzip.compress, bz2.compress, zstandard.compress])
def test_large_content_is_scanned_in_blocks(monkeypatch, pack):
    monkeypatch.setattr(secrets, "MAX_LAYER", 1 << 16)
    inner = base64.encodebytes(b"filler " * 700 + SECRET.encode() + b" tail" * 700)
    for at in range(60_000, 66_000, 700):
        content = b"lorem, " * (at // 7) + SECRET.encode() + b", ipsum" * 30_000 + b" \n"
        found = packed_spans(pack(content))
        # Zstandard keeps rare text as it is.
        assert "assign@base64+packed" in found and "oversized" not in found
        wrapped = b"lorem, " * (at // 7) + b"\n" + inner + b" ipsum," * 9000
        found = packed_spans(pack(wrapped))
        assert "assign@base64+packed+base64" in found and "oversized" not in found
    run = b"Z" * 300_000 + b" " + SECRET.encode()
    assert set(packed_spans(pack(run))) >= {"assign@base64+packed", "oversized"}


def test_many_nested_members_end():
    raw = SECRET.encode()
    for _ in range(600):
        raw = gzip.compress(raw, 0)
    assert "assign@base64" + "+packed" * 600 in packed_spans(raw)


@pytest.mark.parametrize("before", ["example.com/path/", "session-", "blob_", "a/b-c_d", "xy", "Q"])
def test_base64_after_other_text(before):
    for raw, way in (
        (f"{SECRET} tail".encode(), ""),
        (gzip.compress(f"{SECRET} tail".encode()), "+packed"),
        (zlib.compress(f"{SECRET} tail".encode()), "+packed"),
        (base64.b64encode(f"{SECRET} tail".encode()), "+base64"),
    ):
        text = f"é {before}{base64.b64encode(raw).decode().rstrip('=')}/more"
        start, end = spans(text)[1][f"assign@base64{way}"]
        if not way:
            assert text[:start] == f"é {before}" and end == start + -(-len(SECRET) * 4 // 3)


@pytest.mark.parametrize("after", ["word and", "-----END", "\nword"])
def test_wrapped_base64_with_a_full_last_line(after):
    for raw in (b" filler" * 6 + SECRET.encode() + b" tail tail" * 5, gzip.compress(SECRET.encode() * 9 + random.Random(1).randbytes(60))):
        raw += b" " * (-len(raw) % 57)
        block = base64.encodebytes(raw).decode()
        label = "assign@base64+packed" if raw[:1] == b"\x1f" else "assign@base64"
        assert label in spans(f"x\n{block}{after}")[1]
    lines = "\n".join(base64.b64encode((c * 31 + SECRET).encode()).decode().rstrip("=") for c in "ab,") + "\n"
    found = [text for text in all_spans(lines)[1] if text[1] == "assign@base64"]
    assert len({lines[:start].count("\n") for start, _, _ in found}) == 3


def test_parts_of_a_span_are_not_listed():
    raw = b" filler" * 6 + SECRET.encode() + b" tail tail" * 5
    assert len(all_spans(base64.encodebytes(raw).decode())[1]) == 1


def test_layers_end():
    text = SECRET
    for _ in range(6):
        text = base64.b64encode(text.encode()).decode()
    assert len(spans(text)[1]) == 1
    assert spans("%25%32%35" * 2000)[1] == {}


def test_edge_rows(spark):
    docs = edge_documents(spark, "spans")
    result = scan_secrets(docs)
    assert result.count() == docs.count()
    assert {r.spans for r in result.collect()} == {""}
    text = f"{SECRET} AKIA{'Z' * 16} {'0a' * 12}"
    row = scan_secrets(spark.createDataFrame([(1, text)], "doc_id BIGINT, text STRING")).first()
    assert (row.n_assign, row.n_access, row.n_hex) == (1, 1, 1)
    expected = joined([(s, k, e) for s, k, e in brute_base(text)])
    assert row.base_sha256 == hashlib.sha256(expected.encode()).hexdigest()
    assert scan_secrets(empty_documents(spark)).count() == 0


PLAIN = b"some text password=hunter22abc and more of it to compress " * 3
ZIPPED = gzip.compress(bytes(range(256)) * 2 + PLAIN)


def zip_archive(content):
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as archive:
        archive.writestr("a.txt", content)
        archive.writestr("b.txt", b"nothing here " * 9)
    return out.getvalue()


def wrapped(width, lead=""):
    encoded = base64.b64encode(ZIPPED).decode()
    return "\n".join(lead + encoded[i : i + width] for i in range(0, len(encoded), width))


@pytest.mark.parametrize(
    "text, way",
    [
        (urllib.parse.quote_from_bytes(gzip.compress(PLAIN)), "url+packed"),
        ("".join(f"\\x{c:02x}" for c in gzip.compress(PLAIN)), "unicode+packed"),
        (wrapped(64, "    "), "base64+packed"),
        (wrapped(64, "> "), "base64+packed"),
        (wrapped(76, "\t"), "base64+packed"),
        (wrapped(32), "base64+packed"),
        (json.dumps({"k": wrapped(64)}), "unicode+base64+packed"),
        (base64.b64encode(zip_archive(PLAIN)).decode(), "base64+packed"),
        (base64.b64encode(lzma.compress(PLAIN)).decode(), "base64+packed"),
        (r"\U00000070assword = hunter22", "unicode"),
        ("%u0070assword=hunter22", "unicode"),
        (r"\160assword=hunter22", "unicode"),
        (r"{\"password\":\"hunter22\"}", "unicode"),
        (json.dumps(json.dumps(json.dumps({"password": "hunter22"}))), "unicode+unicode"),
        ("pass%" + "25" * 50 + "77ord=hunter22", "url+url+url"),
        ("pass&" + "#38;" * 50 + "#119;ord=hunter22", "unicode+unicode+unicode"),
    ],
)
def test_layers_of_all_kinds(text, way):
    base, deeper = secrets.all_spans("before\n" + text + "\nafter")
    found = [(start, end) for start, kind, end in deeper if kind == f"assign@{way}"]
    assert found
    assert all(7 <= start < end <= 7 + len(text) for start, end in found)


@pytest.mark.parametrize(
    "text",
    ["%" + "25" * 3000 + "41", "&" + "#38;" * 3000 + "#65;", "\\" + "u005c" * 3000 + "u0041", "\\" * 20_000],
)
def test_signs_escaped_many_times_end_soon(text):
    began = time.process_time()
    secrets.all_spans(" ".join([text] * 5))
    assert time.process_time() - began < 1


def test_places_of_nested_escapes_are_exact():
    """Composed places against those found by following every character."""
    inner = "a password=hunter22 z"
    once = "".join(f"%{ord(c):02x}" if i % 3 == 0 else c for i, c in enumerate(inner))
    twice = "".join(f"&#{ord(c)};" if i % 4 == 0 else c for i, c in enumerate(once))
    lead = "x " * 5
    _, deeper = secrets.all_spans(lead + twice)
    start, kind, end = next(s for s in deeper if s[1] == "assign@unicode+url")
    sizes = [len(f"&#{ord(c)};") if i % 4 == 0 else 1 for i, c in enumerate(once)]
    ends = [sum(sizes[: i + 1]) for i in range(len(once))]
    starts = [0, *ends]
    place, at = [], 0
    for i, c in enumerate(inner):
        width = 3 if i % 3 == 0 else 1
        place.append((starts[at], ends[at + width - 1]))
        at += width
    first, last = inner.index("password"), inner.index(" z") - 1
    assert (start, end) == (len(lead) + place[first][0], len(lead) + place[last][1])
