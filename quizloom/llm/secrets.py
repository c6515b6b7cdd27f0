"""Secret scans of texts and of everything encoded inside them.

Each text is the first layer of a worklist. A layer is scanned for secrets, then its
encoded stretches are unwrapped: URL escapes, Unicode and string escapes, base64, also
wrapped, indented or quoted, and compressed data (gzip, zlib, bzip2, xz, Zstandard, zip)
inside base64 or escaped bytes. Escapes are decoded in place, so that
plain and decoded text of their lines are scanned together. Every unwrapped stretch is a
new layer with its own positions mapped back to the text, until no layer yields another.
A layer whose content was seen before in the same document at the same place is not
unwrapped again, so content that decodes to itself ends.

A document is handled by itself, in Arrow batches, without any shuffle.

Decoded bytes are scanned whatever they are: a byte that is not UTF-8 is one character
that no pattern has, and runs of UTF-16 and UTF-32 are layers of their own. A stretch of
base64 characters is decoded from each of its first four, as it may begin with other text.
All members of compressed data that begin anywhere are unpacked, and what a damaged or cut member yields before its error
counts.

Defined results: NULL text is the empty text and has no spans. Unpacked content is scanned
in blocks of ``MAX_LAYER`` bytes, cut where neither a secret nor an encoded stretch can go
on. Where no such place exists, blocks overlap, and a span of kind ``oversized`` says that
an encoded stretch longer than a block was not unwrapped as one. Other columns stay;
columns of the input with a name of a result column are replaced.
"""

import base64
import bisect
import bz2
import hashlib
import lzma
import re
import struct
import zlib
from array import array
from collections import deque
from dataclasses import dataclass
from itertools import accumulate
from urllib.parse import unquote_to_bytes

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame

from quizloom.llm.text import hide, with_fields

# Bytes of unpacked content that are held and scanned at a time.
MAX_LAYER = 8 << 20
_CHUNK = 1 << 16

# The kinds of secrets and the shortest match that counts.
KINDS = ("assign", "access", "hex")
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    re.IGNORECASE | re.ASCII,
)
ASSIGN_NAMES = ("password", "passwd", "secret", "token", "apikey", "api_key")
MIN_VALUE = 6
# Runs of these characters are maximal, so the shortest length can be asked of the
# pattern itself.
ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
HEX = re.compile(r"[0-9a-f]{24,}")

_URL = re.compile(r"%[0-9A-Fa-f]{2}")
# A sign that begins escapes and was escaped many times over is peeled in one step.
_URLS = re.compile(r"%(?:25){4,}|(?:%[0-9A-Fa-f]{2})+")
_CODE = (
    r"&(?:#38;|#[xX]26;){4,}|\\(?:u005[cC]|x5[cC]){4,}"
    r"|\\u([0-9A-Fa-f]{4})|\\u\{([0-9A-Fa-f]{1,6})\}|\\x([0-9A-Fa-f]{2})"
    r"|&#[xX]([0-9A-Fa-f]{1,6});|\\U([0-9A-Fa-f]{8})|%u([0-9A-Fa-f]{4})"
    r"|&#([0-9]{1,7});|\\([0-3][0-7]{2})"
)
_CODES = re.compile(_CODE)
_ESCAPE = re.compile(_CODE + r"|\\([\"'/\\bfnrt])")
# What the letters of string escapes stand for; others stand for themselves.
_LETTERS = {"b": "\b", "f": "\f", "n": "\n", "r": "\r", "t": "\t"}
_STRING_ESCAPE = re.compile(r"\\[\"'/\\bfnrt]")
# Lines of base64 that a string holds with its line ends escaped.
_ESCAPED_END = re.compile(r"[A-Za-z0-9+/_-]{32}(?:\\r)?\\n")
_WORD = re.compile(r"[^\s\"'<>]{24,}")
_HEX_BYTE = re.compile(rb"\\x([0-9A-Fa-f]{2})")
_BASE64 = re.compile(
    r"(?:[A-Za-z0-9+/_-]{32,}\r?\n[\x20\t>]*)+[A-Za-z0-9+/_-]*={0,2}|[A-Za-z0-9+/_-]{16,}={0,2}"
)
# What may stand between the lines of a wrapped block.
_BETWEEN = "\r\n \t>="
_JOINED = str.maketrans("", "", "\r\n \t>")
_BASE64_LINE = re.compile(r"[A-Za-z0-9+/_-]{16,}={0,2}")
# The first bytes of the formats.
_PACKED = re.compile(
    rb"\x1f\x8b\x08|x[\x01\x5e\x9c\xda]|\x28\xb5\x2f\xfd"
    rb"|BZh[1-9](?:1AY&SY|\x17\x72\x45\x38\x50\x90)|\xfd7zXZ\0|PK\x03\x04.{4}\x08\0"
, re.DOTALL)
_SKIPPABLE = re.compile(rb"[\x50-\x5f]\x2a\x4d\x18")
# Low byte first or high byte first, by what stands before; two or four bytes a character.
_WIDE = {n: re.compile(rb"(?:[\t-\r\x20-\xff]\0{%d}){8,}[\t-\r\x20-\xff]?" % (n - 1)) for n in (2, 4)}
# Ends of blocks: after a byte of no secret and no encoded stretch, or after a line
# that no wrapped block goes on from.
_CUTS = (
    re.compile(rb"(?s).*[^A-Za-z0-9+/_.=:\"'\x20\r\n%\\&#;{}\0-]"),
    re.compile(rb"(?s).*[^A-Za-z0-9+/_\r\0-][A-Za-z0-9+/_-]{0,31}\r?\n"),
)
_WRAPPED_END = re.compile(r"[A-Za-z0-9+/_-]{32}\r?\Z")
_WRAPPED_LINES = re.compile(r"(?:[\x20\t>]*[A-Za-z0-9+/_-]{32,}\r?\n)*")


def base_spans(text: str) -> list[tuple[int, str, int]]:
    """``(start, kind, end)`` of the secrets in plain sight, unordered."""
    found = []
    lowered = text.lower()
    if any(name in lowered for name in ASSIGN_NAMES):
        for m in ASSIGN.finditer(text):
            if m.end(2) - m.start(2) >= MIN_VALUE:
                found.append((m.start(), "assign", m.end()))
    found += [(m.start(), "access", m.end()) for m in ACCESS.finditer(text)]
    found += [(m.start(), "hex", m.end()) for m in HEX.finditer(text)]
    return found


def _readable(raw: bytes) -> tuple[str, list[int]]:
    """Text of any bytes and the bytes of each character; an unreadable byte is a lone surrogate."""
    text = raw.decode("utf-8", "surrogateescape")
    return text, [
        1 if c < "\x80" or "\udc80" <= c <= "\udcff"
        else 2 if c < "\u0800" else 3 if c < "\U00010000" else 4
        for c in text
    ]


def _url_layer(piece: str):
    """Decoded text and ``(place, start, end)`` of each decoded character in ``piece``."""
    out, places, size, at = [], [], 0, 0
    for m in _URLS.finditer(piece):
        out.append(piece[at : m.start()])
        size += m.start() - at
        at = m.start()
        if m.group().startswith("%2525"):
            out.append("%25")
            places += [(size + i, *m.span()) for i in range(3)]
            size, at = size + 3, m.end()
            continue
        text, widths = _readable(bytes.fromhex(m.group().replace("%", "")))
        out.append(text)
        for width in widths:
            places.append((size, at, at + 3 * width))
            size, at = size + 1, at + 3 * width
    out.append(piece[at:])
    return "".join(out), places


def _escape_layer(piece: str):
    out, places, size, at = [], [], 0, 0
    for m in _ESCAPE.finditer(piece):
        *hexes, decimal, octal, letter = m.groups()
        digits = next(filter(None, hexes), None)
        if m.lastindex is None:
            sign = "&#38;" if m.group()[0] == "&" else "\\u005c"
            out += [piece[at : m.start()], sign]
            size += m.start() - at
            places += [(size + i, *m.span()) for i in range(len(sign))]
            size, at = size + len(sign), m.end()
            continue
        if digits:
            code = int(digits, 16)
        elif letter:
            code = ord(_LETTERS.get(letter, letter))
        else:
            code = int(decimal) if decimal else int(octal, 8)
        if code > 0x10FFFF or 0xD800 <= code < 0xE000:
            continue
        out += [piece[at : m.start()], chr(code)]
        size += m.start() - at
        places.append((size, *m.span()))
        size, at = size + 1, m.end()
    out.append(piece[at:])
    return "".join(out), places


class _Text:
    """Places of the text itself."""

    def span(self, start: int, end: int) -> tuple[int, int]:
        return start, end


class _Fixed:
    """Places of unpacked content: all of it stands for one stretch."""

    def __init__(self, start: int, end: int):
        self._place = start, end

    def span(self, start: int, end: int) -> tuple[int, int]:
        return self._place


class _Runs:
    """Places of characters of which some stand for stretches and all others follow on."""

    def __init__(self, first: int, entries: list[tuple[int, int, int]]):
        self.first = first
        self.at = array("q", [e[0] for e in entries])
        self.starts = array("q", [e[1] for e in entries])
        self.ends = array("q", [e[2] for e in entries])

    def char(self, i: int) -> tuple[int, int]:
        k = bisect.bisect_right(self.at, i) - 1
        if k < 0:
            return self.first + i, self.first + i + 1
        if self.at[k] == i:
            return self.starts[k], self.ends[k]
        place = self.ends[k] + i - self.at[k] - 1
        return place, place + 1

    def span(self, start: int, end: int) -> tuple[int, int]:
        return self.char(start)[0], self.char(end - 1)[1]

    def inside(self, outer: "_Runs") -> "_Runs":
        """The same characters in the places of the layer around ``outer``."""
        entries, here, there = [], 0, self.first

        def copied(upto: int | None) -> None:
            low = bisect.bisect_left(outer.at, there)
            high = len(outer.at) if upto is None else bisect.bisect_left(outer.at, upto)
            for k in range(low, high):
                entries.append((here + outer.at[k] - there, outer.starts[k], outer.ends[k]))

        for at, start, end in zip(self.at, self.starts, self.ends):
            copied(start)
            entries.append((at, *outer.span(start, end)))
            here, there = at + 1, end
        copied(None)
        return _Runs(outer.char(self.first)[0], entries)


class _Escapes:
    """Places of a layer of escapes; characters between decoded ones follow each other.

    Layers of escapes inside each other keep their places in what is around them all, so
    a place costs the same however deep its layer is.
    """

    def __init__(self, around, start: int, places: list[tuple[int, int, int]]):
        self._local = _Runs(start, [(at, start + first, start + last) for at, first, last in places])
        if isinstance(around, _Escapes):
            self._around, self._runs = around._around, self._local.inside(around._runs)
        else:
            self._around, self._runs = around, self._local

    def outside(self, start: int, end: int) -> tuple[int, int]:
        """Place in the layer around this one."""
        return self._local.span(start, end)

    def span(self, start: int, end: int) -> tuple[int, int]:
        return self._around.span(*self._runs.span(start, end))


class _Decoded:
    """Places of a base64 layer: characters have the place of their groups of four.

    ``bounds`` gives the first byte of each character and the end; both it and the
    positions of wrapped groups are only worked out if something was found.
    """

    def __init__(self, around, start: int, piece: str, shift: int, bounds):
        self._around, self._start, self._piece, self._bounds = around, start, piece, bounds
        self._shift = shift
        self._kept = None

    def span(self, start: int, end: int) -> tuple[int, int]:
        if self._kept is None:
            self._bounds = self._bounds()
            piece = self._piece
            if "\n" in piece:
                self._kept = array("q", [i for i, c in enumerate(piece) if c not in _BETWEEN])
            else:
                self._kept = range(len(piece.rstrip("=")))
        first = self._shift + self._bounds[start] * 4 // 3
        last = min(self._shift - (-self._bounds[end] * 4 // 3), len(self._kept)) - 1
        start, end = self._kept[first], self._kept[last] + 1
        return self._around.span(self._start + start, self._start + end)


def _texts(raw: bytes):
    """``(text, bounds, name)`` of the readings of some bytes; see ``_Decoded``."""
    if raw.isascii():
        yield raw.decode("ascii"), lambda: range(len(raw) + 1), ""
    else:
        text = raw.decode("utf-8", "surrogateescape")
        yield text, lambda: array("q", accumulate(_readable(raw)[1], initial=0)), ""
    for width, pattern in _WIDE.items():
        text, bounds = [], array("q")
        for m in pattern.finditer(raw) if b"\0" in raw else ():
            start, end = m.span()
            high_first = start >= width - 1 and not any(raw[start - width + 1 : start])
            if not high_first:
                end -= (end - start) % width
            text += [raw[start:end:width].decode("latin-1"), "�"]
            bounds.extend(range(start, end, width))
            bounds.append(end)
        if text:
            bounds.append(len(raw))
            yield "".join(text), lambda bounds=bounds: bounds, f"utf{width * 8}"


def _members(raw: bytes, end: list[int]):
    """Content of the compressed members that follow each other from ``end[0]`` on.

    Moves ``end[0]`` behind each member that is whole. Ends at data that is no member.
    """
    while m := _PACKED.match(raw, end[0]):
        at, step, limits = m.start(), _CHUNK, (_CHUNK,)
        if raw.startswith(b"BZh", at):
            worker = bz2.BZ2Decompressor()
        elif raw.startswith(b"\xfd7zXZ", at):
            worker = lzma.LZMADecompressor()
        elif raw.startswith(b"PK", at):
            # A deflated member of a zip archive, behind its own header.
            at += 30 + sum(struct.unpack("<HH", raw[at + 26 : at + 30].ljust(4, b"\0")))
            worker = zlib.decompressobj(-15)
        elif raw.startswith(b"\x28\xb5", at):
            # Its output cannot be limited; its input can.
            worker, step, limits = zstandard.ZstdDecompressor().decompressobj(), 256, ()
        else:
            worker = zlib.decompressobj(47)
        try:
            while not worker.eof and at < len(raw):
                piece = raw[at : at + step]
                at += len(piece)
                while True:
                    content = worker.decompress(piece, *limits)
                    yield content
                    piece = getattr(worker, "unconsumed_tail", b"")
                    if worker.eof or not limits or not piece and len(content) < _CHUNK:
                        break
        except (zlib.error, lzma.LZMAError, OSError, zstandard.ZstdError):
            return
        if not worker.eof:
            return
        at -= len(worker.unused_data)
        while skipped := _SKIPPABLE.match(raw, at):
            at = skipped.end() + 4 + int.from_bytes(raw[skipped.end() : skipped.end() + 4], "little")
        if raw.startswith(b"\0", at):
            at = len(raw) - len(raw[at:].lstrip(b"\0"))
        end[0] = at


def _blocks(chunks):
    """``(block, whole)`` of content; ``whole`` is false where something may be cut."""
    held = bytearray()
    for chunk in chunks:
        held += chunk
        while len(held) >= MAX_LAYER:
            at = max((m.end() for cut in _CUTS if (m := cut.match(held))), default=0)
            yield bytes(held[: at or len(held)]), at > 0
            del held[: at or len(held) - MAX_LAYER // 8]
    if held:
        yield bytes(held), True


def _unpacked(raw: bytes):
    """Blocks of the compressed content that begins anywhere in some bytes."""
    end = [0]
    while m := _PACKED.search(raw, end[0]):
        end[0] = m.start()
        yield from _blocks(_members(raw, end))
        end[0] = max(end[0], m.start() + 1)


def _base64_bytes(piece: str):
    """Bytes of a piece from each of its first four characters on.

    What is encoded may begin anywhere in the piece, after other text of the same
    characters, and may end before it; one of the four then has all of it.
    """
    clean = piece.translate(_JOINED).rstrip("=")
    clean = clean.replace("-", "+").replace("_", "/")
    for shift in range(4):
        rest = clean[shift:]
        if len(rest) % 4 == 1:
            rest = rest[:-1]
        yield shift, base64.b64decode(rest + "=" * (-len(rest) % 4))


def _may_have(text: str) -> bool:
    return bool(
        base_spans(text) or _URL.search(text) or _BASE64_LINE.search(text) or _has_escapes(text)
    )


def _has_escapes(text: str) -> bool:
    """True for escapes of codes, and for string escapes where they can hide something."""
    if "\\" not in text:
        return ("&#" in text or "%u" in text) and bool(_CODES.search(text))
    if _CODES.search(text):
        return True
    lowered = text.lower()
    hides = any(name in lowered for name in ASSIGN_NAMES) or _ESCAPED_END.search(text)
    return bool(hides and _STRING_ESCAPE.search(text))


def _escaped_lines(text: str, mark: re.Pattern) -> tuple[int, int]:
    """Place of the lines from the first escape to the last.

    Neighbouring lines of a wrapped base64 block belong to it: the block may have escapes
    in some of its lines only. No secret crosses a line end otherwise.
    """
    first = last = None
    for last in mark.finditer(text):
        first = first or last
    if first is None:
        return 0, 0
    start = text.rfind("\n", 0, first.start()) + 1
    while start and _WRAPPED_END.search(text, max(0, start - 34), start - 1):
        start = text.rfind("\n", 0, start - 1) + 1
    line = text.find("\n", last.end()) + 1 or len(text)
    line = _WRAPPED_LINES.match(text, line).end()
    return start, text.find("\n", line) + 1 or len(text)


def _escapes(text: str):
    """``(start, end, layer, places, name)`` of the escapes of a text."""
    marks = []
    if "%" in text:
        marks.append((_URL, _url_layer, "url"))
    if _has_escapes(text):
        marks.append((_ESCAPE, _escape_layer, "unicode"))
    for mark, unwrap, name in marks:
        start, end = _escaped_lines(text, mark)
        if start < end:
            yield start, end, *unwrap(text[start:end]), name


def _escaped_bytes(text: str):
    """``(start, end, bytes, name)`` of words whose escapes give compressed data."""
    if "%" not in text and "\\x" not in text:
        return
    for m in _WORD.finditer(text):
        word = m.group()
        if "%" in word:
            raw, name = unquote_to_bytes(word.encode("utf-8", "surrogateescape")), "url"
        elif "\\x" in word:
            raw = _HEX_BYTE.sub(lambda h: bytes.fromhex(h.group(1).decode()), word.encode("utf-8", "surrogateescape"))
            name = "unicode"
        else:
            continue
        if _PACKED.search(raw):
            yield *m.span(), raw, name


def _base64_pieces(text: str):
    """``(start, piece, is_line)``: base64 candidates, and the lines of wrapped ones.

    No wrapped block may it be after all: its lines may be encoded one by one.
    """
    for m in _BASE64.finditer(text):
        yield m.start(), m.group(), False
        if "\n" in m.group():
            for line in _BASE64_LINE.finditer(m.group()):
                yield m.start() + line.start(), line.group(), True


def _without_parts(spans: set, parts: set) -> list:
    """Spans and those of ``parts`` that are no part of a span of the same kind and way."""
    out = set(spans)
    by_kind = {}
    for start, kind, end in sorted(spans):
        starts, ends = by_kind.setdefault(kind, ([], []))
        starts.append(start)
        ends.append(max(end, ends[-1]) if ends else end)
    for start, kind, end in parts:
        starts, ends = by_kind.get(kind, ([], []))
        before = bisect.bisect_right(starts, start)
        if not before or ends[before - 1] < end or "+packed" in kind:
            out.add((start, kind, end))
    return sorted(out)


@dataclass
class _Layer:
    text: str
    places: object
    way: str = ""
    # For escapes: the spans of the layer around it, which are not found again.
    known: set | None = None
    # Comes from a line of a wrapped block, which is read as a whole as well.
    of_line: bool = False


class _Scan:
    """The worklist of a text. Unpacked blocks are made when their turn comes."""

    def __init__(self, text: str):
        self.base = base_spans(text)
        self.plain = set(self.base)
        self.deeper, self.parts = set(), set()
        self.seen = set()
        self.work = deque([_Layer(text, _Text())])

    def run(self) -> list:
        # A block and all it has inside are done before the next block is made.
        stack = [self.work]
        while stack:
            self.work = stack[-1]
            if not self.work:
                stack.pop()
                continue
            item = self.work.popleft()
            if isinstance(item, _Layer):
                self._layer(item)
                continue
            block = next(item, None)
            if block is not None:
                self.work.appendleft(item)
                self.work = deque()
                stack.append(self.work)
                self._bytes(*block)
        return _without_parts(self.deeper, self.parts)

    def _is_new(self, place: tuple[int, int], content: bytes) -> bool:
        mark = (place, hashlib.sha256(content).digest())
        new = mark not in self.seen
        self.seen.add(mark)
        return new

    def _layer(self, layer: _Layer) -> None:
        text, places, way = layer.text, layer.places, layer.way
        found = base_spans(text) if way else self.base
        if way:
            spans = self.parts if layer.of_line else self.deeper
            for start, kind, end in found:
                if layer.known:
                    first, last = places.outside(start, end)
                    if (first, kind, last) in layer.known:
                        continue
                start, end = places.span(start, end)
                if (start, kind, end) not in self.plain:
                    spans.add((start, f"{kind}@{way}", end))
        way = f"{way}+" if way else ""
        for start, end, inner, inner_places, name in _escapes(text):
            if inner and inner != text[start:end]:
                if self._is_new(places.span(start, end), inner.encode("utf-8", "surrogatepass")):
                    mapped = _Escapes(places, start, inner_places)
                    self.work.append(
                        _Layer(inner, mapped, way + name, set(found), layer.of_line)
                    )
        for start, end, raw, name in _escaped_bytes(text):
            place = places.span(start, end)
            if self._is_new(place, raw):
                self.work.append(self._blocks_of(raw, place, f"{way}{name}+packed", layer.of_line))
        for start, piece, is_line in _base64_pieces(text):
            place = places.span(start, start + len(piece))
            for shift, raw in _base64_bytes(piece):
                around = places, start, piece, shift
                self._bytes(raw, place, f"{way}base64", around, layer.of_line or is_line)

    def _bytes(self, raw, place, way, around=None, of_line=False, whole=True) -> None:
        """Layers of some bytes; ``around`` says where they are decoded from."""
        if not whole:
            self.deeper.add((place[0], "oversized", place[1]))
        texts = [found for found in _texts(raw) if _may_have(found[0])]
        packed = _PACKED.search(raw)
        if not (texts or packed) or not self._is_new(place, raw):
            return
        for text, bounds, name in texts:
            mapped = _Decoded(*around, bounds) if around else _Fixed(*place)
            self.work.append(
                _Layer(text, mapped, f"{way}+{name}" if name else way, of_line=of_line)
            )
        if packed:
            self.work.append(self._blocks_of(raw, place, f"{way}+packed", of_line))

    def _blocks_of(self, raw: bytes, place, way: str, of_line: bool):
        """Arguments of ``_bytes`` for all that is unpacked from some bytes, made on demand."""
        return ((block, place, way, None, of_line, whole) for block, whole in _unpacked(raw))


def all_spans(text: str) -> tuple[list, list]:
    """Base spans and spans found in layers, each ``(start, kind, end)`` in the text.

    The kind of a span from a layer is followed by ``@`` and the way to it, such as
    ``assign@url+base64``.
    """
    scan = _Scan(text)
    return scan.base, scan.run()


def _order(span) -> tuple:
    start, kind, end = span
    plain = kind.partition("@")[0]
    rank = KINDS.index(plain) if plain in KINDS else len(KINDS)
    return start, rank, kind, end


def joined(spans) -> str:
    return ",".join(f"{kind}:{start}:{end}" for start, kind, end in sorted(spans, key=_order))


RESULT = {
    "n_assign": "long",
    "n_access": "long",
    "n_hex": "long",
    "base_sha256": "string",
    "spans": "string",
}


def _scan(batches):
    for batch in batches:
        rows = {name: [] for name in RESULT}
        for value in batch.column("text"):
            base, deeper = all_spans(value.as_py() or "")
            for kind in KINDS:
                rows[f"n_{kind}"].append(sum(1 for span in base if span[1] == kind))
            rows["base_sha256"].append(hashlib.sha256(joined(base).encode()).hexdigest())
            rows["spans"].append(joined(base + deeper))
        columns = {name: batch.column(name) for name in batch.schema.names}
        for name, kind in RESULT.items():
            columns[name] = pa.array(rows[name], pa.int64() if kind == "long" else pa.string())
        yield pa.RecordBatch.from_pydict(columns)


def scan_secrets(documents: DataFrame) -> DataFrame:
    """``documents`` with counts of base secrets, their digest and all spans.

    ``spans`` lists ``kind:start:end`` in code points of the text, end exclusive.
    """
    base, show = hide(documents, "text")
    return show(base.mapInArrow(_scan, with_fields(base.schema, RESULT)), *RESULT)
