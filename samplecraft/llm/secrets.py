"""Secret scans with a worklist of decoded layers.

Three kinds, leftmost and non-overlapping each: ``assign`` (a keyword, `:` or `=`, a value of 12 characters or more),
``access`` (`AKIA` and capitals or digits, 18 in all or more), ``hex`` (16 or more of `0-9a-f`).

The text is the first layer. A layer is scanned, and what can be decoded in it is put on the worklist as further layers:
percent escapes (four and more levels at once), Unicode escapes (each for the layer as a whole), runs of base64 at all
four alignments that decode to text, to text of two-byte letters, to bytes with a finding or to compressed data (with
or without a head), base64 over several lines, and compressed data at any place, all members. This goes on until nothing
new comes; a layer equal to an earlier one of the same place is a cycle and not entered again. Every byte of a layer
knows the span of the text it stems from, so a finding maps to the text by its first and last byte: exactly through
escapes, to groups of four characters through base64, and to the whole run through compression. A compressed run that
opens to more than ``MOST_BYTES`` is scanned to its end in windows of about that size, one at a time; a window begins
again with what may go on beyond the end of the one before.

Documents are scanned where they are: one pass, no shuffle. Whole batches are first searched for keywords, hex runs and
possible encodings; only documents with one of them are looked at by themselves.

Edge cases: null and empty texts have no findings; the scan is of bytes, so letters outside ASCII never match; repeated
rows are scanned each; findings of several layers with equal kind and span count once; extra columns are kept, and the
columns added here replace columns of the same name.
"""

from __future__ import annotations

import base64
import bz2
import hashlib
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from samplecraft.llm.common import byte_class, find_words, lower_ascii, slices, text_bytes

KINDS = ("assign", "access", "hex")
MOST_BYTES = 64 << 20

_ASSIGN = re.compile(rb"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE)
_ACCESS = re.compile(rb"AKIA[A-Z0-9]+")
_HEX = re.compile(rb"[0-9a-f]+")
_KEYWORDS = (b"password", b"passwd", b"secret", b"token", b"apikey", b"api_key")
_HEX_BYTES = byte_class((48, 57), (97, 102))

_PERCENT = re.compile(rb"%([0-9A-Fa-f]{2})")
_DEEP = re.compile(rb"%(?:25){4}")
_NESTED = re.compile(rb"%(?:25)*([0-9A-Fa-f]{2})")
_UNICODE = re.compile(rb"\\u([0-9A-Fa-f]{4})(?:(?<=\\u[Dd][89ABab]..)\\u([Dd][C-Fc-f][0-9A-Fa-f]{2}))?")
_BASE64 = re.compile(rb"[A-Za-z0-9+/_-]{16,}={0,2}")
_BASE64_BYTES = byte_class((48, 57), (65, 90), (97, 122), (43, 43), (45, 45), (47, 47), (95, 95))
_LINES = re.compile(
    rb"(?:(?<=\\[nrt])|(?<![A-Za-z0-9+/_\\-]))[A-Za-z0-9+/_-]{16,}+(?:[\x20\t]*+(?:\r?\n|(?:\\r)?\\n)[\x20\t]*+[A-Za-z0-9+/_-]++)++={0,2}"
)
_LINE = re.compile(rb"(?<!\\)[A-Za-z0-9+/_-]+|(?<=\\n)[A-Za-z0-9+/_-]+")
_COMPRESSED = re.compile(rb"\x1f\x8b\x08|\x78[\x01\x5e\x9c\xda]")
_RUN_BYTES = byte_class((48, 57), (65, 90), (97, 122), *((c, c) for c in b"+-/_=%\\\r\n\t"))
_OVERLAP = 1 << 16


@dataclass
class Layer:
    """Decoded bytes, and for each the span of the text (in bytes) that it stems from; no spans: the text itself."""

    data: bytes
    start: np.ndarray | None = None
    end: np.ndarray | None = None

    def span(self, a: int, b: int) -> tuple[int, int]:
        return (a, b) if self.start is None else (int(self.start[a : b].min()), int(self.end[a : b].max()))

    def spans(self) -> tuple[np.ndarray, np.ndarray]:
        if self.start is None:
            at = np.arange(len(self.data))
            return at, at + 1
        return self.start, self.end


def base_matches(data: bytes) -> list[tuple[int, int, int]]:
    """(start, kind, end) by kind."""
    out = [(m.start(), 0, m.end()) for m in _ASSIGN.finditer(data) if m.end(2) - m.start(2) >= 12]
    out += [(m.start(), 1, m.end()) for m in _ACCESS.finditer(data) if m.end() - m.start() >= 18]
    out += [(m.start(), 2, m.end()) for m in _HEX.finditer(data) if m.end() - m.start() >= 16]
    return out


def _even(data: bytes, a: int, b: int) -> Layer:
    """A layer all of whose bytes stem from one span."""
    return Layer(data, np.broadcast_to(np.int64(a), len(data)), np.broadcast_to(np.int64(b), len(data)))


def _replaced(layer: Layer, found: Iterator[re.Match], value) -> Layer | None:
    """The layer with each match replaced by ``value(match)``, all of whose bytes stem from the match."""
    start, end = layer.spans()
    even = layer.start is not None and not start.strides[0]
    parts, starts, ends, upto = [], [], [], 0
    for m in found:
        new = value(m)
        a, b = m.span()
        parts += [layer.data[upto:a], new]
        if not even:
            starts += [start[upto:a], np.full(len(new), start[a:b].min())]
            ends += [end[upto:a], np.full(len(new), end[a:b].max())]
        upto = b
    if not parts:
        return None
    data = b"".join([*parts, layer.data[upto:]])
    if even:
        return _even(data, int(start[0]), int(end[0]))
    return Layer(data, np.concatenate([*starts, start[upto:]]), np.concatenate([*ends, end[upto:]]))


def _code_point(m: re.Match) -> bytes:
    code = int(m[1], 16)
    if m[2]:
        code = 0x10000 + ((code - 0xD800) << 10) + int(m[2], 16) - 0xDC00
    return chr(code).encode("utf-8", "replace")


def _byte(m: re.Match) -> bytes:
    code = int(m[1], 16)
    return bytes([code]) if code < 256 and not m[2] else _code_point(m)


class _Opening:
    """Compressed data from ``at`` on: its pieces, then its ``end`` and whether it was complete."""

    def __init__(self, data: bytes, at: int):
        self.data, self.at, self.end, self.complete = data, at, at, False

    def _member(self, at: int) -> Iterator[bytes]:
        stream = zlib.decompressobj(47)
        size = 256
        while at < len(self.data) and not stream.eof:
            rest = self.data[at : at + size]
            at, size = at + len(rest), 1 << 16
            while True:
                out = stream.decompress(rest, 1 << 20)
                rest = stream.unconsumed_tail
                if out:
                    yield out
                if stream.eof or (not rest and len(out) < 1 << 20):
                    break
        self.end, self.complete = at - len(stream.unused_data), stream.eof

    def pieces(self) -> Iterator[bytes]:
        """Of all members; an error in the first is raised, a later one that cannot be opened ends the data before it."""
        yield from self._member(self.at)
        while self.complete and self.data.startswith(b"\x1f\x8b\x08", self.end):
            before = self.end
            try:
                yield from self._member(self.end)
            except zlib.error:
                self.end = before
                return

    def _last(self) -> int:
        """The end, found without keeping the data."""
        ahead = _Opening(self.data, self.at)
        try:
            for _ in ahead.pieces():
                pass
        except zlib.error:
            return len(self.data)
        return ahead.end

    def windows(self) -> Iterator[bytes]:
        """All the data if it is short, else windows that overlap; nothing if it cannot be opened."""
        kept, size, first = [], 0, True
        try:
            for piece in self.pieces():
                kept.append(piece)
                size += len(piece)
                if size >= MOST_BYTES:
                    window = b"".join(kept)
                    if first:
                        self.end = self._last()
                    yield window
                    kept, first = [window[_open_from(window) :]], False
                    # What is carried on grows with the run it holds; the next window has as much again that is new.
                    size = min(len(kept[0]), MOST_BYTES - len(kept[0]))
        except zlib.error:
            if first:
                return
        if kept and any(kept):
            yield b"".join(kept)


def _open_from(window: bytes) -> int:
    """Where that begins which may go on beyond the window: compressed data, base64 over lines, the last bytes."""
    at = max(0, len(window) - _OVERLAP)
    stop = len(window)
    while stop > 0:  # whole lines of base64, from the last one back
        line = window.rfind(b"\n", 0, stop) + 1
        body = window[line:stop].strip(b"\x20\t\r")
        other = np.flatnonzero(~_RUN_BYTES[np.frombuffer(body, np.uint8)].astype(bool))
        if len(other):
            at = min(at, window.index(body, line) + int(other[-1]) + 1)
            break
        at, stop = min(at, line), line - 1
        if not body:
            break
    for _ in range(2):  # spaces of any length may stand on both sides of the sign between keyword and value
        if at > 0 and window[at - 1] == 32:
            at = max(0, len(window[:at].rstrip(b"\x20")) - 16)
    for m in _COMPRESSED.finditer(window):
        if m.start() >= at:
            break
        opening = _Opening(window, m.start())
        try:
            for _ in opening.pieces():
                pass
        except zlib.error:
            continue
        if not opening.complete:
            return m.start()
    return at


def _opens(data: bytes) -> bool:
    """Whether there is compressed data in it."""
    return any(next(_Opening(data, m.start()).windows(), b"") for m in _COMPRESSED.finditer(data))


def _is_text(data: bytes) -> bool:
    try:
        text = data.decode()
    except UnicodeDecodeError:
        return False
    return bool(text) and sum(c.isprintable() or c in "\t\r\n" for c in text) >= 0.95 * len(text)


def _plain(raw: bytes) -> bytes | None:
    """Decoded base64 if it is text or has compressed data."""
    plain = _unpacked(raw)
    return plain if _is_text(plain) or _opens(plain) else None


def _unpacked(raw: bytes) -> bytes:
    """Decoded base64 of either alphabet."""
    raw = raw.rstrip(b"=").replace(b"-", b"+").replace(b"_", b"/")
    if len(raw) % 4 == 1:
        raw = raw[:-1]
    return base64.b64decode(raw + b"=" * (-len(raw) % 4))


_BZIP2 = re.compile(rb"BZh[1-9]1AY&SY")


def _heads(raw: bytes) -> list[int]:
    """Where a bzip2 stream, or a zlib stream of any window, may begin."""
    a = np.frombuffer(raw, np.uint8).astype(np.int32)
    zlib_heads = np.flatnonzero((a[:-1] & 15 == 8) & (a[:-1] < 128) & ((a[:-1] * 256 + a[1:]) % 31 == 0))
    return [m.start() for m in _BZIP2.finditer(raw)] + zlib_heads.tolist()


def _after_slashes(run: bytes) -> Iterator[int]:
    at = run.find(b"/") + 1
    while at:
        yield at
        at = run.find(b"/", at) + 1


def _inflated(raw: bytes, at: int) -> bytes:
    """A deflate stream without a head, a zlib stream or a bzip2 stream that fills the data from a place on and opens to text."""
    rest = memoryview(raw)[at:]
    for stream in (zlib.decompressobj(-15), zlib.decompressobj(), *([bz2.BZ2Decompressor()] if rest[:3] == b"BZh" else [])):
        try:
            out = stream.decompress(rest, MOST_BYTES)
        except (zlib.error, OSError, ValueError, EOFError):
            continue
        if stream.eof and len(stream.unused_data) < 3 and _is_text(out):
            return out
    return b""


def _joined(data: bytes) -> Iterator[list[tuple[int, int]]]:
    """Lines of base64 that may be one run: all that follow each other, and lines of equal length with a shorter one
    before or after them or without."""
    for m in _LINES.finditer(data):
        lines = [x.span() for x in _LINE.finditer(data, m.start(), m.end())]
        n = [b - a for a, b in lines]
        tried = {(0, len(lines))}
        i = 0
        while i < len(lines):
            j = i + 1
            while j < len(lines) and n[j] == n[i]:
                j += 1
            if n[i] >= 16:
                tried |= {(a, b) for a in (i, max(0, i - 1)) for b in (j, min(len(lines), j + 1)) if b - a > 1}
            i = j
        yield from (lines[a:b] for a, b in sorted(tried) if b - a > 1)


def _decoded(layer: Layer) -> Iterator[Layer]:
    data = layer.data
    upto = 0
    for m in _COMPRESSED.finditer(data):
        if m.start() < upto:
            continue
        opening = _Opening(data, m.start())
        for opened in opening.windows():
            upto = max(upto, opening.end)
            yield _even(opened, *layer.span(m.start(), upto))
    if b"%" in data:
        # Escapes of escapes of escapes are undone at once: a layer for each level would copy all the rest each time.
        pattern = _NESTED if _DEEP.search(data) else _PERCENT
        if new := _replaced(layer, pattern.finditer(data), lambda m: bytes([int(m[1], 16)])):
            yield new
    if b"\\u" in data and (new := _replaced(layer, _UNICODE.finditer(data), _code_point)):
        yield new
        if (packed := _replaced(layer, _UNICODE.finditer(data), _byte)) and packed.data != new.data and _opens(packed.data):
            yield packed
    start, end = layer.spans() if layer.start is not None else (None, None)
    for m in _BASE64.finditer(data):
        # What stands before the run, as a path or a word, may be of base64 letters too: all four alignments are read.
        for shift in range(4):
            raw = _unpacked(m[0][shift:])
            plain = raw if raw and (_is_text(raw) or base_matches(raw) or _opens(raw)) else None
            kept = np.flatnonzero(np.frombuffer(raw, np.uint8)) if plain is None and raw.count(0) * 3 > len(raw) else None
            # a stream without a head begins where the run does, or after a slash in it
            begins = [0, *((x - shift) // 4 * 3 for x in _after_slashes(m[0]) if x > shift and (x - shift) % 4 == 0)] if plain is None and kept is None else []
            # bzip2 and zlib streams have one, and begin wherever that stands
            begins += _heads(raw) if begins else []
            inflated = next(((b, out) for b in begins if (out := _inflated(raw, b))), None)
            if plain is None and kept is None and not inflated:
                continue
            if start is None:
                start, end = layer.spans()
            if inflated:
                yield _even(inflated[1], int(start[m.start() + shift + inflated[0] // 3 * 4]), int(end[m.end() - 1]))
                continue
            at = np.arange(len(raw)) if kept is None else kept  # of two-byte letters the ones that are not zero
            first = m.start() + shift + at // 3 * 4
            last = np.minimum(first + 4, m.end()) - 1
            yield Layer(plain if kept is None else raw.replace(b"\0", b""), start[first], end[last])
    for lines in _joined(data):
        plain = _plain(b"".join(data[a:b] for a, b in lines))
        if plain is None:
            continue
        if start is None:
            start, end = layer.spans()
        place = np.concatenate([np.arange(a, b) for a, b in lines])
        first = np.arange(len(plain)) // 3 * 4
        last = np.minimum(first + 4, len(place)) - 1
        yield Layer(plain, start[place[first]], end[place[last]])


def all_matches(data: bytes) -> list[tuple[int, int, int]]:
    """(start, kind, end) in the text, of the text and of all layers below it."""
    found, work, seen = set(), [iter([Layer(data)])], {(hashlib.sha256(data).digest(), 0, len(data))}
    while work:
        layer = next(work[-1], None)
        if layer is None:
            work.pop()
            continue
        if layer.start is not None:
            mark = (hashlib.sha256(layer.data).digest(), int(layer.start[0]), int(layer.end[-1])) if layer.data else ()
            if not layer.data or mark in seen:
                continue
            seen.add(mark)
        for a, kind, b in base_matches(layer.data):
            s, e = layer.span(a, b)
            found.add((s, kind, e))
        work.append(_decoded(layer))
    return sorted(found)


def _suspects(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Rows that may hold a finding or an encoded layer."""
    raw, low = data.tobytes(), lower_ascii(data).tobytes()
    at: list[int] = []
    for text, words in ((low, _KEYWORDS), (raw, (b"AKIA", b"\\u")), (raw, (b"\x1f\x8b", b"x\x01", b"x^"))):
        for w in words:
            k = text.find(w)
            while k >= 0:
                at.append(k)
                k = text.find(w, k + 1)
    for m in _PERCENT.finditer(raw):
        at.append(m.start())
    for table in (_HEX_BYTES, _BASE64_BYTES):
        first, last, _ = find_words(data, offsets, table)
        at += first[last - first >= 16].tolist()
    rows = np.zeros(len(offsets) - 1, bool)
    if at:
        rows[np.searchsorted(offsets, np.array(at), side="right") - 1] = True
    return rows


_FOUND = T.ArrayType(
    T.StructType([T.StructField("kind", T.StringType()), T.StructField("start", T.LongType()), T.StructField("end", T.LongType()), T.StructField("base", T.BooleanType())])
)


def scan(docs: DataFrame, column: str = "text") -> DataFrame:
    """``docs`` with ``secrets``: kind, start, end (code points) and whether the text itself shows it, in order of start,
    then kind as listed."""
    docs = docs.drop("secrets")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("base", pa.bool_())]))
        for batch in slices(batches, column):
            data, offsets = text_bytes(batch.column(batch.schema.get_field_index(column)))
            rows: list[list[dict]] = [[] for _ in range(batch.num_rows)]
            for k in np.flatnonzero(_suspects(data, offsets)) if len(data) else ():
                one = data[offsets[k] : offsets[k + 1]]
                text = one.tobytes()
                found = all_matches(text)
                if found:
                    base = set(base_matches(text))
                    points = np.concatenate([[0], np.cumsum((one & 0xC0) != 0x80)])
                    rows[k] = [{"kind": KINDS[f[1]], "start": int(points[f[0]]), "end": int(points[f[2]]), "base": f in base} for f in found]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(rows, kind)], names=[*batch.schema.names, "secrets"])

    schema = T.StructType([*docs.schema.fields, T.StructField("secrets", _FOUND)])
    return docs.mapInArrow(run, schema)
