"""Secrets behind marks that are none, long streams, several members, marks inside a layer, and base64 over lines."""

import base64
import gzip
import textwrap
import zlib
from urllib.parse import quote_from_bytes

import pytest

from samplecraft.llm import secrets

INNER = b"password=correcthorsebattery"


def kinds(text: bytes) -> list[int]:
    return [kind for _, kind, _ in secrets.all_matches(text)]


@pytest.mark.parametrize("head", [b"x^2 + y^2 ", b"x\x01 "])
def test_text_that_begins_like_compressed_data(head):
    for hidden in (base64.b64encode(INNER), b"".join(b"%%%02x" % c for c in INNER)):
        assert kinds(head + hidden + b" end") == [0]


def test_long_streams(monkeypatch):
    monkeypatch.setattr(secrets, "MOST_BYTES", 1 << 20)
    for fill in (b"some words. ", b"z "):
        body = fill * (3_000_000 // len(fill))
        for text in (INNER + b" " + body, body + INNER, body[: 1 << 20][:-10] + b" " + INNER + b" " + body):
            assert 0 in kinds(base64.b64encode(gzip.compress(text)))
    wrapped = b"\n".join(x.encode() for x in textwrap.wrap(base64.b64encode(b"many words " * 20_000 + INNER).decode(), 76))
    assert 0 in kinds(base64.b64encode(gzip.compress(b"some words. " * 200_000 + wrapped)))
    inside = gzip.compress(b"more words. " * 100_000 + INNER)
    assert 0 in kinds(base64.b64encode(gzip.compress(b"words, words " * 80_650 + inside + b" tail " * 300_000)))


def test_members_and_places():
    two = gzip.compress(b"nothing here") + gzip.compress(INNER)
    assert kinds(base64.b64encode(two)) == [0]
    assert kinds(base64.b64encode(gzip.compress(INNER[:12]) + gzip.compress(INNER[12:]))) == [0]
    for packed in (gzip.compress(INNER), zlib.compress(INNER)):
        assert kinds(base64.b64encode(b"\x00\xffhead" + packed + b"\xfe tail")) == [0]
        text = b"before " + quote_from_bytes(packed, safe="").encode() + b" after"
        ((a, kind, b),) = secrets.all_matches(text)
        assert (kind, text[:a], text[b:]) == (0, b"before ", b" after")
        assert kinds(b"see " + "".join(f"\\u{c:04x}" for c in packed).encode()) == [0]


@pytest.mark.parametrize("gap", [b"\n", b"\r\n", b"\n  ", b"\\n"])
@pytest.mark.parametrize("width", [17, 64, 76])
def test_base64_over_lines(gap, width):
    text = b"words before it, " * 9 + INNER + b" words after it" * 9
    for packed in (text, gzip.compress(text + bytes(range(256)) * 3)):
        lines = [x.encode() for x in textwrap.wrap(base64.b64encode(packed).decode(), width)]
        for tail in (b" end", gap + b"Following text goes on"):
            found = secrets.all_matches(b"File:" + gap + gap.join(lines) + tail)
            assert 0 in [kind for _, kind, _ in found], (tail, packed)
            assert all(5 <= a < b <= 5 + len(gap) + len(gap.join(lines)) + len(tail) for a, _, b in found)


def test_span_of_a_long_stream(monkeypatch):
    monkeypatch.setattr(secrets, "MOST_BYTES", 1 << 20)
    packed = gzip.compress(INNER + b" some words." * 300_000)
    text = b"a " + b"".join(b"%%%02X" % c for c in packed) + b" b"
    assert (2, 0, len(text) - 2) in secrets.all_matches(text)
