"""Fill-in-the-middle transformation: a text is cut at two code points, and its parts are put into another order.

Where the cuts fall in the bytes is found in 64-bit words: the UTF-8 of a batch is viewed as uint64, a byte that is
followed by the first byte of a code point is marked, arithmetically, eight at once, and the marks of each word are
counted. A cut after k code points is searched in the cumulative counts, which gives the word; in the word the k-th mark is selected by
the product that sums its bytes and one comparison of eight bytes.

What a document becomes follows from the sha256 of ``seed``, a colon and the id's text: h1 to h4 are its first four groups of eight
hex digits. Cuts stand after h1 % (n + 1) and h2 % (n + 1) of n code points, the smaller first. The form is ``plain`` if the
text is empty, contains one of the sentinels, or h3 % 100 >= ``share``; else ``spm`` if h4 % 100 < ``spm_share``, else
``psm``. psm is P prefix S suffix M middle, spm is S suffix P prefix M middle, and ``restored`` gives back the exact text.

Edge cases: a null text counts as empty, a null id as the empty text in the hash; repeated rows keep their rows; bytes
that are no UTF-8 belong to the code point before them; a text of any length is one row of a batch and is cut whole, in
memory of a few times its size; an empty table gives an empty result; extra columns play no part.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from samplecraft.llm.common import U64, slices, text_bytes

SENTINELS = ("<P>", "<S>", "<M>")
SEED = 1
SHARE, SPM_SHARE = 90, 20

_LOW, _HIGH = U64(0x0101010101010101), U64(0x8080808080808080)


class Units:
    """Marks of the bytes that end a code point, with rank and select."""

    def __init__(self, data: np.ndarray) -> None:
        room = np.zeros((len(data) // 8 + 2) * 8, np.uint8)
        room[: len(data)] = data
        word = room.view("<u8").astype(U64, copy=False)
        # A continuation byte has bit 7 and not bit 6.
        begins = _LOW ^ ((word >> U64(7)) & ~(word >> U64(6)) & _LOW)
        self._marks = begins >> U64(8)
        self._marks[:-1] |= begins[1:] << U64(56)
        self._upto = np.cumsum(np.bitwise_count(self._marks), dtype=np.int64)

    def rank(self, place: np.ndarray) -> np.ndarray:
        """Marks before a byte."""
        word = place >> 3
        below = (U64(1) << ((place & 7) << 3).astype(U64)) - U64(1)
        full = np.where(word > 0, self._upto[word - 1], 0)
        return full + np.bitwise_count(self._marks[word] & below)

    def select(self, k: np.ndarray) -> np.ndarray:
        """The byte after the k-th mark (from 1)."""
        word = np.searchsorted(self._upto, k)
        left = k - np.where(word > 0, self._upto[word - 1], 0)
        sums = self._marks[word] * _LOW  # in each byte the marks up to it
        reached = ((sums | _HIGH) - left.astype(U64) * _LOW) & _HIGH
        return 8 * word + 8 - np.bitwise_count(reached).astype(np.int64) + 1


def cuts(data: np.ndarray, offsets: np.ndarray, h1: np.ndarray, h2: np.ndarray) -> tuple[np.ndarray, ...]:
    """Of each row: code points, those before either cut, and the bytes where the cuts stand."""
    units = Units(data)
    base = units.rank(offsets)
    n = np.diff(base)
    a, b = h1 % (n + 1), h2 % (n + 1)
    before, upto = np.minimum(a, b), np.maximum(a, b)
    places = []
    for k in (before, upto):
        at = offsets[:-1].copy()
        some = k > 0
        at[some] = units.select(base[:-1][some] + k[some])
        places.append(at)
    return n, before, upto, *places


def _draws(key: Column, seed: int) -> list[Column]:
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit(""))), 256)
    return [F.conv(F.substring(digest, 8 * k + 1, 8), 16, 10).cast("long").alias(f"h{k + 1}") for k in range(4)]


def transform(
    docs: DataFrame,
    column: str = "text",
    key: str = "doc_id",
    seed: int = SEED,
    share: int = SHARE,
    spm_share: int = SPM_SHARE,
    sentinels: tuple[str, str, str] = SENTINELS,
) -> DataFrame:
    """A row a document: key, ``n`` code points, ``form``, ``prefix_chars`` and ``middle_chars`` (null if plain) and
    ``output``."""
    marks = [s.encode() for s in sentinels]
    p, s, m = marks

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            data, offsets = text_bytes(batch.column(1))
            h1, h2, h3, h4 = (c.to_numpy() for c in batch.columns[2:])
            n, before, upto, *places = cuts(data, offsets, h1, h2)
            moved, suffix_first = h3 % 100 < share, h4 % 100 < spm_share
            raw, forms, texts = data.tobytes(), [], []
            for k, (a, x, y, b) in enumerate(zip(offsets[:-1].tolist(), *(c.tolist() for c in places), offsets[1:].tolist(), strict=True)):
                whole = raw[a:b]
                if not moved[k] or not whole or any(t in whole for t in marks):
                    forms.append("plain")
                    texts.append(whole)
                elif suffix_first[k]:
                    forms.append("spm")
                    texts.append(b"".join((s, raw[y:b], p, raw[a:x], m, raw[x:y])))
                else:
                    forms.append("psm")
                    texts.append(b"".join((p, raw[a:x], s, raw[y:b], m, raw[x:y])))
            plain = np.array([f == "plain" for f in forms], bool)
            columns = [batch.column(0), pa.array(n), pa.array(forms, pa.string()), pa.array(before, mask=plain), pa.array(upto - before, mask=plain)]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(texts, pa.binary()).cast(pa.string())], names=["id", "n", "form", "prefix_chars", "middle_chars", "output"])

    kind = docs.schema[key].dataType.simpleString()
    docs = docs.select(F.col(f"`{key}`").alias("id"), F.col(f"`{column}`").cast("string").alias("text"), *_draws(F.col(f"`{key}`"), seed))
    out = docs.mapInArrow(run, f"id {kind}, n long, form string, prefix_chars long, middle_chars long, output string")
    return out.withColumnRenamed("id", key)


def restored(output: str = "output", form: str = "form", sentinels: tuple[str, str, str] = SENTINELS) -> Column:
    """The text from its output and form. A text with sentinels stays plain, so each stands once in the others."""
    p, s, m = sentinels
    out = F.col(output)
    head, middle = F.substring_index(out, m, 1), F.substring_index(out, m, -1)

    def parts(first: str, second: str) -> tuple[Column, Column]:
        rest = F.substring(head, len(first) + 1, 2**31 - 1)
        return F.substring_index(rest, second, 1), F.substring_index(rest, second, -1)

    prefix, suffix = parts(p, s)
    psm = F.concat(prefix, middle, suffix)
    suffix, prefix = parts(s, p)
    return F.when(F.col(form) == "psm", psm).when(F.col(form) == "spm", F.concat(prefix, middle, suffix)).otherwise(out)
