"""Benchmark decontamination: windows of benchmark words are hashed and broadcast, documents are scanned for them.

A text's words are the runs of letters, digits and non-ASCII characters after A-Z became a-z. A window is ``size``
consecutive words of an item; an item of fewer words, but not none, is one window. A document word is hit if it lies
inside an occurrence of a window; hash hits are verified against the window's words.

The window set is broadcast in blocks of at most ``block_windows`` windows, so its memory is bounded for a benchmark of
any size; more than one block means one narrow pass over the documents for each, with what was found so far written to
the shared folder between passes. Documents are never shuffled.

Edge cases: null and wordless texts have no words and are never contaminated; wordless items and items without an id
have no window; repeated items count once by id, whatever their texts; repeated documents are scanned each for itself;
an empty benchmark hits nothing. Extra columns are kept, and the columns added here replace columns of the same name.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from samplecraft.llm.common import ALNUM, find_words, lower_ascii, materialise, slices, span_hashes, text_bytes, window_hashes

WINDOW = 13
BLOCK_WINDOWS = 500_000
#: Contaminated: this part of a document's words, or more, is hit.
LEAST_SHARE = 1 / 20

_SPANS = T.ArrayType(T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType())]))
ADDED = {"n_words": T.LongType(), "hit_words": _SPANS, "hit_items": T.ArrayType(T.LongType())}


class WindowSet:
    """Windows of some items by window length, for lookup by hash and verification by words."""

    def __init__(self, items: list[tuple[int, bytes]], size: int):
        self.by_size: dict[int, dict[int, list[tuple[bytes, set[int]]]]] = {}
        for item, text in items:
            data = lower_ascii(np.frombuffer(text, np.uint8))
            first, last, _ = find_words(data, np.array([0, len(data)]), ALNUM)
            if not len(first):
                continue
            length = min(size, len(first))
            raw = data.tobytes()
            words = [raw[a:b] for a, b in zip(first.tolist(), last.tolist(), strict=True)]
            table = self.by_size.setdefault(length, {})
            for k, h in enumerate(window_hashes(span_hashes(data, first, last), length).tolist()):
                key, same = b" ".join(words[k : k + length]), table.setdefault(h, [])
                for text_of, ids in same:
                    if text_of == key:
                        ids.add(item)
                        break
                else:
                    same.append((key, {item}))
        self.sorted = {n: np.sort(np.fromiter(t, np.uint64, len(t))) for n, t in self.by_size.items()}
        self.bits = {}
        for n, hashes in self.sorted.items():
            bits = np.zeros(1 << 22, bool)
            bits[hashes & np.uint64((1 << 22) - 1)] = True
            self.bits[n] = bits

    def hits(self, raw: bytes, first: np.ndarray, last: np.ndarray, words: np.ndarray) -> Iterator[tuple[int, int, set[int]]]:
        """(word index, window length, items) of each verified occurrence; ``words`` are the hashes of the words."""
        for n, hashes in self.sorted.items():
            found = window_hashes(words, n)
            at = np.flatnonzero(self.bits[n][found & np.uint64((1 << 22) - 1)])
            at = at[hashes[np.minimum(np.searchsorted(hashes, found[at]), len(hashes) - 1)] == found[at]]
            for k in at.tolist():
                key = b" ".join(raw[a:b] for a, b in zip(first[k : k + n].tolist(), last[k : k + n].tolist(), strict=True))
                for text, ids in self.by_size[n][int(found[k])]:
                    if text == key:
                        yield k, n, ids


def _merge(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def _scan_rows(batch: pa.RecordBatch, column: str, windows: WindowSet) -> tuple[list[int], list[list], list[list]]:
    """Of each row: number of words, hit spans of words, items found."""
    data, offsets = text_bytes(batch.column(batch.schema.get_field_index(column)))
    data = lower_ascii(data)
    first, last, before = find_words(data, offsets, ALNUM)
    spans: list[list] = [[] for _ in range(batch.num_rows)]
    items: list[set[int]] = [set() for _ in range(batch.num_rows)]
    raw = data.tobytes()
    for k, n, ids in windows.hits(raw, first, last, span_hashes(data, first, last)):
        row = int(np.searchsorted(before, k, side="right")) - 1
        if k + n <= before[row + 1]:  # else it runs on into the next row
            base = int(before[row])
            spans[row].append((k - base, k - base + n))
            items[row] |= ids
    return np.diff(before).tolist(), [_merge(s) for s in spans], [sorted(i) for i in items]


def _blocks(items: DataFrame, id_column: str, column: str, size: int, block_windows: int) -> list[DataFrame]:
    """The items in parts of about ``block_windows`` windows at most; the number of words bounds that of windows."""
    items = items.select(F.col(id_column).cast("long").alias("item"), F.col(column).alias("text")).where("item is not null and text is not null")
    total = items.agg(F.sum(F.length("text"))).first()[0] or 0
    parts = int(total // 2 // block_windows) + 1  # a word and its separator take two characters at least
    part = F.pmod(F.xxhash64("item", "text"), F.lit(parts))
    return [items.where(part == k) for k in range(parts)]


def scan(
    docs: DataFrame,
    items: DataFrame,
    column: str = "text",
    id_column: str = "item_id",
    item_column: str = "text",
    size: int = WINDOW,
    block_windows: int = BLOCK_WINDOWS,
) -> DataFrame:
    """``docs`` with ``n_words``, ``hit_words`` (disjoint spans of word numbers, end exclusive) and ``hit_items``."""
    spark = docs.sparkSession
    out = docs.drop(*ADDED).select("*", F.lit(None).cast("long").alias("n_words"), F.lit(None).cast(_SPANS).alias("hit_words"), F.lit(None).cast("array<bigint>").alias("hit_items"))
    blocks = _blocks(items, id_column, item_column, size, block_windows)
    for k, block in enumerate(blocks):
        windows = spark.sparkContext.broadcast(
            WindowSet([(r["item"], r["text"].encode()) for r in block.distinct().collect()], size)
        )

        def run(batches: Iterator[pa.RecordBatch], windows=windows) -> Iterator[pa.RecordBatch]:
            for batch in slices(batches, column):
                n, spans, items = _scan_rows(batch, column, windows.value)
                before = [batch.column(batch.schema.get_field_index(c)).to_pylist() for c in ("hit_words", "hit_items")]
                spans = [_merge([(x["start"], x["end"]) for x in old or ()] + new) for old, new in zip(before[0], spans, strict=True)]
                items = [sorted({*(old or ()), *new}) for old, new in zip(before[1], items, strict=True)]
                span_type = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
                yield pa.RecordBatch.from_arrays(
                    [
                        *batch.columns[:-3],
                        pa.array(n, pa.int64()),
                        pa.array([[{"start": a, "end": b} for a, b in s] for s in spans], span_type),
                        pa.array(items, pa.list_(pa.int64())),
                    ],
                    names=[*batch.schema.names[:-3], *ADDED],
                )

        out = out.mapInArrow(run, out.schema)
        if k + 1 < len(blocks):
            out = materialise(out)
    return out


def n_hit() -> F.Column:
    return F.aggregate("hit_words", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])


def contaminated(least_share: float = LEAST_SHARE) -> F.Column:
    """Compared in whole numbers: hit * (1 / share) >= words."""
    return (n_hit() > 0) & (n_hit() * F.lit(round(1 / least_share)) >= F.col("n_words"))


def remove_documents(docs: DataFrame, items: DataFrame, **options) -> DataFrame:
    """The documents that are not contaminated, with their columns."""
    found = scan(_renamed(docs), items, **options)
    return _restored(found.where(~contaminated()), docs)


def remove_spans(docs: DataFrame, items: DataFrame, column: str = "text", **options) -> DataFrame:
    """All documents; every hit word is cut out together with what stands between hit words of one span."""
    found = scan(_renamed(docs), items, column=column, **options)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, column):
            at = batch.schema.get_field_index(column)
            data, offsets = text_bytes(batch.column(at))
            first, last, before = find_words(lower_ascii(data), offsets, ALNUM)
            raw, out = data.tobytes(), []
            rows = zip(batch.column(at).to_pylist(), batch.column(batch.schema.get_field_index("hit_words")).to_pylist(), strict=True)
            for k, (text, spans) in enumerate(rows):
                if spans:
                    kept, upto = [], int(offsets[k])
                    for s in spans:
                        kept.append(raw[upto : first[before[k] + s["start"]]])
                        upto = int(last[before[k] + s["end"] - 1])
                    text = b"".join([*kept, raw[upto : offsets[k + 1]]]).decode()
                out.append(text)
            yield batch.set_column(at, batch.schema.field(at), pa.array(out, batch.schema.field(at).type))

    return _restored(found.mapInArrow(run, found.schema), docs)


def _renamed(docs: DataFrame) -> DataFrame:
    """Own columns whose names are added here step aside."""
    return docs.withColumnsRenamed({c: f"__own_{c}" for c in docs.columns if c in ADDED})


def _restored(found: DataFrame, docs: DataFrame) -> DataFrame:
    return found.select(*[F.col(f"`__own_{c}`").alias(c) if c in ADDED else F.col(f"`{c}`") for c in docs.columns])
