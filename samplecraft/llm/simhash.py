"""SimHash near-duplicates: documents whose 64-bit fingerprints differ in at most two bits, by multi-index hashing.

A document's shingles are its runs of ``size`` words `[^\\x20\\x09-\\x0D]+` after A-Z became a-z, joined by one blank,
repeats included; fewer words, but not none, are one shingle. Each is hashed by XXH64 with ``seed``; a bit of the
fingerprint is 1 if more than half of the hashes have it. Bits are counted eight at a time in the bytes of 64-bit words.

1. Equal fingerprints become one node at once, by a grouping combined before the shuffle, so copies cost nothing further.
2. Fingerprints are cut into two segments of 32 bits. If two differ in at most two bits, then their high segments differ
   in at most one bit or their low ones are equal. So the table of high segments is probed with a Hamming ball of radius
   one around each of its values, that of the low ones with the value itself. Values, not fingerprints, are probed, from
   the smaller side only, so each pair of values is met once however many fingerprints stand behind it.
3. Values of at most ``BUCKET`` fingerprints deliver them as candidates, and the complete distance of each is verified.
4. Fingerprints behind larger values, and behind whatever such values met, are never paired. They enumerate the ball
   of radius one around the whole fingerprint instead, and all that share a point of it are linked to the smallest of
   them, verified likewise: two fingerprints at distance two or less share such a point, and no point is shared by more
   than 65. So the work stays in proportion to the fingerprints at any size of a segment's group, and no link is lost.

Components come from repeated large-star and small-star steps. Nothing is capped or sampled, nothing but whether links
are left comes back to the driver.

Edge cases: null, empty and wordless texts have fingerprint zero and link like any other; repeated rows keep their rows;
a null id never is the smallest of a component unless all its ids are null; texts beyond ``LONG`` bytes are hashed in
pieces that overlap by ``size - 1`` words; an empty table gives an empty result; extra columns play no part.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from samplecraft.llm.common import U64, UNSPACED, files_for, find_words, lower_ascii, materialise, slices, spaced, text_bytes
from samplecraft.llm.components import connected_components

SIZE = 3
SEED = 42
#: Bits in which linked fingerprints may differ; the steps above rest on this number.
DISTANCE = 2
#: Fingerprints behind one segment value that are compared with each other.
BUCKET = 16
#: Bytes of one text that are hashed at once.
LONG = 8 << 20

_EVERY_EIGHTH = U64(0x0101010101010101)


def _bit_counts(hashes: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """For each row of hashes, how many have each of the 64 bits."""
    n = np.diff(bounds)
    out = np.zeros((len(n), 64), np.int64)
    some = np.flatnonzero(n)
    if not len(some):
        return out
    # A byte counts to 255, so rows are cut into parts of as many hashes.
    parts = -(-n[some] // 255)
    before = np.cumsum(parts) - parts
    starts = np.repeat(bounds[some], parts) + 255 * (np.arange(parts.sum()) - np.repeat(before, parts))
    for shift in range(8):
        eight = np.add.reduceat((hashes >> U64(shift)) & _EVERY_EIGHTH, starts)
        out[some, shift::8] = np.add.reduceat(eight.astype("<u8").view(np.uint8).reshape(-1, 8).astype(np.int64), before, axis=0)
    return out


def _counts(data: np.ndarray, offsets: np.ndarray, size: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """Bit counts and numbers of shingles of each row."""
    first, last, before = find_words(data, offsets, UNSPACED)
    text, at = spaced(data, first, last)
    words = np.diff(before)
    n = np.where(words >= size, words - size + 1, words > 0)
    bounds = np.concatenate([[0], np.cumsum(n)])
    begin = np.arange(bounds[-1]) + np.repeat(before[:-1] - bounds[:-1], n)
    end = begin + np.repeat(np.minimum(words, size), n)
    raw, digest = text.tobytes(), xxhash.xxh64_intdigest
    hashes = [digest(raw[a:b], seed) for a, b in zip(at[begin].tolist(), (at[end] - 1).tolist(), strict=True)]
    return _bit_counts(np.array(hashes, U64), bounds), n


def _long_counts(data: np.ndarray, size: int, seed: int, most: int) -> tuple[np.ndarray, np.ndarray]:
    """The same of one long text, in pieces cut between words."""
    counts, n, at, held = np.zeros((1, 64), np.int64), np.zeros(1, np.int64), 0, np.zeros(0, np.uint8)
    while at < len(data):
        upto = min(at + most, len(data))
        while upto < len(data) and UNSPACED[data[upto]]:
            blank = np.flatnonzero(~UNSPACED[data[upto : upto + most]])
            upto = upto + int(blank[0]) if len(blank) else min(upto + most, len(data))
        piece, at = np.concatenate([held, data[at:upto]]), upto
        first, _, _ = find_words(piece, np.array([0, len(piece)]), UNSPACED)
        if len(first) < size and (n[0] or at < len(data)):
            held = piece
            continue
        more, k = _counts(piece, np.array([0, len(piece)]), size, seed)
        counts, n = counts + more, n + k
        held = piece[first[len(first) - size + 1] :] if size > 1 else held
    return counts, n


def fingerprints(docs: DataFrame, column: str = "text", key: str = "doc_id", size: int = SIZE, seed: int = SEED, long: int = LONG) -> DataFrame:
    """``id, fingerprint`` of each document; the fingerprint's bits as a signed long."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            data, offsets = text_bytes(batch.column(1))
            data = lower_ascii(data)
            one = batch.num_rows == 1 and len(data) > long
            counts, n = _long_counts(data, size, seed, long) if one else _counts(data, offsets, size, seed)
            bits = np.packbits(2 * counts > n[:, None], axis=1, bitorder="little")
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(bits.view("<i8").reshape(-1).astype(np.int64))], names=["id", "fingerprint"])

    docs = docs.select(F.col(key).cast("long").alias("id"), F.col(column).cast("string").alias("text"))
    return docs.mapInArrow(run, "id long, fingerprint long")


def _near(a: str, b: str) -> Column:
    return F.bit_count(F.col(a).bitwiseXOR(F.col(b))) <= DISTANCE


def _ball(value: Column, bits: int, low: int = 0) -> Column:
    """The values that differ from ``value`` in one of ``bits`` bits."""
    return F.transform(F.sequence(F.lit(low), F.lit(low + bits - 1)), lambda i: value.bitwiseXOR(F.call_function("shiftleft", F.lit(1).cast("long"), i)))


def links(prints: DataFrame, bucket: int = BUCKET, files: int | None = None) -> DataFrame:
    """``a, b``: links of distinct fingerprints (column ``fingerprint``) at distances up to two, or of both to a third."""
    f = F.col("fingerprint")
    cut = materialise(prints.select(f.alias("f"), F.shiftrightunsigned(f, 32).alias("high"), f.bitwiseAND(F.lit(0xFFFFFFFF)).alias("low")), files=files)
    high = cut.groupBy("high").agg(F.count("*").alias("c"))
    low = cut.groupBy("low").agg(F.count("*").alias("c"))

    # The smaller value of each pair probes.
    probes = high.select("high", "c", F.explode(F.filter(_ball(F.col("high"), 32), lambda v: v > F.col("high"))).alias("other"))
    hits = materialise(probes.join(high.select(F.col("high").alias("other"), F.col("c").alias("c_other")), "other"), files=files)
    heavy = F.greatest("c", "c_other") > bucket

    def within(value: str, few: DataFrame) -> DataFrame:
        """Pairs behind one value."""
        held = cut.join(few.where((F.col("c") > 1) & (F.col("c") <= bucket)).select(value), value).select(value, "f")
        return held.join(held.select(value, F.col("f").alias("g")), value).where("f < g").select(F.col("f").alias("a"), F.col("g").alias("b"))

    met = hits.where(~heavy).select("high", "other")
    across = cut.select("high", F.col("f").alias("a")).join(met, "high").join(cut.select(F.col("high").alias("other"), F.col("f").alias("b")), "other").select("a", "b")
    found = within("high", high).unionByName(within("low", low)).unionByName(across).where(_near("a", "b"))

    many = high.where(F.col("c") > bucket).select("high")
    many = many.unionByName(hits.where(heavy).select(F.explode(F.array("high", "other")).alias("high"))).distinct()
    crowd = cut.join(many, "high", "left_semi").select("f").unionByName(cut.join(low.where(F.col("c") > bucket), "low", "left_semi").select("f")).distinct()
    points = crowd.select("f", F.explode(F.concat(F.array("f"), _ball(F.col("f"), 64))).alias("point"))
    # At most 65 fingerprints are within one bit of a point.
    shared = points.groupBy("point").agg(F.collect_list("f").alias("all")).where(F.size("all") > 1)
    stars = shared.select(F.array_min("all").alias("a"), F.explode("all").alias("b")).where("a < b").where(_near("a", "b"))
    return found.unionByName(stars).distinct()


def classes(docs: DataFrame, column: str = "text", key: str = "doc_id", size: int = SIZE, seed: int = SEED, bucket: int = BUCKET) -> DataFrame:
    """A row a document: key, ``fingerprint`` (16 lowercase hex digits) and ``component_id``, the smallest id that links
    reach."""
    rows = materialise(fingerprints(docs, column, key, size, seed))
    files = files_for(rows.count())
    prints = materialise(rows.groupBy("fingerprint").agg(F.min("id").alias("least")), files=files)
    labels = connected_components(materialise(links(prints, bucket, files), files=files), "a", "b").withColumnRenamed("node", "fingerprint")
    named = prints.join(labels, "fingerprint", "left").withColumn("comp", F.coalesce("comp", "fingerprint"))
    named = named.join(named.groupBy("comp").agg(F.min("least").alias("component_id")), "comp").select("fingerprint", "component_id")
    shown = F.lpad(F.lower(F.hex("fingerprint")), 16, "0").alias("fingerprint")
    return rows.join(named, "fingerprint").select(F.col("id").alias(key), shown, "component_id")
