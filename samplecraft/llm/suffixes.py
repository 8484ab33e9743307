"""Exact removal of repeated byte strings, by suffix arrays built one bucket at a time with a difference cover.

Every byte covered by a string of ``LENGTH`` bytes that also starts anywhere else, in the same text or another, is
removed. Strings never cross texts and are judged on the input.

Sorting all suffixes of a large corpus is needless, as most have no partner. So they are dealt into buckets first:

1. The anchor of a window of ``LENGTH`` bytes is the first place of the smallest hash among its strings of ``GRAM`` bytes.
   Equal windows have equal anchors at equal places, so only windows of an anchor string seen twice can be repeated.
   Consecutive windows share their anchor: a run. The bytes of a run are its context. Runs with equal contexts are
   repeated as a whole, and need no sorting.
2. Of anchors with several contexts, each different context is cut at fixed distances from the anchor into pieces of at
   most ``PIECE`` windows. A bucket holds the pieces of one anchor and distance with the same common bytes. Buckets with
   one piece end here, pieces equal as a whole are repeated; a bucket of more than ``MOST_PIECES`` pieces is cut again,
   into pieces of half as many windows with more common bytes, down to single windows, which are equal or apart.
3. The suffixes of a bucket are sorted in one task: by their first ``PERIOD`` bytes, long ties by ranks of the sample of
   suffixes at places of a difference cover modulo ``PERIOD``, which are computed first, by doubling. Any two places are
   at most ``PERIOD`` - 1 bytes before places that are both in the sample, so a rank settles every tie. A suffix is
   repeated if it has ``LENGTH`` bytes in common with a neighbour in this order.

Memory is bounded by a bucket and, for texts, by one text. Equal texts are one text with a count; counts and smallest
representatives are combined before each shuffle; links between rows go through tables, never through the driver.

Edge cases: null texts are empty; texts of fewer than ``LENGTH`` bytes lose nothing and cost nothing; equal texts of
that length or more are removed whole; repeated rows and ids are documents of their own; an empty table gives an empty
result; extra columns play no part.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import cmp_to_key

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from samplecraft.llm.common import _BYTE, _powers, U64, materialise, mix, ragged, slices, span_hashes, text_bytes

LENGTH = 200
GRAM = 48
PIECE = 32
MOST_PIECES = 256
# A difference cover modulo 31, in which every residue is the difference of two members.
PERIOD = 31
COVER = (0, 1, 3, 8, 12, 18)
#: Bits of a window's smallest value that hold its place.
_PLACE = 28


def shift_table() -> np.ndarray:
    """For two residues modulo ``PERIOD`` the least shift that takes both into the cover."""
    flag = np.zeros(PERIOD, bool)
    flag[list(COVER)] = True
    at = np.arange(PERIOD)
    moved = flag[(at[:, None] + at[None]) % PERIOD]  # residue, shift
    return (moved[:, None] & moved[None]).argmax(axis=2)


def runs(data: np.ndarray, offsets: np.ndarray, length: int, gram: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Runs of windows with one anchor: first and last window start, anchor place, and row."""
    none = np.zeros(0, np.int64)
    if len(data) < length:
        return none, none, none, none
    n = len(data) - gram + 1
    up, down = _powers(len(data) + 1)
    sums = np.empty(len(data) + 1, U64)
    sums[0] = 0
    np.cumsum(_BYTE[data] * up[: len(data)], dtype=U64, out=sums[1:])
    value = mix((sums[gram:] - sums[:-gram]) * down[:n])
    value >>= U64(_PLACE)
    value <<= U64(_PLACE)
    value |= np.arange(n, dtype=U64)
    # Smallest value of each ``wide`` consecutive ones, by running minima of blocks from both sides.
    wide = length - gram + 1
    blocks = -(-n // wide) + 1
    padded = np.full(blocks * wide, ~U64(0))
    padded[:n] = value
    square = padded.reshape(blocks, wide)
    forward = np.minimum.accumulate(square, axis=1).ravel()
    backward = np.minimum.accumulate(square[:, ::-1], axis=1)[:, ::-1].ravel()
    count = len(data) - length + 1
    anchor = (np.minimum(backward[:count], forward[wide - 1 : wide - 1 + count]) & U64((1 << _PLACE) - 1)).astype(np.int64)
    row = np.searchsorted(offsets, np.arange(count), side="right") - 1
    inside = np.arange(count) + length <= offsets[row + 1]
    starts = np.flatnonzero(inside)
    if not len(starts):
        return none, none, none, none
    a, r = anchor[starts], row[starts]
    new = np.ones(len(starts), bool)
    new[1:] = (a[1:] != a[:-1]) | (r[1:] != r[:-1])
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(starts)) - 1
    return starts[first], starts[last], a[first], r[first]


def _text_ids(data: np.ndarray, offsets: np.ndarray) -> list[tuple[int, int, bytes]]:
    """Of each row two halves of a 128-bit hash, and the SHA-256 digest."""
    raw = data.tobytes()
    out = []
    for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True):
        digest = hashlib.sha256(raw[a:b]).digest()
        out.append((int.from_bytes(digest[:8], "little", signed=True), int.from_bytes(digest[8:16], "little", signed=True), digest))
    return out


def _first_pass(docs: DataFrame, length: int, gram: int) -> DataFrame:
    """A row a document: ``id, t1, t2, n, sha``, and of its runs ``anchors`` and ``contexts`` (hashes)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", 1 << 20):
            data, offsets = text_bytes(batch.column(1))
            first, last, anchor, row = runs(data, offsets, length, gram)
            ids = _text_ids(data, offsets)
            anchors = span_hashes(data, anchor, anchor + gram)
            contexts = mix(span_hashes(data, first, last + length) + (anchor - first).astype(U64))
            bounds = np.searchsorted(row, np.arange(batch.num_rows + 1))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array([x[0] for x in ids], pa.int64()),
                    pa.array([x[1] for x in ids], pa.int64()),
                    pa.array(np.diff(offsets)),
                    pa.array([x[2] for x in ids], pa.binary()),
                    ragged(anchors.view(np.int64), bounds),
                    ragged(contexts.view(np.int64), bounds),
                ],
                names=["id", "t1", "t2", "n", "sha", "anchors", "contexts"],
            )

    return materialise(docs.mapInArrow(run, "id long, t1 long, t2 long, n long, sha binary, anchors array<bigint>, contexts array<bigint>"))


def _marked_runs(first: DataFrame) -> DataFrame:
    """``t1, t2, runs``: of each text its runs (number, repeated as a whole, to be cut into pieces)."""
    pairs = F.posexplode(F.arrays_zip("anchors", "contexts")).alias("run", "x")
    rows = first.where("size(anchors) > 0").select("t1", "t2", pairs).select("t1", "t2", "run", F.col("x.anchors").alias("a"), F.col("x.contexts").alias("c"))
    twice = rows.groupBy("a").agg(F.count("*").alias("seen")).where("seen > 1").select("a")
    # Dealt anew before the sums, so that the rows of a very common anchor may be split over tasks of the join.
    held = rows.join(twice, "a").repartition("a", "c", "t1", "t2", "run").groupBy("a", "c", "t1", "t2", "run").agg(F.count("*").alias("w"))
    held = materialise(held)
    contexts = held.groupBy("a", "c").agg(F.sum("w").alias("seen"), F.min(F.struct("t1", "t2", "run")).alias("one"))
    several = contexts.groupBy("a").agg(F.count("*").alias("contexts")).where("contexts > 1").select("a", F.lit(True).alias("several"))
    contexts = contexts.join(several, "a", "left").where("several or seen > 1").select("a", "c", (F.col("seen") > 1).alias("whole"), F.coalesce("several", F.lit(False)).alias("several"), "one")
    marked = held.join(contexts, ["a", "c"]).select(
        "t1", "t2", "run", "whole", (F.col("several") & (F.struct("t1", "t2", "run") == F.col("one"))).alias("cut")
    ).where("whole or cut")
    return marked.groupBy("t1", "t2").agg(F.collect_list(F.struct("run", "whole", "cut")).alias("runs"))


def _texts(docs: DataFrame, marked: DataFrame) -> DataFrame:
    """``t1, t2, text, runs`` of the texts with marked runs: the one step that moves texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            ids = _text_ids(*text_bytes(batch.column(1)))
            yield pa.RecordBatch.from_arrays([pa.array([x[0] for x in ids], pa.int64()), pa.array([x[1] for x in ids], pa.int64()), batch.column(1)], names=["t1", "t2", "text"])

    texts = docs.mapInArrow(run, "t1 long, t2 long, text string").groupBy("t1", "t2").agg(F.first("text").alias("text"))
    return materialise(texts.join(marked, ["t1", "t2"]))


_PIECES = "t1 long, t2 long, start long, far int, windows int, whole boolean, key long, piece long, bytes binary"
_PIECE_NAMES = [x.split()[0] for x in _PIECES.split(", ")]


def _cut(data: np.ndarray, place: np.ndarray, far: np.ndarray, near: np.ndarray, width: int, length: int, gram: int):
    """Cut windows that start ``far`` to ``near`` bytes before the anchor at ``place`` at multiples of ``width``.

    Returns for each piece: number of its context, ``far``, ``near``, key and hash of its bytes. The key is of the anchor
    and of the bytes that all windows of the block have in common, which every one of them holds.
    """
    parts = far // width - near // width + 1
    of = np.repeat(np.arange(len(far)), parts)
    block = (near // width)[of] + np.arange(len(of)) - np.repeat(np.cumsum(parts) - parts, parts)
    f, n, p = np.minimum(far[of], block * width + width - 1), np.maximum(near[of], block * width), place[of]
    core = span_hashes(data, p - block * width, p - block * width - width + 1 + length)
    key = mix(core + mix(span_hashes(data, p, p + gram) + block.astype(U64)))
    return of, f, n, key.view(np.int64), mix(span_hashes(data, p - f, p - n + length) + f.astype(U64)).view(np.int64)


def _piece_rows(raw: bytes, t1: pa.Array, t2: pa.Array, base: np.ndarray, place: np.ndarray, whole: np.ndarray, cut, length: int) -> pa.RecordBatch:
    """``t1``, ``t2``, ``place``, ``whole`` by context; ``base`` is where the text of the context would begin in ``raw``."""
    of, far, near, key, piece = cut
    first, end = place[of] - far, place[of] - near + length
    parts = [raw[a:b] for a, b in zip(first.tolist(), end.tolist(), strict=True)]
    take = pa.array(of)
    columns = [
        t1.take(take), t2.take(take), pa.array(first - base[of]), pa.array(far.astype(np.int32)), pa.array((far - near + 1).astype(np.int32)),
        pa.array(whole[of]), pa.array(key), pa.array(piece), pa.array(parts, pa.binary()),
    ]
    return pa.RecordBatch.from_arrays(columns, names=_PIECE_NAMES)


def _pieces(texts: DataFrame, length: int, gram: int, width: int) -> DataFrame:
    """The contexts marked to be cut, as pieces of up to ``width`` windows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", 1 << 20):
            data, offsets = text_bytes(batch.column(2))
            first, last, anchor, row = runs(data, offsets, length, gram)
            bounds = np.searchsorted(row, np.arange(batch.num_rows + 1))
            marked = [(int(bounds[k]) + m["run"], m["whole"]) for k, marks in enumerate(batch.column(3).to_pylist()) for m in marks if m["cut"]]
            if marked:
                at = np.array([m[0] for m in marked])
                place = anchor[at]
                cut = _cut(data, place, place - first[at], place - last[at], width, length, gram)
                take = pa.array(row[at])
                yield _piece_rows(data.tobytes(), batch.column(0).take(take), batch.column(1).take(take), offsets[row[at]], place, np.array([m[1] for m in marked], bool), cut, length)

    return texts.mapInArrow(run, _PIECES)


def _halved(pieces: DataFrame, length: int, gram: int, width: int) -> DataFrame:
    """Pieces cut again, into pieces of up to ``width`` windows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "bytes", 1 << 20):
            data, offsets = text_bytes(batch.column(8))
            start, far, windows, whole = (batch.column(k).to_numpy(zero_copy_only=False) for k in (2, 3, 4, 5))
            far = far.astype(np.int64)
            place = offsets[:-1] + far
            cut = _cut(data, place, far, far - windows + 1, width, length, gram)
            yield _piece_rows(data.tobytes(), batch.column(0), batch.column(1), offsets[:-1] - start, place, whole.astype(bool), cut, length)

    return pieces.mapInArrow(run, _PIECES)


def _words(data: np.ndarray) -> np.ndarray:
    """At each place the next eight bytes as a number that orders as they do; zeros follow the end."""
    padded = np.concatenate([data, np.zeros(8, np.uint8)]).astype(U64)
    out = np.zeros(len(data), U64)
    for k in range(8):
        out = (out << U64(8)) | padded[k : k + len(data)]
    return out


def sample_ranks(words: np.ndarray, depth: int) -> np.ndarray:
    """Rank of each place of the sample among its suffixes, to ``depth`` bytes at least; 0 at other places."""
    n = len(words)
    flag = np.zeros(PERIOD, bool)
    flag[list(COVER)] = True
    sample = np.flatnonzero(np.resize(flag, n))

    def after(values: np.ndarray, steps: int) -> np.ndarray:
        at = sample + steps
        return np.where(at < n, values[np.minimum(at, n - 1)], 0)

    keys = [after(words, k) for k in (0, 8, 16, 24)]
    order = np.lexsort(keys[::-1])
    new = np.zeros(len(order), bool)
    for k in keys:
        new[1:] |= k[order][1:] != k[order][:-1]
    ranks = np.zeros(n, np.int64)
    ranks[sample[order]] = np.cumsum(new) + 1
    reach = PERIOD
    while reach < depth:  # a place of the sample is in it again PERIOD bytes on
        both = ranks[sample] * (len(sample) + 2) + after(ranks, reach)
        ranks[sample] = np.unique(both, return_inverse=True)[1] + 1
        reach *= 2
    return ranks


def repeated(parts: list[bytes], far: np.ndarray, windows: np.ndarray, bucket: np.ndarray, length: int) -> list[np.ndarray]:
    """Of each part the windows whose ``length`` bytes occur again in its bucket, by the order of all their suffixes.

    Parts are laid out with their anchors at equal residues, so that most ties are between equal residues and one rank
    a suffix settles them; ties between others go by the pair's own shift."""
    sizes = np.array([len(p) for p in parts])
    lead = (-far) % PERIOD
    space = lead + sizes
    space += (-space) % PERIOD
    starts = np.cumsum(space) - space + lead
    data = np.zeros(int(space.sum()) + length, np.uint8)
    for s, p in zip(starts.tolist(), parts, strict=True):
        data[s : s + len(p)] = np.frombuffer(p, np.uint8)
    words = _words(data)
    ranks = sample_ranks(words, length)
    of = np.repeat(np.arange(len(parts)), windows)
    at = np.arange(len(of)) - np.repeat(np.cumsum(windows) - windows, windows) + starts[of]
    shift = shift_table()
    residue = at % PERIOD
    tie = ranks[at + shift[residue, residue]]
    keys = [bucket[of], *[words[at + k] for k in (0, 8, 16, 24)]]
    order = np.lexsort([tie, residue, *keys[::-1]])
    new = np.ones(len(order), bool)
    new[1:] = False
    for k in keys:
        new[1:] |= k[order][1:] != k[order][:-1]
    group = np.cumsum(new)
    mixed = np.zeros(len(order), bool)
    mixed[1:] = (group[1:] == group[:-1]) & (residue[order][1:] != residue[order][:-1])
    for g in np.unique(group[mixed]):
        a, b = np.searchsorted(group, [g, g + 1])

        def compare(x: int, y: int) -> int:
            d = shift[residue[x], residue[y]]
            return int(ranks[at[x] + d] - ranks[at[y] + d])

        order[a:b] = sorted(order[a:b].tolist(), key=cmp_to_key(compare))
    one, two = order[:-1], order[1:]
    same = np.flatnonzero(bucket[of[one]] == bucket[of[two]])
    for k in [*range(0, length - 7, 8), length - 8]:
        same = same[words[at[one[same]] + k] == words[at[two[same]] + k]]
    out = np.zeros(len(of), bool)
    out[one[same]] = True
    out[two[same]] = True
    return np.split(out, np.cumsum(windows)[:-1])


def _sorted_buckets(pieces: DataFrame, length: int) -> DataFrame:
    """``t1, t2, start, windows``: the repeated windows of pieces, whole buckets of which stand together."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def answer(table: pa.Table) -> pa.RecordBatch:
            t1, t2, start, far, windows, key = (table.column(k).to_numpy() for k in (0, 1, 2, 3, 4, 6))
            marks = repeated([x.as_py() for x in table.column(8)], far.astype(np.int64), windows.astype(np.int64), np.unique(key, return_inverse=True)[1], length)
            rows = []
            for k, m in enumerate(marks):
                edge = np.flatnonzero(np.diff(np.concatenate([[False], m, [False]]).astype(np.int8)))
                rows += [(t1[k], t2[k], start[k] + a, b - a) for a, b in zip(edge[::2].tolist(), edge[1::2].tolist(), strict=True)]
            columns = list(zip(*rows, strict=True)) or [[]] * 4
            return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["t1", "t2", "start", "windows"])

        held: list[pa.RecordBatch] = []
        for batch in slices(batches, "bytes", 1 << 20):
            key = batch.column(6).to_numpy()
            ends = np.flatnonzero(key[1:] != key[:-1]) + 1
            if held and key[0] != held[-1].column(6)[-1].as_py():
                yield answer(pa.Table.from_batches(held))
                held = []
            if len(ends):
                cut = int(ends[-1])
                yield answer(pa.Table.from_batches([*held, batch.slice(0, cut)]))
                held, batch = [], batch.slice(cut)
            held.append(batch)
        if held:
            yield answer(pa.Table.from_batches(held))

    grouped = pieces.repartition("key").sortWithinPartitions("key")
    return grouped.mapInArrow(run, "t1 long, t2 long, start long, windows long")


def _repeated_pieces(texts: DataFrame, length: int, gram: int, most: int) -> DataFrame:
    """``t1, t2, found``: of each text the repeated windows (start, number) among its pieces."""
    width, pieces, found = PIECE, materialise(_pieces(texts, length, gram, PIECE)), []
    while True:
        one = F.min(F.struct("t1", "t2", "start")).alias("one")
        distinct = pieces.groupBy("key", "piece").agg(F.sum(F.when(F.col("whole"), 2).otherwise(1)).alias("seen"), one)
        buckets = distinct.groupBy("key").agg(F.count("*").alias("pieces"), F.sum("seen").alias("all")).where("all > 1").select("key", "pieces")
        distinct = distinct.join(buckets, "key")
        known = materialise(pieces.join(distinct, ["key", "piece"]).where("(seen > 1 and not whole) or (pieces > 1 and (seen = 1 or struct(t1, t2, start) = one))"))
        found.append(known.where("seen > 1 and not whole").select("t1", "t2", "start", F.col("windows").cast("long").alias("windows")))
        chosen = known.where("pieces > 1 and (seen = 1 or struct(t1, t2, start) = one)").withColumn("whole", F.col("seen") > 1)
        columns = [*_PIECE_NAMES, "pieces"]
        found.append(_sorted_buckets(chosen.where(F.col("pieces") <= most).select(*columns), length))
        large = chosen.where(F.col("pieces") > most).select(*_PIECE_NAMES)
        if width == 1 or large.isEmpty():
            break
        width //= 2
        pieces = materialise(_halved(large, length, gram, width))
    every = found[0]
    for f in found[1:]:
        every = every.unionByName(f)
    return every.groupBy("t1", "t2").agg(F.collect_list(F.struct("start", "windows")).alias("found"))


def remove(docs: DataFrame, column: str = "text", key: str = "doc_id", length: int = LENGTH, gram: int = GRAM, most: int = MOST_PIECES, kept: bool = False) -> DataFrame:
    """Key, ``n_bytes``, ``n_removed``, ``n_spans``, ``kept_sha256``, and with ``kept`` the remaining bytes (null: all)."""
    docs = docs.select(F.col(key).cast("long").alias("id"), F.col(column).cast("string").alias("text"))
    first = _first_pass(docs, length, gram)
    texts = _texts(docs, _marked_runs(first))
    pieces = _repeated_pieces(texts, length, gram, most)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", 1 << 20):
            data, offsets = text_bytes(batch.column(2))
            begin, end, _, row = runs(data, offsets, length, gram)
            bounds, raw, rows = np.searchsorted(row, np.arange(batch.num_rows + 1)), data.tobytes(), []
            for k, (marks, found) in enumerate(zip(batch.column(3).to_pylist(), batch.column(4).to_pylist(), strict=True)):
                base = int(offsets[k])
                spans = [(int(begin[bounds[k] + m["run"]]), int(end[bounds[k] + m["run"]]) + length) for m in marks if m["whole"]]
                spans += [(base + f["start"], base + f["start"] + f["windows"] - 1 + length) for f in found or ()]
                parts, removed, count, upto = [], 0, 0, base
                for a, b in sorted(spans):
                    if a > upto or (a == base and not count):
                        parts.append(raw[upto:a])
                        count += 1
                    elif not count:
                        count = 1
                    if b > upto:
                        removed += b - max(a, upto)
                        upto = b
                parts.append(raw[upto : offsets[k + 1]])
                left = b"".join(parts)
                rows.append((removed, count, hashlib.sha256(left).hexdigest(), left if kept else None))
            columns = zip(*rows, strict=True)
            types = [pa.int64(), pa.int64(), pa.string(), pa.binary()]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *[pa.array(c, t) for c, t in zip(columns, types, strict=True)]], names=["t1", "t2", "n_removed", "n_spans", "kept_sha256", "kept"])

    done = texts.join(pieces, ["t1", "t2"], "left").select("t1", "t2", "text", "runs", "found").mapInArrow(run, "t1 long, t2 long, n_removed long, n_spans long, kept_sha256 string, kept binary")
    out = first.select("id", "t1", "t2", "n", "sha").join(done, ["t1", "t2"], "left").select(
        F.col("id").alias(key),
        F.col("n").alias("n_bytes"),
        F.coalesce("n_removed", F.lit(0)).alias("n_removed"),
        F.coalesce("n_spans", F.lit(0)).alias("n_spans"),
        F.coalesce("kept_sha256", F.lower(F.hex("sha"))).alias("kept_sha256"),
        *(["kept"] if kept else []),
    )
    return out
