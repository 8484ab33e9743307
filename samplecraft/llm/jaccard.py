"""N-gram Jaccard join: documents whose sets of word shingles are alike, by prefix filtering.

A document's set holds the distinct shingles of ``size`` words `[^\\x20\\x09-\\x0D]+` after A-Z became a-z; a text of
fewer words, but not none, is one shingle. Documents link when intersection / union >= ``percent`` / 100. Shingles
are 64-bit hashes; a set's identity is its size and two 64-bit sums.

1. One pass over the texts gives each document's set identity and counts shingles by hashed slot (``SLOTS`` counters,
   summed by task first), which tells the most frequent ones.
2. Documents with equal sets become one node. A second pass sends every shingle but the most frequent, shortened to a few
   bytes, to the task of its hash range, where the exact number of sets that have it is counted; what more than one set
   has returns to its document. So each set can be ordered rare-first (count, then hash; the most frequent last, by
   slot), and its prefix taken: two alike sets share a shingle of their prefixes. A set whose prefix is full of shingles
   that no other set has ends here.
3. Prefix shingles that two nodes or more have are kept as postings. The nodes of each are dealt into small groups, and
   pairs of a group are candidates within the length and positional bounds; a suffix filter then bounds the
   intersection by bin counts of the whole sets, and what is left is verified on the sets, once a pair.
4. What is outside a posting's largest component by these links meets a few nodes of that. Whatever two nodes share a
   posting and are still not in one component are then held against each other, without exception, at the first posting they share. So a large group of near copies costs a few links a node
   and not all its pairs, and no link between components is lost.

Sets needed for verification come from a third pass, restricted by a Bloom filter of fixed size to documents with
postings; another tells step 2 which documents may have equals and must be grouped first. Components are found by
repeated large-star and small-star steps on the links. Nothing here is capped or sampled, and only the slot counters and
the Bloom filters, all of fixed size, go through the driver.

Edge cases: null, empty and wordless texts have an empty set and link with nothing, not even with each other; repeated
rows and equal texts are in one component; a null id never is the smallest of a component unless all its ids are null;
an empty table gives an empty result; extra columns play no part.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from samplecraft.llm.common import U64, UNSPACED, files_for, find_words, lower_ascii, materialise, mix, pack, ragged, slices, span_hashes, tasks_for, text_bytes, window_hashes
from samplecraft.llm.components import connected_components

SIZE = 4
PERCENT = 85
SLOTS = 1 << 18
CHUNK = 1 << 12
BLOOM_BITS = 1 << 26
BINS = 16
#: Nodes of one posting that are held against each other at first.
GROUP = 8
#: Ways in which the nodes of larger postings are dealt.
DEALS = 4
#: How often what is outside a posting's largest component meets other nodes of it before all.
TIMES = 2
#: Shingles before a posting by which it is told whether a pair has met already.
KNOWN = 64
#: Shingles whose slot counts more than this, and eight times the mean, are not sent to be counted exactly.
FREQUENT = 1 << 20
#: Shingles that a task of one hash range counts.
RANGE_SHINGLES = 1 << 20
#: Bits by which shortened hashes outnumber the shingles; a shingle taken for another only adds a candidate.
SPARE_BITS = 13
UNIT_BYTES = 2 << 20
#: Shingles, postings (or pairs made from them) and documents for which a table has a task at least, where it has more
#: shuffle partitions than that.
TASK_SHINGLES, TASK_POSTINGS, TASK_DOCS = 1 << 18, 5000, 1000


def shingle_sets(batch: pa.RecordBatch, column: str, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes of each row, end to end, and where each row starts."""
    data, offsets = text_bytes(batch.column(batch.schema.get_field_index(column)))
    data = lower_ascii(data)
    first, last, before = find_words(data, offsets, UNSPACED)
    words = span_hashes(data, first, last)
    windows = window_hashes(words, size)
    sets, bounds = [], [0]
    starts = before.tolist()
    for k in range(batch.num_rows):
        a, b = starts[k], starts[k + 1]
        if b - a >= size:
            sets.append(np.unique(windows[a : b - size + 1]))
        elif b > a:
            sets.append(window_hashes(words[a:b], b - a))
        else:
            sets.append(np.zeros(0, U64))
        bounds.append(bounds[-1] + len(sets[-1]))
    return np.concatenate(sets) if sets else np.zeros(0, U64), np.array(bounds, np.int64)


def _row_sums(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    sums = np.concatenate([np.zeros(1, values.dtype), np.cumsum(values, dtype=values.dtype)])
    return sums[bounds[1:]] - sums[bounds[:-1]]


def identities(shingles: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two 64-bit sums over each set."""
    return tuple(_row_sums(mix(shingles ^ U64(c)), bounds).view(np.int64) for c in (0x243F6A8885A308D3, 0x13198A2E03707344))


def _slot(shingles: np.ndarray) -> np.ndarray:
    return (shingles >> U64(20)).astype(np.int64) & (SLOTS - 1)


def _first_pass(docs: DataFrame, size: int) -> DataFrame:
    """Rows of documents (``id, n, s1, s2``) and of slot counters (``chunk, counts``), as a table."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["id", "n", "s1", "s2", "chunk", "counts"]
        counts = np.zeros(SLOTS, np.uint64)
        for batch in slices(batches, "text"):
            shingles, bounds = shingle_sets(batch, "text", size)
            counts += np.bincount(_slot(shingles), minlength=SLOTS).astype(np.uint64)
            s1, s2 = identities(shingles, bounds)
            n = len(s1)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(np.diff(bounds)), pa.array(s1), pa.array(s2), pa.nulls(n, pa.int32()), pa.nulls(n, pa.binary())], names=names)
        parts = [(k, c) for k, c in enumerate(counts.reshape(-1, CHUNK)) if c.any()]
        none = [pa.nulls(len(parts), pa.int64()) for _ in range(4)]
        yield pa.RecordBatch.from_arrays([*none, pa.array([k for k, _ in parts], pa.int32()), pa.array([c.astype(np.uint32).tobytes() for _, c in parts], pa.binary())], names=names)

    return materialise(docs.mapInArrow(run, "id long, n long, s1 long, s2 long, chunk int, counts binary"))


def _slot_counts(first: DataFrame) -> np.ndarray:
    """The counters of all tasks, summed by chunk as they stream by."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for chunk, counts in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                sums.setdefault(chunk, np.zeros(CHUNK, np.uint64))
                sums[chunk] += np.frombuffer(counts.as_buffer(), np.uint32)
        yield pa.RecordBatch.from_arrays([pa.array(list(sums), pa.int32()), pa.array([c.tobytes() for c in sums.values()], pa.binary())], names=["chunk", "counts"])

    rows = first.where("chunk is not null").select("chunk", "counts").repartition("chunk").mapInArrow(run, "chunk int, counts binary")
    out = np.zeros((SLOTS // CHUNK, CHUNK), np.uint64)
    for r in rows.collect():  # SLOTS counters in all
        out[r["chunk"]] = np.frombuffer(r["counts"], np.uint64)
    flat = out.reshape(-1)
    return np.minimum(flat, U64((1 << 31) - 1)).astype(np.int64)


def prefix_length(n: np.ndarray, percent: int) -> np.ndarray:
    """n - ceil(n * percent / 100) + 1: alike sets are alike in size, so each shares at least that part of its own."""
    return n - (n * percent + 99) // 100 + 1


def _bloom(rows: DataFrame) -> np.ndarray:
    """A Bloom filter of ``BLOOM_BITS`` over column ``s1``; its words are collected, one row each at most."""
    bit = F.pmod(F.col("s1"), F.lit(BLOOM_BITS))
    set_bit = F.expr(f"shiftleft(1L, cast(pmod(s1, {BLOOM_BITS}) % 32 as int))")
    words = rows.groupBy(F.shiftright(bit, 5).cast("int").alias("word")).agg(F.bit_or(set_bit).alias("bits")).toArrow()
    bloom = np.zeros(BLOOM_BITS // 32, np.uint32)
    bloom[words["word"].to_numpy()] = words["bits"].to_numpy().astype(np.uint32)
    return bloom


def _maybe_in(bloom: np.ndarray, s1: np.ndarray) -> np.ndarray:
    at = s1 % BLOOM_BITS
    return ((bloom[at >> 5] >> (at & 31).astype(np.uint32)) & np.uint32(1)).astype(bool)


def _chosen(shingles: np.ndarray, bounds: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The sets of some rows."""
    n = np.diff(bounds)
    return shingles[np.repeat(rows, n)], np.concatenate([[0], np.cumsum(n[rows])])


def _planes(values: np.ndarray) -> bytes:
    """Bytes of equal weight together, so that small values compress."""
    return np.ascontiguousarray(values.view(np.uint8).reshape(len(values), -1).T).tobytes()


def _unplaned(data: bytes, dtype) -> np.ndarray:
    width = np.dtype(dtype).itemsize
    return np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(width, -1).T).reshape(-1).view(dtype)


#: kind 0: shingles (keys, documents of the unit, counts); 1: frequent shingles, likewise; 2: the unit's sets (sizes and
#: numbers of omitted shingles, identities).
_UNITS = "range int, unit long, kind int, x binary, y binary, z binary"


def _packed(shingles: np.ndarray, bounds: np.ndarray, counts: np.ndarray, frequent: int, bits: int, range_bits: int, percent: int) -> pa.RecordBatch:
    """A unit of sets: its shingles by hash range, as differences of shortened hashes."""
    s1, s2 = identities(shingles, bounds)
    n = np.diff(bounds)
    unit = int(mix(s1.view(U64) + s2.view(U64)).sum(dtype=U64).view(np.int64))
    home = unit % (1 << range_bits)
    row = np.repeat(np.arange(len(n)), n)
    key = shingles >> U64(64 - bits)
    slot_count = counts[_slot(shingles)]
    often = slot_count > frequent
    omitted, out = np.zeros(len(n), np.int64), []
    if often.any():
        # Frequent ones come last, so they matter only to sets whose prefix may reach them.
        many = np.bincount(row, often, len(n)).astype(np.int64)
        reached = many > n - prefix_length(n, percent)
        omitted, reach = np.where(reached, 0, many), often & reached[row]
        out.append((home, unit, 1, key[reach].tobytes(), row[reach].astype(np.uint32).tobytes(), slot_count[reach].astype(np.uint32).tobytes()))
        key, row = key[~often], row[~often]
    out.append((home, unit, 2, np.concatenate([n, omitted]).tobytes(), s1.tobytes(), s2.tobytes()))
    order = np.argsort(key, kind="stable")
    key, row = key[order], row[order].astype(np.uint32)
    ranges = (key >> U64(bits - range_bits)).astype(np.int64)
    cuts = np.flatnonzero(np.diff(ranges)) + 1
    for a, b in zip([0, *cuts.tolist()], [*cuts.tolist(), len(key)], strict=True):
        if b > a:
            out.append((int(ranges[a]), unit, 0, _planes(np.diff(key[a:b], prepend=U64(0))), _planes(row[a:b]), None))
    types = [pa.int32(), pa.int64(), pa.int32(), pa.binary(), pa.binary(), pa.binary()]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), types, strict=True)], names=[x.split()[0] for x in _UNITS.split(", ")])


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of each hash range, whose rows stand together: shingles that more than one set has, with their counts."""
    names = [x.split()[0] for x in _UNITS.split(", ")]
    held: list[tuple] = []

    def answer() -> Iterator[pa.RecordBatch]:
        keys = [np.cumsum(_unplaned(r[3], U64), dtype=U64) for r in held]
        if not keys:
            return
        every = np.sort(np.concatenate(keys))
        first = np.flatnonzero(np.concatenate([[True], every[1:] != every[:-1]]))
        count = np.diff(np.append(first, len(every)))
        shared, count = every[first[count > 1]], count[count > 1].astype(np.uint32)
        rows = []
        for r, key in zip(held, keys, strict=True):
            at = np.searchsorted(shared, key)
            found = (at < len(shared)) & (shared[np.minimum(at, len(shared) - 1)] == key) if len(shared) else np.zeros(len(key), bool)
            if found.any():
                rows.append((r[0], r[1], 0, key[found].tobytes(), _unplaned(r[4], np.uint32)[found].tobytes(), count[at[found]].tobytes()))
        if rows:
            types = [pa.int32(), pa.int64(), pa.int32(), pa.binary(), pa.binary(), pa.binary()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names=names)

    for batch in batches:
        kind = batch.column(2).to_numpy()
        yield batch.filter(pa.array(kind > 0))
        for k in np.flatnonzero(kind == 0).tolist():
            row = tuple(c[k].as_py() for c in batch.columns)
            if held and held[0][0] != row[0]:
                yield from answer()
                held = []
            held.append(row)
    yield from answer()


def _prefixes(percent: int):
    """Of each unit, whose rows stand together, the prefix shingles that other sets have too."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []

        def answer() -> pa.RecordBatch:
            n, s1, s2 = next([np.frombuffer(x, np.int64) for x in r[2:]] for r in held if r[1] == 2)
            n, omitted = np.split(n, 2)
            parts = [[np.frombuffer(r[c], t) for r in held if r[1] < 2] for c, t in ((2, U64), (3, np.uint32), (4, np.uint32))]
            kind = np.concatenate([np.full(len(np.frombuffer(r[2], U64)), r[1]) for r in held if r[1] < 2] or [np.zeros(0, int)])
            key, row, count = (np.concatenate(p) if p else np.zeros(0, np.int64) for p in parts)
            order = np.lexsort((key, count, kind, row))
            key, row = key[order], row[order].astype(np.int64)
            shared = np.bincount(row, minlength=len(n))
            begin = np.cumsum(shared) - shared
            # What no other set has comes first, then these; omitted ones would come last.
            absent = n - omitted - shared
            pos = np.arange(len(key)) - begin[row] + absent[row]
            kept = pos < prefix_length(n, percent)[row]
            columns = (key[kept].view(np.int64), pos[kept], n[row[kept]], absent[row[kept]], s1[row[kept]], s2[row[kept]])
            return pa.RecordBatch.from_arrays([pa.array(np.ascontiguousarray(c)) for c in columns], names=["t", "pos", "n", "own", "s1", "s2"])

        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns[1:]), strict=True):
                if held and held[0][0] != row[0]:
                    yield answer()
                    held = []
                held.append(row)
        if held:
            yield answer()

    return run


def _postings(docs: DataFrame, first: DataFrame, size: int, percent: int, frequent: int) -> DataFrame:
    """``t, pos, n, own, s1, s2``: the prefix shingles that more than one set has; ``own`` are those that no other has."""
    rows = first.where("n > 0")
    total = rows.agg(F.sum("n")).first()[0] or 1
    range_bits = max(0, int(total // RANGE_SHINGLES).bit_length())
    bits = min(63, int(total).bit_length() + SPARE_BITS)
    counts = _slot_counts(first)
    limit = max(frequent, 8 * total // SLOTS)
    copies = _bloom(rows.groupBy("n", "s1", "s2").count().where("count > 1"))
    sent = docs.sparkSession.sparkContext.broadcast((counts, copies))

    def alone(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", UNIT_BYTES):
            shingles, bounds = shingle_sets(batch, "text", size)
            s1, _ = identities(shingles, bounds)
            some = (np.diff(bounds) > 0) & ~_maybe_in(sent.value[1], s1)
            if some.any():
                yield _packed(*_chosen(shingles, bounds, some), sent.value[0], limit, bits, range_bits, percent)

    def copied(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", UNIT_BYTES):
            shingles, bounds = shingle_sets(batch, "text", size)
            s1, s2 = identities(shingles, bounds)
            some = pa.array((np.diff(bounds) > 0) & _maybe_in(sent.value[1], s1))
            yield pa.RecordBatch.from_arrays([pa.array(np.diff(bounds)), pa.array(s1), pa.array(s2), pack(shingles, bounds)], names=["n", "s1", "s2", "shingles"]).filter(some)

    def grouped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "shingles", UNIT_BYTES):
            raw, offsets = text_bytes(batch.column(0))
            yield _packed(np.frombuffer(raw.tobytes(), U64), offsets // 8, sent.value[0], limit, bits, range_bits, percent)

    equal = docs.mapInArrow(copied, "n long, s1 long, s2 long, shingles binary").groupBy("n", "s1", "s2").agg(F.first("shingles").alias("shingles"))
    units = docs.mapInArrow(alone, _UNITS).unionByName(equal.select("shingles").mapInArrow(grouped, _UNITS))
    shared = units.repartition(max(1, 1 << range_bits), "range").sortWithinPartitions("range").mapInArrow(_counted, _UNITS)
    prefixes = shared.repartition("unit").sortWithinPartitions("unit").mapInArrow(_prefixes(percent), "t long, pos long, n long, own long, s1 long, s2 long")
    return materialise(prefixes, files=tasks_for(docs.sparkSession, total, TASK_SHINGLES))


def _numbered(postings: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(nodes: ``node, n, s1, s2``; postings: ``t, node, pos, n, own``) of shingles that two nodes or more have."""
    sets = ["n", "s1", "s2"]
    shared = postings.groupBy("t").agg(F.count("*").alias("sets")).where("sets > 1").select("t")
    files = tasks_for(postings.sparkSession, postings.count(), TASK_POSTINGS)
    kept = materialise(postings.join(shared, "t"), files=files)
    # Ids are given as the table is written, and read from it ever after.
    nodes = materialise(kept.select(*sets).distinct().withColumn("node", F.monotonically_increasing_id()), files=files_for(kept.count()))
    return nodes, materialise(kept.join(nodes, sets).select("t", "node", "pos", "n", "own"), files=files)


def _sets(docs: DataFrame, nodes: DataFrame, size: int) -> DataFrame:
    """``node, n, bins, shingles`` of all nodes with postings."""
    sent = docs.sparkSession.sparkContext.broadcast(_bloom(nodes))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            shingles, bounds = shingle_sets(batch, "text", size)
            s1, s2 = identities(shingles, bounds)
            some = (np.diff(bounds) > 0) & _maybe_in(sent.value, s1)
            shingles, bounds = _chosen(shingles, bounds, some)
            n = np.diff(bounds)
            row = np.repeat(np.arange(len(n)), n)
            bins = np.bincount(row * BINS + (shingles >> U64(60)).astype(np.int64), minlength=len(n) * BINS)
            yield pa.RecordBatch.from_arrays(
                [pa.array(n), pa.array(s1[some]), pa.array(s2[some]), ragged(bins.astype(np.int32), np.arange(len(n) + 1) * BINS), pack(shingles, bounds)],
                names=["n", "s1", "s2", "bins", "shingles"],
            )

    rows = docs.mapInArrow(run, "n long, s1 long, s2 long, bins array<int>, shingles binary")
    rows = rows.groupBy("n", "s1", "s2").agg(F.first("bins").alias("bins"), F.first("shingles").alias("shingles"))
    files = tasks_for(docs.sparkSession, nodes.count(), TASK_DOCS)
    return materialise(rows.join(nodes, ["n", "s1", "s2"]).select("node", "n", "bins", "shingles"), files=files)


def _least_common(n: F.Column, m: F.Column, percent: int) -> F.Column:
    """Smallest intersection with 100 * i >= percent * (n + m - i)."""
    return F.ceil((n + m) * F.lit(percent) / F.lit(100 + percent))


def _near(x: dict[str, F.Column], y: dict[str, F.Column], percent: int) -> F.Column:
    """Length bound, and positional bound: what can be common before, at and after two places. Shingles of a set's own
    come first in its order and are common with none."""
    n, m = x["n"], y["n"]
    length = F.least(n, m) * 100 >= F.greatest(n, m) * percent
    before = F.least(x["pos"] - x["own"], y["pos"] - y["own"])
    most = before + 1 + F.least(n - x["pos"] - 1, m - y["pos"] - 1)
    return length & (most >= _least_common(n, m, percent))


def _named(suffix: str) -> dict[str, F.Column]:
    return {c: F.col(f"{c}{suffix}") for c in ("pos", "n", "own")}


def _verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Of distinct pairs ``a, b`` those whose sets are alike."""
    bins = sets.select("node", "n", "bins")
    left = bins.select(F.col("node").alias("a"), F.col("n").alias("n_a"), F.col("bins").alias("bins_a"))
    right = bins.select(F.col("node").alias("b"), F.col("n").alias("n_b"), F.col("bins").alias("bins_b"))
    apart = F.aggregate(F.zip_with("bins_a", "bins_b", lambda x, y: F.abs(x - y)), F.lit(0), lambda s, x: s + x)
    n, m = F.col("n_a"), F.col("n_b")
    close = pairs.join(left, "a").join(right, "b").where(n + m - apart >= 2 * _least_common(n, m, percent)).select("a", "b")
    whole = sets.select("node", "shingles")
    close = close.join(whole.select(F.col("node").alias("b"), F.col("shingles").alias("of_b")), "b")
    close = close.join(whole.select(F.col("node").alias("a"), F.col("shingles").alias("of_a")), "a")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            alike = []
            for x, y in zip(batch.column(2), batch.column(3), strict=True):
                x, y = np.frombuffer(x.as_buffer(), U64), np.frombuffer(y.as_buffer(), U64)
                common = len(np.intersect1d(x, y, assume_unique=True))
                alike.append(100 * common >= percent * (len(x) + len(y) - common))
            yield batch.select([0, 1]).filter(pa.array(alike, pa.bool_()))

    return close.select("a", "b", "of_a", "of_b").mapInArrow(run, "a long, b long")


def _grouped(postings: DataFrame, percent: int, deals: int = DEALS) -> DataFrame:
    """Candidate pairs within small groups: a posting's nodes are dealt by hash into groups of about ``GROUP``.

    Postings of no more nodes are done with this; in larger ones it finds every node a few partners, so that a large
    group of near copies becomes one component, or nearly. There are ``deals`` ways to deal for each power of two of
    groups, so however many postings two nodes share, a node meets some ``deals * GROUP`` partners."""
    groups = postings.groupBy("t").agg(F.expr(f"shiftleft(1L, cast(ceil(log2(ceil(count(*) / {GROUP}))) as int))").alias("groups"))
    deal = F.when(F.col("groups") > 1, F.pmod(F.xxhash64("t"), F.lit(deals))).otherwise(F.lit(0))
    dealt = postings.join(groups, "t").withColumn("part", F.pmod(F.xxhash64("node", deal), "groups")).drop("groups")
    other = dealt.select("t", "part", *[F.col(c).alias(f"{c}_x") for c in ("node", "pos", "n", "own")])
    pairs = dealt.join(other, ["t", "part"]).where((F.col("node") < F.col("node_x")) & _near(_named(""), _named("_x"), percent))
    return pairs.select(F.col("node").alias("a"), F.col("node_x").alias("b")).distinct()


def _with_prior(postings: DataFrame, known: int) -> DataFrame:
    """Postings with the first ``known`` of the rarer shingles that their node has in common with others (``prior``), and
    whether these are all (``exact``)."""
    ranked = postings.withColumn("i", F.row_number().over(W.partitionBy("node").orderBy("pos")))
    heads = ranked.where(F.col("i") <= known).groupBy("node").agg(F.sort_array(F.collect_list(F.struct("i", "t"))).alias("head"))
    prior = F.slice(F.col("head.t"), F.lit(1), F.least(F.col("i") - 1, F.lit(known)))
    return ranked.join(heads, "node").select("t", "node", "pos", "n", "own", prior.alias("prior"), (F.col("i") <= known + 1).alias("exact"))


def _apart(postings: DataFrame, labels: DataFrame, files: int | None = None) -> DataFrame:
    """Postings of several components: ``comp`` of each node, the largest component ``main`` and its nodes ``inside``."""
    held = postings.join(labels, "node", "left").withColumn("comp", F.coalesce("comp", "node"))
    counted = held.groupBy("t", "comp").agg(F.count("*").alias("c"))
    largest = F.max(F.struct("c", "comp"))
    mixed = counted.groupBy("t").agg(F.count("*").alias("comps"), largest.alias("l")).where("comps > 1")
    return materialise(held.join(mixed.select("t", F.col("l.comp").alias("main"), F.col("l.c").alias("inside")), "t"), files=files)


def _partners(apart: DataFrame, percent: int, time: int, deals: int = DEALS) -> DataFrame:
    """Candidate pairs of each node outside the largest component of a posting with about ``GROUP`` nodes of it, so that
    most of what a few random partners missed is linked before the rest is held against all."""
    groups = F.greatest(F.lit(1), F.expr(f"shiftleft(1L, cast(floor(log2(inside / {GROUP})) as int))"))
    deal = F.pmod(F.xxhash64("t"), F.lit(deals)) + time * deals
    dealt = apart.where(F.col("inside") > 1).withColumn("part", F.pmod(F.xxhash64("node", deal), groups))
    columns = ("node", "pos", "n", "own")
    outside = dealt.where("comp != main").select("t", "part", *[F.col(c).alias(f"{c}_x") for c in columns])
    pairs = dealt.where("comp = main").join(outside, ["t", "part"]).where(_near(_named(""), _named("_x"), percent))
    return pairs.select(F.least("node", "node_x").alias("a"), F.greatest("node", "node_x").alias("b")).distinct()


def _rest(postings: DataFrame, apart: DataFrame, percent: int, known: int = KNOWN, files: int | None = None) -> DataFrame:
    """Candidate pairs of all nodes that share a posting across components. Within a posting, nodes outside its
    largest component are held against all others, so that a component's own pairs are never formed.

    A pair is made at its first common posting alone. There nothing before is common, so what can be common is at most
    what follows both places. Where more than ``known`` shingles come before, a pair may come again, never be missed."""
    prior = _with_prior(postings.join(apart.select("node").distinct(), "node", "left_semi"), known)
    rows = materialise(prior.join(apart.select("t", "node", "comp", "main"), ["t", "node"]), files=files)
    columns = ("node", "pos", "n", "own", "prior", "exact", "comp")
    small = rows.where("comp != main").select("t", *[F.col(c).alias(f"{c}_x") for c in columns])
    pairs = small.join(rows, "t").where((F.col("comp") != F.col("comp_x")) & ((F.col("comp") == F.col("main")) | (F.col("node_x") < F.col("node"))))
    after = F.least(F.col("n") - F.col("pos"), F.col("n_x") - F.col("pos_x")) >= _least_common(F.col("n"), F.col("n_x"), percent)
    near = _near(_named(""), _named("_x"), percent) & (after | ~F.col("exact") | ~F.col("exact_x"))
    pairs = pairs.where(near & ~F.arrays_overlap("prior", "prior_x"))
    return pairs.select(F.least("node", "node_x").alias("a"), F.greatest("node", "node_x").alias("b")).distinct()


def _joined(labels: DataFrame, links: DataFrame) -> DataFrame:
    """Components with more links between their nodes. The steps see one link for any two components that links join."""
    rows = links.count()
    for end in ("a", "b"):
        links = links.join(labels.select(F.col("node").alias(end), F.col("comp").alias(f"of_{end}")), end, "left")
    ends = [F.coalesce(f"of_{end}", end).alias(end) for end in ("a", "b")]
    merged = connected_components(materialise(links.select(*ends).where("a != b").distinct(), files=files_for(rows)), "a", "b")
    renamed = labels.join(merged.select(F.col("node").alias("comp"), F.col("comp").alias("new")), "comp", "left")
    added = merged.join(labels, "node", "left_anti").select("node", "comp")
    return materialise(renamed.select("node", F.coalesce("new", "comp").alias("comp")).unionByName(added), files=files_for(labels.count() + 2 * rows))


def classes(docs: DataFrame, column: str = "text", key: str = "doc_id", size: int = SIZE, percent: int = PERCENT, frequent: int = FREQUENT) -> tuple[DataFrame, DataFrame]:
    """(documents: ``id, n, s1, s2``; distinct sets: ``n, s1, s2, least, comp, component_id, chosen``).

    ``component_id`` is the smallest id of the component."""
    docs = docs.select(F.col(key).cast("long").alias("id"), F.col(column).cast("string").alias("text"))
    first = _first_pass(docs, size)
    nodes, postings = _numbered(_postings(docs, first, size, percent, frequent))
    sets = _sets(docs, nodes, size)
    files = tasks_for(docs.sparkSession, postings.count(), TASK_POSTINGS)
    near = materialise(_verified(_grouped(postings, percent), sets, percent), files=files)
    labels = connected_components(near, "a", "b")
    for time in range(1, TIMES + 1):
        labels = _joined(labels, materialise(_verified(_partners(_apart(postings, labels, files), percent, time), sets, percent), files=files))
    labels = _joined(labels, materialise(_verified(_rest(postings, _apart(postings, labels, files), percent, files=files), sets, percent), files=files))
    named = nodes.join(labels, "node", "left").select("n", "s1", "s2", F.coalesce("comp", "node").cast("string").alias("comp"))
    own = F.concat_ws(":", "n", "s1", "s2")  # sets without postings are components of their own
    grouped = first.where("n > 0").groupBy("n", "s1", "s2").agg(F.min("id").alias("least"))
    grouped = grouped.join(named, ["n", "s1", "s2"], "left").withColumn("comp", F.coalesce("comp", own))
    # The smallest id; where ids are equal or null, the smallest set identity.
    best = F.min(F.struct(F.col("least").isNull().alias("none"), "least", "s1", "s2"))
    of = grouped.groupBy("comp").agg(best.alias("best"))
    sets = grouped.join(of, "comp").select("n", "s1", "s2", "least", "comp", F.col("best.least").alias("component_id"), (F.struct("s1", "s2") == F.struct("best.s1", "best.s2")).alias("chosen"))
    return first.where("chunk is null").select("id", "n", "s1", "s2"), sets


def join(docs: DataFrame, column: str = "text", key: str = "doc_id", size: int = SIZE, percent: int = PERCENT) -> DataFrame:
    """A row a document: key, ``n_shingles`` and ``component_id``."""
    rows, sets = classes(docs, column, key, size, percent)
    found = rows.where("n > 0").join(sets.select("n", "s1", "s2", "component_id"), ["n", "s1", "s2"])
    alone = rows.where("n = 0").withColumn("component_id", F.col("id"))
    both = found.select("id", "n", "component_id").unionByName(alone.select("id", "n", "component_id"))
    return both.select(F.col("id").alias(key), F.col("n").alias("n_shingles"), "component_id")


def keep_one(docs: DataFrame, column: str = "text", key: str = "doc_id", size: int = SIZE, percent: int = PERCENT) -> DataFrame:
    """One document of each component, that of the smallest id, and all documents with empty sets."""
    rows, sets = classes(docs, column, key, size, percent)
    chosen = sets.where("chosen").select(F.col("n").alias("__n"), F.col("s1").alias("__s1"), F.col("s2").alias("__s2"), F.col("least").alias("__least"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, column):
            shingles, bounds = shingle_sets(batch, column, size)
            s1, s2 = identities(shingles, bounds)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(np.diff(bounds)), pa.array(s1), pa.array(s2)], names=[*batch.schema.names, "__n", "__s1", "__s2"])

    schema = docs.select("*", *[F.lit(0).cast("long").alias(c) for c in ("__n", "__s1", "__s2")]).schema
    marked = docs.mapInArrow(run, schema)
    same_id = F.col(f"`{key}`").cast("long").eqNullSafe(F.col("__least"))
    kept = marked.where("__n > 0").join(chosen.withColumnsRenamed({c: f"{c}_" for c in ("__n", "__s1", "__s2")}), (F.col("__n") == F.col("__n_")) & (F.col("__s1") == F.col("__s1_")) & (F.col("__s2") == F.col("__s2_")) & same_id, "left_semi")
    kept = kept.dropDuplicates(["__n", "__s1", "__s2"])  # equal sets under one id: one row
    every = kept.unionByName(marked.where("__n = 0")).select(*[F.col(f"`{c}`") for c in docs.columns])
    return every.coalesce(tasks_for(docs.sparkSession, rows.count(), TASK_DOCS))
