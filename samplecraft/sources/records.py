"""Records of huge single files, read by many tasks.

A JSON array or a quoted CSV file cannot be cut at any byte: what a comma or a line end means depends on all quotes and brackets
before it. So a file is read in blocks, in pieces that end at each comma (JSON) or line end (CSV), twice. The first time
each block is summed up: whether its quotes leave the state changed, and by how much its brackets move the depth, for
either state it may begin in. A running sum over the blocks, one row each, gives the state each begins in; the second time every piece
knows whether it ends a record. Pieces of a record that crosses blocks are put together by block; all others never
leave their task.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from samplecraft.functions import maps
from samplecraft.sources.payloads import csv_fields

_SEPARATORS = {"json": ",", "csv": "\n"}
_BLANK = b" \t\r\n"


def _pieces(spark: SparkSession, path: str | Sequence[str], kind: str) -> DataFrame:
    """Pieces in the order of their block, each with its file and where its block begins."""
    read = spark.read.option("lineSep", _SEPARATORS[kind]).text(path if isinstance(path, str) else list(path))
    return read.select(F.xxhash64("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.col("value").alias("piece"))


class _Marks:
    """What the quotes and brackets of some pieces do, for a text that begins outside of quotes."""

    def __init__(self, pieces: pa.Array, kind: str) -> None:
        pieces = pieces.cast(pa.large_binary())
        ends = np.frombuffer(pieces.buffers()[1], np.int64)[pieces.offset : pieces.offset + len(pieces) + 1]
        body = pieces.buffers()[2]
        self.data = np.frombuffer(body, np.uint8)[ends[0] : ends[-1]] if body is not None and ends[-1] > ends[0] else np.zeros(0, np.uint8)
        self.ends = ends - ends[0]
        quote = self.data == 0x22
        if kind == "json":
            quote &= ~self._escaped()
        inside = np.cumsum(quote) & 1
        self.parity = self._at(inside)
        self.depth = {0: np.zeros(len(pieces), np.int64), 1: np.zeros(len(pieces), np.int64)}
        if kind == "json":
            step = np.isin(self.data, (0x5B, 0x7B)).astype(np.int8) - np.isin(self.data, (0x5D, 0x7D)).astype(np.int8)
            for state in (0, 1):
                self.depth[state] = self._at(np.cumsum(np.where(inside == state, step, 0), dtype=np.int64))

    def _at(self, running: np.ndarray) -> np.ndarray:
        """The running value at the end of each piece."""
        return np.concatenate([[0], running]).astype(np.int64)[self.ends[1:]]

    def _escaped(self) -> np.ndarray:
        """Bytes after an odd number of backslashes."""
        slash = self.data == 0x5C
        if not slash.any():
            return slash
        place = np.arange(len(slash))
        heads = self.ends[:-1][self.ends[:-1] < len(slash)]
        begin = np.where(slash, 0, place + 1)  # of a run: after the last byte that is none, or where its piece begins
        begin[heads] = np.maximum(begin[heads], heads)
        begin = np.maximum.accumulate(begin)
        odd = np.concatenate([[False], ((place + 1 - begin) & 1).astype(bool)[:-1]])
        odd[heads] = False
        return odd


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batches cut so that each is of one block."""
    for batch in batches:
        keys = np.stack([batch.column(k).to_numpy() for k in (0, 1)])
        cuts = np.flatnonzero((keys[:, 1:] != keys[:, :-1]).any(axis=0)) + 1
        for a, b in zip([0, *cuts.tolist()], [*cuts.tolist(), batch.num_rows], strict=True):
            if b > a:
                yield batch.slice(a, b - a)


def _summed(kind: str):
    """Of each block: whether its quotes change the state, how far its brackets move the depth if it begins outside and
    inside of quotes, and its first character that is no blank."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, sums, first = None, (0, 0, 0), None

        def row() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip((*at, *sums, first), (*[pa.int64()] * 5, pa.string()), strict=True)], names=["file", "block", "parity", "outside", "inside", "first"])

        for batch in _blocks(batches):
            here = (batch.column(0)[0].as_py(), batch.column(1)[0].as_py())
            if here != at:
                if at:
                    yield row()
                at, sums, first = here, (0, 0, 0), None
            marks = _Marks(batch.column(2), kind)
            parity, outside, inside = sums
            step = (int(marks.depth[0][-1]), int(marks.depth[1][-1]))
            sums = (parity ^ int(marks.parity[-1]), outside + step[parity], inside + step[1 - parity])
            if first is None:
                first = marks.data.tobytes().lstrip(_BLANK)[:1].decode("utf-8", "replace") or None
        if at:
            yield row()

    return run


def _states(blocks: DataFrame) -> np.ndarray:
    """``file, block, parity, depth, listed, opened`` as each block begins, by file and block: 48 bytes a block, which is
    20 MB for 50 TB in blocks of 128 MB."""
    before = W.partitionBy("file").orderBy("block").rowsBetween(W.unboundedPreceding, -1)
    upto = W.partitionBy("file").orderBy("block").rowsBetween(W.unboundedPreceding, 0)
    begun = blocks.withColumn("p", F.coalesce(F.sum("parity").over(before) % 2, F.lit(0)))
    moved = F.when(F.col("p") == 1, F.col("inside")).otherwise(F.col("outside"))
    known = begun.withColumn("moved", moved).select(
        "file",
        "block",
        "p",
        F.coalesce(F.sum("moved").over(before), F.lit(0)).alias("depth"),
        F.coalesce(F.first("first", ignorenulls=True).over(upto) == "[", F.lit(False)).cast("long").alias("listed"),
        F.first("first", ignorenulls=True).over(before).isNotNull().cast("long").alias("opened"),
    )
    held = known.toArrow()
    columns = np.stack([np.asarray(c.to_numpy()) for c in held.columns]) if held.num_rows else np.zeros((6, 0), np.int64)
    return columns[:, np.lexsort((columns[1], columns[0]))]


def _cut(kind: str, states: object):
    """Records of each block, and the pieces before its first and after its last record."""
    separator, rest = _SEPARATORS[kind], 1 if kind == "json" else 0
    types = (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.bool_(), pa.bool_())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = states.value
        at, parity, depth, listed, opened, ix, held, starts = None, 0, 0, False, True, 0, [], True

        def rows(texts: list[tuple[str, bool, bool]]) -> pa.RecordBatch:
            nonlocal ix
            n, ix = len(texts), ix + len(texts)
            columns = [[at[0]] * n, [at[1]] * n, list(range(ix - n, ix)), *map(list, zip(*texts, strict=True))]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=[x.split()[0] for x in _RECORD.split(", ")])

        for batch in _blocks(batches):
            here = (batch.column(0)[0].as_py(), batch.column(1)[0].as_py())
            if here != at:
                if held:
                    yield rows([(separator.join(held), starts, False)])
                at, ix, held = here, 0, []
                low, high = np.searchsorted(known[0], here[0]), np.searchsorted(known[0], here[0], side="right")
                parity, depth, listed, opened = known[2:, low + np.searchsorted(known[1, low:high], here[1])].tolist()
                starts = here[1] == 0 or (parity == 0 and depth == rest and (kind == "csv" or bool(listed and opened)))
            marks = _Marks(batch.column(2), kind)
            levels = depth + marks.depth[parity]
            outside = (marks.parity ^ parity) == 0
            pieces, out, begin = batch.column(2).to_pylist(), [], 0
            if kind == "json" and listed:
                if not opened:
                    head = next((k for k, p in enumerate(pieces) if p.strip()), None)
                    if head is not None:
                        pieces[head], opened = pieces[head].lstrip()[1:], True
                for k in np.flatnonzero(outside & (levels == 0)).tolist():
                    pieces[k] = pieces[k].rstrip().removesuffix("]")
                done = outside & (levels == 1)
            else:
                done = outside & (kind == "csv")
            for k in np.flatnonzero(done).tolist():
                out.append((separator.join([*held, *pieces[begin : k + 1]]), starts, True))
                held, begin, starts = [], k + 1, True
            held += pieces[begin:]
            if out:
                yield rows(out)
            parity, depth = parity ^ int(marks.parity[-1]), int(levels[-1])
        if held:
            yield rows([(separator.join(held), starts, False)])

    return run


_BLOCK = "file long, block long, parity long, outside long, inside long, first string"
_RECORD = "file long, block long, ix long, text string, starts boolean, ends boolean"


def split_records(spark: SparkSession, path: str | Sequence[str], kind: str = "json") -> DataFrame:
    """``file, block, ix, record``: the elements of JSON arrays, or the records of CSV files, in the order of
    ``block, ix``; ``file`` is the hash of the path (``xxhash64``).

    A JSON file whose root is no array is one record, and so is what stands behind a quote or bracket that is not closed. Blank
    records are left out. The sums of the blocks are taken as the plan is built; of these alone something is collected.
    """
    pieces = _pieces(spark, path, kind)
    states = spark.sparkContext.broadcast(_states(pieces.mapInArrow(_summed(kind), _BLOCK)))
    found = pieces.mapInArrow(_cut(kind, states), _RECORD)
    whole = found.where("starts AND ends").select("file", "block", "ix", F.col("text").alias("record"))
    # at most two rows a block
    run = F.sum(F.col("starts").cast("long")).over(W.partitionBy("file").orderBy("block", "ix").rowsBetween(W.unboundedPreceding, 0))
    broken = found.where("NOT (starts AND ends)").withColumn("run", run)
    parts = broken.groupBy("file", "run").agg(F.sort_array(F.collect_list(F.struct("block", "ix", "text"))).alias("p"))
    joined = parts.select("file", F.col("p")[0]["block"].alias("block"), F.col("p")[0]["ix"].alias("ix"), F.array_join(F.col("p.text"), _SEPARATORS[kind]).alias("record"))
    return whole.unionByName(joined).where(F.trim(F.translate("record", "\t\r\n", "   ")) != "")


def read_json_array(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """``file, block, ix, body, payload``: each element of a file's array is a payload of its own, whatever the size of
    the file."""
    records = split_records(spark, path, "json").withColumnRenamed("record", "body")
    return records.withColumn("payload", F.try_parse_json("body"))


def read_csv_records(spark: SparkSession, path: str | Sequence[str], set_header: Sequence[str] = ()) -> DataFrame:
    """``file, block, ix, attrs, error_msg``: a sample for each record of CSV files, whose quoted fields may hold
    separators and line ends.

    The first record of a file is its header unless given. A record of another width ends its file: what stands before
    it are samples, and it gives a row with ``error_msg``.
    """
    records = split_records(spark, path, "csv").withColumn("record", F.regexp_replace("record", "\r$", ""))
    cells = records.select("file", "block", "ix", csv_fields(F.col("record")).alias("cells"))
    place = F.struct("block", "ix")
    if set_header:
        head = F.array(*[F.lit(h) for h in set_header])
        cells = cells.withColumn("head", head)
    else:
        # one row a file
        heads = cells.groupBy("file").agg(F.min_by("cells", place).alias("head"), F.min(place).alias("_at"))
        cells = cells.join(F.broadcast(heads), "file").where(place > F.col("_at")).drop("_at")
    fits = F.size("cells") == F.size("head")
    # one row a file, sent to the records: by file these would all meet in one task
    ends = cells.where(~fits).groupBy(F.col("file").alias("_f")).agg(F.min(place).alias("_end"))
    kept = cells.join(F.broadcast(ends), F.col("file") == F.col("_f"), "left").where(F.col("_end").isNull() | (place <= F.col("_end")))
    attrs = F.when(fits, F.map_from_arrays("head", "cells")).otherwise(maps.empty())
    error = F.when(~fits, F.lit("record with a wrong number of fields"))
    return kept.select("file", "block", "ix", attrs.alias("attrs"), error.alias("error_msg"))
