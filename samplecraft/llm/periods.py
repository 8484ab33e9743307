"""Periodic runs of words, found online by catchers over completed power-of-two blocks.

A run is a stretch of consecutive words `[^\\x20\\x09-\\x0D]+` with smallest period q and at least ``max(least, 2 * q)``
words that no neighbour extends keeping the period.

For each power of two b, every aligned block of b words that is complete has a catcher, awake while the text's end is
2b - 1 to 4b - 2 words further on: exactly two catchers a level. Each appended word completes one suffix of b words,
which is compared with the blocks of both, by hashes built up from the two halves. A square of period p holds, in its first half,
a whole block of the level whose distances include p, so one of its catchers meets the block again at distance p.
Meetings at one distance in neighbouring blocks belong together; they are extended by descending block sizes to the
first words that differ. What reaches the end of the text so far stays open and goes on with the words appended next;
what is closed and two periods long is compared word by word and merges into the runs. Meetings inside a known run at
a multiple of its period are part of it and are left out, so that runs of runs cost no more than words.

Words arrive in arrays; how they are cut into appended arrays changes nothing. The texts of a batch follow each other in one
catcher, parted by words that occur nowhere else. Memory is 8 bytes a word and level of the texts at hand (about one
MiB of text, or one longer text, with log2 of the words of its longest less one levels). Words are numbered exactly, and hashes only
propose; every run was compared in words.

Edge cases: null, empty and wordless texts have no runs and collapse to the empty text; repeated rows keep their rows;
an empty table gives an empty result; extra columns play no part.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from samplecraft.llm.common import U64, UNSPACED, find_words, mix, slices, spaced, text_bytes

#: Words of the shortest run.
LEAST = 12


class Catchers:
    """Catches squares in words (numbers) as they are appended, and merges them into runs."""

    def __init__(self, least: int = LEAST) -> None:
        self.least, self.n = least, 0
        self._hashes = [np.zeros(1024, U64)]  # of the windows of 1, 2, 4, ... words, by their first word
        self._full = [0]
        none = np.zeros(0, np.int64)
        self._open = (none, none)  # first words and periods of stretches that reach the end, by period
        self._runs = (none, none, none)  # first word, end, period, by first word

    def append(self, words: np.ndarray, longest: int) -> None:
        """``longest``: words of the longest text up to and with these; longer squares cannot occur."""
        old, self.n = self.n, self.n + len(words)
        if not len(words):
            return
        self._room(0)
        self._hashes[0][old : self.n] = mix(words.astype(U64) + U64(1))
        self._go_on(old)
        level = 0
        while 2 * (1 << level) - 1 <= longest // 2:
            self._advance(level)
            level += 1

    def runs(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """First words, lengths and periods of all runs, those at the end included, by first word and period."""
        start, period = self._open
        self._keep(start, np.full(len(start), self.n), period)
        start, end, period = self._runs
        return start, end - start, period

    def _room(self, level: int) -> None:
        held = self._hashes[level]
        if len(held) < self.n:
            self._hashes[level] = np.concatenate([held[: self._full[level] if level else len(held)], np.zeros(2 * self.n, U64)])

    def _go_on(self, old: int) -> None:
        """Stretches that reached the old end go on while the new words keep their periods."""
        start, period = self._open
        end = np.full(len(start), self.n)
        word = self._hashes[0]
        for k, p in enumerate(period.tolist()):
            at, step = old, 64
            while at < self.n:
                upto = min(at + step, self.n)
                other = np.flatnonzero(word[at:upto] != word[at - p : upto - p])
                if len(other):
                    end[k] = at + int(other[0])
                    break
                at, step = upto, 2 * step
        self._settle(start, end, period)

    def _settle(self, start: np.ndarray, end: np.ndarray, period: np.ndarray) -> None:
        """Closed stretches become runs, the others stay open."""
        reach = end == self.n
        order = np.argsort(period[reach], kind="stable")
        self._open = (start[reach][order], period[reach][order])
        self._keep(start[~reach], end[~reach], period[~reach])

    def _advance(self, level: int) -> None:
        """The level's windows that the new words completed meet the blocks of its two catchers."""
        b = 1 << level
        if level == len(self._hashes):
            self._hashes.append(np.zeros(0, U64))
            self._full.append(0)
        self._room(level)
        held, low, high = self._hashes[level], self._full[level], max(self.n - b + 1, 0)
        if high <= low:
            return
        if level:
            half = self._hashes[level - 1]
            held[low:high] = mix(half[low:high] * U64(0x9E3779B97F4A7C15) + (half[low + b // 2 : high + b // 2] ^ U64(level)))
        self._full[level] = high
        blocks, distances = [], []
        window = np.arange(max(low, 2 * b - 1), high)
        nearest = (window - (2 * b - 1)) & -b
        for back in (0, b):
            block = nearest - back
            hit = (held[block] == held[window]) & (block >= 0)
            blocks.append(block[hit])
            distances.append((window - block)[hit])
        self._meet(level, np.concatenate(blocks), np.concatenate(distances))

    def _meet(self, level: int, block: np.ndarray, p: np.ndarray) -> None:
        """Merge meetings of neighbouring blocks into stretches and extend these to both sides."""
        b = 1 << level
        new = ~self._known(level, block, block + p + b, p)
        block, p = block[new], p[new]
        if not len(block):
            return
        order = np.lexsort((block, p))
        block, p = block[order], p[order]
        first = np.concatenate([[True], (p[1:] != p[:-1]) | (block[1:] != block[:-1] + b)])
        last = np.concatenate([first[1:], [True]])
        start, end, p = block[first], block[last] + b + p[last], p[first]
        # Extension is by less than a block on each side, as the neighbouring blocks did not meet.
        hope = (end - start + 2 * (b - 1) >= np.maximum(self.least, 2 * p)) | (end + b > self.n)
        start, end, p = start[hope], end[hope], p[hope]
        for k in range(level - 1, -1, -1):
            size, held = 1 << k, self._hashes[k]
            room = start >= size
            at = np.where(room, start - size, 0)
            start = np.where(room & (held[at] == held[at + p]), start - size, start)
            room = end + size <= self.n
            at = np.where(room, end, p)
            end = np.where(room & (held[at] == held[at - p]), end + size, end)
        reach = end == self.n
        self._keep(start[~reach], end[~reach], p[~reach])
        both = np.concatenate([self._open[0], start[reach]]), np.concatenate([self._open[1], p[reach]])
        order = np.argsort(both[1], kind="stable")
        self._open = (both[0][order], both[1][order])

    def _known(self, level: int, start: np.ndarray, end: np.ndarray, p: np.ndarray) -> np.ndarray:
        """Whether a meeting is inside a run or an open stretch of its period, or a run at a multiple of its period."""
        out = np.zeros(len(start), bool)
        firsts, periods = self._open
        if len(firsts):
            at = np.minimum(np.searchsorted(periods, p), len(periods) - 1)
            out |= (periods[at] == p) & (firsts[at] <= start)
        firsts, ends, periods = self._runs
        # Of runs with periods below the level's only one can cover the meeting if any is at a multiple of its period:
        # two would share more words than their periods sum up to. It is the one that ends last.
        less = periods < (2 << level)
        if less.any():
            first, last, q = firsts[less], ends[less], periods[less]
            furthest = np.maximum.accumulate(np.where(last == np.maximum.accumulate(last), np.arange(len(last)), 0))
            at = np.searchsorted(first, start, side="right") - 1
            run = furthest[np.maximum(at, 0)]
            out |= (at >= 0) & (last[run] >= end) & (p % q[run] == 0)
        # Nor do two runs of one period share as many words.
        if len(firsts):
            order = np.lexsort((firsts, periods))
            place = periods[order] * (self.n + 1) + firsts[order]
            at = np.searchsorted(place, p * (self.n + 1) + start, side="right") - 1
            run = order[np.maximum(at, 0)]
            out |= (at >= 0) & (periods[run] == p) & (ends[run] >= end)
        return out

    def _keep(self, start: np.ndarray, end: np.ndarray, p: np.ndarray) -> None:
        """Stretches that are long enough, compared word by word, join the runs; of equal ones that of the smallest
        period stays."""
        word, found = self._hashes[0], []
        enough = end - start >= np.maximum(self.least, 2 * p)
        for a, e, q in zip(start[enough].tolist(), end[enough].tolist(), p[enough].tolist(), strict=True):
            same = np.flatnonzero(word[a : e - q] != word[a + q : e])  # none, but for equal hashes of unlike windows
            cuts = [a - 1, *(a + same).tolist(), e - q]
            found += [(x + 1, y + q, q) for x, y in zip(cuts, cuts[1:]) if y + q - x - 1 >= max(self.least, 2 * q)]
        if not found:
            return
        new = np.array(found, np.int64)
        every = np.concatenate([np.stack(self._runs, axis=1), new])
        every = every[np.lexsort((every[:, 2], every[:, 1], every[:, 0]))]
        one = np.concatenate([[True], (every[1:, :2] != every[:-1, :2]).any(axis=1)])
        every = every[one]
        every = every[np.lexsort((every[:, 2], every[:, 0]))]
        self._runs = tuple(np.ascontiguousarray(every[:, k]) for k in range(3))


def _numbers(text: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Equal numbers for equal words, given end to end and each followed by a blank."""
    words = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(at) - 1, [None, pa.py_buffer(at.astype(np.int64)), pa.py_buffer(text)])
    return words.dictionary_encode().indices.to_numpy().astype(np.int64)


def _runs_of(numbers: np.ndarray, before: np.ndarray, least: int) -> tuple[np.ndarray, ...]:
    """Rows, first words (in the row), lengths and periods of the runs of all rows, by row, first word and period."""
    n = np.diff(before)
    rows = np.arange(len(n))
    # A word of its own after each text.
    home = before + np.arange(len(before))
    line = np.empty(len(numbers) + len(n), np.int64)
    line[np.arange(len(numbers)) + np.repeat(rows, n)] = numbers
    line[home[1:] - 1] = len(numbers) + rows
    catchers = Catchers(least)
    catchers.append(line, int(n.max(initial=0)))
    start, length, period = catchers.runs()
    row = np.searchsorted(home, start, side="right") - 1
    return row, start - home[row], length, period


def _collapsed(text: np.ndarray, at: np.ndarray, before: np.ndarray, runs: tuple[np.ndarray, ...]) -> pa.Array:
    """The texts without the words that a run contains after its first period, joined by one blank."""
    row, start, length, period = runs
    edge = np.zeros(len(at), np.int64)
    np.add.at(edge, before[row] + start + period, 1)
    np.add.at(edge, before[row] + start + length, -1)
    kept = np.cumsum(edge[:-1]) == 0
    sizes = np.where(kept, np.diff(at), 0)
    ends = np.concatenate([[0], np.cumsum(sizes)])[before]
    out = text[np.repeat(kept, np.diff(at))].tobytes()
    bounds = ends.tolist()
    return pa.array([out[a : b - 1] if b > a else b"" for a, b in zip(bounds, bounds[1:])], pa.binary()).cast(pa.string())


def find(docs: DataFrame, column: str = "text", key: str = "doc_id", least: int = LEAST) -> DataFrame:
    """A row a document: key, ``runs`` (array of ``start, length, period`` in words, by start, then period) and
    ``collapsed``, the text with each run cut to its first period."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            data, offsets = text_bytes(batch.column(1))
            first, last, before = find_words(data, offsets, UNSPACED)
            text, at = spaced(data, first, last)
            found = _runs_of(_numbers(text, at), before, least)
            bounds = np.searchsorted(found[0], np.arange(batch.num_rows + 1))
            rows = pa.StructArray.from_arrays([pa.array(c) for c in found[1:]], names=["start", "length", "period"])
            lists = pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), rows)
            yield pa.RecordBatch.from_arrays([batch.column(0), lists, _collapsed(text, at, before, found)], names=["id", "runs", "collapsed"])

    kind = docs.schema[key].dataType.simpleString()
    docs = docs.select(F.col(f"`{key}`").alias("id"), F.col(f"`{column}`").cast("string").alias("text"))
    out = docs.mapInArrow(run, f"id {kind}, runs array<struct<start:bigint,length:bigint,period:bigint>>, collapsed string")
    return out.withColumnRenamed("id", key)
