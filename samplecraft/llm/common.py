"""Helpers shared by the operators: shared-folder tables, Arrow text buffers, vectorised words and their hashes."""

from __future__ import annotations

import contextlib
import ctypes
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

U64 = np.uint64


def shared_folder(spark: SparkSession) -> str:
    """A new folder below ``spark.checkpoint.dir``, which the driver and all executors share.

    Where the setting is absent, as in tests on one machine, a folder of this machine is used; on a cluster the
    setting is required.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        root = f"/tmp/samplecraft-{spark.sparkContext.applicationId}"
        spark.conf.set("spark.checkpoint.dir", root)
    return f"{root.rstrip('/')}/llm-{uuid.uuid4().hex}"


#: Small rows that one task writes at least, where their number is known.
FILE_ROWS = 100_000


def files_for(rows: int) -> int:
    """Files for so many small rows."""
    return max(1, -(-rows // FILE_ROWS))


def tasks_for(spark: SparkSession, rows: int, each: int) -> int:
    """Tasks that write a table made from so many rows: some for each core, and one for ``each`` rows at least. More
    partitions than that only make small files."""
    return max(2 * spark.sparkContext.defaultParallelism, -(-rows // each))


def materialise(df: DataFrame, partitions: int | None = None, files: int | None = None) -> DataFrame:
    """Write ``df`` as a Parquet table in the shared folder and read it back: lineage is cut, and a lost executor
    costs nothing that was written. The table stays until the owner of the folder clears it after the run.

    ``files`` bounds the files of small tables: on a local file system each costs several processes that the executor
    starts to set permissions, and a start counts the executor's memory twice for a moment.
    """
    spark, path = df.sparkSession, shared_folder(df.sparkSession)
    df = df.coalesce(files) if files else df
    df.write.option("compression", "zstd").parquet(path)
    give_back()
    back = spark.read.schema(df.schema).parquet(path)
    return back.repartition(partitions) if partitions else back


def bounded_sample(df: DataFrame, key: str, rows: int) -> DataFrame:
    """About ``rows`` rows (at most twice as many) chosen by a hash of ``key``: the same ones on each run."""
    total = df.count()
    if total <= rows:
        return df
    share = int(rows / total * 2**31)
    return df.where(F.pmod(F.xxhash64(F.lit(7), key), F.lit(2**31)) < F.lit(share)).limit(2 * rows)


def sharable(array: pa.Array) -> pa.Array:
    """A text column as large binary, nulls as empty values."""
    if isinstance(array, pa.ChunkedArray):
        array = array.combine_chunks()
    array = array.cast(pa.large_binary()) if not pa.types.is_large_binary(array.type) else array
    return array.fill_null(b"") if array.null_count else array


def text_bytes(array: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a text column end to end, and where each row starts (one more entry than rows)."""
    array = sharable(array)
    if not len(array):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offs, data = array.buffers()
    offsets = np.frombuffer(offs, np.int64)[array.offset : array.offset + len(array) + 1]
    if data is None or offsets[0] == offsets[-1]:
        return np.zeros(0, np.uint8), np.zeros(len(array) + 1, np.int64)
    return np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]], offsets - offsets[0]


def give_back() -> None:
    """Return what the C library and Arrow hold of freed memory, and the powers kept for hashes, so that idle workers,
    and the driver between jobs, do not weigh on other stages."""
    _POWERS.clear()
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # another C library has no such call
        ctypes.CDLL(None).malloc_trim(0)


def slices(batches: Iterator[pa.RecordBatch], column: str, most: int = 1 << 20) -> Iterator[pa.RecordBatch]:
    """Cut batches so that the text of a piece has about ``most`` bytes, one row at least. Ends with ``give_back``."""
    for batch in batches:
        if not batch.num_rows:
            continue
        array = sharable(batch.column(batch.schema.get_field_index(column)))
        ends = np.frombuffer(array.buffers()[1], np.int64)[array.offset : array.offset + len(array) + 1]
        at = 0
        while at < batch.num_rows:
            upto = int(np.searchsorted(ends, ends[at] + most, side="right")) - 1
            upto = min(max(upto, at + 1), batch.num_rows)
            yield batch.slice(at, upto - at)
            at = upto
    give_back()


def byte_class(*ranges: tuple[int, int]) -> np.ndarray:
    """A table of 256 flags, true within the inclusive ranges."""
    out = np.zeros(256, bool)
    for low, high in ranges:
        out[low : high + 1] = True
    return out


#: `[^\x20\x09-\x0D]+`
UNSPACED = ~byte_class((0x20, 0x20), (0x09, 0x0D))
#: `[^\x00-\x2F\x3A-\x60\x7B-\x7F]+` after A-Z became a-z
ALNUM = byte_class((0x30, 0x39), (0x61, 0x7A), (0x80, 0xFF))

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def lower_ascii(data: np.ndarray) -> np.ndarray:
    return _LOWER[data]


def find_words(data: np.ndarray, offsets: np.ndarray, table: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the maximal runs of flagged bytes, which never cross rows, and for each row the number
    of words before it (one more entry than rows)."""
    if not len(data):
        none = np.zeros(0, np.int64)
        return none, none, np.zeros(len(offsets), np.int64)
    flag = table[data]
    starts, ends = flag.copy(), flag.copy()
    starts[1:] &= ~flag[:-1]
    ends[:-1] &= ~flag[1:]
    inner = offsets[(offsets > 0) & (offsets < len(data))]
    starts[inner] |= flag[inner]
    ends[inner - 1] |= flag[inner - 1]
    first = np.flatnonzero(starts)
    return first, np.flatnonzero(ends) + 1, np.searchsorted(first, offsets)


_BASE, _INVERSE = 0x9E3779B97F4A7C15, pow(0x9E3779B97F4A7C15, -1, 1 << 64)
_POWERS: dict[str, np.ndarray] = {}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd base and of its inverse modulo 2^64, kept for the next call of a task."""
    if "up" not in _POWERS or len(_POWERS["up"]) < n:
        size = 1 << max(16, int(n - 1).bit_length())
        for name, base in (("up", _BASE), ("down", _INVERSE)):
            p = np.full(size, base, U64)
            p[0] = 1
            _POWERS[name] = np.cumprod(p, dtype=U64)
    return _POWERS["up"], _POWERS["down"]


def mix(h: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values."""
    h = h ^ (h >> U64(30))
    h = h * U64(0xBF58476D1CE4E5B9)
    h = h ^ (h >> U64(27))
    h = h * U64(0x94D049BB133111EB)
    return h ^ (h >> U64(31))


#: One random-looking 64-bit value per byte value.
_BYTE = mix(np.arange(1, 257, dtype=U64) * U64(0xD1342543DE82EF95))


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of byte spans, by prefix sums of a polynomial: equal bytes give equal hashes."""
    if not len(starts):
        return np.zeros(0, U64)
    up, down = _powers(len(data) + 1)
    sums = np.empty(len(data) + 1, U64)
    sums[0] = 0
    np.cumsum(_BYTE[data] * up[: len(data)], dtype=U64, out=sums[1:])
    return mix((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(U64))


def window_hashes(words: np.ndarray, size: int) -> np.ndarray:
    """Hash of each window of ``size`` word hashes, one for each word that begins one."""
    n = len(words) - size + 1
    if n <= 0:
        return np.zeros(0, U64)
    out = np.full(n, size, U64)
    for k in range(size):
        out *= U64(0x9E3779B97F4A7C15)
        out += words[k : k + n]
    return mix(out)


def pack(values: np.ndarray, offsets: np.ndarray) -> pa.Array:
    """Rows of fixed-width values as binary."""
    width = values.dtype.itemsize
    return pa.LargeBinaryArray.from_buffers(
        pa.large_binary(), len(offsets) - 1, [None, pa.py_buffer((offsets * width).astype(np.int64)), pa.py_buffer(np.ascontiguousarray(values))]
    ).cast(pa.binary())


def ragged(values: np.ndarray, offsets: np.ndarray) -> pa.Array:
    """Rows of values as lists."""
    return pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(values))



def spaced(data: np.ndarray, first: np.ndarray, last: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of words end to end, each followed by one blank, and where each word starts (one more entry than
    words)."""
    lengths = last - first + 1
    at = np.concatenate([[0], np.cumsum(lengths)])
    take = np.arange(at[-1]) + np.repeat(first - at[:-1], lengths)
    blanks = at[1:] - 1
    take[blanks] = 0
    out = data[take] if len(data) else np.zeros(0, np.uint8)
    out[blanks] = 0x20
    return out, at
