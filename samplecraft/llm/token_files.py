"""Token ids as binary shards: documents compressed one by one with a shared zstandard dictionary.

A shard is one binary value, written as a row of a Parquet table, so that Spark's writers commit it, on any store and
with lost tasks run again. Its layout, little-endian:

    magic "SCTOK1\\0", id width (1 byte: 2 or 4), SHA-256 of the dictionary (32 bytes)
    one zstandard frame a document, holding its ids
    index: for each document: has a key (uint8), key (int64), number of ids (uint64), offset of its frame (uint64)
    number of documents (uint64)

The dictionary is trained on the serialised id arrays of about ``SAMPLE_ROWS`` documents of at most ``SAMPLE_CHARS``
characters, picked by hash; where that is too little for training, frames use no dictionary. The index gives short
documents by themselves: ``ShardReader.ids(k)`` decompresses one frame.

Documents go in ascending key order (null first, equal keys by a hash of the text), or one that is given, over range partitions; a shard ends
after ``SHARD_BYTES`` of frames. ``start`` counts the ids of all documents before one.

Ids are those of ``Tokenizer.encode`` on the whole text. The tokenizer (byte-level BPE with the usual split pattern) cuts
text before a single space that stands between other characters, and between an ASCII letter and ASCII punctuation, so most
texts are cut there first, a bounded memory of pieces saves encoding the same again, and new pieces are encoded together.
Texts that hold a token which the tokenizer finds before it cuts (``<|endoftext|>``) are encoded whole.

Edge cases: null and empty texts have the end id only; repeated rows are documents of their own; an empty table gives
empty shards and an empty reading; extra columns play no part.
"""

from __future__ import annotations

import hashlib
import os
import re
import zlib
from collections.abc import Iterator, Sequence
from functools import lru_cache
from itertools import repeat

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from samplecraft.llm.common import bounded_sample, byte_class, give_back, materialise, slices, tasks_for, text_bytes

END_ID = 2
SHARD_BYTES = 8 << 20
SAMPLE_ROWS = 1024
SAMPLE_CHARS = 20_000
DICTIONARY_BYTES = 64 << 10
LEVEL = 3
#: Pieces of text whose ids a Python worker keeps.
KEPT_PIECES = 2_000_000
#: Documents for which there is a file of shards at least, where there are more range partitions than that.
FILE_DOCS = 2000

MAGIC = b"SCTOK1\0"
INDEX = np.dtype([("keyed", "u1"), ("key", "<i8"), ("ids", "<u8"), ("offset", "<u8")])
SHARDS = "part int, shard int, documents long, ids long, part_ids_before long, dictionary string, data binary"


#: White space next to a space, or at an end of the text: there the rule above does not say where to cut.
_ODD = re.compile(r" (?:\s|\Z|(?<=\s ))")
#: A run of letters ends before punctuation, whatever stands before or after.
_LETTER = byte_class((0x41, 0x5A), (0x61, 0x7A))
_PUNCTUATION = byte_class((0x21, 0x2F), (0x3A, 0x40), (0x5B, 0x60), (0x7B, 0x7E))


class Encoder:
    """Ids of texts as little-endian bytes."""

    def __init__(self, path: str, end_id: int, kept_pieces: int = KEPT_PIECES):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        vocabulary = self.tokenizer.get_vocab()
        #: Tokens that are found in the text before it is cut.
        self.added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.dtype = np.dtype("<u2" if max([end_id, *vocabulary.values()]) < 1 << 16 else "<u4")
        #: Bytes of text that a token stands for: the vocabulary writes each as one character.
        self.lengths = np.zeros(max(vocabulary.values()) + 1, np.int64)
        for token, k in vocabulary.items():
            self.lengths[k] = len(token)
        self.end = np.array([end_id], self.dtype).tobytes()
        self.kept_pieces = kept_pieces
        self.forget()

    def forget(self) -> None:
        """Keep no pieces; the tokenizer stays."""
        #: Number of each kept piece, whose ids are ``flat[at[k] : at[k + 1]]``.
        self.known: dict[bytes, int] = {}
        self.flat, self.at = np.zeros(1 << 16, self.dtype), np.zeros(1 << 16, np.int64)

    def _add(self, first: int, ids: np.ndarray, ends: np.ndarray) -> None:
        """Pieces from number ``first`` on, whose ids end at ``ends``."""
        start = int(self.at[first])
        while len(self.flat) < start + len(ids):
            self.flat = np.concatenate([self.flat, np.zeros_like(self.flat)])
        while len(self.at) < first + len(ends) + 1:
            self.at = np.concatenate([self.at, np.zeros_like(self.at)])
        self.flat[start : start + len(ids)] = ids
        self.at[first + 1 : first + 1 + len(ends)] = start + ends

    def _encode_words(self, first: int, words: list[bytes]) -> None:
        """Pieces that begin with a space, encoded as one text and cut where their bytes end."""
        for k in range(0, len(words), 16_384):
            part = words[k : k + 16_384]
            ids = np.array(self.tokenizer.encode_batch_fast([b"".join(part).decode()], add_special_tokens=False)[0].ids, self.dtype)
            ends = np.cumsum([len(w) for w in part])
            reached = np.cumsum(self.lengths[ids])
            cuts = np.minimum(np.searchsorted(reached, ends), len(ids) - 1)
            if not np.array_equal(reached[cuts], ends):
                raise ValueError("tokens do not end where pieces do")
            self._add(first + k, ids, cuts + 1)

    def _encode_texts(self, first: int, texts: list[bytes]) -> None:
        """Pieces that begin otherwise, and texts that are not cut, in one call."""
        found = [e.ids for e in self.tokenizer.encode_batch_fast([t.decode() for t in texts], add_special_tokens=False)]
        self._add(first, np.array([i for ids in found for i in ids], self.dtype), np.cumsum([len(ids) for ids in found]))

    def encode(self, texts: list[str]) -> list[bytes]:
        """A text is encoded whole where white space meets white space or a token is found before cutting, else by its
        pieces, which begin with the space before them or with punctuation. Each different piece of the texts is looked up once."""
        odd = np.array([t[:1] == " " or _ODD.search(t) is not None or any(a in t for a in self.added) for t in texts], bool)
        data, offsets = text_bytes(pa.array(texts, pa.large_string()).cast(pa.large_binary()))
        begins = data == 0x20
        begins[1:] |= _LETTER[data[:-1]] & _PUNCTUATION[data[1:]]
        for k in np.flatnonzero(odd).tolist():
            begins[offsets[k] : offsets[k + 1]] = False
        begins[offsets[offsets < len(data)]] = True
        bounds = np.append(np.flatnonzero(begins), len(data))
        pieces = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(bounds) - 1, [None, pa.py_buffer(bounds.astype(np.int64)), pa.py_buffer(data)])
        coded = pieces.dictionary_encode()
        different, which = coded.dictionary.to_pylist(), coded.indices.to_numpy()
        place = np.searchsorted(bounds, offsets)
        whole = np.zeros(len(different), bool)
        whole[which[place[:-1][np.diff(offsets) > 0]]] = True  # first pieces, odd texts among them
        number = np.fromiter(map(self.known.get, different, repeat(-1)), np.int64, len(different))
        missing = np.flatnonzero(number < 0)
        spaced = np.array([different[k][:1] == b" " for k in missing.tolist()], bool)
        first = whole[missing]
        words, others = missing[spaced & ~first], np.concatenate([missing[~spaced & ~first], missing[first]])
        kept, new = len(self.known), np.concatenate([words, others[: len(missing) - len(words) - first.sum()]])
        for part, encode in ((words, self._encode_words), (others, self._encode_texts)):
            if len(part):
                encode(kept + (len(words) if part is others else 0), [different[k] for k in part.tolist()])
        number[words], number[others] = kept + np.arange(len(words)), kept + len(words) + np.arange(len(others))
        if kept + len(new) <= self.kept_pieces:
            self.known.update(zip((different[k] for k in new.tolist()), range(kept, kept + len(new)), strict=True))
        number = number[which]
        sizes = self.at[number + 1] - self.at[number]
        until = np.concatenate([[0], np.cumsum(sizes)])
        ids = self.flat[np.arange(until[-1]) + np.repeat(self.at[number] - until[:-1], sizes)].tobytes()
        width = self.dtype.itemsize
        ends = (until[place] * width).tolist()
        return [ids[x:y] + self.end for x, y in zip(ends, ends[1:])]


# A tokenizer that has encoded gives some MB less back than it took, so a worker makes one and not one for each task.
@lru_cache(maxsize=2)
def encoder(path: str, end_id: int, kept_pieces: int) -> Encoder:
    return Encoder(path, end_id, kept_pieces)


class ShardWriter:
    def __init__(self, width: int, dictionary: bytes):
        self.head = MAGIC + bytes([width]) + hashlib.sha256(dictionary).digest()
        self.width, self.size, self.frames, self.index = width, len(self.head), [], []
        shared = zstandard.ZstdCompressionDict(dictionary) if dictionary else None
        if shared:
            shared.precompute_compress(level=LEVEL)
        self.compressor = zstandard.ZstdCompressor(level=LEVEL, dict_data=shared)

    def add(self, key: int | None, ids: bytes) -> None:
        frame = self.compressor.compress(ids)
        self.index.append((key is not None, key or 0, len(ids) // self.width, self.size))
        self.frames.append(frame)
        self.size += len(frame)

    def take(self) -> tuple[int, int, bytes]:
        """(documents, ids, bytes) of the shard; the next one begins."""
        index = np.array(self.index, INDEX)
        data = b"".join([self.head, *self.frames, index.tobytes(), len(index).to_bytes(8, "little")])
        self.size, self.frames, self.index = len(self.head), [], []
        return len(index), int(index["ids"].sum()), data


class ShardReader:
    def __init__(self, data: bytes | memoryview, dictionary: bytes):
        data = memoryview(data).cast("B")
        if data[: len(MAGIC)] != MAGIC:
            raise ValueError("not a token shard")
        self.dtype = np.dtype("<u2" if data[len(MAGIC)] == 2 else "<u4")
        if data[len(MAGIC) + 1 : len(MAGIC) + 33] != hashlib.sha256(dictionary).digest():
            raise ValueError("the shard was written with another dictionary")
        n = int.from_bytes(data[-8:], "little")
        self.frames_end = len(data) - 8 - n * INDEX.itemsize
        self.index = np.frombuffer(data, INDEX, n, self.frames_end)
        self.ends = np.append(self.index["offset"][1:], np.uint64(self.frames_end))
        self.data = data
        shared = zstandard.ZstdCompressionDict(dictionary) if dictionary else None
        self.decompressor = zstandard.ZstdDecompressor(dict_data=shared)

    def __len__(self) -> int:
        return len(self.index)

    def key(self, k: int) -> int | None:
        return int(self.index["key"][k]) if self.index["keyed"][k] else None

    def ids(self, k: int) -> np.ndarray:
        raw = self.decompressor.decompress(self.data[int(self.index["offset"][k]) : int(self.ends[k])])
        return np.frombuffer(raw, self.dtype)


def train_dictionary(docs: DataFrame, path: str, column: str = "text", key: str = "doc_id", end_id: int = END_ID) -> bytes:
    """A dictionary from a bounded sample; empty where there is too little to learn from."""
    sample = bounded_sample(docs.where(F.length(column) <= SAMPLE_CHARS).select(key, column), key, SAMPLE_ROWS)
    samples = Encoder(path, end_id).encode([r[column] for r in sample.collect()])
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, samples, level=LEVEL).as_bytes()
    except zstandard.ZstdError:
        return b""


def write_shards(
    docs: DataFrame,
    path: str,
    dictionary: bytes,
    column: str = "text",
    key: str = "doc_id",
    end_id: int = END_ID,
    kept_pieces: int = KEPT_PIECES,
    order: Sequence[Column] = (),
    stay: bool = True,
) -> DataFrame:
    """Rows of ``SHARDS``, in order of ``part`` and ``shard``; ``part_ids_before`` are the ids of earlier shards of the part."""
    name = hashlib.sha256(dictionary).hexdigest()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # a task has one core; each thread would hold memory
        part, enc, count, before = 0, encoder(path, end_id, kept_pieces), 0, 0
        writer = ShardWriter(enc.dtype.itemsize, dictionary)

        def row() -> pa.RecordBatch:
            nonlocal count, before
            documents, ids, data = writer.take()
            values = [part, count, documents, ids, before, name]
            types = [pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.string()]
            names = ["part", "shard", "documents", "ids", "part_ids_before", "dictionary", "data"]
            count, before = count + 1, before + ids
            ends = pa.py_buffer(np.array([0, len(data)], np.int32))
            shard = pa.BinaryArray.from_buffers(pa.binary(), 1, [None, ends, pa.py_buffer(data)])  # not copied
            return pa.RecordBatch.from_arrays([*(pa.array([v], t) for v, t in zip(values, types, strict=True)), shard], names=names)

        for batch in slices(batches, "text"):
            texts = ["" if t is None else t for t in batch.column(1).to_pylist()]
            part = batch.column(2)[0].as_py()
            for k, ids in zip(batch.column(0).to_pylist(), enc.encode(texts), strict=True):
                writer.add(k, ids)
                if writer.size >= SHARD_BYTES:
                    yield row()
        if writer.index:
            yield row()
        if not stay:
            enc.forget()
            del writer
            give_back()

    named = [c.alias(f"o{i}") for i, c in enumerate(order)]
    narrow = docs.select(F.col(key).cast("long").alias("key"), F.col(column).alias("text"), *named)
    places = [F.col(f"o{i}") for i in range(len(named))] or [F.col("key"), F.xxhash64("key", "text")]
    ordered = narrow.repartitionByRange(*places).sortWithinPartitions(*places).select("key", "text", F.spark_partition_id().alias("part"))
    return ordered.mapInArrow(run, SHARDS)


def read_shards(shards: DataFrame, dictionary: bytes, key: str = "doc_id") -> DataFrame:
    """A row a document from the shards: key, ``start``, ``n_tokens`` and ``ids_crc32`` (ids as 32-bit values)."""
    parts = shards.groupBy("part").agg(F.sum("ids").alias("ids"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select("part", F.coalesce(F.sum("ids").over(before), F.lit(0)).alias("part_start"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for data, start in zip(batch.column(0), batch.column(1).to_pylist(), strict=True):
                reader = ShardReader(memoryview(data.as_buffer()), dictionary)
                n, crc = np.zeros(len(reader), np.int64), np.zeros(len(reader), np.int64)
                for k in range(len(reader)):  # one document's ids at a time
                    ids = reader.ids(k)
                    n[k], crc[k] = len(ids), zlib.crc32(ids.astype("<u4"))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([reader.key(k) for k in range(len(reader))], pa.int64()),
                        pa.array(start + np.cumsum(n) - n),
                        pa.array(n),
                        pa.array(crc),
                    ],
                    names=[key, "start", "n_tokens", "ids_crc32"],
                )
        give_back()

    # ``parts`` has one row for each task of the writing job, so both the window and the broadcast are bounded by that.
    located = shards.select("part", "part_ids_before", "data").join(F.broadcast(parts), "part")
    located = located.select("data", (F.col("part_start") + F.col("part_ids_before")).alias("start"))
    return located.mapInArrow(run, f"`{key}` long, start long, n_tokens long, ids_crc32 long")


def encode_documents(
    spark: SparkSession,
    docs: DataFrame,
    path: str,
    column: str = "text",
    key: str = "doc_id",
    kept_pieces: int = KEPT_PIECES,
    order: Sequence[Column] = (),
    stay: bool = True,
) -> DataFrame:
    """Write ``docs`` as shards into the shared folder and read them back. ``kept_pieces`` bounds what a Python worker
    keeps from task to task, some 170 bytes a piece; without ``stay`` it keeps nothing but the tokenizer beyond a task. ``order`` is another one than by key."""
    dictionary = train_dictionary(docs, path, column, key)
    shards = write_shards(docs, path, dictionary, column, key, kept_pieces=kept_pieces, order=order, stay=stay)
    # A file may hold shards of several range partitions, each of which knows its own number.
    shards = materialise(shards, files=tasks_for(spark, docs.count(), FILE_DOCS))
    return read_shards(shards, dictionary, key)
