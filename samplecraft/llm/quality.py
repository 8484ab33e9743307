"""Quality classifier: support vectors on n-gram indicators scaled by Naive Bayes log-count ratios.

Tokens are runs of letters (with all non-ASCII characters), digits, or one kind of other visible character. Indicators
are hashed into ``BUCKETS``: tokens and token pairs in lower case, and runs of one to three token shapes (capitals,
capitalised, lower case, digits, which mark; whether the token repeats the last one).

1. Training uses at most about ``TRAIN_ROWS`` labelled documents, picked among the labels by a hash of the id. As their
   ids are bounded, they are broadcast, and no text is ever shuffled, whatever the size of either table. For each bucket
   the documents of each class that have it are counted, by task first; the smoothed log ratio of the two class shares
   is the bucket's scale.
2. The hinge-loss model is fitted by dual coordinate descent to about ``FIT_ROWS`` of these documents. A sigmoid turns
   margins into scores: margin 0, where the model is undecided, becomes ``THRESHOLD``; the slope is fitted.
3. All documents are scored in one pass, without a shuffle; the model (``BUCKETS`` numbers) is broadcast.

Edge cases: null, empty and wordless texts have no indicators and get the score of the intercept; documents without a
label, or with one other than 0 and 1, are not trained on; repeated labels count each; without both classes every
score is the share of label 1 (0.5 without labels). Columns added here replace columns of the same name.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from samplecraft.llm.common import U64, bounded_sample, byte_class, lower_ascii, materialise, mix, slices, span_hashes, text_bytes

BUCKETS = 1 << 18
TRAIN_ROWS = 16_000
FIT_ROWS = 4000
EPOCHS = 30
COST = 1.0
#: Bytes of text whose indicators a Python worker holds at once.
SLICE_BYTES = 1 << 19
SMOOTH = 1.0
THRESHOLD = 0.3

_SPACE = ~byte_class((0x21, 0xFF)) | byte_class((0x7F, 0x7F))
_LETTER = byte_class((65, 90), (97, 122), (0x80, 0xFF))
_DIGIT = byte_class((48, 57))
#: Kind of a byte: 0 space, 1 letter, 2 digit, else the byte itself.
_KIND = np.where(_SPACE, 0, np.where(_LETTER, 1, np.where(_DIGIT, 2, np.arange(256)))).astype(np.uint8)
_UPPER = byte_class((65, 90))


def indicators(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct buckets of each row, end to end, and where each row starts."""
    rows = len(offsets) - 1
    if not len(data):
        return np.zeros(0, np.int64), np.zeros(rows + 1, np.int64)
    kind = _KIND[data]
    edge = np.ones(len(data), bool)
    edge[1:] = kind[1:] != kind[:-1]
    edge[offsets[:-1][offsets[:-1] < len(data)]] = True
    starts = np.flatnonzero(edge)
    ends = np.append(starts[1:], len(data))
    seen = kind[starts] != 0
    starts, ends = starts[seen], ends[seen]
    row = np.searchsorted(offsets, starts, side="right") - 1
    word = span_hashes(lower_ascii(data), starts, ends)
    uppers = np.concatenate([[0], np.cumsum(_UPPER[data])])
    n_upper = uppers[ends] - uppers[starts]
    code = kind[starts].astype(np.int64)
    letters = code == 1
    shape = np.where(letters, np.where((n_upper > 1) & (n_upper * 2 >= ends - starts), 260, np.where(n_upper > 0, 259, 258)), code)
    shape = shape * 2
    shape[1:] += (word[1:] == word[:-1]) & (row[1:] == row[:-1])
    shape = mix(shape.astype(U64) + U64(1))
    out = [(row, mix(word + U64(11)))]
    for values, width, seed in ((word, 2, 12), (shape, 1, 21), (shape, 2, 22), (shape, 3, 23)):
        n = len(values) - width + 1
        if n <= 0:
            continue
        h = np.full(n, seed, U64)
        for k in range(width):
            h = mix(h * U64(0x9E3779B97F4A7C15) + values[k : k + n])
        same = row[:n] == row[width - 1 :]
        out.append((row[:n][same], h[same]))
    where = np.concatenate([r for r, _ in out])
    bucket = (np.concatenate([h for _, h in out]) % U64(BUCKETS)).astype(np.int64)
    joint = np.unique(where * BUCKETS + bucket)
    return joint % BUCKETS, np.searchsorted(joint // BUCKETS, np.arange(rows + 1))


def _rows(batch: pa.RecordBatch, column: str) -> tuple[np.ndarray, np.ndarray]:
    return indicators(*text_bytes(batch.column(batch.schema.get_field_index(column))))


@dataclass
class Model:
    """``weights`` already hold the scales; score = sigmoid(slope * (weights . indicators + intercept) + offset)."""

    weights: np.ndarray
    intercept: float
    slope: float
    offset: float

    def scores(self, buckets: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        # The scaled vectors are brought to length one when fitting, so the margin is divided by the same length.
        sums = np.concatenate([[0.0], np.cumsum(self.weights[0][buckets])])
        squares = np.concatenate([[0.0], np.cumsum(self.weights[1][buckets])])
        length = np.sqrt(np.maximum(squares[offsets[1:]] - squares[offsets[:-1]], 1e-12))
        margin = (sums[offsets[1:]] - sums[offsets[:-1]]) / length + self.intercept
        return 1 / (1 + np.exp(-np.clip(self.slope * margin + self.offset, -30, 30)))


def gather(docs: DataFrame, labels: DataFrame, column: str, label: str, key: str) -> DataFrame:
    """What training needs, in one pass over the documents, as a table in the shared folder: partial counts
    (``bucket, c0, c1``), and the indicators of the rows to fit (``order, positive, indicators``)."""
    labels = labels.where(F.col(label).isin(0, 1) & F.col(key).isNotNull()).select(F.col(key).alias("key"), (F.col(label) == 1).alias("positive"))
    rows = max(1, min(labels.count(), TRAIN_ROWS))
    labels = bounded_sample(labels, "key", TRAIN_ROWS)
    picked = F.pmod(F.xxhash64(F.lit(9), "key"), F.lit(rows)) < F.lit(FIT_ROWS)
    rows = docs.select(F.col(key).alias("key"), F.col(column).alias("text")).join(F.broadcast(labels), "key")
    rows = rows.select("text", "positive", picked.alias("picked"), F.xxhash64("key", "text").alias("order"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["bucket", "c0", "c1", "order", "positive", "indicators"]
        types = [pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.bool_(), pa.binary()]
        counts = np.zeros((2, BUCKETS), np.int64)
        for batch in slices(batches, "text", SLICE_BYTES):
            buckets, offsets = _rows(batch, "text")
            positive = np.array(batch.column(1).to_pylist(), bool)
            of = np.repeat(positive, np.diff(offsets))
            for k in (0, 1):
                counts[k] += np.bincount(buckets[of == bool(k)], minlength=BUCKETS)
            chosen = np.flatnonzero(np.array(batch.column(2).to_pylist(), bool))
            if len(chosen):
                vectors = [buckets[offsets[k] : offsets[k + 1]].astype(np.int32).tobytes() for k in chosen]
                empty = [pa.nulls(len(chosen), t) for t in types[:3]]
                yield pa.RecordBatch.from_arrays([*empty, batch.column(3).take(pa.array(chosen)), pa.array(positive[chosen]), pa.array(vectors, pa.binary())], names=names)
        at = np.flatnonzero(counts.any(axis=0))
        empty = [pa.nulls(len(at), t) for t in types[3:]]
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(counts[0][at]), pa.array(counts[1][at]), *empty], names=names)

    return materialise(rows.mapInArrow(run, "bucket int, c0 long, c1 long, order long, positive boolean, indicators binary"))


def log_count_ratios(gathered: DataFrame) -> np.ndarray:
    """The scale of each bucket, from the counts of all training documents."""
    summed = gathered.where("bucket is not null").groupBy("bucket").agg(F.sum("c0").alias("c0"), F.sum("c1").alias("c1"))
    table = summed.toArrow()  # one row a bucket at most
    shares = np.full((2, BUCKETS), SMOOTH)
    for k in (0, 1):
        shares[k][table["bucket"].to_numpy()] += table[f"c{k}"].to_numpy()
        shares[k] /= shares[k].sum()
    return np.log(shares[1] / shares[0])


def descend(rows: list[np.ndarray], values: list[np.ndarray], signs: np.ndarray, cost: np.ndarray, size: int) -> np.ndarray:
    """Dual coordinate descent for the hinge loss; the last feature is the intercept."""
    w, alpha, order = np.zeros(size + 1), np.zeros(len(rows)), np.random.default_rng(5)
    norms = np.array([v @ v + 1.0 for v in values])
    for _ in range(EPOCHS):
        for i in order.permutation(len(rows)):
            at, v = rows[i], values[i]
            gradient = signs[i] * (w[at] @ v + w[size]) - 1
            new = min(max(alpha[i] - gradient / norms[i], 0.0), cost[i])
            step = (new - alpha[i]) * signs[i]
            if step:
                w[at] += step * v
                w[size] += step
                alpha[i] = new
    return w


def sigmoid_slope(margins: np.ndarray, labels: np.ndarray, offset: float) -> float:
    """Slope by Newton steps on smoothed targets; both classes weigh the same, as in the loss."""
    up, down = labels.sum(), len(labels) - labels.sum()
    weight = len(labels) / 2 / np.where(labels, up, down)
    goal = np.where(labels, (up + 1) / (up + 2), 1 / (down + 2))
    a = 1.0
    for _ in range(60):
        p = 1 / (1 + np.exp(-np.clip(a * margins + offset, -30, 30)))
        slope = (weight * (p - goal) * margins).sum() + 1e-3 * a
        curve = (weight * np.maximum(p * (1 - p), 1e-9) * margins * margins).sum() + 1e-3
        a -= max(-2.0, min(2.0, slope / curve))
    return float(max(a, 0.1))


def train(docs: DataFrame, labels: DataFrame, column: str = "text", label: str = "quality", key: str = "doc_id") -> Model:
    """A model from documents and a table of labels by ``key``."""
    gathered = gather(docs, labels, column, label, key)
    ratios = log_count_ratios(gathered)
    sample = gathered.where("bucket is null").select("order", "positive", "indicators").limit(2 * FIT_ROWS).toArrow()
    sample = sample.sort_by([("order", "ascending"), ("positive", "ascending")])
    labels = np.array(sample["positive"].to_pylist(), bool)
    flat = np.zeros(BUCKETS)
    if labels.all() or not labels.any():
        share = labels.mean() if len(labels) else 0.5
        return Model(np.stack([flat, flat]), 0.0, 0.0, float(np.log((share + 1e-9) / (1 - share + 1e-9))))
    rows, values = [], []
    for packed in sample["indicators"]:
        rows.append(np.frombuffer(packed.as_buffer(), np.int32))
        v = ratios[rows[-1]]
        values.append(v / max(np.sqrt(v @ v), 1e-6))
    signs = np.where(labels, 1.0, -1.0)
    # Each class weighs the same in the loss.
    cost = COST * len(labels) / 2 / np.where(labels, labels.sum(), (~labels).sum())
    w = descend(rows, values, signs, cost, BUCKETS)
    offset = float(np.log(THRESHOLD / (1 - THRESHOLD)))
    slope = sigmoid_slope(np.array([w[at] @ v + w[BUCKETS] for at, v in zip(rows, values, strict=True)]), labels, offset)
    return Model(np.stack([w[:BUCKETS] * ratios, ratios * ratios]), float(w[BUCKETS]), slope, offset)


def score(docs: DataFrame, model: Model, column: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` with ``score`` (0 to 1) and ``predicted`` (1 from ``threshold`` on)."""
    docs = docs.drop("score", "predicted")
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, column, SLICE_BYTES):
            s = sent.value.scores(*_rows(batch, column))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(s), pa.array((s >= threshold).astype(np.int32))], names=[*batch.schema.names, "score", "predicted"])

    schema = docs.select("*", F.lit(0.0).alias("score"), F.lit(0).alias("predicted")).schema
    return docs.mapInArrow(run, schema)


def keep(docs: DataFrame, model: Model, column: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """The documents that the model does not reject, with their columns."""
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, column, SLICE_BYTES):
            yield batch.filter(pa.array(sent.value.scores(*_rows(batch, column)) >= threshold))

    return docs.mapInArrow(run, docs.schema)


def training_labels(labels: DataFrame, key: str = "doc_id") -> DataFrame:
    """The labels without the held-out fifth, by a checksum of the id."""
    return labels.where(f"crc32(cast({key} as string)) % 5 != 0")
