"""Approximate nearest neighbours: inverted lists scanned by column blocks, with early abandoning by hypothesis tests.

Vectors are dealt to lists by their nearest centroid (k-means on at most about ``SAMPLE_ROWS`` vectors, picked by hash).
A query probes as many lists, nearest centroid first, as give ``SAMPLE_RECALL`` of the true neighbours on that sample, and
more until they hold k vectors besides its own.
Within a list vectors and queries are turned by one random orthogonal matrix; the squared distance is summed block of
columns by block, and after each block a candidate is given up when its partial distance, scaled to all columns, lies so
far above the distance of the k-th best so far that the hypothesis "it is among the k nearest" is rejected. What
remains is measured on the original vectors in double precision.

Lists are cut into parts of about ``PART_ROWS`` vectors by a hash of the id, and the queries of a list likewise, so a
list that holds a third of all vectors becomes many small tasks. A part gives at most k rows a query, from which the
k best are taken.

Edge cases: vectors that are null, empty, zero, or hold null or non-finite components take no part, nor do those whose
length is not the most common one; of rows with the same id the smallest vector counts; a query's own id is never its
neighbour; equal distances go by the smaller id; fewer candidates than k are all returned; an empty table gives an empty result; extra columns play no
part.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from samplecraft.llm.common import bounded_sample, materialise

SAMPLE_ROWS = 20_000
SAMPLE_QUERIES = 200
SAMPLE_RECALL = 0.96
MOST_LISTS = 4096
PART_ROWS = 4096
PART_QUERIES = 2048
BLOCK = 8
#: Strictness of the test: a candidate's scaled partial distance may pass the bound by (1 + STRICT / sqrt(columns)).
STRICT = 2.1
SMALL = 2000


@dataclass
class Index:
    centroids: np.ndarray
    turn: np.ndarray
    probes: int


def usable(vectors: DataFrame, key: str, column: str) -> DataFrame:
    """``id, v``: the vectors that take part, as doubles, one an id."""
    v = F.col(column).cast("array<double>")
    bad = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    rows = vectors.select(F.col(key).cast("long").alias("id"), v.alias("v")).where(F.col("id").isNotNull() & v.isNotNull() & ~bad & F.exists(v, lambda x: x != 0))
    return rows.groupBy("id").agg(F.min("v").alias("v"))


def _squares(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.maximum((a * a).sum(1)[:, None] + (b * b).sum(1)[None] - 2 * a @ b.T, 0)


def fit(rows: DataFrame, total: int, k: int) -> Index:
    """Centroids, turn and number of probes from a bounded sample."""
    sample = np.array([r["v"] for r in bounded_sample(rows, "id", SAMPLE_ROWS).orderBy("id").collect()])
    rng = np.random.default_rng(11)
    turn = np.linalg.qr(rng.standard_normal((sample.shape[1],) * 2))[0]
    lists = int(min(MOST_LISTS, max(1, np.sqrt(total) / 4))) if total > SMALL else 1
    different = np.unique(sample, axis=0)  # a vector that many rows share is drawn once
    lists = min(lists, len(different))
    centroids = different[rng.choice(len(different), lists, replace=False)]
    for _ in range(10):
        nearest = _squares(sample, centroids).argmin(1)
        sums = np.zeros_like(centroids)
        np.add.at(sums, nearest, sample)
        n = np.bincount(nearest, minlength=lists)
        centroids = np.where(n[:, None] > 0, sums / np.maximum(n, 1)[:, None], centroids)
    nearest = _squares(sample, centroids).argmin(1)
    queries = rng.choice(len(sample), min(SAMPLE_QUERIES, len(sample)), replace=False)
    far = _squares(sample[queries], sample)
    far[np.arange(len(queries)), queries] = np.inf
    true = np.argsort(far, axis=1)[:, :k]
    place = np.argsort(np.argsort(_squares(sample[queries], centroids), axis=1), axis=1)
    needed = np.sort(np.take_along_axis(place, nearest[true], axis=1).ravel())
    probes = int(needed[min(len(needed) - 1, int(SAMPLE_RECALL * len(needed)))]) + 1 if len(needed) else lists
    return Index(centroids, turn, min(lists, probes))


def _near_lists(rows: DataFrame, index: Index, count: int, sizes: np.ndarray | None = None, least: int = 0) -> DataFrame:
    """``id, v, list``: a row for each of the ``count`` nearest lists, and of more where these hold fewer than ``least``
    vectors."""
    sent = rows.sparkSession.sparkContext.broadcast(index)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 1024):
                batch = whole.slice(at, 1024)
                v = batch.column(1).flatten().to_numpy().reshape(batch.num_rows, -1)
                lists = np.argsort(_squares(v, sent.value.centroids), axis=1, kind="stable")
                wanted = np.full(batch.num_rows, count)
                if sizes is not None:
                    wanted = np.maximum(wanted, (np.cumsum(sizes[lists], axis=1) < least).sum(1) + 1)
                taken = np.arange(lists.shape[1]) < wanted[:, None]
                again = pa.array(np.nonzero(taken)[0])
                yield pa.RecordBatch.from_arrays([batch.column(0).take(again), batch.column(1).take(again), pa.array(lists[taken].astype(np.int32))], names=["id", "v", "list"])

    return rows.select("id", "v").mapInArrow(run, "id long, v array<double>, list int")


def scan_part(ids: np.ndarray, vectors: np.ndarray, query_ids: np.ndarray, queries: np.ndarray, turn: np.ndarray, k: int) -> list[tuple[int, int, float]]:
    """(query, id, distance) of the k nearest of each query among ``vectors``."""
    width = vectors.shape[1]
    turned, asked = vectors @ turn, queries @ turn
    blocks = [np.ascontiguousarray(turned[:, c : c + BLOCK]) for c in range(0, width, BLOCK)]
    slack = 1e-9 * (1 + float((vectors * vectors).sum(1).max()))
    out = []
    for own, query, q in zip(query_ids.tolist(), queries, asked, strict=True):
        # Rows are visited in groups; the k-th best of those before is the bound for the next.
        rows, exact, bound, at, size = np.zeros(0, np.int64), np.zeros(0), np.inf, 0, 4 * k + 1
        while at < len(ids):
            alive = np.arange(at, min(at + size, len(ids)))
            at, size = at + size, 4 * size
            partial = np.zeros(len(alive))
            for n, block in enumerate(blocks) if np.isfinite(bound) else ():
                if not len(alive):
                    break
                partial += ((block[alive] - q[n * BLOCK : n * BLOCK + block.shape[1]]) ** 2).sum(1)
                seen = min(width, (n + 1) * BLOCK)
                kept = partial * (width / seen) <= bound * (1 + STRICT / np.sqrt(seen)) ** 2 + slack
                alive, partial = alive[kept], partial[kept]
            alive = alive[ids[alive] != own]
            rows = np.concatenate([rows, alive])
            exact = np.concatenate([exact, np.sqrt(((vectors[alive] - query) ** 2).sum(1))])
            best = np.lexsort((ids[rows], exact))[:k]
            rows, exact = rows[best], exact[best]
            bound = exact[-1] ** 2 if len(rows) == k else np.inf
        out += [(own, int(i), float(x)) for i, x in zip(ids[rows], exact, strict=True)]
    return out


def search(vectors: DataFrame, wanted: F.Column, k: int = 10, key: str = "vec_id", column: str = "embedding") -> DataFrame:
    """``query_id, rank, <key>, score`` for the rows whose id (column ``id``) satisfies ``wanted``."""
    result = f"query_id long, rank int, `{key}` long, score double"
    rows = materialise(usable(vectors, key, column))
    widths = rows.groupBy(F.size("v").alias("w")).count().orderBy(F.desc("count"), "w").first()
    if widths is None:
        return vectors.sparkSession.createDataFrame([], result)
    rows = rows.where(F.size("v") == widths["w"])
    index = fit(rows, widths["count"], k)
    dealt = materialise(_near_lists(rows, index, 1))
    # One row a list: at most MOST_LISTS.
    sizes = F.broadcast(
        dealt.groupBy("list").agg(
            F.ceil(F.count("*") / PART_ROWS).cast("int").alias("parts"), F.ceil(F.sum(wanted.cast("int")) * index.probes / PART_QUERIES + 1).cast("int").alias("query_parts")
        )
    )
    part = F.pmod(F.xxhash64("id"), F.col("parts")).cast("int")
    query_part = F.pmod(F.xxhash64("id", F.lit(3)), F.col("query_parts")).cast("int")
    stored = dealt.join(sizes, "list").select("list", part.alias("part"), F.explode(F.sequence(F.lit(0), F.col("query_parts") - 1)).alias("query_part"), "id", "v")
    held = np.zeros(len(index.centroids), np.int64)
    for r in dealt.groupBy("list").count().collect():  # one row a list
        held[r["list"]] = r["count"]
    asked = _near_lists(rows.where(wanted), index, index.probes, held, k + 1).join(sizes, "list")
    asked = asked.select("list", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), query_part.alias("query_part"), "id", "v")
    sent = vectors.sparkSession.sparkContext.broadcast(index.turn)

    def run(key: tuple, left: pa.Table, right: pa.Table) -> pa.Table:
        found = []
        if left.num_rows and right.num_rows:
            def of(t: pa.Table) -> tuple[np.ndarray, np.ndarray]:
                t = t.sort_by("id")
                return t["id"].to_numpy(), t["v"].combine_chunks().flatten().to_numpy().reshape(t.num_rows, -1)

            found = scan_part(*of(left), *of(right), sent.value, k)
        columns = list(zip(*found, strict=True)) or [[], [], []]
        return pa.table([pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.int64(), pa.float64()), strict=True)], names=["query_id", "id", "score"])

    by = ["list", "part", "query_part"]
    found = stored.groupBy(*by).cogroup(asked.groupBy(*by)).applyInArrow(run, "query_id long, id long, score double")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy("score", "id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", F.col("id").alias(key), "score")
