"""Stateful streams over several micro-batches."""

import datetime
import random
import resource

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from samplecraft.operators import metrics as M
from samplecraft.streaming import series as state
from samplecraft.streaming import stream as S

SCHEMA = "s string, g int, ts timestamp, value double, kind string"


def run(df, folder, mode="append"):
    """Drain a stream into a table."""
    query = df.writeStream.outputMode(mode).format("parquet").option("checkpointLocation", f"{folder}/state").option("path", f"{folder}/out").trigger(availableNow=True).start()
    query.awaitTermination()
    return df.sparkSession.read.schema(df.schema).parquet(f"{folder}/out"), query


def parts(spark, frames, folder, schema=SCHEMA):
    """A stream that meets each list of rows in a micro-batch of its own."""
    for k, rows in enumerate(frames):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(f"{folder}/in/batch={k:03}")
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).option("latestFirst", False).parquet(f"{folder}/in/*")


def at(seconds):
    return datetime.datetime(2024, 1, 1) + datetime.timedelta(seconds=seconds)


def test_several_batches_equal_one(spark, tmp_path):
    draw = random.Random(4)
    batches = []
    for b in range(4):
        rows = []
        for s, g in (("a", 1), ("a", None), (None, 2), ("hot", 3), ('q"{', 4)):
            for k in range(60 if s == "hot" else 7):
                t = b * 1000 + k * 10
                rows.append((s, g, at(t), float(draw.randrange(20)), draw.choice(["RATE", "PRATE", "DELTA", "PDELTA", "GAUGE", None])))
        draw.shuffle(rows)
        batches.append(rows)
    stream = parts(spark, batches, tmp_path)
    got, query = run(S.stream_differences(stream, ["s", "g"], buckets=3), tmp_path)
    assert len(query.recentProgress) >= 4
    every = spark.createDataFrame([r for b in batches for r in b], SCHEMA)
    want = M.differences(every, ["s", "g"], slice_seconds=10**6).select("s", "g", "ts", "value", "kind", "reported")
    rounded = lambda df: sorted(map(repr, df.withColumn("reported", F.round("reported", 9)).collect()))
    assert rounded(got) == rounded(want)


def test_late_and_expired_series(spark, tmp_path):
    batches = [
        [("a", 1, at(0), 1.0, "DELTA"), ("b", 1, at(0), 1.0, "DELTA")],
        [("a", 1, at(100), 5.0, "DELTA"), ("a", 1, at(-1), 9.0, "DELTA")],
        [("a", 1, at(100_000), 7.0, "DELTA")],
        [("a", 1, at(100_010), 8.0, "DELTA"), ("b", 1, at(100_020), 3.0, "DELTA")],
    ]
    got, _ = run(S.stream_differences(parts(spark, batches, tmp_path), ["s", "g"], ttl_ms=50_000_000, delay="1 seconds", buckets=1), tmp_path)
    rows = sorted((r["s"], r["ts"].timestamp(), r["reported"]) for r in got.collect())
    start = at(0).timestamp()
    assert [(s, round(t - at(0).timestamp()), x) for s, t, x in rows] == [("a", 0, 0.0), ("a", 100, 4.0), ("a", 100_000, 2.0), ("a", 100_010, 1.0), ("b", 0, 0.0), ("b", 100_020, 0.0)] and start


def test_a_hot_series_takes_bounded_memory():
    """A million rows of one series in one call, in chunks as the workers get them."""

    class Handle:
        def listTimers(self):
            return iter(())

        def registerTimer(self, _):
            pass

    class Held:
        value = None

        def exists(self):
            return self.value is not None

        def get(self):
            return self.value

        def update(self, value):
            self.value = value

    class Timers:
        def getCurrentWatermarkInMs(self):
            return 0

    processor = state.SeriesDifferences(10**9)
    processor.handle, processor.held = Handle(), Held()
    rng = np.random.default_rng(3)

    def chunks(n=1_000_000, size=10_000):
        for k in range(0, n, size):
            yield pd.DataFrame({"series": ["hot"] * size, "us": rng.permutation(size) + k, "value": rng.random(size), "kind": ["DELTA"] * size})

    before = resource.getrusage(resource.RUSAGE_SELF).ru_maxrss
    sizes = [len(f) for f in processor.handleInputRows((0,), chunks(), Timers())]
    grown = (resource.getrusage(resource.RUSAGE_SELF).ru_maxrss - before) / 1024
    assert sum(sizes) == 1_000_000 and max(sizes) <= processor.most and grown < 300
    assert processor._stored()["us"].tolist() == [999_999]


ROW = "id int, ts timestamp, attrs map<string,string>"


@pytest.mark.parametrize("how", ["left", "inner"])
def test_streams_join_within_an_interval(spark, tmp_path, how):
    draw = random.Random(8)
    sides = {}
    for side in "lr":
        batches, n = [], 0
        for b in range(3):
            rows = []
            for _ in range(40):
                # some are late within the delay, some keys are null, numbers are written in two ways
                t = b * 100 + draw.randrange(100) - draw.choice([0, 0, 30])
                key = draw.choice(["1", "1.0", "x", "y", None])
                rows.append((n, at(t), {"key": key, side: str(n)}))
                n += 1
            batches.append(rows)
        batches.append([(-1, at(10**6), {"key": "closing"})])
        batches.append([(-2, at(2 * 10**6), {"key": "closing too"})])
        sides[side] = batches
    streams = {s: S.event_time(parts(spark, b, tmp_path / s, ROW), delay="60 seconds") for s, b in sides.items()}
    out = S.stream_interval_join(streams["l"], streams["r"], "key", "key", "20 SECONDS", how=how, prefix="p.")
    got, query = run(out, tmp_path)
    number = lambda k: "1" if k == "1.0" else k
    left, right = ([r for b in sides[s] for r in b if r[0] >= 0] for s in "lr")
    want = []
    for n, t, a in left:
        near = [r for r in right if a["key"] and number(r[2]["key"]) == number(a["key"]) and t <= r[1] <= t + datetime.timedelta(seconds=20)]
        want += [(n, r[0]) for r in near]
        if not near and how == "left":
            want.append((n, None))
    rows = [(r["id"], r["attrs"].get("p.r")) for r in got.where("id >= 0").collect()]
    assert sorted(map(repr, rows)) == sorted(repr((n, None if m is None else str(m))) for n, m in want)
    # What both watermarks have passed is gone.
    state = query.recentProgress[-1]["stateOperators"]
    held = sum(s["numRowsTotal"] for s in state)
    assert held <= 4 < max(sum(s["numRowsTotal"] for s in p["stateOperators"]) for p in query.recentProgress)
