"""A drained stream delivers the last window."""

import shutil

from pyspark.sql import functions as F

from catalog import QUERIES


def test_hot_day(spark, tmp_path):
    events = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    day = events.agg(F.min(F.to_date("ts"))).first()[0]
    hot = events.filter(F.to_date("ts") == day)
    hot.coalesce(1).write.parquet(f"{tmp_path}/made")
    shutil.copy(next((tmp_path / "made").glob("part-*")), tmp_path / "events.parquet")
    got = QUERIES["stream_merge_by_window"](spark, str(tmp_path)).collect()
    want = {r["event_type"]: r["last"] for r in hot.groupBy("event_type").agg(F.max_by("event_id", "ts").alias("last")).collect()}
    assert want and {r["kind"]: r["last_event"] for r in got} == want and len(got) == len(want)
