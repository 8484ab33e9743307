"""Structured Streaming runs over the tables, drained once; results are read back from the sink.

Building one of these queries runs its stream to the end; only the reading back is lazy.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from catalog.registry import attr, attrs_of, doc, query, table, text
from samplecraft.operators import combine as C
from samplecraft.plans.sampling import SampleSpec
from samplecraft.session import shared_folder
from samplecraft.sources import prometheus as P
from samplecraft.streaming import stream as S


def events(spark: SparkSession, sf: str) -> DataFrame:
    schema = spark.read.parquet(f"{sf}/events.parquet").schema
    return spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(sf)


def drain(spark: SparkSession, df: DataFrame, mode: str = "append", close: Callable[[], None] | None = None) -> DataFrame:
    """Run a stream over everything that is there, then over what ``close`` adds, and read the sink back."""
    folder = shared_folder(spark)
    for more in (None, close) if close else (None,):
        if more:
            more()
        run = (
            df.writeStream.outputMode(mode)
            .format("parquet")
            .option("checkpointLocation", f"{folder}/state")
            .option("path", f"{folder}/out")
            .trigger(availableNow=True)
            .start()
        )
        run.awaitTermination()
    return spark.read.schema(df.schema).parquet(f"{folder}/out")


@query("""
    SELECT event_type, count(*) AS n, CAST(sum(2 * CAST(json_extract_string(props, '$.k') AS BIGINT)) AS BIGINT) AS doubled FROM events
    WHERE NOT regexp_matches(json_extract_string(props, '$.k'), '^8') GROUP BY event_type
""")
def stream_stateless_samples(spark, sf):
    body = doc(event_type="event_type", detail=F.from_json("props", "k bigint"))
    spec = SampleSpec(sample_filter=[{"k$": "^8"}], math={"double": "${detail.k} * 2"})
    out = S.sample_stream(events(spark, sf).select("event_id", body.alias("body")), spec)
    rows = drain(spark, out.select("event_id", "event_type", attr("double", "bigint").alias("double")))
    return rows.groupBy("event_type").agg(F.count(F.lit(1)).alias("n"), F.sum("double").alias("doubled"))


@query("SELECT event_id, value AS gauge, event_type AS type FROM events")
def stream_grouped_per_batch(spark, sf):
    """Exposition text on a plain stream: payloads are put together inside the row."""
    body = F.concat(F.lit("# TYPE v gauge\n"), text('v{type="', F.col("event_type"), '"} ', F.col("value")))
    payloads = events(spark, sf).select("event_id", body.alias("body"))
    out = drain(spark, P.label_samples(P.parse_lines(payloads)))
    return out.select("event_id", attr("v.gauge", "double").alias("gauge"), attr("type").alias("type"))


@query("""
    WITH w AS (SELECT event_type, user_id, ts, value AS v, lag(value) OVER s AS pv, epoch_us(ts) AS us, lag(epoch_us(ts)) OVER s AS pus
               FROM events WINDOW s AS (PARTITION BY event_type, user_id ORDER BY ts))
    SELECT event_type, user_id, us, CASE WHEN pus IS NULL THEN 0 ELSE round((v - pv) / ((us - pus) / 1000000.0::DOUBLE), 9) END AS rate FROM w
""")
def stream_rates(spark, sf):
    out = S.stream_differences(events(spark, sf), ["event_type", "user_id"], kind=F.lit("RATE"))
    rows = drain(spark, out)
    return rows.select("event_type", "user_id", F.unix_micros("ts").alias("us"), F.round("reported", 9).alias("rate"))


@query("""
    SELECT event_id, event_type AS kind, user_id AS "user", n_name AS nation FROM events LEFT JOIN nation ON n_nationkey = user_id
""")
def stream_static_join(spark, sf):
    ev = events(spark, sf).select("event_id", attrs_of(kind="event_type", user="user_id").alias("attrs"))
    nations = table(spark, sf, "nation").select("n_nationkey", attrs_of(n_nationkey="n_nationkey", nation="n_name").alias("attrs"))
    static = C.latest_by_key(C.Source(nations, order=["n_nationkey"]), "n_nationkey")
    rows = drain(spark, S.stream_join(ev, static, "user"))
    return rows.select(
        "event_id", attr("kind").alias("kind"), attr("user", "bigint").alias("user"), attr("nation").alias("nation")
    )


@query("SELECT user_id AS \"user\", event_type AS kind, 1 AS n FROM events GROUP BY user_id, event_type")
def stream_dedupe(spark, sf):
    ev = S.event_time(events(spark, sf), delay="3650 days").select("ts", attrs_of(user="user_id", kind="event_type").alias("attrs"))
    rows = drain(spark, S.stream_dedupe(ev, ["user", "kind"]))
    return rows.groupBy(attr("user").cast("bigint").alias("user"), attr("kind").alias("kind")).agg(F.count(F.lit(1)).cast("int").alias("n"))


@query("""
    SELECT CAST(epoch(date_trunc('day', ts)) AS BIGINT) AS day, event_type AS kind, arg_max(user_id, ts) AS last_user,
           arg_max(event_id, ts) AS last_event, CAST(count(DISTINCT event_type) + 1 AS INTEGER) AS keys
    FROM events GROUP BY date_trunc('day', ts), event_type
""")
def stream_merge_by_window(spark, sf):
    """All days, the last one too: a closing event, which the result leaves out, moves the watermark past it."""
    source, folder = events(spark, sf), f"{shared_folder(spark)}/closing"
    ev = S.event_time(S.with_closing(source, folder), delay="0 seconds")
    ev = ev.select("ts", F.col("event_type").alias("kind"), attrs_of(user="user_id", event="event_id").alias("attrs"))
    rows = drain(spark, S.stream_merge(ev, "1 day", ["kind"]), close=lambda: S.close(source, folder))
    return rows.select(
        F.unix_seconds("window.start").alias("day"), "kind", attr("user", "bigint").alias("last_user"),
        attr("event", "bigint").alias("last_event"), F.size("attrs").alias("keys"),
    )


@query("""
    WITH c AS (SELECT * FROM events WHERE event_type = 'click'), p AS (SELECT * FROM events WHERE event_type = 'purchase')
    SELECT c.event_id, c.user_id AS "user", p.event_id AS bought, epoch_us(p.ts) - epoch_us(c.ts) AS after_us
    FROM c LEFT JOIN p ON p.user_id = c.user_id AND p.ts >= c.ts AND p.ts <= c.ts + INTERVAL 2 DAY
""")
def stream_stream_join(spark, sf):
    """Clicks with the purchases of the same user within two days, both as streams; clicks without any come last."""
    source, folder = events(spark, sf), f"{shared_folder(spark)}/closing"
    ev = S.event_time(S.with_closing(source, folder), delay="1 hour")
    # The condition names the time, so that the closing event passes the watermarks before it is left out.
    of = lambda kind: ev.where(F.when(F.col("ts").isNotNull(), F.col("event_type")) == kind)
    rows = attrs_of(user="user_id", event="event_id")
    out = S.stream_interval_join(
        of("click").select("ts", "event_id", rows.alias("attrs")), of("purchase").select("ts", rows.alias("attrs")), "user", "user", "2 DAYS", prefix="p."
    )
    done = drain(spark, out, close=lambda: S.close(source, folder))
    return done.select(
        "event_id", attr("user", "bigint").alias("user"), attr("p.event", "bigint").alias("bought"), (F.unix_micros("partner_ts") - F.unix_micros("ts")).alias("after_us")
    )
