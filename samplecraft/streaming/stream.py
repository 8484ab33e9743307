"""Streams of payloads and samples.

Everything that works inside a row (all of shape, keys, values, filters, key/value, column and block text)
is applied to a stream as it is. Forms that group the rows of one payload run per micro-batch, where a
payload is always whole. Rates, merges, joins and de-duplication keep bounded state by event time.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from samplecraft.functions import maps
from samplecraft.functions.rows import each
from samplecraft.operators.combine import comparable
from samplecraft.plans.sampling import SampleSpec, to_samples
from samplecraft.streaming import series as state



# The worker that prepares a stateful operator beside the driver does not see shipped packages.
cloudpickle.register_pickle_by_value(state)


def payload_stream(spark: SparkSession, path: str, schema: str, fmt: str = "parquet", files_per_trigger: int = 0) -> DataFrame:
    """A file stream of captured payloads; ``files_per_trigger`` bounds a micro-batch."""
    reader = spark.readStream.schema(schema).format(fmt)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.load(path)


def sample_stream(payloads: DataFrame, spec: SampleSpec) -> DataFrame:
    """The batch plan on a stream; an event limit has no meaning there."""
    if spec.event_limit:
        raise ValueError("an event limit needs a batch")
    return to_samples(payloads, spec)


def per_batch(
    stream: DataFrame, build: Callable[[DataFrame], DataFrame], write: Callable[[DataFrame, int], None]
) -> DataStreamWriter:
    """Run a batch operator on every micro-batch; ``write`` gets the result and the batch number.

    For operators that group by payload: a payload is one row of the stream, so no group spans batches.
    """

    def run(batch: DataFrame, number: int) -> None:
        write(build(batch), number)

    return stream.writeStream.foreachBatch(run)


def event_time(df: DataFrame, column: str = "ts", delay: str = "10 minutes") -> DataFrame:
    """Cast the time column for watermarking and set the watermark."""
    return df.withColumn(column, F.col(column).cast("timestamp")).withWatermark(column, delay)


def with_closing(df: DataFrame, folder: str) -> DataFrame:
    """The stream and a source beside it that is empty until ``close``; set the watermark on the result."""
    spark = df.sparkSession
    spark.createDataFrame([], df.schema).write.mode("append").parquet(folder)
    return df.unionByName(spark.readStream.schema(df.schema).parquet(folder))


def close(df: DataFrame, folder: str, ts: str = "ts") -> None:
    """Write the closing event for ``with_closing(df, folder)``: all null but for a time beyond all others.

    Run the drained query once more after it: the watermark passes every window, and the last ones are delivered. The
    event's own window stays open, so the result leaves it out. The query takes no events after that.
    """
    columns = [F.lit("9999-01-01" if f.name == ts else None).cast(f.dataType).alias(f.name) for f in df.schema.fields]
    df.sparkSession.range(1).select(*columns).write.mode("append").parquet(folder)


# ---------------------------------------------------------------- rates and deltas


def stream_differences(
    df: DataFrame,
    series: Sequence[str] = ("event_type", "namespace", "metric"),
    ts: str = "ts",
    value: str = "value",
    kind: str | Column = "kind",
    ttl_ms: int = 24 * 3600 * 1000,
    delay: str = "10 minutes",
    buckets: int = 1024,
) -> DataFrame:
    """Differences and rates against the last value kept per series.

    State is one (time, value) per series; it is dropped once the watermark (``delay`` behind the newest
    sample) is ``ttl_ms`` past it. Samples older than the stored one are late and dropped; one of equal time reports
    null, as in a batch. Columns: the series, ``ts``, ``value``, ``kind``, ``reported``.

    Series are dealt into ``buckets``, each with one state, and all series of a bucket advance together in arrays: 24
    bytes for a row of the micro-batch (which ``files_per_trigger`` bounds) and some 60 for a live series of the bucket. A timer
    wakes a bucket that no samples reach when the oldest of its series is due.
    """
    kind = F.col(kind) if isinstance(kind, str) else kind
    named = F.struct(*[F.col(f"`{c}`") for c in series])
    rows = event_time(df, ts, delay).where(F.col(ts).isNotNull()).select(
        F.pmod(F.xxhash64(named), F.lit(buckets)).alias("bucket"),
        # null fields stay, so that the text is the series
        F.to_json(named, {"ignoreNullFields": "false"}).alias("series"),
        F.col(ts).alias("at"),
        F.unix_micros(F.col(ts).cast("timestamp")).alias("us"),
        F.col(value).cast("double").alias("value"),
        F.coalesce(kind.cast("string"), F.lit("")).alias("kind"),
    )
    out = rows.groupBy("bucket").transformWithStateInPandas(
        state.SeriesDifferences(ttl_ms), "series string, us bigint, value double, kind string, reported double", "append", "EventTime"
    )
    types = ", ".join(f"`{c}` {dict(df.dtypes)[c]}" for c in series)
    return out.withColumn("series", F.from_json("series", types)).select(
        *[F.col("series")[c].alias(c) for c in series], F.timestamp_micros("us").alias(ts), "value", F.nullif("kind", F.lit("")).alias("kind"), "reported"
    )


# ---------------------------------------------------------------- merge, join, dedupe


def stream_merge(
    df: DataFrame,
    window: str,
    group: Sequence[str] = (),
    ts: str = "ts",
    order: Sequence[str] = ("ts",),
    attrs: str = "attrs",
) -> DataFrame:
    """Rows of a window (and group) collapse into one sample, the later row winning a key.

    The frame needs a watermark on ``ts``. The winner of each key is aggregated first; the second
    aggregation, chained on the same window, assembles them.
    """
    entries = each(df, [ts, *group, F.struct(*order).alias("_place")], F.map_entries(attrs), "_e")
    winners = entries.groupBy(F.window(ts, window), *group, F.col("_e.key").alias("_k")).agg(
        F.max_by("_e.value", "_place").alias("_v")
    )
    again = F.window(F.window_time("window"), window)
    merged = winners.groupBy(again, *group).agg(
        F.map_from_entries(F.collect_list(maps.pair(F.col("_k"), F.col("_v")))).alias(attrs)
    )
    return merged


def stream_join(df: DataFrame, secondary: DataFrame, key: str, attrs: str = "attrs") -> DataFrame:
    """Left outer join of a sample stream with a static table of ``_key``, ``_attrs`` (``latest_by_key``)."""
    joined = df.join(secondary, comparable(F.col(attrs)[key]) == F.col("_key"), "left")
    return joined.withColumn(attrs, maps.overlay(F.col(attrs), F.col("_attrs"))).drop("_key", "_attrs")


def stream_interval_join(
    left: DataFrame,
    right: DataFrame,
    key: str,
    right_key: str,
    within: str,
    ts: str = "ts",
    how: str = "left",
    prefix: str = "",
    attrs: str = "attrs",
) -> DataFrame:
    """Samples of one stream with those of another that have the same key at most ``within`` later.

    Both streams need a watermark on ``ts``. A sample is in the result once for each partner, whose attributes (with
    ``prefix``) override its own and whose time is ``partner_ts``. With ``how="left"`` one without partners follows when
    both watermarks say that none can come any more. Either side is held for ``within`` and the delays only. Keys are
    compared as in the batch join; a null key has no partners.
    """
    if how not in ("left", "inner"):
        raise ValueError(f"a stream is joined inner or left: {how}")
    mine = left.withColumn("_key", comparable(F.col(attrs)[key]))
    theirs = F.transform_keys(attrs, lambda k, _: F.concat(F.lit(prefix), k)) if prefix else F.col(attrs)
    right = right.select(comparable(F.col(attrs)[right_key]).alias("_other"), F.col(ts).alias("partner_ts"), theirs.alias("_attrs"))
    after = F.col("partner_ts")
    near = (F.col("_key") == F.col("_other")) & (after >= F.col(ts)) & (after <= F.col(ts) + F.expr(f"INTERVAL {within}"))
    joined = mine.join(right, near, "left_outer" if how == "left" else "inner")
    return joined.withColumn(attrs, maps.overlay(F.col(attrs), F.col("_attrs"))).drop("_key", "_other", "_attrs")


def stream_dedupe(df: DataFrame, keys: Sequence[str], attrs: str = "attrs") -> DataFrame:
    """First row per attribute values within the watermark delay."""
    named = df.withColumns({f"_d{i}": F.col(attrs)[k] for i, k in enumerate(keys)})
    columns = [f"_d{i}" for i in range(len(keys))]
    return named.dropDuplicatesWithinWatermark(columns).drop(*columns)
