"""Event payloads, batches, fixed attributes, entities and JSON files."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from samplecraft.functions import maps
from samplecraft.operators.numbering import number_any_order

BATCH_ROWS = 5000


def with_identity(df: DataFrame, name: str, version: str, attrs: str = "attrs") -> DataFrame:
    """``integration_name`` and ``integration_version`` on each row."""
    fixed = {"integration_name": name, "integration_version": version}
    return df.withColumn(attrs, maps.overlay(F.col(attrs), maps.literal(fixed)))


def with_entity(
    df: DataFrame, entity: str | None = None, entity_type: str | None = None, local: str = "local"
) -> DataFrame:
    """The entity rows belong to: a named one (type ``instance`` by default) or the local one."""
    kind = (entity_type or "instance") if entity else None
    return df.withColumns({"entity": F.lit(entity or local), "entity_type": F.lit(kind).cast("string")})


def event_attributes(event_key: str = "eventType", attrs: str = "attrs") -> Column:
    """Attributes with the event type under ``event_key``."""
    return maps.overlay(F.col(attrs), F.create_map(F.lit(event_key), F.col("event_type")))


def event_payloads(df: DataFrame, event_key: str = "eventType", attrs: str = "attrs") -> DataFrame:
    """One JSON text per row in ``event``."""
    rest = [c for c in df.columns if c not in (attrs, "event_type")]
    return df.select(*rest, F.to_json(event_attributes(event_key, attrs)).alias("event"))


def batches(
    df: DataFrame,
    key: Sequence[str],
    entity: Sequence[str] = ("entity",),
    size: int = BATCH_ROWS,
    event: str = "event",
    rows_per_slice: int = 100_000,
) -> DataFrame:
    """At most ``size`` events per batch and entity: ``entity, batch_id, n, events``.

    ``key`` identifies a row. An entity that holds most of the rows is numbered in parallel parts of about
    ``rows_per_slice`` rows; a collected list never exceeds ``size``.
    """
    numbered = number_any_order(df, key, "_no", entity, rows_per_slice)
    batch = F.floor((F.col("_no") - 1) / size).cast("bigint").alias("batch_id")
    return numbered.groupBy(*entity, batch).agg(
        F.count(F.lit(1)).alias("n"), F.collect_list(event).alias("events")
    )


def write_json(df: DataFrame, path: str, mode: str = "overwrite", max_records: int = 0) -> None:
    """Save samples as JSON lines, the attributes as top-level fields of each line."""
    lines = df.select(F.to_json(event_attributes("event_type")).alias("value"))
    writer = lines.write.mode(mode)
    if max_records:
        writer = writer.option("maxRecordsPerFile", max_records)
    writer.text(path)


def write_samples(df: DataFrame, path: str, mode: str = "append", fmt: str = "parquet") -> None:
    """Sample table partitioned by event type."""
    df.write.mode(mode).format(fmt).partitionBy("event_type").save(path)
