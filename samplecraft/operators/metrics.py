"""Metric typing, differences and rates, dimensional payloads, inventory and event rows, counters."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from samplecraft.functions import maps, scalars
from samplecraft.functions.rows import each
from samplecraft.operators.numbering import in_ranges

KINDS = ("RATE", "PRATE", "DELTA", "PDELTA", "ATTRIBUTE")


def metric_kind(key: Column, rules: Mapping[str, str], auto_set: bool = False, mode: str | None = None) -> Column:
    """Kind of a numeric attribute: the first declared rule that fits, else ``GAUGE``.

    A rule fits on the exact name, as a regex with ``auto_set``, or under ``mode``.
    """
    kind = F.lit(None).cast("string")
    for pattern, wanted in reversed(list(rules.items())):
        if wanted not in KINDS:
            continue
        fits = key == pattern
        if auto_set:
            fits = fits | scalars.matches(key, pattern)
        if mode:
            fits = fits | scalars.matches(key, pattern, mode)
        kind = F.when(fits, wanted).otherwise(kind)
    return F.coalesce(kind, F.lit("GAUGE"))


def metric_rows(
    df: DataFrame,
    rules: Mapping[str, str] | None = None,
    auto_set: bool = False,
    mode: str | None = None,
    attrs: str = "attrs",
) -> DataFrame:
    """Long form: one row per attribute with ``metric, kind, value, text``; no number is an ``ATTRIBUTE``."""
    rest = [c for c in df.columns if c != attrs]
    cells = each(df, rest, F.map_entries(attrs), "_e")
    cells = cells.select(*rest, F.col("_e.key").alias("metric"), F.col("_e.value").alias("text"))
    value = scalars.metric_value(F.col("text"))
    kind = F.when(value.isNull(), "ATTRIBUTE").otherwise(metric_kind(F.col("metric"), rules or {}, auto_set, mode))
    out = cells.withColumns({"_value": value, "kind": kind})
    return out.withColumn("value", F.when(F.col("kind") != "ATTRIBUTE", F.col("_value"))).select(
        *rest, "metric", "kind", "value", "text"
    )


def series_namespace(
    df: DataFrame,
    name: str,
    custom_attr: str | None = None,
    existing_attr: Sequence[str] = (),
    attrs: str = "attrs",
) -> DataFrame:
    """Add ``namespace``, the identity of a row's series.

    A constant; or one existing text attribute, which leaves the row; or several joined by ``-`` without the
    missing ones; else the source name.
    """
    existing = list(existing_attr)
    if custom_attr:
        return df.withColumn("namespace", F.lit(custom_attr))
    if len(existing) == 1:
        own = F.col(attrs)[existing[0]]
        return df.withColumn("namespace", F.coalesce(own, F.lit(name))).withColumn(
            attrs, F.map_filter(attrs, lambda k, _: k != existing[0])
        )
    joined = F.nullif(F.concat_ws("-", *[F.col(attrs)[k] for k in existing]), F.lit("")) if existing else None
    return df.withColumn("namespace", F.lit(name) if joined is None else F.coalesce(joined, F.lit(name)))


def change(kind: Column, value: Column, ts_us: Column, before: Column, before_us: Column) -> Column:
    """Reported value of a difference or rate.

    The first sample of a series reports 0; equal times report nothing; a falling value is kept for ``RATE``
    and ``DELTA`` and dropped for the positive variants. Rates are per second.
    """
    step, seconds = value - before, (ts_us - before_us) / F.lit(1000000.0)
    moved = F.when(kind.isin("RATE", "PRATE"), F.try_divide(step, seconds)).otherwise(step)
    positive = F.when(kind.isin("PRATE", "PDELTA") & (step < 0), None).otherwise(moved)
    return (
        F.when(~F.coalesce(kind.isin("RATE", "PRATE", "DELTA", "PDELTA"), F.lit(False)), value)
        .when(ts_us.isNull(), None)
        .when(before_us.isNull(), 0.0)
        .when(ts_us == before_us, None)
        .otherwise(positive)
    )


def differences(
    df: DataFrame,
    series: Sequence[str] = ("event_type", "namespace", "metric"),
    ts: str = "ts",
    value: str = "value",
    kind: str | Column = "kind",
    tie: Sequence[str] = (),
    into: str | Mapping[str, str | Column] = "reported",
    slice_seconds: int | None = None,
) -> DataFrame:
    """Differences and rates to the previous sample of the same series.

    ``into`` names the result, or maps several names to their kinds, all from one pass.

    Rows are dealt into ranges of series, time and tie (see ``numbering``), so a series that holds most rows is
    spread over many tasks, and so is a second that holds most of its rows. Only the last sample of each range travels
    to the first one of its series in the next: that carry has one row per series and range. With ``slice_seconds``, series are cut
    into time slices of that width instead and nothing is written in between; a burst then stays in one slice.
    """
    series, tie = list(series), list(tie)
    wanted = {into: kind} if isinstance(into, str) else dict(into)
    kinds = {f"_kind{i}": F.col(k) if isinstance(k, str) and k in df.columns else k if isinstance(k, Column) else F.lit(k) for i, k in enumerate(wanted.values())}
    us = F.unix_micros(F.col(ts).cast("timestamp"))
    rows = df.withColumns({"_us": us, "_v": F.col(value), **kinds})
    if slice_seconds is None:
        rows = in_ranges(rows, [*series, "_us", *tie]).drop("_at").withColumnRenamed("_range", "_slice")
    else:
        rows = rows.withColumn("_slice", F.floor(F.col("_us") / (slice_seconds * 1_000_000)).cast("bigint"))

    seen = F.struct("_v", "_us")
    last = rows.groupBy(*series, "_slice").agg(F.max_by(seen, F.struct("_us", *tie)).alias("_last"))
    across = W.partitionBy(*series).orderBy("_slice")
    carried = last.withColumn("_slice", F.lead("_slice").over(across)).filter(F.col("_slice").isNotNull())
    carried = carried.select(*series, "_slice", "_last.*", F.lit(True).alias("_carried"))

    # The carried samples join their slice as rows, not through a join: the rows are shuffled once.
    whole = rows.withColumn("_carried", F.lit(False)).unionByName(carried, allowMissingColumns=True)
    inside = W.partitionBy(*series, "_slice").orderBy("_us", *tie)
    before = F.col("_before")
    out = whole.withColumn("_before", F.lag(seen).over(inside)).filter(~F.col("_carried"))
    reported = {n: change(F.col(k), F.col("_v"), F.col("_us"), before["_v"], before["_us"]) for n, k in zip(wanted, kinds, strict=True)}
    return out.withColumns(reported).drop("_us", "_slice", "_v", *kinds, "_carried", "_before")


# ---------------------------------------------------------------- dimensional payloads

_METRICS = (
    "array<struct<name:string,type:string,value:double,"
    "summary:struct<min:double,max:double,sum:double,count:double>,interval_ms:double>>"
)


def dimensional_payload(
    df: DataFrame,
    counts: Mapping[str, float] | None = None,
    summaries: Mapping[str, Mapping[str, str | float]] | None = None,
    fixed: Mapping[str, str] | None = None,
    prefix: str = "",
    timestamp_ms: Column | None = None,
    attrs: str = "attrs",
) -> DataFrame:
    """One payload per row: ``timestamp_ms``, ``common_attributes`` and ``metrics``.

    Values that are no numbers (and ``infinity``) are common attributes. A listed count has an interval;
    the four keys of a summary become one metric if all are numbers and its interval is one; the rest are
    gauges.
    """
    counts, summaries = dict(counts or {}), dict(summaries or {})
    source = F.transform_keys(attrs, lambda k, _: F.concat(F.lit(prefix), k)) if prefix else F.col(attrs)
    df = df.withColumn("_a", source)
    df = df.withColumn("_n", F.transform(F.map_values("_a"), lambda v: scalars.metric_value(v, dimensional=True)))
    keys, texts, number_at = F.map_keys("_a"), F.map_values("_a"), lambda i: F.get("_n", i)
    is_text = lambda _, i: number_at(i).isNull()
    text = F.map_from_arrays(F.filter(keys, is_text), F.filter(texts, is_text))
    parts = {s: {m: str(r[m]) for m in ("min", "max", "sum", "count") if m in r} for s, r in summaries.items()}
    claimed = [k for p in parts.values() for k in p.values() if k not in counts]

    def interval_of(key: Column) -> Column:
        out = F.lit(None).cast("double")
        for name, ms in counts.items():
            out = F.when(key == name, F.lit(float(ms))).otherwise(out)
        return out

    nothing = F.lit(None).cast("struct<min:double,max:double,sum:double,count:double>")
    single = lambda k, i: F.when(
        number_at(i).isNotNull() & ~k.isin(claimed),
        F.struct(
            k.alias("name"),
            F.when(k.isin(list(counts)), "count").otherwise("gauge").alias("type"),
            number_at(i).alias("value"),
            nothing.alias("summary"),
            interval_of(k).alias("interval_ms"),
        ),
    )
    singles = F.filter(F.transform(keys, single), lambda m: m.isNotNull())
    found = []
    for name, rule in summaries.items():
        every = scalars.as_number(F.lit(str(rule.get("interval", ""))))
        if len(parts[name]) < 4 or any(k in counts for k in parts[name].values()):
            continue
        values = {m: number_at(F.array_position(keys, k) - 1) for m, k in parts[name].items()}
        complete = every.isNotNull()
        for v in values.values():
            complete = complete & v.isNotNull()
        metric = F.struct(
            F.lit(name).alias("name"),
            F.lit("summary").alias("type"),
            F.lit(None).cast("double").alias("value"),
            F.struct(*[values[m].alias(m) for m in ("min", "max", "sum", "count")]).alias("summary"),
            every.alias("interval_ms"),
        )
        found.append(F.when(complete, F.array(metric)).otherwise(F.array().cast(_METRICS)))
    now = F.unix_millis(F.current_timestamp()) if timestamp_ms is None else timestamp_ms
    rest = [c for c in df.columns if c not in (attrs, "_a", "_n")]
    return df.select(
        *rest,
        now.alias("timestamp_ms"),
        maps.overlay(maps.literal(fixed or {}), text).alias("common_attributes"),
        F.concat(singles, F.array().cast(_METRICS), *found).alias("metrics"),
    )


# ---------------------------------------------------------------- inventory, events, counters


def inventory_rows(df: DataFrame, rules: Mapping[str, str], attrs: str = "attrs") -> DataFrame:
    """Selected attributes as ``item, field, value``: rule ``value`` -> (key, 'value', v), else (rule, key, v)."""
    rest = [c for c in df.columns if c != attrs]
    cells = [
        F.struct(
            F.lit(key if rule == "value" else rule).alias("item"),
            F.lit("value" if rule == "value" else key).alias("field"),
            F.col(attrs)[key].alias("value"),
        )
        for key, rule in rules.items()
        if rule
    ]
    return _listed(df, rest, cells, "value")


def event_rows(df: DataFrame, rules: Mapping[str, str], attrs: str = "attrs") -> DataFrame:
    """Selected attributes as ``summary, category``: rule ``default`` -> the key is the category."""
    rest = [c for c in df.columns if c != attrs]
    cells = [
        F.struct(
            F.col(attrs)[key].alias("summary"), F.lit(key if rule == "default" else rule).alias("category")
        )
        for key, rule in rules.items()
        if rule
    ]
    return _listed(df, rest, cells, "summary")


def _listed(df: DataFrame, rest: list[str], cells: list[Column], needed: str) -> DataFrame:
    present = F.filter(F.array(*cells), lambda c: c[needed].isNotNull())
    return each(df, rest, present, "_cell").select(*rest, "_cell.*")


def run_counters(df: DataFrame) -> DataFrame:
    """Rows per event type."""
    return df.groupBy("event_type").agg(F.count(F.lit(1)).alias("samples"))


def kind_counters(metrics: DataFrame) -> DataFrame:
    """Metrics per kind."""
    return metrics.groupBy("kind").agg(F.count(F.lit(1)).alias("metrics"))


def observe_counts(df: DataFrame, name: str = "samples"):
    """The frame with a row counter that is filled by whatever action runs it: (DataFrame, Observation)."""
    from pyspark.sql import Observation

    seen = Observation(name)
    return df.observe(seen, F.count(F.lit(1)).alias("rows")), seen
