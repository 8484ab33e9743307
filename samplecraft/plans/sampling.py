"""Payloads to samples in one fixed order, whatever order the options are declared in.

Payload: extract, descend, strip, lazy flatten, flatten and explode. Keys and values: event type, constants,
key case and blanks, percent and microseconds, value case, value parser, numbers, sub-parse, value
transformer, value mapper, times, rename, replace, keep, rename samples. Rows: new attributes, hold back,
include, exclude, formulas, base URL, remove keys.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from samplecraft.functions import maps
from samplecraft.operators import filters, keys, shape, values


@dataclass(frozen=True)
class SampleSpec:
    """What to do with the payloads of one source. Every option is off by default, except microseconds."""

    name: str = "source"
    event_type: str | None = None
    extract: str | None = None
    start_key: Sequence[str] = ()
    inherit_attributes: bool = False
    strip_keys: Sequence[str] = ()
    lazy_flatten: Sequence[str] = ()
    sample_keys: Mapping[str, str] = field(default_factory=dict)
    split_objects: bool = False
    split_array: bool = False
    leaf_array: bool = False
    set_header: Sequence[str] = ()
    time_value_pairs: bool = False
    global_attributes: Mapping[str, object] = field(default_factory=dict)
    custom_attributes: Mapping[str, object] = field(default_factory=dict)
    to_lower: bool = False
    convert_space: str | None = None
    snake_to_camel: bool = False
    perc_to_decimal: bool = False
    micros_to_ms: bool = True
    value_to_lower: Sequence[str] = ()
    value_to_upper: Sequence[str] = ()
    value_parser: Mapping[str, str] = field(default_factory=dict)
    pluck_numbers: bool = False
    sub_parse: Sequence[Mapping[str, object]] = ()
    value_transformer: Mapping[str, str] = field(default_factory=dict)
    value_mapper: Mapping[str, Sequence[str]] = field(default_factory=dict)
    timestamp_conversion: Mapping[str, str] = field(default_factory=dict)
    rename_keys: Mapping[str, str] = field(default_factory=dict)
    replace_keys: Mapping[str, str] = field(default_factory=dict)
    keep_keys: Sequence[str] = ()
    rename_samples: Mapping[str, str] = field(default_factory=dict)
    add_attribute: Mapping[str, str] = field(default_factory=dict)
    ignore_output: bool = False
    sample_include_filter: Sequence[Mapping[str, str]] = ()
    sample_include_match_all_filter: Sequence[Mapping[str, str]] = ()
    sample_filter: Sequence[Mapping[str, str]] = ()
    sample_exclude_filter: Sequence[Mapping[str, str]] = ()
    math: Mapping[str, str] = field(default_factory=dict)
    base_url: str | None = None
    remove_keys: Sequence[str] = ()
    merge: str | None = None
    prefix: str = ""
    event_limit: int = 0
    fixed6: bool = False
    compat: str | None = None


def payloads_to_rows(df: DataFrame, spec: SampleSpec) -> DataFrame:
    """The payload part: a ``payload`` column becomes ``event_type, sample_ix, attrs``."""
    if spec.extract:
        df = shape.extract(df, spec.extract)
    df = shape.payload_objects(df)
    if spec.start_key:
        df = shape.descend(df, spec.start_key, spec.inherit_attributes)
    df = shape.strip_keys(df, spec.strip_keys)
    df = shape.lazy_flatten(df, spec.lazy_flatten)
    return shape.to_samples(
        df,
        sample_keys=spec.sample_keys,
        split_objects=spec.split_objects,
        split_array=spec.split_array,
        leaf_array=spec.leaf_array,
        set_header=spec.set_header,
        strip=spec.strip_keys,
        time_value_pairs=spec.time_value_pairs,
    )


def keyed_rows(df: DataFrame, spec: SampleSpec) -> DataFrame:
    """Keys and values, up to the new attributes: all rows, as lookups, variables and saved rows see them."""
    df = keys.name_events(df, spec.name, spec.event_type, merging=spec.merge is not None)
    df = keys.custom_attributes(df, spec.global_attributes, spec.custom_attributes)
    df = filters.limit_events(df, spec.event_limit)
    if spec.to_lower:
        df = keys.lower_keys(df)
    if spec.convert_space:
        df = keys.replace_blanks(df, spec.convert_space)
    if spec.snake_to_camel:
        df = keys.snake_to_camel(df)
    if spec.perc_to_decimal:
        df = values.strip_percent(df)
    if spec.micros_to_ms:
        df = values.micros_to_millis(df)
    df = values.lower_values(df, spec.value_to_lower)
    df = values.upper_values(df, spec.value_to_upper)
    df = values.parse_values(df, spec.value_parser)
    if spec.pluck_numbers:
        df = values.pluck_numbers(df)
    # Attributes made by the sub-parse and the mapper skip the steps up to keep_keys.
    made = bool(spec.sub_parse) or any("=>" in k for k in spec.value_mapper)
    if made:
        df = df.withColumn("_made", maps.empty())
    df = values.sub_parse(df, spec.sub_parse, into="_made" if made else None)
    df = values.transform_values(df, spec.value_transformer)
    df = values.map_values(df, spec.value_mapper, into="_made" if made else None)
    df = values.convert_times(df, spec.timestamp_conversion)
    if spec.rename_keys or spec.replace_keys:
        df = keys.rename_keys(df, spec.rename_keys, spec.replace_keys)
    if made:
        df = df.withColumn("attrs", maps.overlay(F.col("attrs"), F.col("_made"))).drop("_made")
    df = keys.keep_keys(df, spec.keep_keys)
    df = keys.rename_samples(df, spec.rename_samples)
    return keys.add_attributes(df, spec.add_attribute)


def selected_rows(df: DataFrame, spec: SampleSpec) -> DataFrame:
    """What follows: hold back, filters, formulas, base URL, removed keys, prefix."""
    if spec.ignore_output:
        return filters.hold_back(df)
    df = filters.filter_samples(
        df,
        exclude=[*spec.sample_filter, *spec.sample_exclude_filter],
        include=spec.sample_include_filter,
        match_all=spec.sample_include_match_all_filter,
        fixed6=spec.fixed6,
        compat=spec.compat,
    )
    df = values.compute(df, spec.math)
    df = keys.base_url(df, spec.base_url)
    df = keys.remove_keys(df, spec.remove_keys)
    # merged sources get their prefix in the merge
    return df if spec.merge else keys.prefix_keys(df, spec.prefix)


def rows_to_samples(df: DataFrame, spec: SampleSpec) -> DataFrame:
    """The row part, on any frame with ``attrs`` (and ``event_type`` where a payload names it)."""
    return selected_rows(keyed_rows(df, spec), spec)


def parsed(df: DataFrame) -> DataFrame:
    """JSON text in ``body``, unless there is a ``payload`` already."""
    return df if "payload" in df.columns else shape.parse_payloads(df).drop("body")


def to_samples(df: DataFrame, spec: SampleSpec) -> DataFrame:
    """Payloads (``payload``, or JSON text in ``body``) to samples."""
    return rows_to_samples(payloads_to_rows(parsed(df), spec), spec)
