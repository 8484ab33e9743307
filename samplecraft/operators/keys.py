"""Key functions. The map plane rewrites keys per row; the wide plane renames columns at plan time."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from samplecraft.functions import maps
from samplecraft.functions.dialect import count_groups, java_regex, java_replacement
from samplecraft.functions.scalars import any_match, fill_template, matches

# ---------------------------------------------------------------- map plane


def _rekey(df: DataFrame, fn: Callable[[Column], Column], attrs: str) -> DataFrame:
    return df.withColumn(attrs, F.transform_keys(attrs, lambda k, _: fn(k)))


def lower_keys(df: DataFrame, attrs: str = "attrs") -> DataFrame:
    return _rekey(df, F.lower, attrs)


def replace_blanks(df: DataFrame, by: str, attrs: str = "attrs") -> DataFrame:
    return _rekey(df, lambda k: F.replace(k, F.lit(" "), F.lit(by)), attrs)


def camel_key(key: Column) -> Column:
    """``a_b`` -> ``aB``: first letter lowered, underscores removed."""
    head = F.lower(key.substr(1, 1))
    pieces = F.split(F.substring(key, F.lit(2), F.length(key)), "_")
    body = F.transform(
        pieces,
        lambda p, i: F.when(i == 0, p).otherwise(F.concat(F.upper(p.substr(1, 1)), F.substring(p, F.lit(2), F.length(p)))),
    )
    return F.concat(head, F.array_join(body, ""))


def snake_to_camel(df: DataFrame, attrs: str = "attrs") -> DataFrame:
    return _rekey(df, camel_key, attrs)


def rename_key(key: Column, rules: Mapping[str, str]) -> Column:
    for pattern, template in rules.items():
        key = F.regexp_replace(key, java_regex(pattern), java_replacement(template, count_groups(pattern)))
    return key


def rename_keys(
    df: DataFrame,
    rename: Mapping[str, str] | None = None,
    replace: Mapping[str, str] | None = None,
    attrs: str = "attrs",
) -> DataFrame:
    """Regex replacement in keys, in declared order, ``rename`` before ``replace``."""
    return _rekey(df, lambda k: rename_key(rename_key(k, rename or {}), replace or {}), attrs)


def keep_keys(df: DataFrame, patterns: Iterable[str], attrs: str = "attrs") -> DataFrame:
    patterns = list(patterns)
    if not patterns:
        return df
    return df.withColumn(attrs, F.map_filter(attrs, lambda k, _: any_match(k, patterns)))


def remove_keys(df: DataFrame, patterns: Iterable[str], attrs: str = "attrs") -> DataFrame:
    """Drop keys that match any pattern, in any case."""
    patterns = [f"(?i){p}" for p in patterns]
    if not patterns:
        return df
    return df.withColumn(attrs, F.map_filter(attrs, lambda k, _: ~any_match(k, patterns)))


def drop_unmatched_keys(
    df: DataFrame, filters: Iterable[Mapping[str, object]], attrs: str = "attrs"
) -> DataFrame:
    """Key filter: with an ``inverse`` rule last, keys that no inverse rule matches are dropped."""
    filters = list(filters)
    if not filters or not filters[-1].get("inverse"):
        return df

    def wanted(key: Column) -> Column:
        hit = F.lit(False)
        for f in filters:
            if f.get("inverse"):
                hit = hit | matches(key, str(f["key"]), str(f.get("mode") or "regex"))
        return hit

    return df.withColumn(attrs, F.map_filter(attrs, lambda k, _: wanted(k)))


def custom_attributes(df: DataFrame, *levels: Mapping[str, object] | None, attrs: str = "attrs") -> DataFrame:
    """Add constants; a later level overrides an earlier one."""
    merged: dict[str, object] = {}
    for level in levels:
        merged.update(level or {})
    return df.withColumn(attrs, maps.overlay(F.col(attrs), maps.literal(merged))) if merged else df


def add_attributes(df: DataFrame, templates: Mapping[str, str], attrs: str = "attrs") -> DataFrame:
    """New attributes from ``${key}`` templates, each set only if a key was filled in."""
    if not templates:
        return df
    made = {f"_t{i}": fill_template(t, lambda k: F.col(attrs)[k]) for i, t in enumerate(templates.values())}
    added = [F.when(F.col(c).isNotNull(), F.create_map(F.lit(n), F.col(c))) for n, c in zip(templates, made, strict=True)]
    return maps.bind(df.withColumns(made), maps.overlay(F.col(attrs), *added), attrs).drop(*made)


def prefix_keys(df: DataFrame, prefix: str, attrs: str = "attrs") -> DataFrame:
    return _rekey(df, lambda k: F.concat(F.lit(prefix), k), attrs) if prefix else df


def base_url(df: DataFrame, url: str | None, attrs: str = "attrs") -> DataFrame:
    return custom_attributes(df, {"baseUrl": url}, attrs=attrs) if url else df


def clean_event_name(name: Column) -> Column:
    """Only ``[A-Za-z0-9_]``; one leading underscore is removed."""
    return F.regexp_replace(F.regexp_replace(name, "[^a-zA-Z0-9_]", "_"), "^_", "")


def name_events(
    df: DataFrame,
    name: str,
    event_type: str | None = None,
    merging: bool = False,
    error_type: str = "sampleError",
    attrs: str = "attrs",
) -> DataFrame:
    """Set the ``event_type`` column and take the attribute of that name out of the map.

    Error rows keep their type; an explicit type comes next (not for merged sources), then the payload's
    own or its array's name with ``Samples`` -> ``Sample``, then ``<name>Sample``.
    """
    own = F.coalesce(F.col("event_type"), F.col(attrs)["event_type"]) if "event_type" in df.columns else F.col(
        attrs
    )["event_type"]
    automatic = F.coalesce(F.replace(own, F.lit("Samples"), F.lit("Sample")), F.lit(name + "Sample"))
    chosen = F.lit(event_type) if event_type and not merging else automatic
    event = clean_event_name(F.when(own == error_type, own).otherwise(chosen))
    return df.withColumns({"event_type": event, attrs: F.map_filter(attrs, lambda k, _: k != "event_type")})


def rename_samples(df: DataFrame, rules: Mapping[str, str], attrs: str = "attrs") -> DataFrame:
    """Rows with a key that matches a rule get its event type; the first declared rule wins."""

    def has_key(pattern: str) -> Column:
        return F.exists(F.map_keys(attrs), lambda k: k.rlike(java_regex(pattern)))

    hits = [F.when(has_key(pattern), F.lit(event)) for pattern, event in rules.items()]
    return df.withColumn("event_type", F.coalesce(*hits, F.col("event_type"))) if hits else df


# ---------------------------------------------------------------- wide plane


def rekey_columns(df: DataFrame, fn: Callable[[str], str | None], only: Iterable[str] | None = None) -> DataFrame:
    """Rename columns by a Python function at plan time; None drops the column.

    When two columns end up with one name the later one wins where it is not null.
    """
    subject = set(df.columns if only is None else only)
    out: dict[str, Column] = {}
    for c in df.columns:
        new = fn(c) if c in subject else c
        if new is None:
            continue
        col = F.col(f"`{c}`")
        out[new] = F.coalesce(col, out[new]) if new in out else col
    return df.select(*[col.alias(name) for name, col in out.items()])


def camel_name(name: str) -> str:
    head, *rest = name[1:].split("_")
    return name[:1].lower() + head + "".join(r[:1].upper() + r[1:] for r in rest)


def rename_columns(df: DataFrame, rules: Mapping[str, str], only: Iterable[str] | None = None) -> DataFrame:
    def fn(name: str) -> str:
        for pattern, template in rules.items():
            name = re.sub(pattern, re.sub(r"\$\{?(\w+)\}?", r"\\g<\1>", template), name)
        return name

    return rekey_columns(df, fn, only)


def keep_columns(df: DataFrame, patterns: Iterable[str], always: Iterable[str] = ()) -> DataFrame:
    """Column pruning by name; ``always`` columns stay."""
    always, patterns = set(always), list(patterns)
    return df.select(
        *[F.col(f"`{c}`") for c in df.columns if c in always or any(re.search(p, c) for p in patterns)]
    )


def remove_columns(df: DataFrame, patterns: Iterable[str], always: Iterable[str] = ()) -> DataFrame:
    always, patterns = set(always), list(patterns)
    return df.select(
        *[
            F.col(f"`{c}`")
            for c in df.columns
            if c in always or not any(re.search(p, c, re.IGNORECASE) for p in patterns)
        ]
    )
