"""Value functions on the attribute map; the expressions live in ``functions.scalars``."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from samplecraft.functions import maps, scalars
from samplecraft.functions.dialect import java_regex


def _revalue(df: DataFrame, fn: Callable[[Column, Column], Column], attrs: str) -> DataFrame:
    return df.withColumn(attrs, F.transform_values(attrs, fn))


def _where_key(rules: Mapping[str, str], change: Callable[[Column, str], Column]) -> Callable[[Column, Column], Column]:
    """Apply each rule to the values whose key matches its regex, in declared order."""

    def fn(key: Column, value: Column) -> Column:
        for pattern, rule in rules.items():
            value = F.when(key.rlike(java_regex(pattern)), change(value, rule)).otherwise(value)
        return value

    return fn


def strip_percent(df: DataFrame, attrs: str = "attrs") -> DataFrame:
    return _revalue(df, lambda _, v: scalars.strip_percent(v), attrs)


def micros_to_millis(df: DataFrame, attrs: str = "attrs") -> DataFrame:
    """Values with a microsecond sign become milliseconds under ``<key>.ms``."""

    def entry(e: Column) -> Column:
        hit = e["value"].contains("µs")
        return maps.pair(
            F.when(hit, F.concat(e["key"], F.lit(".ms"))).otherwise(e["key"]),
            F.when(hit, scalars.micros_to_millis(e["value"])).otherwise(e["value"]),
        )

    changed = F.map_from_entries(F.transform(F.map_entries(attrs), entry))
    present = F.exists(F.map_values(attrs), lambda v: v.contains("µs"))
    return df.withColumn(attrs, F.when(present, changed).otherwise(F.col(attrs)))


def lower_values(df: DataFrame, keys: Iterable[str], attrs: str = "attrs") -> DataFrame:
    keys = list(keys)
    return _revalue(df, lambda k, v: F.when(k.isin(keys), F.lower(v)).otherwise(v), attrs) if keys else df


def upper_values(df: DataFrame, keys: Iterable[str], attrs: str = "attrs") -> DataFrame:
    keys = list(keys)
    return _revalue(df, lambda k, v: F.when(k.isin(keys), F.upper(v)).otherwise(v), attrs) if keys else df


def parse_values(df: DataFrame, rules: Mapping[str, str], attrs: str = "attrs") -> DataFrame:
    """Key regex -> first regex match of the value."""
    return _revalue(df, _where_key(rules, scalars.first_match), attrs) if rules else df


def pluck_numbers(df: DataFrame, attrs: str = "attrs") -> DataFrame:
    """The first number in every value."""
    return _revalue(df, lambda _, v: scalars.pluck_number(v), attrs)


def transform_values(df: DataFrame, rules: Mapping[str, str], attrs: str = "attrs") -> DataFrame:
    """Key regex -> template with ``${value}``."""
    return _revalue(df, _where_key(rules, scalars.fill_value), attrs) if rules else df


def convert_times(df: DataFrame, rules: Mapping[str, str], attrs: str = "attrs") -> DataFrame:
    """Key regex -> ``TIMESTAMP::layout`` or ``DATE::layout``."""
    return _revalue(df, _where_key(rules, scalars.convert_time), attrs) if rules else df


def sub_parse(
    df: DataFrame, rules: Iterable[Mapping[str, object]], attrs: str = "attrs", into: str | None = None
) -> DataFrame:
    """``k=v,k=v`` values -> extra attributes ``<key>.<k>``; malformed parts are skipped.

    A rule has ``type`` (match mode), ``key`` and ``split_by`` (two literal separators).
    """
    into = into or attrs
    found = [_sub_pairs(rule, attrs) for rule in rules if len(rule["split_by"]) == 2]
    if not found:
        return df
    return df.withColumn(into, maps.overlay(F.col(into), F.map_from_entries(F.concat(*found))))


def _sub_pairs(rule: Mapping[str, object], attrs: str) -> Column:
    outer, inner = rule["split_by"]

    def parts(e: Column) -> Column:
        cells = F.transform(_split(e["value"], outer), lambda p: _split(p, inner))
        return F.transform(
            F.filter(cells, lambda c: F.size(c) == 2),
            lambda c: maps.pair(F.concat(e["key"], F.lit("."), c[0]), c[1]),
        )

    hits = F.filter(
        F.map_entries(attrs), lambda e: scalars.matches(e["key"], str(rule["key"]), str(rule["type"]))
    )
    return F.flatten(F.transform(hits, parts))


def _split(text: Column, sep: str) -> Column:
    return F.split(text, "\\Q" + sep + "\\E", -1)


def map_values(
    df: DataFrame, rules: Mapping[str, Iterable[str]], attrs: str = "attrs", into: str | None = None
) -> DataFrame:
    """``key`` or ``key=>new`` -> ordered ``regex=>template`` rules; the first that matches wins."""
    into = into or attrs
    layers: dict[str, list[Column]] = {}
    made: dict[str, Column] = {}
    for i, (target, options) in enumerate(rules.items()):
        key, _, new = target.partition("=>")
        made[f"_m{i}"] = scalars.map_value(F.col(attrs)[key], list(options))
        layer = F.when(F.col(f"_m{i}").isNotNull(), F.create_map(F.lit(new or key), F.col(f"_m{i}")))
        layers.setdefault(into if new else attrs, []).append(layer)
    if not made:
        return df
    df = df.withColumns(made)
    for column, found in layers.items():
        df = maps.bind(df, maps.overlay(F.col(column), *found), column)
    return df.drop(*made)


def compute(df: DataFrame, formulas: Mapping[str, str], attrs: str = "attrs") -> DataFrame:
    """New attributes from formulas over ``${key}``; not set when a key is missing or no number."""
    for stage in _formula_stages(formulas):
        used = list(dict.fromkeys(k for t in stage.values() for k in _KEYS.findall(t)))
        numbers = {f"_n{i}": scalars.as_number(F.col(attrs)[k]) for i, k in enumerate(used)}
        made, added = {}, []
        for i, (name, text) in enumerate(stage.items()):
            result, is_bool = scalars.formula(text, lambda k: F.col(f"_n{used.index(k)}"))  # noqa: B023
            made[f"_f{i}"] = result
            shown = F.col(f"_f{i}").cast("string") if is_bool else scalars.number_text(F.col(f"_f{i}"))
            added.append(F.when(F.col(f"_f{i}").isNotNull(), F.create_map(F.lit(name), shown)))
        df = (df.withColumns(numbers) if numbers else df).withColumns(made)
        df = maps.bind(df, maps.overlay(F.col(attrs), *added), attrs).drop(*numbers, *made)
    return df


_KEYS = re.compile(r"\$\{(.*?)\}")


def _formula_stages(formulas: Mapping[str, str]) -> list[dict[str, str]]:
    """Formulas in declared order, a new stage wherever one reads an earlier result of its stage."""
    stages: list[dict[str, str]] = [{}]
    for name, text in formulas.items():
        if any(k in stages[-1] for k in _KEYS.findall(text)):
            stages.append({})
        stages[-1][name] = text
    return [s for s in stages if s]


def render_numbers(df: DataFrame, style: str = "fixed6", attrs: str = "attrs") -> DataFrame:
    """Render numeric values as ``fixed6``, ``shortest`` or ``integral``; other values stay."""
    fn = {"fixed6": scalars.fixed6, "shortest": scalars.shortest, "integral": scalars.integral}[style]
    return _revalue(df, lambda _, v: F.coalesce(fn(scalars.as_number(v)), v), attrs)


# ---------------------------------------------------------------- wide plane


def on_columns(df: DataFrame, fn: Callable[[Column], Column], columns: Iterable[str]) -> DataFrame:
    """Apply a value expression to whole columns: stays in generated code."""
    return df.withColumns({c: fn(F.col(f"`{c}`")) for c in columns})


def compute_columns(df: DataFrame, formulas: Mapping[str, str]) -> DataFrame:
    """Formulas over columns; text columns count only when they are strictly numbers."""
    types = dict(df.dtypes)
    for name, text in formulas.items():
        result, _ = scalars.formula(
            text,
            lambda k: (
                F.lit(None).cast("double")
                if k not in types
                else scalars.as_number(F.col(f"`{k}`"))
                if types[k] == "string"
                else F.col(f"`{k}`").cast("double")
            ),
        )
        df = df.withColumn(name, result)
    return df
