"""Helpers for ``MAP<STRING, STRING>`` attributes."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

TEXT_MAP = "map<string,string>"
PAIRS = "array<struct<key:string,value:string>>"


def empty() -> Column:
    return F.create_map().cast(TEXT_MAP)


def no_pairs() -> Column:
    return F.array().cast(PAIRS)


def literal(values: Mapping[str, object]) -> Column:
    """A constant map; values are rendered as text."""
    if not values:
        return empty()
    cells = []
    for key, value in values.items():
        cells += [F.lit(key), value if isinstance(value, Column) else F.lit(str(value))]
    return F.create_map(*cells)


def pair(key: Column, value: Column) -> Column:
    return F.struct(key.cast("string").alias("key"), value.cast("string").alias("value"))


def drop_nulls(attrs: Column) -> Column:
    return F.map_filter(attrs, lambda _, v: v.isNotNull())


def overlay(*layers: Column) -> Column:
    """Union of maps, later layers win; a null layer counts as empty."""
    return F.map_concat(*[F.coalesce(layer, empty()) for layer in layers])


def has_pair(attrs: Column, test: Callable[[Column, Column], Column]) -> Column:
    """True if some (key, value) passes the test; a null value passes none."""
    return F.exists(F.map_entries(attrs), lambda e: F.coalesce(test(e["key"], e["value"]), F.lit(False)))


def bind(df: DataFrame, expr: Column | str, attrs: str = "attrs") -> DataFrame:
    """Set the map column as the output of a one-element explode.

    A later filter on the map then stays above this point. Pushed below, it would hold a copy of the whole
    expression for every mention of the map, and a copy of a copy for every step before.
    """
    rest = [F.col(f"`{c}`") for c in df.columns if c != attrs]
    return df.select(*rest, F.explode(F.array(expr)).alias(attrs))


def to_wide(df: DataFrame, keys: list[str] | Mapping[str, str], attrs: str = "attrs") -> DataFrame:
    """One column per listed attribute (a mapping also casts: key -> type); the map is dropped.

    Values that do not fit the type become null.
    """
    types = keys if isinstance(keys, Mapping) else dict.fromkeys(keys, "string")
    rest = [c for c in df.columns if c != attrs]
    return df.select(*rest, *[F.col(attrs)[k].try_cast(t).alias(k) for k, t in types.items()])


def to_map(df: DataFrame, columns: list[str], attrs: str = "attrs") -> DataFrame:
    """Fold columns into an attribute map; null values are left out."""
    rest = [F.col(f"`{c}`") for c in df.columns if c not in columns]
    folded = literal({c: F.col(f"`{c}`").cast("string") for c in columns})
    return df.select(*rest, drop_nulls(folded).alias(attrs))


def discover_keys(df: DataFrame, attrs: str = "attrs") -> DataFrame:
    """The distinct attribute names, one per row, for choosing the columns of ``to_wide``."""
    return df.select(F.explode(F.map_keys(attrs)).alias("key")).distinct()
