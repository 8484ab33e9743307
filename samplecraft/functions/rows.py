"""Array -> rows."""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def each(df: DataFrame, keep: Iterable[str | Column], array: Column | str, name: str, pos: str | None = None) -> DataFrame:
    """One row per element, with its position if asked for; rows without elements disappear.

    The array and the kept columns are computed in a step of their own: beside an explode they would be
    evaluated again for every row that comes out. A plain explode also makes the optimizer add
    ``size(array) > 0`` below it, which evaluates the array twice more; the outer form with a filter on the
    result does not.
    """
    array = F.col(array) if isinstance(array, str) else array
    staged = df.select(*keep, array.alias("_each"))
    columns = [F.col(f"`{c}`") for c in staged.columns if c != "_each"]
    if pos:
        out = staged.select(*columns, F.posexplode_outer("_each").alias(pos, name))
        return out.filter(F.col(pos).isNotNull())
    out = staged.select(*columns, F.explode_outer("_each").alias(name))
    return out.filter(F.col(name).isNotNull())


def grouped(entries: Column, key: str, make: Callable[[Column, Column], Column]) -> Column:
    """``make(key, entries of it)`` for each key of an array of entries, in order of appearance."""
    keys = F.array_distinct(F.transform(entries, lambda e: e[key]))
    return F.transform(keys, lambda k: make(k, F.filter(entries, lambda e: e[key] == k)))
