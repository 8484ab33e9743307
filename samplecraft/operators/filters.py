"""Sample filters, the emit flag and the event limit."""

from __future__ import annotations

import re
from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from samplecraft.functions import maps, scalars
from samplecraft.functions.dialect import java_regex

Rules = Iterable[Mapping[str, str]]


def _exact(pattern: str) -> str | None:
    """The key a pattern like ``^name$`` pins down, else None."""
    m = re.fullmatch(r"\^([\w-]+)\$", pattern)
    return m[1] if m else None


def _pair_matches(attrs: str, key_re: str, value_re: str, fixed6: bool) -> Column:
    """True if one attribute matches both regexes; a pinned key needs no walk over the map."""

    def value_ok(value: Column) -> Column:
        if fixed6:
            value = F.coalesce(scalars.fixed6(scalars.as_number(value)), value)
        return value.rlike(java_regex(value_re))

    pinned = _exact(key_re)
    if pinned:
        return F.coalesce(value_ok(F.col(attrs)[pinned]), F.lit(False))
    return maps.has_pair(F.col(attrs), lambda k, v: k.rlike(java_regex(key_re)) & value_ok(v))


def matches_any(rules: Rules, attrs: str = "attrs", fixed6: bool = False) -> Column:
    """True if any (key regex, value regex) pair matches an attribute; an empty regex never does."""
    hit = F.lit(False)
    for rule in rules:
        for key_re, value_re in rule.items():
            if key_re and value_re:
                hit = hit | _pair_matches(attrs, key_re, value_re, fixed6)
    return hit


def matches_all(rules: Rules, attrs: str = "attrs", fixed6: bool = False, compat: str | None = None) -> Column:
    """True if every pair matches an attribute; ``compat="last"`` lets the last pair decide alone."""
    flat = [(k, v) for rule in rules for k, v in rule.items()]
    if compat == "last":
        flat = flat[-1:]
    ok = F.lit(True)
    for key_re, value_re in flat:
        ok = ok & _pair_matches(attrs, key_re, value_re, fixed6)
    return ok


def filter_samples(
    df: DataFrame,
    exclude: Rules = (),
    include: Rules = (),
    match_all: Rules = (),
    attrs: str = "attrs",
    fixed6: bool = False,
    compat: str | None = None,
) -> DataFrame:
    """Include first (``match_all`` supersedes it), exclude next."""
    exclude, include, match_all = list(exclude), list(include), list(match_all)
    if not (exclude or include or match_all):
        return df
    df = maps.bind(df, attrs, attrs)
    if match_all:
        df = df.filter(matches_all(match_all, attrs, fixed6, compat))
    elif include:
        df = df.filter(matches_any(include, attrs, fixed6))
    return df.filter(~matches_any(exclude, attrs, fixed6)) if exclude else df


def filter_columns(
    df: DataFrame, exclude: Rules = (), include: Rules = (), only: Iterable[str] | None = None
) -> DataFrame:
    """The same filters on the wide plane: key regexes pick columns at plan time."""
    columns = list(df.columns if only is None else only)

    def hit(rules: Rules) -> Column:
        out = F.lit(False)
        for rule in rules:
            for key_re, value_re in rule.items():
                for c in columns if key_re and value_re else ():
                    if re.search(key_re, c):
                        ok = F.col(f"`{c}`").cast("string").rlike(java_regex(value_re))
                        out = out | F.coalesce(ok, F.lit(False))
        return out

    include, exclude = list(include), list(exclude)
    if include:
        df = df.filter(hit(include))
    return df.filter(~hit(exclude)) if exclude else df


def drop_events(df: DataFrame, filters: Iterable[Mapping[str, str]], attrs: str = "attrs") -> DataFrame:
    """Drop rows with an attribute that matches key and value of any rule under the rule's mode."""
    gone = F.lit(False)
    for f in filters:
        mode = f.get("mode") or "regex"
        value = f.get("value") or (".*" if f.get("mode") == "regex" else "")
        gone = gone | maps.has_pair(
            F.col(attrs),
            lambda k, v, f=f, m=mode, val=value: scalars.matches(k, f["key"], m) & scalars.matches(v, val, m),
        )
    return maps.bind(df, attrs, attrs).filter(~gone)


def hold_back(df: DataFrame, ignore: bool | Column = True) -> DataFrame:
    """Flag rows that are not emitted but stay usable for lookups."""
    flag = ignore if isinstance(ignore, Column) else F.lit(ignore)
    keep = F.col("emit") if "emit" in df.columns else F.lit(True)
    return df.withColumn("emit", keep & ~flag)


def emitted(df: DataFrame) -> DataFrame:
    return df.filter("emit").drop("emit") if "emit" in df.columns else df


def limit_events(df: DataFrame, limit: int) -> DataFrame:
    """At most ``limit`` rows in total; 0 is no limit."""
    return df.limit(limit) if limit else df
