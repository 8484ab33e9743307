"""Management-bean dumps: flat objects keyed ``domain:k=v,...,attr=A``."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from samplecraft.functions import maps
from samplecraft.functions import variants as V
from samplecraft.functions.rows import each, grouped
from samplecraft.sources.text import lines_of

# What stands in for parts that are missing.
NO_BEAN = "FailedToGetBeanName"
NO_ATTR = "FailedToGetAttrName"
NO_DOMAIN = "CouldNotGetDomain"
NO_QUERY = "CouldNotGetQuery"


def parse_bean_text(df: DataFrame, body: str = "body", payload: str = "payload") -> DataFrame:
    """The one JSON line inside tool output; without exactly that, an object with ``error``."""
    numbered = F.transform(lines_of(F.col(body)), lambda x, i: F.struct(i.alias("i"), x.alias("line")))
    starts = F.filter(numbered, lambda x: x["line"].startswith('{"'))
    ends = F.filter(numbered, lambda x: x["line"].endswith("}"))
    last = lambda a: F.element_at(a, -1)
    line = F.when(
        (F.size(starts) > 0) & (F.size(ends) > 0),
        F.when(last(starts)["i"] == last(ends)["i"], last(starts)["line"]),
    )
    failed = F.parse_json(F.lit('{"error":"Failed to process JMX Data"}'))
    return df.withColumn(payload, F.coalesce(F.try_parse_json(line), failed)).drop(body)


def _bean_name(key: Column) -> Column:
    name = F.regexp_extract(key, "^(.*),attr=.*", 1)
    return F.when(key.rlike("^(.*),attr=.*"), name).otherwise(NO_BEAN)


def _properties(key: Column) -> Column:
    """``k=v`` parts of a key as pairs; parts that are not exactly two are skipped."""
    parts = F.transform(F.split(key, ",", -1), lambda p: F.split(p, "=", -1))
    return F.transform(F.filter(parts, lambda p: F.size(p) == 2), lambda p: maps.pair(p[0], p[1]))


def bean_samples(
    df: DataFrame,
    group_by: str | None = None,
    keep: list[str] | None = None,
    earlier: str | None = None,
    payload: str = "payload",
) -> DataFrame:
    """One row per bean, or per value of the property ``group_by``: ``bean``, ``domain``, its properties and
    ``<attr> = value``. ``earlier`` names a map column copied into each row.
    """
    names = [c for c in df.columns if c not in (payload, earlier)] if keep is None else keep
    rest = [F.col(f"`{c}`") for c in names]

    def entry(e: Column) -> Column:
        key, value = e["key"], V.text(e["value"])
        pairs = F.transform(_properties(key), lambda p: F.when(p["key"] == "attr", maps.pair(p["value"], value)).otherwise(p))
        if group_by:
            group = F.coalesce(F.get(F.filter(_properties(key), lambda p: p["key"] == group_by), 0)["value"], F.lit(""))
        else:
            group = _bean_name(key)
        return F.struct(group.alias("group"), pairs.alias("pairs"))

    def sample(group: Column, entries: Column) -> Column:
        whole = group.contains(":")
        domain = F.when(whole, F.split_part(group, F.lit(":"), F.lit(1))).otherwise(NO_DOMAIN)
        query = F.when(whole, F.regexp_replace(group, "^[^:]*:", "")).otherwise(NO_QUERY)
        pairs = F.flatten(F.transform(entries, lambda e: e["pairs"]))
        found = F.map_from_entries(F.filter(pairs, lambda p: p["value"].isNotNull()))
        layers = [F.create_map(F.lit("bean"), query, F.lit("domain"), domain)]
        layers += [F.col("_earlier")] if earlier else []
        return maps.overlay(*layers, found)

    carried = [F.col(earlier).alias("_earlier")] if earlier else []
    staged = df.select(*rest, *carried, F.transform(V.pairs(F.col(payload)), entry).alias("_entries"))
    return each(staged, rest, grouped(F.col("_entries"), "group", sample), "attrs")


def compressed_bean_samples(df: DataFrame, payload: str = "payload") -> DataFrame:
    """One row per payload; keys are the property values joined by ``.`` and the attribute name."""

    def short(key: Column) -> Column:
        query = F.regexp_replace(_bean_name(key), "^[^:]*:", "")
        named = F.when(_bean_name(key).contains(":"), query).otherwise("")
        values = F.transform(_properties(named), lambda p: p["value"])
        attr = F.when(key.rlike("attr="), F.regexp_extract(key, "^.*attr=(.*)$", 1)).otherwise(NO_ATTR)
        return F.concat(F.array_join(values, "."), F.lit("."), attr)

    pairs = F.transform(V.pairs(F.col(payload)), lambda e: maps.pair(short(e["key"]), V.text(e["value"])))
    attrs = F.map_from_entries(F.filter(pairs, lambda p: p["value"].isNotNull()))
    return df.withColumn("attrs", attrs).drop(payload)
