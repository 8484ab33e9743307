"""Merging, joining and looking up samples across sources."""

from __future__ import annotations

import re
from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from samplecraft.functions import maps, scalars
from samplecraft.functions.rows import each
from samplecraft.functions.scalars import fill_template


@dataclass(frozen=True)
class Source:
    """Samples of one source, in declared order, with its prefix and join key (``a,b`` for a primary)."""

    df: DataFrame
    prefix: str = ""
    join_key: str | None = None
    order: Sequence[str] = ("payload_id", "sample_ix")
    attrs: str = "attrs"

    def prefixed(self) -> Column:
        if not self.prefix:
            return F.col(self.attrs)
        return F.transform_keys(self.attrs, lambda k, _: F.concat(F.lit(self.prefix), k))


def union_samples(*frames: DataFrame) -> DataFrame:
    """All rows of all sources; missing columns are null."""
    out = frames[0]
    for frame in frames[1:]:
        out = out.unionByName(frame, allowMissingColumns=True)
    return out


def merged_entries(sources: Iterable[Source], group: Sequence[str] = ()) -> DataFrame:
    """The merge in long form: ``group, key, value``, one row a key; a later source, and in it a later row, wins a key.

    One aggregation with map-side combining, so only one candidate per key and task is shuffled. Keys may come from the
    data, a million of one group never meet in one value or task.
    """
    group, parts = list(group), []
    for no, source in enumerate(sources):
        entries = F.map_entries(source.prefixed())
        place = F.struct(F.lit(no).alias("no"), *[F.col(c).cast("string" if t == "string" else "bigint").alias(f"o{i}") for i, (c, t) in enumerate((c, dict(source.df.dtypes)[c]) for c in source.order)])
        parts.append(each(source.df, [*group, place.alias("_place")], entries, "_e"))
    rows = parts[0]
    for part in parts[1:]:
        rows = rows.unionByName(part)
    return rows.groupBy(*group, F.col("_e.key").alias("key")).agg(F.max_by("_e.value", "_place").alias("value"))


def assembled(entries: DataFrame, group: Sequence[str] = (), event_type: str | None = None) -> DataFrame:
    """Long form to one sample per group, whose ``attrs`` hold all its keys."""
    merged = entries.groupBy(*group).agg(F.map_from_entries(F.collect_list(F.struct("key", "value"))).alias("attrs"))
    return merged.withColumn("event_type", F.lit(event_type)) if event_type else merged


def merge_samples(sources: Iterable[Source], group: Sequence[str] = (), event_type: str | None = None) -> DataFrame:
    """All rows collapse into one sample per group. Where keys come from the data, prefer ``merged_entries``."""
    return assembled(merged_entries(sources, group), group, event_type)


def comparable(text: Column) -> Column:
    """Form under which keys are compared: numbers by value, with six decimals, all else as it is written."""
    return F.coalesce(scalars.fixed6(scalars.as_number(text)), text)


def latest_by_key(source: Source, key: str) -> DataFrame:
    """One row per key value: of duplicates the last one; ``_key`` and the prefixed attributes."""
    place = F.struct(*source.order)
    rows = source.df.select(comparable(F.col(source.attrs)[key]).alias("_key"), place.alias("_place"), source.prefixed().alias("_attrs"))
    return rows.filter(F.col("_key").isNotNull()).groupBy("_key").agg(F.max_by("_attrs", "_place").alias("_attrs"))


def join_samples(primary: Source, secondaries: Iterable[Source]) -> DataFrame:
    """Left outer join: every primary row, overlaid with the matching row of each secondary.

    A secondary has one join key; it matches if any key of the primary has the same number or text (a later key of the
    primary wins a clash). Duplicate secondary keys: the last wins. Secondary attributes override; prefixes
    of both sides apply. Each (secondary, key) pair is its own equi-join. The primary's rows are counted by key:
    a secondary brings only rows that some key meets, which are broadcast if their measured size is small, and the rows of
    a key that has many are joined in parts, each with its own copy of the one row it meets.
    """
    keys = [k.strip() for k in str(primary.join_key).split(",")]
    names = {key: f"_key{i}" for i, key in enumerate(dict.fromkeys(keys))}
    columns = [primary.prefixed().alias(c) if c == primary.attrs else F.col(f"`{c}`") for c in primary.df.columns]
    df = primary.df.select(*columns, *[comparable(F.col(primary.attrs)[key]).alias(name) for key, name in names.items()])
    sizes = {name: df.where(F.col(name).isNotNull()).groupBy(F.col(name).alias("_key")).agg(F.count("*").alias("_n")) for name in names.values()}
    if not df.isStreaming:
        df = _dealt(df, sizes, primary.attrs)
    for secondary in secondaries:
        latest = latest_by_key(secondary, str(secondary.join_key))
        for key in keys:
            name = names[key]
            if df.isStreaming:
                hit = latest.select(F.col("_key").alias("_k"), F.col("_attrs").alias("_a"))
                df = df.join(hit, F.col(name) == F.col("_k"), "left").drop("_k")
            else:
                parts = F.explode(F.sequence(F.lit(0), _parts(F.col("_n")) - 1))
                hit = latest.join(sizes[name], "_key").select(F.col("_key").alias("_k"), F.col("_attrs").alias("_a"), parts.alias("_p"))
                df = df.join(hit, (F.col(name) == F.col("_k")) & (F.col(f"_part{name}") == F.col("_p")), "left").drop("_k", "_p")
            df = df.withColumn(primary.attrs, maps.overlay(F.col(primary.attrs), F.col("_a"))).drop("_a")
    return df.select(*[F.col(f"`{c}`") for c in primary.df.columns])


#: Rows of one key that are joined together; a key that has more is dealt into parts.
KEY_ROWS = 20_000
#: Parts of the rows without a key.
_KEYLESS = 1_000


def _parts(rows: Column) -> Column:
    return F.ceil(rows / KEY_ROWS).cast("int")


def _dealt(df: DataFrame, sizes: Mapping[str, DataFrame], attrs: str) -> DataFrame:
    """``_part<key>``: which part of its key's rows a row belongs to, by a hash of the row.

    No more keys than one for each ``KEY_ROWS`` rows have parts, so these are few whatever the rows are.
    """
    plain = [f"`{c}`" for c, kind in df.dtypes if "map<" not in kind and "variant" not in kind and not c.startswith("_key")]
    place = F.xxhash64(*plain, F.map_entries(attrs))
    df = df.withColumn("_place", place)
    for name, counted in sizes.items():
        large = counted.where(F.col("_n") > KEY_ROWS).select(F.col("_key").alias("_k"), _parts(F.col("_n")).alias("_of"))
        of = F.when(F.col(name).isNull(), _KEYLESS).otherwise(F.coalesce("_of", F.lit(1)))
        df = df.join(F.broadcast(large), F.col(name) == F.col("_k"), "left").withColumn(f"_part{name}", F.pmod("_place", of).cast("int")).drop("_k", "_of")
    return df.drop("_place")


# ---------------------------------------------------------------- lookups


def lookup_values(df: DataFrame, key: str, name: str = "value", attrs: str = "attrs") -> DataFrame:
    """The distinct values of an attribute as a one-column set; list values are split."""
    value = F.col(attrs)[key]
    listed = F.when(value.startswith("["), F.from_json(value, "array<string>"))
    return each(df, [], F.coalesce(listed, F.array(value)), name).distinct()


_SLOT = re.compile(r"\$\{lookup:(.*?)\}")


def lookup_fan_out(targets: DataFrame, template: str, sets: Mapping[str, DataFrame], key: str = "payload_id") -> DataFrame:
    """Rows of ``targets`` whose key is the template filled with some combination of the named sets.

    ``.../${lookup:a}/${lookup:b}`` stands for the product of the sets, but the product is never built: each key is
    taken apart along the template and every part is checked against its set. A slot that is followed by text is cut at
    each place where the text occurs, one that is followed by another slot at each length that a value of its set has.
    A key that can be taken apart in several ways is in the result once for each, as in the product. Adds one
    ``lookup_<name>`` column per set. A template with an unknown set has no rows.
    """
    names = _SLOT.findall(template)
    if not names:
        return targets
    if any(n not in sets for n in names):
        return targets.limit(0)
    pieces = _SLOT.split(template)[::2]
    values = {n: sets[n].select(F.col(sets[n].columns[0]).cast("string").alias("_v")).where("_v IS NOT NULL").distinct() for n in dict.fromkeys(names)}
    out = targets.filter(F.col(key).startswith(pieces[0])) if pieces[0] else targets
    out = out.withColumn("_left", F.substring(F.col(key), F.lit(len(pieces[0]) + 1), F.length(key)))
    bound: list[str] = []
    for no, (name, after) in enumerate(zip(names, pieces[1:], strict=True)):
        column, last = f"lookup_{name}", no == len(names) - 1
        if name in bound:
            start = F.concat(F.col(f"`{column}`"), F.lit(after))
            out = out.filter(F.startswith("_left", start)).withColumn(
                "_left", F.substring("_left", F.length(start) + 1, F.length("_left"))
            )
            continue
        bound.append(name)
        if last:
            # only the split at the very end of the key fits
            out = out.filter(F.endswith("_left", F.lit(after))).withColumns(
                {column: F.substring("_left", F.lit(1), F.length("_left") - len(after)), "_left": F.lit("")}
            )
        elif after:
            out = _cut(out, column, _cuts_at_text(after))
        else:
            lengths = values[name].agg(F.collect_set(F.length("_v"))).scalar()
            out = _cut(out.withColumn("_lengths", lengths), column, _cuts_at_lengths(F.col("_lengths"))).drop("_lengths")
        out = out.join(values[name], F.col(f"`{column}`") == F.col("_v"), "left_semi")
    return out.filter(F.col("_left") == "").drop("_left")


def _cut(df: DataFrame, column: str, cuts: Column) -> DataFrame:
    """One row for each way to cut ``_left`` into a part and the rest."""
    out = each(df, ["*"], cuts, "_cut")
    return out.withColumns({column: F.col("_cut.part"), "_left": F.col("_cut.left")}).drop("_cut")


def _cuts_at_text(after: str) -> Column:
    """Every place where the text occurs, one within another included."""
    size = len(after)
    places = F.filter(F.sequence(F.lit(1), F.greatest(F.length("_left") - size + 1, F.lit(1))), lambda i: F.substring("_left", i, F.lit(size)) == after)
    return F.transform(
        places,
        lambda i: F.struct(F.substring("_left", F.lit(1), i - 1).alias("part"), F.substring("_left", i + size, F.length("_left")).alias("left")),
    )


def _cuts_at_lengths(lengths: Column) -> Column:
    """After as many characters as some value has; of use are no more lengths than the key has characters."""
    return F.transform(
        F.filter(lengths, lambda n: n <= F.length("_left")),
        lambda n: F.struct(F.substring("_left", F.lit(1), n).alias("part"), F.substring("_left", n + 1, F.length("_left")).alias("left")),
    )


def row_lookup(
    samples: DataFrame,
    targets: DataFrame,
    template: str,
    event_type: str,
    key: str = "payload_id",
    dedupe: Sequence[str] = (),
    order: Sequence[str] = (),
    attrs: str = "attrs",
) -> DataFrame:
    """For every row of an event type, emitted or held back, the target named by the filled template.

    ``${lookup.<Event>:<attr>}`` slots take any attribute; rows that leave a slot open are skipped. The
    lookup row's attributes come along as ``lookup``.
    """
    rows = samples.filter(F.col("event_type") == event_type)
    if dedupe:
        rows = dedupe_lookups(rows, dedupe, order, attrs)
    slots = template.replace("${lookup." + event_type + ":", "${")
    name = fill_template(slots, lambda k: F.col(attrs)[k], need="all")
    wanted = rows.select(name.alias("_target"), F.col(attrs).alias("lookup")).filter(F.col("_target").isNotNull())
    return targets.join(wanted, F.col(key) == F.col("_target")).drop("_target")


def dedupe_lookups(df: DataFrame, keys: Sequence[str], order: Sequence[str] = (), attrs: str = "attrs") -> DataFrame:
    """One row per value of the listed attributes (several: per combination), the first in order.

    Rows without any of them pass.
    """
    values = {f"_d{i}": comparable(F.col(attrs)[k]) for i, k in enumerate(keys)}
    names = list(values)
    named = df.withColumns(values)
    has_any = F.coalesce(*names).isNotNull()
    if order:
        firsts = named.filter(has_any).groupBy(*names).agg(F.min_by(F.struct(*df.columns), F.struct(*order)).alias("_row"))
        firsts = firsts.select("_row.*")
    else:
        firsts = named.filter(has_any).dropDuplicates(names).drop(*names)
    return firsts.unionByName(named.filter(~has_any).drop(*names))


def store_variable(df: DataFrame, key: str, order: Sequence[str], attrs: str = "attrs") -> DataFrame:
    """The last value of an attribute as a one-row, one-column frame."""
    value = F.col(attrs)[key]
    return df.filter(value.isNotNull()).agg(F.max_by(value, F.struct(*order)).alias("value"))


def fill_variables(template: str, variables: Mapping[str, DataFrame | str]) -> Column:
    """Text with ``${var:x}`` filled in; a frame enters as a scalar subquery, a text as a constant.

    Unknown variables stay as they are written.
    """
    pieces, at = [], 0
    for m in re.finditer(r"\$\{var:(.*?)\}", template):
        pieces.append(F.lit(template[at : m.start()]))
        stored = variables.get(m[1])
        value = stored.scalar() if isinstance(stored, DataFrame) else F.lit(stored)
        pieces.append(F.coalesce(value, F.lit(m[0])))
        at = m.end()
    pieces.append(F.lit(template[at:]))
    return F.concat(*pieces)


def lookup_rows(lookup: DataFrame, targets: DataFrame, template: str, key: str = "payload_id") -> DataFrame:
    """Targets named by a ``${lf:column}`` template, once per lookup row that fills at least one slot.

    The lookup columns come along prefixed ``lf_``.
    """
    columns = {c.lower(): c for c in lookup.columns}

    def text_of(name: str) -> Column:
        found = columns.get(name.lower())
        return F.col(f"`{found}`").cast("string") if found else F.lit(None).cast("string")

    name = fill_template(template.replace("${lf:", "${"), text_of)
    wanted = lookup.select(name.alias("_target"), *[F.col(f"`{c}`").alias(f"lf_{c}") for c in lookup.columns])
    return targets.join(wanted.filter(F.col("_target").isNotNull()), F.col(key) == F.col("_target")).drop("_target")
