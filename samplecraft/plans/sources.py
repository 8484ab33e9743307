"""Several sources as one plan: lookups, variables, reuse, merges and joins between them, from a list of specs.

A source reads a payload table, or what another source read (``cache``), or those payloads of its table whose key the
template ``payload`` names. Templates, of the key and of custom attributes, may hold

* ``${lookup:x}``: each value of the set ``x``; several slots stand for the product of their sets,
* ``${lookup.Event:key}``: once per row of that event type, emitted or held back, with any of its attributes,
* ``${lf:column}``: once per row of the source's lookup file,
* ``${var:x}``: the variable ``x``, the last value stored by a source or else a given one.

Sources store sets and variables of their rows before these are filtered. Which source needs which is read off the
specs: a set or variable comes from all sources that store it, an event type from those that name it (by event type, renaming,
``emits`` or their own name), else from all that are declared earlier. Order of declaration otherwise only decides ties: of several stored
variables and merged keys the one declared last wins. Sources that need each other are refused.

Sources with ``merge`` are not emitted themselves. Of those with one target, all without a join key collapse into one
sample (per group), and the first with a join key is joined by the others with one. Functions are not applied again.

Everything is lazy: a set is a frame, a variable a scalar subquery, a key template a join. No set is collected and no
product is built. Frames that several others use are passed through ``share``, once (as they are by default;
``persisted`` keeps them until ``release``).
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field, replace
from functools import reduce
from graphlib import CycleError, TopologicalSorter

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from samplecraft.operators import combine, filters
from samplecraft.plans.sampling import SampleSpec, keyed_rows, parsed, payloads_to_rows, selected_rows

_SLOT = re.compile(r"\$\{(lookup|var|lf)(\.[^:}]+)?:(.*?)\}")
_PLACE = ("payload_id", "sample_ix")


@dataclass(frozen=True)
class SourceSpec:
    """One source: what it reads, how its payloads become samples (``sample``), and what it gives to the others."""

    sample: SampleSpec
    input: str | None = None  # payload table; by default that of the source's name
    cache: str | None = None  # read what this source read
    payload: str | None = None  # template of the keys to read
    lookup_file: str | None = None
    dedupe_lookups: Sequence[str] = ()
    store_lookups: Mapping[str, str] = field(default_factory=dict)  # set: attribute
    store_variables: Mapping[str, str] = field(default_factory=dict)  # variable: attribute
    join_key: str | None = None
    emits: Sequence[str] = ()  # event types that the payloads name themselves

    @property
    def name(self) -> str:
        return self.sample.name

    def templates(self) -> list[str]:
        return [t for t in (self.payload, *self.sample.custom_attributes.values()) if isinstance(t, str)]

    def slots(self) -> set[tuple[str, str, str]]:
        """(kind, event type, name) of all slots."""
        return {(kind, event[1:], name) for t in self.templates() for kind, event, name in _SLOT.findall(t)}

    def event_types(self) -> set[str]:
        own = () if self.sample.merge else (self.sample.event_type or f"{self.name}Sample",)
        return {*own, *self.sample.rename_samples.values(), *self.emits}


def persisted(df: DataFrame) -> DataFrame:
    return df.persist(StorageLevel.MEMORY_AND_DISK)


class SourcePlan:
    """The sources of ``specs`` over payload tables, as frames that depend on each other."""

    def __init__(
        self,
        specs: Sequence[SourceSpec],
        inputs: Mapping[str, DataFrame],
        variables: Mapping[str, str] | None = None,
        lookup_files: Mapping[str, DataFrame] | None = None,
        sets: Mapping[str, DataFrame] | None = None,
        group: Sequence[str] = (),
        share: Callable[[DataFrame], DataFrame] | None = None,
    ) -> None:
        """``sets`` and ``variables`` are given ones; ``group`` names columns of all payload tables that part merges."""
        twice = [n for n, k in Counter(s.name for s in specs).items() if k > 1]
        if twice:
            raise ValueError(f"sources of one name: {', '.join(sorted(twice))}")
        self.specs = {s.name: s for s in specs}
        self._inputs, self._given, self._files = dict(inputs), dict(variables or {}), dict(lookup_files or {})
        self._sets, self._group, self._share = dict(sets or {}), list(group), share
        self._made: dict[tuple[str, str], DataFrame] = {}
        self._kept: list[DataFrame] = []
        needs = {name: self._needs(name) for name in self.specs}
        try:
            self.order = tuple(TopologicalSorter(needs).static_order())
        except CycleError as err:
            raise ValueError(f"sources need each other: {' -> '.join(reversed(err.args[1]))}") from None
        # Sources whose samples are looked up besides being emitted.
        self._looked_up = {n for s in specs for _, event, _ in s.slots() if event for n in self._emitting(event, s.name)}

    # ---------------------------------------------------------------- who needs whom

    def _storing(self, kind: str, name: str, but: str) -> list[str]:
        stores = {"lookup": lambda s: s.store_lookups, "var": lambda s: s.store_variables}[kind]
        return [s.name for s in self.specs.values() if name in stores(s) and s.name != but]

    def _emitting(self, event: str, but: str) -> list[str]:
        found = [s.name for s in self.specs.values() if event in s.event_types() and s.name != but]
        names = list(self.specs)
        return found or [n for n in names[: names.index(but)] if not self.specs[n].sample.merge]

    def _needs(self, name: str) -> set[str]:
        spec = self.specs[name]
        found: set[str] = set()
        if spec.cache:
            if spec.cache not in self.specs:
                raise ValueError(f"{name} reads what {spec.cache} read, which is no source")
            found.add(spec.cache)
        elif (spec.input or name) not in self._inputs:
            raise ValueError(f"{name} has no payload table {spec.input or name}")
        for kind, event, slot in spec.slots():
            if event:
                found.update(self._emitting(event, name))
            elif kind == "lf":
                if spec.lookup_file not in self._files:
                    raise ValueError(f"{name} has no lookup file {spec.lookup_file}")
            else:
                found.update(self._storing(kind, slot, name))
        return found

    # ---------------------------------------------------------------- frames

    def _once(self, kind: str, name: str, make: Callable[[], DataFrame], shared: bool = False) -> DataFrame:
        if (kind, name) not in self._made:
            made = make()
            if shared and self._share:
                made = self._share(made)
                self._kept.append(made)
            self._made[kind, name] = made
        return self._made[kind, name]

    def release(self) -> None:
        """Let go of what ``share`` persisted."""
        for df in self._kept:
            df.unpersist()

    def payloads(self, name: str) -> DataFrame:
        """What a source reads: a row for each payload and combination or row that names it."""
        cached = any(s.cache == name for s in self.specs.values())
        return self._once("payloads", name, lambda: self._read(self.specs[name]), cached)

    def rows(self, name: str) -> DataFrame:
        """All rows of a source, before they are held back or filtered (what stores see, and what may be saved)."""
        stores = bool(self.specs[name].store_lookups or self.specs[name].store_variables)
        return self._once("rows", name, lambda: self._rows(self.specs[name]), stores)

    def samples(self, name: str) -> DataFrame:
        """The samples of a source, those held back included (``emit`` false)."""
        return self._once("samples", name, lambda: self._samples(self.specs[name]), name in self._looked_up)

    def lookup_set(self, name: str, but: str = "") -> DataFrame | None:
        """The distinct values stored under a name, and given ones, in a column."""
        given = [self._sets[name]] if name in self._sets else []
        found = [combine.lookup_values(self.rows(n), self.specs[n].store_lookups[name]) for n in self._storing("lookup", name, but)]
        frames = [df.select(F.col(df.columns[0]).cast("string").alias("value")) for df in [*given, *found]]
        return reduce(DataFrame.unionByName, frames).distinct() if frames else None

    def variable(self, name: str, but: str = "") -> DataFrame | str | None:
        """The last stored value as a one-row frame, or the given text."""
        stored = []
        for n in self._storing("var", name, but):
            value = F.col("attrs")[self.specs[n].store_variables[name]]
            stored.append(self.rows(n).select(value.alias("value"), F.struct(*_PLACE).alias("place")).where("value IS NOT NULL"))
        return self._last(stored, name) if stored else self._given.get(name)

    def _last(self, stored: list[DataFrame], name: str) -> DataFrame:
        """Of each source its last value, of these that of the source declared last, and without any the given one."""
        lasts = [s.agg(F.max_by("value", "place").alias("value")).withColumn("no", F.lit(no)) for no, s in enumerate(stored)]
        if name in self._given:
            lasts.append(lasts[0].select(F.lit(self._given[name]).alias("value"), F.lit(-1).alias("no")))
        return reduce(DataFrame.unionByName, lasts).agg(F.max_by("value", F.when(F.col("value").isNotNull(), F.col("no"))).alias("value"))

    def merged(self, target: str) -> list[DataFrame]:
        """The merged sample (of each group) and the joined samples of a target, those there are."""
        members = [s for s in self.specs.values() if s.sample.merge == target]
        of = {s.name: combine.Source(filters.emitted(self.samples(s.name)), s.sample.prefix, s.join_key, _PLACE) for s in members}
        out = []
        loose = [of[s.name] for s in members if not s.join_key]
        if loose:
            out.append(combine.merge_samples(loose, self._group, target))
        keyed = [of[s.name] for s in members if s.join_key]
        if keyed:
            out.append(combine.join_samples(keyed[0], keyed[1:]).withColumn("event_type", F.lit(target)))
        return out

    def emitted(self) -> DataFrame:
        """All samples that leave the plan: ``source`` (a merge target for merged ones), ``payload_id, sample_ix``, group,
        ``event_type`` and ``attrs``."""
        parts = [(n, filters.emitted(self.samples(n))) for n in self.order if not self.specs[n].sample.merge]
        targets = dict.fromkeys(s.sample.merge for s in self.specs.values() if s.sample.merge)
        parts += [(t, df) for t in targets for df in self.merged(t)]
        columns = [*_PLACE, *self._group, "event_type", "attrs"]
        frames = [df.select(F.lit(n).alias("source"), *[F.col(f"`{c}`") for c in columns if c in df.columns]) for n, df in parts]
        return combine.union_samples(*frames)

    # ---------------------------------------------------------------- one source

    def _read(self, spec: SourceSpec) -> DataFrame:
        source = self.payloads(spec.cache) if spec.cache else self._inputs[spec.input or spec.name]
        kinds = {(kind, event) for kind, event, _ in spec.slots() if kind != "var"}
        if spec.payload is None or not _SLOT.search(spec.payload):
            # Slots of attributes alone ask for every payload of the source once per combination.
            if kinds:
                raise ValueError(f"{spec.name} uses lookups, so its payload key must name them")
            return source if spec.payload is None else source.where(F.col("payload_id") == spec.payload)
        if len(kinds) > 1:
            raise ValueError(f"{spec.name} mixes lookups of several kinds")
        kind, event = next(iter(kinds), ("var", ""))
        variables = {n: self.variable(n, spec.name) for k, _, n in spec.slots() if k == "var"}
        held = {n: v for n, v in variables.items() if v is not None}
        template = spec.payload
        if kind == "var":
            return source.where(F.col("payload_id") == combine.fill_variables(template, held))
        for n, v in held.items():
            if isinstance(v, str):
                template = template.replace("${var:" + n + "}", v)
        held = {n: v for n, v in held.items() if not isinstance(v, str)}
        if event:
            return self._read_by_rows(spec, source, template, event, held)
        if kind == "lf":
            file = self._files[spec.lookup_file].withColumns({f"var.{n}": v.scalar() for n, v in held.items()})
            return _as_map(combine.lookup_rows(file, source, _renamed(template, held, "${lf:var.")), "lf_", "lf")
        sets = {n: self.lookup_set(n, spec.name) for k, _, n in spec.slots() if k == "lookup"} | {f"var.{n}": v for n, v in held.items()}
        found = combine.lookup_fan_out(source, _renamed(template, held, "${lookup:var."), {n: s for n, s in sets.items() if s is not None})
        return _as_map(found, "lookup_", "lookup")

    def _read_by_rows(self, spec: SourceSpec, source: DataFrame, template: str, event: str, held: Mapping[str, DataFrame]) -> DataFrame:
        rows = [self.samples(n).select("event_type", "attrs", *_PLACE) for n in self._emitting(event, spec.name)]
        if not rows:
            return source.limit(0)
        known = reduce(DataFrame.unionByName, rows)
        if held:
            cells = [c for n, v in held.items() for c in (F.lit(f"var.{n}"), v.scalar())]
            known = known.withColumn("attrs", F.map_concat("attrs", F.create_map(*cells)))
        named = _renamed(template, held, "${lookup." + event + ":var.")
        return combine.row_lookup(known, source, named, event, "payload_id", spec.dedupe_lookups, _PLACE if spec.dedupe_lookups else ())

    def _filled(self, spec: SourceSpec, template: str) -> Column:
        """A custom attribute: slots become what named the payload; a slot that nothing fills stays as it is written."""
        pieces, at = [], 0
        for m in _SLOT.finditer(template):
            pieces.append(F.lit(template[at : m.start()]))
            pieces.append(F.coalesce(self._slot_value(spec, m[1], m[2], m[3]), F.lit(m[0])))
            at = m.end()
        return F.concat(*pieces, F.lit(template[at:]))

    def _slot_value(self, spec: SourceSpec, kind: str, event: str | None, name: str) -> Column:
        if kind == "var":
            value = self.variable(name, spec.name)
            return value.scalar() if isinstance(value, DataFrame) else F.lit(value).cast("string")
        if kind not in self.payloads(spec.name).columns:
            return F.lit(None).cast("string")
        # columns of a lookup file go by any case
        return F.col(kind)[name.lower() if kind == "lf" else name]

    def _rows(self, spec: SourceSpec) -> DataFrame:
        filled = {k: self._filled(spec, v) if isinstance(v, str) and _SLOT.search(v) else v for k, v in spec.sample.custom_attributes.items()}
        sample = replace(spec.sample, custom_attributes=filled)
        df = payloads_to_rows(parsed(self.payloads(spec.name)), sample)
        return keyed_rows(df, sample)

    def _samples(self, spec: SourceSpec) -> DataFrame:
        df = selected_rows(self.rows(spec.name), spec.sample)
        return df if "emit" in df.columns else df.withColumn("emit", F.lit(True))


def _as_map(df: DataFrame, prefix: str, into: str) -> DataFrame:
    """Columns of one prefix as a map, whatever their names hold."""
    found = [c for c in df.columns if c.startswith(prefix)]
    if not found:
        return df
    cells = [x for c in found for x in (F.lit(c.removeprefix(prefix).lower() if into == "lf" else c.removeprefix(prefix)), F.col(f"`{c}`").cast("string"))]
    return df.withColumn(into, F.create_map(*cells)).drop(*found)


def _renamed(template: str, held: Mapping[str, object], to: str) -> str:
    """Variables enter as one more set, attribute or column."""
    for n in held:
        template = template.replace("${var:" + n + "}", f"{to}{n}" + "}")
    return template


def run_sources(specs: Sequence[SourceSpec], inputs: Mapping[str, DataFrame], **options: object) -> DataFrame:
    """All emitted samples of the sources; see ``SourcePlan`` for the options."""
    return SourcePlan(specs, inputs, **options).emitted()
