"""Helpers for ``VARIANT`` payloads: everything stays inside the row."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

OBJECT = "map<string,variant>"
ARRAY = "array<variant>"


def as_object(v: Column) -> Column:
    """Fields of an object, null for anything else."""
    return v.try_cast(OBJECT)


def as_array(v: Column) -> Column:
    """Elements of an array, null for anything else."""
    return v.try_cast(ARRAY)


def is_object(v: Column) -> Column:
    return as_object(v).isNotNull()


def is_array(v: Column) -> Column:
    return as_array(v).isNotNull()


def child(v: Column, key: str) -> Column:
    """A field by its exact name; null if missing."""
    quote = '"' if "'" in key else "'"
    return F.try_variant_get(v, f"$[{quote}{key}{quote}]", "variant")


def text(v: Column) -> Column:
    """Text of a scalar; arrays and objects as JSON text; JSON null as null."""
    return v.try_cast("string")


def rebuild(fields: Column) -> Column:
    """Variant from a map or an array of variants."""
    return F.to_variant_object(fields)


def edit_object(v: Column, edit: Callable[[Column], Column]) -> Column:
    """Apply an edit to the fields of an object; other values pass unchanged."""
    return F.coalesce(rebuild(edit(as_object(v))), v)


def edit_elements(v: Column, edit: Callable[[Column], Column]) -> Column:
    """Apply an edit to each element of an array."""
    return rebuild(F.transform(as_array(v), edit))


def pairs(v: Column) -> Column:
    """Fields of an object as an array of (key, value)."""
    return F.map_entries(as_object(v))


SCALAR, LIST, FIELDS = 0, 1, 2
_KIND = (
    "CASE WHEN try_cast({0} AS map<string,variant>) IS NOT NULL THEN 2 "
    "WHEN try_cast({0} AS array<variant>) IS NOT NULL THEN 1 ELSE 0 END"
)


def kind_of(v: Column) -> Column:
    """``FIELDS`` for an object, ``LIST`` for an array, else ``SCALAR``."""
    return F.when(is_object(v), FIELDS).when(is_array(v), LIST).otherwise(SCALAR)


def entry(key: Column, value: Column) -> Column:
    """(path, value, kind): the kind is worked out once, when an entry is made."""
    return F.struct(key.alias("key"), value.alias("value"), kind_of(value).alias("kind"))


#: Levels that are opened by an expression of their own; whatever lies deeper is opened by a fold.
_UNROLLED = 4
#: Turns of folds in each other, which stop asking one level up: 1,024 in all, as no payload nests deeper than the JSON
#: parser's 1,000 levels, and a value that is done asks few more times, whatever its depth.
_TURNS = (4, 4, 4, 4, 4)


def until_done(value: Column, step: Callable[[Column], Column], open_: Callable[[Column], Column]) -> Column:
    """``step`` again and again while ``open_`` holds, inside the row. Rows that need no turn skip the folds."""

    def turned(level: int) -> Callable[[Column], Column]:
        more = step if level == 0 else lambda now: F.aggregate(F.sequence(F.lit(1), F.lit(_TURNS[level - 1])), now, lambda acc, _: turned(level - 1)(acc))
        return lambda now: F.when(open_(now), more(now)).otherwise(now)

    return F.transform(F.array(value), turned(len(_TURNS)))[0]


def flat_pairs(v: Column, sep: str = ".", arrays: bool = False, start: Column | None = None) -> Column:
    """Nested fields as (dotted path, leaf, kind) entries, however deep; empty objects vanish.

    ``arrays=True`` also walks arrays, with the position as a path segment; otherwise an array is a leaf.
    ``start`` is an array of entries to begin with instead of the fields of ``v``.
    """

    def open_one(e: Column) -> Column:
        fields = F.transform(
            pairs(e["value"]), lambda c: entry(F.concat(e["key"], F.lit(sep), c["key"]), c["value"])
        )
        opened = F.when(e["kind"] == FIELDS, fields)
        if arrays:
            elements = F.transform(
                as_array(e["value"]), lambda x, i: entry(F.concat(e["key"], F.lit(sep), i.cast("string")), x)
            )
            opened = opened.when(e["kind"] == LIST, elements)
        return opened.otherwise(F.array(e))

    def nested(e: Column) -> Column:
        return (e["kind"] == FIELDS) | (e["kind"] == LIST) if arrays else e["kind"] == FIELDS

    first = F.transform(pairs(v), lambda c: entry(c["key"], c["value"])) if start is None else start
    return until_done(first, lambda es: F.flatten(F.transform(es, open_one)), lambda es: F.exists(es, nested))


def flat_column(name: str, unopened: list[str] | None = None) -> Column:
    """``flat_pairs`` of a column, as one SQL expression: much cheaper to build than nested lambdas.

    Fields whose own name is in ``unopened`` stay whole.
    """
    made = f"named_struct('key', {{}}, 'value', c.value, 'kind', {_KIND.format('c.value')})"
    fields = "map_entries(try_cast({} AS map<string,variant>))"
    inner = made.format("concat(e.key, '.', c.key)")
    skip = ""
    if unopened:
        listed = ", ".join("'" + u.replace("\\", "\\\\").replace("'", "\\'") + "'" for u in unopened)
        skip = f" AND NOT substring_index(e.key, '.', -1) IN ({listed})"
    opened = f"if(e.kind = 2{skip}, transform({fields.format('e.value')}, c -> {inner}), array(e))"
    nested = f"exists({{}}, e -> e.kind = 2{skip})"
    expand = f"flatten(transform({{}}, e -> {opened}))"
    # what is left after the unrolled levels: folds in each other
    last = f"l{_UNROLLED}"
    body = f"if({nested.format('a0')}, {expand.format('a0')}, a0)"
    for i, turns in enumerate(_TURNS, 1):
        now = last if i == len(_TURNS) else f"a{i}"
        body = f"if({nested.format(now)}, aggregate(sequence(1, {turns}), {now}, (a{i - 1}, i) -> {body}), {now})"
    # innermost first: each level is bound to a name and opened only if it still holds objects
    for i in range(_UNROLLED, 0, -1):
        before = f"l{i - 1}"
        body = f"if({nested.format(before)}, transform(array({expand.format(before)}), l{i} -> {body})[0], {before})"
    start = f"transform({fields.format(f'`{name}`')}, c -> {made.format('c.key')})"
    return F.expr(f"transform(array({start}), l0 -> {body})[0]")


def text_map(leaf_pairs: Column) -> Column:
    """Pairs -> text map without nulls."""
    cells = F.transform(leaf_pairs, lambda e: F.struct(e["key"].alias("key"), text(e["value"]).alias("value")))
    return F.map_from_entries(F.filter(cells, lambda e: e["value"].isNotNull()))
