"""Payload shape: path extraction, descent, stripping, lazy flattening, and payload -> samples.

A payload is a ``VARIANT`` column. All steps up to the final explode work inside the row, so none of them
shuffles and all of them run on streams.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from samplecraft.functions import maps, scalars
from samplecraft.functions import variants as V
from samplecraft.functions.rows import each

# One future row: its set, its place, and either a value to flatten or finished attributes.
_ELEMENTS = (
    "array<struct<set_name:string,ix:int,element:variant,id_name:string,id_value:string,attrs:map<string,string>>>"
)


def parse_payloads(df: DataFrame, body: str = "body", payload: str = "payload") -> DataFrame:
    """Decode JSON text; malformed text gives a null payload."""
    return df.withColumn(payload, F.try_parse_json(body))


def payload_objects(df: DataFrame, payload: str = "payload") -> DataFrame:
    """One row per object: arrays are walked, however nested, and bare scalars dropped."""
    objects = F.filter(V.until_done(F.array(F.col(payload)), _open_arrays, lambda xs: F.exists(xs, V.is_array)), V.is_object)
    return _replace_by_each(df, payload, objects)


def _open_arrays(values: Column) -> Column:
    return F.flatten(F.transform(values, lambda x: F.coalesce(V.as_array(x), F.array(x))))


def _replace_by_each(df: DataFrame, payload: str, values: Column) -> DataFrame:
    rest = [F.col(f"`{c}`") for c in df.columns if c != payload]
    return each(df, rest, values, "_one").withColumnRenamed("_one", payload)


# ---------------------------------------------------------------- path extraction


def _steps(path: str) -> list[str | int | None]:
    """``.a.b[].c[0]`` -> field names, positions and None for iteration."""
    steps: list[str | int | None] = []
    for m in re.finditer(r'\."([^"]+)"|\.?\[\s*(-?\d*|"[^"]+")\s*\]|\.([A-Za-z_][\w-]*)', path):
        if m[1] or m[3]:
            steps.append(m[1] or m[3])
        elif m[2].startswith('"'):
            steps.append(m[2].strip('"'))
        else:
            steps.append(int(m[2]) if m[2] else None)
    rest = re.sub(r'\."[^"]+"|\.?\[\s*(?:-?\d*|"[^"]+")\s*\]|\.[A-Za-z_][\w-]*|[.\s]', "", path)
    if rest:
        raise ValueError(f"only paths, [] and commas are supported: {path}")
    return steps


def extract(df: DataFrame, query: str, payload: str = "payload") -> DataFrame:
    """Replace payloads by what ``.a.b``, ``.a[]``, ``.a[0]`` or several of them with commas select.

    Several results are several payloads; an array result stands for its elements; scalars are ignored and
    payloads without a result disappear. A query that starts with ``.[`` addresses the list of payloads: the
    elements of an array payload, or the payload itself.
    """

    def partial_step(step: str | int):
        if isinstance(step, int):
            return lambda v: F.get(V.as_array(v), step)
        return lambda v: V.child(v, step)

    whole = F.col(payload)
    outputs = []
    for path in query.split(","):
        path = path.strip()
        steps = _steps(path)
        current = F.array(whole)
        if path.startswith(".[") and steps:
            listed = F.coalesce(V.as_array(whole), F.array(whole))
            first = steps.pop(0)
            current = listed if first is None else F.array(F.get(listed, first))
        for step in steps:
            if step is None:
                current = F.flatten(
                    F.transform(
                        current,
                        lambda v: F.coalesce(V.as_array(v), F.map_values(V.as_object(v)), F.array().cast(V.ARRAY)),
                    )
                )
            else:
                current = F.transform(current, partial_step(step))
        outputs.append(current)
    found = F.concat(*outputs)
    first_array = F.get(F.filter(found, V.is_array), 0)
    chosen = F.coalesce(V.as_array(first_array), F.filter(found, V.is_object))
    return _replace_by_each(df, payload, chosen)


# ---------------------------------------------------------------- descent


def _scalar_parents(fields: Column, level: int, start: str) -> Column:
    """Scalars beside the start key, renamed ``parent.<level>.<key>``, as text."""
    beside = F.map_filter(
        fields, lambda k, v: (k != start) & ~V.is_object(v) & ~V.is_array(v) & ~F.is_variant_null(v)
    )
    renamed = F.transform_keys(beside, lambda k, _: F.concat(F.lit(f"parent.{level}."), k))
    return F.transform_values(renamed, lambda _, v: V.text(v))


def _as_variants(parents: Column) -> Column:
    return F.transform_values(parents, lambda _, v: v.cast("variant"))


def descend(
    df: DataFrame, start_keys: Iterable[str], inherit_attributes: bool = False, payload: str = "payload"
) -> DataFrame:
    """Start at a nested key: an object is entered, an array ``a`` makes the payload ``{a: [...]}``.

    ``a>b`` collects ``b`` from every element of the array ``a`` into ``{b: [...]}``. A missing key changes
    nothing. With ``inherit_attributes`` scalars beside the start key come along as ``parent.<level>.<key>``;
    for ``a>b`` also the element's other attributes, flattened, on the rows from that element.
    """
    start_keys = list(start_keys)
    current, parents, done = F.col(payload), maps.empty(), F.lit(False)
    out = df
    for level, key in enumerate(start_keys):
        outer, _, inner = key.partition(">")
        out = out.withColumns({"_cur": current, "_par": parents, "_done": done})
        cur = F.col("_cur")
        out = out.withColumn("_found", V.child(cur, outer))
        found = F.col("_found")
        present = found.isNotNull() & ~F.is_variant_null(found)
        own = _scalar_parents(V.as_object(cur), level, key if not inner else "") if inherit_attributes else maps.empty()
        all_parents = maps.overlay(F.col("_par"), own)
        live = ~F.col("_done")
        if inner:
            collected = _collect_nested(found, inner, level, all_parents, inherit_attributes)
            hit = live & V.is_array(found)
            current = F.when(hit, V.rebuild(F.create_map(F.lit(inner), V.rebuild(collected)))).otherwise(cur)
            done = F.col("_done") | hit
            parents = F.when(live & present, all_parents).otherwise(F.col("_par"))
            continue
        to_object, to_array = live & V.is_object(found), live & V.is_array(found)
        element = lambda x: V.edit_object(x, lambda f: F.map_concat(f, _as_variants(all_parents)))
        listed = F.transform(V.as_array(found), element) if inherit_attributes else V.as_array(found)
        entered_value = found
        if level == len(start_keys) - 1 and inherit_attributes:
            entered_value = V.edit_object(found, lambda f: F.map_concat(f, _as_variants(all_parents)))
        current = (
            F.when(to_object, entered_value)
            .when(to_array, V.rebuild(F.create_map(F.lit(outer), V.rebuild(listed))))
            .otherwise(cur)
        )
        done = F.col("_done") | to_array
        parents = F.when(live & present, all_parents).otherwise(F.col("_par"))
    return out.withColumn(payload, current).drop("_cur", "_par", "_done", "_found") if start_keys else df


def _collect_nested(found: Column, inner: str, level: int, parents: Column, inherit: bool) -> Column:
    """``inner`` of every element, each result carrying the attributes of the element it came from."""

    def one(element: Column) -> Column:
        nested = V.child(element, inner)
        items = F.coalesce(
            V.as_array(nested), F.when(V.is_object(nested), F.array(nested)), F.array().cast(V.ARRAY)
        )
        if not inherit:
            return items
        flat = V.flat_pairs(element, arrays=True)
        others = F.filter(flat, lambda e: ~e["key"].contains(inner))
        renamed = F.transform(
            others, lambda e: F.struct(F.concat(F.lit(f"parent.{level}."), e["key"]).alias("key"), e["value"])
        )
        extra = maps.overlay(parents, V.text_map(renamed))
        return F.transform(items, lambda x: V.edit_object(x, lambda f: F.map_concat(f, _as_variants(extra))))

    return F.flatten(F.transform(V.as_array(found), one))


# ---------------------------------------------------------------- strip and lazy flatten


def strip_keys(df: DataFrame, keys: Iterable[str], payload: str = "payload") -> DataFrame:
    """Remove top-level keys, or ``a>b`` one level below ``a`` (an object or the elements of an array)."""
    keys = list(keys)
    nested = [k.split(">") for k in keys if k.count(">") == 1]
    if not keys:
        return df

    def without(gone: list[str]) -> Callable[[Column], Column]:
        return lambda v: V.edit_object(v, lambda f: F.map_filter(f, lambda k, _: ~k.isin(gone)))

    def edit(fields: Column) -> Column:
        left = F.map_filter(fields, lambda k, _: ~k.isin(keys))
        if not nested:
            return left

        def value(key: Column, v: Column) -> Column:
            out = v
            for outer in dict.fromkeys(o for o, _ in nested):
                drop = without([b for a, b in nested if a == outer])
                inside = F.when(V.is_array(v), V.edit_elements(v, drop)).otherwise(drop(v))
                out = F.when(key == outer, inside).otherwise(out)
            return out

        return F.transform_values(left, value)

    return df.withColumn(payload, V.edit_object(F.col(payload), edit))


def lazy_flatten(df: DataFrame, keys: Iterable[str], payload: str = "payload") -> DataFrame:
    """Turn ``a`` into flat keys ``a.flat.0.k`` of the same row instead of rows of their own.

    ``a>b``: an object ``a`` gets all of itself, flattened, under ``b``; in the elements of an array ``a``
    the keys that contain ``b`` are flattened in place.
    """
    for key in keys:
        change = _lazy_value(key)
        df = df.withColumn(payload, V.edit_object(F.col(payload), lambda f: F.transform_values(f, change)))  # noqa: B023
    return df


def _value_map(entries: Column) -> Column:
    return F.map_from_entries(F.transform(entries, lambda e: F.struct(e["key"], e["value"])))


def _lazy_value(key: str) -> Callable[[Column, Column], Column]:
    outer, _, inner = key.partition(">")

    def without_inner(fields: Column) -> Column:
        return F.map_filter(fields, lambda k, _: k != inner)

    def in_element(x: Column) -> Column:
        flat = F.filter(V.flat_pairs(x, arrays=True), lambda e: e["key"].contains(inner))
        return V.edit_object(x, lambda f: F.map_concat(without_inner(f), _value_map(flat)))

    def value(name: Column, v: Column) -> Column:
        if not inner:
            start = F.array(V.entry(F.lit("flat"), v))
            flat = V.rebuild(_value_map(V.flat_pairs(v, arrays=True, start=start)))
            return F.when(name == outer, flat).otherwise(v)
        whole = V.rebuild(_value_map(V.flat_pairs(v, arrays=True)))
        in_object = V.edit_object(
            v, lambda f: F.map_concat(without_inner(f), F.create_map(F.lit(inner), whole))
        )
        edited = F.when(V.is_array(v), V.edit_elements(v, in_element)).otherwise(in_object)
        return F.when(name == outer, edited).otherwise(v)

    return value


# ---------------------------------------------------------------- flatten and explode


def flatten_attrs(df: DataFrame, payload: str = "payload", attrs: str = "attrs") -> DataFrame:
    """Standard flatten of an object into one attribute map; arrays stay as JSON text."""
    return df.withColumn(attrs, V.text_map(V.flat_column(payload))).drop(payload)


def flatten_columns(df: DataFrame, body: str, schema: T.StructType | str, sep: str = ".") -> DataFrame:
    """Standard flatten with a known schema: one column per leaf, in generated code."""
    schema = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    rest = [c for c in df.columns if c != body]

    def leaves(col: Column, struct: T.StructType, path: str) -> list[Column]:
        out = []
        for f in struct.fields:
            name = path + f.name
            inner = col.getField(f.name)
            out += leaves(inner, f.dataType, name + sep) if isinstance(f.dataType, T.StructType) else [
                inner.alias(name)
            ]
        return out

    parsed = df.withColumn("_doc", F.from_json(F.col(body), schema))
    return parsed.select(*rest, *leaves(F.col("_doc"), schema, ""))


# Expressions over a column ``_flat`` of (path, leaf) pairs, kept as SQL text: building the same from nested
# Python lambdas costs a second of driver time per plan.
_SET_NAME = "concat(regexp_replace(e.key, 's$', ''), 'Samples')"
_TEXT = "map_from_entries(filter({}, p -> p.value IS NOT NULL))"
_ARRAYS = "filter(_flat, e -> e.kind = 1)"
_TOP = _TEXT.format(
    "transform(filter(_flat, e -> e.kind = 0 AND NOT contains(e.key, 'Samples')), "
    "e -> named_struct('key', e.key, 'value', try_cast(e.value AS string)))"
)
_OWN = _TEXT.format(
    f"transform(_flat, e -> named_struct('key', if(e.kind = 1, {_SET_NAME}, e.key), "
    "'value', try_cast(e.value AS string)))"
)
_ARRAY_ROWS = (
    "flatten(transform(_arrays, e -> transform(try_cast(e.value AS array<variant>), "
    f"(x, i) -> named_struct('set_name', {_SET_NAME}, 'ix', i, 'element', x, 'id_name', string(null), "
    "'id_value', string(null), 'attrs', cast(null AS map<string,string>)))))"
)


def _set_name(path: Column) -> Column:
    """Array path -> sample set: without a final ``s``, plus ``Samples``."""
    return F.concat(F.regexp_replace(path, "s$", ""), F.lit("Samples"))


def _row(set_name: Column, ix: Column, **parts: Column) -> Column:
    fields = {"element": "variant", "id_name": "string", "id_value": "string", "attrs": maps.TEXT_MAP}
    return F.struct(
        set_name.alias("set_name"),
        ix.cast("int").alias("ix"),
        *[parts.get(f, F.lit(None)).cast(t).alias(f) for f, t in fields.items()],
    )


def to_samples(
    df: DataFrame,
    payload: str = "payload",
    sample_keys: Mapping[str, str] | None = None,
    split_objects: bool = False,
    split_array: bool = False,
    set_header: Iterable[str] = (),
    leaf_array: bool = False,
    strip: Iterable[str] = (),
    time_value_pairs: bool = False,
    number_style: str = "fixed6",
    scalar_key: str = "value",
) -> DataFrame:
    """Flatten object payloads and give one row per sample: ``event_type`` (set name), ``sample_ix``, ``attrs``.

    Every array becomes a set of rows (sets are united, never multiplied); scalars beside the arrays are
    copied into each row and win a clash; a payload without array rows is one row.

    - ``sample_keys``: ``{name: "a>id"}`` turns the object of objects ``a`` into rows with its keys as ``id``.
    - ``split_objects``: each object at the top is a row with ``split.id``; the rest is dropped.
    - ``split_array`` / ``set_header`` / ``leaf_array``: arrays of scalars become rows, see ``_split_arrays``.
    - ``strip``: attributes and row sets to drop after flattening.
    - ``time_value_pairs``: ``values: [[t, v], ...]`` and ``value: [t, v]`` inside elements become rows with
      ``timestamp`` and ``value``.
    """
    strip, p = list(strip), F.col(payload)
    opened = dict(v.split(">", 1) for v in (sample_keys or {}).values() if ">" in v)

    if split_objects:
        members = F.transform(
            F.filter(V.pairs(p), lambda e: V.is_object(e["value"])),
            lambda e: _row(
                F.lit("Samples"), F.lit(0), element=e["value"], id_name=F.lit("split.id"), id_value=e["key"]
            ),
        )
        df = df.withColumns({"_top": maps.empty(), "_rows": members.cast(_ELEMENTS)})
        return _emit_rows(df, payload, scalar_key, False)

    df = df.withColumn("_flat", V.flat_column(payload, list(opened)))
    flat = F.col("_flat")
    df = df.withColumns({"_top": F.expr(_TOP), "_arrays": F.expr(_ARRAYS)})
    if split_array:
        df = _split_arrays(df, list(set_header), leaf_array, number_style)
    else:
        rows = F.expr(_ARRAY_ROWS).cast(_ELEMENTS)
        if opened:
            rows = F.concat(rows, _keyed_rows(flat, opened))
        df = df.withColumn("_rows", rows)
    if strip:
        df = df.withColumns(
            {
                "_top": F.map_filter("_top", lambda k, _: ~k.isin(strip)),
                "_rows": F.filter("_rows", lambda r: ~r["set_name"].isin([k + "Samples" for k in strip])),
            }
        )
    return _emit_rows(df.drop("_flat", "_arrays"), payload, scalar_key, time_value_pairs)


def _keyed_rows(flat: Column, opened: Mapping[str, str]) -> Column:
    """Objects of objects -> rows with the object key as an attribute."""
    own_name = lambda key: F.substring_index(key, ".", -1)

    def rows(e: Column) -> Column:
        ident = F.coalesce(*[F.when(own_name(e["key"]) == a, F.lit(i)) for a, i in opened.items()])
        members = F.filter(V.pairs(e["value"]), lambda m: V.is_object(m["value"]))
        return F.transform(
            members,
            lambda m, i: _row(_set_name(e["key"]), i, element=m["value"], id_name=ident, id_value=m["key"]),
        )

    return F.flatten(F.transform(F.filter(flat, lambda e: e["kind"] == V.FIELDS), rows))


def _emit_rows(df: DataFrame, payload: str, scalar_key: str, time_value_pairs: bool) -> DataFrame:
    """One row per element, or the scalars alone when there is none."""
    rest = [c for c in df.columns if c not in (payload, "_top", "_rows", "event_type", "sample_ix", "attrs")]
    out = df.select(*rest, "_top", F.explode_outer("_rows").alias("_row"))
    out = out.select(*rest, "_top", "_row", F.col("_row.element").alias("_el"))
    el = F.col("_el")
    out = out.withColumn("_flat", V.flat_column("_el"))
    scalar = F.create_map(
        F.when(V.is_array(el), "Samples").otherwise(F.lit(scalar_key)), F.coalesce(V.text(el), F.lit(""))
    )
    own = F.when(F.col("_flat").isNotNull(), F.expr(_OWN)).when(el.isNotNull(), scalar)
    ident = F.when(
        F.col("_row.id_name").isNotNull(), F.create_map("_row.id_name", F.col("_row.id_value"))
    )
    layers = [own, ident, F.col("_row.attrs")]
    if time_value_pairs:
        many, one = V.as_array(V.child(el, "values")), V.as_array(V.child(el, "value"))
        pairs = F.when(F.size(V.as_array(F.get(many, 0))) == 2, F.transform(many, V.as_array)).when(
            F.size(one) == 2, F.array(one)
        )
        out = out.select("*", F.explode_outer(pairs).alias("_pair"))
        opened = F.create_map(
            F.lit("timestamp"),
            V.text(F.col("_pair")[0]).try_cast("double").cast("bigint").cast("string"),
            F.lit("value"),
            F.coalesce(V.text(F.col("_pair")[1]), F.lit("")),
        )
        is_pair = F.col("_pair").isNotNull()
        layers[0] = F.when(is_pair, F.map_filter(own, lambda k, _: k != "valueSamples")).otherwise(own)
        layers.append(F.when(is_pair, opened))
    return out.select(
        *rest,
        F.coalesce(F.col("_top")["event_type"], "_row.set_name").alias("event_type"),
        F.coalesce("_row.ix", F.lit(0)).alias("sample_ix"),
        maps.overlay(*layers, F.col("_top")).alias("attrs"),
    )


def _split_arrays(
    df: DataFrame,
    header: list[str],
    leaf_array: bool,
    number_style: str,
) -> DataFrame:
    """Each innermost array of scalars becomes a row (or, with ``leaf_array``, each scalar does).

    Names come from ``header`` by position, else ``<key><position>``; a leaf row uses the first header and
    has ``index``. Objects on the way give dimensions ``key-sub-...`` from all their scalars; entering an
    object inside an array starts them afresh. Nesting may have any depth.
    """
    render = {"fixed6": scalars.fixed6, "shortest": scalars.shortest}.get(number_style)

    def cell_text(v: Column) -> Column:
        raw = V.text(v)
        numeric = F.schema_of_variant(v).rlike("^(BIGINT|DOUBLE|FLOAT|DECIMAL)")
        shown = F.when(numeric, render(raw.try_cast("double"))).otherwise(raw) if render else raw
        return F.coalesce(shown, F.lit(""))

    is_scalar = lambda v: ~V.is_array(v) & ~V.is_object(v)
    names = F.array(*[F.lit(h) for h in header]) if header else F.array().cast("array<string>")

    def item(key: Column, value: Column, dims: Column) -> Column:
        return F.struct(key.alias("key"), value.alias("value"), dims.alias("dims"))

    def rows_of(a: Column) -> Column:
        cells = F.filter(
            F.transform(V.as_array(a["value"]), lambda x, i: F.struct(i.alias("i"), x.alias("x"))),
            lambda c: is_scalar(c["x"]),
        )
        name = lambda c: F.coalesce(F.get(names, c["i"]), F.concat(a["key"], c["i"].cast("string")))
        sample = lambda ix, attrs: _row(F.concat(a["root"], F.lit("Samples")), ix, attrs=attrs)
        if leaf_array:
            leaf = F.lit(header[0]) if header else None
            return F.transform(
                cells,
                lambda c: sample(
                    c["i"],
                    F.map_concat(
                        F.create_map(
                            leaf if leaf is not None else name(c), cell_text(c["x"]), F.lit("index"), c["i"].cast("string")
                        ),
                        a["dims"],
                    ),
                ),
            )
        row = F.map_from_entries(F.transform(cells, lambda c: maps.pair(name(c), cell_text(c["x"]))))
        return F.when(F.size(cells) > 0, F.array(sample(F.lit(0), F.map_concat(row, a["dims"])))).otherwise(
            F.array().cast(_ELEMENTS)
        )

    def inside(a: Column) -> Column:
        def open_one(x: Column) -> Column:
            flat = V.flat_pairs(x, sep="-")
            prefixed = F.transform(
                flat,
                lambda e: F.struct(F.concat(a["key"], F.lit("-"), e["key"]).alias("key"), e["value"], e["kind"]),
            )
            dims = V.text_map(F.filter(prefixed, lambda e: e["kind"] == V.SCALAR))
            found = F.transform(
                F.filter(prefixed, lambda e: e["kind"] == V.LIST), lambda e: item(e["key"], e["value"], dims)
            )
            return F.when(V.is_array(x), F.array(item(a["key"], x, a["dims"]))).otherwise(found)

        nested = F.filter(V.as_array(a["value"]), lambda x: ~is_scalar(x))
        return F.transform(
            F.flatten(F.transform(nested, open_one)),
            lambda n: F.struct(a["root"].alias("root"), n["key"], n["value"], n["dims"]),
        )

    frontier = F.transform(
        "_arrays",
        lambda e: F.struct(
            e["key"].alias("root"), e["key"].alias("key"), e["value"].alias("value"), maps.empty().alias("dims")
        ),
    )
    # every turn gives the rows of the arrays still open, and opens what is inside them
    def turn(state: Column) -> Column:
        rows = F.concat(state["rows"], F.flatten(F.transform(state["open"], rows_of)))
        return F.struct(F.flatten(F.transform(state["open"], inside)).alias("open"), rows.cast(_ELEMENTS).alias("rows"))

    first = F.struct(frontier.alias("open"), F.array().cast(_ELEMENTS).alias("rows"))
    done = V.until_done(first, turn, lambda state: F.size(state["open"]) > 0)
    return df.withColumn("_rows", done["rows"])
