"""Prometheus exposition text. Lines are parsed, and put together to samples, inside the row: nothing shuffles, so all
forms run on streams as they are, and payloads with equal ids stay apart."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from samplecraft.functions import maps, scalars
from samplecraft.functions.rows import each, grouped
from samplecraft.sources.text import lines_of

# The exposition grammar.
_TEXT = r'[^"\\]*+(?:\\.[^"\\]*+)*+'
_KEY = rf'[a-zA-Z_][a-zA-Z0-9_]*+|"{_TEXT}"'
_PAIR = rf'(?:{_KEY})\s*+=\s*+"{_TEXT}"'
_NEXT = r"\s*+(?:,\s*+|(?=\}))"
_SAMPLE = (
    rf"^(?:([a-zA-Z_:][a-zA-Z0-9_:]*+)(?:\s*+\{{\s*+((?:{_PAIR}{_NEXT})*+)\}}\s*+|\s++)"
    rf'|\{{\s*+((?:(?:{_PAIR}|"{_TEXT}"){_NEXT})++)\}}\s*+)'
    r"(\S++)(?:\s++(-?\d++))?\s*+$"
)
# \G: each match begins where the one before ended, so nothing inside a quoted text is taken for a label.
_LABEL = rf'\G(?:({_KEY})\s*+=\s*+"({_TEXT})"|("{_TEXT}"))\s*+,?+\s*+'
_NAME = rf'("{_TEXT}"|\S+)'
_TYPE = rf"^#\s+TYPE\s+{_NAME}\s+(\S+)"
_HELP = rf"^#\s+HELP\s+{_NAME}\s*(.*)$"


def _unescape(text: Column) -> Column:
    plain = F.regexp_replace(text, r"\\n", "\n")
    return F.when(text.contains("\\"), F.regexp_replace(plain, r"\\(.)", "$1")).otherwise(text)


def _labels(text: Column) -> Column:
    """Label map of the text between the braces of a line that has its name before them."""
    names = F.regexp_extract_all(text, F.lit(_LABEL), F.lit(1))
    values = F.regexp_extract_all(text, F.lit(_LABEL), F.lit(2))
    return F.map_from_arrays(F.transform(names, _unquote), F.transform(values, _unescape))


def _unquote(name: Column) -> Column:
    return F.when(name.startswith('"'), _unescape(F.substring(name, F.lit(2), F.length(name) - 2))).otherwise(name)


def _inner_names(text: Column) -> Column:
    """Quoted names among the labels, which stand without a value."""
    return F.filter(F.regexp_extract_all(text, F.lit(_LABEL), F.lit(3)), lambda x: x != "")


def _inner_labels(text: Column) -> Column:
    names = F.regexp_extract_all(text, F.lit(_LABEL), F.lit(1))
    values = F.regexp_extract_all(text, F.lit(_LABEL), F.lit(2))
    pairs = F.zip_with(names, values, lambda n, v: maps.pair(n, v))
    labels = F.filter(pairs, lambda p: p["key"] != "")
    return F.map_from_entries(F.transform(labels, lambda p: maps.pair(_unquote(p["key"]), _unescape(p["value"]))))


#: The types of the grammar as they are reported, and as dimensional rows name them.
_KINDS = ("counter", "gauge", "histogram", "summary", "untyped")


def _shown(kind: Column) -> Column:
    """Upper case; the known words without the call, which costs many times the checks."""
    return F.coalesce(*[F.when(kind == k, F.lit(k.upper())) for k in _KINDS], F.upper(kind))


def _named(kind: Column) -> Column:
    return F.coalesce(*[F.when(kind == k.upper(), F.lit(k)) for k in _KINDS], F.lower(kind))


def _declared(lines: Column, marker: str, pattern: str) -> Column:
    hits = F.filter(lines, lambda x: x.startswith("#") & x.rlike(pattern))
    return F.map_from_entries(
        F.transform(hits, lambda x: maps.pair(_unquote(F.regexp_extract(x, pattern, 1)), F.regexp_extract(x, pattern, 2)))
    )


def _families(types: Column, helps: Column) -> Column:
    """What the name of a sample says: its family, the type and help of that, and the part of a summary or histogram. A name
    that is declared itself is no part of another."""

    def named(name: Column, e: Column, part: Column) -> Column:
        of = F.struct(e["key"].alias("family"), _shown(e["value"]).alias("type"), F.coalesce(helps[e["key"]], F.lit("")).alias("help"), part.cast("string").alias("part"))
        return F.struct(name.alias("key"), of.alias("value"))

    def pieces(e: Column) -> Column:
        ends = F.when(e["value"] == "histogram", F.array(*map(F.lit, ("bucket", "count", "sum")))).when(e["value"] == "summary", F.array(*map(F.lit, ("count", "sum"))))
        made = F.transform(ends, lambda part: named(F.concat(e["key"], F.lit("_"), part), e, part))
        return F.concat(F.coalesce(made, F.array()), F.array(named(e["key"], e, F.lit(None))))

    found = F.flatten(F.transform(F.map_entries(types), pieces))
    own = F.filter(found, lambda e: e["value"]["part"].isNull())
    part = F.filter(found, lambda e: e["value"]["part"].isNotNull())
    return F.map_from_entries(F.concat(part, own))


def parse_lines(df: DataFrame, body: str = "body", go_metrics: bool = True, compat: bool = False) -> DataFrame:
    """Column ``lines`` in place of the text: ``line_no, family, type, help, name, labels, value, part, error`` of each sample.

    Names and label names may be quoted, a quoted name stands among the labels. A line that is no sample is an entry with
    ``line_no`` and ``error``, all else null; one whose value is no number has its fields and ``error``. The forms below take
    no notice of entries without a type.

    ``part`` is ``quantile``, ``bucket``, ``count`` or ``sum`` for the pieces of a summary or histogram and
    null otherwise. ``go_metrics=False`` drops families that start with ``go_`` (``compat``: contain it).
    """
    rest = [F.col(f"`{c}`") for c in df.columns if c != body]
    df = df.select(*rest, F.transform(lines_of(F.col(body)), lambda x: F.rtrim(F.ltrim(x))).alias("_lines"))
    cells = F.transform(
        F.filter(
            F.transform("_lines", lambda x, i: F.struct(i.alias("line_no"), x.alias("line"))),
            lambda x: (x["line"] != "") & ~x["line"].startswith("#"),
        ),
        # one regex pass per line: its groups, separated by a character no line holds
        lambda x: F.struct(
            x["line_no"], F.split(F.regexp_replace(x["line"], _SAMPLE, "$1\u0001$2\u0001$3\u0001$4"), "\u0001", -1).alias("c"), x["line"]
        ),
    )

    # In steps: what a step names once, the next may read several times. Few of them, as each copies its result.
    def with_name(x: Column) -> Column:
        c = x["c"]
        bare = (F.size(c) == 4) & (c[0] != "")
        one = lambda inner: F.when(F.size(inner) == 1, F.nullif(_unquote(inner[0]), F.lit("")))
        name = F.when(bare, c[0]).when(F.size(c) == 4, F.transform(F.array(_inner_names(c[2])), one)[0])
        return F.struct(x["line_no"], x["line"], c.alias("c"), bare.alias("bare"), name.alias("name"))

    def read(x: Column) -> Column:
        c, known = x["c"], x["name"].isNotNull()
        labels = F.when(x["bare"], F.when(c[1] == "", maps.empty()).otherwise(_labels(c[1]))).when(known, _inner_labels(c[2]))
        # named twice, so that the map stays a column of the step before and is not made again for each line
        of = F.when(F.size("_families") > 0, F.col("_families")[x["name"]])
        error = F.when(~known, F.concat(F.lit("no sample: "), x["line"]))
        raw = F.when(known, scalars.lowered(c[3]))
        return F.struct(x["line_no"], x["name"], labels.alias("labels"), of.alias("of"), raw.alias("raw"), error.alias("error"))

    def whole(s: Column) -> Column:
        value, of = s["raw"], s["of"]
        part = F.coalesce(of["part"], F.when((of["type"] == "SUMMARY") & F.map_contains_key(s["labels"], "quantile"), "quantile"))
        # the cast would raise, and catch, an exception for each of these words
        number = (
            F.when(value.isin("inf", "+inf"), F.lit(float("inf")))
            .when(value == "-inf", F.lit(float("-inf")))
            .when(value == "nan", F.lit(float("nan")))
            .otherwise(value.try_cast("double"))
        )
        family = F.coalesce(of["family"], s["name"])
        kind = F.coalesce(of["type"], F.when(s["error"].isNull(), "UNTYPED"))
        text = F.coalesce(of["help"], F.when(s["error"].isNull(), F.coalesce(F.col("_helps")[s["name"]], F.lit(""))))
        no_number = F.when(value.isNotNull() & number.isNull(), F.concat(F.lit("no number: "), value))
        error = F.coalesce(s["error"], no_number)
        return F.struct(
            s["line_no"], family.alias("family"), kind.alias("type"), text.alias("help"), s["name"], s["labels"],
            number.alias("value"), part.alias("part"), error.alias("error"),
        )

    declared = [
        _declared(F.col("_lines"), "TYPE", _TYPE).alias("_types"),
        _declared(F.col("_lines"), "HELP", _HELP).alias("_helps"),
    ]
    df = df.select(*rest, "_lines", *declared)
    df = df.select(*rest, "_lines", "_helps", _families(F.col("_types"), F.col("_helps")).alias("_families"))
    found = F.transform(F.transform(cells, with_name), read)
    if not go_metrics:
        family = lambda s: F.coalesce(s["of"]["family"], s["name"])
        go = lambda s: family(s).contains("go_") if compat else family(s).startswith("go_")
        found = F.filter(found, lambda s: s["error"].isNotNull() | ~go(s))
    return df.select(*rest, F.transform(found, whole).alias("lines"))


def parse_exposition(df: DataFrame, body: str = "body", go_metrics: bool = True, compat: bool = False) -> DataFrame:
    """One row per sample line, with the fields of ``parse_lines``."""
    parsed = parse_lines(df, body, go_metrics, compat)
    rest = [c for c in parsed.columns if c != "lines"]
    return each(parsed, [F.col(f"`{c}`") for c in rest], "lines", "_s").select(*[F.col(f"`{c}`") for c in rest], "_s.*")


def _kept(parsed: DataFrame, keep: Iterable[str] | None) -> list[Column]:
    return [F.col(f"`{c}`") for c in (keep if keep is not None else parsed.columns) if c != "lines"]


def _label_key(labels: Column) -> Column:
    """Groupable form of a label map, independent of the order in the text."""
    return F.sort_array(F.map_entries(labels))


def _bare(labels: Column) -> Column:
    return F.map_filter(labels, lambda k, _: ~k.isin("le", "quantile"))


def _bound(labels: Column, name: str) -> Column:
    """``le`` or ``quantile`` with six decimals, infinities as they are written."""
    raw = labels[name]
    number = scalars.as_number(raw)
    infinite = F.when(scalars.lowered(raw).isin("inf", "+inf"), "+Inf").when(scalars.lowered(raw) == "-inf", "-Inf").otherwise("NaN")
    return F.coalesce(scalars.fixed6(number), infinite)


def _is_family(line: Column) -> Column:
    """Null for a line that is no sample, so that neither side takes it."""
    return line["type"].isin("SUMMARY", "HISTOGRAM")


def _pieces(wanted: Column) -> Column:
    """Lines of summaries and histograms as entries: their family and labels, and the piece as key and value."""

    def entry(line: Column) -> Column:
        labels, part = line["labels"], line["part"]
        key = (
            F.when(part == "quantile", _bound(labels, "quantile"))
            .when(part == "bucket", _bound(labels, "le"))
            .otherwise(part)
        )
        shown = F.when(~((part == "quantile") & F.isnan(line["value"])), scalars.shortest(line["value"]))
        of = F.struct(line["family"], line["type"], line["help"], _label_key(_bare(labels)).alias("lk"))
        return F.struct(of.alias("of"), key.alias("k"), shown.alias("v"))

    return F.transform(wanted, entry)


def _put_together(custom: Column) -> Callable[[Column, Column], Column]:
    def make(of: Column, entries: Column) -> Column:
        found = F.filter(entries, lambda e: e["k"].isNotNull() & e["v"].isNotNull())
        pieces = F.map_from_entries(F.transform(found, lambda e: maps.pair(e["k"], e["v"])))
        zero = maps.literal({"count": "0", "sum": "0"})
        return maps.overlay(_identity(of), custom, F.map_from_entries(of["lk"]), zero, pieces)

    return make


def _identity(of: Column) -> Column:
    return F.create_map(F.lit("name"), of["family"], F.lit("help"), of["help"], F.lit("type"), of["type"])


def raw_samples(
    parsed: DataFrame, keep: Iterable[str] | None = None, custom_attributes: Mapping[str, str] | None = None
) -> DataFrame:
    """One row per metric: ``name, help, type``, labels, and ``value`` or ``count``, ``sum`` and the pieces.

    This and the other forms take the result of ``parse_lines``; ``keep`` are the columns that come along, all by default.
    """
    rest, custom = _kept(parsed, keep), maps.literal(custom_attributes or {})
    single = F.transform(
        F.filter("lines", lambda x: ~_is_family(x)),
        lambda x: maps.overlay(_identity(x), custom, x["labels"], F.create_map(F.lit("value"), scalars.shortest(x["value"]))),
    )
    staged = parsed.select(*rest, single.alias("_single"), _pieces(F.filter("lines", _is_family)).alias("_pieces"))
    rows = F.concat("_single", grouped(F.col("_pieces"), "of", _put_together(custom)))
    return each(staged, rest, rows, "attrs")


def label_samples(
    parsed: DataFrame,
    keep: Iterable[str] | None = None,
    summary: bool = False,
    histogram: bool = False,
) -> DataFrame:
    """Metrics with the same labels share a row: ``<name>.gauge``, ``.counter``, ``.summary.count``,
    ``.summary.sum``, ``.histogram.count``, ``.histogram.sum``; untyped ones keep the bare name.

    Unlabelled metrics are left to ``flattened_sample``. ``summary`` / ``histogram`` hand those families to
    ``full_family_samples`` instead.
    """
    rest = _kept(parsed, keep)
    skipped = [t for t, off in (("SUMMARY", summary), ("HISTOGRAM", histogram)) if off]

    def entry(x: Column) -> Column:
        kind, part, family = x["type"], x["part"], x["family"]
        suffix = F.when(kind == "GAUGE", ".gauge").when(kind == "COUNTER", ".counter").otherwise("")
        key = F.when(
            _is_family(x),
            F.when(part.isin("count", "sum"), F.concat(family, F.lit("."), _named(kind), F.lit("."), part)),
        ).otherwise(F.concat(family, suffix))
        return F.struct(_label_key(_bare(x["labels"])).alias("lk"), key.alias("k"), scalars.shortest(x["value"]).alias("v"))

    lines = F.filter("lines", lambda x: x["type"].isNotNull() & ~x["type"].isin(skipped))
    entries = F.filter(F.transform(lines, entry), lambda e: (F.size(e["lk"]) > 0) & e["k"].isNotNull())
    values = lambda es: F.map_from_entries(F.transform(es, lambda e: maps.pair(e["k"], e["v"])))
    staged = parsed.select(*rest, entries.alias("_entries"))
    rows = grouped(F.col("_entries"), "lk", lambda k, es: maps.overlay(F.map_from_entries(k), values(es)))
    return each(staged, rest, rows, "attrs")


def flattened_sample(
    parsed: DataFrame,
    event_type: str,
    keep: Iterable[str] | None = None,
    key_merge: Iterable[str] = (),
    custom_attributes: Mapping[str, str] | None = None,
) -> DataFrame:
    """Unlabelled gauges and counters of a payload as one row with ``name = main``.

    ``key_merge`` lists attributes (``name``, ``help``, ``type`` or custom ones); the first that exists is
    appended to the key.
    """
    rest, custom = _kept(parsed, keep), dict(custom_attributes or {})
    merged = next((m for m in key_merge if m in custom or m in ("name", "help", "type")), None)

    def pair(x: Column) -> Column:
        key = x["family"]
        if merged:
            key = F.concat(key, F.lit("."), F.lit(custom[merged]) if merged in custom else x["family" if merged == "name" else merged])
        return maps.pair(key, scalars.shortest(x["value"]))

    found = F.filter("lines", lambda x: ~_is_family(x) & (F.size(x["labels"]) == 0))
    staged = parsed.select(*rest, F.transform(found, pair).alias("_found"))
    attrs = maps.overlay(maps.literal({"name": "main"}), F.map_from_entries("_found"), maps.literal(custom))
    # A filter on the size would be pushed below the steps of the parser, as one expression that holds all of them in each other.
    rows = each(staged, rest, F.when(F.size("_found") > 0, F.array(attrs)), "attrs")
    return rows.select(*rest, F.lit(event_type).alias("event_type"), "attrs")


def full_family_samples(
    parsed: DataFrame,
    name: str,
    keep: Iterable[str] | None = None,
    summary: bool = True,
    histogram: bool = True,
    custom_attributes: Mapping[str, str] | None = None,
) -> DataFrame:
    """Summaries and histograms as rows of their own, the event type marked ``Summary`` / ``Histogram``."""
    rest = _kept(parsed, keep)

    def event(mark: str) -> str:
        return name.replace("Sample", f"{mark}Sample") if "Sample" in name else f"{name}{mark}Sample"

    wanted = [t for t, on in (("SUMMARY", summary), ("HISTOGRAM", histogram)) if on]
    staged = parsed.select(*rest, _pieces(F.filter("lines", lambda x: x["type"].isin(wanted))).alias("_pieces"))
    put_together = _put_together(maps.literal(custom_attributes or {}))

    def make(of: Column, entries: Column) -> Column:
        mark = F.when(of["type"] == "SUMMARY", event("Summary")).otherwise(event("Histogram"))
        return F.struct(mark.alias("event_type"), put_together(of, entries).alias("attrs"))

    rows = each(staged, rest, grouped(F.col("_pieces"), "of", make), "_row")
    return rows.select(*rest, "_row.event_type", "_row.attrs")


def dimensional_rows(
    parsed: DataFrame, keep: Iterable[str] = ("payload_id",), custom_attributes: Mapping[str, str] | None = None
) -> DataFrame:
    """Long form: ``metric, type, value, attributes, common``; every metric is typed gauge.

    Untyped metrics and NaN quantiles are left out.
    """
    labels, part, kind = F.col("labels"), F.col("part"), F.col("type")
    metric = F.when(part.isNotNull(), F.concat(F.col("family"), F.lit("_"), part)).otherwise(F.col("family"))
    bound = F.when(part == "quantile", labels["quantile"]).when(part == "bucket", labels["le"])
    attributes = F.when(
        bound.isNotNull(),
        F.create_map(
            F.when(part == "bucket", "le").otherwise("quantile"), F.coalesce(scalars.number_text(scalars.as_number(bound)), bound)
        ),
    ).otherwise(maps.empty())
    common = maps.overlay(
        F.create_map(F.lit("help"), F.col("help")),
        maps.literal(custom_attributes or {}),
        _bare(labels),
        F.create_map(F.lit("prometheusType"), _named(kind)),
    )
    rows = parsed.filter(kind.isin("GAUGE", "COUNTER", "SUMMARY", "HISTOGRAM"))
    rows = rows.filter(~((part == "quantile") & F.isnan("value")) | part.isNull())
    return rows.select(
        *keep,
        metric.alias("metric"),
        F.lit("gauge").alias("type"),
        "value",
        attributes.alias("attributes"),
        common.alias("common"),
    )
