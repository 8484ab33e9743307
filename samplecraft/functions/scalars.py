"""Value functions as Column -> Column expressions, shared by the map plane and the wide plane."""

from __future__ import annotations

import ast
import re
import string
from collections.abc import Callable, Iterable, Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

from samplecraft.functions.dialect import (
    count_groups,
    java_regex,
    layout_pieces,
    parse_pattern,
)

# The number patterns of the value functions.
PLUCK = r"[+-]?([0-9]*\.?[0-9]+|[0-9]+\.?[0-9]*)([eE][+-]?[0-9]+)?"
_MAYBE_HUGE = r"[eE]\+?[0-9]{3}|[0-9]{309}"
_NUMBER = r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$"
#: Numbers that are finite by their length, and what any other text that has a value begins with.
_FINITE = r"^[+-]?(?:[0-9]{1,200}(?:\.[0-9]*)?|\.[0-9]+)(?:[eE][+-]?[0-9]{1,2})?$"
_MAYBE_VALUE = r"^(?:[+-]?[0-9.]|[+-]?[iI][nN][fF]|[nN][aA][nN])"


# ---------------------------------------------------------------- numbers


def as_number(text: Column) -> Column:
    """The text as a double if it is strictly a number, else null (no trimming, no suffixes)."""
    number = F.when(text.rlike(_NUMBER), text.try_cast("double"))
    return F.when(text.rlike(_MAYBE_HUGE), F.when(F.abs(number) < float("inf"), number)).otherwise(number)


def lowered(text: Column) -> Column:
    """``lower``, which costs many times the checks, called only for letters that plain translation does not do."""
    plain = F.when(text.rlike("[A-Z]"), F.translate(text, string.ascii_uppercase, string.ascii_lowercase)).otherwise(text)
    return F.when(text.rlike(r"[^\x00-\x7F]"), F.lower(text)).otherwise(plain)


def metric_value(text: Column, dimensional: bool = False) -> Column:
    """The double a sample value is reported as, null if it stays an attribute.

    ``inf`` and ``nan`` spellings are attributes; ``-inf`` and ``-infinity`` are numbers. Dimensional
    payloads exclude ``infinity`` only. Most texts are settled by one pattern; lambdas, which are interpreted, would
    try all of them on each value.
    """
    low = lowered(text)
    value = F.when(low.isin("-inf", "-infinity"), F.lit(float("-inf")))
    if dimensional:
        value = value.when(low.isin("inf", "+inf", "+infinity"), F.lit(float("inf")))
        value = value.when(low == "nan", F.lit(float("nan")))
    else:
        value = value.when(low == "+infinity", F.lit(float("inf")))
    value = value.otherwise(as_number(text))
    return F.when(text.rlike(_FINITE), text.try_cast("double")).when(text.rlike(_MAYBE_VALUE), value)


def fixed6(number: Column) -> Column:
    """Six decimals, never scientific."""
    return F.when(number.isNotNull(), F.format_string("%.6f", number.cast("double")))


def integral(number: Column) -> Column:
    """No decimals, half to even."""
    return F.bround(number.try_cast("decimal(38,10)"), 0).cast("decimal(38,0)").cast("string")


def shortest(number: Column) -> Column:
    """Shortest text of a double; ``d.ddde+XX`` below 1e-4 and from 1e6 on."""
    x = number.cast("double")
    text, size = x.cast("string"), F.abs(x)
    shift = F.regexp_replace(F.regexp_replace(text, r"(?:\.0)?E(-?)(\d)$", "e$1+0$2"), r"(?:\.0)?E(-?)(\d\d+)$", "e$1+$2")
    millions = F.regexp_replace(text, r"^(-?\d)(\d{6})\.(\d+)$", "$1.$2$3")
    return (
        F.when(F.isnan(x), "NaN")
        .when(x == 0, "0")
        .when((size >= 1e-3) & (size < 1e6), F.regexp_replace(text, r"\.0$", ""))
        .when(size == float("inf"), F.when(x > 0, "+Inf").otherwise("-Inf"))
        .when((size >= 1e6) & (size < 1e7), F.concat(F.regexp_replace(millions, r"\.?0+$", ""), F.lit("e+06")))
        .when(
            (size >= 1e-4) & (size < 1e-3),
            F.regexp_replace(F.regexp_replace(text, r"\.0E", "E"), r"^(-?)(\d)\.?(\d*)E-4$", r"$1\0.000$2$3"),
        )
        .when(x.isNotNull(), F.replace(shift, F.lit("-+"), F.lit("-")))
    )


def number_text(number: Column) -> Column:
    """Canonical text of a computed double: whole numbers without a fraction."""
    whole = (F.floor(number) == number) & (F.abs(number) < 1e15)
    return F.when(whole, number.try_cast("bigint").cast("string")).otherwise(number.cast("string"))


# ---------------------------------------------------------------- matching


def matches(text: Column, pattern: str, mode: str = "regex") -> Column:
    """The shared predicate: ``prefix``, ``suffix``, ``contains`` or ``regex``; other modes never match."""
    if mode == "regex":
        return text.rlike(java_regex(pattern))
    if mode == "prefix":
        return text.startswith(pattern)
    if mode == "suffix":
        return text.endswith(pattern)
    if mode == "contains":
        return text.contains(pattern)
    return F.lit(False)


def any_match(text: Column, patterns: Iterable[str], mode: str = "regex") -> Column:
    """True if any pattern matches; one regex for all of them in regex mode."""
    patterns = list(patterns)
    if mode == "regex" and patterns:
        return text.rlike("|".join(f"(?:{java_regex(p)})" for p in patterns))
    hit = F.lit(False)
    for p in patterns:
        hit = hit | matches(text, p, mode)
    return hit


# ---------------------------------------------------------------- text values


def strip_percent(text: Column) -> Column:
    return F.regexp_replace(text, "%+$", "")


def first_match(text: Column, pattern: str) -> Column:
    """First regex match, or the text itself."""
    return F.coalesce(F.regexp_substr(text, F.lit(java_regex(pattern))), text)


def pluck_number(text: Column) -> Column:
    return first_match(text, PLUCK)


def fill_value(text: Column, template: str) -> Column:
    """Put the value into ``${value}``."""
    parts = template.split("${value}")
    pieces = [F.lit(parts[0])]
    for part in parts[1:]:
        pieces += [text, F.lit(part)]
    return F.concat(*pieces)


def micros_to_millis(text: Column) -> Column:
    """Number before the microsecond sign, divided by 1000; 0 if there is none."""
    number = F.coalesce(as_number(F.split_part(text, F.lit("µs"), F.lit(1))), F.lit(0.0))
    return number_text(number / 1000)


def map_value(text: Column, rules: Iterable[str]) -> Column:
    """First ``regex=>template`` rule whose groups match; null if none does."""
    hits = []
    for rule in rules:
        parts = rule.split("=>")
        if len(parts) != 2 or count_groups(parts[0]) == 0:
            continue
        pattern = java_regex(parts[0])
        pieces, at = [], 0
        for m in re.finditer(r"\$(\d+)", parts[1]):
            group = _known_group(m[1], count_groups(parts[0]))
            if group is None:
                continue
            pieces.append(F.lit(parts[1][at : m.start()]))
            pieces.append(F.regexp_extract(text, pattern, group))
            at = m.start() + 1 + len(str(group))
        pieces.append(F.lit(parts[1][at:]))
        hits.append(F.when(text.rlike(pattern), F.concat(*pieces)))
    return F.coalesce(*hits) if hits else F.lit(None).cast("string")


def _known_group(digits: str, groups: int) -> int | None:
    for length in range(1, len(digits) + 1):
        if 0 < int(digits[:length]) <= groups:
            return int(digits[:length])
    return None


# ---------------------------------------------------------------- time


def to_epoch(text: Column, layout: str = "RFC3339") -> Column:
    """Formatted time -> epoch seconds text, null if it does not parse."""
    pattern, weekday, two_digits = parse_pattern(layout)
    clean = F.regexp_replace(text, " +", " ") if "_2" in layout or weekday else text
    if weekday:
        clean = F.regexp_replace(clean, r"^\p{L}+,? *", "")
    stamp = F.try_to_timestamp(clean, F.lit(pattern))
    if two_digits:  # two digits mean 1969..2068
        stamp = F.when(F.year(stamp) >= 2069, F.timestamp_add("YEAR", F.lit(-100), stamp)).otherwise(stamp)
    return F.unix_timestamp(stamp).cast("string")


def from_epoch(text: Column, layout: str = "RFC3339") -> Column:
    """Epoch seconds text -> formatted time, null if it is not a whole number."""
    seconds = F.when(text.rlike(r"^[+-]?\d+$"), text.try_cast("bigint"))
    return format_time(F.timestamp_seconds(seconds), layout)


def format_time(stamp: Column, layout: str) -> Column:
    """Render a timestamp by an example-date layout, in the session zone."""
    parts, run = [], ""
    for piece in layout_pieces(layout) + ["_end"]:
        if piece not in ("_d", "_end"):
            run += piece
            continue
        if run:
            parts.append(F.date_format(stamp, run))
            run = ""
        if piece == "_d":
            parts.append(F.lpad(F.dayofmonth(stamp).cast("string"), 2, " "))
    return F.concat(*parts)


def convert_time(text: Column, rule: str) -> Column:
    """``TIMESTAMP::layout`` or ``DATE::layout``; the value stays when it cannot be converted."""
    parts = rule.split("::")
    layout = parts[1] if len(parts) == 2 else "RFC3339"
    if parts[0] == "TIMESTAMP":
        return F.coalesce(to_epoch(text, layout), text)
    if parts[0] == "DATE":
        return F.coalesce(from_epoch(text, layout), text)
    return text


# Unit spellings of relative times, as nanoseconds.
_UNITS = {
    "ns": 1,
    "nano": 1,
    "nanosecond": 1,
    "ms": 10**6,
    "milli": 10**6,
    "millisecond": 10**6,
    "s": 10**9,
    "sec": 10**9,
    "second": 10**9,
    "m": 60 * 10**9,
    "min": 60 * 10**9,
    "minute": 60 * 10**9,
    "h": 3600 * 10**9,
    "hr": 3600 * 10**9,
    "hour": 3600 * 10**9,
}


def relative_time(fmt: str = "ms", amount: int = 0, unit: str = "ms", base: Column | None = None) -> Column:
    """Text of ``base`` (default: now) plus ``amount`` units, in one of the named formats.

    Formats: ``ms ns s date datetime datetimetz`` and calendar parts ``year month day hour minute
    second``; each calendar or date format also with ``utc`` (``dateutc``, ``utchour``, ...). Unknown
    formats give milliseconds, unknown units are milliseconds. The session zone is the local zone.
    """
    base = F.current_timestamp() if base is None else base
    nanos = amount * _UNITS.get(unit.lower(), 10**6)
    base_micros = F.unix_micros(base.cast("timestamp"))
    shift = F.lit(nanos // 1000).cast("bigint")
    micros = base_micros + shift
    stamp = F.timestamp_micros(micros)
    utc = "utc" in fmt
    fmt = fmt.replace("utc", "")
    if utc:
        stamp = F.convert_timezone(F.current_timezone(), F.lit("UTC"), stamp.cast("timestamp_ntz"))
    layouts = {"date": "yyyy-MM-dd", "datetime": "yyyy-MM-dd'T'HH:mm:ss"}
    if fmt == "ns":
        return (base_micros * 1000 + F.lit(nanos).cast("bigint")).cast("string")
    if fmt == "s":
        return _floor_div(micros, 1000000)
    if fmt in layouts:
        return F.date_format(stamp, layouts[fmt])
    if fmt == "datetimetz":
        zone = F.lit("Z") if utc else F.date_format(stamp, "XXX")
        return F.concat(F.date_format(stamp, layouts["datetime"]), zone)
    if fmt in ("year", "month", "day", "hour", "minute", "second"):
        return getattr(F, fmt)(stamp).cast("string")
    return _floor_div(micros, 1000)


def _floor_div(n: Column, by: int) -> Column:
    return ((n - F.pmod(n, F.lit(by))) / by).cast("bigint").cast("string")


def fill_relative_times(template: str, base: Column | None = None) -> Column:
    """Text with every ``${timestamp:...}`` replaced, as one Column."""
    pieces, at = [], 0
    for m in re.finditer(r"\$\{timestamp:(.*?)\}", template):
        pieces.append(F.lit(template[at : m.start()]))
        spec = re.fullmatch(r"([a-z]+)(?:([+-])(\d+)(\D+)?)?", m[1])
        if spec and spec[2]:
            amount = int(spec[3]) * (-1 if spec[2] == "-" else 1)
            pieces.append(relative_time(spec[1], amount, spec[4] or "ms", base))
        else:
            pieces.append(relative_time(spec[1] if spec else "ms", base=base))
        at = m.end()
    pieces.append(F.lit(template[at:]))
    return F.concat(*pieces)


# ---------------------------------------------------------------- formulas

_BINARY: Mapping[type, Callable[[Column, Column], Column]] = {
    ast.Add: lambda a, b: a + b,
    ast.Sub: lambda a, b: a - b,
    ast.Mult: lambda a, b: a * b,
    ast.Div: F.try_divide,
    ast.Mod: F.try_mod,
    ast.Pow: F.pow,
}
_COMPARE: Mapping[type, Callable[[Column, Column], Column]] = {
    ast.Eq: lambda a, b: a == b,
    ast.NotEq: lambda a, b: a != b,
    ast.Lt: lambda a, b: a < b,
    ast.LtE: lambda a, b: a <= b,
    ast.Gt: lambda a, b: a > b,
    ast.GtE: lambda a, b: a >= b,
}


def formula(text: str, number_of: Callable[[str], Column]) -> tuple[Column, bool]:
    """Arithmetic, comparison or logic over ``${key}`` as (Column, is_boolean).

    Allowed: numbers, ``${key}``, ``+ - * / % **``, comparisons, ``&& || !`` and parentheses; anything
    else is a ValueError. The result is null unless every key it names is a number.
    """
    keys: list[str] = []

    def name(m: re.Match) -> str:
        if m[1] not in keys:
            keys.append(m[1])
        return f" k{keys.index(m[1])} "

    source = re.sub(r"\$\{(.*?)\}", name, text)
    source = source.replace("&&", " and ").replace("||", " or ")
    source = re.sub(r"!(?!=)", "~", source)
    try:
        tree = ast.parse(source.strip(), mode="eval").body
    except SyntaxError as err:
        raise ValueError(f"not a formula: {text}") from err
    values = [number_of(k) for k in keys]

    def walk(node: ast.expr) -> tuple[Column, bool]:
        if isinstance(node, ast.Constant) and isinstance(node.value, (int, float)) and not isinstance(node.value, bool):
            return F.lit(float(node.value)), False
        if isinstance(node, ast.Name) and re.fullmatch(r"k\d+", node.id) and int(node.id[1:]) < len(keys):
            return values[int(node.id[1:])], False
        if isinstance(node, ast.BinOp) and type(node.op) in _BINARY:
            (a, ab), (b, bb) = walk(node.left), walk(node.right)
            if not ab and not bb:
                return _BINARY[type(node.op)](a, b), False
        if isinstance(node, ast.UnaryOp):
            a, ab = walk(node.operand)
            if isinstance(node.op, ast.USub) and not ab:
                return -a, False
            if isinstance(node.op, ast.UAdd) and not ab:
                return a, False
            if isinstance(node.op, ast.Invert) and ab:
                return ~a, True
        if isinstance(node, ast.Compare) and len(node.ops) == 1 and type(node.ops[0]) in _COMPARE:
            (a, ab), (b, bb) = walk(node.left), walk(node.comparators[0])
            if ab == bb:
                return _COMPARE[type(node.ops[0])](a, b), True
        if isinstance(node, ast.BoolOp):
            parts = [walk(v) for v in node.values]
            if all(is_bool for _, is_bool in parts):
                out = parts[0][0]
                for p, _ in parts[1:]:
                    out = out & p if isinstance(node.op, ast.And) else out | p
                return out, True
        raise ValueError(f"not allowed in a formula: {text}")

    result, is_bool = walk(tree)
    for v in values:
        result = F.when(v.isNotNull(), result)
    return result, is_bool


def fill_template(template: str, text_of: Callable[[str], Column], need: str = "any") -> Column:
    """Put attributes into ``${key}``.

    With ``need="any"`` the result is null unless at least one key is present (a missing key keeps its
    placeholder); with ``need="all"`` it is null unless all are.
    """
    pieces, present, at = [], [], 0
    for m in re.finditer(r"\$\{(.*?)\}", template):
        value = text_of(m[1])
        pieces.append(F.lit(template[at : m.start()]))
        pieces.append(F.coalesce(value, F.lit(m[0])))
        present.append(value.isNotNull())
        at = m.end()
    pieces.append(F.lit(template[at:]))
    if not present:
        return F.lit(None).cast("string")
    ok = present[0]
    for p in present[1:]:
        ok = (ok & p) if need == "all" else (ok | p)
    return F.when(ok, F.concat(*pieces))
