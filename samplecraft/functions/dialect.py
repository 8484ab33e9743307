"""Translation of the two text dialects users write: RE2-style patterns and example-date layouts."""

from __future__ import annotations

import re

# POSIX classes of RE2 and their Java spelling.
_POSIX = {
    "alnum": r"\p{Alnum}",
    "alpha": r"\p{Alpha}",
    "ascii": r"\p{ASCII}",
    "blank": r"\p{Blank}",
    "cntrl": r"\p{Cntrl}",
    "digit": r"\p{Digit}",
    "graph": r"\p{Graph}",
    "lower": r"\p{Lower}",
    "print": r"\p{Print}",
    "punct": r"\p{Punct}",
    "space": r"\s",
    "upper": r"\p{Upper}",
    "word": r"\w",
    "xdigit": r"\p{XDigit}",
}

# Named time layouts.
LAYOUTS = {
    "ANSIC": "Mon Jan _2 15:04:05 2006",
    "UnixDate": "Mon Jan _2 15:04:05 MST 2006",
    "RubyDate": "Mon Jan 02 15:04:05 -0700 2006",
    "ATOM": "2006-01-02T15:04:05Z07:00",
    "COOKIE": "Monday, 02-Jan-06 15:04:05 MST",
    "ISO8601": "2006-01-02T15:04:05Z0700",
    "RFC822": "Mon, 02 Jan 06 15:04:05 Z0700",
    "RFC850": "Monday, 02-Jan-06 15:04:05 MST",
    "RFC1036": "Mon, 02 Jan 06 15:04:05 Z0700",
    "RFC1123": "Mon, 02 Jan 2006 15:04:05 Z0700",
    "RFC2822": "Mon, 02 Jan 2006 15:04:05 Z0700",
    "RFC3339": "2006-01-02T15:04:05Z07:00",
    "RFC3339Nano": "2006-01-02T15:04:05.999999999Z07:00",
    "RSS": "Mon, 02 Jan 2006 15:04:05 Z0700",
    "W3C": "2006-01-02T15:04:05Z07:00",
}

# Pieces of an example date and the matching datetime pattern letters.
_TOKENS = {
    "January": "MMMM",
    "Monday": "EEEE",
    "-07:00": "xxx",
    "Z07:00": "XXX",
    "-0700": "xx",
    "Z0700": "XX",
    "2006": "yyyy",
    "Jan": "MMM",
    "Mon": "EEE",
    "MST": "z",
    "-07": "x",
    "01": "MM",
    "02": "dd",
    "03": "hh",
    "04": "mm",
    "05": "ss",
    "06": "yy",
    "15": "HH",
    "PM": "a",
    "_2": "_d",
    "1": "M",
    "2": "d",
    "3": "h",
    "4": "m",
    "5": "s",
}
_TOKEN_RE = re.compile(r"[.,](?:0+|9+)(?!\d)|" + "|".join(re.escape(t) for t in _TOKENS))


def java_regex(pattern: str) -> str:
    """Rewrite what Java's regex engine rejects in RE2's spelling, or reads otherwise.

    Named groups and POSIX classes are respelled, and only a line feed ends a line. RE2's flag for ungreedy repetition
    (``U``) has no counterpart and is rejected.
    """
    if re.search(r"\(\?[a-zA-Z]*U", pattern):
        raise ValueError(f"the flag U is not supported: {pattern}")

    def posix(m: re.Match) -> str:
        known = _POSIX.get(m[2])
        if known is None:
            return m[0]
        return known[0] + known[1].swapcase() + known[2:] if m[1] else known

    out = re.sub(r"\[:(\^?)(\w+):\]", posix, pattern.replace("(?P<", "(?<"))
    return f"(?d){out}" if re.search(r"[.^$]", out) else out


def count_groups(pattern: str) -> int:
    """Number of capture groups in a pattern."""
    bare = re.sub(r"\\.", "", java_regex(pattern))
    bare = re.sub(r"\[\^?\]?[^\]]*\]", "", bare)
    return len(re.findall(r"\((?!\?)|\(\?<(?![=!])", bare))


def java_replacement(template: str, groups: int) -> str:
    """Rewrite ``$1``, ``${1}``, ``$name`` and ``$$`` for ``regexp_replace``.

    A group that the pattern does not have is replaced by nothing.
    """

    def literal(text: str) -> str:
        return text.replace("\\", "\\\\").replace("$", "\\$")

    out, at, after_group = "", 0, False
    for m in re.finditer(r"\$(?:(\$)|\{(\w+)\}|(\w+))", template):
        plain = template[at : m.start()]
        out += _guard(literal(plain), after_group)
        after_group = after_group and not plain
        at = m.end()
        name = m[2] or m[3]
        if m[1]:
            out, after_group = out + "\\$", False
        elif not name.isdigit():
            out, after_group = out + "${" + name + "}", False
        elif int(name) <= groups:
            out, after_group = out + f"${int(name)}", True
    return out + _guard(literal(template[at:]), after_group)


def _guard(text: str, after_group: bool) -> str:
    # A digit right after $1 would otherwise be read as part of the group number.
    return "\\" + text if after_group and text[:1].isdigit() else text


def layout_pieces(layout: str) -> list[str]:
    """Split an example-date layout into datetime-pattern pieces.

    The piece ``_d`` stands for a blank-padded day, which datetime patterns cannot express.
    """
    layout = LAYOUTS.get(layout, layout)
    pieces, at = [], 0
    for m in _TOKEN_RE.finditer(layout):
        if m.start() > at:
            pieces.append(_quote(layout[at : m.start()]))
        token = m[0]
        pieces.append(token[0] + "S" * (len(token) - 1) if token[0] in ".," else _TOKENS[token])
        at = m.end()
    if at < len(layout):
        pieces.append(_quote(layout[at:]))
    return pieces


def parse_pattern(layout: str) -> tuple[str, bool, bool]:
    """Pattern for reading: (pattern, text starts with a weekday, year has two digits).

    The weekday is dropped (it carries no information and cannot be parsed); a fraction of a
    second is accepted after the seconds even when the layout has none.
    """
    pieces = layout_pieces(layout)
    weekday = bool(pieces) and pieces[0] in ("EEE", "EEEE")
    if weekday:
        pieces = pieces[1:]
        pieces[0] = pieces[0].lstrip(", ").replace("','", "").lstrip()
    out = []
    for i, piece in enumerate(pieces):
        nxt = pieces[i + 1] if i + 1 < len(pieces) else ""
        if piece.strip(".,") and not piece.strip(".,").strip("S") and "S" in piece:
            piece = "[.SSSSSSSSS]"
        elif piece in ("ss", "s") and not nxt.startswith((".S", ",S")):
            piece += "[.SSSSSSSSS]"
        out.append("d" if piece == "_d" else piece)
    return "".join(out), weekday, "yy" in pieces


def _quote(text: str) -> str:
    return re.sub(r"[A-Za-z\[\]{}#']+", lambda m: "'" + m[0].replace("'", "''") + "'", text)
