"""Text payloads: key/value lines, columns, blocks and regex fields. All but the row explode stay in the row."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from samplecraft.functions import maps
from samplecraft.functions.dialect import count_groups, java_regex
from samplecraft.functions.rows import each


def lines_of(body: Column) -> Column:
    """Lines of a text, without the empty one after a final newline."""
    return F.split(F.regexp_replace(body, r"\n\z", ""), "\n", -1)


def line_range(lines: Column, start: int = 0, end: int = 0) -> Column:
    """Lines from ``start`` (from 0) up to, not including, ``end``; 0 is no end."""
    if not start and not end:
        return lines
    return F.filter(lines, lambda _, i: (i >= start) & (F.lit(end == 0) | (i < end)))


def _key_values(lines: Column, split_by: str) -> Column:
    """Pairs of the lines that hold the separator, cut at its first place."""
    at = lambda line: F.instr(line, F.lit(split_by))
    return F.transform(
        F.filter(lines, lambda line: at(line) > 0),
        lambda line: maps.pair(
            F.substring(line, F.lit(1), at(line) - 1),
            F.regexp_replace(F.substring(line, at(line) + len(split_by), F.length(line)), r"[\r\n]+$", ""),
        ),
    )


def key_value_samples(
    df: DataFrame,
    split_by: str,
    line_start: int = 0,
    line_end: int = 0,
    custom_attributes: Mapping[str, str] | None = None,
    body: str = "body",
) -> DataFrame:
    """All ``key<sep>value`` lines of a payload form one sample; a later key wins."""
    lines = line_range(lines_of(F.col(body)), line_start, line_end)
    # Entries written later win, so constants go first: a line may override them.
    found = F.map_from_entries(_key_values(lines, split_by))
    attrs = maps.overlay(maps.literal(custom_attributes or {}), found) if custom_attributes else found
    return df.withColumn("attrs", attrs).drop(body)


def column_samples(
    df: DataFrame,
    split_by: str,
    header_split_by: str | None = None,
    set_header: Sequence[str] = (),
    row_header: int = 0,
    row_start: int = 0,
    line_start: int = 0,
    line_end: int = 0,
    regex_match: bool = False,
    header_regex_match: bool = False,
    earlier: str | None = None,
    custom_attributes: Mapping[str, str] | None = None,
    body: str = "body",
) -> DataFrame:
    """Column text: one sample per line, named by the header line or ``set_header``.

    Names and values come from splitting by a regex, or from its groups. Extra values are dropped, missing
    ones absent. ``earlier`` names a map column whose attributes are copied into each row. A text of one
    line is header and data at once.
    """
    first = 0
    if row_start != row_header and row_start >= 1:
        first = row_start
    if line_start != row_header and line_start >= 1:
        first = line_start
    header_line = -1 if set_header else row_header
    df = df.withColumn("_lines", lines_of(F.col(body)))
    if set_header:
        names = F.array(*[F.lit(h) for h in set_header])
    else:
        names = _cells(F.get("_lines", row_header), header_split_by or split_by, header_regex_match)
    rest = [c for c in df.columns if c not in (body, "_lines", earlier)]
    numbered = F.transform("_lines", lambda x, i: F.struct(i.alias("line_no"), x.alias("line")))
    single = F.size("_lines") == 1
    wanted = F.filter(
        numbered,
        lambda x: (((x["line_no"] != header_line) & (x["line_no"] >= first)) | single)
        & (F.lit(line_end == 0) | (x["line_no"] < line_end)),
    )
    carried = [F.col(earlier).alias("_earlier")] if earlier else []
    df = each(df, [*rest, *carried, names.alias("_names")], wanted, "_line")
    df = df.withColumn("_cells", _cells(F.col("_line.line"), split_by, regex_match))
    width = F.least(F.size("_names"), F.size("_cells"))
    row = F.map_from_arrays(F.slice("_names", 1, width), F.slice("_cells", 1, width))
    layers = [row] + ([F.col("_earlier")] if earlier else []) + [maps.literal(custom_attributes or {})]
    out = df.select(*rest, F.col("_line.line_no").alias("sample_ix"), maps.overlay(*layers).alias("attrs"))
    return out.filter(F.size("attrs") > 0)


def _cells(line: Column, pattern: str, groups: bool) -> Column:
    """Parts between regex matches, or the groups of the first match (none if it does not match)."""
    regex = java_regex(pattern)
    if not groups:
        return F.split(line, regex, -1)
    found = F.array(*[F.regexp_extract(line, regex, i + 1) for i in range(count_groups(pattern))])
    return F.when(line.rlike(regex), found).otherwise(F.array().cast("array<string>"))


def split_blocks(df: DataFrame, pattern: str, body: str = "body") -> DataFrame:
    """Add ``blocks``: a line that matches starts a block; the lines before the first are their own block.

    A text of one line is one block; several lines without a match are none.
    """
    regex = java_regex(pattern)
    df = df.withColumn("_lines", lines_of(F.col(body)))
    starts = F.filter(
        F.transform("_lines", lambda x, i: F.when(x.rlike(regex), i)), lambda i: i.isNotNull()
    )
    df = df.withColumn("_starts", starts)
    n = F.size("_lines")
    begin = F.concat(F.array(F.lit(0)), F.col("_starts"))
    blocks = F.transform(
        begin,
        lambda b, i: F.slice("_lines", b + 1, F.coalesce(F.get("_starts", i), n) - b),
    )
    none = F.array().cast("array<array<string>>")
    return df.withColumn(
        "blocks", F.when(n == 1, F.array("_lines")).when(F.size("_starts") == 0, none).otherwise(blocks)
    ).drop("_lines", "_starts")


def block_samples(
    df: DataFrame,
    split_output: str,
    regex_matches: Iterable[Mapping[str, Sequence[str] | str]] = (),
    split_by: str | None = None,
    line_start: int = 0,
    line_end: int = 0,
    body: str = "body",
) -> DataFrame:
    """One sample per block: regex groups named by ``keys``, or key/value lines; empty samples are dropped.

    With ``keys_multi`` the n-th matching line of a block prefixes its keys with ``keys_multi[n]``.
    """
    rest = [c for c in df.columns if c != body]
    out = each(split_blocks(df, split_output, body), rest, "blocks", "_block", pos="sample_ix")
    rules = list(regex_matches)
    if rules:
        pairs = F.concat(*[_fields(F.col("_block"), rule) for rule in rules])
    else:
        pairs = _key_values(line_range(F.col("_block"), line_start, line_end), split_by or "")
    out = out.withColumn("attrs", F.map_from_entries(pairs)).drop("_block")
    return out.filter(F.size("attrs") > 0)


def _fields(block: Column, rule: Mapping[str, Sequence[str] | str]) -> Column:
    pattern, keys = str(rule["expression"]), list(rule.get("keys") or [])
    regex, groups = java_regex(pattern), count_groups(pattern)
    if not groups or not keys:
        return maps.no_pairs()
    multi = list(rule.get("keys_multi") or [])
    prefixes = F.array(*[F.lit(m) for m in multi]) if multi else None

    def fields(line: Column, n: Column) -> Column:
        prefix = F.get(prefixes, n) if prefixes is not None else F.lit("")
        return F.array(
            *[
                maps.pair(F.concat(prefix, F.lit(keys[g])), F.regexp_extract(line, regex, g + 1))
                for g in range(min(groups, len(keys)))
            ]
        )

    hits = F.filter(block, lambda line: line.rlike(regex))
    return F.filter(F.flatten(F.transform(hits, fields)), lambda p: p["key"].isNotNull())
