"""Dense row numbers without putting a whole table, a hot value or a whole group into one task.

The input is evaluated once, into a table in the shared folder. Rows are then dealt into ranges of the whole ordering
key, the last part of which tells any two rows apart, so neither a common prefix nor a hot value makes a large range.
There are as many ranges as the square root of the rows asks for, so both their number and their size stay workable: a
hundred thousand ranges of ten million rows for 10^12.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from samplecraft.session import written

#: Ranges for 10,000 rows.
_RANGES = 10


def in_ranges(df: DataFrame, order: Sequence[str]) -> DataFrame:
    """``df`` as a table, with the number of a row's range (``_range``) and its place there (``_at``): by these two, rows
    are in the given order, nulls first; equal ones stand in any order."""
    held = written(df.withColumn("_tie", F.monotonically_increasing_id()))
    ranges = max(1, round(_RANGES * (held.count() / 10_000) ** 0.5))
    keys = [F.col(f"`{c}`") for c in (*order, "_tie")]
    dealt = held.repartitionByRange(ranges, *keys).sortWithinPartitions(*keys).withColumn("_id", F.monotonically_increasing_id())
    # the number of the partition stands above the 33 bits of the place in it
    places = {"_range": F.shiftright("_id", 33), "_at": F.col("_id").bitwiseAND(F.lit((1 << 33) - 1))}
    return written(dealt.withColumns(places).drop("_tie", "_id"))


def number_rows(df: DataFrame, order: Sequence[str], into: str = "row_no", group: Sequence[str] = ()) -> DataFrame:
    """Number rows 1..n in the given order, per group."""
    order = list(order) or [c for c, t in df.dtypes if not t.startswith(("map", "variant"))]
    group = list(group)
    dealt = in_ranges(df, [*group, *order])
    spans = dealt.groupBy(*group, "_range").agg(F.min("_at").alias("_first"), F.count(F.lit(1)).alias("_n"))
    before = W.partitionBy(*([F.col(f"`{c}`") for c in group] or [F.lit(0)])).orderBy("_range").rowsBetween(W.unboundedPreceding, -1)
    # one row for each range and group in it
    shift = (F.coalesce(F.sum("_n").over(before), F.lit(0)) + 1 - F.col("_first")).alias("_shift")
    keys = [*group, "_range"]
    spans = spans.select(*[F.col(f"`{c}`").alias(f"_k{i}") for i, c in enumerate(keys)], shift)
    same = F.lit(True)
    for i, c in enumerate(keys):
        same = same & F.col(f"`{c}`").eqNullSafe(F.col(f"_k{i}"))
    # without groups there are no more rows than ranges
    shifted = dealt.join(spans if group else F.broadcast(spans), same)
    return shifted.withColumn(into, F.col("_at") + F.col("_shift")).select(*df.columns, into)


def number_any_order(
    df: DataFrame, key: Sequence[str], into: str = "row_no", group: Sequence[str] = (), rows_per_slice: int = 100_000
) -> DataFrame:
    """Number rows 1..n per group in a fixed but arbitrary order.

    ``key`` identifies a row. Rows are spread by its hash over as many slices as the table needs.
    """
    held = written(df)
    slices = held.count() // rows_per_slice + 1
    return _number_sliced(held.withColumn("_slice", F.pmod(F.xxhash64(*key), F.lit(slices))), list(key), into, group)


def _number_sliced(sliced: DataFrame, order: Sequence[str], into: str, group: Sequence[str]) -> DataFrame:
    group = list(group)
    counts = sliced.groupBy(*group, "_slice").agg(F.count(F.lit(1)).alias("_n"))
    keys = [F.col(c) for c in group] or [F.lit(0)]
    before = W.partitionBy(*keys).orderBy("_slice").rowsBetween(W.unboundedPreceding, -1)
    # one row per group and slice: small, however large the table is
    offsets = counts.select(*group, "_slice", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    # The offset leads its slice as a row of its own, so that the table is shuffled once and joined with nothing.
    whole = sliced.unionByName(offsets, allowMissingColumns=True)
    inside = W.partitionBy(*group, "_slice").orderBy(F.col("_before").isNull(), *order)
    number = F.first("_before").over(inside) + F.row_number().over(inside) - 1
    return whole.withColumn(into, number).filter(F.col("_before").isNull()).drop("_slice", "_before")
