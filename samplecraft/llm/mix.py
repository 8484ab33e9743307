"""Mixing sources to target weights along a time-varying curriculum, with DataFrame functions only.

A document's size is its number of words `[^\\x20\\x09-\\x0D]+` (null text: 0). Sources, ordered by code point with null
last, take weights in turn from ``SCHEDULE``; together they share ``share`` times all sizes. No target passes ``most``
times the source's size: what is above is shared again by weight until none is, which is the level at which
``sum(least(most * size, level * weight))`` meets the total.

A source is read in whole passes, then in part: documents in hash order while they fit, then, within the one slice of
hash order where the target ends, the smallest documents left, the last of them if more than half of it fits. So whole
documents meet the target within about half of a small document, and none is taken more than ``most`` times (rounded up).

The schedule gives each source a weight that changes linearly over training time, ``start`` at 0 to ``end`` at 1. Its
integral is the demand for the source up to a time; inverting it at the words of the source before a copy gives the
copy's training position in 0 to 1, and a range sort by position gives the training order.

Hash order is cut into about sqrt(rows) / 4 slices, so that a hot source spreads over as many tasks: sums by source and
slice are combined before they are shuffled, and running sums are taken inside one slice. Only tables of one row a
source, or one a source and slice, are ordered as a whole.

Edge cases: null texts have size 0, are taken in whole passes and once more while the rest lasts, with 0 words; a
source of size 0 takes nothing; repeated rows are documents of their own and equal ones may differ in ``taken``, which
of them is immaterial; an empty table gives an empty result. Columns added here replace columns of the same name.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: For each place in the order of sources, repeating: weight, and its factors at the start and the end of training.
SCHEDULE = ((5.0, 1.5, 0.5), (2.0, 1.0, 1.0), (1.0, 0.5, 1.5))
SHARE = 1.5
MOST = 2.0

ADDED = ("size", "source_size", "target", "taken", "positions")


def word_count(column: str) -> F.Column:
    return F.coalesce(F.regexp_count(F.col(column), F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def targets(slices: DataFrame, schedule=SCHEDULE, share: float = SHARE, most: float = MOST) -> DataFrame:
    """One row a source: ``__source, source_size, target, __first, __last``; from rows ``__source, __sum``."""
    sizes = slices.groupBy("__source").agg(F.sum("__sum").alias("source_size"), F.first("__name").alias("__name"))
    place = F.pmod(F.row_number().over(Window.orderBy(F.col("__name").asc_nulls_last())) - 1, F.lit(len(schedule)))

    def entry(k: int) -> F.Column:
        return F.array(*[F.lit(float(x[k])) for x in schedule])[place]

    # One row a source, here and below, so one task may order them all.
    weighed = sizes.select(
        "*", entry(0).alias("__weight"), entry(1).alias("__first"), entry(2).alias("__last"), (F.col("source_size") * F.lit(float(most))).alias("__cap")
    )
    by_level = Window.orderBy(F.col("__cap") / F.col("__weight"), "__source")
    after, before = by_level.rowsBetween(0, Window.unboundedFollowing), by_level.rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy().rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    total = F.sum("source_size").over(everything) * F.lit(float(share))
    level = (total - F.coalesce(F.sum("__cap").over(before), F.lit(0.0))) / F.sum("__weight").over(after)
    filled = weighed.withColumn("__level", level)
    open_level = F.when(F.col("__cap") / F.col("__weight") > F.col("__level"), F.struct(F.col("__cap") / F.col("__weight"), "__source", "__level"))
    found = filled.withColumn("__level", F.min(open_level).over(everything)["__level"])
    return found.select(
        "__source", "source_size", F.coalesce(F.least("__cap", F.col("__level") * F.col("__weight")), F.col("__cap")).alias("target"), "__first", "__last"
    )


def assign(
    docs: DataFrame,
    column: str = "text",
    source: str = "source",
    key: str = "doc_id",
    schedule=SCHEDULE,
    share: float = SHARE,
    most: float = MOST,
) -> DataFrame:
    """``docs`` with ``size``, ``source_size``, ``target``, ``taken`` and ``positions`` (one for each copy in the mix)."""
    n_slices = docs.agg(F.ceil(F.sqrt(F.count("*") + 1) / 4).cast("long")).scalar()
    based = docs.drop(*[c for c in ADDED if c not in (column, source, key)]).select(
        "*",
        F.coalesce(F.concat(F.lit("="), F.col(source).cast("string")), F.lit("")).alias("__source"),
        word_count(column).alias("__size"),
        F.xxhash64(F.col(key), F.col(column)).alias("__hash"),
    )
    based = based.withColumn("__slice", F.pmod("__hash", n_slices))
    # Only these columns are read here; the text is neither kept nor shuffled.
    slices = based.groupBy("__source", "__slice").agg(F.sum("__size").alias("__sum"))
    slices = slices.withColumn("__name", F.expr("if(__source = '', null, substring(__source, 2))"))
    earlier = Window.partitionBy("__source").orderBy("__slice").rowsBetween(Window.unboundedPreceding, -1)
    slices = slices.select("__source", "__slice", "__sum", F.coalesce(F.sum("__sum").over(earlier), F.lit(0)).alias("__start"), "__name")
    plan = slices.join(targets(slices, schedule, share, most), "__source").drop("__name")

    in_slice = Window.partitionBy("__source", "__slice")
    joined = based.join(plan, ["__source", "__slice"])
    passes = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0)).cast("long")
    run = in_slice.orderBy("__hash", key).rowsBetween(Window.unboundedPreceding, 0)
    placed = joined.withColumns({"__passes": passes, "__end": F.col("__start") + F.sum("__size").over(run)})
    placed = placed.withColumn("__rest", F.when(F.col("source_size") > 0, F.col("target") - F.col("__passes") * F.col("source_size")).otherwise(F.lit(0.0)))
    fits = F.col("__end") <= F.col("__rest")
    met = F.coalesce(F.max(F.when(fits, F.col("__end"))).over(in_slice), F.col("__start"))
    last_slice = (F.col("__start") <= F.col("__rest")) & (F.col("__rest") < F.col("__start") + F.col("__sum"))
    placed = placed.withColumns({"__fits": fits, "__gap": F.when(last_slice, F.col("__rest") - met)})
    fill = in_slice.orderBy("__fits", "__size", "__hash", key).rowsBetween(Window.unboundedPreceding, 0)
    placed = placed.withColumn("__fill", F.sum(F.when(~F.col("__fits"), F.col("__size")).otherwise(0)).over(fill) - F.col("__size") / 2)
    filled = ~F.col("__fits") & F.coalesce(F.col("__fill") <= F.col("__gap"), F.lit(False))
    placed = placed.withColumns({"__filled": filled, "__copies": F.col("__passes") + (F.col("__fits") | filled).cast("long")})

    # Words of the source before the middle of a copy, as a part of the target; then the time by which so much is due.
    middle = F.col("__end") - F.col("__size") / 2
    in_rest = F.when(F.col("__filled"), F.col("__rest") - F.col("__gap") + F.col("__fill")).otherwise(middle)

    def position(copy: F.Column) -> F.Column:
        words = copy * F.col("source_size") + F.when(copy < F.col("__passes"), middle).otherwise(in_rest)
        due = F.least(F.lit(1.0), F.when(F.col("target") > 0, words / F.col("target")).otherwise(F.lit(0.0)))
        a, b = F.col("__first"), F.col("__last")
        return due * (a + b) / (a + F.sqrt(a * a + (b * b - a * a) * due))

    copies = F.when(F.col("__copies") > 0, F.sequence(F.lit(0).cast("long"), F.col("__copies") - 1)).otherwise(F.array().cast("array<bigint>"))
    own = [F.col(f"`{c}`") for c in docs.columns if c not in ADDED or c in (column, source, key)]
    return placed.select(
        *own,
        F.col("__size").alias("size"),
        "source_size",
        "target",
        (F.col("__copies") * F.col("__size")).alias("taken"),
        F.transform(copies, position).alias("positions"),
        F.col("__hash"),
    ).drop("__hash")


def mix(docs: DataFrame, column: str = "text", source: str = "source", key: str = "doc_id", **options) -> DataFrame:
    """The mix itself in training order: a row for each copy, with the columns of ``docs``."""
    aside = {c: f"__own_{c}" for c in docs.columns if c in ADDED and c not in (column, source, key)}
    assigned = assign(docs.withColumnsRenamed(aside), column, source, key, **options)
    copies = assigned.withColumn("__position", F.explode("positions"))
    ordered = copies.repartitionByRange("__position", key).sortWithinPartitions("__position", key)
    return ordered.select(*[F.col(f"`{aside.get(c, c)}`").alias(c) for c in docs.columns])
