"""Where queries register, and the helpers they share."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from samplecraft import prepare
from samplecraft.session import spread

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None, name: str | None = None) -> Callable[[Query], Query]:
    def register(fn: Query) -> Query:
        key = name or fn.__name__
        if key in QUERIES:
            raise ValueError(f"query {key} is registered twice")

        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return fn(prepare(spark), sf_dir)

        QUERIES[key] = run
        if sql:
            ORACLES[key] = sql
        return fn

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spread_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The same rows, dealt to many tasks, for what costs much time a row."""
    return spread(table(spark, sf_dir, name))


def attr(key: str, cast: str | None = None) -> Column:
    value = F.col("attrs")[key]
    return value.try_cast(cast) if cast else value


def doc(**fields: Column | str) -> Column:
    """JSON text of an object with these fields."""
    return F.to_json(F.struct(*[(F.col(v) if isinstance(v, str) else v).alias(k) for k, v in fields.items()]))


def lines(*parts: Column | str) -> Column:
    """Parts joined by line ends; plain strings are constants."""
    return F.concat_ws("\n", *[F.lit(p) if isinstance(p, str) else p for p in parts])


def text(*parts: Column | str) -> Column:
    """Parts joined; plain strings are constants."""
    return F.concat(*[F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts])


def attrs_of(**fields: Column | str) -> Column:
    cells = []
    for k, v in fields.items():
        cells += [F.lit(k), (F.col(v) if isinstance(v, str) else v).cast("string")]
    return F.create_map(*cells)
