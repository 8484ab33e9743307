"""Queries that once ran over parts of their tables: every row of the tables comes through."""

import pytest
from pyspark.sql import functions as F

from catalog import QUERIES

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", ["join_with_secondaries", "lookup_fan_out", "row_lookup"])
def test_every_order_once(spark, name):
    orders = spark.read.parquet(f"{SF}/orders.parquet")
    got = QUERIES[name](spark, SF).filter("o_orderkey IS NOT NULL")
    assert got.count() == orders.count() == got.select("o_orderkey").distinct().count()
    if name == "join_with_secondaries":
        assert got.filter("c_name IS NULL").isEmpty()
        assert {r["name"] for r in got.select("name").distinct().collect()} == {"N0", "N1", "own"}


def test_secondary_of_all_vectors(spark):
    got = QUERIES["join_arrays_by_position"](spark, SF)
    last = got.agg(F.max("vec_id")).first()[0]
    assert got.filter((F.col("vec_id") == last) & ~F.col("x").eqNullSafe(F.col("y"))).isEmpty()
    assert not got.filter((F.col("vec_id") == 0) & (F.col("x") != F.col("y"))).isEmpty()


@pytest.mark.parametrize("name,kind", [("csv_quoted_in_one_file", "quoted"), ("json_array_in_one_file", "arrays")])
def test_files_written_by_many_tasks(spark, tmp_path, monkeypatch, name, kind):
    """No task writes a whole table; those without rows write none that holds a record."""
    row = "concat('a,\"', id, '\"\n')"
    spark.range(40).selectExpr("id AS doc_id", f"{row} AS text").repartition(4).write.parquet(f"{tmp_path}/documents.parquet")
    spark.range(40).selectExpr("id AS o_orderkey", "id AS o_custkey", "'F' AS o_orderstatus").repartition(4).write.parquet(f"{tmp_path}/orders.parquet")
    spark.range(30).selectExpr("id AS c_custkey", f"{row} AS c_name").where("c_custkey < 3").repartition(4).write.parquet(f"{tmp_path}/customer.parquet")
    monkeypatch.setattr("catalog.payloads.shared_folder", lambda spark: f"{tmp_path}/shared")
    before = spark.conf.get("spark.sql.files.openCostInBytes")
    spark.conf.set("spark.sql.files.openCostInBytes", "128m")
    try:
        rows = QUERIES[name](spark, str(tmp_path)).collect()
    finally:
        spark.conf.set("spark.sql.files.openCostInBytes", before)
    assert len(rows) == (40 if kind == "quoted" else 43)
    folder = tmp_path / "shared" / kind
    assert len(list((folder if kind == "quoted" else folder / "orders").glob("part-*"))) > 1
