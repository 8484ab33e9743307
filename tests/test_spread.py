"""Rows that cost much time are dealt to many tasks, and rows of one key are joined in parts."""

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from catalog import QUERIES
from samplecraft import session
from samplecraft.operators import combine as C
from samplecraft.session import spread

ROWS = 60_000


@pytest.fixture(scope="module")
def one_group(tmp_path_factory):
    """Tables of one row group, which one task reads."""
    folder = str(tmp_path_factory.mktemp("tables"))
    n = list(range(1, ROWS + 1))
    text = [f"v{i % 7}" for i in n]
    tables = {
        "orders": {"o_orderkey": n, "o_custkey": n, "o_orderstatus": text, "o_totalprice": [float(i) for i in n], "o_orderpriority": text},
        "customer": {"c_custkey": n, "c_name": text, "c_nationkey": pa.array([i % 3 for i in n], pa.int32()), "c_acctbal": [float(i) for i in n]},
        "events": {"event_id": n, "user_id": n},
        "lineitem": {"l_orderkey": n, "l_linenumber": pa.array([1] * ROWS, pa.int32()), "l_partkey": n, "l_returnflag": text, "l_quantity": [1.0] * ROWS, "l_extendedprice": [2.0] * ROWS},
        "nation": {"n_nationkey": pa.array([0, 1, 2], pa.int32()), "n_name": ["a", "b", "c"], "n_regionkey": pa.array([0, 0, 0], pa.int32())},
        "region": {"r_regionkey": pa.array([0], pa.int32()), "r_name": ["r"]},
    }
    for name, columns in tables.items():
        pq.write_table(pa.table(columns), f"{folder}/{name}.parquet")
    return folder


@pytest.mark.parametrize(
    "name",
    ["split_arrays_any_depth", "lazy_flatten_nested", "descend_through_elements", "dimensional_payloads", "path_extraction", "html_tables"],
)
def test_costly_rows_are_dealt(spark, one_group, name):
    """None of these is left to one task because its table is stored as one group."""
    parts = QUERIES[name](spark, one_group).rdd.getNumPartitions()
    assert parts >= -(-ROWS // session.TASK_ROWS)


@pytest.mark.parametrize("name", ["sources_joined", "sources_with_stores", "join_with_secondaries"])
def test_source_tables_are_dealt(spark, one_group, name):
    plan = QUERIES[name](spark, one_group)._jdf.queryExecution().optimizedPlan().toString()
    assert f"Repartition {-(-ROWS // session.TASK_ROWS)}, true" in plan


def test_spread_keeps_rows(spark):
    df = spark.range(0, 1000, 1, 1).select((F.col("id") % 10).alias("k"))
    out = spread(df, 100)
    assert out.rdd.getNumPartitions() == 10
    assert out.groupBy("k").count().collect() and sorted(r.k for r in out.collect()) == sorted(r.k for r in df.collect())
    assert spread(df.where("k < 0"), 100).count() == 0


def test_rows_of_one_key_are_joined_in_parts(spark, monkeypatch):
    """One key has most rows, others have none or one: no part takes more than its share, and no row is lost."""
    monkeypatch.setattr(C, "KEY_ROWS", 50)
    primary = spark.range(2000).select(
        F.col("id").alias("payload_id"), F.lit(0).alias("sample_ix"),
        F.create_map(F.lit("id"), F.when(F.col("id") < 1500, "1").when(F.col("id") < 1900, F.col("id").cast("string")), F.lit("alt"), F.lit("z")).alias("attrs"),
    )
    secondary = spark.createDataFrame(
        [(1, 0, {"key": "1.0", "s": "old"}), (2, 0, {"key": "1", "s": "new"}), (3, 0, {"key": "1600", "s": "one"}), (4, 0, {"key": "z", "t": "alt"})],
        "payload_id long, sample_ix int, attrs map<string,string>",
    )
    settings = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false"}
    old = {k: spark.conf.get(k) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        out = C.join_samples(C.Source(primary, join_key="id, alt"), [C.Source(secondary, prefix="b.", join_key="key")])
        assert out.columns == primary.columns
        found = {r.payload_id: r.attrs for r in out.collect()}
        one = C.join_samples(C.Source(primary, join_key="id"), [C.Source(secondary, join_key="key")])
        in_parts = [r["count"] for r in one.groupBy(F.spark_partition_id()).count().collect()]
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    assert len(found) == 2000
    assert max(in_parts) < 1000
    assert all(found[i].get("b.s") == "new" for i in range(1500))
    assert found[1600]["b.s"] == "one" and "b.s" not in found[1601] and "b.s" not in found[1950]
    assert all(a["b.t"] == "alt" for a in found.values())


def test_equal_rows_of_one_key_are_kept(spark, monkeypatch):
    monkeypatch.setattr(C, "KEY_ROWS", 5)
    primary = spark.range(40).select(F.lit(1).alias("payload_id"), F.lit(0).alias("sample_ix"), F.create_map(F.lit("id"), F.lit("1")).alias("attrs"))
    secondary = primary.limit(1).withColumn("attrs", F.create_map(F.lit("id"), F.lit("1"), F.lit("v"), F.lit("x")))
    out = C.join_samples(C.Source(primary, join_key="id"), [C.Source(secondary, join_key="id")])
    assert [r.attrs for r in out.collect()] == [{"id": "1", "v": "x"}] * 40
