"""Metric typing, rates, dimensional payloads, counters and sinks."""

from pyspark.sql import functions as F

from catalog.registry import attr, attrs_of, query, spread_table, table
from samplecraft.operators import metrics as M
from samplecraft.sinks import output as O

_K = "json_extract_string(props, '$.k')"


def event_samples(spark, sf):
    k = F.get_json_object("props", "$.k")
    return table(spark, sf, "events").select(
        "event_id", "ts", "event_type",
        attrs_of(user="user_id", value="value", k=k, word=F.lit("infinity"), low=F.lit("-inf"), kind="event_type").alias("attrs"),
    )


@query(f"""
    SELECT event_id, 'value' AS metric, 'RATE' AS kind, value, CAST(NULL AS VARCHAR) AS text FROM events
    UNION ALL SELECT event_id, 'k', 'DELTA', CAST({_K} AS DOUBLE), NULL FROM events
    UNION ALL SELECT event_id, 'user', 'ATTRIBUTE', NULL, CAST(user_id AS VARCHAR) FROM events
    UNION ALL SELECT event_id, 'word', 'ATTRIBUTE', NULL, 'infinity' FROM events
    UNION ALL SELECT event_id, 'kind', 'ATTRIBUTE', NULL, event_type FROM events
    UNION ALL SELECT event_id, 'low', 'GAUGE', -1, NULL FROM events
""")
def metric_typing(spark, sf):
    out = M.metric_rows(event_samples(spark, sf), {"^val": "RATE", "k": "DELTA", "user": "ATTRIBUTE", "low": "NONE"}, auto_set=True)
    return out.select(
        "event_id", "metric", "kind",
        F.when(F.col("value") < -1e300, -1.0).otherwise(F.col("value")).alias("value"),
        F.when(F.col("kind") == "ATTRIBUTE", F.col("text")).alias("text"),
    )


@query("""
    SELECT event_id, event_type || '-' || user_id AS joined, event_type AS existing, 0 AS left_, 'fixed' AS constant, 'src' AS fallback FROM events
""")
def series_namespaces(spark, sf):
    ev = event_samples(spark, sf)
    a = M.series_namespace(ev, "src", existing_attr=["kind", "absent", "user"]).select("event_id", F.col("namespace").alias("joined"))
    b = M.series_namespace(ev, "src", existing_attr=["kind"]).select(
        "event_id", F.col("namespace").alias("existing"), F.map_contains_key("attrs", "kind").cast("int").alias("left_")
    )
    c = M.series_namespace(M.series_namespace(ev, "src", custom_attr="fixed").withColumnRenamed("namespace", "constant"), "src").select(
        "event_id", "constant", F.col("namespace").alias("fallback")
    )
    return a.join(b, "event_id").join(c, "event_id")


def series_rows(spark, sf, metric, kind):
    ev = event_samples(spark, sf)
    rows = M.metric_rows(M.series_namespace(ev, "events", existing_attr=["user", "none"]), {metric: kind})
    return rows.filter(F.col("metric") == metric)


_LAG = """
    WITH w AS (SELECT event_id, event_type, user_id, {v} AS v, epoch_us(ts) AS us,
                      lag({v}) OVER s AS pv, lag(epoch_us(ts)) OVER s AS pus
               FROM events WINDOW s AS (PARTITION BY event_type, user_id ORDER BY ts))
"""


@query(_LAG.format(v="value") + """
    SELECT event_id, CASE WHEN pus IS NULL THEN 0 ELSE round(v - pv, 6) END AS delta FROM w
""")
def metric_delta(spark, sf):
    rows = series_rows(spark, sf, "value", "DELTA")
    out = M.differences(rows)
    return out.select("event_id", F.round("reported", 6).alias("delta"))


@query(_LAG.format(v=f"CAST({_K} AS DOUBLE)") + """
    SELECT event_id, CASE WHEN pus IS NULL THEN 0 WHEN v < pv THEN NULL ELSE round((v - pv) / ((us - pus) / 1000000.0::DOUBLE), 9) END AS rate FROM w
""")
def metric_positive_rate(spark, sf):
    out = M.differences(series_rows(spark, sf, "k", "PRATE"), slice_seconds=3600)
    return out.select("event_id", F.round("reported", 9).alias("rate"))


@query(_LAG.format(v="value") + """
    SELECT event_id, CASE WHEN pus IS NULL THEN 0 ELSE round((v - pv) / ((us - pus) / 1000000.0::DOUBLE), 9) END AS rate,
           CASE WHEN pus IS NULL THEN 0 WHEN v < pv THEN NULL ELSE round(v - pv, 6) END AS pdelta FROM w
""")
def metric_rate_and_positive_delta(spark, sf):
    ev = table(spark, sf, "events").select("event_id", "ts", "event_type", "user_id", "value")
    out = M.differences(ev, ["event_type", "user_id"], into={"r": F.lit("RATE"), "p": F.lit("PDELTA")}, tie=["event_id"])
    return out.select("event_id", F.round("r", 9).alias("rate"), F.round("p", 6).alias("pdelta"))


def line_samples(spark, sf):
    """Line items as samples; numbers as they are written."""
    li = spread_table(spark, sf, "lineitem")
    return li.select(
        "l_orderkey", "l_linenumber", "l_partkey",
        attrs_of(
            flag="l_returnflag", qty="l_quantity", price="l_extendedprice", lo=F.col("l_extendedprice") * 0.5, hi=F.col("l_extendedprice") * 2,
            n="l_linenumber", odd=F.when(F.col("l_linenumber") % 2 == 1, "x").otherwise("1"),
        ).alias("attrs"),
    )


@query("""
    SELECT l_orderkey, l_linenumber, l_partkey, l_returnflag AS flag, l_quantity AS qty, 60000 AS qty_interval, 'count' AS qty_type,
           l_extendedprice AS sum_, l_extendedprice * 0.5 AS min_, CASE WHEN l_linenumber % 2 = 1 THEN 2 ELSE 3 END AS metrics,
           CASE WHEN l_linenumber % 2 = 1 THEN 'x' END AS odd
    FROM lineitem
""")
def dimensional_payloads(spark, sf):
    out = M.dimensional_payload(
        line_samples(spark, sf),
        counts={"qty": 60000},
        summaries={
            "price": {"min": "lo", "max": "hi", "sum": "price", "count": "n", "interval": 1000},
            "broken": {"min": "none", "max": "none", "sum": "none", "count": "none", "interval": 1000},
        },
        fixed={"integration_name": "x"},
    )
    pick = lambda name: F.get("metrics", F.array_position(F.col("metrics")["name"], name) - 1)
    out = out.withColumns({"_qty": pick("qty"), "_price": pick("price")})
    return out.select(
        "l_orderkey", "l_linenumber", "l_partkey",
        F.col("common_attributes")["flag"].alias("flag"),
        F.col("_qty")["value"].alias("qty"),
        F.col("_qty")["interval_ms"].cast("bigint").alias("qty_interval"),
        F.col("_qty")["type"].alias("qty_type"),
        F.col("_price")["summary"]["sum"].alias("sum_"),
        F.col("_price")["summary"]["min"].alias("min_"),
        F.size("metrics").alias("metrics"),
        F.col("common_attributes")["odd"].alias("odd"),
    )


@query("""
    SELECT event_id, 'value' AS item, 'value' AS field, CAST(value AS DOUBLE) AS value FROM events
    UNION ALL SELECT event_id, 'group', 'user', user_id FROM events
""")
def inventory_rows(spark, sf):
    out = M.inventory_rows(event_samples(spark, sf), {"value": "value", "user": "group", "absent": "value", "k": ""})
    return out.select("event_id", "item", "field", F.col("value").cast("double").alias("value"))


@query("""
    SELECT event_id, event_type AS summary, 'kind' AS category FROM events UNION ALL SELECT event_id, 'infinity', 'words' FROM events
""")
def event_category_rows(spark, sf):
    out = M.event_rows(event_samples(spark, sf), {"kind": "default", "word": "words", "absent": "default"})
    return out.select("event_id", "summary", "category")


@query("SELECT event_type, count(*) AS samples FROM events GROUP BY event_type")
def run_counters(spark, sf):
    return M.run_counters(event_samples(spark, sf))


@query("""
    SELECT 'GAUGE' AS kind, 4 * count(*) AS metrics FROM events UNION ALL SELECT 'ATTRIBUTE', 2 * count(*) FROM events
""")
def kind_counters(spark, sf):
    return M.kind_counters(M.metric_rows(event_samples(spark, sf)))


@query("SELECT event_id, event_type AS \"logType\", user_id AS \"user\", 7 AS fields FROM events")
def event_payload_shape(spark, sf):
    out = O.event_payloads(event_samples(spark, sf).drop("ts"), event_key="logType")
    parsed = F.from_json("event", "map<string,string>")
    return out.select(
        "event_id", parsed["logType"].alias("logType"), parsed["user"].cast("bigint").alias("user"), F.size(parsed).alias("fields")
    )


@query("""
    WITH big AS (SELECT count(*) AS n, count(DISTINCT (l_orderkey, l_linenumber, l_partkey, l_suppkey)) AS ids, sum(l_partkey) AS parts, sum(l_orderkey) AS orders FROM lineitem)
    SELECT 'big' AS entity, 'instance' AS entity_type, n AS events, (n + 4999) // 5000 AS batches, least(n, 5000) AS largest,
           ids AS different, CAST(parts AS BIGINT) AS parts, CAST(orders AS BIGINT) AS orders FROM big
    UNION ALL SELECT 'local', NULL, count(*), 1, count(*), count(*), NULL, NULL FROM region
""")
def batches_per_entity(spark, sf):
    li = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    rows = O.with_entity(
        li.select(F.struct("*").alias("r"), F.lit("line").alias("event_type"), attrs_of(part=F.col("l_partkey")).alias("attrs")), "big"
    )
    rows = O.event_payloads(rows.select(F.to_json("r").alias("id"), "event_type", "attrs", "entity", "entity_type").withColumn("attrs", F.map_concat("attrs", F.create_map(F.lit("id"), "id"))))
    region = O.with_entity(
        table(spark, sf, "region").select(F.col("r_name").alias("id"), F.lit("region").alias("event_type"), attrs_of(n="r_name", id="r_name").alias("attrs"))
    )
    rows = rows.unionByName(O.event_payloads(region))
    out = O.batches(rows, ["id"], ["entity", "entity_type"], size=5000)
    # the events themselves, taken out of their batches again
    sizes = out.groupBy("entity", "entity_type").agg(F.count(F.lit(1)).alias("batches"), F.max("n").alias("largest"))
    event = F.from_json("event", "eventType string, id string, part string")
    each = out.select("entity", F.explode("events").alias("event")).select("entity", event.alias("e"), F.regexp_extract("event", "l_orderkey.{1,2}:([0-9]+)", 1).try_cast("bigint").alias("line"))
    seen = each.groupBy("entity").agg(
        F.count(F.lit(1)).alias("events"), F.countDistinct("e.id").alias("different"), F.sum(F.col("e.part").try_cast("bigint")).alias("parts"), F.sum("line").alias("orders")
    )
    return sizes.join(seen, "entity")



@query("SELECT event_id, 'samplecraft' AS name, '1.0' AS version, event_type AS kind FROM events")
def fixed_identity(spark, sf):
    out = O.with_identity(event_samples(spark, sf), "samplecraft", "1.0")
    return out.select("event_id", attr("integration_name").alias("name"), attr("integration_version").alias("version"), attr("kind").alias("kind"))
