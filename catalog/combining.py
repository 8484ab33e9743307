"""Merging, joining and looking up."""

from pyspark.sql import functions as F

from catalog.registry import attr, attrs_of, query, spread_table, table, text
from samplecraft.functions import maps
from samplecraft.operators import combine as C


def customers(spark, sf):
    return spread_table(spark, sf, "customer").select(
        "c_custkey", F.lit("customer").alias("event_type"),
        attrs_of(id="c_custkey", name="c_name", nation="c_nationkey", balance="c_acctbal").alias("attrs"),
    )


def orders(spark, sf):
    return spread_table(spark, sf, "orders").select(
        "o_orderkey", F.lit("order").alias("event_type"),
        attrs_of(key="o_orderkey", cust="o_custkey", status="o_orderstatus", name=F.lit("own")).alias("attrs"),
    )


@query("""
    SELECT 'c' AS source, c_custkey AS k, c_name AS name, CAST(NULL AS BIGINT) AS status FROM customer
    UNION ALL SELECT 'o', o_orderkey, NULL, o_custkey FROM orders
""")
def union_of_sources(spark, sf):
    c = table(spark, sf, "customer").select(F.lit("c").alias("source"), F.col("c_custkey").alias("k"), F.col("c_name").alias("name"))
    o = table(spark, sf, "orders").select(F.lit("o").alias("source"), F.col("o_orderkey").alias("k"), F.col("o_custkey").alias("status"))
    return C.union_samples(c, o)


@query("""
    SELECT 'merged' AS event_type, (SELECT arg_max(c_name, c_custkey) FROM customer) AS name,
           (SELECT max(o_orderkey) FROM orders) AS last_order, (SELECT arg_max(o_orderstatus, o_orderkey) FROM orders) AS status
""")
def merge_into_one(spark, sf):
    out = C.merge_samples(
        [C.Source(orders(spark, sf), order=["o_orderkey"]), C.Source(customers(spark, sf), prefix="c.", order=["c_custkey"])],
        event_type="merged",
    )
    return out.select("event_type", attr("c.name").alias("name"), attr("key", "bigint").alias("last_order"), attr("status").alias("status"))


@query("""
    SELECT c_custkey AS cust, c_name AS name, o.last_order, o.status FROM customer
    LEFT JOIN (SELECT o_custkey, max(o_orderkey) AS last_order, arg_max(o_orderstatus, o_orderkey) AS status FROM orders GROUP BY 1) o
      ON o_custkey = c_custkey
""")
def merge_per_group(spark, sf):
    o = orders(spark, sf).withColumns({"cust": attr("cust", "bigint"), "place": F.col("o_orderkey")})
    c = customers(spark, sf).withColumns({"cust": F.col("c_custkey"), "place": F.col("c_custkey")})
    out = C.merge_samples([C.Source(o, order=["place"]), C.Source(c, order=["place"])], group=["cust"])
    return out.select("cust", attr("name").alias("name"), attr("key", "bigint").alias("last_order"), attr("status").alias("status"))


@query("""
    SELECT o_orderkey, o_custkey AS cust, coalesce('N' || n_nationkey, 'own') AS name, c_name AS c_name, c_nationkey AS nation
    FROM orders LEFT JOIN customer ON c_custkey = o_custkey
    LEFT JOIN nation ON n_nationkey = CASE o_orderstatus WHEN 'F' THEN 0 WHEN 'O' THEN 1 END
""")
def join_with_secondaries(spark, sf):
    """All customers and nations; orders of other statuses than F and O, and nations of no status, have no partner."""
    n = F.col("n_nationkey")
    states = table(spark, sf, "nation").select(
        "n_nationkey",
        attrs_of(state=F.when(n == 0, "F").when(n == 1, "O").otherwise(text("N", n)), name=text("N", n)).alias("attrs"),
    )
    out = C.join_samples(
        C.Source(orders(spark, sf), join_key="cust,status"),
        [C.Source(customers(spark, sf), prefix="c.", join_key="id", order=["c_custkey"]), C.Source(states, join_key="state", order=["n_nationkey"])],
    )
    return out.select(
        "o_orderkey", attr("cust", "bigint").alias("cust"), attr("name").alias("name"),
        attr("c.name").alias("c_name"), attr("c.nation", "int").alias("nation"),
    )


@query("""
    SELECT c_custkey, last AS order_, (SELECT o_orderstatus FROM orders WHERE o_orderkey = last) AS status
    FROM customer LEFT JOIN (SELECT o_custkey, max(o_orderkey) AS last FROM orders GROUP BY 1) ON o_custkey = c_custkey
""")
def join_last_duplicate_wins(spark, sf):
    out = C.join_samples(
        C.Source(customers(spark, sf), join_key="id"),
        [C.Source(orders(spark, sf), prefix="o.", join_key="cust", order=["o_orderkey"])],
    )
    return out.select("c_custkey", attr("o.key", "bigint").alias("order_"), attr("o.status").alias("status"))


@query("""
    WITH e AS (SELECT vec_id, i - 1 AS ix, round(CAST(embedding[i] AS DOUBLE), 4) AS x
               FROM embeddings, UNNEST(generate_series(1, len(embedding))) AS u(i))
    SELECT a.vec_id, CAST(a.ix AS INTEGER) AS ix, a.x AS x, b.x AS y FROM e a
    JOIN (SELECT ix, arg_max(x, vec_id) AS x FROM e GROUP BY ix) b USING (ix)
""")
def join_arrays_by_position(spark, sf):
    """All vectors as the secondary: of the elements at a position, that of the last vector wins."""
    e = table(spark, sf, "embeddings").select("vec_id", F.posexplode("embedding").alias("ix", "x"))
    rows = e.select("vec_id", attrs_of(index="ix", x=F.round(F.col("x").cast("double"), 4)).alias("attrs"))
    out = C.join_samples(
        C.Source(rows, join_key="index"), [C.Source(rows, prefix="b.", join_key="index", order=["vec_id"])]
    )
    return out.select("vec_id", attr("index", "int").alias("ix"), attr("x", "double").alias("x"), attr("b.x", "double").alias("y"))


@query("""
    SELECT DISTINCT o_orderstatus AS state FROM orders UNION SELECT DISTINCT 'p' || substr(o_orderpriority, 1, 1) FROM orders
""")
def lookup_sets(spark, sf):
    listed = F.to_json(F.array(F.col("o_orderstatus"), F.concat(F.lit("p"), F.substring("o_orderpriority", 1, 1))))
    o = table(spark, sf, "orders").select(attrs_of(states=listed).alias("attrs"))
    return C.lookup_values(o, "states", "state")


@query("""
    SELECT o_orderkey, CAST(o_custkey AS VARCHAR) AS cust, o_orderstatus AS state FROM orders
    WHERE o_custkey IN (SELECT c_custkey FROM customer)
    UNION ALL SELECT NULL, CAST(c_custkey AS VARCHAR), 'any' FROM customer WHERE c_custkey IN (SELECT o_custkey FROM orders)
""")
def lookup_fan_out(spark, sf):
    """All orders against all customers and statuses, and all customers against all orders: those without orders have no row."""
    pages = table(spark, sf, "orders").select(
        "o_orderkey", text("/c/", F.col("o_custkey"), "/state-", F.col("o_orderstatus"), "/x").alias("payload_id")
    )
    known = C.lookup_values(customers(spark, sf), "id")
    states = table(spark, sf, "orders").select("o_orderstatus").distinct()
    out = C.lookup_fan_out(pages, "/c/${lookup:cust}/state-${lookup:state}/x", {"cust": known, "state": states})
    own = table(spark, sf, "customer").select(F.lit(None).cast("bigint").alias("o_orderkey"), text("/c/", F.col("c_custkey"), "/any").alias("payload_id"))
    ordering = C.lookup_fan_out(own, "/c/${lookup:cust}/any", {"cust": C.lookup_values(orders(spark, sf), "cust")})
    out = out.unionByName(ordering.withColumn("lookup_state", F.lit("any")))
    return out.select("o_orderkey", F.col("lookup_cust").alias("cust"), F.col("lookup_state").alias("state"))


@query("""
    SELECT o_orderkey, c_custkey AS cust, n_name AS nation FROM orders JOIN customer ON c_custkey = o_custkey
    JOIN nation ON n_nationkey = c_nationkey
""")
def row_lookup(spark, sf):
    """Orders of every status; customers without orders have no row."""
    both = C.union_samples(orders(spark, sf), customers(spark, sf).select("event_type", "attrs"))
    nations = table(spark, sf, "nation")
    targets = table(spark, sf, "customer").join(nations, F.col("c_nationkey") == F.col("n_nationkey")).select(
        text("cust/", F.col("c_custkey")).alias("payload_id"), "c_custkey", "n_name"
    )
    out = C.row_lookup(both, targets, "cust/${lookup.order:cust}", "order")
    return out.select(F.col("lookup")["key"].cast("bigint").alias("o_orderkey"), F.col("c_custkey").alias("cust"), F.col("n_name").alias("nation"))


@query("""
    SELECT min(event_id) AS event_id, user_id AS "user", event_type AS kind FROM events GROUP BY user_id, event_type
""")
def dedupe_lookups(spark, sf):
    ev = table(spark, sf, "events").select("event_id", attrs_of(user="user_id", kind="event_type").alias("attrs"))
    out = C.dedupe_lookups(ev, ["user", "kind"], order=["event_id"])
    return out.select("event_id", attr("user", "bigint").alias("user"), attr("kind").alias("kind"))


@query("""
    SELECT o_orderkey, 'http://h/' || (SELECT arg_max(c_name, c_custkey) FROM customer) || '/seeded/${var:none}/' || o_orderkey AS url FROM orders
""")
def stored_variables(spark, sf):
    last = C.store_variable(customers(spark, sf), "name", ["c_custkey"])
    url = C.fill_variables("http://h/${var:name}/${var:seed}/${var:none}/", {"name": last, "seed": "seeded"})
    return table(spark, sf, "orders").select("o_orderkey", F.concat(url, F.col("o_orderkey").cast("string")).alias("url"))


@query("""
    SELECT c_custkey, n_name AS nation, r_name AS region FROM customer JOIN nation ON n_nationkey = c_nationkey JOIN region ON r_regionkey = n_regionkey
""")
def lookup_file_rows(spark, sf):
    nations = table(spark, sf, "nation").join(table(spark, sf, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    targets = table(spark, sf, "customer").select("c_custkey", text("nation-", F.col("c_nationkey")).alias("payload_id"))
    out = C.lookup_rows(nations.select("n_nationkey", "n_name", "r_name"), targets, "nation-${lf:n_nationkey}")
    return out.select("c_custkey", F.col("lf_n_name").alias("nation"), F.col("lf_r_name").alias("region"))


@query("""
    SELECT c_custkey, 2 AS n, c_name AS name FROM customer
""")
def planes_round_trip(spark, sf):
    wide = maps.to_wide(customers(spark, sf).drop("event_type"), {"id": "bigint", "name": "string"})
    back = maps.to_map(wide, ["id", "name"])
    return back.select("c_custkey", F.size("attrs").alias("n"), attr("name").alias("name"))


@query("SELECT UNNEST(['id', 'name', 'nation', 'balance']) AS key WHERE EXISTS (SELECT * FROM customer)")
def key_discovery(spark, sf):
    return maps.discover_keys(customers(spark, sf))
