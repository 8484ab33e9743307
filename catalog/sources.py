"""Several sources in one plan, each query from specs and payload tables alone."""

from pyspark.sql import functions as F

from catalog.registry import attr, doc, query, spread_table, table, text
from samplecraft.operators import combine as C
from samplecraft.plans.sampling import SampleSpec
from samplecraft.plans.sources import SourcePlan, SourceSpec, run_sources


def regions(spark, sf):
    return table(spark, sf, "region").select(F.lit("/regions").alias("payload_id"), doc(id="r_regionkey", name="r_name").alias("body"))


def nations(spark, sf):
    return table(spark, sf, "nation").select(
        text("/regions/", F.col("n_regionkey"), "/nations").alias("payload_id"), doc(id="n_nationkey", name="n_name").alias("body")
    )


def customers(spark, sf):
    c = spread_table(spark, sf, "customer")
    body = doc(id="c_custkey", name="c_name", home="c_nationkey", balance="c_acctbal")
    return c.select(text("/nations/", F.col("c_nationkey"), "/customers").alias("payload_id"), body.alias("body"), F.col("c_custkey").alias("cust"))


def orders(spark, sf):
    o = spread_table(spark, sf, "orders")
    body = doc(key="o_orderkey", cust="o_custkey", status="o_orderstatus")
    return o.select(F.lpad(F.col("o_orderkey").cast("string"), 20, "0").alias("payload_id"), body.alias("body"), F.col("o_custkey").alias("cust"))


@query("""
    SELECT 'Region' AS event_type, CAST(r_regionkey AS BIGINT) AS id, r_name AS name, CAST(NULL AS VARCHAR) AS nation, CAST(NULL AS VARCHAR) AS region FROM region
    UNION ALL SELECT 'Nation', n_nationkey, n_name, NULL, r_name FROM nation JOIN region ON r_regionkey = n_regionkey
    UNION ALL SELECT 'Customer', c_custkey, c_name, n_name, r_name FROM customer JOIN nation ON n_nationkey = c_nationkey JOIN region ON r_regionkey = n_regionkey
""")
def sources_lookup_chain(spark, sf):
    """Each source is read once per row of the one before it; declared in reverse."""
    specs = [
        SourceSpec(
            SampleSpec("customers", "Customer", custom_attributes={"nation": "${lookup.Nation:name}", "region": "${lookup.Nation:region}"}),
            payload="/nations/${lookup.Nation:id}/customers",
        ),
        SourceSpec(SampleSpec("nations", "Nation", custom_attributes={"region": "${lookup.Region:name}"}), payload="/regions/${lookup.Region:id}/nations"),
        SourceSpec(SampleSpec("regions", "Region"), payload="/regions"),
    ]
    out = run_sources(specs, {"regions": regions(spark, sf), "nations": nations(spark, sf), "customers": customers(spark, sf)})
    return out.select("event_type", attr("id", "bigint").alias("id"), *[attr(c).alias(c) for c in ("name", "nation", "region")])


@query("""
    SELECT cust, c_name AS name, o.last_order, o.status, c_custkey IS NOT NULL AS known FROM
      (SELECT c_custkey AS cust FROM customer UNION SELECT o_custkey FROM orders)
      LEFT JOIN customer ON c_custkey = cust
      LEFT JOIN (SELECT o_custkey, max(o_orderkey) AS last_order, arg_max(o_orderstatus, o_orderkey) AS status FROM orders GROUP BY 1) o ON o_custkey = cust
""")
def sources_merged_per_group(spark, sf):
    """Two sources with one merge target: a sample for each customer."""
    specs = [
        SourceSpec(SampleSpec("orders", merge="CustomerState", prefix="order.")),
        SourceSpec(SampleSpec("customers", merge="CustomerState")),
    ]
    out = run_sources(specs, {"orders": orders(spark, sf), "customers": customers(spark, sf)}, group=["cust"])
    return out.where("event_type = 'CustomerState'").select(
        "cust", attr("name").alias("name"), attr("order.key", "bigint").alias("last_order"), attr("order.status").alias("status"), attr("id").isNotNull().alias("known")
    )


@query("""
    SELECT 'OrderState' AS event_type, o_orderkey, o_orderstatus AS status, c_name, n_name AS nation FROM orders
    LEFT JOIN customer ON c_custkey = o_custkey LEFT JOIN nation ON n_nationkey = o_custkey
    UNION ALL SELECT 'Region', r_regionkey, NULL, r_name, NULL FROM region
""")
def sources_joined(spark, sf):
    """The first source with a join key is joined by the two others; a fourth is emitted by itself."""
    specs = [
        SourceSpec(SampleSpec("regions", "Region"), payload="/regions"),
        SourceSpec(SampleSpec("orders", merge="OrderState"), join_key="cust"),
        SourceSpec(SampleSpec("customers", merge="OrderState", prefix="c."), join_key="id"),
        SourceSpec(SampleSpec("nations", merge="OrderState", prefix="n."), join_key="id"),
    ]
    inputs = {"regions": regions(spark, sf), "orders": orders(spark, sf), "customers": customers(spark, sf), "nations": nations(spark, sf)}
    out = run_sources(specs, inputs)
    key = F.when(F.col("source") == "regions", attr("id", "bigint")).otherwise(attr("key", "bigint"))
    name = F.when(F.col("source") == "regions", attr("name")).otherwise(attr("c.name"))
    return out.select("event_type", key.alias("o_orderkey"), attr("status").alias("status"), name.alias("c_name"), attr("n.name").alias("nation"))


@query("""
    WITH last AS (SELECT max('/nations/' || c_nationkey || '/customers') AS page FROM customer)
    SELECT event_type, id, name, home FROM (
      SELECT 'Home' AS event_type, CAST(n_nationkey AS BIGINT) AS id, n_name AS name, page AS home FROM nation, last WHERE n_nationkey IN (SELECT c_nationkey FROM customer)
      UNION ALL SELECT 'HomeAgain', n_nationkey, n_name, NULL FROM nation WHERE n_nationkey IN (SELECT c_nationkey FROM customer)
      UNION ALL SELECT 'Rich', c_custkey, c_name, NULL FROM customer WHERE NOT regexp_matches(CAST(c_acctbal AS VARCHAR), '^-'))
""")
def sources_with_stores(spark, sf):
    """A set and a variable stored before the rows are filtered; what they name is read, and read again from its cache."""
    own = customers(spark, sf).withColumn("body", F.to_json(F.map_concat(F.from_json("body", "map<string,string>"), F.create_map(F.lit("page"), F.col("payload_id")))))
    seeded = table(spark, sf, "nation").select(text("/v1/home/", F.col("n_nationkey")).alias("payload_id"), doc(id="n_nationkey", name="n_name").alias("body"))
    specs = [
        SourceSpec(SampleSpec("again", "HomeAgain"), cache="homes"),
        SourceSpec(SampleSpec("homes", "Home", custom_attributes={"home": "${var:page}"}), payload="/${var:version}/home/${lookup:homes}"),
        SourceSpec(
            SampleSpec("customers", "Rich", sample_filter=[{"^balance$": "^-"}]), store_lookups={"homes": "home"}, store_variables={"page": "page"}
        ),
    ]
    out = run_sources(specs, {"customers": own, "homes": seeded}, variables={"version": "v1"})
    home = F.when(F.col("event_type") == "Home", attr("home"))
    return out.select("event_type", attr("id", "bigint").alias("id"), attr("name").alias("name"), home.alias("home"))


@query("""
    SELECT c_custkey AS id, n_name AS nation, CAST(r_regionkey AS BIGINT) AS region, c_custkey % 2 = 0 AS saved FROM customer
    JOIN nation ON n_nationkey = c_nationkey JOIN region ON r_regionkey = n_regionkey
""")
def sources_lookup_file(spark, sf):
    """A source read once per row of a lookup file, and its rows as they are saved: before the filters."""
    file = table(spark, sf, "nation").join(table(spark, sf, "region"), F.col("n_regionkey") == F.col("r_regionkey")).select("n_nationkey", "n_name", "r_regionkey")
    attributes = {"nation": "${lf:n_name}", "region": "${lf:r_regionkey}"}
    spec = SourceSpec(
        SampleSpec("customers", custom_attributes=attributes, sample_exclude_filter=[{"^id$": "[13579]$"}]),
        payload="/nations/${lf:n_nationkey}/customers", lookup_file="places",
    )
    plan = SourcePlan([spec], {"customers": customers(spark, sf)}, lookup_files={"places": file})
    kept = plan.emitted().select(attr("id", "bigint").alias("id"), F.lit(True).alias("saved"))
    rows = plan.rows("customers").select(attr("id", "bigint").alias("id"), attr("nation").alias("nation"), attr("region", "bigint").alias("region"))
    return rows.join(kept, "id", "left").select("id", "nation", "region", F.coalesce("saved", F.lit(False)).alias("saved"))


@query("""
    WITH keys AS (SELECT c_custkey, CAST(c_nationkey AS VARCHAR) || c_custkey || '.' AS k FROM customer),
         pairs AS (SELECT a.n AS nation, b.c AS cust FROM (SELECT DISTINCT CAST(c_nationkey AS VARCHAR) AS n FROM customer) a, (SELECT CAST(c_custkey AS VARCHAR) AS c FROM customer) b)
    SELECT c_custkey, nation, cust FROM keys JOIN pairs ON nation || cust || '.' = k
""")
def lookup_adjacent_slots(spark, sf):
    """Two slots without text between them: a key is in the result for each way to take it apart."""
    c = table(spark, sf, "customer")
    targets = c.select("c_custkey", text(F.col("c_nationkey"), F.col("c_custkey"), ".").alias("payload_id"))
    sets = {"nation": c.select("c_nationkey"), "cust": c.select("c_custkey")}
    out = C.lookup_fan_out(targets, "${lookup:nation}${lookup:cust}.", sets)
    return out.select("c_custkey", F.col("lookup_nation").alias("nation"), F.col("lookup_cust").alias("cust"))


@query("""
    SELECT 'order-' || o_orderkey AS key, o_orderstatus AS value FROM orders WHERE o_orderkey NOT IN (SELECT c_custkey FROM customer)
    UNION ALL SELECT 'order-' || c_custkey, c_name FROM customer
""")
def merge_long_form(spark, sf):
    """Everything merged into one group whose keys come from the data: a row for each key, later sources win."""
    o = table(spark, sf, "orders").select("o_orderkey", F.create_map(text("order-", F.col("o_orderkey")), F.col("o_orderstatus")).alias("attrs"))
    c = table(spark, sf, "customer").select("c_custkey", F.create_map(text(F.col("c_custkey")), F.col("c_name")).alias("attrs"))
    return C.merged_entries([C.Source(o, order=["o_orderkey"]), C.Source(c, prefix="order-", order=["c_custkey"])])
