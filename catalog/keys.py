"""Key functions on both planes."""

from pyspark.sql import functions as F

from catalog.registry import attr, attrs_of, query, table
from samplecraft.functions import maps
from samplecraft.operators import keys as K


def part_samples(spark, sf):
    p = table(spark, sf, "part")
    return p.select(
        "p_partkey",
        attrs_of(
            **{"Part Name": "p_name", "part_brand_id": "p_brand", "partType": "p_type", "SIZE": "p_size", "price.retail": "p_retailprice"}
        ).alias("attrs"),
    )


def joined_keys():
    return F.array_join(F.array_sort(F.map_keys("attrs")), ",").alias("keys")


@query("SELECT p_partkey, 'part name,part_brand_id,parttype,price.retail,size' AS keys, p_size AS size FROM part")
def keys_to_lower(spark, sf):
    return K.lower_keys(part_samples(spark, sf)).select("p_partkey", joined_keys(), attr("size", "int").alias("size"))


@query("SELECT p_partkey, p_name AS name FROM part")
def keys_convert_space(spark, sf):
    return K.replace_blanks(part_samples(spark, sf), "_").select("p_partkey", attr("Part_Name").alias("name"))


@query("SELECT p_partkey, p_brand AS brand, p_size AS size FROM part")
def keys_snake_to_camel(spark, sf):
    out = K.snake_to_camel(part_samples(spark, sf))
    return out.select("p_partkey", attr("partBrandId").alias("brand"), attr("sIZE", "int").alias("size"))


@query("SELECT p_partkey, p_brand AS a, p_type AS b, p_retailprice AS c, p_size AS d FROM part")
def keys_rename_and_replace(spark, sf):
    out = K.rename_keys(
        part_samples(spark, sf),
        {r"^part_(\w+)_id$": "${1}.key", r"^(?P<head>part)Type$": "$head-kind", "SIZE": "x$$1"},
        {r"^brand\.": "BRAND:", r"retail": "${0}er"},
    )
    return out.select(
        "p_partkey",
        attr("BRAND:key").alias("a"),
        attr("part-kind").alias("b"),
        attr("price.retailer", "double").alias("c"),
        attr("x$1", "int").alias("d"),
    )


@query("SELECT p_partkey, 'part_brand_id,partType' AS keys, p_type AS kind FROM part")
def keys_keep(spark, sf):
    out = K.keep_keys(part_samples(spark, sf), ["^part_", "Type$"])
    return out.select("p_partkey", F.array_join(F.sort_array(F.map_keys("attrs"), False), ",").alias("k"), attr("partType").alias("kind")).select(
        "p_partkey", F.when(F.col("k") == "part_brand_id,partType", F.col("k")).alias("keys"), "kind"
    )


@query("SELECT p_partkey, 'price.retail' AS keys FROM part")
def keys_remove(spark, sf):
    return K.remove_keys(part_samples(spark, sf), ["^PART", "^size$"]).select("p_partkey", joined_keys())


@query("SELECT p_partkey, 'SIZE,partType' AS keys FROM part")
def keys_filter_inverse(spark, sf):
    out = K.drop_unmatched_keys(
        part_samples(spark, sf),
        [{"key": "SIZE", "inverse": True, "mode": "contains"}, {"key": "Type", "mode": "suffix", "inverse": True}],
    )
    return out.select("p_partkey", joined_keys())


@query("SELECT c_custkey, 'source' AS env, 'global' AS zone, c_name AS name FROM customer")
def custom_attributes(spark, sf):
    c = table(spark, sf, "customer").select("c_custkey", attrs_of(name="c_name", env=F.lit("own")).alias("attrs"))
    out = K.custom_attributes(c, {"env": "global", "zone": "global"}, {"env": "source"})
    return out.select("c_custkey", *[attr(k).alias(k) for k in ("env", "zone", "name")])


@query("""
    SELECT o_orderkey, 'http://x/' || o_custkey || '/' || o_orderkey AS link, 'p-' || o_orderpriority || '-${none}' AS partly,
           CAST(NULL AS VARCHAR) AS absent FROM orders
""")
def add_attributes(spark, sf):
    o = table(spark, sf, "orders").select(
        "o_orderkey", attrs_of(key="o_orderkey", cust="o_custkey", **{"a.priority": "o_orderpriority"}).alias("attrs")
    )
    out = K.add_attributes(
        o, {"link": "http://x/${cust}/${key}", "partly": "p-${a.priority}-${none}", "absent": "${none}", "constant": "c"}
    )
    return out.select("o_orderkey", attr("link").alias("link"), attr("partly").alias("partly"), F.coalesce(attr("absent"), attr("constant")).alias("absent"))


@query("SELECT c_custkey, c_name AS name, 3 AS n, 'http://base' AS url FROM customer")
def key_prefix_and_base_url(spark, sf):
    c = table(spark, sf, "customer").select("c_custkey", attrs_of(name="c_name", seg="c_mktsegment").alias("attrs"))
    out = K.prefix_keys(K.base_url(c, "http://base"), "cust.")
    return out.select("c_custkey", attr("cust.name").alias("name"), F.size("attrs").alias("n"), attr("cust.baseUrl").alias("url"))


@query("""
    SELECT event_id, CASE event_type WHEN 'click' THEN 'sampleError' WHEN 'view' THEN 'detail_viewSample'
        WHEN 'error' THEN 'x_y' ELSE 'my_sourceSample' END AS event_type, 'own' AS kept FROM events
""")
def event_naming(spark, sf):
    et = F.col("event_type")
    raw = F.when(et == "click", "sampleError").when(et == "view", "detail.viewSamples").when(et == "error", "_x y")
    ev = table(spark, sf, "events").select("event_id", maps.drop_nulls(attrs_of(event_type=raw, kept=F.lit("own"))).alias("attrs"))
    out = K.name_events(ev, "my-source")
    return out.select("event_id", "event_type", attr("kept").alias("kept"))


@query("""
    SELECT event_id, CASE WHEN event_type = 'error' THEN 'sampleError' ELSE 'Given' END AS event_type FROM events
""")
def event_naming_explicit(spark, sf):
    raw = F.when(F.col("event_type") == "error", "sampleError").otherwise("otherSamples")
    ev = table(spark, sf, "events").select("event_id", attrs_of(event_type=raw).alias("attrs"))
    return K.name_events(ev, "s", event_type="Given").select("event_id", "event_type")


@query("""
    SELECT event_id, CASE WHEN event_type = 'click' THEN 'ClickSample' WHEN user_id % 2 = 0 THEN 'EvenSample' ELSE 'base' END AS event_type
    FROM events
""")
def rename_samples_by_key(spark, sf):
    ev = table(spark, sf, "events")
    marks = F.create_map(F.concat(F.lit("is."), F.col("event_type")), F.lit("1"), F.when(F.col("user_id") % 2 == 0, "even").otherwise("odd"), F.lit("1"))
    rows = ev.select("event_id", F.lit("base").alias("event_type"), marks.alias("attrs"))
    return K.rename_samples(rows, {r"^is\.click": "ClickSample", "^even$": "EvenSample"}).select("event_id", "event_type")


@query("""
    SELECT p_partkey, p_brand AS "brand.id", p_size AS "size", p_name AS "pName" FROM part
""")
def wide_plane_keys(spark, sf):
    p = table(spark, sf, "part")
    p = K.keep_columns(p, ["^p_(brand|size|name|type)$"], always=["p_partkey"])
    p = K.remove_columns(p, ["P_TYPE"], always=["p_partkey"])
    p = K.rename_columns(p, {"^p_brand$": "brand.id", "^p_(size)$": "$1"}, only=["p_brand", "p_size"])
    return K.rekey_columns(p, K.camel_name, only=["p_name"])
