"""Payload shape operators over documents built from the tables."""

from pyspark.sql import functions as F

from catalog.registry import attr, doc, query, spread_table, table
from samplecraft.operators import shape


def payloads(df, *keep, **fields):
    return shape.parse_payloads(df.select(*keep, doc(**fields).alias("body"))).drop("body")


def order_documents(spark, sf):
    """Orders with a nested customer, a list of items (1 to 4) and a list of tags."""
    items = F.expr(
        "transform(sequence(1, o_orderkey % 4 + 1), i -> struct(i AS line, struct(o_totalprice * i AS amount) AS price, "
        "array(o_orderstatus, concat('t', i)) AS marks, struct(i * 2 AS half, 'z' AS halfway) AS half))"
    )
    return payloads(
        spread_table(spark, sf, "orders"),
        "o_orderkey",
        status="o_orderstatus",
        customer=F.struct(
            F.col("o_custkey").alias("key"),
            F.struct(F.col("o_orderpriority").alias("priority"), F.lit("").alias("note")).alias("more"),
        ),
        items=items,
        tags=F.array("o_orderstatus", "o_orderpriority"),
    )


@query("""
    SELECT e.event_type, count(*) AS samples FROM events e
    WHERE NOT regexp_matches(json_extract_string(props, '$.k'), '^8') AND 2 * CAST(json_extract_string(props, '$.k') AS DOUBLE) > 10
    GROUP BY e.event_type
""")
def flagship_event_samples(spark, sf):
    """Parse, flatten, add a constant, filter, compute, count: the whole way from payload to counters."""
    from samplecraft.operators import metrics
    from samplecraft.plans.sampling import SampleSpec, to_samples

    ev = table(spark, sf, "events")
    body = doc(event_type="event_type", id="event_id", detail=F.from_json("props", "k bigint"))
    spec = SampleSpec(
        name="events",
        custom_attributes={"env": "test"},
        sample_filter=[{r"^detail\.k$": "^8"}],
        math={"double": "${detail.k} * 2", "big": "${detail.k} * 2 > 10"},
    )
    samples = to_samples(ev.select("event_id", body.alias("body")), spec)
    return metrics.run_counters(samples.filter(attr("big") == "true"))


@query("""
    SELECT event_id, event_type AS kind, user_id AS "user", CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events
""")
def flatten_standard(spark, sf):
    p = payloads(
        table(spark, sf, "events"),
        "event_id",
        a=F.struct(F.struct(F.col("event_type").alias("kind"), F.from_json("props", "k bigint").alias("d")).alias("b")),
        user="user_id",
        gone=F.create_map().cast("map<string,string>"),
    )
    out = shape.flatten_attrs(p)
    return out.select(
        "event_id", attr("a.b.kind").alias("kind"), attr("user", "bigint").alias("user"), attr("a.b.d.k", "bigint").alias("k")
    )


@query("""
    SELECT event_id, event_type AS "a.kind", CAST(json_extract_string(props, '$.k') AS BIGINT) AS "a.d.k" FROM events
""")
def flatten_with_schema(spark, sf):
    ev = table(spark, sf, "events")
    body = doc(a=F.struct(F.col("event_type").alias("kind"), F.from_json("props", "k bigint").alias("d")))
    return shape.flatten_columns(
        ev.select("event_id", body.alias("body")), "body", "a struct<kind:string,d:struct<k:bigint>>"
    )


@query("""
    SELECT o_orderkey, 'itemSamples' AS event_type, CAST(i AS BIGINT) AS line, o_totalprice * i AS amount,
           CAST(NULL AS VARCHAR) AS tag, o_orderstatus AS status, o_custkey AS cust, '["' || o_orderstatus || '","t' || i || '"]' AS marks
    FROM orders, UNNEST(generate_series(1, o_orderkey % 4 + 1)) AS u(i)
    UNION ALL
    SELECT o_orderkey, 'tagSamples', NULL, NULL, UNNEST([o_orderstatus, o_orderpriority]), o_orderstatus, o_custkey, NULL FROM orders
""")
def arrays_to_samples(spark, sf):
    out = shape.to_samples(order_documents(spark, sf))
    return out.select(
        "o_orderkey",
        "event_type",
        attr("line", "bigint").alias("line"),
        attr("price.amount", "double").alias("amount"),
        attr("value").alias("tag"),
        attr("status").alias("status"),
        attr("customer.key", "bigint").alias("cust"),
        attr("markSamples").alias("marks"),
    )


@query("""
    SELECT o_orderkey, o_orderstatus AS status, o_custkey AS cust, o_orderkey % 4 + 1 AS n
    FROM orders, UNNEST(generate_series(1, o_orderkey % 4 + 1)) AS u(i)
""")
def parent_wins_broadcast(spark, sf):
    rows = F.expr("transform(sequence(1, o_orderkey % 4 + 1), i -> struct(i AS line, 'own' AS status))")
    p = payloads(
        spread_table(spark, sf, "orders"), "o_orderkey", status="o_orderstatus", cust="o_custkey", rows=rows,
        n=F.col("o_orderkey") % 4 + 1,
    )
    out = shape.to_samples(p)
    return out.select(
        "o_orderkey", attr("status").alias("status"), attr("cust", "bigint").alias("cust"), attr("n", "bigint").alias("n")
    )


@query("""
    SELECT o_orderkey, o_orderpriority AS priority, CAST(NULL AS BIGINT) AS line FROM orders
    UNION ALL SELECT o_orderkey, NULL, i FROM orders, UNNEST(generate_series(1, o_orderkey % 4 + 1)) AS u(i)
""")
def path_extraction(spark, sf):
    docs = order_documents(spark, sf)
    more = shape.flatten_attrs(shape.extract(docs, ".customer.more, .customer.missing"))
    items = shape.flatten_attrs(shape.extract(docs, ".items"))
    return more.select("o_orderkey", attr("priority").alias("priority"), F.lit(None).cast("bigint").alias("line")).unionByName(
        items.select("o_orderkey", F.lit(None).cast("string").alias("priority"), attr("line", "bigint").alias("line"))
    )


@query("""
    SELECT o_orderkey, o_totalprice * 2 AS second FROM orders WHERE o_orderkey % 4 >= 1
""")
def path_extraction_by_position(spark, sf):
    out = shape.flatten_attrs(shape.extract(order_documents(spark, sf), ".items[1].price"))
    return out.select("o_orderkey", attr("amount", "double").alias("second"))


@query("""
    SELECT o_orderkey, o_orderpriority AS priority, CAST(NULL AS VARCHAR) AS status FROM orders
""")
def descend_to_object(spark, sf):
    out = shape.flatten_attrs(shape.descend(order_documents(spark, sf), ["customer", "more", "missing"]))
    return out.select("o_orderkey", attr("priority").alias("priority"), attr("status").alias("status"))


@query("""
    SELECT o_orderkey, o_orderpriority AS priority, o_orderstatus AS p0, o_custkey AS p1 FROM orders
""")
def descend_with_parents(spark, sf):
    out = shape.flatten_attrs(shape.descend(order_documents(spark, sf), ["customer", "more"], inherit_attributes=True))
    return out.select(
        "o_orderkey",
        attr("priority").alias("priority"),
        attr("parent.0.status").alias("p0"),
        attr("parent.1.key", "bigint").alias("p1"),
    )


@query("""
    SELECT o_orderkey, 'itemSamples' AS event_type, CAST(i AS BIGINT) AS line, o_orderstatus AS p0
    FROM orders, UNNEST(generate_series(1, o_orderkey % 4 + 1)) AS u(i)
""")
def descend_to_array(spark, sf):
    out = shape.to_samples(shape.descend(order_documents(spark, sf), ["items"], inherit_attributes=True))
    return out.select(
        "o_orderkey", "event_type", attr("line", "bigint").alias("line"), attr("parent.0.status").alias("p0")
    )


@query("""
    SELECT o_orderkey, 'priceSamples' AS event_type, o_totalprice * i AS amount, o_orderstatus AS p0, CAST(i AS BIGINT) AS p_line,
           't' || i AS p_mark
    FROM orders, UNNEST(generate_series(1, o_orderkey % 4 + 1)) AS u(i)
""")
def descend_through_elements(spark, sf):
    out = shape.to_samples(shape.descend(order_documents(spark, sf), ["items>price"], inherit_attributes=True))
    return out.select(
        "o_orderkey",
        "event_type",
        attr("amount", "double").alias("amount"),
        attr("parent.0.status").alias("p0"),
        attr("parent.0.line", "bigint").alias("p_line"),
        attr("parent.0.marks.1").alias("p_mark"),
    )


@query("""
    SELECT o_orderkey, CAST(i AS BIGINT) AS line, CAST(NULL AS DOUBLE) AS amount, CAST(NULL AS VARCHAR) AS status, o_custkey AS cust,
           CAST(NULL AS VARCHAR) AS priority
    FROM orders, UNNEST(generate_series(1, o_orderkey % 4 + 1)) AS u(i)
""")
def strip_payload_keys(spark, sf):
    strip = ["status", "items>price", "customer>more", "tags"]
    out = shape.to_samples(shape.strip_keys(order_documents(spark, sf), strip), strip=strip)
    return out.select(
        "o_orderkey",
        attr("line", "bigint").alias("line"),
        attr("price.amount", "double").alias("amount"),
        attr("status").alias("status"),
        attr("customer.key", "bigint").alias("cust"),
        attr("customer.more.priority").alias("priority"),
    )


@query("""
    SELECT o_orderkey, o_totalprice AS first, CASE WHEN o_orderkey % 4 >= 1 THEN o_totalprice * 2 END AS second,
           o_orderpriority AS tag FROM orders
""")
def lazy_flatten_arrays(spark, sf):
    docs = shape.lazy_flatten(order_documents(spark, sf), ["items", "tags"])
    out = shape.to_samples(docs)
    return out.select(
        "o_orderkey",
        attr("items.flat.0.price.amount", "double").alias("first"),
        attr("items.flat.1.price.amount", "double").alias("second"),
        attr("tags.flat.1").alias("tag"),
    )


@query("""
    SELECT o_orderkey, 'itemSamples' AS event_type, CAST(i AS BIGINT) AS line, o_orderstatus AS mark0, 't' || i AS mark1,
           CAST(NULL AS VARCHAR) AS marks, o_orderpriority AS deep
    FROM orders, UNNEST(generate_series(1, o_orderkey % 4 + 1)) AS u(i)
""")
def lazy_flatten_nested(spark, sf):
    docs = shape.lazy_flatten(order_documents(spark, sf), ["items>marks", "customer>more"])
    out = shape.to_samples(shape.strip_keys(docs, ["tags"]))
    return out.select(
        "o_orderkey",
        "event_type",
        attr("line", "bigint").alias("line"),
        attr("marks.0").alias("mark0"),
        attr("marks.1").alias("mark1"),
        attr("markSamples").alias("marks"),
        attr("customer.more.more.priority").alias("deep"),
    )


@query("""
    SELECT c_custkey, 'accountSamples' AS event_type, 'main' AS id, c_acctbal AS balance, c_name AS name FROM customer
    UNION ALL SELECT c_custkey, 'accountSamples', 'seg-' || c_mktsegment, c_nationkey, c_name FROM customer
""")
def keyed_objects_to_samples(spark, sf):
    accounts = F.create_map(
        F.lit("main"),
        F.struct(F.col("c_acctbal").alias("balance")),
        F.concat(F.lit("seg-"), F.col("c_mktsegment")),
        F.struct(F.col("c_nationkey").cast("double").alias("balance")),
    )
    p = payloads(table(spark, sf, "customer"), "c_custkey", name="c_name", accounts=accounts)
    out = shape.to_samples(p, sample_keys={"a": "accounts>account.id"})
    return out.select(
        "c_custkey", "event_type", attr("account.id").alias("id"), attr("balance", "double").alias("balance"), attr("name").alias("name")
    )


@query("""
    SELECT c_custkey, 'Samples' AS event_type, 'first' AS id, c_name AS name, c_acctbal AS balance FROM customer
    UNION ALL SELECT c_custkey, 'Samples', 'second', c_mktsegment, NULL FROM customer
""")
def split_top_objects(spark, sf):
    p = payloads(
        table(spark, sf, "customer"),
        "c_custkey",
        first=F.struct(F.col("c_name").alias("name"), F.struct(F.col("c_acctbal").alias("bal")).alias("x")),
        second=F.struct(F.col("c_mktsegment").alias("name")),
        scalar="c_nationkey",
        list=F.array("c_name"),
    )
    out = shape.to_samples(p, split_objects=True)
    return out.select(
        "c_custkey", "event_type", attr("split.id").alias("id"), attr("name").alias("name"), attr("x.bal", "double").alias("balance")
    )


@query("""
    SELECT o_orderkey, CAST(i * 1000 AS DOUBLE) AS t, o_totalprice * i AS v, 'x' AS more3, o_orderstatus AS status,
           o_orderpriority AS priority
    FROM orders, UNNEST(generate_series(1, o_orderkey % 4 + 1)) AS u(i)
""")
def split_nested_arrays(spark, sf):
    rows = F.expr(
        "concat('[', array_join(transform(sequence(1, o_orderkey % 4 + 1), i -> concat('[', i * 1000, ',', o_totalprice * i, "
        "',\"x\"]')), ','), ']')"
    )
    inner = F.concat(
        F.lit('{"data":[[{"status":"'), F.col("o_orderstatus"), F.lit('","unit":{"priority":"'), F.col("o_orderpriority"),
        F.lit('"},"rows":'), rows, F.lit("}]]}"),
    )
    p = shape.parse_payloads(spread_table(spark, sf, "orders").select("o_orderkey", inner.alias("body"))).drop("body")
    out = shape.to_samples(p, split_array=True, set_header=["t", "v"])
    return out.select(
        "o_orderkey",
        attr("t", "double").alias("t"),
        F.round(attr("v", "double"), 2).alias("v"),
        attr("data-rows2").alias("more3"),
        attr("data-status").alias("status"),
        attr("data-unit-priority").alias("priority"),
    )


@query("""
    SELECT vec_id, CAST(i - 1 AS INTEGER) AS index, round(CAST(embedding[i] AS DOUBLE), 4) AS x, CAST(label AS VARCHAR) AS label
    FROM embeddings, UNNEST(generate_series(1, len(embedding))) AS u(i)
""")
def leaf_arrays(spark, sf):
    e = table(spark, sf, "embeddings")
    p = payloads(e, "vec_id", vec=F.array(F.struct(F.transform("embedding", lambda x: x.cast("double")).alias("values"), F.col("label").cast("string").alias("label"))))
    out = shape.to_samples(p, split_array=True, leaf_array=True, set_header=["x"], number_style="plain")
    return out.select(
        "vec_id", attr("index", "int").alias("index"), F.round(attr("x", "double"), 4).alias("x"), attr("vec-label").alias("label")
    )


@query("""
    SELECT event_id, event_type AS job, CAST(floor(epoch(ts)) AS BIGINT) + i AS timestamp, value + i AS value
    FROM (SELECT *, UNNEST([0, 1]) AS i FROM events)
    UNION ALL SELECT event_id, 'one', CAST(floor(epoch(ts)) AS BIGINT), user_id FROM events
""")
def time_value_pairs(spark, sf):
    seconds = F.unix_seconds(F.col("ts").cast("timestamp"))
    body = F.concat(
        F.lit('{"result":[{"metric":{"job":"'), F.col("event_type"), F.lit('"},"values":[['), seconds, F.lit('.5,"'), F.col("value"),
        F.lit('"],['), seconds + 1, F.lit('.5,"'), F.col("value") + 1, F.lit('"]]},{"metric":{"job":"one"},"value":['), seconds,
        F.lit('.25,"'), F.col("user_id"), F.lit('"]}]}'),
    )
    p = shape.parse_payloads(spread_table(spark, sf, "events").select("event_id", body.alias("body"))).drop("body")
    out = shape.to_samples(p, time_value_pairs=True)
    return out.select(
        "event_id",
        attr("metric.job").alias("job"),
        attr("timestamp", "bigint").alias("timestamp"),
        attr("value", "double").alias("value"),
    )


@query("""
    SELECT o_orderkey, CAST(count(*) AS BIGINT) AS rows, 1 AS objects
    FROM orders, UNNEST(generate_series(1, o_orderkey % 4 + 1)) AS u(i) GROUP BY o_orderkey
""")
def array_payload_objects(spark, sf):
    body = F.expr("concat('[1,', array_join(transform(sequence(1, o_orderkey % 4 + 1), i -> concat('{\"i\":', i, '}')), ','), ']')")
    p = shape.parse_payloads(spread_table(spark, sf, "orders").select("o_orderkey", body.alias("body"))).drop("body")
    out = shape.flatten_attrs(shape.payload_objects(p))
    return out.groupBy("o_orderkey").agg(F.count(attr("i")).alias("rows"), F.min(F.size("attrs")).alias("objects"))


@query("""
    SELECT o_orderkey, (o_orderkey % 40 + 1) AS depth, rtrim(repeat('k.', CAST(o_orderkey % 40 + 1 AS INTEGER)), '.') || '.v' AS path,
           CAST(o_custkey AS VARCHAR) AS value, CAST(o_orderkey AS VARCHAR) AS beside
    FROM orders
""")
def flatten_any_depth(spark, sf):
    """Objects nested 1 to 40 deep: the leaf keeps its path and value."""
    depth = (F.col("o_orderkey") % 40 + 1).cast("int")
    body = F.concat(F.lit('{"id":'), "o_orderkey", F.lit(","), F.substring(F.concat(F.repeat(F.lit('{"k":'), depth), F.lit('{"v":'), "o_custkey", F.repeat(F.lit("}"), depth + 1)), F.lit(2), F.lit(10_000)))
    p = shape.parse_payloads(spread_table(spark, sf, "orders").select("o_orderkey", depth.cast("bigint").alias("depth"), body.alias("body"))).drop("body")
    out = shape.to_samples(p)
    path = F.filter(F.map_keys("attrs"), lambda k: k != "id")[0]
    return out.select("o_orderkey", "depth", path.alias("path"), F.col("attrs")[path].alias("value"), attr("id").alias("beside"))


@query("""
    SELECT event_id, CAST(event_id * 1000 AS DOUBLE) AS a, CAST(user_id AS DOUBLE) AS b, 'mSamples' AS set_name
    FROM events
""")
def split_arrays_any_depth(spark, sf):
    """Arrays nested 1 to 40 deep: the innermost one becomes a row."""
    depth = (F.col("event_id") % 40 + 1).cast("int")
    body = F.concat(F.lit('{"m":'), F.repeat(F.lit("["), depth), (F.col("event_id") * 1000).cast("string"), F.lit(","), "user_id", F.repeat(F.lit("]"), depth), F.lit("}"))
    p = shape.parse_payloads(spread_table(spark, sf, "events").select("event_id", body.alias("body"))).drop("body")
    out = shape.to_samples(p, split_array=True, set_header=["a", "b"])
    return out.select("event_id", attr("a", "double").alias("a"), attr("b", "double").alias("b"), F.col("event_type").alias("set_name"))


@query("""
    SELECT event_id, CAST(event_id AS VARCHAR) AS id, part FROM events, (VALUES ('x'), ('y')) AS t(part)
    WHERE part = 'x' OR event_id % 3 = 0
""")
def nested_list_payloads(spark, sf):
    """Lists of lists 1 to 40 deep: every object in them is a payload, bare scalars are none."""
    depth = (F.col("event_id") % 40 + 1).cast("int")

    def one(part: str) -> F.Column:
        return F.concat(F.lit('{"id":'), "event_id", F.lit(f',"part":"{part}"}}'))

    second = F.when(F.col("event_id") % 3 == 0, F.concat(F.lit(",1,["), one("y"), F.lit("]"))).otherwise(F.lit(""))
    body = F.concat(F.repeat(F.lit("["), depth), one("x"), second, F.repeat(F.lit("]"), depth))
    p = shape.parse_payloads(spread_table(spark, sf, "events").select("event_id", body.alias("body"))).drop("body")
    out = shape.to_samples(shape.payload_objects(p))
    return out.select("event_id", attr("id").alias("id"), attr("part").alias("part"))
