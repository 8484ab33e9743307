"""Scans, text payloads and formats."""

import pyarrow as pa
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from catalog.registry import attr, attrs_of, doc, lines, query, table, text
from samplecraft.operators import combine, metrics, shape
from samplecraft.session import shared_folder
from samplecraft.sinks import output
from samplecraft.sources import payloads as P
from samplecraft.sources import records as R
from samplecraft.sources import text as T
from samplecraft.sources import xml as X


@query("""
    SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k, 'a' || 'b' AS tag FROM events
""")
def json_documents_without_blanks(spark, sf):
    ev = table(spark, sf, "events")
    body = F.concat(F.expr("left(props, length(props) - 1)"), F.lit(', "t g": "a b"}'))
    out = P.decode_json(ev.select("event_id", body.alias("body")), strip_blanks=True)
    out = shape.flatten_attrs(out.drop("body"))
    return out.select("event_id", attr("k", "bigint").alias("k"), attr("tg").alias("tag"))


@query("""
    SELECT p_partkey, CAST(i - 1 AS INTEGER) AS sample_ix, p_name AS name, p_type || ', no ' || i AS kind, CAST(i AS BIGINT) AS n
    FROM part, UNNEST(generate_series(1, p_size % 4 + 1)) AS u(i)
""")
def csv_text(spark, sf):
    records = F.expr(
        "transform(sequence(1, p_size % 4 + 1), i -> concat(p_name, ',\"', p_type, ', no ', i, '\",', i))"
    )
    body = F.concat(F.lit("name,kind,n\n"), F.array_join(records, "\r\n"), F.lit("\n"))
    out = P.csv_text_samples(table(spark, sf, "part").select("p_partkey", body.alias("body")))
    return out.select(
        "p_partkey", "sample_ix", attr("name").alias("name"), attr("kind").alias("kind"), attr("n", "bigint").alias("n")
    )


@query("""
    SELECT 'flags' AS label, 'flags_' || row_number() OVER (ORDER BY l_returnflag, l_linestatus) AS row_id,
           'flags' AS event_type, l_returnflag || l_linestatus AS what, count(*) AS n
    FROM lineitem GROUP BY l_returnflag, l_linestatus
    UNION ALL
    SELECT 'orders', 'orders_' || row_number() OVER (ORDER BY o_orderkey), 'OrderSample', o_orderpriority, o_orderkey
    FROM orders
""")
def labelled_queries(spark, sf):
    for name in ("lineitem", "orders"):
        table(spark, sf, name).createOrReplaceTempView(f"captured_{name}")
    out = P.query_samples(
        spark,
        [
            (
                "flags",
                "SELECT concat(l_returnflag, l_linestatus) AS what, count(*) AS n FROM captured_lineitem "
                "GROUP BY l_returnflag, l_linestatus",
                None,
                ["what"],
            ),
            ("orders", "SELECT o_orderpriority AS what, o_orderkey AS n FROM captured_orders", "OrderSample", ["n"]),
            ("", "SELECT 1", None, []),
        ],
    )
    return out.select(
        attr("queryLabel").alias("label"),
        attr("rowIdentifier").alias("row_id"),
        "event_type",
        attr("what").alias("what"),
        attr("n", "bigint").alias("n"),
    )


@query("""
    SELECT event_id, epoch_us(ts) // 1000 AS start_ms, user_id * 10 AS took_ms, event_type AS kind FROM events
""")
def capture_times(spark, sf):
    ev = table(spark, sf, "events").withColumn("attrs", attrs_of(kind="event_type"))
    out = P.capture_times(ev, F.unix_millis(F.col("ts").cast("timestamp")), F.col("user_id") * 10)
    return out.select(
        "event_id",
        attr("query.startMs", "bigint").alias("start_ms"),
        attr("query.timeMs", "bigint").alias("took_ms"),
        attr("kind").alias("kind"),
    )


@query("""
    SELECT o_orderkey, o_custkey AS cust, o_orderstatus || ':' || o_orderpriority AS state, 'last' AS dup,
           CAST(NULL AS VARCHAR) AS skipped, 'x' AS shell
    FROM orders
""")
def key_value_text(spark, sf):
    body = lines(
        "skipped:1",
        text("cust:", F.col("o_custkey"), "\r"),
        text("state:", F.col("o_orderstatus"), ":", F.col("o_orderpriority")),
        "noise without a separator",
        "dup:first",
        "dup:last",
        "after:the end",
    )
    out = T.key_value_samples(
        table(spark, sf, "orders").select("o_orderkey", body.alias("body")),
        ":",
        line_start=1,
        line_end=6,
        custom_attributes={"shell": "x"},
    )
    return out.select(
        "o_orderkey",
        attr("cust", "bigint").alias("cust"),
        attr("state").alias("state"),
        attr("dup").alias("dup"),
        attr("skipped").alias("skipped"),
        attr("shell").alias("shell"),
    )


@query("""
    WITH l AS (
        SELECT doc_id, UNNEST(string_split(regexp_replace(text, '\\n$', ''), chr(10))) AS line FROM documents
    ), kv AS (
        SELECT doc_id, left(line, instr(line, ', ') - 1) AS k FROM l WHERE contains(line, ', ')
    )
    SELECT d.doc_id, coalesce(n, 0) AS keys FROM documents d
    LEFT JOIN (SELECT doc_id, count(DISTINCT k) AS n FROM kv GROUP BY doc_id) USING (doc_id)
""")
def key_value_documents(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", F.col("text").alias("body"))
    out = T.key_value_samples(docs, ", ")
    return out.select("doc_id", F.size("attrs").cast("bigint").alias("keys"))


@query("""
    WITH l AS (
        SELECT doc_id, string_split(regexp_replace(text, '\\n$', ''), chr(10)) AS ls FROM documents
    ), n AS (
        SELECT doc_id, i - 1 AS ix, ls[i] AS line FROM l, UNNEST(generate_series(1, len(ls))) AS u(i)
    )
    SELECT doc_id, CAST(ix AS INTEGER) AS sample_ix, string_split(line, ' ')[1] AS w1,
           string_split(line, ' ')[2] AS w2, string_split(line, ' ')[3] AS w3
    FROM n
""")
def column_text_documents(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", F.col("text").alias("body"))
    out = T.column_samples(docs, " ", set_header=["w1", "w2", "w3"])
    return out.select("doc_id", "sample_ix", *[attr(k).alias(k) for k in ("w1", "w2", "w3")])


@query("""
    SELECT c_custkey, CAST(i + 1 AS INTEGER) AS sample_ix, c_mktsegment AS segment, c_acctbal * i AS balance,
           CAST(i AS BIGINT) AS line, 'v' AS earlier
    FROM customer, UNNEST(generate_series(1, c_nationkey % 3 + 1)) AS u(i)
""")
def column_text_with_header(spark, sf):
    rows = F.expr(
        "transform(sequence(1, c_nationkey % 3 + 1), i -> concat(c_mktsegment, '   ', c_acctbal * i, ' ', i, '  extra'))"
    )
    body = F.concat(F.lit("some tool 1.0\nsegment  balance   line\n"), F.array_join(rows, "\n"), F.lit("\n"))
    cust = table(spark, sf, "customer").select("c_custkey", body.alias("body"), attrs_of(earlier=F.lit("v")).alias("kv"))
    out = T.column_samples(cust, r"\s+", row_header=1, row_start=2, earlier="kv")
    return out.select(
        "c_custkey",
        "sample_ix",
        attr("segment").alias("segment"),
        attr("balance", "double").alias("balance"),
        attr("line", "bigint").alias("line"),
        attr("earlier").alias("earlier"),
    )


@query("""
    SELECT p_partkey, p_brand AS brand, p_size AS size FROM part
""")
def header_regex_groups(spark, sf):
    body = lines("[brand] <size>", text("b=", F.col("p_brand"), " s=", F.col("p_size")), "not a row")
    out = T.column_samples(
        table(spark, sf, "part").select("p_partkey", body.alias("body")),
        r"^b=(\S+) s=(\d+)$",
        header_split_by=r"\[(\w+)\] <(\w+)>",
        regex_match=True,
        header_regex_match=True,
    )
    return out.select("p_partkey", attr("brand").alias("brand"), attr("size", "int").alias("size"))


_BLOCKS = """
    WITH l AS (
        SELECT doc_id, string_split(regexp_replace(text, '\\n$', ''), chr(10)) AS ls FROM documents
    ), n AS (
        SELECT doc_id, len(ls) AS total, i - 1 AS ix, ls[i] AS line FROM l, UNNEST(generate_series(1, len(ls))) AS u(i)
    ), b AS (
        SELECT *, sum(CASE WHEN regexp_matches(line, '^[A-M]') THEN 1 ELSE 0 END)
                   OVER (PARTITION BY doc_id ORDER BY ix) AS block,
               sum(CASE WHEN regexp_matches(line, '^[A-M]') THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id) AS hits
        FROM n
    ), k AS (
        SELECT doc_id, CASE WHEN total = 1 THEN 0 ELSE block END AS block, ix, line FROM b WHERE total = 1 OR hits > 0
    )
"""


@query(_BLOCKS + """
    SELECT doc_id, count(DISTINCT block) AS blocks_with_lines, count(*) AS lines FROM k GROUP BY doc_id
""")
def block_split(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", F.col("text").alias("body"))
    out = T.split_blocks(docs, "^[A-M]").select("doc_id", F.transform("blocks", F.size).alias("sizes"))
    return out.filter(F.size("sizes") > 0).select(
        "doc_id",
        F.size(F.filter("sizes", lambda n: n > 0)).cast("bigint").alias("blocks_with_lines"),
        F.aggregate("sizes", F.lit(0), lambda a, n: a + n).cast("bigint").alias("lines"),
    )


@query(_BLOCKS + """
    , m AS (
        SELECT doc_id, block, ix, regexp_extract(line, '([a-z]+) ([a-z]+)', 1) AS a,
               regexp_extract(line, '([a-z]+) ([a-z]+)', 2) AS b
        FROM k WHERE regexp_matches(line, '([a-z]+) ([a-z]+)')
    ), q AS (
        SELECT doc_id, block, ix, regexp_extract(line, '(\\w+)\\.$', 1) AS z FROM k WHERE regexp_matches(line, '(\\w+)\\.$')
    )
    SELECT coalesce(m.doc_id, q.doc_id) AS doc_id, CAST(coalesce(m.block, q.block) AS INTEGER) AS block, a, b, z
    FROM (SELECT doc_id, block, arg_max(a, ix) AS a, arg_max(b, ix) AS b FROM m GROUP BY ALL) m
    FULL JOIN (SELECT doc_id, block, arg_max(z, ix) AS z FROM q GROUP BY ALL) q USING (doc_id, block)
""")
def block_regex_fields(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", F.col("text").alias("body"))
    out = T.block_samples(
        docs,
        "^[A-M]",
        [{"expression": "([a-z]+) ([a-z]+)", "keys": ["a", "b"]}, {"expression": r"(\w+)\.$", "keys": ["z"]}],
    )
    return out.select("doc_id", F.col("sample_ix").alias("block"), *[attr(k).alias(k) for k in ("a", "b", "z")])


@query("""
    SELECT o_orderkey, o_custkey AS read_n, CAST(o_totalprice AS DOUBLE) AS write_n, o_orderstatus AS mount FROM orders
""")
def block_prefixed_fields(spark, sf):
    body = lines(
        "header to skip",
        text("disk ", F.col("o_orderstatus"), " mounted"),
        text("  n ", F.col("o_custkey")),
        text("  n ", F.col("o_totalprice")),
    )
    out = T.block_samples(
        table(spark, sf, "orders").select("o_orderkey", body.alias("body")),
        "mounted$",
        [
            {"expression": r"^disk (\S+) mounted", "keys": ["mount"]},
            {"expression": r"^\s+n (\S+)", "keys": ["n"], "keys_multi": ["read.", "write."]},
        ],
    )
    return out.select(
        "o_orderkey",
        attr("read.n", "bigint").alias("read_n"),
        attr("write.n", "double").alias("write_n"),
        attr("mount").alias("mount"),
    )


@query("""
    WITH b AS (
        SELECT 'events' AS src, props AS body FROM events
        UNION ALL SELECT 'documents', text FROM documents
        UNION ALL SELECT 'pages', html FROM pages
        UNION ALL SELECT 'customer', '  <?xml version="1.0"?><c/>' FROM customer
    )
    SELECT src, CASE WHEN json_valid(body) THEN 'json' WHEN starts_with(ltrim(body), '<?xml version=') THEN 'xml'
                     ELSE 'raw' END AS format, count(*) AS n
    FROM b GROUP BY ALL
""")
def format_detection(spark, sf):
    bodies = combine.union_samples(
        table(spark, sf, "events").select(F.lit("events").alias("src"), F.col("props").alias("body")),
        table(spark, sf, "documents").select(F.lit("documents").alias("src"), F.col("text").alias("body")),
        table(spark, sf, "pages").select(F.lit("pages").alias("src"), F.col("html").alias("body")),
        table(spark, sf, "customer").select(
            F.lit("customer").alias("src"), F.lit('  <?xml version="1.0"?><c/>').alias("body")
        ),
    )
    return P.detect_format(bodies).groupBy("src", "format").agg(F.count(F.lit(1)).alias("n"))


@query("""
    SELECT c_custkey, c_custkey AS id, c_name AS name, c_acctbal AS balance, c_mktsegment AS segment FROM customer
""")
def xml_payloads(spark, sf):
    body = text(
        '<?xml version="1.0"?><customer id="',
        F.col("c_custkey"),
        '"><name>',
        F.col("c_name"),
        "</name><account><balance>",
        F.col("c_acctbal"),
        "</balance><segment>",
        F.col("c_mktsegment"),
        "</segment></account></customer>",
    )
    out = P.parse_xml(
        table(spark, sf, "customer").select("c_custkey", body.alias("body")),
        "`-id` bigint, name string, account struct<balance:double,segment:string>",
    )
    out = shape.flatten_attrs(out.drop("body"))
    return out.select(
        "c_custkey",
        attr("-id", "bigint").alias("id"),
        attr("name").alias("name"),
        attr("account.balance", "double").alias("balance"),
        attr("account.segment").alias("segment"),
    )


@query("""
    SELECT o_orderkey, 'kv' AS via, o_orderstatus AS status FROM orders
    UNION ALL SELECT o_orderkey, 'columns', o_orderstatus FROM orders
""")
def cached_payloads_reused(spark, sf):
    body = text("status=", F.col("o_orderstatus"))
    store = P.Captures()
    store.store("orders", table(spark, sf, "orders").select("o_orderkey", body.alias("body")))
    kv = T.key_value_samples(store.reuse("orders"), "=")
    cols = T.column_samples(store.reuse("orders"), "=", set_header=["name", "status"])
    return combine.union_samples(
        kv.select("o_orderkey", F.lit("kv").alias("via"), attr("status").alias("status")),
        cols.select("o_orderkey", F.lit("columns").alias("via"), attr("status").alias("status")),
    )


@query("""
    SELECT page_id, url FROM pages
    WHERE regexp_matches(html, '<html lang="(en|fr)">') AND NOT regexp_matches(html, 'track\\(\\d*7\\)')
""")
def payload_assertion(spark, sf):
    pages = table(spark, sf, "pages")
    out = P.assert_text(pages, '<html lang="(en|fr)">', r"track\(\d*7\)", body="html")
    return out.select("page_id", "url")


@query("""
    WITH b AS (SELECT 'e' || event_id AS payload_id, props AS body FROM events
               UNION ALL SELECT 'd' || doc_id, text FROM documents)
    SELECT payload_id, CASE WHEN json_valid(body) THEN 'ok' ELSE 'sampleError' END AS event_type FROM b
""")
def error_rows(spark, sf):
    bodies = table(spark, sf, "events").select(
        F.concat(F.lit("e"), F.col("event_id")).alias("payload_id"), F.col("props").alias("body")
    ).unionByName(
        table(spark, sf, "documents").select(
            F.concat(F.lit("d"), F.col("doc_id")).alias("payload_id"), F.col("text").alias("body")
        )
    )
    good, bad = P.quarantine(P.decode_json(bodies))
    return good.select("payload_id", F.lit("ok").alias("event_type")).unionByName(
        P.error_samples(bad).select("payload_id", "event_type")
    )


@query("""
    SELECT event_id, event_type AS kind, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events
""")
def ingested_events(spark, sf):
    ev = table(spark, sf, "events")
    body = doc(kind="event_type", detail=F.from_json("props", "k bigint"))
    out = shape.flatten_attrs(shape.parse_payloads(ev.select("event_id", body.alias("body"))).drop("body"))
    return out.select("event_id", attr("kind").alias("kind"), attr("detail.k", "bigint").alias("k"))


@query("SELECT doc_id, CAST(length(text) AS BIGINT) AS n, md5(text) AS digest, CAST(doc_id % 2 AS INTEGER) AS errors FROM documents")
def csv_whole_documents(spark, sf):
    """Whole documents as quoted CSV fields with line ends; after every other one a record of another width."""
    field = F.concat(F.lit('"'), F.replace("text", F.lit('"'), F.lit('""')), F.lit('"'))
    ragged = F.when(F.col("doc_id") % 2 == 1, F.lit("1,2,3\n9,unread\n")).otherwise(F.lit(""))
    body = F.concat(F.lit("id,text\n"), F.col("doc_id"), F.lit(","), field, F.lit("\n"), ragged)
    out = P.csv_text_samples(table(spark, sf, "documents").select("doc_id", body.alias("body")))
    text = F.max(attr("text"))
    return out.groupBy("doc_id").agg(
        F.length(text).cast("bigint").alias("n"), F.md5(F.encode(text, "UTF-8")).alias("digest"), F.count("error_msg").cast("int").alias("errors")
    )


@query("SELECT o_orderkey, o_orderstatus AS status, CAST(o_custkey AS VARCHAR) AS customer FROM orders")
def json_repeated_keys(spark, sf):
    """A key that an object repeats has its last value."""
    body = text('{"status":"?","customer":0,"status":"', F.col("o_orderstatus"), '","customer":', F.col("o_custkey"), "}")
    p = P.decode_json(table(spark, sf, "orders").select("o_orderkey", body.alias("body")))
    status, customer = (F.try_variant_get("payload", f"$.{k}", "string") for k in ("status", "customer"))
    return p.select("o_orderkey", status.alias("status"), customer.alias("customer"))


@query("SELECT n_nationkey, n_name AS name, CAST(n_nationkey AS VARCHAR) AS id FROM nation")
def xml_with_schema_object(spark, sf):
    """A schema given as an object, with an attribute column."""
    schema = StructType([StructField("-id", StringType()), StructField("name", StringType())])
    body = text('<n id="', F.col("n_nationkey"), '"><name>', F.col("n_name"), "</name></n>")
    p = P.parse_xml(table(spark, sf, "nation").select("n_nationkey", body.alias("body")), schema)
    name, ident = F.try_variant_get("payload", "$.name", "string"), F.try_variant_get("payload", "$['-id']", "string")
    return p.select("n_nationkey", name.alias("name"), ident.alias("id"))


@query("SELECT n_nationkey AS key, n_name AS name, n_regionkey AS region FROM nation")
def csv_files_scanned(spark, sf):
    """Written as CSV into the shared folder and scanned as samples."""
    folder = f"{shared_folder(spark)}/csv"
    table(spark, sf, "nation").select("n_nationkey", "n_name", "n_regionkey").write.option("header", True).csv(folder)
    out = P.read_csv_samples(spark, folder)
    return out.select(F.col("n_nationkey").cast("int").alias("key"), F.col("n_name").alias("name"), F.col("n_regionkey").cast("int").alias("region"))


@query("SELECT c_custkey AS key, c_mktsegment AS segment, c_name AS name, 'customer' AS event_type FROM customer")
def json_files_scanned(spark, sf):
    """Samples written as JSON lines, each line scanned as a payload again."""
    folder = f"{shared_folder(spark)}/json"
    c = table(spark, sf, "customer").select(F.lit("customer").alias("event_type"), attrs_of(key="c_custkey", segment="c_mktsegment", name="c_name").alias("attrs"))
    output.write_json(c, folder)
    payloads = P.decode_json(spark.read.text(folder).select(F.col("value").alias("body"))).drop("body")
    out = shape.flatten_attrs(payloads)
    return out.select(attr("key", "bigint").alias("key"), attr("segment").alias("segment"), attr("name").alias("name"), attr("event_type").alias("event_type"))


@query("SELECT n_regionkey AS region, n_name AS name FROM nation")
def sample_table_written(spark, sf):
    """A table partitioned by event type, read back by type."""
    folder = f"{shared_folder(spark)}/table"
    n = table(spark, sf, "nation")
    output.write_samples(n.select(F.concat(F.lit("region"), "n_regionkey").alias("event_type"), attrs_of(name="n_name").alias("attrs")), folder)
    back = spark.read.parquet(folder)
    return back.select(F.substring("event_type", 7, 9).cast("int").alias("region"), attr("name").alias("name"))


@query("""
    SELECT c_custkey AS id, 'customer' AS kind, c_name AS name, CAST(c_nationkey AS VARCHAR) AS nation, CAST(NULL AS VARCHAR) AS note, 0 AS ix FROM customer
    UNION ALL SELECT o_orderkey, 'lineSample', o_orderstatus, CAST(i AS VARCHAR), NULL, CAST(i AS INTEGER)
    FROM orders, (VALUES (0), (1)) AS t(i) WHERE o_orderkey % 2 = 0
    UNION ALL SELECT o_orderkey, 'order', o_orderstatus, '0', 'see ' || o_custkey || ' & more', 0 FROM orders WHERE o_orderkey % 2 = 1
    UNION ALL SELECT s_suppkey, 'error', NULL, NULL, NULL, 0 FROM supplier
""")
def xml_any_shape(spark, sf):
    """Documents of differing shape without a schema: attributes, one or two elements of a name, mixed text, namespaces, and some that are no XML."""
    c, o, s = (table(spark, sf, n) for n in ("customer", "orders", "supplier"))
    one = text('<?xml version="1.0"?><x:c xmlns:x="urn:c" id="', F.col("c_custkey"), '"><x:name>', F.col("c_name"), '</x:name><at nation="', F.col("c_nationkey"), '"/></x:c>')
    head = text('<o id="', F.col("o_orderkey"), '"><status>', F.col("o_orderstatus"), "</status>")
    lines_ = text(head, '<line no="0"><k>a</k></line><line no="1"/></o>')
    mixed = text(head, '<line no="0"/><note>see <b>', F.col("o_custkey"), "</b> &amp; <![CDATA[more]]></note></o>")
    docs = c.select(F.col("c_custkey").alias("id"), one.alias("body")).unionByName(
        o.select(F.col("o_orderkey").alias("id"), F.when(F.col("o_orderkey") % 2 == 0, lines_).otherwise(mixed).alias("body"))
    ).unionByName(s.select(F.col("s_suppkey").alias("id"), text("<s><name>", F.col("s_name"), "</s>").alias("body")))
    p = X.parse_any_xml(docs).drop("body")
    good, bad = p.where("payload IS NOT NULL"), p.where("payload IS NULL")
    rows = shape.to_samples(shape.descend(shape.payload_objects(good), ["o"]))
    kind = F.when(F.col("event_type").isNotNull(), F.replace("event_type", F.lit("Samples"), F.lit("Sample"))).when(attr("c.-id").isNotNull(), "customer").otherwise("order")
    # the pieces of mixed text around an element are joined
    note = F.when(attr("note.b").isNotNull(), F.replace(attr("note.#content"), F.lit("see "), F.concat(F.lit("see "), attr("note.b"), F.lit(" "))))
    found = rows.select(
        "id", kind.alias("kind"), F.coalesce(attr("c.name"), attr("status")).alias("name"),
        F.coalesce(attr("c.at.-nation"), attr("-no"), attr("line.-no")).alias("nation"), note.alias("note"), F.col("sample_ix").cast("int").alias("ix"),
    )
    none = F.lit(None).cast("string")
    return found.unionByName(bad.select("id", F.lit("error").alias("kind"), none.alias("name"), none.alias("nation"), none.alias("note"), F.lit(0).alias("ix")))


@query("SELECT n_nationkey AS key, n_name AS name, n_regionkey AS region FROM nation")
def xml_files_scanned(spark, sf):
    """Written as XML files into the shared folder and scanned, a payload for each row element."""
    folder = f"{shared_folder(spark)}/xml"
    n = table(spark, sf, "nation").select(F.col("n_nationkey").alias("-key"), F.col("n_name").alias("name"), F.col("n_regionkey").alias("region"))
    n.write.format("xml").option("rowTag", "nation").option("rootTag", "nations").option("attributePrefix", "-").save(folder)
    p = P.read_xml(spark, folder, "nation", "`-key` int, name string, region int")
    cell = lambda k, t: F.try_variant_get("payload", f"$['{k}']", t)
    return p.select(cell("-key", "int").alias("key"), cell("name", "string").alias("name"), cell("region", "int").alias("region"))


@query("""
    SELECT o_orderkey AS key, o_custkey AS cust, 'a,"b" ]}' || o_orderstatus AS note FROM orders UNION ALL SELECT c_custkey, NULL, c_name FROM customer
""")
def json_array_in_one_file(spark, sf):
    """Two tables, a file for each task that reads them, each one array of all its rows: every element is a payload, read by as
    many tasks as the files have blocks."""
    folder = f"{shared_folder(spark)}/arrays"
    o = table(spark, sf, "orders").select(doc(key="o_orderkey", cust="o_custkey", note=text('a,"b" ]}', F.col("o_orderstatus"))).alias("value"))
    c = table(spark, sf, "customer").select(doc(key="c_custkey", note="c_name").alias("value"))

    def closed(batches):
        """The rows of a task, and behind them the bracket that ends their array."""
        held = None
        for held in batches:
            yield held
        if held is not None:
            yield pa.RecordBatch.from_arrays([pa.array(["]"], held.schema.field(0).type)], schema=held.schema)

    for name, rows in (("orders", o), ("customers", c)):
        # an element a line, the brackets on lines of their own
        place = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
        begun = rows.select(F.concat(F.when(place == 0, F.lit("[\n")).otherwise(F.lit(", ")), "value").alias("value"))
        begun.mapInArrow(closed, "value string").write.text(f"{folder}/{name}")
    p = R.read_json_array(spark, [f"{folder}/orders", f"{folder}/customers"])
    cell = lambda k, t: F.try_variant_get("payload", f"$.{k}", t)
    return p.select(cell("key", "bigint").alias("key"), cell("cust", "bigint").alias("cust"), cell("note", "string").alias("note"))


@query("""
    SELECT doc_id, length(text) AS n, md5(text) AS digest FROM documents WHERE text IS NOT NULL
""")
def csv_quoted_in_one_file(spark, sf):
    """All documents as quoted fields of CSV files, with their separators, quotes and line ends: a file for each task that
    reads the table, cut again into blocks as it is read."""
    folder = f"{shared_folder(spark)}/quoted"
    d = table(spark, sf, "documents").where("text IS NOT NULL")
    line = text(F.col("doc_id"), ',"', F.replace("text", F.lit('"'), F.lit('""')), '"')
    d.select(line.alias("value")).write.text(folder)
    out = R.read_csv_records(spark, folder, ["doc_id", "text"])
    return out.select(attr("doc_id", "bigint").alias("doc_id"), F.length(attr("text")).cast("bigint").alias("n"), F.md5(F.encode(attr("text"), "UTF-8")).alias("digest"))


@query("""
    SELECT event_type, count(*) AS rows, count(*) AS samples FROM events GROUP BY event_type
    UNION ALL SELECT 'all', count(*), count(*) FROM events
""")
def observed_counters(spark, sf):
    """Rows counted beside the action that writes them, and counted from what was written."""
    folder = f"{shared_folder(spark)}/counted"
    ev = table(spark, sf, "events").select("event_type", attrs_of(user="user_id").alias("attrs"))
    seen, counter = metrics.observe_counts(ev)
    output.write_samples(seen, folder)
    back = spark.read.parquet(folder)
    by_type = metrics.run_counters(back)
    every = back.agg(F.count(F.lit(1)).alias("samples")).select(F.lit("all").alias("event_type"), F.lit(counter.get["rows"]).cast("bigint").alias("rows"), "samples")
    return by_type.select("event_type", F.col("samples").alias("rows"), "samples").unionByName(every)
