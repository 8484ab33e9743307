"""Exposition text, bean dumps, responses, page sequences and HTML tables."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from catalog.registry import attr, attrs_of, doc, lines, query, spread_table, table, text
from samplecraft.operators import shape
from samplecraft.operators.numbering import number_rows
from samplecraft.sources import beans as B
from samplecraft.sources import prometheus as P
from samplecraft.sources import web as W
from samplecraft.sources.pages import chain_pages, next_page


def exposition(spark, sf, go_metrics=True, compat=False):
    """Every event as one scrape: an unlabelled counter, a labelled gauge, a summary and a histogram."""
    et, k = F.col("event_type"), F.get_json_object("props", "$.k")
    body = lines(
        "# HELP app_events_total Events seen.",
        "# TYPE app_events_total counter",
        text("app_events_total ", F.col("event_id")),
        "",
        "# TYPE app_value gauge",
        text('app_value{type="', et, '",zone="a\\"b"} ', F.col("value"), " 1700000000000"),
        "# TYPE app_k gauge",
        text('app_k{zone="a\\"b",type="', et, '"} ', k),
        "# HELP lat Latency.",
        "# TYPE lat summary",
        text('lat{type="', et, '",quantile="0.5"} ', F.col("value")),
        text('lat{type="', et, '",quantile="0.99"} NaN'),
        text('lat_sum{type="', et, '"} ', F.col("value")),
        text('lat_count{type="', et, '"} ', F.col("user_id")),
        "# TYPE size histogram",
        text('size_bucket{type="', et, '",le="1"} ', k),
        text('size_bucket{type="', et, '",le="+Inf"} ', F.col("user_id")),
        text('size_sum{type="', et, '"} ', F.col("value")),
        text('size_count{type="', et, '"} ', F.col("user_id")),
        "# TYPE go_threads gauge",
        text("go_threads ", k),
        text("plain ", F.col("user_id")),
        "mongo_ops 3",
    )
    ev = table(spark, sf, "events").select("event_id", body.alias("body"))
    return P.parse_lines(ev, go_metrics=go_metrics, compat=compat)


def exposition_lines(spark, sf, **options):
    return exposition(spark, sf, **options).select("event_id", F.explode_outer("lines").alias("_line")).select("event_id", "_line.*")


_E = "SELECT event_id, event_type AS et, user_id AS u, value AS v, CAST(json_extract_string(props, '$.k') AS DOUBLE) AS k FROM events"


@query(f"""
    WITH e AS ({_E})
    SELECT event_id, 'app_events_total' AS family, 'COUNTER' AS type, 'Events seen.' AS help, CAST(NULL AS VARCHAR) AS part,
           CAST(event_id AS DOUBLE) AS value, CAST(0 AS INTEGER) AS labels FROM e
    UNION ALL SELECT event_id, 'app_value', 'GAUGE', '', NULL, v, 2 FROM e
    UNION ALL SELECT event_id, 'app_k', 'GAUGE', '', NULL, k, 2 FROM e
    UNION ALL SELECT event_id, 'lat', 'SUMMARY', 'Latency.', 'quantile', v, 2 FROM e
    UNION ALL SELECT event_id, 'lat', 'SUMMARY', 'Latency.', 'quantile', -1.0, 2 FROM e
    UNION ALL SELECT event_id, 'lat', 'SUMMARY', 'Latency.', 'sum', v, 1 FROM e
    UNION ALL SELECT event_id, 'lat', 'SUMMARY', 'Latency.', 'count', u, 1 FROM e
    UNION ALL SELECT event_id, 'size', 'HISTOGRAM', '', 'bucket', k, 2 FROM e
    UNION ALL SELECT event_id, 'size', 'HISTOGRAM', '', 'bucket', u, 2 FROM e
    UNION ALL SELECT event_id, 'size', 'HISTOGRAM', '', 'sum', v, 1 FROM e
    UNION ALL SELECT event_id, 'size', 'HISTOGRAM', '', 'count', u, 1 FROM e
    UNION ALL SELECT event_id, 'go_threads', 'GAUGE', '', NULL, k, 0 FROM e
    UNION ALL SELECT event_id, 'plain', 'UNTYPED', '', NULL, u, 0 FROM e
    UNION ALL SELECT event_id, 'mongo_ops', 'UNTYPED', '', NULL, 3, 0 FROM e
""")
def exposition_parse(spark, sf):
    return exposition_lines(spark, sf).select(
        "event_id",
        "family",
        "type",
        "help",
        "part",
        F.when(F.isnan("value"), -1.0).otherwise(F.col("value")).alias("value"),
        F.size("labels").alias("labels"),
    )


@query(f"""
    WITH e AS ({_E})
    SELECT event_id, 'lat' AS name, et AS label, CAST(NULL AS DOUBLE) AS value, CAST(u AS DOUBLE) AS count_, v AS sum_,
           v AS half, CAST(NULL AS DOUBLE) AS high, CAST(NULL AS DOUBLE) AS inf FROM e
    UNION ALL SELECT event_id, 'size', et, NULL, u, v, NULL, k, u FROM e
    UNION ALL SELECT event_id, 'app_events_total', NULL, event_id, NULL, NULL, NULL, NULL, NULL FROM e
    UNION ALL SELECT event_id, 'app_value', et, v, NULL, NULL, NULL, NULL, NULL FROM e
    UNION ALL SELECT event_id, 'app_k', et, k, NULL, NULL, NULL, NULL, NULL FROM e
    UNION ALL SELECT event_id, 'go_threads', NULL, k, NULL, NULL, NULL, NULL, NULL FROM e
    UNION ALL SELECT event_id, 'plain', NULL, u, NULL, NULL, NULL, NULL, NULL FROM e
    UNION ALL SELECT event_id, 'mongo_ops', NULL, 3, NULL, NULL, NULL, NULL, NULL FROM e
""")
def exposition_raw_samples(spark, sf):
    out = P.raw_samples(exposition(spark, sf), keep=["event_id"])
    return out.select(
        "event_id",
        attr("name").alias("name"),
        # the type of the family is under "type" unless a label of that name overrides it
        F.when(~attr("type").isin("UNTYPED", "COUNTER", "GAUGE"), attr("type")).alias("label"),
        attr("value", "double").alias("value"),
        attr("count", "double").alias("count_"),
        attr("sum", "double").alias("sum_"),
        attr("0.500000", "double").alias("half"),
        attr("1.000000", "double").alias("high"),
        attr("+Inf", "double").alias("inf"),
    )


@query(f"""
    WITH e AS ({_E})
    SELECT event_id, et AS type, 'a"b' AS zone, v AS app_value, k AS app_k, CAST(NULL AS DOUBLE) AS lat_count,
           CAST(NULL AS DOUBLE) AS lat_sum, CAST(NULL AS DOUBLE) AS size_count FROM e
    UNION ALL SELECT event_id, et, NULL, NULL, NULL, u, v, u FROM e
""")
def exposition_label_samples(spark, sf):
    out = P.label_samples(exposition(spark, sf), keep=["event_id"])
    return out.select(
        "event_id",
        attr("type").alias("type"),
        attr("zone").alias("zone"),
        attr("app_value.gauge", "double").alias("app_value"),
        attr("app_k.gauge", "double").alias("app_k"),
        attr("lat.summary.count", "double").alias("lat_count"),
        attr("lat.summary.sum", "double").alias("lat_sum"),
        attr("size.histogram.count", "double").alias("size_count"),
    )


@query(f"""
    WITH e AS ({_E})
    SELECT event_id, 'scrape' AS event_type, 'main' AS name, event_id AS total, k AS threads, u AS plain, 'eu' AS region FROM e
""")
def exposition_flattened_sample(spark, sf):
    out = P.flattened_sample(
        exposition(spark, sf), "scrape", keep=["event_id"], key_merge=["absent", "type"], custom_attributes={"region": "eu"}
    )
    return out.select(
        "event_id",
        "event_type",
        attr("name").alias("name"),
        attr("app_events_total.COUNTER", "double").cast("bigint").alias("total"),
        attr("go_threads.GAUGE", "double").alias("threads"),
        attr("plain.UNTYPED", "bigint").alias("plain"),
        attr("region").alias("region"),
    )


@query(f"""
    WITH e AS ({_E})
    SELECT event_id, 'appSummarySample' AS event_type, 'lat' AS name, u AS count_, v AS sum_, v AS half FROM e
    UNION ALL SELECT event_id, 'appHistogramSample', 'size', u, v, NULL FROM e
""")
def exposition_full_families(spark, sf):
    out = P.full_family_samples(exposition(spark, sf), "appSample", keep=["event_id"])
    return out.select(
        "event_id",
        "event_type",
        attr("name").alias("name"),
        attr("count", "bigint").alias("count_"),
        attr("sum", "double").alias("sum_"),
        attr("0.500000", "double").alias("half"),
    )


@query("""
    SELECT family, n * (SELECT count(*) FROM events) AS n FROM (VALUES ('app_events_total', 1), ('app_value', 1),
        ('app_k', 1), ('lat', 4), ('size', 4), ('plain', 1), ('mongo_ops', 1)) AS t(family, n)
""")
def exposition_without_go_metrics(spark, sf):
    return exposition_lines(spark, sf, go_metrics=False).groupBy("family").agg(F.count(F.lit(1)).alias("n"))


@query(f"""
    WITH e AS ({_E})
    SELECT event_id, 'app_events_total' AS metric, CAST(event_id AS DOUBLE) AS value, CAST(NULL AS VARCHAR) AS at,
           'counter' AS kind, CAST(NULL AS VARCHAR) AS type_label FROM e
    UNION ALL SELECT event_id, 'app_value', v, NULL, 'gauge', et FROM e
    UNION ALL SELECT event_id, 'app_k', k, NULL, 'gauge', et FROM e
    UNION ALL SELECT event_id, 'go_threads', k, NULL, 'gauge', NULL FROM e
    UNION ALL SELECT event_id, 'lat_quantile', v, '0.5', 'summary', et FROM e
    UNION ALL SELECT event_id, 'lat_sum', v, NULL, 'summary', et FROM e
    UNION ALL SELECT event_id, 'lat_count', u, NULL, 'summary', et FROM e
    UNION ALL SELECT event_id, 'size_bucket', k, '1', 'histogram', et FROM e
    UNION ALL SELECT event_id, 'size_bucket', u, '+Inf', 'histogram', et FROM e
    UNION ALL SELECT event_id, 'size_sum', v, NULL, 'histogram', et FROM e
    UNION ALL SELECT event_id, 'size_count', u, NULL, 'histogram', et FROM e
""")
def exposition_dimensional_rows(spark, sf):
    out = P.dimensional_rows(exposition_lines(spark, sf), keep=["event_id"])
    return out.select(
        "event_id",
        "metric",
        "value",
        F.coalesce(F.col("attributes")["quantile"], F.col("attributes")["le"]).alias("at"),
        F.col("common")["prometheusType"].alias("kind"),
        F.col("common")["type"].alias("type_label"),
    )


def bean_payloads(spark, sf):
    s = table(spark, sf, "supplier")
    key = lambda name, a: text("app:type=Pool,name=", F.col("s_suppkey"), f"-{name},attr={a}")
    body = F.to_json(
        F.create_map(
            key("a", "used"), F.col("s_acctbal").cast("string"),
            key("a", "owner"), F.col("s_name"),
            key("b", "used"), F.col("s_nationkey").cast("string"),
            text("app:type=Main,attr=up"), F.lit("yes"),
        )
    )
    log = lines("INFO starting", F.concat(body), "WARNING done")
    return B.parse_bean_text(s.select("s_suppkey", log.alias("body"))).withColumn("kv", attrs_of(host=F.lit("h")))


@query("""
    SELECT s_suppkey, 'type=Pool,name=' || s_suppkey || '-a' AS bean, 'app' AS domain, 'Pool' AS kind, s_acctbal AS used,
           s_name AS owner, CAST(NULL AS VARCHAR) AS up, 'h' AS host FROM supplier
    UNION ALL SELECT s_suppkey, 'type=Pool,name=' || s_suppkey || '-b', 'app', 'Pool', s_nationkey, NULL, NULL, 'h' FROM supplier
    UNION ALL SELECT s_suppkey, 'type=Main', 'app', 'Main', NULL, NULL, 'yes', 'h' FROM supplier
""")
def bean_grouping(spark, sf):
    out = B.bean_samples(bean_payloads(spark, sf), earlier="kv")
    return out.select(
        "s_suppkey",
        attr("bean").alias("bean"),
        attr("domain").alias("domain"),
        attr("app:type").alias("kind"),
        attr("used", "double").alias("used"),
        attr("owner").alias("owner"),
        attr("up").alias("up"),
        attr("host").alias("host"),
    )


@query("""
    SELECT s_suppkey, s_suppkey || '-a' AS name, s_acctbal AS used, 'CouldNotGetDomain' AS domain FROM supplier
    UNION ALL SELECT s_suppkey, s_suppkey || '-b', s_nationkey, 'CouldNotGetDomain' FROM supplier
    UNION ALL SELECT s_suppkey, NULL, NULL, 'CouldNotGetDomain' FROM supplier
""")
def bean_grouping_by_property(spark, sf):
    out = B.bean_samples(bean_payloads(spark, sf).drop("kv"), group_by="name")
    return out.select(
        "s_suppkey", attr("name").alias("name"), attr("used", "double").alias("used"), attr("domain").alias("domain")
    )


@query("""
    SELECT s_suppkey, 4 AS n, s_acctbal AS used_a, s_nationkey AS used_b, 'yes' AS up FROM supplier
""")
def bean_compression(spark, sf):
    out = B.compressed_bean_samples(bean_payloads(spark, sf).drop("kv"))
    name = F.concat(F.lit("Pool."), F.col("s_suppkey").cast("string"))
    value = lambda suffix: F.col("attrs")[F.concat(name, F.lit(suffix))]
    return out.select(
        "s_suppkey",
        F.size("attrs").alias("n"),
        value("-a.used").try_cast("double").alias("used_a"),
        value("-b.used").try_cast("int").alias("used_b"),
        attr("Main.up").alias("up"),
    )


@query("""
    SELECT conv_id, turn, 0 AS element_ix, 200 + turn % 3 AS status, role AS role, CAST(NULL AS VARCHAR) AS output,
           'srv' AS server FROM conversations
    UNION ALL SELECT conv_id, turn, 1, 200 + turn % 3, NULL, text, 'srv' FROM conversations
    UNION ALL SELECT conv_id, turn, 0, 7, role, NULL, NULL FROM conversations
""")
def response_envelopes(spark, sf):
    conv = table(spark, sf, "conversations").withColumn("headers", attrs_of(Server=F.lit("srv")))
    obj = F.to_json(F.struct("role"))
    listed = F.concat(F.lit("["), obj, F.lit(","), F.to_json(F.array("text")).substr(F.lit(2), F.length(F.to_json(F.array("text"))) - 2), F.lit(",3]"))
    arrays = conv.select("conv_id", "turn", (200 + F.col("turn") % 3).alias("status"), "headers", listed.alias("body"))
    objects = conv.select(
        "conv_id", "turn", F.lit(200).alias("status"), F.to_json(F.struct("role", F.lit(7).alias("api.StatusCode"))).alias("body")
    )
    a = W.response_payloads(arrays, headers="headers")
    b = W.response_payloads(objects)
    out = shape.flatten_attrs(a.unionByName(b))
    return out.select(
        "conv_id",
        "turn",
        "element_ix",
        attr("api.StatusCode", "bigint").alias("status"),
        attr("role").alias("role"),
        attr("output").alias("output"),
        attr("api.header.Server").alias("server"),
    )


_PAGES = """
    WITH p AS (SELECT *, CASE WHEN length(text) % 50 = 1 THEN 500 ELSE 200 END AS status, length(text) % 5 = 0 AS is_empty
               FROM conversations),
    s AS (SELECT conv_id, min(CASE WHEN status >= 300 THEN turn END) AS bad, min(turn) AS first,
                 min(CASE WHEN is_empty THEN turn END) AS empty FROM p GROUP BY conv_id)
"""


def captured_pages(spark, sf):
    n = F.length("text")
    items = F.when(n % 5 == 0, F.array().cast("array<string>")).otherwise(F.array("role"))
    body = doc(items=items, meta=F.struct(F.lit(3).alias("pages")), text="text")
    status = F.when(n % 50 == 1, 500).otherwise(200)
    return table(spark, sf, "conversations").select("conv_id", "turn", status.alias("status"), body.alias("body"))


@query(_PAGES + """
    SELECT p.conv_id, p.turn FROM p JOIN s USING (conv_id)
    WHERE (bad IS NULL OR turn < bad) AND (empty IS NULL OR turn <= empty)
""")
def page_sequence_until_empty(spark, sf):
    out = W.select_pages(captured_pages(spark, sf), "conv_id", "turn", payload_key="items")
    return out.select("conv_id", "turn")


@query(_PAGES + """
    SELECT p.conv_id, p.turn, 3 AS pages FROM p JOIN s USING (conv_id)
    WHERE (bad IS NULL OR turn < bad) AND turn <= first + 2
""")
def page_sequence_up_to_max(spark, sf):
    out = W.select_pages(captured_pages(spark, sf), "conv_id", "turn", max_pages_key="pages")
    return out.select("conv_id", "turn", W.page_number_key(F.col("body"), "pages").cast("int").alias("pages"))


# A page for each event; a user's pages follow each other by the digest of their ids. Errors were not captured.
_CHAIN = """
    WITH e AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY md5(CAST(event_id AS VARCHAR))) AS n FROM events),
    s AS (SELECT user_id, min(CASE WHEN event_type = 'error' AND n > 3 THEN n END) AS lost FROM e GROUP BY user_id)
"""


def linked_pages(spark, sf):
    e = table(spark, sf, "events")
    w = Window.partitionBy("user_id").orderBy(F.md5(F.col("event_id").cast("string")))
    url = lambda i: text("/u/", F.col("user_id"), "/", i)
    e = e.withColumns({"n": F.row_number().over(w), "after": F.lead("event_id").over(w), "start": F.first("event_id").over(w)})
    # the last page leads back to the first
    following = F.coalesce(F.col("after"), F.col("start"))
    e = e.select("user_id", "event_id", "event_type", "n", "after", url(F.col("event_id")).alias("url"), url(following).alias("next"), F.lit(200).alias("status"))
    return e.where("event_type != 'error' OR n <= 3")


@query(_CHAIN + """
    SELECT user_id, event_id, n AS page_no FROM e JOIN s USING (user_id) WHERE lost IS NULL OR n < lost
""")
def page_chain_by_next_link(spark, sf):
    """Links in the bodies, pages in no order, loops, lost pages and pages behind them."""
    p = linked_pages(spark, sf)
    path = F.substring("next", F.lit(2), F.length("next"))
    p = p.select("user_id", "event_id", "n", "url", "status", doc(items=F.array("event_type"), links=F.struct(path.alias("next"))).alias("body"))
    out = chain_pages(p, next_page(F.col("body"), link_key="next", host="/"), F.col("n") == 1, request="user_id")
    return out.select("user_id", "event_id", "page_no")


@query(_CHAIN + """
    , c AS (SELECT user_id, min(CASE WHEN event_id % 7 = 0 THEN n END) AS bad, min(CASE WHEN event_id % 11 = 0 THEN n END) AS empty FROM e GROUP BY user_id)
    SELECT user_id, event_id, n AS page_no FROM e JOIN s USING (user_id) JOIN c USING (user_id)
    WHERE (lost IS NULL OR n < lost) AND (bad IS NULL OR n < bad) AND (empty IS NULL OR n <= empty) AND n <= 9
""")
def page_chain_by_cursor(spark, sf):
    """Cursors put into a template with the body's limit; failed and empty pages end a chain, and so does the ninth."""
    p = linked_pages(spark, sf)
    bad, empty = F.col("event_id") % 7 == 0, F.col("event_id") % 11 == 0
    items = F.when(empty, F.array().cast("array<string>")).otherwise(F.array("event_type"))
    cursor = F.regexp_extract("next", r"(\d+)$", 1)
    body = doc(items=items, cursor=cursor, size=F.lit(25), total=F.lit(9))
    url = lambda c: F.concat(c, F.lit("?n=25"))
    p = p.select("user_id", "event_id", "n", url(F.col("url")).alias("url"), F.when(bad, 503).otherwise(200).alias("status"), body.alias("body"))
    following = F.replace(next_page(F.col("body"), cursor_key="cursor", template="/u/{}/${page}?n=${limit}", limit_key="size"), F.lit("{}"), F.col("user_id").cast("string"))
    out = chain_pages(p, following, F.col("n") == 1, request="user_id", payload_key="items", max_pages_key="total")
    return out.select("user_id", "event_id", "page_no")


@query("""
    SELECT event_id, row_number() OVER (ORDER BY md5(CAST(event_id AS VARCHAR))) AS page_no FROM events
""")
def page_chain_by_link_header(spark, sf):
    """One request with all pages, in one chain by the links of their headers."""
    e = table(spark, sf, "events").select("event_id", F.md5(F.col("event_id").cast("string")).alias("place"))
    e = number_rows(e, ["place"], "n")
    after = text('<https://h/', F.col("n") + 1, '>; rel="next", <https://h/1>; rel="first"')
    p = e.select("event_id", F.lit("all").alias("request_id"), text("https://h/", F.col("n")).alias("url"), F.lit(200).alias("status"), doc(id="event_id").alias("body"), after.alias("link"))
    out = chain_pages(p, next_page(F.col("body"), link_header=F.col("link")), F.col("url") == "https://h/1")
    return out.select("event_id", "page_no")


@query("""
    SELECT o_orderkey, CAST(0 AS INTEGER) AS table_ix, CAST(i - 1 AS INTEGER) AS row_ix, CAST(i AS BIGINT) AS no_,
           trim(regexp_replace(o_orderpriority, '[-]', ' ', 'g')) AS priority,
           CASE WHEN i = 1 THEN 'a b' ELSE '' END AS extra, 'list' AS class, 0 AS index_
    FROM orders, UNNEST(generate_series(1, o_orderkey % 3 + 1)) AS u(i)
    UNION ALL
    SELECT o_orderkey, 1, 0, NULL, NULL, NULL, NULL, 1 FROM orders
""")
def html_tables(spark, sf):
    rows = F.expr(
        "transform(sequence(1, o_orderkey % 3 + 1), i -> concat('<tr><td>', i, '</td><td><b>', o_orderpriority, "
        "'</b></td>', if(i = 1, '<td>a&amp;b</td>', ''), '</tr>'))"
    )
    html = F.concat(
        F.lit('<html><body><table class="list"><tr><th>No.</th><th> Priority </th><th></th></tr>'),
        F.array_join(rows, "\n"),
        F.lit("</table><p>x</p><table><tr><td>only</td></tr></table></body></html>"),
    )
    out = W.html_table_samples(spread_table(spark, sf, "orders").select("o_orderkey", html.alias("html")), "o_orderkey")
    return out.select(
        "o_orderkey",
        "table_ix",
        "row_ix",
        attr("No", "bigint").alias("no_"),
        attr("Priority").alias("priority"),
        attr("Col 2").alias("extra"),
        attr("class").alias("class"),
        attr("Index", "int").alias("index_"),
    )


@query("""
    SELECT page_id, CAST(t AS INTEGER) AS table_ix, CAST(r AS INTEGER) AS row_ix, 'p' || page_id AS page, page_id * 10 + r AS mark
    FROM pages, UNNEST(generate_series(0, CAST(page_id % 2 AS INTEGER))) AS a(t), UNNEST(generate_series(0, 1)) AS b(r)
""")
def html_tables_of_pages(spark, sf):
    """Whole pages, one or two tables put into each before its end."""
    row = lambda r: F.concat(F.lit("<tr><td>p"), F.col("page_id"), F.lit("</td><td><b>"), F.col("page_id") * 10 + r, F.lit("</b></td></tr>"))
    one = F.concat(F.lit("<table><tr><th>Page</th><th>Mark</th></tr>"), row(0), row(1), F.lit("</table>"))
    tables = F.repeat(one, (F.col("page_id") % 2 + 1).cast("int"))
    pages = spread_table(spark, sf, "pages").select("page_id", F.replace("html", F.lit("</article>"), F.concat(tables, F.lit("</article>"))).alias("html"))
    out = W.html_table_samples(pages)
    return out.select("page_id", "table_ix", "row_ix", attr("Page").alias("page"), attr("Mark", "bigint").alias("mark"))


@query("SELECT doc_id, CAST(length(text) AS BIGINT) AS n, md5(text) AS digest FROM documents")
def exposition_long_labels(spark, sf):
    """Whole documents as label values: escapes undone, however long."""
    escaped = F.replace(F.replace(F.replace("text", F.lit("\\"), F.lit("\\\\")), F.lit('"'), F.lit('\\"')), F.lit("\n"), F.lit("\\n"))
    body = F.concat(F.lit('doc{a="1",text="'), escaped, F.lit('"} '), F.col("doc_id"))
    rows = P.parse_exposition(table(spark, sf, "documents").select("doc_id", body.alias("body")))
    text = F.col("labels")["text"]
    return rows.select("doc_id", F.length(text).cast("bigint").alias("n"), F.md5(F.encode(text, "UTF-8")).alias("digest"))


@query("""
    WITH e AS (SELECT event_id, event_type AS et, value AS v FROM events)
    SELECT event_id, 'my.metric' AS name, 'GAUGE' AS type, 'a b' AS label, et AS label_value, v AS value, CAST(NULL AS VARCHAR) AS error FROM e
    UNION ALL SELECT event_id, 'plain', 'UNTYPED', 'a.b', et || '"}', v, NULL FROM e
    UNION ALL SELECT event_id, 'my "own", x="y"', 'UNTYPED', NULL, NULL, event_id, NULL FROM e
    UNION ALL SELECT event_id, NULL, NULL, NULL, NULL, NULL, 'no sample: open{a="' || et || '} 1' FROM e
    UNION ALL SELECT event_id, NULL, NULL, NULL, NULL, NULL, 'no sample: {"two","names"} ' || event_id FROM e
    UNION ALL SELECT event_id, 'word', 'UNTYPED', NULL, NULL, NULL, 'no number: none' FROM e
""")
def exposition_quoted_and_bad(spark, sf):
    """Quoted names of metrics and labels, and lines that are no samples, of every event."""
    et, v = F.col("event_type"), F.col("value")
    body = lines(
        '# TYPE "my.metric" gauge',
        text('{"my.metric","a b"="', et, '"} ', v),
        text('plain{ "a.b" = "', et, '\\"}", } ', v, " 1700000000000"),
        text('{"my \\"own\\", x=\\"y\\""} ', F.col("event_id")),
        text('open{a="', et, "} 1"),
        text('{"two","names"} ', F.col("event_id")),
        "word None",
    )
    rows = P.parse_exposition(table(spark, sf, "events").select("event_id", body.alias("body")), go_metrics=False)
    return rows.select(
        "event_id", "name", "type", F.try_element_at(F.map_keys("labels"), F.lit(1)).alias("label"),
        F.try_element_at(F.map_values("labels"), F.lit(1)).alias("label_value"), "value", "error",
    )
