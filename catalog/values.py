"""Value functions."""

from pyspark.sql import functions as F

from catalog.registry import attr, attrs_of, query, table, text
from samplecraft.functions import scalars as S
from samplecraft.operators import values as V


@query("SELECT l_orderkey, l_linenumber, l_partkey, CAST(round(l_discount * 100) AS BIGINT) AS pct, l_returnflag AS flag FROM lineitem")
def percent_to_decimal(spark, sf):
    li = table(spark, sf, "lineitem")
    pct = text(F.round(F.col("l_discount") * 100).cast("bigint"), "%%")
    out = V.strip_percent(li.select("l_orderkey", "l_linenumber", "l_partkey", attrs_of(pct=pct, flag="l_returnflag").alias("attrs")))
    return out.select("l_orderkey", "l_linenumber", "l_partkey", attr("pct", "bigint").alias("pct"), attr("flag").alias("flag"))


@query("""
    SELECT event_id, value / 1000 AS ms, CAST(NULL AS VARCHAR) AS old, event_type AS kind, CAST(0 AS DOUBLE) AS none_ FROM events
""")
def microseconds_to_milliseconds(spark, sf):
    ev = table(spark, sf, "events").select(
        "event_id", attrs_of(took=text(F.col("value"), "µs"), none=F.lit("xµs"), kind="event_type").alias("attrs")
    )
    out = V.micros_to_millis(ev)
    return out.select(
        "event_id",
        attr("took.ms", "double").alias("ms"),
        attr("took").alias("old"),
        attr("kind").alias("kind"),
        attr("none.ms", "double").alias("none_"),
    )


@query("SELECT p_partkey, lower(p_type) AS kind, upper(p_name) AS name, p_brand AS brand FROM part")
def value_case(spark, sf):
    p = table(spark, sf, "part").select("p_partkey", attrs_of(kind="p_type", name="p_name", brand="p_brand").alias("attrs"))
    out = V.upper_values(V.lower_values(p, ["kind"]), ["name"])
    return out.select("p_partkey", *[attr(k).alias(k) for k in ("kind", "name", "brand")])


@query("""
    SELECT p_partkey, regexp_extract(p_brand, '[0-9]+') AS brand, CASE WHEN regexp_matches(p_name, 'b\\w+') THEN
        regexp_extract(p_name, 'b\\w+') ELSE p_name END AS name, p_type AS kind FROM part
""")
def value_parser(spark, sf):
    p = table(spark, sf, "part").select("p_partkey", attrs_of(p_brand="p_brand", p_name="p_name", kind="p_type").alias("attrs"))
    out = V.parse_values(p, {"brand$": "[0-9]+", "^p_name": r"b\w+"})
    return out.select("p_partkey", attr("p_brand").alias("brand"), attr("p_name").alias("name"), attr("kind").alias("kind"))


@query("""
    SELECT o_orderkey, o_totalprice AS price, CAST(substr(o_orderpriority, 1, 1) AS INTEGER) AS priority, 'none' AS other FROM orders
""")
def pluck_numbers(spark, sf):
    o = table(spark, sf, "orders").select(
        "o_orderkey",
        attrs_of(price=text("about ", F.col("o_totalprice"), " (", F.col("o_orderkey"), ")"), priority="o_orderpriority", other=F.lit("none")).alias("attrs"),
    )
    out = V.pluck_numbers(o)
    return out.select("o_orderkey", attr("price", "double").alias("price"), attr("priority", "int").alias("priority"), attr("other").alias("other"))


@query("""
    SELECT l_orderkey, l_linenumber, l_partkey, CAST(l_quantity AS DOUBLE) AS qty, l_returnflag AS flag, CAST(NULL AS VARCHAR) AS bad,
           'qty=' || CAST(l_quantity AS INTEGER) || ',flag=' || l_returnflag || ',a=b=c,lone' AS kept FROM lineitem
""")
def sub_parse(spark, sf):
    li = table(spark, sf, "lineitem")
    packed = text("qty=", F.col("l_quantity").cast("int"), ",flag=", F.col("l_returnflag"), ",a=b=c,lone")
    out = V.sub_parse(
        li.select("l_orderkey", "l_linenumber", "l_partkey", attrs_of(db0=packed, other=packed).alias("attrs")),
        [{"type": "prefix", "key": "db", "split_by": [",", "="]}],
    )
    return out.select(
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        attr("db0.qty", "double").alias("qty"),
        attr("db0.flag").alias("flag"),
        F.coalesce(attr("db0.a"), attr("db0.lone"), attr("other.qty")).alias("bad"),
        attr("db0").alias("kept"),
    )


@query("SELECT c_custkey, 'hello-' || c_name || '/' || c_name AS name, c_mktsegment AS segment FROM customer")
def value_transformer(spark, sf):
    c = table(spark, sf, "customer").select("c_custkey", attrs_of(name="c_name", segment="c_mktsegment").alias("attrs"))
    out = V.transform_values(c, {"^na": "hello-${value}/${value}"})
    return out.select("c_custkey", attr("name").alias("name"), attr("segment").alias("segment"))


@query("""
    SELECT o_orderkey, CASE WHEN regexp_matches(o_orderpriority, '^[12]-') THEN 'top ' || regexp_extract(o_orderpriority, '-(.+)$', 1)
                            ELSE regexp_extract(o_orderpriority, '^(\\d)', 1) || ':' || regexp_extract(o_orderpriority, '-(.+)$', 1) END AS level,
           o_orderpriority AS priority, o_orderstatus AS status FROM orders
""")
def value_mapper(spark, sf):
    o = table(spark, sf, "orders").select("o_orderkey", attrs_of(priority="o_orderpriority", status="o_orderstatus").alias("attrs"))
    out = V.map_values(
        o,
        {"priority=>level": [r"^.*=>no groups", r"^[12]-(.+)$=>top $1", r"^(\d)-(.+)$=>$1:$2"], "status": [r"^(Z)$=>never"]},
    )
    return out.select("o_orderkey", *[attr(k).alias(k) for k in ("level", "priority", "status")])


@query("""
    SELECT event_id, CAST(epoch(date_trunc('second', ts)) AS BIGINT) AS iso, strftime(ts, '%Y-%m-%d') AS day,
           CAST(epoch(date_trunc('second', ts)) AS BIGINT) AS http, strftime(ts, '%a %b ') || lpad(CAST(day(ts) AS VARCHAR), 2, ' ')
           || strftime(ts, ' %H:%M:%S %Y') AS ansi, event_type AS bad
    FROM events
""")
def timestamp_conversion(spark, sf):
    ts = F.col("ts").cast("timestamp")
    seconds = F.unix_seconds(ts).cast("string")
    ev = table(spark, sf, "events").select(
        "event_id",
        attrs_of(
            iso=F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"),
            http=F.date_format(ts, "EEE, dd MMM yyyy HH:mm:ss XX"),
            day=seconds,
            ansi=seconds,
            bad="event_type",
        ).alias("attrs"),
    )
    out = V.convert_times(
        ev,
        {
            "^iso$": "TIMESTAMP::RFC3339",
            "^http": "TIMESTAMP::RFC1123",
            "^day": "DATE::2006-01-02",
            "^ansi": "DATE::ANSIC",
            "^bad": "TIMESTAMP::RFC3339",
        },
    )
    return out.select(
        "event_id",
        attr("iso", "bigint").alias("iso"),
        attr("http", "bigint").alias("http"),
        attr("day").alias("day"),
        attr("ansi").alias("ansi"),
        attr("bad").alias("bad"),
    )


@query("""
    SELECT event_id, epoch_us(ts) // 1000 - 5000 AS ms, CAST(floor(epoch(ts)) AS BIGINT) + 3600 AS s,
           strftime(ts - INTERVAL 2 DAY, '%Y-%m-%d') AS day, strftime(ts + INTERVAL 90 MINUTE, '%Y-%m-%dT%H:%M:%SZ') AS stamp,
           hour(ts - INTERVAL 1 MINUTE) AS hour_, month(ts) AS month_ FROM events
""")
def relative_times(spark, sf):
    ts = F.col("ts")
    return table(spark, sf, "events").select(
        "event_id",
        S.relative_time("ms", -5, "sec", ts).cast("bigint").alias("ms"),
        S.relative_time("s", 1, "h", ts).cast("bigint").alias("s"),
        S.relative_time("date", -48, "hr", ts).alias("day"),
        S.relative_time("datetimeutctz", 90, "min", ts).alias("stamp"),
        S.relative_time("utchour", -60, "s", ts).cast("bigint").alias("hour_"),
        S.relative_time("utcmonth", base=ts).cast("bigint").alias("month_"),
    )


@query("""
    SELECT l_orderkey, l_linenumber, l_partkey, round(l_extendedprice * (1 - l_discount) + 200, 4) AS net,
           CASE WHEN l_discount = 0 THEN NULL ELSE round(l_extendedprice / l_discount, 2) END AS ratio,
           CASE WHEN l_quantity >= 25 AND NOT (l_tax > 0.05) THEN 'true' ELSE 'false' END AS big, pow(l_quantity, 2) % 7 AS rest,
           CAST(NULL AS DOUBLE) AS missing, CAST(l_quantity AS INTEGER) * 4 AS twice FROM lineitem
""")
def formulas(spark, sf):
    li = table(spark, sf, "lineitem")
    rows = li.select(
        "l_orderkey", "l_linenumber", "l_partkey",
        attrs_of(price="l_extendedprice", disc="l_discount", qty="l_quantity", tax="l_tax", flag="l_returnflag").alias("attrs"),
    )
    out = V.compute(
        rows,
        {
            "net": "${price} * (1 - ${disc}) + 200",
            "ratio": "${price} / ${disc}",
            "big": "${qty} >= 25 && !(${tax} > 0.05)",
            "rest": "${qty} ** 2 % 7",
            "missing": "${flag} + ${none}",
            "once": "${qty} + ${qty}",
            "twice": "${once} * 2",
        },
    )
    return out.select(
        "l_orderkey", "l_linenumber", "l_partkey",
        F.round(attr("net", "double"), 4).alias("net"),
        F.round(attr("ratio", "double"), 2).alias("ratio"),
        attr("big").alias("big"),
        attr("rest", "double").alias("rest"),
        attr("missing", "double").alias("missing"),
        attr("twice", "int").alias("twice"),
    )


@query("""
    SELECT l_orderkey, l_linenumber, l_partkey, round(l_extendedprice * (1 - l_discount), 4) AS net, l_quantity * 2 AS dbl FROM lineitem
""")
def formulas_on_columns(spark, sf):
    li = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice", "l_discount", "l_quantity")
    out = V.compute_columns(li, {"net": "${l_extendedprice} * (1 - ${l_discount})", "dbl": "${l_quantity} * 2"})
    return out.select("l_orderkey", "l_linenumber", "l_partkey", F.round("net", 4).alias("net"), "dbl")


@query("""
    SELECT o_orderkey, printf('%.6f', o_totalprice) AS fixed, printf('%.6f', o_totalprice * 1000) AS big,
           CAST(round_even(o_totalprice, 0) AS BIGINT) AS whole, o_orderstatus AS status FROM orders
""")
def number_rendering(spark, sf):
    o = table(spark, sf, "orders").select(
        "o_orderkey", "o_totalprice", attrs_of(fixed="o_totalprice", big=F.col("o_totalprice") * 1000, status="o_orderstatus").alias("attrs")
    )
    out = V.render_numbers(o, "fixed6")
    return out.select("o_orderkey", attr("fixed").alias("fixed"), attr("big").alias("big"), S.integral(F.col("o_totalprice")).cast("bigint").alias("whole"), attr("status").alias("status"))


@query("""
    WITH x AS (SELECT o_orderkey, o_totalprice * k AS x, k FROM orders, (VALUES (1.0::DOUBLE), (1e-9::DOUBLE), (1e-7::DOUBLE), (16.0::DOUBLE)) AS t(k))
    SELECT o_orderkey, k, x AS back, CASE WHEN x < 1e-4 OR x >= 1e6 THEN true ELSE false END AS scientific FROM x
""")
def shortest_numbers(spark, sf):
    o = table(spark, sf, "orders").select("o_orderkey", "o_totalprice", F.explode(F.array(*[F.lit(k) for k in (1.0, 1e-9, 1e-7, 16.0)])).alias("k"))
    shown = S.shortest(F.col("o_totalprice") * F.col("k"))
    return o.select("o_orderkey", "k", shown.cast("double").alias("back"), shown.contains("e").alias("scientific"))


@query("""
    WITH t AS (SELECT doc_id, UNNEST(string_split(text, ' ')) AS w FROM documents)
    SELECT doc_id, count(*) AS words, count(CASE WHEN regexp_full_match(w, '[+-]?([0-9]+\\.?[0-9]*|\\.[0-9]+)([eE][+-]?[0-9]+)?') THEN 1 END) AS numbers
    FROM t GROUP BY doc_id
""")
def numeric_detection(spark, sf):
    words = table(spark, sf, "documents").select("doc_id", F.explode(F.split("text", " ", -1)).alias("w"))
    return words.groupBy("doc_id").agg(
        F.count(F.lit(1)).alias("words"), F.count(S.as_number(F.col("w"))).alias("numbers")
    )


@query("""
    SELECT p_partkey, starts_with(p_name, 'red') AS a, ends_with(p_name, 'bolt') AS b, contains(p_name, 'a') AS c,
           regexp_matches(p_name, '^\\w+ [b-w]') AS d, false AS e FROM part
""")
def match_modes(spark, sf):
    n = F.col("p_name")
    return table(spark, sf, "part").select(
        "p_partkey",
        S.matches(n, "red", "prefix").alias("a"),
        S.matches(n, "bolt", "suffix").alias("b"),
        S.matches(n, "a", "contains").alias("c"),
        S.matches(n, r"^\w+ [b-w]", "regex").alias("d"),
        S.matches(n, "red", "exact").alias("e"),
    )
