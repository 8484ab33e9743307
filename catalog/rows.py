"""Filters, limits and ranges."""

from pyspark.sql import functions as F

from catalog.registry import attr, attrs_of, query, table
from samplecraft.operators import filters as E
from samplecraft.sources import text as T


def event_rows(spark, sf):
    k = F.get_json_object("props", "$.k")
    return table(spark, sf, "events").select("event_id", attrs_of(kind="event_type", user="user_id", k=k).alias("attrs"))


_K = "json_extract_string(props, '$.k')"


@query(f"""
    SELECT event_id FROM events WHERE NOT (regexp_matches({_K}, '^8') OR event_type = 'error' OR regexp_matches({_K}, '5$'))
""")
def sample_exclude_filter(spark, sf):
    rules = [{"^k$": "^8", "^ki": "^error$"}, {"k$": "5$"}, {"": "x", "kind": ""}]
    return E.filter_samples(event_rows(spark, sf), exclude=rules).select("event_id")


@query(f"""
    SELECT event_id FROM events WHERE (regexp_matches({_K}, '^1') OR event_type = 'click') AND NOT regexp_matches(CAST(user_id AS VARCHAR), '3')
""")
def sample_include_filter(spark, sf):
    out = E.filter_samples(event_rows(spark, sf), include=[{"^k$": "^1"}, {"kind": "click"}], exclude=[{"user": "3"}])
    return out.select("event_id")


@query(f"SELECT event_id FROM events WHERE regexp_matches({_K}, '[2468]$') AND event_type IN ('click', 'view')")
def sample_include_match_all_filter(spark, sf):
    out = E.filter_samples(event_rows(spark, sf), match_all=[{"^k$": "[2468]$", "kind": "^(click|view)$"}], include=[{"kind": "never"}])
    return out.select("event_id")


@query(f"SELECT event_id FROM events WHERE regexp_matches({_K}, '^[1-9]$') AND user_id < 10")
def filter_on_fixed_decimals(spark, sf):
    out = E.filter_samples(event_rows(spark, sf), match_all=[{"^k$": r"^[1-9]\.000000$", "^user$": r"^\d\.0+$"}], fixed6=True)
    return out.select("event_id")


@query("SELECT p_partkey, p_size FROM part WHERE p_type IN ('SMALL', 'ECONOMY') AND NOT regexp_matches(p_brand, '#1')")
def wide_plane_filter(spark, sf):
    p = table(spark, sf, "part").select("p_partkey", "p_brand", "p_type", "p_size")
    out = E.filter_columns(p, exclude=[{"brand": "#1"}], include=[{"^p_type$": "^(SMALL|ECONOMY)$"}])
    return out.select("p_partkey", "p_size")


@query("""
    SELECT event_type = 'click' AS held, count(*) AS n FROM events GROUP BY 1
""")
def held_back_samples(spark, sf):
    out = E.hold_back(event_rows(spark, sf), attr("kind") == "click")
    return out.groupBy((~F.col("emit")).alias("held")).agg(F.count(F.lit(1)).alias("n"))


@query("SELECT least(100, count(*)) AS n, least(100, count(*)) AS different, least(100, count(*)) AS known FROM events")
def event_limit(spark, sf):
    """A hundred rows, each a different one of the table's."""
    limited = E.limit_events(table(spark, sf, "events").select("event_id", "value"), 100)
    events = table(spark, sf, "events").select("event_id", F.col("value").alias("own"))
    known = F.count(F.when(F.col("value").eqNullSafe(F.col("own")), 1))
    return limited.join(events, "event_id").agg(F.count(F.lit(1)).alias("n"), F.countDistinct("event_id").alias("different"), known.alias("known"))


@query("""
    WITH l AS (SELECT doc_id, string_split(regexp_replace(text, '\\n$', ''), chr(10)) AS ls FROM documents)
    SELECT doc_id, CAST(i - 1 AS INTEGER) AS line_no, ls[i] AS line FROM l, UNNEST(generate_series(2, least(4, len(ls)))) AS u(i)
""")
def line_ranges(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", F.col("text").alias("body"))
    out = T.column_samples(docs, "\\z", set_header=["line"], line_start=1, line_end=4)
    return out.filter("sample_ix >= 1").select("doc_id", F.col("sample_ix").alias("line_no"), attr("line").alias("line"))


@query("SELECT event_id FROM events WHERE NOT (starts_with(event_type, 'pur') OR event_type = 'view')")
def event_filter_modes(spark, sf):
    out = E.drop_events(
        event_rows(spark, sf),
        [{"key": "kin", "value": "pur", "mode": "prefix"}, {"key": "^kind$", "value": "^view$"}],
    )
    return out.select("event_id")
