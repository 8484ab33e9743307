"""Quoted names, and lines that are no samples."""

from samplecraft.sources import prometheus

BODY = """# TYPE "my.count" counter
{"my.count","a"="x",b="{\\"y\\"}"} 1
m{"l.1"="v"} 2
{a="x"} 3
m{a=x} 4
no value
m 5
m{a="1"} 6 7 8
"""


def test_lines(spark):
    df = spark.createDataFrame([(1, BODY)], "payload_id int, body string")
    got = prometheus.parse_exposition(df).collect()
    named = [(r["line_no"], r["name"], r["type"], r["labels"], r["value"]) for r in got if r["error"] is None]
    assert named == [
        (1, "my.count", "COUNTER", {"a": "x", "b": '{"y"}'}, 1.0), (2, "m", "UNTYPED", {"l.1": "v"}, 2.0), (6, "m", "UNTYPED", {}, 5.0)
    ]
    bad = {r["line_no"]: r["error"] for r in got if r["error"]}
    assert bad == {3: 'no sample: {a="x"} 3', 4: "no sample: m{a=x} 4", 5: "no number: value", 7: 'no sample: m{a="1"} 6 7 8'}
    lines = prometheus.parse_lines(df)
    assert {r["attrs"]["name"] for r in prometheus.raw_samples(lines).collect()} == {"my.count", "m", "no"}
    assert prometheus.label_samples(lines).count() == 2
    assert prometheus.flattened_sample(lines, "e").count() == 1


def test_flattened_sample_parses_a_payload_once(spark):
    """No step of the parser stands in a filter below, where each would hold copies of those before it."""
    body = "# TYPE up gauge\nup 1\nplain NaN\nwide +Inf\nword None"
    df = spark.createDataFrame([(1, body), (2, "# HELP up x"), (3, 'up{a="b"} 1')], "id int, body string")
    out = prometheus.flattened_sample(prometheus.parse_lines(df), "scrape", keep=["id"])
    filters = [step for step in out._jdf.queryExecution().optimizedPlan().toString().split("\n") if "Filter" in step]
    assert len(filters) == 1 and "isnotnull(attrs" in filters[0]
    rows = {r["id"]: r["attrs"] for r in out.collect()}
    assert rows == {1: {"name": "main", "up": "1", "plain": "NaN", "wide": "+Inf", "word": None}}
