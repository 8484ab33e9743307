import json

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from samplecraft.operators import shape
from samplecraft.sources import beans, payloads, prometheus, text, web


def body(spark, *texts):
    return spark.createDataFrame(list(enumerate(texts)), "payload_id int, body string")


def attrs(df):
    return [dict(r["attrs"]) for r in df.collect()]


def test_key_value_and_columns(spark):
    kv = text.key_value_samples(body(spark, "# garden\nsoil:loam ph:6\r\nbed1:rows=4\nnothing\nbed2:\n"), ":")
    assert attrs(kv) == [{"soil": "loam ph:6", "bed1": "rows=4", "bed2": ""}]
    df = body(spark, "Plant  Height Shade Planted in\nfern/3  40 15%  /\nmoss  2\n")
    assert attrs(text.column_samples(df, r"\s{1,}")) == [
        {"Plant": "fern/3", "Height": "40", "Shade": "15%", "Planted": "/"},
        {"Plant": "moss", "Height": "2"},
    ]
    single = text.column_samples(body(spark, "a b"), " ")
    assert attrs(single) == [{"a": "a", "b": "b"}]
    later = text.column_samples(body(spark, "junk\n===\nA  B\n1  2\n3  4\n5  6"), r"\s{2,}", row_header=2, row_start=3, line_end=5)
    assert attrs(later) == [{"A": "1", "B": "2"}, {"A": "3", "B": "4"}]


@pytest.mark.parametrize(
    "body_text,blocks",
    [
        ("x\n", [["x"]]),
        ("a\nb", []),
        ("top\nM 1\nv\nM 2", [["top"], ["M 1", "v"], ["M 2"]]),
        ("M 1\nM 2", [[], ["M 1"], ["M 2"]]),
    ],
)
def test_split_blocks(spark, body_text, blocks):
    assert text.split_blocks(body(spark, body_text), "^M ").first()["blocks"] == blocks


def test_block_fields(spark):
    log = "Pump house 3 \nlitres hours faults\n 510 24 1 \nOpen: 2 Shut: 5 Stuck: 0 \n"
    out = text.block_samples(
        body(spark, log),
        "Pump",
        [
            {"expression": r"Pump house\s(\S+)", "keys": ["house"]},
            {"expression": r"\s?(\d+)\s(\d+)\s(\d+)", "keys": ["litres", "hours", "faults"]},
            {"expression": r"Open:\s(\d+)\s\S+\s(\d+)\s\S+\s(\d+)", "keys": ["open", "shut", "stuck"]},
        ],
    )
    assert attrs(out) == [{"house": "3", "litres": "510", "hours": "24", "faults": "1", "open": "2", "shut": "5", "stuck": "0"}]


def test_csv(spark, tmp_path):
    path = tmp_path / "a.csv"
    path.write_text("first,last\nann,\"x, y\"\n")
    assert payloads.read_csv_samples(spark, str(path)).collect() == [("ann", "x, y")]
    renamed = payloads.read_csv_samples(spark, str(path), ["a", "b"]).collect()
    assert renamed[0] == ("first", "last")
    bad = payloads.csv_text_samples(body(spark, "a,b\n1,2\n3\n", 'a,b\n"1 ""q""",\n'))
    rows = sorted(bad.collect(), key=lambda r: (r["payload_id"], r["sample_ix"]))
    assert [dict(r["attrs"]) for r in rows] == [{"a": "1", "b": "2"}, {}, {"a": '1 "q"', "b": ""}]
    assert [r["error_msg"] is None for r in rows] == [True, False, True]


def test_long_and_broken_fields(spark):
    long = "x y," * 30_000
    texts = [f'a,b\n1,"{long}"\n', 'a,b\r\n1,"two\nlines, ""quoted"""\r\n2,z', "a,b\n1,2\n3,4,5\n6,7\n", ""]
    rows = sorted(payloads.csv_text_samples(body(spark, *texts)).collect(), key=lambda r: (r["payload_id"], r["sample_ix"]))
    assert [(r["payload_id"], r["attrs"].get("a"), r["attrs"].get("b"), bool(r["error_msg"])) for r in rows] == [
        (0, "1", long, False), (1, "1", 'two\nlines, "quoted"', False), (1, "2", "z", False), (2, "1", "2", False), (2, None, None, True),
    ]
    label = "v" * 60_000 + '\\"'
    parsed = prometheus.parse_exposition(body(spark, f'm{{a="{label}",b="c"}} 1\n')).collect()
    assert dict(parsed[0]["labels"]) == {"a": "v" * 60_000 + '"', "b": "c"}


def test_repeated_keys_and_xml_schema(spark):
    df = payloads.decode_json(body(spark, '{"a":1,"b":0,"a":2}'))
    assert attrs(shape.flatten_attrs(df.drop("body"))) == [{"a": "2", "b": "0"}]
    schema = T.StructType([T.StructField("-id", T.IntegerType()), T.StructField("name", T.StringType())])
    xml = payloads.parse_xml(body(spark, '<p id="5"><name>n</name></p>'), schema)
    assert attrs(shape.flatten_attrs(xml.drop("body"))) == [{"-id": "5", "name": "n"}]


def test_json_files_and_xml(spark, tmp_path):
    (tmp_path / "a.json").write_text('{\n "a b": {"c": 1}\n}')
    df = payloads.read_json_payloads(spark, str(tmp_path / "*.json"))
    assert attrs(shape.flatten_attrs(df.drop("body"))) == [{"a b.c": "1"}]
    assert attrs(shape.flatten_attrs(payloads.read_json_payloads(spark, str(tmp_path), True).drop("body"))) == [{"ab.c": "1"}]
    (tmp_path / "x.xml").write_text('<?xml version="1.0"?><l><i k="1">t</i><i k="2">u</i></l>')
    rows = payloads.read_xml(spark, str(tmp_path / "x.xml"), "i", "`-k` int, `#content` string")
    assert sorted(a["-k"] for a in attrs(shape.flatten_attrs(rows))) == ["1", "2"]


def test_formats_and_quarantine(spark):
    df = body(spark, '{"a":1}', " <?xml version='1.0'?><a/>", "k=v", "{broken")
    assert [r["format"] for r in payloads.detect_format(df).orderBy("payload_id").collect()] == ["json", "xml", "raw", "raw"]
    assert payloads.detect_format(df, "csv").first()["format"] == "csv"
    good, bad = payloads.quarantine(payloads.decode_json(df))
    assert good.count() == 1 and payloads.error_samples(bad).count() == 3


EXPOSITION = """# HELP go_pause Pauses.
# TYPE go_pause summary
go_pause{quantile="0"} 0.00025
go_pause{quantile="1"} NaN
go_pause_sum 0.5
go_pause_count 4
# TYPE warm gauge
warm 1.25e+07
# TYPE doors counter
doors{hall="x",side="y z"} 3 1700000000
# TYPE weight histogram
weight_bucket{hall="x",side="y z",le="0.5"} 1
weight_bucket{side="y z",hall="x",le="+Inf"} 2
weight_sum{hall="x",side="y z"} 0.75
weight_count{hall="x",side="y z"} 2
cargo_tons 4
"""


def test_prometheus(spark):
    parsed = prometheus.parse_lines(body(spark, EXPOSITION))
    for form in (prometheus.raw_samples(parsed), prometheus.label_samples(parsed), prometheus.full_family_samples(parsed, "x")):
        assert "Exchange" not in form._jdf.queryExecution().executedPlan().toString()
    twice = prometheus.parse_lines(spark.createDataFrame([(1, 'm{a="x"} 1'), (1, 'm{a="x"} 2')], "payload_id int, body string"))
    assert sorted(a["m"] for a in attrs(prometheus.label_samples(twice))) == ["1", "2"]
    raw = {a["name"]: a for a in attrs(prometheus.raw_samples(parsed))}
    assert raw["warm"]["value"] == "1.25e+07" and raw["warm"]["type"] == "GAUGE"
    assert raw["go_pause"]["0.000000"] == "0.00025" and "1.000000" not in raw["go_pause"] and raw["go_pause"]["count"] == "4"
    assert raw["weight"]["0.500000"] == "1" and raw["weight"]["+Inf"] == "2"
    assert attrs(prometheus.label_samples(parsed)) == [
        {"hall": "x", "side": "y z", "doors.counter": "3", "weight.histogram.count": "2", "weight.histogram.sum": "0.75"}
    ]
    assert attrs(prometheus.flattened_sample(parsed, "e")) == [{"name": "main", "warm": "1.25e+07", "cargo_tons": "4"}]
    families = lambda df: {r["family"] for r in df.collect()}
    assert families(prometheus.parse_exposition(body(spark, EXPOSITION), go_metrics=False)) == {"warm", "doors", "weight", "cargo_tons"}
    assert "cargo_tons" not in families(prometheus.parse_exposition(body(spark, EXPOSITION), go_metrics=False, compat=True))
    events = {r["event_type"] for r in prometheus.full_family_samples(parsed, "port").collect()}
    assert events == {"portSummarySample", "portHistogramSample"}


def test_beans(spark):
    dump = {"Harbour:type=Crane,name=a,attr=max": 5, "Harbour:type=Crane,name=a,attr=on": True, "odd": 1}
    df = beans.parse_bean_text(body(spark, "noise\n" + json.dumps(dump) + "\nmore noise"))
    out = beans.bean_samples(df.unionByName(df))
    assert out.count() == 4 and "HashAggregate" not in out._jdf.queryExecution().executedPlan().toString()
    got = sorted(attrs(beans.bean_samples(df)), key=len)
    assert got[-1] == {
        "bean": "type=Crane,name=a", "domain": "Harbour", "Harbour:type": "Crane", "name": "a", "max": "5", "on": "true",
    }
    assert got[0] == {"bean": "CouldNotGetQuery", "domain": "CouldNotGetDomain"}
    short = attrs(beans.compressed_bean_samples(df))[0]
    assert short["Crane.a.max"] == "5" and short["Crane.a.on"] == "true"
    failed = beans.parse_bean_text(body(spark, "no json"))
    assert "Failed" in failed.select(F.to_json("payload")).first()[0]


def test_html_tables(spark):
    page = """<html><body><table source="q"><tr><th>River</th><th>Length</th><th></th></tr>
      <tr><td>Ems</td><td><span>long,<a href="">ish</a></span></td></tr><tr><td>Oder</td></tr></table>
      <table></table><table><tr><td><table><tr><td>in</td></tr></table></td></tr></table></html>"""
    df = spark.createDataFrame([(1, page), (2, "<p>none</p>")], "page_id int, html string")
    got = [(r["table_ix"], dict(r["attrs"])) for r in web.html_table_samples(df).collect()]
    assert (0, {"River": "Ems", "Length": "long ish", "Col 2": "", "source": "q", "Index": "0"}) in got
    assert (0, {"River": "Oder", "Length": "", "Col 2": "", "source": "q", "Index": "0"}) in got
    assert (2, {"Col 1": "TableElement", "Index": "2"}) in got
    assert (3, {"Col 1": "in", "Index": "3"}) in got


def test_responses_and_pages(spark):
    df = spark.createDataFrame([(1, 200, '[{"a":1},"s",3]'), (2, 404, '{"error":"e","api.StatusCode":7}')], "id int, status int, body string")
    got = sorted(attrs(shape.flatten_attrs(web.response_payloads(df))), key=str)
    assert got == sorted(
        [{"api.StatusCode": "200", "a": "1"}, {"api.StatusCode": "200", "output": "s"}, {"api.StatusCode": "7", "error": "e"}], key=str
    )
    pages = spark.createDataFrame(
        [("r", 1, 200, '{"x":[1]}'), ("r", 2, 200, '{"x": [ ]}'), ("r", 3, 200, '{"x":[1]}'), ("q", 1, 200, "{}"), ("q", 2, 500, "{}"), ("n", 1, 200, "{}"), ("n", 2, None, "{}")],
        "request_id string, page_no int, status int, body string",
    )
    kept = sorted((r["request_id"], r["page_no"]) for r in web.select_pages(pages, payload_key="x").collect())
    assert kept == [("n", 1), ("q", 1), ("r", 1), ("r", 2)]
    assert web.select_pages(pages, max_pages=1).count() == 3
    keys = spark.range(1).select(
        web.page_number_key(F.lit('{"next": "12"}'), "next").alias("n"),
        web.page_text_key(F.lit('{"link":"/p?2"}'), "link", "http://h").alias("l"),
        web.next_link(F.lit('<http://h/2>; rel="next", <http://h/9>; rel="last"')).alias("h"),
    )
    assert list(keys.first()) == [12, "http://h/p?2", "http://h/2"]
