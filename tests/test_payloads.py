"""Dimensional payloads: values are typed once, whatever a summary asks for."""

from pyspark.sql import functions as F

from samplecraft.functions import scalars
from samplecraft.operators import metrics as M

INF = float("inf")


def summary(*keys):
    return dict(zip(["min", "max", "sum", "count"], keys, strict=True), interval="1000")


def rows_of(spark, rows, **options):
    df = spark.createDataFrame(rows, "id int, attrs map<string,string>")
    return M.dimensional_payload(df, timestamp_ms=F.lit(5), **options)


def test_values_are_parsed_once(spark):
    """More summaries bring no more number patterns, and a value in the usual form is tried against one of them."""
    def patterns(summaries):
        return rows_of(spark, [(1, {"a": "1"})], summaries=summaries)._jdf.queryExecution().optimizedPlan().toString().count("RLIKE")

    few = patterns({})
    assert few and patterns({"s": summary("a", "b", "c", "d"), "t": summary("e", "f", "g", "h")}) == few


def test_payloads(spark):
    rows = [
        (1, {"lo": "1", "hi": "3.5", "sum": "-inf", "n": "2", "qty": "7", "free": "1e3", "word": "x", "gone": None}),
        (2, {"lo": "1", "hi": "x", "sum": "4", "n": "2", "inf": "infinity", "nan": "NaN"}),
        (3, {}),
        (4, None),
    ]
    out = rows_of(spark, rows, counts={"qty": 60000}, summaries={"s": summary("lo", "hi", "sum", "n"), "none": summary("a", "a", "a", "a")}, fixed={"by": "me"})
    found = {r["id"]: r for r in out.collect()}
    assert [r["timestamp_ms"] for r in found.values()] == [5] * 4
    assert {i: r["common_attributes"] for i, r in found.items()} == {
        1: {"by": "me", "word": "x", "gone": None}, 2: {"by": "me", "hi": "x", "inf": "infinity"}, 3: {"by": "me"}, 4: {"by": "me"}
    }
    first = {m["name"]: m for m in found[1]["metrics"]}
    assert {n: (m["type"], m["value"], m["interval_ms"]) for n, m in first.items()} == {
        "qty": ("count", 7.0, 60000.0), "free": ("gauge", 1000.0, None), "s": ("summary", None, 1000.0)
    }
    assert tuple(first["s"]["summary"]) == (1.0, 3.5, -INF, 2.0) and found[1]["metrics"][-1]["name"] == "s"
    assert [str(m["value"]) for m in found[2]["metrics"]] == ["nan"] and found[3]["metrics"] == [] and found[4]["metrics"] is None


def test_prefixed(spark):
    out = rows_of(spark, [(1, {"a": "1", "b": "x"})], prefix="p.", summaries={"s": summary("p.a", "p.a", "p.a", "p.a")}).first()
    assert out["common_attributes"] == {"p.b": "x"} and [m["name"] for m in out["metrics"]] == ["s"]


def test_metric_values(spark):
    expected = {
        "5": 5.0, "+5.": 5.0, "-.5e2": -50.0, "5\n": 5.0, "1e308": 1e308, "9" * 308: float("9" * 308), "." + "1" * 400: float("." + "1" * 400), "1e-400": 0.0,
        "1e400": None, "9" * 309: None, "9" * 309 + ".5": None, "": None, " 5": None, "5d": None, "0x1p3": None, "1_0": None, "٥": None, ".": None, "1.2.3": None,
        "-INF": -INF, "-Infinity": -INF, "infinity": None, "-nan": None, "x": None, None: None,
    }
    for dimensional in (False, True):
        more = {"inf": INF, "+INF": INF, "+Infinity": INF} if dimensional else {"inf": None, "+INF": None, "+Infinity": INF, "NaN": None}
        df = spark.createDataFrame([(t,) for t in expected | more], "t string")
        assert {r["t"]: r["v"] for r in df.select("t", scalars.metric_value(F.col("t"), dimensional).alias("v")).collect()} == expected | more
