import json
import math

import pytest
from pyspark.sql import functions as F

from samplecraft.functions import variants as V
from samplecraft.operators import shape


def payloads(spark, *bodies):
    rows = [(i, b if isinstance(b, str) else json.dumps(b)) for i, b in enumerate(bodies)]
    return shape.parse_payloads(spark.createDataFrame(rows, "payload_id int, body string")).drop("body")


def docs(df):
    return [json.loads(r[0]) for r in df.orderBy("payload_id").select(F.to_json("payload")).collect()]


def attrs(df):
    return sorted((dict(r["attrs"]) for r in df.collect()), key=lambda d: sorted(d.items()))


STATION = {"station": "north", "active": True, "readings": {"wind": {"gust": 17, "mean": 9.5}, "sky": "clear", "alerts": ["ice"]}}
LINES = {"city": "K", "lines": [{"no": 4, "stops": [{"at": 1}, {"at": 2}], "depot": {"east": 1}}, {"no": 7, "stops": {"at": 3}}, {"no": 9}]}


@pytest.mark.parametrize(
    "body,keys,inherit,expected",
    [
        (STATION, ["readings"], False, STATION["readings"]),
        (STATION, ["readings", "wind"], False, {"gust": 17, "mean": 9.5}),
        (STATION, ["readings", "wind"], True, {"gust": 17, "mean": 9.5, "parent.0.active": "true", "parent.0.station": "north", "parent.1.sky": "clear"}),
        (STATION, ["readings", "alerts"], False, {"alerts": ["ice"]}),
        (STATION, ["readings", "missing"], False, STATION["readings"]),
        (STATION, ["station"], False, STATION),
        (LINES, ["lines"], False, {"lines": LINES["lines"]}),
        (LINES, ["lines>stops"], False, {"stops": [{"at": 1}, {"at": 2}, {"at": 3}]}),
        (
            LINES,
            ["lines>stops"],
            True,
            {
                "stops": [
                    {"at": 1, "parent.0.city": "K", "parent.0.no": "4", "parent.0.depot.east": "1"},
                    {"at": 2, "parent.0.city": "K", "parent.0.no": "4", "parent.0.depot.east": "1"},
                    {"at": 3, "parent.0.city": "K", "parent.0.no": "7"},
                ]
            },
        ),
    ],
)
def test_descend(spark, body, keys, inherit, expected):
    assert docs(shape.descend(payloads(spark, body), keys, inherit)) == [expected]


SHELF = {"shelf": 12, "owner": {"name": "o", "phone": 5}, "books": [{"isbn": 1, "loan": {"due": 3}}, {"isbn": 2}]}


@pytest.mark.parametrize(
    "keys,expected",
    [
        (["shelf", "books"], {"owner": SHELF["owner"]}),
        (["none", "owner>none"], SHELF),
        (["owner>phone"], SHELF | {"owner": {"name": "o"}}),
        (["books>loan", "owner"], {"shelf": 12, "books": [{"isbn": 1}, {"isbn": 2}]}),
    ],
)
def test_strip_keys(spark, keys, expected):
    assert docs(shape.strip_keys(payloads(spark, SHELF), keys)) == [expected]


@pytest.mark.parametrize(
    "key,expected",
    [
        ("books", SHELF | {"books": {"flat.0.isbn": 1, "flat.0.loan.due": 3, "flat.1.isbn": 2}}),
        ("owner", SHELF | {"owner": {"flat.name": "o", "flat.phone": 5}}),
        ("books>loan", SHELF | {"books": [{"isbn": 1, "loan.due": 3}, {"isbn": 2}]}),
        ("owner>phone", SHELF | {"owner": {"name": "o", "phone": {"name": "o", "phone": 5}}}),
        ("none", SHELF),
    ],
)
def test_lazy_flatten(spark, key, expected):
    assert docs(shape.lazy_flatten(payloads(spark, SHELF), [key])) == [expected]


def test_no_leaf_is_lost_at_any_depth(spark):
    """As many leaves come out as go in, whatever the nesting."""

    def nested(seed: int, depth: int):
        if not depth:
            return seed
        return {f"k{seed % 3}": nested(seed * 5 + 1, depth - 1), f"m{seed % 2}": seed, **({"deep": nested(seed + 7, depth // 2)} if seed % 4 == 0 else {})}

    def leaves(x) -> int:
        return sum(map(leaves, x.values())) if isinstance(x, dict) else 1

    bodies = [nested(seed, depth) for seed, depth in ((1, 1), (4, 7), (8, 9), (3, 12), (12, 33), (5, 60))]
    out = shape.to_samples(payloads(spark, *bodies)).orderBy("payload_id").collect()
    assert [len(r["attrs"]) for r in out] == [leaves(b) for b in bodies]
    lists = ["[" * d + "1,2" + "]" * d for d in (1, 2, 9, 50)]
    rows = shape.to_samples(payloads(spark, *[f'{{"a":{x}}}' for x in lists]), split_array=True, number_style="plain")
    assert attrs(rows) == [{"a0": "1", "a1": "2"}] * 4
    objects = shape.payload_objects(payloads(spark, *["[" * d + '{"o":1},[{"o":2}]' + "]" * d for d in (1, 3, 20)]))
    assert objects.count() == 6


def test_extract(spark):
    df = payloads(spark, {"foo": {"data": [{"a": 1}, {"a": 2}]}, "b": {"c": 1}, "d": {"c": 2}, "s": 1})
    assert docs(shape.extract(df, ".foo.data")) == [{"a": 1}, {"a": 2}]
    assert docs(shape.extract(df, ".foo.data[]")) == [{"a": 1}, {"a": 2}]
    assert docs(shape.extract(df, ".b, .d")) == [{"c": 1}, {"c": 2}]
    assert docs(shape.extract(df, ".foo.data[1]")) == [{"a": 2}]
    assert docs(shape.extract(df, ".s")) == []
    listed = payloads(spark, [{"a": {"b": 1}}, {"a": {"b": 2}}])
    assert docs(shape.extract(listed, ".[].a")) == [{"b": 1}, {"b": 2}]
    assert docs(shape.extract(listed, ".[0].a")) == [{"b": 1}]
    with pytest.raises(ValueError):
        shape.extract(df, ".a | select(.b)")


def test_samples_union_and_broadcast(spark):
    body = {
        "id": 7,
        "n": None,
        "e": {},
        "resources": ["arn"],
        "detail": {"zone": "z", "containers": [{"name": "a", "id": 1, "tags": ["x"]}, {"name": "b"}]},
    }
    out = shape.to_samples(payloads(spark, body))
    got = sorted((r["event_type"], r["sample_ix"], dict(r["attrs"])) for r in out.collect())
    assert got == [
        ("detail.containerSamples", 0, {"name": "a", "id": "7", "tagSamples": '["x"]', "detail.zone": "z"}),
        ("detail.containerSamples", 1, {"name": "b", "id": "7", "detail.zone": "z"}),
        ("resourceSamples", 0, {"value": "arn", "id": "7", "detail.zone": "z"}),
    ]


def test_samples_without_arrays_is_one_row(spark):
    out = shape.to_samples(payloads(spark, {"a": {"b": 1, "c": {"d": "x"}}, "l": []}))
    assert attrs(out) == [{"a.b": "1", "a.c.d": "x"}]


def test_sample_keys_and_split_objects(spark):
    body = {"farm": "f", "barns": {"b1": {"cows": {"brown": 1}}, "b2": {"cows": {"brown": 2}}}}
    out = shape.to_samples(payloads(spark, body), sample_keys={"x": "barns>barn.id"})
    assert attrs(out) == [
        {"barn.id": "b1", "cows.brown": "1", "farm": "f"},
        {"barn.id": "b2", "cows.brown": "2", "farm": "f"},
    ]
    assert {r["event_type"] for r in out.collect()} == {"barnSamples"}
    split = shape.to_samples(payloads(spark, {"oak": {"age": 90}, "count": 2, "fir": {"size": {"tall": 30}}}), split_objects=True)
    assert attrs(split) == [{"age": "90", "split.id": "oak"}, {"size.tall": "30", "split.id": "fir"}]


def test_split_array(spark):
    body = {
        "tides": [
            [{"points": [[100, 1.25], [160, 1.5]], "pier": "A", "gauge": {"model": "g1"}}],
            [{"points": [[100, 7]], "pier": "B", "gauge": {"model": "g2"}}],
        ]
    }
    out = attrs(shape.to_samples(payloads(spark, body), split_array=True, set_header=["when", "metres"]))
    first, second = {"tides-pier": "A", "tides-gauge-model": "g1"}, {"tides-pier": "B", "tides-gauge-model": "g2"}
    want = [
        {"when": "100.000000", "metres": "1.250000", **first},
        {"when": "160.000000", "metres": "1.500000", **first},
        {"when": "100.000000", "metres": "7.000000", **second},
    ]
    assert len(out) == 3 and all(w in out for w in want)
    leaf = shape.to_samples(
        payloads(spark, {"laps": [[{"seconds": [61, 59], "runner": "r"}], []]}),
        split_array=True,
        leaf_array=True,
        set_header=["lap"],
        number_style="plain",
    )
    assert attrs(leaf) == [{"index": "0", "lap": "61", "laps-runner": "r"}, {"index": "1", "lap": "59", "laps-runner": "r"}]


def test_time_value_pairs(spark):
    body = {
        "series": [
            {"tags": {"room": "attic"}, "values": [[1700000000.25, "20.5"], [1700000060.25, "21"]]},
            {"tags": {"room": "cellar"}, "value": [1700000007.5, "12"]},
        ]
    }
    out = attrs(shape.to_samples(payloads(spark, body), time_value_pairs=True))
    assert out == [
        {"tags.room": "attic", "timestamp": "1700000000", "value": "20.5"},
        {"tags.room": "attic", "timestamp": "1700000060", "value": "21"},
        {"tags.room": "cellar", "timestamp": "1700000007", "value": "12"},
    ]


def test_flatten_columns_matches_flatten_attrs(spark):
    df = spark.createDataFrame([(1, '{"a":{"b":"x","c":{"d":"y"}},"e":"z"}')], "id int, body string")
    wide = shape.flatten_columns(df, "body", "a struct<b:string,c:struct<d:string>>, e string")
    assert wide.first().asDict() == {"id": 1, "a.b": "x", "a.c.d": "y", "e": "z"}
    mapped = shape.flatten_attrs(shape.parse_payloads(df).drop("body"))
    assert dict(mapped.first()["attrs"]) == {"a.b": "x", "a.c.d": "y", "e": "z"}


def test_no_exchange_in_shape(spark):
    df = shape.to_samples(shape.strip_keys(payloads(spark, {"a": [1]}), ["b"]))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan


def test_turns_reach_any_depth_and_few_are_idle(spark):
    assert math.prod(V._TURNS) >= 1000 and sum(V._TURNS) <= 64
    n = F.col("id")
    counted = V.until_done(F.struct(F.lit(0).alias("i"), n.alias("n")), lambda s: F.struct((s["i"] + 1).alias("i"), s["n"]), lambda s: s["i"] < s["n"])
    rows = spark.createDataFrame([(0,), (1,), (4,), (37,), (1000,)], "id int").select("id", counted["i"].alias("i")).collect()
    assert [r["i"] for r in rows] == [r["id"] for r in rows]
