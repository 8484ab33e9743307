import itertools

from pyspark.sql import Window
from pyspark.sql import functions as F

from samplecraft.operators import combine as C
from samplecraft.operators import metrics as M
from samplecraft.operators import numbering as N
from samplecraft.plans.sampling import SampleSpec, to_samples
from samplecraft.sinks import output as O

SCHEMA = "payload_id int, sample_ix int, attrs map<string,string>"


def rows(spark, *maps):
    return spark.createDataFrame([(i, 0, {k: str(v) for k, v in m.items()}) for i, m in enumerate(maps)], SCHEMA)


def attrs(df):
    return sorted((dict(r["attrs"]) for r in df.collect()), key=str)


def test_join(spark):
    primary = rows(spark, {"id": 1, "alt": "z", "v": "p"}, {"id": 2, "v": "q"}, {"id": 3, "alt": "w"})
    by_id = rows(spark, {"key": 1, "v": "old"}, {"key": 1, "v": "new"}, {"key": 9})
    by_alt = rows(spark, {"key": "w", "x": "alt"})
    out = C.join_samples(
        C.Source(primary, prefix="p.", join_key="id,alt"),
        [C.Source(by_id, prefix="s.", join_key="key"), C.Source(by_alt, join_key="key")],
    )
    assert attrs(out) == sorted(
        [
            {"p.id": "1", "p.alt": "z", "p.v": "p", "s.key": "1", "s.v": "new"},
            {"p.id": "2", "p.v": "q"},
            {"p.id": "3", "p.alt": "w", "key": "w", "x": "alt"},
        ],
        key=str,
    )


def test_merge(spark):
    out = C.merge_samples([C.Source(rows(spark, {"a": 1, "b": 1}, {"a": 2}), prefix="x."), C.Source(rows(spark, {"x.b": 9}))], event_type="m")
    assert [(r["event_type"], dict(r["attrs"])) for r in out.collect()] == [("m", {"x.a": "2", "x.b": "9"})]


def test_fan_out_is_the_product(spark):
    sets = {"a": ["1", "2", "3"], "b": ["x", "x/y"], "c": ["p", "q"]}
    named = {k: spark.createDataFrame([(v,) for v in vs], "v string") for k, vs in sets.items()}
    keys = [f"/{a}/{b}/{c}" for a, b, c in itertools.product(*sets.values())]
    targets = spark.createDataFrame([(k,) for k in [*keys, "/4/x/p", "/1/x", "/1/x/p/"]], "payload_id string")
    out = C.lookup_fan_out(targets, "/${lookup:a}/${lookup:b}/${lookup:c}", named)
    got = sorted(tuple(r) for r in out.select("lookup_a", "lookup_b", "lookup_c").collect())
    assert got == sorted(itertools.product(*sets.values())) and len(got) == 12
    assert C.lookup_fan_out(targets, "/${lookup:none}", named).count() == 0
    assert "CartesianProduct" not in out._jdf.queryExecution().executedPlan().toString()


def test_row_lookup_and_dedupe(spark):
    samples = rows(spark, {"id": 31}, {"id": 31}, {"id": 52}, {"other": 1}).withColumn("event_type", F.lit("e"))
    targets = spark.createDataFrame([("n/31",), ("n/52",)], "payload_id string")
    template = "n/${lookup.e:id}"
    assert C.row_lookup(samples, targets, template, "e").count() == 3
    assert C.row_lookup(samples, targets, template, "e", dedupe=["id"], order=["payload_id"]).count() == 2
    assert C.dedupe_lookups(samples, ["id"]).count() == 3


def test_numbering_is_dense_and_ordered(spark):
    df = spark.range(500).withColumn("g", (F.col("id") % 10 < 7).cast("int"))
    ids = {g: sorted(r["id"] for r in df.collect() if r["g"] == g) for g in (0, 1)}
    want = sorted((i, g, k + 1) for g in ids for k, i in enumerate(ids[g]))
    assert sorted(tuple(r) for r in N.number_rows(df, ["id"], group=["g"]).select("id", "g", "row_no").collect()) == want
    words = df.select(F.when(F.col("id") % 50 != 0, F.concat(F.lit("same prefix "), F.lpad(F.col("id").cast("string"), 4, "0"))).alias("w"), "id")
    ordered = N.number_rows(words, ["w", "id"]).orderBy("row_no").collect()
    assert [r["row_no"] for r in ordered] == list(range(1, 501))
    assert [r["id"] for r in ordered] == [r["id"] for r in words.orderBy("w", "id").collect()]
    loose = N.number_any_order(df, ["id"], group=["g"], rows_per_slice=70).groupBy("g").agg(
        F.max("row_no"), F.countDistinct("row_no"), F.count(F.lit(1))
    )
    assert all(r[1] == r[2] == r[3] for r in loose.collect())


def test_ranges_are_even(spark):
    """Common prefixes, a value that half of the rows share and exact copies."""
    k = F.col("id")
    head = F.when(k % 2 == 0, F.lit("https://one.host.example/path/")).otherwise(F.concat(F.lit("https://one.host.example/path/"), F.sha2(k.cast("string"), 256)))
    df = spark.range(120_000).select(head.alias("url"), F.when(k % 4 == 0, F.lit(None)).otherwise(k % 1000).alias("n"), k)
    for order in (["url", "n"], ["url"], ["n", "url"]):
        dealt = N.in_ranges(df, order)
        sizes = sorted(r["count"] for r in dealt.groupBy("_range").count().collect())
        assert len(sizes) > 25 and sizes[-1] < 2 * sizes[len(sizes) // 2] and sum(sizes) == 120_000
        numbers = N.number_rows(df, order)
        assert numbers.agg(F.min("row_no"), F.max("row_no"), F.countDistinct("row_no")).first() == (1, 120_000, 120_000)
        w = Window.orderBy("row_no")
        fell = F.lag(F.struct(*order)).over(w) > F.struct(*order)
        assert numbers.select(fell.alias("fell")).where("fell").isEmpty()
    assert N.number_rows(df.limit(0), ["url"]).isEmpty()


def test_bursts_are_even(spark):
    """Half of all rows are within one second of one series."""
    k = F.col("id")
    burst = k % 2 == 0
    us = F.when(burst, 10**9 + k * 7 % 900_000).otherwise(k * 1_000_000)
    df = spark.range(60_000).select(F.timestamp_micros(us).alias("ts"), F.when(burst, "hot").otherwise(F.concat(F.lit("s"), k % 20)).alias("s"), (k * 7919 % 101).cast("double").alias("value"), "id")
    got = M.differences(df, ["s"], kind=F.lit("DELTA"), tie=["id"])
    want = M.differences(df, ["s"], kind=F.lit("DELTA"), tie=["id"], slice_seconds=10**7)
    assert got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()
    sizes = sorted(r["count"] for r in N.in_ranges(df, ["s", "ts", "id"]).groupBy("_range").count().collect())
    assert sizes[-1] < 2 * sizes[len(sizes) // 2]


def test_differences_do_not_depend_on_the_slices(spark):
    df = spark.range(300).select(
        F.timestamp_seconds(F.col("id") * 37).alias("ts"), F.lit("hot").alias("s"), ((F.col("id") * 7919) % 101).cast("double").alias("value")
    )
    results = []
    for seconds in (60, 10**6, None):
        out = M.differences(df, ["s"], kind=F.lit("RATE"), slice_seconds=seconds)
        results.append([r["reported"] for r in out.orderBy("ts").collect()])
    assert results[0] == results[1] == results[2]
    assert results[0][0] == 0.0 and results[0][1] == (7919 % 101) / 37


def test_change_rules(spark):
    df = spark.createDataFrame(
        [("s", k, t, v) for k in ("RATE", "PRATE", "DELTA", "PDELTA", "GAUGE") for t, v in ((0, 5.0), (10, 3.0), (10, 4.0))],
        "s string, kind string, t int, value double",
    ).withColumn("ts", F.timestamp_seconds("t"))
    out = M.differences(df, ["s", "kind"], tie=["value"])
    got = {k: [r["reported"] for r in out.filter(F.col("kind") == k).orderBy("t", "value").collect()] for k in ("RATE", "PRATE", "DELTA", "PDELTA", "GAUGE")}
    assert got == {
        "RATE": [0.0, -0.2, None], "PRATE": [0.0, None, None], "DELTA": [0.0, -2.0, None], "PDELTA": [0.0, None, None], "GAUGE": [5.0, 3.0, 4.0],
    }


def test_batches(spark):
    df = spark.range(25).select("id", F.when(F.col("id") < 20, "hot").otherwise("cold").alias("entity"), F.col("id").cast("string").alias("event"))
    out = O.batches(df, ["id"], ["entity"], size=8, rows_per_slice=7).collect()
    assert sorted((r["entity"], r["batch_id"], r["n"]) for r in out) == [("cold", 0, 5), ("hot", 0, 8), ("hot", 1, 8), ("hot", 2, 4)]
    assert sorted(int(e) for r in out for e in r["events"]) == list(range(25))


def test_write_json(spark, tmp_path):
    df = spark.createDataFrame([("aSample", {"x": "1"})], "event_type string, attrs map<string,string>")
    O.write_json(df, str(tmp_path / "out"))
    assert spark.read.json(str(tmp_path / "out")).first().asDict() == {"event_type": "aSample", "x": "1"}
    O.write_samples(df, str(tmp_path / "table"))
    assert spark.read.parquet(str(tmp_path / "table")).filter("event_type = 'aSample'").count() == 1


def test_plan_end_to_end(spark):
    def run(body, **options):
        df = spark.createDataFrame([(1, body)], "payload_id int, body string")
        rows = to_samples(df, SampleSpec(name="read", **options)).collect()
        return sorted(((r["event_type"], dict(r["attrs"])) for r in rows), key=lambda r: sorted(r[1].items()))

    assert run(
        '{"legs": [{"from": "A","km": 30},{"from": "B","km": 12.5}]}',
        lazy_flatten=["legs"],
        math={"km": "${legs.flat.0.km} + ${legs.flat.1.km} + 7"},
        remove_keys=["legs.flat.1.from"],
        custom_attributes={"fleet": "red"},
    ) == [("readSample", {"fleet": "red", "km": "49.5", "legs.flat.0.from": "A", "legs.flat.0.km": "30", "legs.flat.1.km": "12.5"})]
    assert run('{"tank": {"level": "low", "litres": 3}, "x": 1}', extract=".tank", keep_keys=["level"], custom_attributes={"fleet": "red"}) == [
        ("readSample", {"level": "low"})
    ]
    assert run(
        '{"ID":"q","Tank":{"level":"low","hatch":{"bolt1":"no:8","bolt2":"no:15"}},"name":"t"}',
        to_lower=True, strip_keys=["Tank>level", "name"], value_parser={"bolt": "[0-9]+"}, value_transformer={"id": "fixed"},
    ) == [("readSample", {"id": "fixed", "tank.hatch.bolt1": "8", "tank.hatch.bolt2": "15"})]
    assert run('{"trip":[{"km":10,"bus":"b1"},{"km":20,"bus":"b2"}]}', sample_include_filter=[{"bus": "b1"}]) == [
        ("tripSample", {"km": "10", "bus": "b1"})
    ]
    assert run(
        '{"ok":1,"tides":[{"pier":-4,"units":[{"u":"m"}],"points":[[1700000000,0,"hi"],[1700000000,2,"lo"]]}]}',
        event_type="tide", split_array=True, set_header=["at", "metres", "mark"], start_key=["tides>points"],
    ) == [
        ("tide", {"at": "1700000000.000000", "mark": "hi", "metres": "0.000000"}),
        ("tide", {"at": "1700000000.000000", "mark": "lo", "metres": "2.000000"}),
    ]


def test_numbers_join_by_value(spark):
    primary = rows(spark, {"id": "2500000", "v": "p"}, {"id": "07", "v": "q"}, {"id": "x1", "v": "r"})
    secondary = rows(spark, {"key": "2.5e+06", "s": "a"}, {"key": "7", "s": "b"}, {"key": "x1", "s": "c"})
    out = C.join_samples(C.Source(primary, join_key="id"), [C.Source(secondary, join_key="key")])
    assert {a["v"]: a.get("s") for a in attrs(out)} == {"p": "a", "q": "b", "r": "c"}
    assert C.dedupe_lookups(rows(spark, {"id": "100"}, {"id": "1e2"}, {"id": "1e2x"}), ["id"]).count() == 2


def test_option_order_does_not_matter(spark):
    options = dict(
        to_lower=True, rename_keys={"^a_": "b."}, keep_keys=["^b"], value_parser={"a_x": r"\d+"}, add_attribute={"link": "/${b.x}"},
        sample_filter=[{"b.y": "never"}], math={"m": "${b.x} + 1"},
    )
    df = spark.createDataFrame([(1, '{"A_X":"n 7","a_y":"v","c":1}')], "payload_id int, body string")
    first = to_samples(df, SampleSpec(**options)).collect()
    second = to_samples(df, SampleSpec(**dict(reversed(options.items())))).collect()
    assert first == second
    assert dict(first[0]["attrs"]) == {"b.x": "7", "b.y": "v", "link": "/7", "m": "8"}
