"""Plans over several sources: order, lookups, stores, merges and joins from specs alone."""

import itertools
import json
import random

import pytest
from pyspark.sql import functions as F

from samplecraft.operators import combine as C
from samplecraft.plans.sampling import SampleSpec
from samplecraft.plans.sources import SourcePlan, SourceSpec, persisted, run_sources


def payloads(spark, *rows):
    return spark.createDataFrame([(k, json.dumps(b) if b is not None else None) for k, b in rows], "payload_id string, body string")


def got(df):
    return sorted((r["event_type"], *sorted(dict(r["attrs"]).items())) for r in df.collect())


def test_adjacent_slots_are_the_product(spark):
    draw = random.Random(3)
    a, b = ["", "1", "11", "12", "1.", "é"], ["1", "2", "11", ".", "21", None]
    keys = ["".join(draw.choice("12.é") for _ in range(draw.randrange(6))) for _ in range(300)] + [None, ""]
    targets = spark.createDataFrame([(k,) for k in keys], "payload_id string")
    sets = {n: spark.createDataFrame([(v,) for v in vs + vs], "v string") for n, vs in (("a", a), ("b", b))}
    for template in ("${lookup:a}${lookup:b}", "${lookup:b}${lookup:a}${lookup:b}", "${lookup:a}${lookup:b}${lookup:a}", "1${lookup:a}${lookup:b}2", "${lookup:a}.${lookup:b}"):
        want = []
        for x, y in itertools.product(a, b):
            if y is not None:
                made = template.replace("${lookup:a}", x).replace("${lookup:b}", y)
                want += [(k, x, y) for k in keys if k == made]
        rows = C.lookup_fan_out(targets, template, sets).collect()
        assert sorted((r["payload_id"], r["lookup_a"], r["lookup_b"]) for r in rows) == sorted(want), template


def test_long_form_is_the_merge(spark):
    rows = spark.createDataFrame([("p", k, {"x": str(k), f"k{k % 3}": "v"}) for k in range(20)], "payload_id string, sample_ix int, attrs map<string,string>")
    sources = [C.Source(rows), C.Source(rows.where("sample_ix < 2"), prefix="z.")]
    entries = {r["key"]: r["value"] for r in C.merged_entries(sources).collect()}
    assert entries == dict(C.merge_samples(sources).first()["attrs"]) == {"x": "19", "k0": "v", "k1": "v", "k2": "v", "z.x": "1", "z.k0": "v", "z.k1": "v"}


def chain(spark):
    specs = [
        SourceSpec(SampleSpec("hulls", "Hull", custom_attributes={"ship": "${lookup.Ship:name}", "odd": "${lookup.Ship:none}"}), payload="s/${lookup.Ship:id}"),
        SourceSpec(SampleSpec("ships", "Ship", ignore_output=True)),
    ]
    inputs = {
        "ships": payloads(spark, ("", {"id": 1, "name": "a"}), ("", {"id": 2, "name": "b"}), ("", {"id": 2, "name": "c"}), ("", {"name": "none"}), (None, None)),
        "hulls": payloads(spark, ("s/1", {"m": 10}), ("s/2", {"m": 20}), ("s/3", {"m": 30}), (None, {"m": 40}), ("s/${lookup.Ship:id}", {"m": 50})),
    }
    return specs, inputs


def test_rows_name_payloads(spark):
    specs, inputs = chain(spark)
    plan = SourcePlan(specs, inputs)
    assert plan.order == ("ships", "hulls")
    odd = ("odd", "${lookup.Ship:none}")
    want = [("Hull", ("m", "10"), odd, ("ship", "a")), ("Hull", ("m", "20"), odd, ("ship", "b")), ("Hull", ("m", "20"), odd, ("ship", "c"))]
    assert got(plan.emitted()) == want == got(SourcePlan(specs[::-1], inputs).emitted())
    once = SourcePlan([SourceSpec(specs[0].sample, payload=specs[0].payload, dedupe_lookups=["id"]), specs[1]], inputs)
    assert once.emitted().count() == 2
    empty = {n: df.limit(0) for n, df in inputs.items()}
    assert SourcePlan(specs, empty).emitted().isEmpty()


def test_shared_frames_are_kept_once(spark):
    specs, inputs = chain(spark)
    kept = []
    plan = SourcePlan([*specs, SourceSpec(SampleSpec("more", "More"), cache="hulls")], inputs, share=lambda df: kept.append(persisted(df)) or kept[-1])
    assert plan.emitted().count() == 6 and len(kept) == 2 and all(df.is_cached for df in kept)
    plan.release()
    assert not any(df.is_cached for df in kept)


def test_stores_see_rows_before_filters(spark):
    inputs = {
        "a": payloads(spark, ("1", {"id": "x", "list": ["p", "q"]}), ("2", {"id": "y", "list": "r"}), ("3", {"other": 1})),
        "b": payloads(spark, *[(f"{v}/{k}", {"k": k}) for v in ("x", "y", "given") for k in "pqrs"]),
    }
    a = SourceSpec(SampleSpec("a", sample_filter=[{"id": ".*"}], lazy_flatten=[], split_objects=False), store_variables={"last": "id"}, store_lookups={"ids": "id"})
    plan = SourcePlan([SourceSpec(SampleSpec("b"), payload="${var:last}/${lookup:keys}"), a], inputs, sets={"keys": spark.createDataFrame([("p",), ("s",)], "v string")})
    assert [r["event_type"] for r in plan.samples("b").collect()] == ["bSample"] * 2
    assert sorted(r["payload_id"] for r in plan.samples("b").collect()) == ["y/p", "y/s"]
    assert sorted(r["value"] for r in plan.lookup_set("ids").collect()) == ["x", "y"]
    assert plan.lookup_set("none") is None and plan.variable("none") is None
    nothing = {**inputs, "a": inputs["a"].limit(0)}
    given = SourcePlan([SourceSpec(SampleSpec("b"), payload="${var:last}/p"), a], nothing, variables={"last": "given"})
    assert [r["payload_id"] for r in given.samples("b").collect()] == ["given/p"]
    text = SourcePlan([SourceSpec(SampleSpec("b", custom_attributes={"v": "<${var:last}${var:free}>"}), payload="${var:last}/${lf:K}", lookup_file="f")], inputs, variables={"last": "x"}, lookup_files={"f": spark.createDataFrame([("q",), (None,)], "k string")})
    assert got(text.emitted()) == [("bSample", ("k", "q"), ("v", "<x${var:free}>"))]


def test_the_variable_of_the_last_declared_source_wins(spark):
    inputs = {n: payloads(spark, ("1", {"v": f"{n}1"}), ("2", {"v": f"{n}2"})) for n in "abc"} | {"d": payloads(spark, ("0", {"z": 1}))}
    specs = [SourceSpec(SampleSpec(n), store_variables={"v": "v"}) for n in "abc"]
    read = SourceSpec(SampleSpec("d", custom_attributes={"v": "${var:v}"}))
    for order in itertools.permutations(range(3)):
        plan = SourcePlan([read, *[specs[k] for k in order]], inputs)
        assert plan.samples("d").first()["attrs"]["v"] == "abc"[order[-1]] + "2"


def test_merge_and_join(spark):
    inputs = {
        "p": payloads(spark, ("1", {"id": 1, "alt": "k", "v": "p"}), ("2", {"id": 2, "v": "q"})),
        "s": payloads(spark, ("1", {"key": 1.0, "w": "a"}), ("2", {"key": 1, "w": "b"}), ("3", {"key": 9, "w": "c"})),
        "t": payloads(spark, ("1", {"name": "k", "u": "t"})),
        "m": payloads(spark, ("1", {"x": 1}), ("2", {"x": 2, "y": 3})),
        "n": payloads(spark, ("1", {"y": 4})),
    }
    specs = [
        SourceSpec(SampleSpec("p", merge="All", prefix="p."), join_key="id, alt"),
        SourceSpec(SampleSpec("m", merge="All")),
        SourceSpec(SampleSpec("s", merge="All"), join_key="key"),
        SourceSpec(SampleSpec("t", merge="All", prefix="t."), join_key="name"),
        SourceSpec(SampleSpec("n", merge="All")),
    ]
    out = run_sources(specs, inputs)
    assert got(out) == [
        ("All", ("key", "1"), ("p.alt", "k"), ("p.id", "1"), ("p.v", "p"), ("t.name", "k"), ("t.u", "t"), ("w", "b")),
        ("All", ("p.id", "2"), ("p.v", "q")),
        ("All", ("x", "2"), ("y", "4")),
    ]
    assert {r["source"] for r in out.collect()} == {"All"}


def test_what_is_refused(spark):
    one = payloads(spark, ("1", {"a": 1}))
    inputs = {"a": one, "b": one}
    uses = lambda n, of: SourceSpec(SampleSpec(n), payload="${lookup:" + of + "}", store_lookups={n: "a"})
    with pytest.raises(ValueError, match="need each other: (a -> b -> a|b -> a -> b)"):
        SourcePlan([uses("a", "b"), uses("b", "a")], inputs)
    with pytest.raises(ValueError, match="one name: a"):
        SourcePlan([SourceSpec(SampleSpec("a")), SourceSpec(SampleSpec("a"))], inputs)
    with pytest.raises(ValueError, match="no payload table c"):
        SourcePlan([SourceSpec(SampleSpec("c"))], inputs)
    with pytest.raises(ValueError, match="no source"):
        SourcePlan([SourceSpec(SampleSpec("a"), cache="z")], inputs)
    with pytest.raises(ValueError, match="no lookup file"):
        SourcePlan([SourceSpec(SampleSpec("a"), payload="${lf:x}")], inputs)
    with pytest.raises(ValueError, match="several kinds"):
        run_sources([SourceSpec(SampleSpec("a"), payload="${lookup:x}${lookup.bSample:a}"), SourceSpec(SampleSpec("b"))], inputs)
    # a set that nobody stores names nothing, and a source that uses what it stores itself sees the others' values
    assert run_sources([SourceSpec(SampleSpec("a"), payload="${lookup:x}")], inputs).isEmpty()
    assert run_sources([uses("a", "a"), SourceSpec(SampleSpec("b"), store_lookups={"a": "a"})], inputs).count() == 2


def test_rows_before_filters_can_be_saved(spark, tmp_path):
    from samplecraft.sinks.output import write_json

    plan = SourcePlan([SourceSpec(SampleSpec("a", sample_filter=[{"a": "1"}], to_lower=True))], {"a": payloads(spark, ("1", {"A": 1}), ("2", {"A": 2}))})
    write_json(plan.rows("a"), str(tmp_path / "saved"))
    assert sorted(r["a"] for r in spark.read.json(str(tmp_path / "saved")).collect()) == ["1", "2"]
    assert [r["attrs"]["a"] for r in plan.emitted().collect()] == ["2"]
    assert plan.emitted().where(F.col("source") != "a").isEmpty()
