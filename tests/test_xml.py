"""XML without a schema."""

import json
import time
from xml.etree import ElementTree

from hypothesis import given, settings
from hypothesis import strategies as st

from samplecraft.operators import shape
from samplecraft.sources.xml import parse_any_xml, xml_to_json


def read(text, **options):
    out = xml_to_json(text, **options)
    return None if out is None else json.loads(out)


def test_shapes():
    assert read("<a/>") == {"a": ""} and read("<a> x </a>") == {"a": "x"}
    assert read('<?xml version="1.0" encoding="ISO-8859-1"?><a k="é&amp;">ü</a>') == {"a": {"-k": "é&", "#content": "ü"}}
    assert read("<a><b>1</b><c/><b x='2'/></a>") == {"a": {"b": ["1", {"-x": "2"}], "c": ""}}
    assert read("<a>one<b/>\n two <!-- no --> more<c/>  </a>") == {"a": {"b": "", "c": "", "#content": "one two  more"}}
    assert read("<a><![CDATA[<x> & ]]>y</a>") == {"a": "<x> & y"}
    named = '<n:a xmlns:n="u" n:k="1" k="2"><n:b/><m:b xmlns:m="v"/></n:a>'
    assert read(named) == {"a": {"-n": "u", "-k": "2", "b": ["", {"-m": "v"}]}}
    assert read(named, prefixes=True) == {"n:a": {"-xmlns:n": "u", "-n:k": "1", "-k": "2", "n:b": "", "m:b": {"-xmlns:m": "v"}}}
    assert read("<a k='1'>t</a>", attribute="@", content="$") == {"a": {"@k": "1", "$": "t"}}
    assert read("﻿ \n<?xml version='1.0'?><a/>") == {"a": ""}


def test_what_is_no_xml():
    lol = '<!DOCTYPE l [<!ENTITY a "ha"><!ENTITY b "&a;&a;&a;&a;&a;&a;&a;&a;">]><l>&b;</l>'
    for text in ("", " ", "plain", "<a>", "<a></b>", "<a/><b/>", "<a>&none;</a>", "<a b=1/>", "<a\0/>", lol, "<a>\ud800</a>"):
        assert read(text) is None, text


def test_long_and_deep_documents():
    began = time.time()
    wide = read("<a>" + "<b>x</b>" * 200_000 + "</a>")
    assert len(wide["a"]["b"]) == 200_000
    deep = xml_to_json("<a>" * 50_000 + "</a>" * 50_000)
    assert deep.count('{"a":') == 50_000 and time.time() - began < 20


names = st.sampled_from(["a", "b", "c"])
texts = st.text("xy <&é", max_size=5)


@st.composite
def elements(draw, depth=3):
    e = ElementTree.Element(draw(names), draw(st.dictionaries(names, texts, max_size=2)))
    e.text = draw(texts)
    for _ in range(draw(st.integers(0, 3)) if depth else 0):
        child = draw(elements(depth - 1))
        child.tail = draw(texts)
        e.append(child)
    return e


def expected(e):
    fields = {f"-{k}": v for k, v in e.attrib.items()}
    for c in e:
        fields.setdefault(c.tag, []).append(expected(c))
    fields = {k: v[0] if isinstance(v, list) and len(v) == 1 else v for k, v in fields.items()}
    words = " ".join(w.strip() for w in [e.text or "", *[c.tail or "" for c in e]] if w.strip())
    if not fields:
        return words
    return fields | ({"#content": words} if words else {})


@settings(max_examples=150, deadline=None)
@given(elements())
def test_any_document(e):
    assert read(ElementTree.tostring(e, "unicode")) == {e.tag: expected(e)}


def test_payloads(spark):
    rows = [(1, "<o id='7'><i><n>1</n></i><i><n>2</n></i><s>x</s></o>", "kept"), (2, "<other>t</other>", None), (3, "<bad", None), (4, None, None)]
    df = parse_any_xml(spark.createDataFrame(rows, "payload_id int, body string, extra string")).drop("body")
    assert df.where("payload is null").count() == 2 and "extra" in df.columns
    got = shape.to_samples(shape.descend(shape.payload_objects(df), ["o"])).collect()
    assert sorted((r["payload_id"], r["sample_ix"], *sorted(r["attrs"].items())) for r in got) == [
        (1, 0, ("-id", "7"), ("n", "1"), ("s", "x")), (1, 1, ("-id", "7"), ("n", "2"), ("s", "x")), (2, 0, ("other", "t")),
    ]
