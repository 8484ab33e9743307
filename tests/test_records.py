"""Huge files by record: small ones, read in very small blocks."""

import csv
import io
import json
import random

import pytest
from pyspark.sql import functions as F

from samplecraft.sources import records as R


@pytest.fixture
def tiny_blocks(spark):
    old = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    yield lambda n: [spark.conf.set(k, str(n)) for k in old]
    for k, v in old.items():
        spark.conf.set(k, v)


def element(draw, depth=3):
    text = lambda: "".join(draw.choice('ab,"\\[]{}\né ') for _ in range(draw.randrange(12)))
    kind = draw.randrange(7 if depth else 4)
    if kind < 4:
        return [text(), draw.randrange(1000), None, True][kind]
    if kind == 4:
        return [element(draw, depth - 1) for _ in range(draw.randrange(5))]
    return {text(): element(draw, depth - 1) for _ in range(draw.randrange(5))}


@pytest.mark.parametrize("size", [37, 200, 5000])
def test_json_arrays(spark, tmp_path, tiny_blocks, size):
    draw = random.Random(size)
    wanted = {}
    for k in range(6):
        items = [element(draw) for _ in range([0, 1, 40, 90, 3, 60][k])]
        head = [" \n", "", "", " " * 300, "", ""][k]
        text = head + json.dumps(items, indent=[None, 2, None, 1, None, None][k], ensure_ascii=k % 2 == 0) + ["", "\n", " \n ", "", "", ""][k]
        (tmp_path / f"{k}.json").write_text(text, encoding="utf-8")
        wanted[k] = [json.dumps(i, sort_keys=True) for i in items]
    whole = {"a": [1, 2, {"b": "],["}], "c": "x,y" * 40}
    (tmp_path / "6.json").write_text(json.dumps(whole))
    wanted[6] = [json.dumps(whole, sort_keys=True)]
    (tmp_path / "7.json").write_text("")
    tiny_blocks(size)
    found = R.read_json_array(spark, str(tmp_path))
    rows = found.orderBy("file", "block", "ix").collect()
    hashes = {r["h"]: int(r["p"][-6]) for r in spark.read.text(str(tmp_path), wholetext=True).select(F.col("_metadata.file_path").alias("p"), F.xxhash64("_metadata.file_path").alias("h")).collect()}
    got = {k: [] for k in wanted}
    for r in rows:
        got[hashes[r["file"]]].append(json.dumps(json.loads(r["body"]), sort_keys=True))
    assert got == wanted
    assert found.where("payload IS NULL").isEmpty()
    if size < 1000:
        assert found.select("file", "block").distinct().count() > 20


def test_unclosed_json(spark, tmp_path, tiny_blocks):
    (tmp_path / "a.json").write_text('[{"a":1},{"b":"x,y,')
    tiny_blocks(4)
    assert [r["body"] for r in R.read_json_array(spark, str(tmp_path)).orderBy("block", "ix").collect()] == ['{"a":1}', '{"b":"x,y']


@pytest.mark.parametrize("size", [23, 150])
@pytest.mark.parametrize("end", ["\n", "\r\n"])
def test_quoted_csv(spark, tmp_path, tiny_blocks, size, end):
    draw = random.Random(size)
    rows = [["id", "a,b", "c"]] + [[str(k)] + ["".join(draw.choice('xy,"\né ') for _ in range(draw.randrange(9))) for _ in range(2)] for k in range(150)]
    out = io.StringIO()
    csv.writer(out, lineterminator=end, quoting=csv.QUOTE_ALL).writerows(rows)
    (tmp_path / "a.csv").write_bytes(out.getvalue().encode())
    (tmp_path / "b.csv").write_bytes(f"p,q{end}1,2{end}{end}3{end}4,5{end}".encode())
    tiny_blocks(size)
    found = R.read_csv_records(spark, str(tmp_path))
    attrs = [dict(r["attrs"]) for r in found.orderBy("block", "ix").collect() if "id" in r["attrs"]]
    assert attrs == [dict(zip(rows[0], r, strict=True)) for r in rows[1:]]
    other = [(dict(r["attrs"]), r["error_msg"] is not None) for r in found.orderBy("block", "ix").collect() if "id" not in r["attrs"]]
    assert other == [({"p": "1", "q": "2"}, False), ({}, True)]
    given = R.read_csv_records(spark, str(tmp_path / "b.csv"), ["x", "y"])
    assert [dict(r["attrs"]) for r in given.orderBy("block", "ix").collect()] == [{"x": "p", "y": "q"}, {"x": "1", "y": "2"}, {}]


def test_records_of_a_file_are_not_dealt_by_file(spark, tmp_path):
    (tmp_path / "a.csv").write_text('k,v\n1,"x,\ny"\n2,z\n3\n4,w\n')
    for header in ([], ["k", "v"]):
        out = R.read_csv_records(spark, str(tmp_path), header)
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" not in plan and "BroadcastHashJoin" in plan
        rows = [r["attrs"] for r in out.orderBy("block", "ix").collect()]
        head = [{"k": "k", "v": "v"}] if header else []
        assert rows == [*head, {"k": "1", "v": "x,\ny"}, {"k": "2", "v": "z"}, {}]
