"""Operators on pages and vectors."""

import brute
import numpy as np
import pytest
from pyspark.sql import functions as F

from samplecraft.llm import html_text, nearest, warc

LONG = "<p>" + "word " * 30 + "</p>"
PAGES = [
    (4, "http://a.example/x y", LONG, "k"),
    (2, "http://a.example/2", LONG, "k"),
    (9, None, LONG, "k"),
    (3, "http://a.example/3", None, "k"),
    (5, "http://a.example/5", "", "k"),
    (6, "http://a.example/6", "tiny", "k"),
    (7, "http://a.example/7", "tiny", "k"),
    (8, "http://a.example/\n8", "é\r\n\r\nWARC/1.1\r\n" * 20, "k"),
    (10, "u", "x" * 500_000, "k"),
]


def test_warc(spark):
    pages = spark.createDataFrame(PAGES, "page_id long, url string, html string, key string")
    got = warc.read_warc(warc.convert(warc.to_arc(pages)))
    rows = [tuple(r)[:5] for r in got.collect()]
    assert sorted(map(repr, rows)) == sorted(map(repr, brute.warc([(p[0], p[2]) for p in PAGES])))
    again = warc.read_warc(warc.convert(warc.to_arc(pages)))
    assert sorted(r["record_id"] for r in again.collect()) == sorted(r["record_id"] for r in got.collect())
    twice = warc.read_warc(warc.convert(warc.to_arc(pages.unionByName(pages.where("page_id = 2"))))).collect()
    assert sorted(r["record_type"] for r in twice if r["page_id"] == 2) == ["response"] * 2
    nameless = pages.select(F.lit(None).cast("long").alias("page_id"), "url", "html")
    assert {r["record_type"] for r in warc.read_warc(warc.convert(warc.to_arc(nameless))).collect()} == {"response"}
    assert warc.read_warc(warc.convert(warc.to_arc(pages.limit(0)))).isEmpty()


@pytest.mark.parametrize("version", [1, 2])
def test_arc_versions(version):
    name = "old.arc"
    blocks = [b"HTTP/1.1 200 OK\r\n\r\nbody with\nline ends\n", b"", b"plain text, no message"]
    data = warc.arc_version_block(name, version) + b"".join(warc.arc_record(version, f"http://x/{k}", b, 0, name) for k, b in enumerate(blocks))
    found = list(warc.parse_arc(data))
    assert [bytes(c) for _, c in found] == blocks
    assert [f["URL"] for f, _ in found] == ["http://x/0", "http://x/1", "http://x/2"]
    assert all(len(f) == len(warc.FIELDS[version].split()) for f, _ in found)
    with pytest.raises(ValueError):
        list(warc.parse_arc(data[:-10]))


def page(k: int) -> str:
    words = [f"w{(k * 31 + j * 17) % 997}" for j in range(60)]
    body = "".join(f"<p>{' '.join(words[j : j + 15])}</p>" for j in range(0, 60, 15))
    return (
        f"<!DOCTYPE html><html><head><title>t</title><script>if (a < b) c('</p>')</script></head><body><nav><ul><li><a href=/a>{words[0]}</a></li></ul></nav>"
        f'<div class="ad">{" ".join(words[5:12])}</div><article><h1>{words[1]} &amp; {words[2]}</h1>{body}</article><footer>&copy; {words[3]}</footer></body></html>'
    )


def test_html_blocks():
    found = html_text.blocks('<div class="topMenu">A<br>b &lt;c&gt; <b>d</b>\n e<p>one<p>two</div> tail<!-- x --><style>p{}</style><img src="a>b"> end')
    assert [(b[1]) for b in found] == ["A b <c> d e", "one", "two", "tail end"]
    assert found[0][0] == ("<div>", "top", "menu")
    assert html_text.blocks("") == [] and html_text.blocks("<script>never closed") == []
    assert html_text.blocks("a < b & c &unknown; <") [0][1] == "a < b & c &unknown; <"
    assert len(html_text.blocks("<li>" * 3000 + "x")) == 1


def test_html_text(spark):
    pages = spark.createDataFrame([(k, f"u{k}", page(k), "own") for k in range(60)], "page_id long, url string, html string, text string")
    labeller = html_text.train(pages)
    odd = spark.createDataFrame([(100, "u", None, "x"), (101, "u", "", "x"), (102, "u", "<nav>only menu</nav>", "x"), (103, None, page(3), "x")], pages.schema)
    rows = {r["page_id"]: r for r in html_text.extract(pages.unionByName(odd), labeller).collect()}
    for k in (0, 7, 59):
        words = [f"w{(k * 31 + j * 17) % 997}" for j in range(60)]
        lines = [f"{words[1]} & {words[2]}", *[" ".join(words[j : j + 15]) for j in range(0, 60, 15)]]
        assert rows[k]["text"] == "\n".join(lines) and rows[k]["n_chars"] == len(rows[k]["text"])
    assert [rows[k]["text"] for k in (100, 101, 102)] == ["", "", ""] and rows[103]["text"] == rows[3]["text"]
    assert html_text.extract(pages.limit(0), html_text.train(pages.limit(0))).isEmpty()


def test_html_gradients():
    """The gradients of the labeller agree with differences of its loss."""
    pages = [[((f"<{t}>",), f"words {t} {k}", 0.0) for k, t in enumerate("abcab")], [(("<p>", "x"), "one two", 0.5)]]
    goal = np.array([1.0, 0, 1, 0, 1, 0])
    labeller = html_text.Labeller()
    slots, bounds, dense, starts = html_text.features(pages)
    dense = dense.astype(float)
    grads = labeller._gradients(slots, bounds, dense, starts, goal)

    def loss() -> float:
        total = 0.0
        for d in [0]:
            states = []
            for k in "fb":
                padded, mask = labeller._padded(labeller._inputs(k, slots, bounds, dense), starts, np.arange(2))
                states.append(labeller._run(k, padded, mask, False)[0])
            p = html_text._sigmoid(np.concatenate(states, axis=2) @ labeller.p["out"] + labeller.p["bias"])
            target, _ = labeller._padded(goal[:, None], starts, np.arange(2))
            t = target[..., 0]
            total -= (np.where(mask, t * np.log(p) + (1 - t) * np.log(1 - p), 0)).sum() / mask.sum()
        return total

    for name in ("again_f", "again_b", "dense_f", "dense_b", "out"):
        at = np.unravel_index(np.abs(grads[name]).argmax(), grads[name].shape)
        kept = labeller.p[name][at]
        labeller.p[name][at] = kept + 1e-5
        up = loss()
        labeller.p[name][at] = kept - 1e-5
        down = loss()
        labeller.p[name][at] = kept
        assert abs((up - down) / 2e-5 - grads[name][at]) < 1e-5


def exact(vectors, wanted, k):
    out = []
    for i, v in vectors.items():
        if wanted(i):
            near = sorted((float(np.sqrt(((np.array(v) - np.array(w)) ** 2).sum())), j) for j, w in vectors.items() if j != i)
            out += [(i, n + 1, j, d) for n, (d, j) in enumerate(near[:k])]
    return out


def test_nearest_small(spark):
    rng = np.random.default_rng(1)
    good = {k: rng.standard_normal(12).astype(np.float32).tolist() for k in range(0, 300, 5)}
    good |= {k: good[100] for k in (1, 2, 3, 400)}
    odd = [(900, None), (901, [0.0] * 12), (902, [float("nan")] + [1.0] * 11), (903, [None] + [1.0] * 11), (904, [float("inf")] * 12), (905, [1.0]), (906, []), (None, [1.0] * 12), (100, good[100])]
    table = spark.createDataFrame([*good.items(), *odd], "vec_id long, embedding array<float>")
    got = nearest.search(table.withColumn("list", F.lit(1)), F.col("id") % 100 == 0, 10).collect()
    want = exact(good, lambda i: i % 100 == 0, 10)
    assert [(r["query_id"], r["rank"], r["vec_id"]) for r in sorted(got, key=lambda r: (r["query_id"], r["rank"]))] == [w[:3] for w in sorted(want)]
    few = nearest.search(table.where("vec_id in (100, 5, 900)"), F.col("id") == 100, 10).collect()
    assert [(r["query_id"], r["vec_id"]) for r in few] == [(100, 5)]
    assert nearest.search(table.limit(0), F.col("id") % 100 == 0, 10).isEmpty()


def test_nearest_recall_and_hot_list(spark, monkeypatch):
    """Lists cut into parts; a third of all vectors are equal."""
    monkeypatch.setattr(nearest, "PART_ROWS", 300)
    monkeypatch.setattr(nearest, "PART_QUERIES", 8)
    rng = np.random.default_rng(2)
    vectors = {k: rng.standard_normal(24).tolist() for k in range(2400)} | {k: [0.5] * 24 for k in range(2400, 3600)}
    table = spark.createDataFrame(list(vectors.items()), "vec_id long, embedding array<double>")
    got = nearest.search(table, F.col("id") % 100 == 0, 10).collect()
    want = exact(vectors, lambda i: i % 100 == 0, 10)
    found, true = {(r["query_id"], r["vec_id"]) for r in got}, {(w[0], w[2]) for w in want}
    assert len(found & true) >= 0.9 * len(true)
    assert {(r["vec_id"], r["score"]) for r in got if r["query_id"] == 2500} == {(k, 0.0) for k in range(2400, 2410)}
