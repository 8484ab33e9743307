"""Cases in which earlier versions lost something."""

import base64
import bz2
import time
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from samplecraft.llm import html_text, nearest, secrets

SECRET = b"password=abcDEF123456xyz"


def kinds(text: bytes):
    return {(k, a, b) for a, k, b in secrets.all_matches(text)}


def test_secrets_in_odd_wrappings():
    wide = "password=abcDEF123456xyz".encode("utf-16-le")
    raw = zlib.compressobj(9, zlib.DEFLATED, -15)
    packed = raw.compress(SECRET) + raw.flush()
    for name, body in {
        "latin": b"caf\xe9 " + SECRET, "binary": bytes(range(7, 32)) + SECRET + bytes(range(128, 160)), "wide": wide, "raw": packed,
        "bzip2": bz2.compress(SECRET), "small window": zlib.compress(SECRET, 9, 9),
    }.items():
        coded = base64.b64encode(body).rstrip(b"=")
        # a stream without a head can only be told where something says that it begins
        for head in (b"", b"/a/", b"x/y/") if name == "raw" else (b"", b"/a/", b"ab", b"/x/y/z"):
            text = b"see " + head + coded + b" here"
            found = kinds(text)
            assert any(k == 0 for k, _, _ in found), (name, head)
            assert all(4 <= a < b <= len(text) - 5 for _, a, b in found), (name, head)


def test_equal_layers_with_other_spans():
    one = base64.b64encode(SECRET + b" " * 9)
    assert len([k for k in kinds(one + b" . " + one) if k[0] == 0]) == 2


def test_deep_escapes_take_linear_time():
    began = time.time()
    deep = b"%" + b"25" * 500_000 + b"41"
    found = kinds(b"token=" + deep + b"BCDEFGHIJKLMNOP")
    assert (0, 0, len(b"token=") + len(deep) + 15) in found and time.time() - began < 5


ARTICLE = "".join(f"<p>Sentence number {k} of the story tells how the boats came home, and what they brought.</p>" for k in range(8))
FRAME = "<nav><ul><li><a href='/'>Home</a></li><li><a href='/a'>About</a></li></ul></nav>{}<footer><p>Copyright, all rights reserved</p></footer>"


@pytest.fixture(scope="module")
def pages(spark):
    body = FRAME.format(f"<article><h1>Title</h1>{ARTICLE}</article>")
    made = {
        "open head": f"<html><head><title>t</title><meta name=x>{body}</html>",
        "named body": f"<html class='has-sidebar'><head><title>t</title></head><body class='page has-sidebar with-footer'>{body}</body></html>",
        "plain": f"<html><head><title>t</title></head><body>{body}</body></html>",
        "formula": "<html><body>" + body.replace("boats", "<math><mi>x</mi><mo>=</mo><mn>2</mn></math> <svg><text>boats</text></svg>") + "</body></html>",
        "noscript": "<html><body>" + body.replace("<p>Sentence number 3", "<noscript><p>kept without scripts, as it says</p></noscript><p>Sentence number 3") + "</body></html>",
        "long": "<html><body>" + FRAME.format(f"<article>{ARTICLE * 1300}</article>") + "</body></html>",
    }
    rows = [(k, name, html) for k in range(10) for name, html in made.items() if name != "long" or k == 0]
    return spark.createDataFrame([(n, r[1], r[2]) for n, r in enumerate(rows)], "page_id long, name string, html string").cache()


def test_whole_articles(pages):
    found = html_text.extract(pages, html_text.train(pages)).collect()
    for r in found:
        text = r["text"]
        n = 8 * 1300 if r["name"] == "long" else 8
        assert text.count("Sentence number") == n and "Home" not in text and "Copyright" not in text, (r["name"], text[:300])
        if r["name"] == "formula":
            assert "how the x=2 boats came home" in text
        if r["name"] == "noscript":
            assert "kept without scripts" in text


def test_every_query_has_its_neighbours(spark):
    rng = np.random.default_rng(5)
    centres = rng.standard_normal((12, 16)) * 50
    vectors = np.concatenate([centres[k] + rng.standard_normal((6 if k == 0 else 218, 16)) for k in range(12)])
    # a vector that a third of the rows share
    vectors = np.concatenate([vectors, np.repeat(vectors[:1] + 300, len(vectors) // 2, axis=0)])
    rows = [(k, v.tolist()) for k, v in enumerate(vectors)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    found = nearest.search(table, F.col("id") % 100 == 0).collect()
    asked = [k for k, _ in rows if k % 100 == 0]
    assert sorted(r["query_id"] for r in found) == sorted(asked * 10)
    hit = 0
    for q in asked:
        d = np.sqrt(((vectors - vectors[q]) ** 2).sum(1))
        d[q] = np.inf
        best = set(np.lexsort((np.arange(len(d)), d))[:10].tolist())
        hit += len(best & {r["vec_id"] for r in found if r["query_id"] == q})
    assert hit >= 0.9 * 10 * len(asked)
