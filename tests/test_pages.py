"""Page chains by the links that pages carry."""

import random

from pyspark.sql import functions as F

from samplecraft.sources.pages import chain_pages, next_page

SCHEMA = "request_id string, url string, next string, status int, body string, start boolean"


def followed(rows, most=0):
    """The same by walking."""
    pages = {}
    for r, u, q, s, b, start in rows:
        if r is not None and u is not None and s is not None and 200 <= s <= 299:
            pages.setdefault((r, u), (q, b, start))
    out = {}
    for r in {r for r, _ in pages}:
        starts = sorted(u for (x, u), p in pages.items() if x == r and p[2])
        at, n, seen = (starts[0] if starts else None), 0, set()
        while at is not None and (r, at) in pages and at not in seen and (not most or n < most):
            n += 1
            seen.add(at)
            out[r, at] = n
            q, b, _ = pages[r, at]
            at = None if '"items":[]' in (b or "") else q
    return out


def test_chains(spark):
    draw = random.Random(11)
    rows = []
    for r in ("a", "b", "c", "hot", None):
        size = 700 if r == "hot" else 40
        names = [f"p{k}" for k in range(size)]
        for k, name in enumerate(names):
            following = names[k + 1] if k + 1 < size else names[size // 2] if r != "a" else None
            if r != "hot" and draw.random() < 0.2:
                following = draw.choice([*names, "lost", None])
            status = 500 if r == "b" and k == 30 else 200
            body = '{"items":[]}' if r == "c" and k == 25 else f'{{"items":[{k}]}}'
            rows.append((r, name, following, status, body, k == 0))
        rows.append((r, None, "p0", 200, None, False))
        rows.append((r, names[1], rows[-size][2], 200, f'{{"items":[1]}}', False))
    rows += [("none", "x", "y", 200, None, False), ("self", "x", "x", 200, None, True), ("failed", "x", "y", 404, "", True), ("failed", "y", None, 200, "", None)]
    draw.shuffle(rows)
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    for most in (0, 17):
        out = chain_pages(df, F.col("next"), F.col("start"), payload_key="items", max_pages=most)
        got = out.collect()
        assert {(r["request_id"], r["url"]): r["page_no"] for r in got} == followed(rows, most)
        assert len(got) == len({(r["request_id"], r["url"]) for r in got})
        assert out.columns == [*df.columns, "page_no"]
    assert chain_pages(df.limit(0), F.col("next"), F.col("start")).isEmpty()


def test_next_page(spark):
    rows = [
        ('{"next":"/p?2","cur":7,"lim":50}', '<http://h/2>; rel="next"'),
        ('{"cur":"abc","lim":"9"}', '<http://h/3>;rel=next,<http://h/9>;rel=last'),
        ('{"other":1}', '<http://h/4>; rel="next"'),
        ("", None),
        (None, None),
    ]
    df = spark.createDataFrame(rows, "body string, link string")
    body, link = F.col("body"), F.col("link")
    every = next_page(body, "next", "http://h", cursor_key="cur", template="/u/${page}/${limit}", limit=20, limit_key="lim", link_header=link)
    own = next_page(body, cursor_key="cur", template="/u/${page}/${limit}", limit=20)
    got = [tuple(r) for r in df.select(every, own).collect()]
    assert got == [("http://h/p?2", "/u/7/20"), ("/u/abc/9", "/u/abc/20"), ("http://h/4", None), (None, None), (None, None)]
