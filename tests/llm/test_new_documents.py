"""SimHash components, periodic runs and fill-in-the-middle against brute force."""

import hashlib
import random
import re
import zlib

import duckdb
import numpy as np
import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from samplecraft.llm import fill_middle, periods, simhash
from samplecraft.llm.queries import ORACLES, QUERIES, with_planted_periods

SF = "/root/testdata/sf0.001"
WORDS = r"[^\x20\x09-\x0D]+"
SCHEMA = "doc_id long, text string, fingerprint string, runs string, n string, id string, comp long"


def sentence(seed, words):
    return " ".join(f"w{(seed * 7919 + k * 104729) % 5003}" for k in range(words))


def rows():
    near = sentence(9, 300).split()
    group = [" ".join(near[:k] + [f"x{k}"] + near[k + 1 :]) for k in range(0, 300, 7)]
    body = [
        None,
        "",
        " \t\n",
        "one",
        "One  two",
        "a b c",
        "a\x0bB   c",
        sentence(1, 400),
        sentence(1, 400),
        sentence(1, 399) + " end",
        sentence(2, 40_000),
        "no<P>thing é 😀",
        "é😀" * 700 + " ünï",
        "to be or not " * 9,
        "a " * 500,
        *group,
    ]
    out = [(k, t, "f", "r", "n", "i", 7) for k, t in enumerate(body)]
    return [*out, out[7], (None, sentence(1, 400), "f", "r", "n", "i", 7), (None, None, None, None, None, None, None)]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(rows(), SCHEMA)


# ---------------------------------------------------------------- fingerprints


def fingerprint(text, size=3):
    w = re.findall(WORDS, re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    shingles = [w[k : k + size] for k in range(len(w) - size + 1)] if len(w) >= size else [w] if w else []
    hashes = [xxhash.xxh64_intdigest(" ".join(s).encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def components(prints):
    """Component number of each fingerprint, by all pairs."""
    root = list(range(len(prints)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, x in enumerate(prints):
        for j in range(i):
            if (x ^ prints[j]).bit_count() <= 2:
                root[max(find(i), find(j))] = min(find(i), find(j))
    return [find(i) for i in range(len(prints))]


def classes(pairs):
    prints = [fingerprint(t) for _, t in pairs]
    comps = components(prints)
    least = {}
    for (doc, _), c in zip(pairs, comps, strict=True):
        least[c] = min((d for d in (least.get(c), doc) if d is not None), default=None)
    return [(doc, f"{p:016x}", least[c]) for (doc, _), p, c in zip(pairs, prints, comps, strict=True)]


def test_simhash(docs):
    found = simhash.classes(docs)
    assert found.columns == ["doc_id", "fingerprint", "component_id"]
    want = classes([(r[0], r[1]) for r in rows()])
    assert sorted(map(repr, (tuple(r) for r in found.collect()))) == sorted(map(repr, want))
    assert simhash.classes(docs.limit(0)).isEmpty()


def test_long_texts_are_hashed_in_pieces(docs):
    one = docs.where("doc_id in (1, 4, 10, 12, 14)")
    assert sorted(simhash.fingerprints(one, long=50).collect()) == sorted(simhash.fingerprints(one).collect())


@pytest.mark.parametrize("bucket", [0, 1, 3, simhash.BUCKET])
def test_links_of_crowded_segments(spark, bucket):
    draw = random.Random(5)
    prints = {0, 2**64 - 1, 1 << 63}
    for _ in range(12):
        middle = draw.getrandbits(64)
        for _ in range(25):  # a crowd around a middle, in both segments and in one
            x = middle
            for _ in range(draw.randrange(4)):
                x ^= 1 << draw.choice([draw.randrange(64), draw.randrange(32), 32 + draw.randrange(32)])
            prints.add(x)
    prints = sorted(prints)
    table = spark.createDataFrame([(x - 2**64 if x >> 63 else x,) for x in prints], "fingerprint long")
    links = [(r["a"] % 2**64, r["b"] % 2**64) for r in simhash.links(table, bucket).collect()]
    assert all((a ^ b).bit_count() <= 2 for a, b in links)
    at = {x: k for k, x in enumerate(prints)}
    root = list(range(len(prints)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a, b in links:
        a, b = find(at[a]), find(at[b])
        root[max(a, b)] = min(a, b)
    assert [find(k) for k in range(len(prints))] == components(prints)


# ---------------------------------------------------------------- periodic runs


def runs_of(words, least=12):
    found = {}
    for q in range(1, len(words) // 2 + 1):
        k = 0
        while k < len(words) - q:
            if words[k] != words[k + q]:
                k += 1
                continue
            a = k
            while k < len(words) - q and words[k] == words[k + q]:
                k += 1
            if k + q - a >= max(least, 2 * q):
                found.setdefault((a, k + q), q)
    return sorted((a, e - a, q) for (a, e), q in found.items())


def collapse(words, runs):
    gone = {k for a, n, q in runs for k in range(a + q, a + n)}
    return " ".join(w for k, w in enumerate(words) if k not in gone)


def fibonacci(n):
    a, b = "a", "ab"
    while len(b) < n:
        a, b = b, b + a
    return b[:n]


def thue(n):
    return [str(k.bit_count() % 2) for k in range(n)]


PATTERNS = [
    list(fibonacci(700)),
    thue(4096) * 2,
    ["a"] * 300,
    ["a"] * 40 + ["b"] + ["a"] * 40 + ["b"] + ["a"] * 41,
    (list("abcabd") * 7 + ["x"]) * 5,
    list("ab") * 6,
    list("ab") * 5 + ["a"],
    [f"u{k}" for k in range(333)] * 3,
    ([f"u{k}" for k in range(50)] * 2 + ["y"]) * 4,
    [],
    ["only"],
]


def caught(words, cuts, least=12):
    numbers = np.array([{w: k for k, w in enumerate(dict.fromkeys(words))}[w] for w in words], np.int64)
    catchers = periods.Catchers(least)
    for a, b in zip([0, *cuts], [*cuts, len(words)], strict=True):
        catchers.append(numbers[a:b], b)
    return list(zip(*(c.tolist() for c in catchers.runs()), strict=True))


@pytest.mark.parametrize("k", range(len(PATTERNS)))
def test_catchers(k):
    words = PATTERNS[k]
    want = runs_of(words) if len(words) < 5000 else None
    whole = caught(words, [])
    if want is not None:
        assert whole == want
    else:
        assert whole[0] == (0, len(words), len(words) // 2) or (0, len(words), len(words) // 2) in whole
    draw = random.Random(k)
    for _ in range(5):
        cuts = sorted(draw.randrange(len(words) + 1) for _ in range(draw.randrange(9)))
        assert caught(words, cuts) == whole


@settings(max_examples=300, deadline=None)
@given(st.lists(st.tuples(st.text("abc", min_size=1, max_size=9), st.integers(1, 9)), max_size=8), st.lists(st.integers(0, 400), max_size=4), st.sampled_from([1, 4, 12]))
def test_catchers_on_repeated_pieces(pieces, cuts, least):
    words = [c for p, n in pieces for c in p * n]
    cuts = sorted(min(c, len(words)) for c in cuts)
    assert caught(words, cuts, least) == runs_of(words, least)


def test_word_by_word():
    words = list("abaabaabaabaab") + list("xyxyxyxyxyxyxy") + ["a"] * 20
    assert caught(words, list(range(1, len(words)))) == runs_of(words)


def test_periods(docs, spark):
    texts = [" ".join(p) for p in PATTERNS if len(p) < 5000]
    more = spark.createDataFrame([(1000 + k, t.replace(" ", "\t\n ")) for k, t in enumerate(texts)], "doc_id long, text string")
    table = docs.where("text is null or length(text) < 5000").unionByName(more, allowMissingColumns=True)
    pairs = [(r["doc_id"], re.findall(WORDS, r["text"] or "")) for r in table.collect()]
    want = [(doc, runs_of(w), collapse(w, runs_of(w))) for doc, w in pairs]
    found = periods.find(table)
    assert found.columns == ["doc_id", "runs", "collapsed"]
    got = [(r["doc_id"], [tuple(x) for x in r["runs"]], r["collapsed"]) for r in found.collect()]
    assert sorted(map(repr, got)) == sorted(map(repr, want))
    assert periods.find(docs.limit(0)).isEmpty()
    long = periods.find(docs.where("doc_id = 10")).first()
    assert long["collapsed"].split()[:5003] == sentence(2, 5003).split() and [r["period"] for r in long["runs"]] == [5003]


def planted(doc, text):
    w = re.findall(WORDS, text or "")
    if doc is None or zlib.crc32(str(doc).encode()) % 10 or not w:
        return w
    g = zlib.crc32(str(doc).encode()) // 10
    a = g % len(w)
    p = 1 + (len(w) - a) // (3 + g % 8)
    return [x if i < a else w[a + (i - a) % p] for i, x in enumerate(w)]


def test_periods_query(spark):
    table = duckdb.sql(f"select doc_id, text from '{SF}/documents.parquet'").fetchall()
    want = []
    for doc, text in table:
        w = planted(doc, text)
        if len(w) > 3000:
            continue
        runs = runs_of(w)
        best = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=(None, None, None))
        lines = "".join(f"{a},{n},{q}\n" for a, n, q in runs)
        milli = 1000 * best[1] // best[2] if runs else None
        want.append((doc, len(runs), *best, milli, *(hashlib.sha256(x.encode()).hexdigest() for x in (lines, collapse(w, runs)))))
    docs = {w[0] for w in want}
    found = QUERIES["op12_periods"](spark, SF).collect()
    assert len(found) == len(table) and len(docs) > 0.9 * len(table)
    assert sorted(tuple(r) for r in found if r["doc_id"] in docs) == sorted(want)
    assert sum(w[1] > 0 for w in want) > 10


def test_planted_periods(docs):
    got = {(r["doc_id"], r["text"]) for r in with_planted_periods(docs).collect()}
    assert got == {(r[0], None if r[1] is None else " ".join(planted(r[0], r[1]))) for r in rows()}


# ---------------------------------------------------------------- fill in the middle


def filled(doc, text, seed=1):
    d = hashlib.sha256(f"{seed}:{'' if doc is None else doc}".encode()).hexdigest()
    h = [int(d[8 * k : 8 * k + 8], 16) for k in range(4)]
    t = text or ""
    a, b = sorted((h[0] % (len(t) + 1), h[1] % (len(t) + 1)))
    if not t or any(s in t for s in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 90:
        return (doc, len(t), "plain", None, None, t, t)
    parts = ("spm", f"<S>{t[b:]}<P>{t[:a]}<M>{t[a:b]}") if h[3] % 100 < 20 else ("psm", f"<P>{t[:a]}<S>{t[b:]}<M>{t[a:b]}")
    return (doc, len(t), parts[0], a, b - a, parts[1], t)


def test_fill_middle(docs, spark):
    odd = ["<", "<P", "P><S", "<<M", ">", "<S", "<M><", "\u0000", "\U0010ffff߿ࠀ￿", "é", "日本語" * 11]
    more = [(100 + k, odd[k % len(odd)] * (1 + k // 40)) for k in range(400)]
    table = docs.unionByName(spark.createDataFrame(more, "doc_id long, text string"), allowMissingColumns=True)
    found = fill_middle.transform(table)
    assert found.columns == ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"]
    got = [tuple(r) for r in found.withColumn("back", fill_middle.restored()).collect()]
    want = [filled(r["doc_id"], r["text"]) for r in table.select("doc_id", "text").collect()]
    assert sorted(map(repr, got)) == sorted(map(repr, want))
    assert {r[2] for r in got} == {"plain", "psm", "spm"}
    assert fill_middle.transform(docs.limit(0)).isEmpty()
    plain = fill_middle.transform(table, share=0)
    assert {r["form"] for r in plain.collect()} == {"plain"}


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(max_size=40), min_size=1, max_size=6), st.integers(0, 2**32 - 1), st.integers(0, 2**32 - 1))
def test_cuts(texts, h1, h2):
    texts = [t.encode("utf-8", "ignore").decode() for t in texts]
    raw = [t.encode() for t in texts]
    offsets = np.concatenate([[0], np.cumsum([len(r) for r in raw])]).astype(np.int64)
    data = np.frombuffer(b"".join(raw), np.uint8)
    many = np.full(len(texts), h1), np.full(len(texts), h2)
    n, before, upto, x, y = fill_middle.cuts(data, offsets, *many)
    for k, t in enumerate(texts):
        a, b = sorted((h1 % (len(t) + 1), h2 % (len(t) + 1)))
        assert (n[k], before[k], upto[k]) == (len(t), a, b)
        assert x[k] - offsets[k] == len(t[:a].encode()) and y[k] - offsets[k] == len(t[:b].encode())


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "benchmark", "pages"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    want = con.execute(ORACLES[name])
    names = [d[0] for d in want.description]
    got = [tuple(r[c] for c in names) for r in QUERIES[name](spark, SF).collect()]
    assert sorted(map(repr, got)) == sorted(map(repr, want.fetchall()))
