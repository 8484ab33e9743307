"""Plain-Python statements of what the operators return, for small inputs."""

from __future__ import annotations

import hashlib
import re
import zlib
from collections import defaultdict


def lower(text: str) -> str:
    return re.sub("[A-Z]", lambda m: m[0].lower(), text)


def decontaminate(docs, items, size=13):
    def words(t):
        return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(t or ""))

    windows = defaultdict(set)
    for item, text in items:
        w = words(text)
        if item is None or not w:
            continue
        n = min(size, len(w))
        for k in range(len(w) - n + 1):
            windows[tuple(w[k : k + n])].add(item)
    sizes = {len(w) for w in windows}
    out = []
    for doc, text in docs:
        w, hit, found = words(text), set(), set()
        for n in sizes:
            for k in range(len(w) - n + 1):
                ids = windows.get(tuple(w[k : k + n]))
                if ids:
                    hit |= set(range(k, k + n))
                    found |= ids
        digest = hashlib.sha256(",".join(sorted(map(str, found))).encode()).hexdigest()
        out.append((doc, len(w), len(hit), len(found), digest, bool(hit) and 20 * len(hit) >= len(w)))
    return out


def shingles(text, size):
    w = re.findall(r"[^\x20\x09-\x0D]+", lower(text or ""))
    return {tuple(w[k : k + size]) for k in range(len(w) - size + 1)} if len(w) >= size else ({tuple(w)} if w else set())


def jaccard(docs, size=4, percent=85):
    sets = [shingles(t, size) for _, t in docs]
    root = list(range(len(docs)))

    def find(i):
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    by = defaultdict(list)
    for i, s in enumerate(sets):
        for g in s:
            by[g].append(i)
    common = defaultdict(int)
    for rows in by.values():
        for x in range(len(rows)):
            for y in range(x):
                common[rows[y], rows[x]] += 1
    for (i, j), c in common.items():
        if 100 * c >= percent * (len(sets[i]) + len(sets[j]) - c):
            root[find(i)] = find(j)
    least = {}
    for i, (doc, _) in enumerate(docs):
        if doc is not None:
            r = find(i)
            least[r] = min(least.get(r, doc), doc)
    return [(doc, len(sets[i]), least.get(find(i)) if sets[i] else doc) for i, (doc, _) in enumerate(docs)]


def tokens(docs, encode, end=2):
    out, start = [], 0
    for doc, text in sorted(docs, key=lambda d: (d[0] is not None, d[0] or 0)):
        ids = [*encode(text or ""), end]
        out.append((doc, start, len(ids), zlib.crc32(b"".join(i.to_bytes(4, "little") for i in ids))))
        start += len(ids)
    return out


def targets(sizes: dict, weights=(5, 2, 1), share=1.5, most=2.0):
    names = sorted((s for s in sizes if s is not None)) + ([None] if None in sizes else [])
    weight = {s: weights[k % len(weights)] for k, s in enumerate(names)}
    left, open_, target = share * sum(sizes.values()), set(names), {}
    while True:
        level = left / sum(weight[s] for s in open_) if open_ else 0
        above = {s for s in open_ if level * weight[s] > most * sizes[s]}
        if not above:
            return target | {s: level * weight[s] for s in open_}
        for s in above:
            target[s] = most * sizes[s]
            left -= target[s]
        open_ -= above


def warc(pages):
    rows = [(k, (h or "").encode()) for k, h in pages]
    first = {}
    for k, p in rows:
        if len(p) >= 100 and k is not None:
            first[p] = min(first.get(p, k), k)
    return [(k, len(p), hashlib.sha256(p).hexdigest(), "response" if first.get(p, k) == k else "revisit", None if first.get(p, k) == k else first[p]) for k, p in rows]


def secrets(docs):
    assign = re.compile(r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII)
    out = []
    for doc, text in docs:
        text = text or ""
        found = [(m.start(), 0, m.end()) for m in assign.finditer(text) if len(m[2]) >= 12]
        found += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 18]
        found += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 16]
        names = ("assign", "access", "hex")
        spans = ",".join(f"{names[k]}:{a}:{b}" for a, k, b in sorted(found))
        out.append((doc, *[sum(f[1] == k for f in found) for k in range(3)], hashlib.sha256(spans.encode()).hexdigest()))
    return out


def suffixes(docs, length=200):
    data = [(t or "").encode() for _, t in docs]
    seen = defaultdict(int)
    for d in data:
        for k in range(len(d) - length + 1):
            seen[d[k : k + length]] += 1
    out = []
    for (doc, _), d in zip(docs, data, strict=True):
        gone = bytearray(len(d))
        for k in range(len(d) - length + 1):
            if seen[d[k : k + length]] > 1:
                gone[k : k + length] = b"\1" * length
        spans = len(re.findall(b"\1+", bytes(gone)))
        kept = bytes(b for b, g in zip(d, gone, strict=True) if not g)
        out.append((doc, len(d), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return out
