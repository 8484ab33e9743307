"""HTML extraction by a recurrent block labeller: a bidirectional LSTM in numpy reads a page's blocks in order.

A page is cut into blocks: the text between two block-level tags, with its path of open elements. Script, style, head
and similar contents, comments and markup are no text. Each block becomes a vector: the sum of learnt embeddings of the
hashed names on its path (tags, and words of class, id and role), its hashed words, and its length, share of link text,
punctuation and place. One LSTM reads the sequence forwards and one backwards, so that every block is judged in the
context of the whole page; a logistic unit on both states says whether it is main text.

The labeller is trained here, on about ``TRAIN_PAGES`` pages picked by hash, without given labels: a block is a negative
example if a name on its path says so (``BOILERPLATE``). As pages of one corpus use few names, each training page is
varied: blocks of other pages' text are put in under negative and under neutral paths made from the listed names.

Texts of all blocks are kept in page order; nothing is cut or capped. White space is that of `str.split`.

Edge cases: null and empty pages give an empty text, as do pages without main blocks; unclosed and stray tags are
tolerated; repeated rows are extracted each; extra columns are kept, and the columns added here replace columns of
the same name.
"""

from __future__ import annotations

import html
import re
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from samplecraft.llm.common import UNSPACED, bounded_sample, find_words, lower_ascii, slices, span_hashes

TRAIN_PAGES = 200
VARIANTS = 3
#: Blocks of a long page that a varied training page holds.
WINDOW = 80
NAMES = 2048
WORDS = 64
HIDDEN = 24
EPOCHS = 12
BATCH = 32

# Element classes of HTML.
_INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q ruby rp rt s samp small span strike strong sub sup time tt u var wbr "
    # formulas and drawings within a line, and what stands in their elements
    "math mrow mi mn mo ms mtext mfrac msup msub msubsup msqrt mroot mover munder munderover mstyle mpadded semantics annotation svg g text tspan path".split()
)
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_HIDDEN = frozenset("script style head title template iframe textarea select option".split())
_RAW = frozenset("script style textarea title iframe".split())
#: Elements that may stand in a head; any other ends it.
_IN_HEAD = frozenset("base link meta title style script noscript template".split())
_NO_NESTING = {
    "p": ("p",),
    "li": ("li",),
    "dt": ("dt", "dd"),
    "dd": ("dt", "dd"),
    "tr": ("tr", "td", "th"),
    "td": ("td", "th"),
    "th": ("td", "th"),
}

#: Names that make a block a negative example for training, anywhere on its path.
BOILERPLATE = (
    "nav navbar navigation menu menubar submenu breadcrumb breadcrumbs topbar header masthead banner footer foot bottom colophon copyright "
    "aside sidebar side rail widget widgets related recommended trending popular promo promotion promoted sponsor sponsored advert adverts "
    "advertisement advertising ad ads adbox adsense adslot notice notices cookie cookies consent gdpr alert popup modal overlay subscribe "
    "subscription newsletter signup login register form search searchbox button toolbar share sharing social follow comment comments reply "
    "replies respond discussion disqus feedback pagination pager skip legal disclaimer tags tagcloud"
).split()
_NEGATIVE_TAGS = "nav header footer aside form button menu dialog fieldset".split()
_NEUTRAL = "article main content post entry story text body section page wrapper container column row inner primary block document detail paragraph".split()
_NEUTRAL_TAGS = "article main section div".split()
_LEAVES = "p p p p h2 h3 li blockquote pre td dd div figcaption".split()

_TAG = re.compile(r"<(?:!--.*?(?:-->|\Z)|!\[CDATA\[.*?(?:\]\]>|\Z)|[!?][^>]*(?:>|\Z)|(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)(?:>|\Z))", re.DOTALL)
_NAMED = re.compile(r"""(?:^|\s)(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.IGNORECASE)
_PARTS = re.compile(r"[a-z]+")

Block = tuple[tuple[str, ...], str, float]


@lru_cache(maxsize=50_000)
def _names(tag: str, attributes: str) -> tuple[str, ...]:
    """Names an element puts on the path: its tag, and the words of its class, id and role; of ``html`` and ``body``, whose
    names say something about the whole page and nothing about a block, the tag alone."""
    if tag in ("html", "body"):
        return (f"<{tag}>",)
    split = [re.sub(r"(?<=[a-z])(?=[A-Z])", " ", "".join(m)) for m in _NAMED.findall(attributes)] if "=" in attributes else []
    return (f"<{tag}>", *[w for s in split for w in _PARTS.findall(s.lower())])


def blocks(page: str) -> list[Block]:
    """(names on the path, text, share of it within links) of each block with text, in page order."""
    out: list[Block] = []
    stack: list[tuple[str, tuple[str, ...]]] = []
    texts: list[str] = []
    linked = total = hidden = links = 0
    path: tuple[str, ...] | None = None
    at, end = 0, len(page)

    def close() -> None:
        nonlocal texts, linked, total, path
        if texts:
            text = " ".join(html.unescape("".join(texts)).split())
            if text:
                out.append((path, text, linked / max(1, total)))
            texts, linked, total, path = [], 0, 0, None

    def add(text: str) -> None:
        nonlocal total, linked, path
        if text and not hidden:
            if path is None and not text.isspace():
                path = tuple(n for _, names in stack for n in names)
            if path is not None:
                texts.append(text)
                total += len(text)
                linked += len(text) if links else 0

    while at < end:
        m = _TAG.search(page, at)
        if not m:
            add(page[at:])
            break
        if m.start() > at:
            add(page[at : m.start()])
        at = m.end()
        if m[2] is None:
            continue
        tag = m[2].lower()
        if tag not in _INLINE and tag not in _HIDDEN:
            close()
        elif tag in ("br", "img"):
            add(" ")
        if m[1]:
            if any(t == tag for t, _ in stack):
                while stack:
                    top, _ = stack.pop()
                    hidden -= top in _HIDDEN
                    links -= top == "a"
                    if top == tag:
                        break
            continue
        if tag in _VOID or m[3].endswith("/"):
            continue
        if tag not in _IN_HEAD and any(t == "head" for t, _ in stack):  # a head that was not closed ends here
            at_head = next(k for k, (t, _) in enumerate(stack) if t == "head")
            hidden -= sum(t in _HIDDEN for t, _ in stack[at_head:])
            links -= sum(t == "a" for t, _ in stack[at_head:])
            del stack[at_head:]
        if tag not in _INLINE and tag not in _HIDDEN:
            # A new block ends an unclosed paragraph, and a list item or cell the one before it.
            ended = _NO_NESTING.get(tag, ("p",))
            for k in range(len(stack) - 1, -1, -1):
                if stack[k][0] in ended:
                    links -= sum(t == "a" for t, _ in stack[k:])
                    del stack[k:]
                    break
                if stack[k][0] not in _INLINE:
                    break
        if tag in _RAW:
            stop = re.compile(rf"</{tag}\b[^>]*>", re.IGNORECASE).search(page, at)
            at = stop.end() if stop else end
            continue
        stack.append((tag, _names(tag, m[3])))
        hidden += tag in _HIDDEN
        links += tag == "a"
    close()
    return out


@lru_cache(maxsize=50_000)
def _name_slots(path: tuple[str, ...]) -> np.ndarray:
    return np.unique([zlib.crc32(n.encode()) % NAMES for n in path]).astype(np.int64)


def features(pages: list[list[Block]]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of all blocks of all pages: name slots end to end, where each block's slots start, dense values, page starts."""
    every = [b for page in pages for b in page]
    starts = np.concatenate([[0], np.cumsum([len(p) for p in pages])]).astype(np.int64)
    slots = [_name_slots(b[0]) for b in every]
    bounds = np.concatenate([[0], np.cumsum([len(s) for s in slots])]).astype(np.int64)
    dense = np.zeros((len(every), WORDS + 6), np.float32)
    if every:
        raw = [b[1].encode("utf-8", "replace") for b in every]
        data = lower_ascii(np.frombuffer(b"".join(raw), np.uint8))
        offsets = np.concatenate([[0], np.cumsum([len(r) for r in raw])]).astype(np.int64)
        first, last, before = find_words(data, offsets, UNSPACED)
        words = (span_hashes(data, first, last) % np.uint64(WORDS)).astype(np.int64)
        n = np.diff(before)
        row = np.repeat(np.arange(len(every)), n)
        counts = np.bincount(row * WORDS + words, minlength=len(every) * WORDS).reshape(-1, WORDS)
        dense[:, :WORDS] = counts / np.sqrt(np.maximum((counts * counts).sum(1), 1))[:, None]
        size = np.diff(offsets)
        marks = np.concatenate([[0], np.cumsum(np.isin(data, np.frombuffer(b".,;:!?", np.uint8)))])
        place = np.arange(len(every)) - np.repeat(starts[:-1], np.diff(starts))
        of = np.repeat(np.diff(starts), np.diff(starts))
        dense[:, WORDS:] = np.stack([np.log1p(size) / 5, np.log1p(n) / 4, [b[2] for b in every], (marks[offsets[1:]] - marks[offsets[:-1]]) / np.maximum(n, 1), place / np.maximum(of, 1), np.ones(len(every))], axis=1)
    return (np.concatenate(slots) if slots else np.zeros(0, np.int64)), bounds, dense, starts


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


class Labeller:
    """Parameters: for each direction name embeddings, dense and recurrent weights into the four gates; output weights."""

    def __init__(self, seed: int = 3):
        r = np.random.default_rng(seed)
        self.p = {}
        for d in "fb":
            self.p[f"names_{d}"] = r.standard_normal((NAMES, 4 * HIDDEN)) * 0.1
            self.p[f"dense_{d}"] = r.standard_normal((WORDS + 6, 4 * HIDDEN)) * 0.1
            self.p[f"again_{d}"] = r.standard_normal((HIDDEN, 4 * HIDDEN)) / np.sqrt(HIDDEN)
        self.p["out"] = r.standard_normal(2 * HIDDEN) * 0.1
        self.p["bias"] = np.zeros(1)

    def _inputs(self, d: str, slots: np.ndarray, bounds: np.ndarray, dense: np.ndarray) -> np.ndarray:
        x = dense @ self.p[f"dense_{d}"]
        if len(slots):
            sums = np.add.reduceat(self.p[f"names_{d}"][slots], np.minimum(bounds[:-1], len(slots) - 1), axis=0)
            x += np.where((np.diff(bounds) > 0)[:, None], sums, 0)
        return x

    def _run(self, d: str, x: np.ndarray, mask: np.ndarray, keep: bool):
        """States of one direction over (steps, pages, gates); masked steps carry the state on."""
        steps, n, _ = x.shape
        h, c = np.zeros((n, HIDDEN), x.dtype), np.zeros((n, HIDDEN), x.dtype)
        states, trace = np.zeros((steps, n, HIDDEN), x.dtype), []
        for t in range(steps) if d == "f" else range(steps - 1, -1, -1):
            z = x[t] + h @ self.p[f"again_{d}"]
            gates = _sigmoid(z[:, : 3 * HIDDEN])
            i, f, o, g = gates[:, :HIDDEN], gates[:, HIDDEN : 2 * HIDDEN], gates[:, 2 * HIDDEN :], np.tanh(z[:, 3 * HIDDEN :])
            m = mask[t][:, None]
            new = f * c + i * g
            tc = np.tanh(new)
            if keep:
                trace.append((t, h, c, i, f, o, g, tc, m))
            h, c = np.where(m, o * tc, h), np.where(m, new, c)
            states[t] = h
        return states, trace

    @staticmethod
    def _padded(values: np.ndarray, starts: np.ndarray, which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        lengths = np.diff(starts)[which]
        steps = int(lengths.max())
        at = starts[which][None] + np.arange(steps)[:, None]
        mask = np.arange(steps)[:, None] < lengths[None]
        return values[np.where(mask, at, 0)] * mask[..., None].astype(values.dtype), mask

    def scores(self, pages: list[list[Block]]) -> list[np.ndarray]:
        """Of each page the probability of each block to be main text."""
        slots, bounds, dense, starts = features(pages)
        lengths, out = np.diff(starts), [np.zeros(0)] * len(pages)
        order = np.argsort(lengths, kind="stable")
        order = order[lengths[order] > 0]
        if not len(order):
            return out
        x = {d: self._inputs(d, slots, bounds, dense) for d in "fb"}
        at = 0
        while at < len(order):
            # Pages of like length go together, and fewer of them where pages are long.
            upto = at + 1
            while upto < len(order) and upto - at < 256 and (upto + 1 - at) * lengths[order[upto]] <= 20_000:
                upto += 1
            which = order[at:upto]
            states = []
            for d in "fb":
                padded, mask = self._padded(x[d], starts, which)
                states.append(self._run(d, padded, mask, False)[0])
            p = _sigmoid(np.concatenate(states, axis=2) @ self.p["out"] + self.p["bias"])
            for k, page in enumerate(which):
                out[page] = p[: lengths[page], k]
            at = upto
        return out

    def train(self, pages: list[list[Block]], labels: list[np.ndarray]) -> None:
        """Adam on the logistic loss, backwards through time."""
        slots, bounds, dense, starts = features(pages)
        flat = np.concatenate(labels).astype(float)
        order, step = np.random.default_rng(4), 0
        first, second = ({k: np.zeros_like(v) for k, v in self.p.items()} for _ in range(2))
        usable = np.flatnonzero(np.diff(starts) > 0)
        for _ in range(EPOCHS):
            shuffled = order.permutation(usable)
            shuffled = shuffled[np.argsort(np.diff(starts)[shuffled] // 8, kind="stable")]
            batches = [shuffled[k : k + BATCH] for k in range(0, len(shuffled), BATCH)]
            for b in order.permutation(len(batches)):
                which = batches[b]
                rows = np.concatenate([np.arange(starts[k], starts[k + 1]) for k in which])
                own = np.concatenate([np.arange(bounds[k], bounds[k + 1]) for k in rows])
                own_bounds = np.concatenate([[0], np.cumsum(np.diff(bounds)[rows])])
                own_starts = np.concatenate([[0], np.cumsum(np.diff(starts)[which])])
                grads = self._gradients(slots[own], own_bounds, dense[rows], own_starts, flat[rows])
                step += 1
                for k, g in grads.items():
                    first[k] = 0.9 * first[k] + 0.1 * g
                    second[k] = 0.999 * second[k] + 0.001 * g * g
                    self.p[k] -= 0.01 * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.999**step)) + 1e-8)
        self.p = {k: v.astype(np.float32) for k, v in self.p.items()}

    def _gradients(self, slots: np.ndarray, bounds: np.ndarray, dense: np.ndarray, starts: np.ndarray, goal: np.ndarray) -> dict[str, np.ndarray]:
        every = np.arange(len(starts) - 1)
        runs = {}
        for d in "fb":
            padded, mask = self._padded(self._inputs(d, slots, bounds, dense), starts, every)
            runs[d] = self._run(d, padded, mask, True)
        target, _ = self._padded(goal[:, None], starts, every)
        states = np.concatenate([runs["f"][0], runs["b"][0]], axis=2)
        error = np.where(mask, _sigmoid(states @ self.p["out"] + self.p["bias"]) - target[..., 0], 0) / mask.sum()
        grads = {"out": np.tensordot(error, states, 2), "bias": np.array([error.sum()])}
        into = error[..., None] * self.p["out"]
        for k, d in enumerate("fb"):
            again, grad_again = self.p[f"again_{d}"], np.zeros_like(self.p[f"again_{d}"])
            grad_x = np.zeros((*mask.shape, 4 * HIDDEN))
            dh, dc = np.zeros((len(every), HIDDEN)), np.zeros((len(every), HIDDEN))
            for t, h, c, i, f, o, g, tc, m in reversed(runs[d][1]):
                dh = dh + into[t][:, k * HIDDEN : (k + 1) * HIDDEN]
                here = np.where(m, dh, 0)
                cell = np.where(m, dc, 0) + here * o * (1 - tc * tc)
                z = np.concatenate([cell * g * i * (1 - i), cell * c * f * (1 - f), here * tc * o * (1 - o), cell * i * (1 - g * g)], axis=1)
                grad_x[t] = z
                grad_again += h.T @ z
                dh, dc = np.where(m, z @ again.T, dh), np.where(m, cell * f, dc)
            flat = np.concatenate([grad_x[: starts[p + 1] - starts[p], p] for p in every])
            names = np.zeros_like(self.p[f"names_{d}"])
            np.add.at(names, slots, np.repeat(flat, np.diff(bounds), axis=0))
            grads |= {f"again_{d}": grad_again, f"dense_{d}": dense.T @ flat, f"names_{d}": names}
        return {n: np.clip(g, -1, 1) for n, g in grads.items()}


_BAD = frozenset(BOILERPLATE) | {f"<{t}>" for t in _NEGATIVE_TAGS}


def weak_label(block: Block) -> bool:
    return not any(n in _BAD for n in block[0])


def varied(pages: list[list[Block]], seed: int = 6) -> list[list[Block]]:
    """Each page as it is, and ``VARIANTS`` times with foreign blocks under made-up paths, its own frame renamed."""
    r = np.random.default_rng(seed)
    foreign = [b[1] for page in pages for b in page][:: max(1, sum(map(len, pages)) // 4000)]
    out = list(pages)

    def pick(names) -> str:
        return str(names[r.integers(len(names))])

    def group() -> list[Block]:
        bad = r.random() < 0.5
        head = ["<html>", "<body>"] + [f"<{pick(_NEUTRAL_TAGS)}>", pick(_NEUTRAL)] * int(r.integers(0, 3))
        if bad:
            by_tag = r.random() < 0.35
            head += [f"<{pick(_NEGATIVE_TAGS)}>"] if by_tag else [f"<{pick(['div', 'section', 'ul', 'p', 'span', 'div'])}>", pick(BOILERPLATE)]
            head += [pick(BOILERPLATE + _NEUTRAL)] if r.random() < 0.3 else []
        else:
            head += [f"<{pick(_NEUTRAL_TAGS)}>"] + ([pick(_NEUTRAL)] if r.random() < 0.6 else [])
        link = float(r.random() < (0.5 if bad else 0.1)) * r.random()
        return [((*head, f"<{pick(_LEAVES)}>"), pick(foreign), link) for _ in range(int(r.integers(1, 6)))]

    for page in pages:
        for _ in range(VARIANTS):
            frame = f"<{pick(_NEUTRAL_TAGS)}>"
            # the whole page, in windows if it is long
            for at in range(0, len(page), WINDOW):
                new: list[Block] = []
                for names, text, link in page[at : at + WINDOW]:
                    if r.random() < 0.15:
                        new += group()
                    new.append((tuple(frame if n == "<article>" else n for n in names), text, link))
                out.append(new + (group() if r.random() < 0.5 else []))
    return out


def train(pages: DataFrame, key: str = "page_id", column: str = "html") -> Labeller:
    """A labeller from a bounded sample of pages."""
    sample = bounded_sample(pages.where(f"{column} is not null").select(key, column), key, TRAIN_PAGES).orderBy(F.xxhash64(key, column)).collect()
    known = varied([blocks(r[column]) for r in sample])
    labeller = Labeller()
    if any(known):
        labeller.train(known, [np.array([weak_label(b) for b in page], bool) for page in known])
    return labeller


def extract(pages: DataFrame, labeller: Labeller, column: str = "html") -> DataFrame:
    """``pages`` with ``text``, the main blocks joined by line ends, and ``n_chars``."""
    pages = pages.drop(*[c for c in ("text", "n_chars") if c != column])
    sent = pages.sparkSession.sparkContext.broadcast(labeller)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, column):
            cut = [blocks(p or "") for p in batch.column(batch.schema.get_field_index(column)).to_pylist()]
            texts = ["\n".join(b[1] for b, p in zip(page, scores, strict=True) if p >= 0.5) for page, scores in zip(cut, sent.value.scores(cut), strict=True)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], names=[*batch.schema.names, "text", "n_chars"])

    schema = pages.select("*", F.lit("").alias("text"), F.lit(0).cast("long").alias("n_chars")).schema
    return pages.mapInArrow(run, schema)
