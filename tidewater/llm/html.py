"""HTML extraction: a recurrent block labeller.

A page becomes its sequence of leaf blocks: the texts between block-level tags,
each with the path of open tags (and their class, id and role words) above it.
A bidirectional LSTM in numpy reads a page's whole sequence - hashed tag-path
vector, vector of all its hashed words and a few sizes for each block - and labels every
block article or not with the context of the whole document. The main text is
the labelled blocks in page order.

The network is trained here: on a bounded sample of the pages themselves
(PAGES), labelled where their markup says what a block is, and on the same
pages with that markup renamed, shuffled and extended (sidebars, notices,
forms, comments), so that it also learns from place and wording. White space is
one space inside a block; blocks are joined by one space; character references
are decoded; scripts, styles, templates, comments and the head are no blocks. The
head ends with its end tag or before the first text or element it can't hold.

Null and empty html give the empty text. Repeated pages are extracted each;
null ids and urls are kept. An empty table gives no rows.
"""

from __future__ import annotations

import html as entities
import random
import re
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import hash_bound

PAGES = 400                     # pages in the training sample
PATH_DIM, WORD_DIM, HIDDEN = 48, 32, 16
EPOCHS, BATCH, RATE = 5, 16, 0.01
MAX_TRAIN_BLOCKS = 120          # a longer page trains as pieces of so many blocks

# fixed values of the HTML standard: elements
RAW = "script|style|textarea|iframe|title"              # without an end tag they run to the end of the page
UNSEEN = frozenset("noscript template svg".split())     # left out up to their end tag; without one only the tag itself
HEAD = frozenset("base link meta noscript script style template title".split())     # any other element ends the head
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset("a abbr b bdi bdo big cite code data dfn em font i kbd label mark q s samp small span strike strong "
                   "sub sup time tt u var wbr img".split())
CLOSES_P = frozenset("address article aside blockquote div dl fieldset footer form h1 h2 h3 h4 h5 h6 header hr main "
                     "nav ol p pre section table ul figure details".split())

# attributes by the rules of HTML: a quote opens a value only right after the equals sign; elsewhere it is a letter.
# Every part takes what it can and never gives back, and a piece that the page's end cuts off ends there, so a page is
# read once, whatever it is.
ATTRS = (r"(?:[\s/]++|[^\s/>][^\s/>=]*+(?:\s*+=\s*+(?:\"[^\"]*+(?:\"|\Z)|'[^']*+(?:'|\Z)|[^\s>\"'][^\s>]*+)?+)?+)*+")
PIECE = re.compile(r"<!--.*?(?:-->|\Z)|<(?P<raw>" + RAW + r")(?=[\s/>]|\Z)" + ATTRS + r"(?:>|\Z)(?:.*?</(?P=raw)(?=[\s/>])[^>]*+(?:>|\Z)|.*\Z)"
                   r"|<![^>]*+(?:>|\Z)|<\?[^>]*+(?:>|\Z)|</(?![a-zA-Z])[^>]*+(?:>|\Z)"
                   r"|<(?P<end>/?)(?P<tag>[a-zA-Z][^\s/>]*+)(?P<attr>" + ATTRS + r")(?:>|\Z)",
                   re.S | re.I)
NAMES = re.compile(r"""\b(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+))""", re.I)
PART = re.compile(r"[a-z]+")

# what markup words say of a block, for training labels
SAYS_NO = frozenset("nav header footer aside form button select menu sidebar ad ads advert advertisement banner promo "
                    "sponsor cookie notice consent newsletter subscribe comment comments reply discussion share social "
                    "related breadcrumb breadcrumbs login search popup modal toolbar copyright widget".split())
SAYS_YES = frozenset("article main post entry story content body".split())


def unseen(pieces: list) -> dict[int, int]:
    """The pieces where UNSEEN elements with an end tag start and end."""
    opened: dict[str, list[int]] = {t: [] for t in UNSEEN}
    spans: dict[int, int] = {}
    for k, m in enumerate(pieces):
        tag = (m["tag"] or "").lower()
        if tag in UNSEEN:
            if not m["end"]:
                if not m["attr"].endswith("/"):
                    opened[tag].append(k)
            elif opened[tag]:
                spans[opened[tag].pop()] = k
    return spans


def blocks(page: str) -> list[tuple[tuple[str, ...], str, int]]:
    """(path, text, characters in links) of every leaf block with text, in page order."""
    out, stack, buf, at, linked = [], [], [], 0, 0
    head = None                                             # where the head stands in the stack, while it is open

    def flush():
        nonlocal linked
        if buf:
            text = " ".join(entities.unescape("".join(buf)).split())
            if text:
                path = tuple(w for _, words in stack for w in words)
                out.append((path, text, linked))
            buf.clear()
        linked = 0

    def end_head():
        nonlocal head
        flush()
        del stack[head:]
        head = None

    def text(s: str):
        nonlocal linked
        if s:
            if head is not None and s.strip():
                end_head()
            buf.append(s)
            if any(t == "a" for t, _ in stack):
                linked += len(s)

    pieces = list(PIECE.finditer(page))
    spans, after = unseen(pieces), -1
    for piece, m in enumerate(pieces):
        if piece <= after:
            continue
        text(page[at:m.start()])
        at = m.end()
        tag = m["tag"]
        if tag is None:
            continue
        tag = tag.lower()
        if head is not None and not m["end"] and tag not in HEAD:
            end_head()
        if tag in UNSEEN:
            if piece in spans:
                after = spans[piece]
                at = pieces[after].end()
            continue
        if tag not in INLINE:
            flush()
        if m["end"]:
            if tag == "head":
                head = None
            for k in range(len(stack) - 1, -1, -1):
                if stack[k][0] == tag:
                    del stack[k:]
                    break
                if tag in INLINE and stack[k][0] not in INLINE:
                    break                                   # a stray inline end closes no block
        elif tag not in VOID and not m["attr"].endswith("/"):
            if tag in CLOSES_P:
                for k in range(len(stack) - 1, -1, -1):
                    if stack[k][0] == "p":
                        del stack[k:]
                        break
                    if stack[k][0] not in INLINE:
                        break
            words = [tag]
            if tag in ("html", "body"):
                words = []                                  # above every block: they say nothing of one
            elif m["attr"]:
                for a in NAMES.finditer(m["attr"]):
                    words += PART.findall((a[1] or a[2] or a[3] or "").lower())
            if tag == "head":
                head = len(stack)
            stack.append((tag, words))
    text(page[at:])
    flush()
    return out


def vectors(seq) -> np.ndarray:
    """One row per block: hashed path, hashed words, sizes."""
    x = np.zeros((len(seq), PATH_DIM + WORD_DIM + 4), np.float32)
    paths: dict[tuple, list[int]] = {}
    for k, (path, text, linked) in enumerate(seq):
        own = paths.get(path)
        if own is None:
            own = paths[path] = [crc32(w.encode()) % PATH_DIM for w in path]
        x[k, own] = 1.0
        words = text.lower().encode("utf-8", "replace").split()
        x[k, PATH_DIM:PATH_DIM + WORD_DIM] = np.bincount([crc32(w) % WORD_DIM for w in words], minlength=WORD_DIM) / len(words)
        x[k, -4] = np.log1p(len(text)) / 5
        x[k, -3] = min(linked / len(text), 1.0)
        x[k, -2] = (k + 1) / len(seq)
        x[k, -1] = 1.0 if text[-1] in ".!?" else 0.0
    return x


class Labeller:
    """Bidirectional LSTM with a logistic output; forward pass, and Adam over backpropagation in time."""

    def __init__(self, seed: int = 3):
        rng = np.random.default_rng(seed)
        d, h = PATH_DIM + WORD_DIM + 4, HIDDEN
        self.p = {}
        for way in "fb":
            self.p["W" + way] = (rng.normal(0, 1 / np.sqrt(d + h), (d + h, 4 * h))).astype(np.float32)
            bias = np.zeros(4 * h, np.float32)
            bias[h:2 * h] = 1.0                             # forget gates start open
            self.p["b" + way] = bias
        self.p["Wo"] = rng.normal(0, 0.2, (2 * h, 1)).astype(np.float32)
        self.p["bo"] = np.zeros(1, np.float32)

    def _run(self, x, mask, way, keep):
        """x (T, B, D), mask (T, B); states at padded places are passed through."""
        t_len, b, _ = x.shape
        h, w, bias = HIDDEN, self.p["W" + way], self.p["b" + way]
        d = x.shape[2]
        pre = x.reshape(-1, d) @ w[:d] + bias
        pre = pre.reshape(t_len, b, 4 * h)
        hs, c, s = np.zeros((t_len, b, h), np.float32), np.zeros((b, h), np.float32), np.zeros((b, h), np.float32)
        tape = []
        steps = range(t_len) if way == "f" else range(t_len - 1, -1, -1)
        for t in steps:
            z = pre[t] + s @ w[d:]
            gates = 1 / (1 + np.exp(-np.clip(z[:, :3 * h], -30, 30)))
            i, f, o = gates[:, :h], gates[:, h:2 * h], gates[:, 2 * h:]
            g = np.tanh(z[:, 3 * h:])
            m = mask[t][:, None]
            new = f * c + i * g
            tc = np.tanh(new)
            if keep:
                tape.append((t, c, s, i, f, o, g, tc, m))
            s = m * (o * tc) + (1 - m) * s
            c = m * new + (1 - m) * c
            hs[t] = s
        return hs, tape

    def forward(self, x, mask, keep=False):
        f, tf = self._run(x, mask, "f", keep)
        b, tb = self._run(x, mask, "b", keep)
        both = np.concatenate([f, b], axis=2)
        p = 1 / (1 + np.exp(-np.clip((both @ self.p["Wo"])[:, :, 0] + self.p["bo"], -30, 30)))
        return p, both, tf, tb

    def gradients(self, x, mask, y):
        p, both, tf, tb = self.forward(x, mask, True)
        h, d = HIDDEN, x.shape[2]
        e = ((p - y) * mask / max(mask.sum(), 1))[:, :, None]
        grads = {"Wo": np.einsum("tbh,tbo->ho", both, e), "bo": e.sum((0, 1))}
        back = e @ self.p["Wo"].T
        for way, tape, part in (("f", tf, back[:, :, :h]), ("b", tb, back[:, :, h:])):
            w = self.p["W" + way]
            dw, db = np.zeros_like(w), np.zeros(4 * h, np.float32)
            ds, dc = np.zeros((x.shape[1], h), np.float32), np.zeros((x.shape[1], h), np.float32)
            for t, c, s, i, f, o, g, tc, m in reversed(tape):
                ds = ds + part[t]
                dn, through = ds * m, ds * (1 - m)
                dnew = dn * o * (1 - tc ** 2) + dc * m
                z = np.concatenate([dnew * g * i * (1 - i), dnew * c * f * (1 - f), dn * tc * o * (1 - o),
                                    dnew * i * (1 - g ** 2)], axis=1)
                dw[:d] += x[t].T @ z
                dw[d:] += s.T @ z
                db += z.sum(0)
                ds = z @ w[d:].T + through
                dc = dnew * f + dc * (1 - m)
            grads["W" + way], grads["b" + way] = dw, db
        return grads

    def fit(self, pages: list[tuple[np.ndarray, np.ndarray]], seed: int = 5) -> "Labeller":
        rng = np.random.default_rng(seed)
        m = {k: np.zeros_like(v) for k, v in self.p.items()}
        v = {k: np.zeros_like(v) for k, v in self.p.items()}
        step = 0
        for _ in range(EPOCHS):
            order = sorted(rng.permutation(len(pages)), key=lambda i: len(pages[i][0]) // 8)
            batches = [order[k:k + BATCH] for k in range(0, len(order), BATCH)]
            for k in rng.permutation(len(batches)):
                x, mask = pad([pages[i][0] for i in batches[k]])
                y = np.zeros(mask.shape, np.float32)
                for j, i in enumerate(batches[k]):
                    y[:len(pages[i][1]), j] = pages[i][1]
                step += 1
                for name, g in self.gradients(x, mask, y).items():
                    g = np.clip(g, -1, 1)
                    m[name] = 0.9 * m[name] + 0.1 * g
                    v[name] = 0.999 * v[name] + 0.001 * g * g
                    self.p[name] = (self.p[name] - RATE * (m[name] / (1 - 0.9 ** step))
                                    / (np.sqrt(v[name] / (1 - 0.999 ** step)) + 1e-8)).astype(np.float32)
        return self

    def label(self, pages: list[np.ndarray]) -> list[np.ndarray]:
        """True for the blocks of the main text; pages of about equal length run together."""
        out: list = [np.zeros(0, bool)] * len(pages)
        order = sorted((i for i in range(len(pages)) if len(pages[i])), key=lambda i: len(pages[i]))
        at = 0
        while at < len(order):
            # as many pages as keep the padded batch small
            n = max(1, min(256, 60_000 // len(pages[order[min(at + 255, len(order) - 1)]])))
            some = order[at:at + n]
            p = self.forward(*pad([pages[i] for i in some]))[0]
            for j, i in enumerate(some):
                out[i] = p[:len(pages[i]), j] >= 0.5
            at += n
        return out


def pad(seqs: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    t = max(len(s) for s in seqs)
    x = np.zeros((t, len(seqs), seqs[0].shape[1]), np.float32)
    mask = np.zeros((t, len(seqs)), np.float32)
    for j, s in enumerate(seqs):
        x[:len(s), j] = s
        mask[:len(s), j] = 1
    return x, mask


def said(path: tuple[str, ...]) -> int:
    """What a path's markup says of its block: 1 article, 0 not, -1 nothing."""
    if any(w in SAYS_NO for w in path):
        return 0
    return 1 if any(w in SAYS_YES for w in path) else -1


def variants(page: list, rng: random.Random):
    """Labelled training sequences of one page: as it is, and with its markup changed."""
    labels = [said(path) for path, _, _ in page]
    if 1 not in labels:
        if 0 not in labels or -1 not in labels:
            return
        labels = [-v for v in labels]                       # no block says yes: those that don't say no are the article
    yield page, [max(v, 0) for v in labels]
    main = [b for b, v in zip(page, labels) if v == 1]
    rest = [b for b, v in zip(page, labels) if v != 1]
    wrap = rng.choice([("div", "content"), ("main",), ("div", "post"), ("section", "entry"), ("article",), ("div",)])
    tail = [tuple(w for w in path if w not in SAYS_YES) for path, _, _ in main]
    new = [(wrap + t, text, n) for t, (_, text, n) in zip(tail, main)]
    parts = [(b, 1) for b in new]

    def extra(paths, n, linked):
        got = []
        for _ in range(rng.randint(1, n)):
            _, text, _ = rng.choice(page)
            words = text.split()
            k = rng.randint(1, 14)
            s = rng.randint(0, max(len(words) - k, 0))
            text = " ".join(words[s:s + k]) or "x"
            got.append(((rng.choice(paths), text, len(text) if linked else 0), 0))
        return got

    before = [(b, 0) for b in rest if "footer" not in b[0]] + extra(
        [("nav", "ul", "li", "a"), ("header",), ("header", "div", "menu", "a"), ("div", "banner"), ("div", "cookie", "notice"),
         ("div", "breadcrumbs", "a"), ("div", "ad")], 4, rng.random() < 0.6)
    after = extra([("aside", "p"), ("div", "sidebar", "ul", "li"), ("section", "comments", "div", "comment", "p"),
                   ("div", "comments", "p"), ("form", "label"), ("form", "p"), ("div", "newsletter"), ("div", "related", "a"),
                   ("div", "share", "a"), ("aside", "div", "widget"), ("div", "ad")], 6, rng.random() < 0.4)
    after += [(b, 0) for b in rest if "footer" in b[0]]
    inside = extra([wrap + ("aside",), wrap + ("div", "ad"), wrap + ("form", "p"), wrap + ("nav", "a"), wrap + ("div", "share", "a"),
                    wrap + ("footer",), wrap + ("div", "notice")], 2, rng.random() < 0.5) if rng.random() < 0.5 else []
    for one in inside:
        parts.insert(rng.randint(0, len(parts)), one)
    all_ = before + parts + after
    yield [b for b, _ in all_], [y for _, y in all_]


def train(pages: DataFrame, html_col: str = "html", id_col: str = "page_id", sample: int = PAGES) -> Labeller:
    """From the ``sample`` pages with the smallest hashes of their ids; of an id's pages the least one.

    The hashes are bounded first, so that some ``2 * sample`` pages leave all tasks together,
    not ``sample`` pages each of them. Where too few have a html the bound is raised.
    """
    src = pages.select(F.xxhash64(F.col(id_col).cast("string")).alias("h"),
                       F.col(html_col).cast("string").alias("html"))
    ids = src.agg(F.approx_count_distinct("h")).first()[0]
    share = (2 * sample + 64) / max(ids, 1)
    while True:
        bound = hash_bound(share)
        some = src if bound is None else src.filter(F.col("h") < bound)
        rows = (some.filter("html is not null").groupBy("h").agg(F.min("html").alias("html"))
                .orderBy("h").limit(sample).toPandas())
        if bound is None or len(rows) >= sample:
            break
        share *= 8
    rng, data = random.Random(11), []
    for page in rows["html"]:
        for seq, y in variants(blocks(page), rng):
            x, y = vectors(seq), np.array(y, np.float32)
            for k in range(0, len(x), MAX_TRAIN_BLOCKS):
                data.append((x[k:k + MAX_TRAIN_BLOCKS], y[k:k + MAX_TRAIN_BLOCKS]))
    return Labeller().fit(data) if data else None


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
            model: Labeller | None = None, sample: int = PAGES) -> DataFrame:
    """(page_id, url, text, n_blocks, n_main) of every page, over its whole html."""
    model = model or train(pages, html_col, id_col, sample)
    src = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"),
                       F.coalesce(F.col(html_col).cast("string"), F.lit("")).alias("html"))

    def run(batches):
        for b in batches:
            for at in range(0, b.num_rows, 512):
                part = b.slice(at, 512)
                seqs = [blocks(h.as_py()) for h in part.column(2)]
                if model is None:                           # no page says what its blocks are: all of them
                    kept = [np.ones(len(s), bool) for s in seqs]
                else:
                    kept = model.label([vectors(s) for s in seqs])
                texts = [" ".join(t for (_, t, _), y in zip(s, k) if y) for s, k in zip(seqs, kept)]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.array(texts, pa.string()),
                     pa.array([len(s) for s in seqs], pa.int32()), pa.array([int(k.sum()) for k in kept], pa.int32())],
                    names=["page_id", "url", "text", "n_blocks", "n_main"])

    return src.mapInArrow(run, "page_id long, url string, text string, n_blocks int, n_main int")


def main_texts(pages: DataFrame) -> DataFrame:
    """The query's row per page."""
    return extract(pages).select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"),
                                 "n_blocks", "n_main")
