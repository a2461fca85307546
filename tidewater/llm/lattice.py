"""LM scoring: the marginal likelihood of a subword lattice.

A document is its words (A-Z lower-cased) and one end. A word, with its start
mark, can be cut into pieces of an existing vocabulary in many ways; its
spelling probability is the sum over all of them of the product of the pieces'
probabilities, by the forward recursion in log space. A character without a
piece is the product of its bytes' pieces. The pieces' first weights come from
the vocabulary's own scores; ROUNDS of expectation-maximisation over all
distinct training words then move them to the corpus, with the first weights as
prior. A word seen c times in training is one arc of its own beside these: its
count less a discount, and the discounts of all words are shared out by spelling,

    P(word) = (max(c - d, 0) + d * distinct * spelling(word)) / tokens,

with d from the numbers of words seen once and twice, and the end as often as in
training. ``score`` is the log10 probability of the whole text under this model,
which sums to 1 over all texts. Without training rows it is the vocabulary's.
``lattice_score`` is the marginal by the vocabulary's own scores alone: the sum over
all cuts of every word, nothing learnt but how often a text ends.

Every word's count and lattice probability is computed once for the corpus:
tasks write a dictionary of distinct words for each block of documents, the
words are counted and scored as rows of one table, and each block gets its own
words' numbers back. Nothing that grows with the corpus is held by the driver.

``base_score`` is the add-0.1 unigram model over words. Null texts are empty
(one token: the end); null ids never train and are not held out; repeated rows
count and are scored each; an empty table gives no rows.
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Scratch, Shipped, held_out, id_text, remainder

FOLDS = 10
ALPHA = 0.1                     # of the base model
ROUNDS = 2
UNTRAINED_END = 1 / 500         # chance of the end without training rows
PRIOR = 1_000.0                 # pieces that the vocabulary's own weights count as
BLOCK_WORDS, BLOCK_BYTES = 600_000, 48_000_000
BASE = np.uint64(0x9E3779B97F4A7C15)
START = "▁"                # the vocabulary's mark of a word's start
SLOTS = np.uint64((1 << 17) - 1)    # low bits of a piece's hash that are looked up first
STRETCH = 4096                  # places of a long word whose arcs are held at once (more than a piece has)


class Pieces:
    """The vocabulary as sorted hashes by length, with a log weight for each piece."""

    def __init__(self, names: list[str], scores: list[float]):
        """Weights from the scores: a rank r (scores fall by 1 a rank) weighs 1 / (r + 2.7)."""
        self.byte = np.full(256, -1, np.int64)
        by: dict[int, list[tuple[int, int]]] = {}
        weight = np.zeros(len(names) + 1)
        for i, (n, s) in enumerate(zip(names, scores)):
            if len(n) == 6 and n.startswith("<0x") and n.endswith(">"):
                self.byte[int(n[3:5], 16)] = i
                weight[i] = 1e-7
            elif n.startswith("<") and n.endswith(">") and len(n) > 2:
                continue                                    # control symbols
            else:
                codes = np.array([[ord(x) for x in n]], np.uint64)
                by.setdefault(len(n), []).append((int(hashes(codes, len(n))[0, 0]), i))
                weight[i] = 1 / (2.7 + max(-s, 0))
        missing = self.byte < 0
        self.byte[missing] = len(names)
        weight[len(names)] = 1e-12
        self.longest = max(by)
        self.keys, self.ids, self.maybe = {}, {}, {}
        for n, pairs in by.items():
            pairs.sort()
            self.keys[n] = np.array([h for h, _ in pairs], np.uint64)
            self.ids[n] = np.array([i for _, i in pairs], np.int64)
            self.maybe[n] = np.zeros(int(SLOTS) + 1, bool)
            self.maybe[n][self.keys[n] & SLOTS] = True
        # words end where a piece with the start mark follows, so that spellings sum to 1
        self.first = weight / weight.sum()
        with np.errstate(divide="ignore"):
            self.log = self.first_log = np.log(self.first)

    def reestimate(self, counts: np.ndarray) -> None:
        with np.errstate(divide="ignore"):
            self.log = np.log((counts + PRIOR * self.first) / (counts.sum() + PRIOR))


def hashes(codes: np.ndarray, n: int) -> np.ndarray:
    """64-bit polynomial hashes of all stretches of n codes in each row."""
    out = None
    width = codes.shape[1] - n + 1
    for k in range(n):
        part = codes[:, k:k + width] + np.uint64(1)
        out = part if out is None else out * BASE + part
    return out ^ (out >> np.uint64(29))


@dataclass
class Arcs:
    """The arcs of words of one length, each at a word, from a place to a later one: pieces, and characters without one."""

    word: np.ndarray
    start: np.ndarray
    length: np.ndarray
    piece: np.ndarray
    bare_word: np.ndarray
    bare_start: np.ndarray
    bare_code: np.ndarray

    def before(self, end: int) -> Arcs:
        """Those that start before a place."""
        own, bare = self.start < end, self.bare_start < end
        return Arcs(self.word[own], self.start[own], self.length[own], self.piece[own],
                    self.bare_word[bare], self.bare_start[bare], self.bare_code[bare])


def codes_of(words: list[str]) -> np.ndarray:
    """(word, place): code points of words of one length, with their start marks."""
    text = "".join(START + w for w in words).encode("utf-32-le", "replace")
    return np.frombuffer(text, "<u4").reshape(len(words), -1)


def arcs(pieces: Pieces, codes: np.ndarray) -> Arcs:
    """Every piece in some codes (word, place)."""
    got, raw = [], None
    part = codes.astype(np.uint64) + np.uint64(1)
    single = np.zeros(codes.shape, bool)
    for k in range(1, min(pieces.longest, codes.shape[1]) + 1):
        raw = part if raw is None else raw[:, :-1] * BASE + part[:, k - 1:]     # as in hashes()
        if k not in pieces.keys:
            continue
        h, keys = raw ^ (raw >> np.uint64(29)), pieces.keys[k]
        word, start = np.nonzero(pieces.maybe[k][h & SLOTS])        # few others pass
        h = h[word, start]
        at = np.minimum(np.searchsorted(keys, h), len(keys) - 1)
        same = keys[at] == h
        word, start, own = word[same], start[same], pieces.ids[k][at[same]]
        if k == 1:
            single[word, start] = True
        got.append((word, start, np.full(len(word), k), own))
    bare = np.nonzero(~single)
    return Arcs(*map(np.concatenate, zip(*got)), *bare, codes[bare])


def spelt_out(pieces: Pieces, code: int) -> np.ndarray:
    """The bytes' pieces of a character."""
    return pieces.byte[list(chr(code).encode("utf-8", "replace"))]


def bare_weights(pieces: Pieces, found: Arcs, log: np.ndarray) -> np.ndarray:
    """Log weights of the characters without a piece."""
    odd, where = np.unique(found.bare_code, return_inverse=True)
    return np.array([log[spelt_out(pieces, int(c))].sum() for c in odd])[where] if len(odd) else np.zeros(0)


def _sum(x: np.ndarray) -> np.ndarray:
    top = x.max(axis=1)
    safe = np.where(np.isfinite(top), top, 0)
    with np.errstate(divide="ignore"):
        return np.log(np.exp(x - safe[:, None]).sum(axis=1)) + safe


def _forward(pieces: Pieces, codes: np.ndarray, logs: list[np.ndarray]) -> Iterator[tuple[np.ndarray, Arcs]]:
    """By stretch of places: (weights and word, place), the log of the summed weight of all ways to a place; and its arcs.

    Before its places a stretch holds the last ones of the stretch before, so a word of any length needs
    the arcs of one stretch at a time. Rows are the words by the first weights, then by the second, ...
    """
    n, size = codes.shape
    wide = min(pieces.longest, size)
    a = np.full((len(logs) * n, wide), -np.inf)
    a[:, -1] = 0                                            # place 0
    for s in range(0, size, STRETCH):
        e = min(s + STRETCH, size)
        o = max(s + 1 - wide, 0)                            # no arc to a place after s starts before o
        found = arcs(pieces, codes[:, o:e])
        lp = np.full((len(logs) * n, e - o + 1, wide), -np.inf)
        for k, log in enumerate(logs):
            lp[k * n + found.word, found.start + found.length, found.length - 1] = log[found.piece]
            lp[k * n + found.bare_word, found.bare_start + 1, 0] = bare_weights(pieces, found, log)
        a = np.concatenate([a[:, -wide:], np.empty((len(a), e - s))], axis=1)
        for j in range(e - s):
            # lengths 1..wide reach back to the wide places before
            a[:, wide + j] = _sum(lp[:, s + 1 + j - o, :] + a[:, j:wide + j][:, ::-1])
        yield a, found


def forward(pieces: Pieces, codes: np.ndarray, log: np.ndarray) -> tuple[np.ndarray, Arcs]:
    """(word, place): log of the summed weight of all ways to cut the words up to a place, 0 to the last.

    With the arcs of the last stretch: those of the whole words, if they are one stretch.
    """
    wide = min(pieces.longest, codes.shape[1])
    out = [np.zeros((len(codes), 1))]
    for a, found in _forward(pieces, codes, [log]):
        out.append(a[:, wide:])
    return np.concatenate(out, axis=1), found


def marginals(pieces: Pieces, words: list[str], logs: list[np.ndarray]) -> np.ndarray:
    """(weights, word): log of the summed weight of all cuts of words of one length."""
    for a, _ in _forward(pieces, codes_of(words), logs):
        last = a[:, -1]
    return last.reshape(len(logs), -1)


def expected(pieces: Pieces, words: list[str], weight: np.ndarray, counts: np.ndarray) -> None:
    """Adds each piece's expected number in words of one length (times their weights) to counts."""
    codes = codes_of(words)
    n, size = codes.shape
    wide = min(pieces.longest, size)
    a, found = forward(pieces, codes, pieces.log)
    total = a[:, -1]
    after = np.full((n, wide), -np.inf)                     # the places from the end of a stretch on
    after[:, 0] = 0
    for s in reversed(range(0, size, STRETCH)):
        e = min(s + STRETCH, size)
        if size > STRETCH:
            found = arcs(pieces, codes[:, s:e + wide - 1]).before(e - s)
        bare = bare_weights(pieces, found, pieces.log)
        lp = np.full((n, e - s, wide), -np.inf)             # by start
        lp[found.word, found.start, found.length - 1] = pieces.log[found.piece]
        lp[found.bare_word, found.bare_start, 0] = bare
        b = np.concatenate([np.empty((n, e - s)), after], axis=1)
        for j in reversed(range(e - s)):
            b[:, j] = _sum(lp[:, j, :] + b[:, j + 1:j + 1 + wide])
        after = b[:, :wide].copy()

        def share(word, start, length, log):
            return np.exp(a[word, s + start] + log + b[word, start + length] - total[word]) * weight[word]

        counts += np.bincount(found.piece, share(found.word, found.start, found.length, pieces.log[found.piece]), len(counts))
        odd, where = np.unique(found.bare_code, return_inverse=True)
        seen = np.bincount(where, share(found.bare_word, found.bare_start, 1, bare), len(odd))
        for c, x in zip(odd, seen):
            np.add.at(counts, spelt_out(pieces, int(c)), x)


def by_length(words: list[str], most: int = 200_000):
    """Indices of words of one length, in groups of a bounded number of characters."""
    size = np.fromiter(map(len, words), np.int64, len(words))
    order = np.argsort(size, kind="stable")
    edges = np.flatnonzero(np.diff(size[order], prepend=-1))
    for s, e in zip(edges, [*edges[1:], len(order)]):
        some = max(1, most // 8 // (int(size[order[s]]) + 1))
        for k in range(s, e, some):
            yield order[k:min(k + some, e)]


def read_pieces(model_file: str) -> Pieces:
    import sentencepiece
    sp = sentencepiece.SentencePieceProcessor(model_file=model_file)
    n = sp.get_piece_size()
    return Pieces([sp.id_to_piece(i) for i in range(n)], [sp.get_score(i) for i in range(n)])


BLOCK_SCHEMA = ("block string, kind int, word binary, local int, n long, doc_id long, held_out boolean, bag binary")


def blocks(docs: DataFrame) -> DataFrame:
    """Rows of two kinds: a block's distinct words with training counts (0), its documents as bags (1)."""
    kinds = pa.schema([("block", pa.string()), ("kind", pa.int32()), ("word", pa.binary()), ("local", pa.int32()),
                       ("n", pa.int64()), ("doc_id", pa.int64()), ("held_out", pa.bool_()), ("bag", pa.binary())])

    def run(batches):
        known: dict[bytes, int] = {}
        counts, rows, size = np.zeros(BLOCK_WORDS, np.int64), [], 0

        def emit():
            name = uuid.uuid4().hex     # one write of both kinds names the block; a repeated task writes both anew
            words = list(known)
            for k in range(0, len(words), 50_000):
                part = words[k:k + 50_000]
                m = len(part)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([name] * m), pa.array([0] * m, pa.int32()), pa.array(part, pa.binary()),
                     pa.array(np.arange(k, k + m, dtype=np.int32)), pa.array(counts[k:k + m]),
                     pa.nulls(m, pa.int64()), pa.nulls(m, pa.bool_()), pa.nulls(m, pa.binary())], schema=kinds)
            for k in range(0, len(rows), 2_000):
                yield pa.RecordBatch.from_pylist([dict(r, block=name, kind=1) for r in rows[k:k + 2_000]], schema=kinds)

        for b in batches:
            ids, trains, outs = b.column(0).to_pylist(), b.column(2).to_pylist(), b.column(3).to_pylist()
            for doc, text, train, out in zip(ids, b.column(1).cast(pa.binary()), trains, outs):
                text = text.as_py()
                words = text.lower().split()                # of bytes: A-Z, and the six white characters
                here = np.fromiter((known.setdefault(w, len(known)) for w in words), np.int64, len(words))
                own, tf = np.unique(here, return_counts=True)
                if len(known) > len(counts):
                    counts = np.concatenate([counts, np.zeros(max(len(known), len(counts)), np.int64)])
                if train:
                    counts[own] += tf
                step = np.diff(own, prepend=0)
                bag = zlib.compress(np.concatenate([step, tf]).astype("<u4").tobytes(), 1)
                rows.append({"doc_id": doc, "held_out": out, "bag": bag, "n": len(words)})
                size += len(text)
                if len(known) >= BLOCK_WORDS or size >= BLOCK_BYTES:
                    yield from emit()
                    known, rows, size = {}, [], 0
                    counts = np.zeros(BLOCK_WORDS, np.int64)
        if rows:
            yield from emit()

    return docs.mapInArrow(run, BLOCK_SCHEMA)


def learn(words: DataFrame, pieces: Pieces, rounds: int = ROUNDS) -> Pieces:
    """Rounds of expectation-maximisation over a table (word binary, c), each training word once."""
    for _ in range(rounds):
        sent = Shipped(words.sparkSession, pieces)          # bounded by the vocabulary
        size = len(pieces.log)

        def run(batches):
            mine, counts = sent.load(), np.zeros(size)
            for b in batches:
                texts = [w.as_py().decode("utf-8", "replace") for w in b.column(0)]
                for at in by_length(texts):
                    expected(mine, [texts[i] for i in at], np.ones(len(at)), counts)
            has = np.flatnonzero(counts)
            yield pa.RecordBatch.from_arrays([pa.array(has.astype(np.int32)), pa.array(counts[has])],
                                             names=["piece", "n"])

        got = (words.filter("c > 0").select("word").mapInArrow(run, "piece int, n double")
               .groupBy("piece").agg(F.sum("n").alias("n")).toPandas())      # at most one row a piece
        counts = np.zeros(size)
        counts[got["piece"].to_numpy()] = got["n"].to_numpy()
        pieces.reestimate(counts)
    return pieces


def scores(docs: DataFrame, model_file: str, id_col: str = "doc_id", text_col: str = "text", folds: int = FOLDS,
           rounds: int = ROUNDS) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score, lattice_score) of every row."""
    spark = docs.sparkSession
    scratch = Scratch(spark, "lattice")
    src = id_text(docs, id_col, text_col).select(
        "doc_id", "text", F.coalesce(remainder("doc_id", folds) != 0, F.lit(False)).alias("train"),
        held_out("doc_id", folds).alias("held_out"))
    rows = scratch.write(blocks(src), "blocks")
    bags = rows.filter("kind = 1")
    trained = F.coalesce(remainder("doc_id", folds) != 0, F.lit(False))
    ends = bags.filter(trained).count()
    words = scratch.write(rows.filter("kind = 0").groupBy("word").agg(F.sum("n").alias("c")), "words")
    number = lambda x: F.coalesce(F.sum(x.cast("long")), F.lit(0))
    c = F.col("c")
    seen, types, once, twice = map(int, words.agg(number(c), number(c > 0), number(c == 1), number(c == 2)).first())
    tokens, distinct = seen + ends, types + (ends > 0)
    discount = min(max(once / (once + 2 * twice), 0.05), 0.95) if once else 0.5
    scratch.release()
    pieces = learn(words, read_pieces(model_file), rounds if types else 0)
    sent = Shipped(spark, pieces)

    def likelihood(batches):
        mine = sent.load()
        for b in batches:
            texts = [w.as_py().decode("utf-8", "replace") for w in b.column(0)]
            out, own = np.zeros(len(texts)), np.zeros(len(texts))
            for at in by_length(texts):
                out[at], own[at] = marginals(mine, [texts[i] for i in at], [mine.log, mine.first_log])
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(out / np.log(10)), pa.array(own / np.log(10))],
                                             names=["word", "c", "lp", "own"])

    scored = words.select("word", "c").mapInArrow(likelihood, "word binary, c long, lp double, own double")
    numbers = (rows.filter("kind = 0").select("block", "word", "local").join(scored, "word")
               .select("block", F.lit(0).alias("kind"), "local", F.col("c").alias("n"), "lp", "own",
                       F.lit(None).cast("long").alias("doc_id"), F.lit(None).cast("boolean").alias("held_out"),
                       F.lit(None).cast("binary").alias("bag")))
    both = (numbers.unionByName(bags.select(
        "block", "kind", F.lit(0).alias("local"), "n", F.lit(0.0).alias("lp"), F.lit(0.0).alias("own"),
        "doc_id", "held_out", "bag"))
        .repartition("block").sortWithinPartitions("block", "kind"))
    low = float(np.log10(ALPHA / (tokens + ALPHA * (distinct + 1))))
    scale = tokens + ALPHA * (distinct + 1)
    end_base = float(np.log10((ends + ALPHA) / scale))
    end_score = float(np.log10(ends / tokens)) if ends else float(np.log10(UNTRAINED_END))
    going_on = float(np.log10(1 - 10 ** end_score)) if end_score else 0.0

    def score(batches):
        block, count, logp, ownp = None, *np.zeros((3, 0))
        for b in batches:
            names = b.column(0).to_pylist()
            kinds = b.column(1).to_numpy()
            local, n, lp, by_own = (b.column(k).to_numpy(zero_copy_only=False) for k in (2, 3, 4, 5))
            docs_, outs, bags_ = (b.column(k).to_pylist() for k in (6, 7, 8))
            got = []
            edges = [i for i in range(len(names)) if i == 0 or names[i] != names[i - 1]] + [len(names)]
            for s, e in zip(edges, edges[1:]):
                if names[s] != block:
                    block, count, logp, ownp = names[s], *np.zeros((3, 0))
                words_ = np.arange(s, e)[kinds[s:e] == 0]
                if len(words_):
                    top = int(local[words_].max()) + 1
                    if top > len(count):
                        count, logp, ownp = (np.concatenate([x, np.zeros(top - len(x))]) for x in (count, logp, ownp))
                    count[local[words_]], logp[local[words_]], ownp[local[words_]] = n[words_], lp[words_], by_own[words_]
                for i in np.arange(s, e)[kinds[s:e] == 1]:
                    x = np.frombuffer(zlib.decompress(bags_[i]), "<u4").astype(np.int64)
                    own, tf = np.cumsum(x[:len(x) // 2]), x[len(x) // 2:]
                    c = count[own]
                    base = np.where(c > 0, np.log10((c + ALPHA) / scale), low)
                    if ends and types:
                        with np.errstate(divide="ignore"):
                            arc = np.log10(np.maximum(c - discount, 0) / tokens)
                        spelt = logp[own] + np.log10(discount * types / tokens)
                        top = np.maximum(arc, spelt)
                        word = top + np.log10(10 ** (arc - top) + 10 ** (spelt - top))
                    else:
                        word = logp[own] + going_on
                    got.append({"doc_id": docs_[i], "held_out": outs[i], "n_tokens": int(n[i]) + 1,
                                "n_known": int(tf[c > 0].sum()) + (ends > 0), "train_tokens": tokens,
                                "base_score": float((tf * base).sum() + end_base),
                                "score": float((tf * word).sum() + end_score),
                                "lattice_score": float((tf * (ownp[own] + going_on)).sum() + end_score)})
            yield pa.RecordBatch.from_pylist(got, schema=result)

    result = pa.schema([("doc_id", pa.int64()), ("held_out", pa.bool_()), ("n_tokens", pa.int64()),
                        ("n_known", pa.int64()), ("train_tokens", pa.int64()), ("base_score", pa.float64()),
                        ("score", pa.float64()), ("lattice_score", pa.float64())])
    return both.mapInArrow(score, "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, "
                                  "base_score double, score double, lattice_score double")
