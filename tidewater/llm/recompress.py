"""Substring dedup by recompression.

Rounds name runs and pairs of symbols, beginning with words: a run of equal
symbols becomes one symbol, then every neighbouring pair whose first symbol is
of the round's left half and whose second is of its right half becomes one. A
name is a hash of what it stands for, so equal strings get equal names in every
task without an exchange. For each symbol the words are known that its forming
depended on; a symbol whose words all lie inside a window is interior to it,
and equal windows have equal interior symbols wherever they stand.

A window's anchor is the one of least priority among its stretches of SPAN
interior symbols, which themselves are named once more (the window itself, if it
is so uniform that too few are interior). Spark then finds the anchors that
documents share: only their windows can repeat. These windows are taken as
96-bit hashes, the smallest document of each is found, and every document's
words in a window that a smaller one has are removed. Of equal texts only the
smallest document goes through this: all windows of the others are repeats.

A window belongs to one row; null and empty texts have none. A null doc_id
neither removes nor is removed. Rows that repeat a doc_id are one document to
the others and remove nothing from each other. Texts with fewer words than a
window are kept whole. An empty table gives no rows.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Scratch, id_text, mixed, run_hashes, word_hashes

WINDOW = 13
ROUNDS, SPAN = 1, 3        # words run and pair, then three symbols: some seven words of a window
ROWS = 256                  # texts in hand at once
BROADCAST_ROWS = 2_000_000  # ids of copies (24 bytes each) that are sent to all tasks
RUN = np.uint64(0xA24BAED4963EE407)
SECOND = 0xD1342543DE82EF95


class Symbols:
    """A parse: names, the words [start, end) they stand for, and the words [lo, hi) they depend on."""

    def __init__(self, h: np.ndarray, doc: np.ndarray):
        n = len(h)
        self.name, self.doc = h, doc
        self.start, self.end = np.arange(n), np.arange(1, n + 1)
        self.lo, self.hi = self.start.copy(), self.end.copy()

    def _neighbours(self):
        """Bounds of what the symbol before and after depends on; one word outside at a text's ends."""
        same = np.zeros(len(self.doc) + 1, bool)
        same[1:-1] = self.doc[1:] == self.doc[:-1]
        before = np.where(same[:-1], np.concatenate([self.lo[:1], self.lo[:-1]]), self.start - 1)
        after = np.where(same[1:], np.concatenate([self.hi[1:], self.hi[-1:]]), self.end + 1)
        return same, np.minimum(before, self.lo), np.maximum(after, self.hi)

    def _keep(self, at, name, last, lo, hi):
        self.name, self.doc, self.start, self.end = name, self.doc[at], self.start[at], self.end[last]
        self.lo, self.hi = lo, hi

    def runs(self) -> None:
        if not len(self.name):
            return
        same, before, after = self._neighbours()
        new = np.ones(len(self.name), bool)
        new[1:] = (self.name[1:] != self.name[:-1]) | ~same[1:-1]
        at = np.flatnonzero(new)
        last = np.concatenate([at[1:], [len(new)]]) - 1
        size = (last - at + 1).astype(np.uint64)
        name = np.where(size > 1, mixed(self.name[at] + size * RUN), self.name[at])
        self._keep(at, name, last, before[at], after[last])

    def pairs(self, rnd: int) -> None:
        if not len(self.name):
            return
        same, before, after = self._neighbours()
        half = np.uint64(rnd * int(RUN) % (1 << 64))
        right = (mixed(self.name ^ half) & np.uint64(1)).astype(bool)
        first = np.zeros(len(right), bool)
        first[:-1] = ~right[:-1] & right[1:] & same[1:-1]
        second = np.zeros(len(right), bool)
        second[1:] = first[:-1]
        at = np.flatnonzero(~second)
        last = at + first[at]
        paired = last > at
        name = np.where(paired, mixed(mixed(self.name[at] + np.uint64(rnd)) + self.name[last]), self.name[at])
        # a left symbol stayed alone because of the next one, a right symbol because of the one before
        lo = np.where(paired | ~right[at], self.lo[at], before[at])
        hi = np.where(paired, self.hi[last], np.where(right[at], self.hi[at], after[at]))
        self._keep(at, name, last, lo, hi)


def parse(h: np.ndarray, doc: np.ndarray, rounds: int = ROUNDS) -> Symbols:
    s = Symbols(h, doc)
    s.runs()
    for rnd in range(1, rounds + 1):
        s.pairs(rnd)
    return s


def windows(doc: np.ndarray, size: int = WINDOW) -> np.ndarray:
    """Where windows start: size words of one text."""
    n = len(doc) - size + 1
    return np.flatnonzero(doc[:n] == doc[size - 1:]) if n > 0 else np.zeros(0, np.int64)


def anchors(h: np.ndarray, doc: np.ndarray, at: np.ndarray, size: int = WINDOW) -> np.ndarray:
    """The name of each window's anchor."""
    s, n = parse(h, doc), len(h)
    below = np.cumsum(np.bincount(s.lo + 1, minlength=n + 2))       # symbols that depend on a word before p
    within = np.cumsum(np.bincount(np.minimum(s.hi, n + 1), minlength=n + 2))
    first, last = below[at], within[at + size] - SPAN               # first symbols of stretches inside the window
    name = s.name
    if len(name) >= SPAN:
        name = run_hashes(s.name, SPAN)
    rank = mixed(name ^ RUN)
    most = int((last - first).max(initial=-1)) + 1
    far = np.iinfo(np.uint64).max
    padded = np.concatenate([rank, np.full(most + 1 + SPAN, far, np.uint64)])
    best, who = np.full(len(at), far, np.uint64), np.full(len(at), -1, np.int64)
    for k in range(most):
        r = np.where(first + k <= last, padded[first + k], far)
        better = r < best
        np.copyto(best, r, where=better)
        np.copyto(who, first + k, where=better)
    out = np.where(who >= 0, name[np.maximum(who, 0)] if len(name) else np.uint64(0), np.uint64(0))
    alone = np.flatnonzero(who < 0)
    if len(alone):
        out[alone] = run_hashes(h, size)[at[alone]] ^ RUN
    return out


def _words(texts: list[bytes]):
    """All words of some texts in a row, and the text each belongs to."""
    lists = [t.split() for t in texts]
    doc = np.repeat(np.arange(len(lists)), [len(x) for x in lists])
    return lists, [w for x in lists for w in x], doc


def _texts(batches, *columns):
    """Small slices: (texts as bytes, other columns)."""
    for whole in batches:
        for k in range(0, whole.num_rows, ROWS):
            b = whole.slice(k, ROWS)
            texts = [x.as_py() for x in b.column(b.schema.get_field_index("text")).cast(pa.binary())]
            yield (texts, *(b.column(b.schema.get_field_index(c)) for c in columns))


def anchor_rows(docs: DataFrame, size: int = WINDOW) -> DataFrame:
    """(anchor, doc_id) of all windows, once for each anchor and row."""
    def run(batches):
        for texts, ids in _texts(batches, "doc_id"):
            _, words, doc = _words(texts)
            at = windows(doc, size)
            if not len(at):
                continue
            a, d = anchors(word_hashes(words), doc, at, size), doc[at]
            order = np.lexsort((a, d))
            a, d = a[order], d[order]
            new = np.ones(len(a), bool)
            new[1:] = (a[1:] != a[:-1]) | (d[1:] != d[:-1])
            yield pa.RecordBatch.from_arrays([pa.array(a[new].view(np.int64)), ids.take(pa.array(d[new]))],
                                             names=["anchor", "doc_id"])
    return docs.filter("doc_id is not null").select("doc_id", "text").mapInArrow(run, "anchor long, doc_id long")


def window_rows(docs: DataFrame, size: int = WINDOW) -> DataFrame:
    """(h1, h2, doc_id) of the windows with one of the row's ``shared`` anchors, once for each row."""
    def run(batches):
        for texts, ids, shared in _texts(batches, "doc_id", "shared"):
            _, words, doc = _words(texts)
            at = windows(doc, size)
            if not len(at):
                continue
            h = word_hashes(words)
            a = anchors(h, doc, at, size)
            keep = np.zeros(len(at), bool)
            edges = np.searchsorted(doc[at], np.arange(len(texts) + 1))
            for k, (s, e) in enumerate(zip(edges, edges[1:])):
                if e > s:
                    keep[s:e] = np.isin(a[s:e], shared[k].values.to_numpy().view(np.uint64))
            at = at[keep]
            h1, h2 = run_hashes(h, size)[at].view(np.int64), (run_hashes(h, size, SECOND)[at] >> np.uint64(33)).astype(np.int32)
            d = doc[at]
            order = np.lexsort((h1, d))
            h1, h2, d = h1[order], h2[order], d[order]
            new = np.ones(len(d), bool)
            new[1:] = (h1[1:] != h1[:-1]) | (d[1:] != d[:-1])
            yield pa.RecordBatch.from_arrays([pa.array(h1[new]), pa.array(h2[new]), ids.take(pa.array(d[new]))],
                                             names=["h1", "h2", "doc_id"])
    return docs.select("doc_id", "text", "shared").mapInArrow(run, "h1 long, h2 int, doc_id long")


def covered(h: np.ndarray, repeated: np.ndarray, size: int = WINDOW) -> np.ndarray:
    """Which words stand in a window with one of the hashes."""
    hit = np.isin(run_hashes(h, size).view(np.int64), repeated)
    edge = np.zeros(len(h) + 1, np.int64)
    edge[:len(hit)] += hit
    edge[size:size + len(hit)] -= hit
    return np.cumsum(edge[:-1]) > 0


def copies(docs: DataFrame, scratch: Scratch) -> DataFrame:
    """(doc_id, k1, k2) of rows whose whole text a smaller document has."""
    marks = scratch.write(docs.filter("doc_id is not null").select("doc_id", "k1", "k2"), "marks")
    first = marks.groupBy("k1", "k2").agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last")).filter("first < last")
    return scratch.write(marks.join(first.select("k1", "k2", "first"), ["k1", "k2"]).filter("doc_id > first")
                         .select("doc_id", "k1", "k2").distinct(), "copies")


def marked(docs: DataFrame) -> DataFrame:
    """128 bits of the sha256 of each text beside it, as two longs."""
    half = lambda k: F.conv(F.substring("_sha", k, 16), 16, -10).cast("long")
    return docs.withColumn("_sha", F.sha2(F.col("text").cast("binary"), 256)).withColumns(
        {"k1": half(1), "k2": half(17)}).drop("_sha")


def repeats(docs: DataFrame, scratch: Scratch, size: int = WINDOW) -> DataFrame:
    """(doc_id, repeated array<long>): hashes of each document's windows that a smaller document has."""
    seen = scratch.write(anchor_rows(docs, size), "anchors")
    shared = scratch.write(seen.groupBy("anchor").agg(F.min("doc_id").alias("a"), F.max("doc_id").alias("b"))
                           .filter("a < b").select("anchor"), "shared")
    scratch.release()
    near = scratch.write(seen.join(shared, "anchor").groupBy("doc_id").agg(F.collect_set("anchor").alias("shared")), "near")
    scratch.drop("anchors", "shared")
    scratch.release()
    texts = docs.filter("doc_id is not null").join(near.hint("shuffle_hash"), "doc_id")
    found = scratch.write(window_rows(texts, size), "windows")
    scratch.drop("near")
    scratch.release()
    first = scratch.write(found.groupBy("h1", "h2").agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last"))
                          .filter("first < last").select("h1", "h2", "first"), "first")
    scratch.release()
    out = scratch.write(found.join(first, ["h1", "h2"]).filter("doc_id > first")
                        .groupBy("doc_id").agg(F.collect_set("h1").alias("repeated")), "repeated")
    scratch.drop("windows", "first")
    scratch.release()
    return out


def dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = WINDOW) -> DataFrame:
    """(doc_id, n_words, n_removed, kept) of every row; kept: its remaining words joined by one space."""
    return _strip(id_text(docs, id_col, text_col), size)


def cleaned(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = WINDOW) -> DataFrame:
    """All columns of every row, repeated words removed from the text; a text that lost none is unchanged."""
    other = [c for c in docs.columns if c != text_col]
    src = docs.select(
        F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"),
        F.col(text_col).alias("original"), F.struct(*other).alias("row"))
    done = _strip(src, size, ["original", "row"])
    text = F.when(F.col("n_removed") > 0, F.col("kept")).otherwise(F.col("original")).alias(text_col)
    return done.select(*[text if c == text_col else F.col("row")[c].alias(c) for c in docs.columns])


def _strip(src: DataFrame, size: int, extra: list[str] = []) -> DataFrame:  # noqa: B006
    scratch = Scratch(src.sparkSession, "recompress")
    src = marked(src)
    again = copies(src, scratch)
    # the ids of copies are few enough to go to the texts, or the texts go to them
    small = again.count() <= BROADCAST_ROWS
    again = F.broadcast(again) if small else again.hint("shuffle_hash")
    keys = ["doc_id", "k1", "k2"]
    found = repeats(src.select("text", *keys).join(again, keys, "left_anti").select("doc_id", "text"), scratch, size)
    # a row without id joins nothing

    @F.pandas_udf("n_words long, n_removed long, kept string")
    def strip(text: pd.Series, repeated: pd.Series, copy: pd.Series) -> pd.DataFrame:
        n, gone, kept = [], [], []
        for t, marks, whole in zip(text, repeated, copy):
            words = t.encode().split()
            n.append(len(words))
            out = None
            if len(words) < size:
                pass
            elif whole:
                words, out = [], np.ones(n[-1], bool)
            elif marks is not None:
                out = covered(word_hashes(words), np.asarray(marks, np.int64), size)
                words = [w for w, x in zip(words, out.tolist()) if not x]
            gone.append(int(out.sum()) if out is not None else 0)
            kept.append(b" ".join(words).decode())
        return pd.DataFrame({"n_words": n, "n_removed": gone, "kept": kept})

    both = (src.join(found.hint("shuffle_hash"), "doc_id", "left")
            .join(again.withColumn("copy", F.lit(True)), keys, "left"))
    done = strip("text", "repeated", F.coalesce("copy", F.lit(False))).alias("s")
    return both.select("doc_id", *extra, done).select("doc_id", *extra, "s.*")


def digests(docs: DataFrame) -> DataFrame:
    """The query's row per document."""
    return dedup(docs).select("doc_id", "n_words", "n_removed",
                              F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))
