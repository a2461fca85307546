"""Benchmark decontamination by latent semantic retrieval.

Documents and benchmark items are cut into overlapping passages of WINDOW words,
each a TF-IDF vector over hashed terms (document frequencies over the whole
corpus). A randomised SVD, its products with the passage matrix computed by
Spark tasks over the rows, gives RANK latent directions; it is fitted on every
passage of the benchmark and of the corpus. Texts are hashed once, into a table
that all later steps read. Every passage of every document is then projected and
compared by cosine with all benchmark passages, in blocks. A passage that is near
one and holds some of the item's rare words is checked in the text around it: the
longest common subsequence with the item, the share of the item's rare words,
and the answer (a column of the benchmark, or the item's last sentence). Long
subsequences are leaks; shorter ones are, as paraphrases, if the answer stands
there too.

Null and empty texts have no passages and are clean. Items without words match
nothing; repeated items count each under its id. Rows that repeat a doc_id are
judged each by its own text. A null doc_id is kept. An empty corpus gives no
rows, an empty benchmark leaves every document clean.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from itertools import groupby
from operator import itemgetter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Scratch, Shipped, id_text, lean, strings, word_hashes

TERM_BITS = 15
TERMS = 1 << TERM_BITS
WINDOW, STRIDE = 16, 8
RANK, OVERSAMPLE, POWER = 64, 16, 2
COSINE = 0.5
SHARED_RARE = 3                                 # rare words of the item in a candidate passage
COMPARED = 1_024                                # passages compared at once
FIT_BLOCKS = 1 << 16                            # blocks of STRIDE words in one product of the fit
FULL, PART, RARE = 0.7, 0.5, 0.5                # of the item's words in order; with the answer; of its rare words
MAX_BENCHMARK_BYTES = 200_000                   # broadcast up to this size; a larger benchmark goes in parts
# ASCII punctuation parts words; other letters and signs belong to them
PARTS = bytes(32 if not (48 <= c < 58 or 97 <= c < 123 or c == 95 or c > 127) else c for c in range(256))


def tokens(text: str) -> list[bytes]:
    return text.lower().encode("utf-8", "replace").translate(PARTS).split()


def buckets(words: list[bytes]) -> np.ndarray:
    """Hashed terms."""
    return (word_hashes(words) >> np.uint64(64 - TERM_BITS)).astype(np.int32)


def blocks(ids: np.ndarray) -> np.ndarray:
    """A text's hashed terms in rows of STRIDE, the last one filled up with TERMS."""
    out = np.full(-(-len(ids) // STRIDE) * STRIDE, TERMS, np.uint16)
    out[:len(ids)] = ids
    return out.reshape(-1, STRIDE)


def row_sums(at: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """``rows[at].sum(axis=1)``, some at a time, so that sums stay in the cache."""
    step = 1_024
    out = np.empty((len(at), rows.shape[1]), rows.dtype)
    held = np.empty((min(len(at), step), rows.shape[1]), rows.dtype)
    for k in range(0, len(at), step):
        columns, total = at[k:k + step].T, out[k:k + step]
        np.take(rows, columns[0], axis=0, out=total, mode="clip")
        for c in columns[1:]:
            total += np.take(rows, c, axis=0, out=held[:len(total)], mode="clip")
    return out


def passage_sums(ids: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Sum of each passage's rows, from sums of STRIDE words (``rows`` ends with a row of zeros).

    Passages are two blocks long and start at each block but the last; a text of one block is one.
    """
    part = row_sums(blocks(ids), rows)
    return part[:-1] + part[1:] if len(part) > 1 else part


def sliced(batch: pa.RecordBatch, rows: int = 1_000) -> Iterator[pa.RecordBatch]:
    """A batch in pieces: the JVM holds one at a time, outside its heap."""
    for k in range(0, batch.num_rows, rows):
        yield batch.slice(k, rows)


def hashed(texts: DataFrame) -> DataFrame:
    """(doc_id, mark: a hash of the text, text, terms: its hashed terms, two bytes each) of every row."""
    def run(batches):
        for b in batches:
            terms = pa.array([buckets(tokens(t)).astype("<u2").tobytes() for t in strings(b, "text")], pa.binary())
            yield from sliced(pa.RecordBatch.from_arrays([*b.columns, terms], names=["doc_id", "mark", "text", "terms"]))
    return texts.select("doc_id", F.xxhash64("text").alias("mark"), "text").mapInArrow(
        lean(run), "doc_id long, mark long, text string, terms binary")


def term_ids(batch: pa.RecordBatch) -> Iterator[np.ndarray]:
    """The hashed terms of each text."""
    for x in batch.column(batch.schema.get_field_index("terms")):
        yield np.frombuffer(x.as_buffer(), "<u2")


def few(rows: DataFrame) -> DataFrame:
    """As few partitions as keep all cores busy: each sends up to TERMS rows on."""
    return rows.coalesce(2 * rows.sparkSession.sparkContext.defaultParallelism)


def document_frequencies(texts: DataFrame) -> tuple[np.ndarray, int, int]:
    """Texts with each term, all texts with any, and their passages; summed in tasks, then by Spark."""
    def run(batches):
        count, n, passages = np.zeros(TERMS, np.int64), 0, 0
        for b in batches:
            for ids in term_ids(b):
                if len(ids):
                    own = np.sort(ids, kind="stable")
                    count[own[np.append(True, own[1:] != own[:-1])]] += 1
                    n += 1
                    passages += max(-(-len(ids) // STRIDE) - 1, 1)
        has = np.flatnonzero(count)
        yield pa.RecordBatch.from_arrays([pa.array(np.append(has, [-1, -2]).astype(np.int32)),
                                          pa.array(np.append(count[has], [n, passages]))], names=["term", "n"])
    got = few(texts.select("terms")).mapInArrow(lean(run), "term int, n long").groupBy("term").agg(F.sum("n").alias("n")).toPandas()
    out = np.zeros(TERMS + 2, np.int64)                 # the two sums stand last
    out[got["term"].to_numpy()] = got["n"].to_numpy()   # at most TERMS + 2 rows
    return out[:TERMS], int(out[-1]), int(out[-2])


def run_sums(at: np.ndarray, count: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Sums of ``rows[at]`` over runs of ``count`` each (``rows`` ends with a row of zeros), by groups of STRIDE."""
    groups = -(-count // STRIDE)
    start = np.cumsum(groups) - groups
    full = np.full((groups.sum() + 1) * STRIDE, len(rows) - 1)      # one group more: the next row of zeros
    full[np.arange(len(at)) + np.repeat(start * STRIDE - (np.cumsum(count) - count), count)] = at
    got = row_sums(full.reshape(-1, STRIDE), rows)
    out, many = got[start], groups > 1
    if many.any():
        out[many] = run_sums(np.flatnonzero(np.repeat(many, groups)), groups[many], got)
    return out


def add_products(ids: np.ndarray, own: np.ndarray, weight: np.ndarray, rows: np.ndarray, total: np.ndarray) -> None:
    """Adds A' A rows to ``total`` (by term), A holding the passages' term counts times their texts' weights.

    ``ids`` are the blocks of whole texts, ``own`` the text and ``weight`` the squared weight of each.
    A passage is two blocks of a text, so each block takes part in the passages before and after it.
    """
    for k in range(0, len(ids), FIT_BLOCKS):
        # one more block on each side, for the passages across the edges
        lo, hi = max(k - 1, 0), min(k + FIT_BLOCKS + 1, len(ids))
        x = row_sums(ids[lo:hi], rows)
        same = own[lo + 1:hi] == own[lo:hi - 1]
        y = x[:-1] + x[1:]
        y[~same] = 0
        z = np.zeros((len(x) + 1, x.shape[1]), x.dtype)     # its last row stays zero
        z[:-2] += y
        z[1:-1] += y
        alone = ~(np.append(same, False) | np.append(False, same))
        z[:-1][alone] = x[alone]
        del x, y
        z[:-1] *= weight[lo:hi, None]
        flat = ids[k:k + FIT_BLOCKS].ravel()
        order = np.argsort(flat, kind="stable")
        order = order[:np.count_nonzero(flat != TERMS)]     # without what fills up
        in_order = flat[order]
        first = np.flatnonzero(np.append(True, in_order[1:] != in_order[:-1]))
        count = np.diff(np.append(first, len(order)))
        total[in_order[first]] += run_sums(order // STRIDE + (k - lo), count, z)


def basis(texts: DataFrame, idf: np.ndarray, rank: int = RANK) -> np.ndarray:
    """The leading right singular vectors (TERMS x rank) of the TF-IDF passages of all texts (weight, terms)."""
    sc, width = texts.sparkSession.sparkContext, rank + OVERSAMPLE

    def by_term(total: np.ndarray) -> Iterator[pa.RecordBatch]:
        has = np.flatnonzero(np.abs(total).sum(axis=1))
        yield from sliced(pa.RecordBatch.from_arrays(
            [pa.array(has.astype(np.int32)), pa.array([x.tobytes() for x in total[has].astype("<f4")], pa.binary())], names=["term", "v"]))

    def times(q: np.ndarray) -> np.ndarray:
        """A' A q: each task over its texts, then summed by term."""
        sent = sc.broadcast(np.vstack([q * idf[:, None], np.zeros((1, width))]).astype(np.float32))

        def part(batches):
            total = np.zeros((TERMS, width))
            for b in batches:
                cut = [blocks(ids) for ids in term_ids(b)]
                sizes = [len(x) for x in cut]
                if sum(sizes):
                    own = np.repeat(np.arange(len(cut)), sizes)
                    weight = b.column(b.schema.get_field_index("weight")).to_numpy().astype(np.float32) ** 2
                    add_products(np.concatenate(cut), own, weight[own], sent.value, total)
            yield from by_term(total)

        def whole(batches):
            total = np.zeros((TERMS, width))
            for b in batches:
                if not b.num_rows:
                    continue
                names, back = np.unique(b.column(0).to_numpy(), return_inverse=True)
                order = np.argsort(back, kind="stable")
                v = np.array([np.frombuffer(x.as_buffer(), "<f4") for x in b.column(1)])
                total[names] += np.add.reduceat(v[order], np.searchsorted(back[order], np.arange(len(names))), axis=0)
            yield from by_term(total)

        got = (few(texts).mapInArrow(lean(part), "term int, v binary").repartition("term")
               .mapInArrow(lean(whole), "term int, v binary").toArrow())       # at most TERMS x width numbers
        sent.destroy()
        out = np.zeros((TERMS, width))
        if got.num_rows:
            out[got.column("term").to_numpy()] = np.array([np.frombuffer(x, "<f4") for x in got.column("v").to_pylist()])
        return out * idf[:, None]

    q = np.linalg.qr(np.random.default_rng(17).normal(size=(TERMS, width)))[0]
    for _ in range(POWER + 1):
        y = times(q)
        q, r = np.linalg.qr(y)
    # rotate to the leading directions of the last product
    u, _, _ = np.linalg.svd(r)
    return (q @ u[:, :rank]).astype(np.float32)


def subsequence(item: list, text: list) -> int:
    """Length of the longest common subsequence, bit-parallel over the item's words."""
    masks: dict = {}
    for k, w in enumerate(item):
        masks[w] = masks.get(w, 0) | 1 << k
    full = (1 << len(item)) - 1
    row = full
    for w in text:
        m = masks.get(w)
        if m is not None:
            low = row & m
            row = ((row + low) | (row & ~m)) & full
    return len(item) - row.bit_count()


class Benchmark:
    """Items with their latent passages; bounded by a checked size, so it goes with the tasks."""

    def __init__(self, rows: list[tuple], idf: np.ndarray, directions: np.ndarray):
        self.idf = idf
        self.scaled = np.vstack([directions * idf[:, None].astype(np.float32), np.zeros((1, directions.shape[1]), np.float32)])
        self.items, vectors, owner = [], [], []
        for item_id, text, answer in rows:
            words = tokens(text or "")
            if not words:
                continue
            if answer is None:
                parts = [p for p in re.split(r"[.!?\n]+", text) if tokens(p)]
                last = tokens(parts[-1]) if len(parts) > 1 else words[-max(3, len(words) // 4):]
            else:
                last = tokens(answer)
            ids = buckets(words)
            rare = {w for w, t in zip(words, ids) if idf[t] >= np.median(idf[ids])}
            own = passage_sums(ids, self.scaled)
            vectors += list(own)
            owner += [len(self.items)] * len(own)
            self.items.append((item_id, words, last, rare))
        v = np.array(vectors, np.float32).reshape(-1, directions.shape[1])
        size = np.linalg.norm(v, axis=1)
        self.vectors = v / np.maximum(size, 1e-9)[:, None]
        # where each item's passages begin, its rare words by term, and how many of them a passage must hold
        self.first = np.searchsorted(np.array(owner, np.int64), np.arange(len(self.items) + 1))
        self.rare = np.zeros((TERMS + 1, len(self.items)), np.uint8)
        for k, (_, _, _, rare) in enumerate(self.items):
            self.rare[buckets(list(rare)), k] = 1
        self.need = np.minimum(SHARED_RARE, np.maximum(1, self.rare.sum(axis=0, dtype=np.int64) // 3)).astype(np.uint8)

    def candidates(self, texts: list[np.ndarray]) -> Iterator[tuple[int, int, int]]:
        """(text, item index, passage start) whose cosine is high enough, in order of texts and places."""
        if not self.items or not texts:
            return
        cut = [blocks(ids) for ids in texts]
        sizes = np.array([len(x) for x in cut])
        ids = np.concatenate([*cut, np.full((1, STRIDE), TERMS, np.uint16)])       # the last block sums to zero
        own, first = np.repeat(np.arange(len(cut)), sizes), np.cumsum(sizes) - sizes
        # a passage starts at each block but a text's last one, unless it is the only one
        two = np.append(own[1:] == own[:-1], np.zeros(min(len(own), 1), bool))
        begin = np.flatnonzero(two | (sizes[own] == 1))
        for k in range(0, len(begin), COMPARED):
            at = begin[k:k + COMPARED]
            part = np.concatenate([ids[at[0]:at[-1] + 2], ids[-1:]])
            one = at - at[0]
            other = np.where(two[at], one + 1, len(part) - 1)
            v = row_sums(part, self.scaled)
            v = v[one] + v[other]
            v /= np.maximum(np.linalg.norm(v, axis=1), 1e-9)[:, None]
            cosine = v @ self.vectors.T
            # passages of one language are all near each other here: enough rare words must be in them, too
            held = row_sums(part, self.rare)
            for x in np.flatnonzero(held[one] + held[other] >= self.need).tolist():
                p, i = divmod(x, len(self.items))
                if cosine[p, self.first[i]:self.first[i + 1]].max() >= COSINE:
                    t = int(own[at[p]])
                    yield t, i, int(at[p] - first[t]) * STRIDE

    def leaks(self, text: str, found: Iterable[tuple[int, int, int]]) -> list[tuple]:
        """(item_id, lcs share, answer share, first word, last word) of a text's candidates that hold, best place of each item."""
        words = tokens(text)
        best: dict[int, tuple] = {}
        tried: dict[int, int] = {}
        for _, i, s in found:
            item_id, item, answer, rare = self.items[i]
            if i in best and best[i][1] >= 1.0:
                continue
            slack = max(4, len(item) // 4)
            # the passage may be any part of the item: as many words before and after
            lo, hi = max(0, s - len(item) - slack), min(len(words), s + WINDOW + len(item) + slack)
            if tried.get(i) == lo:
                continue
            tried[i] = lo
            found = self.place(item, rare, words, lo, hi)
            if found is None:
                continue
            share, a, b = found
            near = words[max(0, a - 2):b + 2]
            said = subsequence(answer, near) / len(answer) if answer else 0.0
            known = sum(w in set(near) for w in rare) / max(len(rare), 1)
            if known >= RARE and (share >= FULL or (share >= PART and said >= FULL)) and (i not in best or share > best[i][1]):
                best[i] = (item_id, share, said, a, b)
        return list(best.values())

    @staticmethod
    def place(item, rare, words, lo, hi):
        """The stretch of about the item's length with most of it in order (the last such), or None if it can't be enough."""
        n, part = len(item), words[lo:hi]
        most = subsequence(item, part)                      # no stretch has more
        if most < PART * n:
            return None
        own = set(item)
        hit = np.cumsum([0] + [w in own for w in part])
        width = min(len(part), n + max(4, n // 4))
        if len(part) > width:
            gain = hit[width:] - hit[:-width]
        else:
            gain = np.array([hit[-1]])
        best, at = -1, 0
        for a in np.lexsort((-np.arange(len(gain)), -gain)).tolist():       # those with most of its words first
            if best >= min(int(gain[a]), most):
                break
            got = subsequence(item, part[a:a + width])
            if got > best:
                best, at = got, a
        return best / n, lo + at, lo + at + width


def decontaminate(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  item_id_col: str = "item_id", item_text_col: str = "text", answer_col: str | None = None,
                  part_bytes: int = MAX_BENCHMARK_BYTES) -> DataFrame:
    """(doc_id, contaminated, n_items, items array<struct>, mark: a hash of the text) of every row."""
    src = id_text(docs, id_col, text_col)
    answer = F.col(answer_col).cast("string") if answer_col else F.lit(None).cast("string")
    items = benchmark.select(F.col(item_id_col).cast("long").alias("item_id"),
                             F.col(item_text_col).cast("string").alias("text"), answer.alias("answer"))
    size = items.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    parts = -(-int(size) // part_bytes) or 1
    scratch = Scratch(docs.sparkSession, "latent")
    texts = scratch.write(hashed(src), "texts")
    df, n, passages = document_frequencies(texts)
    idf = np.log((n + 1) / (df + 1)) + 0.1
    bench = scratch.write(hashed(id_text(items, "item_id")), "items")
    # the benchmark weighs as much as the corpus, so that its directions are among the leading ones
    lift = float(np.sqrt(max(1.0, passages / max(document_frequencies(bench)[2], 1))))
    directions = basis(texts.select(F.lit(1.0).alias("weight"), "terms").unionByName(
        bench.select(F.lit(lift).alias("weight"), "terms")), idf)
    found = leaks = None
    for k in range(parts):
        some = items if parts == 1 else items.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(parts)) == k)
        # at most about part_bytes at once; a larger benchmark takes a pass for each part
        one = search(texts, Benchmark([tuple(r) for r in some.collect()], idf, directions))
        if parts > 1:
            one = scratch.write(one if k == 0 else one.filter(F.size("items") > 0), f"part{k}")
            # equal rows hold the same items: once for each part
            own = one.filter(F.size("items") > 0).groupBy("doc_id", "mark").agg(F.first("items").alias("items"))
            leaks = own if leaks is None else leaks.unionByName(own)
        found = one if found is None else found
    if parts > 1:
        leaks = leaks.groupBy(F.col("doc_id").alias("leak_id"), F.col("mark").alias("leak_mark")).agg(
            F.sort_array(F.flatten(F.collect_list("items"))).alias("leaks"))
        found = found.select("doc_id", "mark").join(
            leaks, F.col("doc_id").eqNullSafe(F.col("leak_id")) & (F.col("mark") == F.col("leak_mark")), "left").select(
            "doc_id", "mark", F.coalesce("leaks", F.array().cast(ITEMS)).alias("items"))
    return found.select("doc_id", (F.size("items") > 0).alias("contaminated"),
                        F.size("items").cast("long").alias("n_items"), "items", "mark")


def clean(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, with all their columns, that hold no benchmark item."""
    out = Scratch(docs.sparkSession, "latent").write(
        decontaminate(docs, benchmark, id_col, text_col).filter("contaminated")
        .select(F.col("doc_id").alias("leak_id"), F.col("mark").alias("leak_mark")).distinct(), "leaks")
    # the rows' own columns in a struct: whatever they are called, none meets the leaks' names
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = docs.select(F.struct(*docs.columns).alias("row"), F.col(id_col).cast("long").alias("id"), F.xxhash64(text).alias("mark"))
    kept = rows.join(out, F.col("id").eqNullSafe(F.col("leak_id")) & (F.col("mark") == F.col("leak_mark")), "left_anti")
    return kept.select("row.*")


ITEMS = "array<struct<item_id: bigint, lcs: double, answer: double, first_word: int, last_word: int>>"


def search(texts: DataFrame, bench: Benchmark) -> DataFrame:
    sent = Shipped(texts.sparkSession, bench)
    kind = pa.list_(pa.struct([("item_id", pa.int64()), ("lcs", pa.float64()), ("answer", pa.float64()),
                               ("first_word", pa.int32()), ("last_word", pa.int32())]))
    names = ("item_id", "lcs", "answer", "first_word", "last_word")

    def run(batches):
        mine = sent.load()
        for b in batches:
            got: list[list[dict]] = [[] for _ in range(b.num_rows)]
            for k, found in groupby(mine.candidates(list(term_ids(b))), itemgetter(0)):
                got[k] = [dict(zip(names, x)) for x in mine.leaks(b.column(2)[k].as_py(), found)]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(got, kind)],
                                             names=["doc_id", "mark", "items"])
    return texts.select("doc_id", "mark", "text", "terms").mapInArrow(lean(run), f"doc_id long, mark long, items {ITEMS}")


def report(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The query's row per document."""
    return decontaminate(docs, benchmark).select(
        "doc_id", "contaminated", "n_items", F.sort_array(F.col("items.item_id")).alias("item_ids"),
        F.round(F.array_max("items.lcs"), 6).alias("best_lcs"))
