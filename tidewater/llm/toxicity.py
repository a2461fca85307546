"""Toxicity: a factorization machine over hashed terms.

A document is the set of its hashed terms: lower-cased words and the first four
and five letters of longer ones. Its logit is w0 + sum of w_i + sum over pairs
of <v_i, v_j>, so a pair (an insult with a mention of a group) can weigh more
than its two terms do alone. It is fitted on a bounded sample of labelled rows:
at most SAMPLE rows of each class, the rates corrected by the classes' counts
over all labels. Terms that tell the classes apart in the sample by a chi-square
test get weights; the others have none.

Null and empty texts have no terms and get the score of the intercept. Null ids
never train. With training rows of one class only, every score is that class
(0.5 with no labels at all). Repeated rows are scored each.
"""

from __future__ import annotations

import re
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import held_out, id_text, strings
from .labelled import FOLDS, class_counts, training_labels

SAMPLE = 4_000
BITS, RANK = 18, 8
EPOCHS, LEAST_STEPS, STEP, RIDGE = 12, 1_000, 0.2, 1e-4      # a small sample is gone through more often
CHI_SQUARE = 10.83
TERM = re.compile(r"\w+")


def terms(words) -> set[int]:
    mask, out = (1 << BITS) - 1, set()
    for w in words:
        out.add(crc32(w.encode("utf-8", "replace")) & mask)
        if len(w) > 4:
            out.add(crc32(b"4:" + w[:4].encode("utf-8", "replace")) & mask)
        if len(w) > 5:
            out.add(crc32(b"5:" + w[:5].encode("utf-8", "replace")) & mask)
    return out


def term_rows(docs: DataFrame) -> DataFrame:
    """(doc_id, y, terms array<int>): only asked for the sampled rows."""
    def run(batches):
        for b in batches:
            t = [sorted(terms(set(TERM.findall(x.lower())))) for x in strings(b, "text")]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(2), pa.array(t, pa.list_(pa.int32()))],
                                             names=["doc_id", "y", "terms"])
    return docs.select("doc_id", "text", "y").mapInArrow(run, "doc_id long, y int, terms array<int>")


class Machine:
    """w0, w and V of the terms that have weights, by hash."""

    def __init__(self, share: float):
        self.w0 = float(np.log(share / (1 - share))) if 0 < share < 1 else (30.0 if share >= 1 else -30.0)
        self.index = np.full(1 << BITS, -1, np.int32)
        self.w, self.v = np.zeros(0), np.zeros((0, RANK))

    def fit(self, rows: list[np.ndarray], y: np.ndarray, weight: np.ndarray, seed: int = 7) -> "Machine":
        size = 1 << BITS
        have = {c: np.bincount(np.concatenate([r for r, v in zip(rows, y) if v == c]), minlength=size).astype(float)
                for c in (0, 1)}
        n1, n0 = float((y == 1).sum()), float((y == 0).sum())
        a, b = have[1], have[0]
        c, d, n = n1 - a, n0 - b, n1 + n0
        chi = n * (a * d - b * c) ** 2 / np.maximum((a + b) * (c + d) * (a + c) * (b + d), 1e-9)
        keep = np.flatnonzero((chi >= CHI_SQUARE) & (a + b >= 5))
        self.index[keep] = np.arange(len(keep))
        rng = np.random.default_rng(seed)
        self.w, self.v = np.zeros(len(keep)), rng.normal(0, 0.01, (len(keep), RANK))
        own = [self.index[r] for r in rows]
        own = [r[r >= 0] for r in own]
        gw, gv, g0 = np.full(len(keep), 1e-6), np.full((len(keep), RANK), 1e-6), 1e-6
        for _ in range(max(EPOCHS, -(-LEAST_STEPS * 64 // len(rows)))):
            order = rng.permutation(len(rows))
            for at in range(0, len(order), 64):
                batch = order[at:at + 64]
                flat = np.concatenate([own[i] for i in batch])
                row = np.repeat(np.arange(len(batch)), [len(own[i]) for i in batch])
                vs = self.v[flat]
                total = np.zeros((len(batch), RANK))
                np.add.at(total, row, vs)
                logit = self.w0 + np.bincount(row, self.w[flat], len(batch)) + 0.5 * (
                    (total ** 2).sum(1) - np.bincount(row, (vs ** 2).sum(1), len(batch)))
                p = 1 / (1 + np.exp(-np.clip(logit, -30, 30)))
                e = (p - y[batch]) * weight[batch] / len(batch)
                g = e.sum()
                g0 += g * g
                self.w0 -= STEP * g / np.sqrt(g0)
                used, where = np.unique(flat, return_inverse=True)
                dw = np.bincount(where, e[row], len(used)) + RIDGE * self.w[used]
                dv = np.zeros((len(used), RANK))
                np.add.at(dv, where, e[row][:, None] * (total[row] - vs))
                dv += RIDGE * self.v[used]
                gw[used] += dw ** 2
                gv[used] += dv ** 2
                self.w[used] -= STEP * dw / np.sqrt(gw[used])
                self.v[used] -= STEP * 0.25 * dv / np.sqrt(gv[used])
        return self

    def logit(self, hashed: np.ndarray) -> float:
        own = self.index[hashed]
        own = own[own >= 0]
        v = self.v[own]
        return float(self.w0 + self.w[own].sum() + 0.5 * ((v.sum(0) ** 2).sum() - (v ** 2).sum()))


def fit(docs: DataFrame, labels: DataFrame, column: str = "toxic", sample: int = SAMPLE,
        folds: int = FOLDS) -> Machine | float:
    """The machine, or the one score there is if a class has no training rows."""
    counts = class_counts(labels, column, folds)
    if not counts.get(1) or not counts.get(0):
        return 1.0 if counts.get(1) else 0.0 if counts.get(0) else 0.5
    picked = training_labels(labels, column, sample, folds)         # at most 2 * sample rows
    # rows that repeat an id train once, by the least of their texts
    once = id_text(docs).join(F.broadcast(picked), "doc_id").groupBy("doc_id").agg(
        F.min("text").alias("text"), F.first("y").alias("y"))
    rows = term_rows(once).toPandas()
    y = rows["y"].to_numpy()
    if not (y == 1).any() or not (y == 0).any():
        return counts[1] / (counts[0] + counts[1])
    share = counts[1] / (counts[0] + counts[1])
    weight = np.where(y == 1, share / (y == 1).mean(), (1 - share) / (y == 0).mean())
    # rare classes are lifted so that their loss is felt in every batch
    lift = np.where(y == 1, np.sqrt((1 - share) / share), 1.0) if share < 0.5 else np.ones(len(y))
    return Machine(share).fit([np.asarray(t, np.int64) for t in rows["terms"]], y.astype(float), weight * lift)


def scores(docs: DataFrame, labels: DataFrame, column: str = "toxic", threshold: float = 0.5,
           sample: int = SAMPLE, folds: int = FOLDS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, held_out, score, predicted) of every row of ``docs``."""
    src = id_text(docs, id_col, text_col)
    model = fit(src, labels, column, sample, folds)

    def run(batches):
        known: dict[str, tuple] = {}                        # a word's terms with weights, by word
        for b in batches:
            out = []
            for text in strings(b, "text"):
                if isinstance(model, float):
                    out.append(model)
                    continue
                got: set = set()
                for w in set(TERM.findall(text.lower())):
                    t = known.get(w)
                    if t is None:
                        if len(known) > 500_000:
                            known.clear()
                        t = known[w] = tuple(x for x in terms((w,)) if model.index[x] >= 0)
                    if t:
                        got.update(t)
                z = model.logit(np.fromiter(got, np.int64, len(got))) if got else model.w0
                out.append(float(1 / (1 + np.exp(-np.clip(z, -30, 30)))))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(out, pa.float64())], names=["doc_id", "score"])

    return (src.mapInArrow(run, "doc_id long, score double")
            .select("doc_id", held_out("doc_id", folds).alias("held_out"), "score",
                    (F.col("score") >= threshold).cast("int").alias("predicted")))
