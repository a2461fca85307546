"""Quality classifier: regularised quadratic discriminant over document statistics.

Each whole text becomes a vector of transformed statistics (logs of counts,
logits of shares). The classes' means and covariances come from sums over all
labelled training rows; each covariance is shrunk towards the pooled one and
towards its diagonal. The score is the difference of the two log densities,
each a Mahalanobis distance by that class's cached Cholesky factor, put on the
scale of a probability by a one-variable logistic fit on a bounded sample of
the training rows.

Empty and null texts have statistics like any other and get a score. Null ids
never train. With no training row of one class every score is the share of the
other (0.5 if there are no labels). Repeated rows are scored each.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import WORD, Scratch, held_out, id_text, lean, strings
from .labelled import FOLDS, training_labels, training_labels_all

CALIBRATION_ROWS = 10_000   # of each class, for the logistic fit
SHRINK_POOLED, SHRINK_DIAGONAL = 0.1, 0.05
TAU = 1e-3                  # the least variance of a statistic
STATS = ("log_words", "word_length", "upper", "digits", "exclaim", "symbols", "pipes", "stops", "other",
         "repeats", "distinct", "line_words", "line_repeats", "long_words", "top_word")


def _logit(x: float, n: float) -> float:
    """Of a share x of n, smoothed so that 0 and 1 are finite."""
    return float(np.log((x + 0.1) / (n - x + 0.1)))


def statistics(text: str) -> list[float]:
    words = WORD.findall(text)
    n = len(words)
    raw = np.frombuffer(text.encode("utf-8", "replace"), np.uint8)
    by = np.bincount(raw, minlength=256)
    letters = max(int(by[65:91].sum() + by[97:123].sum() + by[192:].sum()), 1)
    chars = max(len(raw), 1)
    pipes, bang = int(by[124]), int(by[33])
    symbols = int(by[[35, 36, 37, 38, 42, 43, 60, 61, 62, 64, 94, 95, 96, 126]].sum())
    seen: dict[str, int] = {}
    for w in words:
        seen[w] = seen.get(w, 0) + 1
    same = sum(map(str.__eq__, words, words[1:]))
    lines = [x for x in text.split("\n") if x.strip()]
    many = max(n, 1)
    return [
        np.log1p(n), np.log1p(len(text) / many), _logit(int(by[65:91].sum()), letters),
        _logit(int(by[48:58].sum()), chars), _logit(min(bang, many), many), _logit(min(symbols, many), many),
        _logit(min(pipes, many), many), _logit(min(int(by[46] + by[44]), many), many),
        _logit(int(by[128:].sum()), chars), _logit(same, many),
        # distinct words fall with the length of a text; this is Herdan's ratio
        np.log1p(len(seen)) / max(np.log1p(n), 0.7), np.log1p(many / max(len(lines), 1)),
        _logit(len(lines) - len(set(lines)), max(len(lines), 1)),
        _logit(sum(c for w, c in seen.items() if len(w) > 24), many), _logit(max(seen.values(), default=0), many),
    ]


def features(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, x array<double>) of every row."""
    def run(batches):
        for b in batches:
            x = [statistics(t) for t in strings(b, "text")]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(x, pa.list_(pa.float64()))],
                                             names=["doc_id", "x"])
    return id_text(docs, id_col, text_col).mapInArrow(lean(run), "doc_id long, x array<double>")


def _moments(rows: DataFrame) -> dict[int, tuple[float, np.ndarray, np.ndarray]]:
    """By class: rows, sum of x, sum of x x'; summed in tasks first, then by Spark."""
    d = len(STATS)

    def partial(batches):
        total: dict[int, np.ndarray] = {}
        for b in batches:
            y = b.column(0).to_numpy(zero_copy_only=False)
            x = np.array(b.column(1).flatten()).reshape(-1, d)
            one = np.hstack([np.ones((len(x), 1)), x])
            for c in np.unique(y):
                z = one[y == c]
                total[int(c)] = total.get(int(c), 0) + z.T @ z
        for c, m in total.items():
            yield pa.RecordBatch.from_arrays(
                [pa.array([c] * m.size, pa.int32()), pa.array(range(m.size), pa.int32()), pa.array(m.ravel())],
                names=["y", "i", "v"])

    sums = (rows.select("y", "x").mapInArrow(partial, "y int, i int, v double")
            .groupBy("y", "i").agg(F.sum("v").alias("v")).collect())     # 2 * (d + 1)^2 rows
    out = {}
    for c in {r["y"] for r in sums}:
        m = np.zeros((d + 1) * (d + 1))
        for r in sums:
            if r["y"] == c:
                m[r["i"]] = r["v"]
        m = m.reshape(d + 1, d + 1)
        out[c] = (m[0, 0], m[0, 1:], m[1:, 1:])
    return out


class Discriminant:
    """Means, Cholesky factors and the calibration; small, so it goes with the tasks."""

    def __init__(self, moments: dict):
        self.share, self.ready = 0.5, len(moments) == 2
        if not self.ready:
            if moments:
                self.share = 1.0 if 1 in moments else 0.0
            return
        n = {c: m[0] for c, m in moments.items()}
        mean = {c: m[1] / m[0] for c, m in moments.items()}
        cov = {c: m[2] / m[0] - np.outer(mean[c], mean[c]) for c, m in moments.items()}
        pooled = sum(n[c] * cov[c] for c in n) / sum(n.values())
        self.share = n[1] / sum(n.values())
        self.mean, self.factor, self.log_det = mean, {}, {}
        for c in n:
            s = (1 - SHRINK_POOLED) * cov[c] + SHRINK_POOLED * pooled
            s = (1 - SHRINK_DIAGONAL) * s + SHRINK_DIAGONAL * np.diag(np.diag(s)) + TAU * np.eye(len(s))
            low = np.linalg.cholesky(s)
            self.factor[c] = np.linalg.inv(low)
            self.log_det[c] = 2 * np.log(np.diag(low)).sum()
        self.slope, self.offset = 1.0, float(np.log(n[1] / n[0]))

    def difference(self, x: np.ndarray) -> np.ndarray:
        """log density of class 1 less that of class 0, compressed far from 0."""
        out = np.zeros(len(x))
        for c, sign in ((1, 1.0), (0, -1.0)):
            z = (x - self.mean[c]) @ self.factor[c].T
            out += sign * -0.5 * ((z * z).sum(axis=1) + self.log_det[c])
        return np.sign(out) * np.log1p(np.abs(out))

    def calibrate(self, x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> None:
        """Weighted logistic fit of y on the difference (Newton steps)."""
        a = np.column_stack([self.difference(x), np.ones(len(x))])
        w = np.array([1.0, 0.0])
        for _ in range(30):
            p = 1 / (1 + np.exp(-np.clip(a @ w, -30, 30)))
            g = a.T @ (weight * (p - y)) + 1e-3 * w * np.array([1, 0])
            h = (a * (weight * p * (1 - p))[:, None]).T @ a + 1e-3 * np.eye(2)
            step = np.linalg.solve(h, g)
            w -= np.clip(step, -1, 1)
            if np.abs(step).max() < 1e-8:
                break
        self.slope, self.offset = float(max(w[0], 1e-3)), float(w[1])

    def score(self, x: np.ndarray) -> np.ndarray:
        if not self.ready:
            return np.full(len(x), self.share)
        z = self.slope * self.difference(x) + self.offset
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def fit(x: DataFrame, labels: DataFrame, column: str = "quality", folds: int = FOLDS) -> Discriminant:
    """From a table of features and one of labels; all training rows give the moments."""
    y = training_labels_all(labels, column, folds)
    model = Discriminant(_moments(x.join(y, "doc_id")))
    if model.ready:
        sample = training_labels(labels, column, CALIBRATION_ROWS, folds)     # at most 2 * CALIBRATION_ROWS rows
        # rows that repeat an id are calibrated on once
        rows = x.join(F.broadcast(sample), "doc_id").groupBy("doc_id").agg(
            F.first("y").alias("y"), F.min("x").alias("x")).select("y", "x").toPandas()
        got = rows["y"].to_numpy()
        many = {c: max((got == c).sum(), 1) for c in (0, 1)}
        weight = np.where(got == 1, model.share / many[1], (1 - model.share) / many[0]) * len(got)
        model.calibrate(np.vstack(rows["x"]), got, weight)
    return model


def passing(docs: DataFrame, labels: DataFrame, column: str = "quality", threshold: float = 0.3,
            folds: int = FOLDS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, with all their columns, that score at least the threshold."""
    scratch = Scratch(docs.sparkSession, "quality")
    src = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    x = scratch.write(features(src), "features")
    model = fit(x, labels, column, folds)

    def run(batches):
        for b in batches:
            text = b.column(b.schema.get_field_index(text_col)).cast(pa.string())
            at = np.array([statistics(t.as_py() or "") for t in text]).reshape(-1, len(STATS))
            yield b.filter(pa.array(model.score(at) >= threshold))

    return docs.mapInArrow(lean(run), docs.schema)


def scores(docs: DataFrame, labels: DataFrame, column: str = "quality", threshold: float = 0.3,
           folds: int = FOLDS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, held_out, score, predicted) of every row of ``docs``."""
    scratch = Scratch(docs.sparkSession, "quality")
    x = scratch.write(features(docs, id_col, text_col), "features")
    model = fit(x, labels, column, folds)

    def run(batches):
        for b in batches:
            at = np.array(b.column(1).flatten()).reshape(-1, len(STATS))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(model.score(at))], names=["doc_id", "score"])

    return (x.mapInArrow(run, "doc_id long, score double")
            .select("doc_id", held_out("doc_id", folds).alias("held_out"), "score",
                    (F.col("score") >= threshold).cast("int").alias("predicted")))
