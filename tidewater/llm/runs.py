"""Periodic run detection by internal pattern matching.

A run is a stretch of consecutive words with smallest period q (words q apart are
identical) that no neighbouring word extends, at least ``max(LEAST, REPEATS * q)`` words long.

A run with q in (b/2, b], for a power of two b >= 4, holds a dyadic block: b words from a
multiple of b/2, all followed by q more words of the run. The block is at least a period
long, so its occurrences in the run form a progression with difference q, and the next one
after it starts exactly q on. A block's occurrences are a slice of the suffix array; the
next one within the neighbouring window of b words is a range successor, which a wavelet
matrix over the suffix array answers. Each such distance is a candidate period; comparing
the text with itself that far on, both ways, gives the run or drops it. A block finds at most
one period, and the least one, so every run is found, once each, whatever the text.

Rows: a null text has no words, an empty one neither; a row without id is never altered by
``rotated``; equal rows give equal results; the table's other columns are not read.
"""

from __future__ import annotations

import hashlib
import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import id_text, strings
from .suffixes import Suffixes, Wavelet, blocks, covered, numbered

LEAST, REPEATS = 6, 4       # words of the shortest run; periods in a run
FIRST = 4                   # words of the shortest block (finds the periods 1 to 4)

SCHEMA = ("doc_id long, n_words long, n_runs long, start long, length long, period long, exponent_milli long, "
          "runs_sha256 string, collapsed_sha256 string")
RUNS_SCHEMA = "doc_id long, start long, length long, period long"


@dataclass
class Runs:
    """Runs of some texts: the text of each, its first word there, its words and period."""

    text: np.ndarray
    start: np.ndarray
    length: np.ndarray
    period: np.ndarray


def candidates(suffixes: Suffixes) -> tuple[np.ndarray, np.ndarray]:
    """(place of a block, distance to its next occurrence) within the window that its level asks for."""
    at, far = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    least = FIRST.bit_length() - 1
    if least < len(suffixes.levels):
        # only suffixes that share their first words with another one can answer a block
        rank = suffixes.levels[least][suffixes.array]
        same = rank[1:] == rank[:-1]
        shared = np.append(same, False) | np.append(False, same)
        slot = np.append(0, np.cumsum(shared))
        wavelet = Wavelet(suffixes.array[shared])
        for k in range(least, len(suffixes.levels)):
            b, rank = 1 << k, suffixes.levels[k]
            size = np.bincount(rank, minlength=suffixes.n)
            place = np.arange(0, suffixes.n, b // 2)
            place = place[size[rank[place]] > 1]
            lo = slot[rank[place]]
            step = wavelet.successor(lo, lo + size[rank[place]], place) - place
            near = (step > (0 if k == least else b // 2)) & (step <= b)
            at.append(place[near])
            far.append(step[near])
    return np.concatenate(at), np.concatenate(far)


def find(symbols: np.ndarray, bounds: np.ndarray) -> Runs:
    """Every run of every text, by text, start and period."""
    suffixes = Suffixes(symbols, bounds)
    at, q = candidates(suffixes)
    start = at - suffixes.behind(at, at + q)
    end = at + q + suffixes.ahead(at, at + q)
    good = end - start >= np.maximum(LEAST, REPEATS * q)
    found = np.unique(np.stack([start[good], q[good], end[good]]), axis=1)
    start, q, end = found
    text = suffixes.text[start]
    return Runs(text, start - bounds[text], end - start, q)


def rotated(doc_id: int | None, words: list[str]) -> list[str]:
    """The words as the query takes them: ids with crc32 % 10 = 0 get a periodic tail."""
    h = 1 if doc_id is None else zlib.crc32(str(doc_id).encode())
    if h % 10 or not words:
        return words
    g, n = h // 10, len(words)
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + [words[a + (i - a) % p] for i in range(a, n)]


def greatest(runs: list[tuple[int, int, int]]) -> tuple[int, int, int]:
    """The (start, length, period) of greatest length / period; ties: least start, then period."""
    best = runs[0]
    for r in runs[1:]:
        more = r[1] * best[2] - best[1] * r[2]
        if more > 0 or (more == 0 and (r[0], r[2]) < (best[0], best[2])):
            best = r
    return best


def collapsed(words: list[str], runs: list[tuple[int, int, int]]) -> list[str]:
    """The words that no run contains after its first period."""
    if not runs:
        return words
    start, length, period = np.array(runs).T
    gone = covered(start + period, length - period, len(words))
    return [w for w, g in zip(words, gone.tolist()) if not g]


def _sha(text: str) -> str:
    return hashlib.sha256(text.encode("utf-8")).hexdigest()


def _by_text(docs: DataFrame, alter, rows, schema: str) -> DataFrame:
    """``rows(id, words, runs)`` of every text, texts taken together in blocks of words."""
    def run(batches):
        for b in batches:
            ids = b.column(0).to_pylist()
            for block in blocks(zip(ids, strings(b, "text"))):
                words = [alter(i, w) for i, _, w in block]
                symbols, bounds = numbered(words)
                found = find(symbols, bounds)
                edge = np.searchsorted(found.text, np.arange(len(block) + 1))
                out = []
                for k, (i, _, _) in enumerate(block):
                    s = slice(edge[k], edge[k + 1])
                    out += rows(i, words[k], list(zip(found.start[s].tolist(), found.length[s].tolist(),
                                                      found.period[s].tolist())))
                yield pa.RecordBatch.from_pylist(out, schema=arrow)

    frame = docs.sparkSession.createDataFrame([], schema)
    arrow = pa.schema([pa.field(f.name, pa.string() if f.dataType.typeName() == "string" else pa.int64())
                       for f in frame.schema])
    return docs.mapInArrow(run, schema)


def runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per run of every text as it is: (doc_id, start, length, period)."""
    return _by_text(id_text(docs, id_col, text_col), lambda i, w: w, lambda i, words, found: [
        {"doc_id": i, "start": s, "length": n, "period": q} for s, n, q in found], RUNS_SCHEMA)


def digests(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: its runs, the greatest one, and digests of the runs and of the kept words."""
    def rows(i, words, found):
        best = greatest(found) if found else None
        return [{"doc_id": i, "n_words": len(words), "n_runs": len(found), "start": best and best[0],
                 "length": best and best[1], "period": best and best[2],
                 "exponent_milli": best and 1000 * best[1] // best[2],
                 "runs_sha256": _sha("".join(f"{s},{n},{q}\n" for s, n, q in found)),
                 "collapsed_sha256": _sha(" ".join(collapsed(words, found)))}]

    return _by_text(id_text(docs, id_col, text_col), rotated, rows, SCHEMA)
