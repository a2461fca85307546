import hashlib
import random

import numpy as np
import pytest

from tidewater.llm import queries
from tidewater.llm import recompress as rc
from tidewater.llm.common import WORD, word_hashes


def brute(rows, size=13):
    first = {}
    for i, t in rows:
        if i is not None:
            w = WORD.findall(t or "")
            for k in range(len(w) - size + 1):
                g = tuple(w[k:k + size])
                first[g] = min(first.get(g, i), i)
    out = []
    for i, t in rows:
        w = WORD.findall(t or "")
        gone = set()
        for k in range(len(w) - size + 1):
            if i is not None and first[tuple(w[k:k + size])] < i:
                gone.update(range(k, k + size))
        kept = " ".join(x for k, x in enumerate(w) if k not in gone)
        out.append((i, len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out, key=repr)


def got(df):
    return sorted((tuple(r) for r in df.select("doc_id", "n_words", "n_removed", "kept_sha256").collect()), key=repr)


def random_rows(rng, n, letters="abc"):
    pool = [" ".join(rng.choice(letters) * rng.randint(1, 2) for _ in range(rng.randint(5, 60))) for _ in range(6)]
    rows = []
    for k in range(n):
        parts = [rng.choice(pool) if rng.random() < 0.5 else
                 " ".join(rng.choice(letters) + str(rng.randint(0, 3)) for _ in range(rng.randint(0, 40)))
                 for _ in range(rng.randint(0, 5))]
        rows.append((rng.randint(0, n), " ".join(parts)))
    return rows


@pytest.mark.parametrize("letters", ["a", "ab", "abcdefgh"])
def test_equal_windows_have_equal_anchors(letters):
    rng = random.Random(len(letters))
    for _ in range(60):
        base = [rng.choice(letters).encode() for _ in range(rng.randint(13, 50))]
        if rng.random() < 0.5:
            base[3:20] = [b"a"] * 17
        first = {}
        for _ in range(8):
            left = [rng.choice(letters).encode() for _ in range(rng.randint(0, 20))]
            right = [rng.choice(letters).encode() for _ in range(rng.randint(0, 20))]
            words = left + base + right
            doc = np.zeros(len(words), np.int64)
            at = rc.windows(doc)
            for p, a in zip(at, rc.anchors(word_hashes(words), doc, at)):
                assert first.setdefault(tuple(words[p:p + 13]), a) == a


def test_symbols_shrink_and_tile():
    rng = np.random.default_rng(1)
    h = rng.integers(0, 2 ** 63, 10_000).astype(np.uint64)
    s = rc.parse(h, np.zeros(len(h), np.int64), rounds=2)
    assert s.start[0] == 0 and s.end[-1] == len(h) and (s.start[1:] == s.end[:-1]).all()
    assert len(s.name) < 0.62 * len(h) and (np.diff(s.lo) >= 0).all() and (np.diff(s.hi) >= 0).all()


def test_random_texts(spark):
    rng = random.Random(9)
    for n, letters in ((30, "ab"), (60, "abcdef")):
        rows = random_rows(rng, n, letters)
        docs = spark.createDataFrame([(i, t, "x", 0) for i, t in rows], "doc_id long, text string, kept string, n_words int")
        assert got(rc.digests(docs)) == brute(rows)


def test_odd_rows(spark):
    run = "same " * 40
    line = " ".join(f"w{k}" for k in range(13))
    rows = [(1, None), (2, ""), (3, " \n\t "), (5, run), (4, run + "end"), (5, run), (6, line), (7, line + " more"),
            (None, line), (8, "w1 w2"), (9, "x " + line.replace(" ", "  ")), (10, "é" * 2000 + " " + line), (7, "other " + line),
            (11, line + " " + line), (2, "again")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert got(rc.digests(docs)) == brute(rows)


def test_empty_table(spark):
    assert rc.digests(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_query(spark):
    sf = "/root/testdata/sf0.01"
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    assert got(queries.op8_recompress(spark, sf)) == brute(rows)
