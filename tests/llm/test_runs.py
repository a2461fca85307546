import hashlib
import random
import time
from fractions import Fraction

import pytest

from tidewater.llm import queries, runs
from tidewater.llm.common import WORD
from tidewater.llm.suffixes import numbered


def brute(w):
    """Every run: (start, length, period), by comparing the words with themselves at every distance."""
    n, out = len(w), []
    for q in range(1, n // 4 + 1):
        i = 0
        while i + q < n:
            s = i
            while i + q < n and w[i] == w[i + q]:
                i += 1
            size = i - s + q
            if i > s and size >= max(6, 4 * q) and not any(
                    q % d == 0 and w[s:s + size - d] == w[s + d:s + size] for d in range(1, q)):
                out.append((s, size, q))
            i += i == s
    return sorted(out, key=lambda r: (r[0], r[2]))


def row(i, text):
    w = runs.rotated(i, WORD.findall(text or ""))
    found = brute(w)
    gone = {k for s, size, q in found for k in range(s + q, s + size)}
    best = min(found, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2])) if found else (None, None, None)
    sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
    return (i, len(w), len(found), *best, best[1] and 1000 * best[1] // best[2],
            sha("".join("%d,%d,%d\n" % r for r in found)), sha(" ".join(x for k, x in enumerate(w) if k not in gone)))


def got(df):
    return sorted((tuple(r) for r in df.select("doc_id", "n_words", "n_runs", "start", "length", "period", "exponent_milli",
                                               "runs_sha256", "collapsed_sha256").collect()), key=repr)


def random_text(rng):
    letters = rng.choice(["ab", "a", "abc", "abcdefgh"])
    t = [rng.choice(letters) for _ in range(rng.randint(0, 40))]
    for _ in range(rng.randint(0, 3)):
        p = [rng.choice(letters) for _ in range(rng.randint(1, 9))]
        t += (p * rng.randint(1, 9))[:rng.randint(1, 60)] + [rng.choice(letters) for _ in range(rng.randint(0, 4))]
    return t


def test_every_run_of_random_texts():
    rng = random.Random(1)
    for _ in range(400):
        texts = [random_text(rng) for _ in range(rng.randint(1, 4))]
        r = runs.find(*numbered(texts))
        found = [[] for _ in texts]
        for t, s, n, q in zip(r.text, r.start, r.length, r.period):
            found[t].append((s, n, q))
        assert found == [brute(t) for t in texts]


def test_nested_and_long_periods():
    inner = ["a", "b"] * 6 + ["c"]
    texts = [inner * 5, [str(k) for k in range(700)] * 4, [str(k) for k in range(700)] * 4 + ["end"], ["x"] * 6, ["x"] * 5]
    r = runs.find(*numbered(texts))
    assert [(t, s, n, q) for t, s, n, q in zip(r.text, r.start, r.length, r.period) if t] == \
        [(1, 0, 2800, 700), (2, 0, 2800, 700), (3, 0, 6, 1)]
    assert sorted(zip(*[x[r.text == 0].tolist() for x in (r.start, r.length, r.period)])) == sorted(brute(texts[0]))


def test_greatest_and_ties():
    assert runs.greatest([(0, 8, 2), (9, 4, 1), (3, 4, 1)]) == (0, 8, 2)
    assert runs.greatest([(5, 12, 3), (5, 8, 2), (7, 9, 2)]) == (7, 9, 2)
    assert runs.greatest([(5, 12, 3), (5, 8, 2)]) == (5, 8, 2)


def test_odd_rows(spark):
    one = "word " * 30
    rows = [(1, None), (2, ""), (3, " \n\t\x0b "), (4, one), (4, one), (None, one), (5, "a b " * 9 + "é 字 " * 7), (6, "\x00 " * 8),
            (7, "x" * 50_000 + " y"), (None, None)] + [(k, "a b c " * 9 + "d") for k in range(10, 60)]
    docs = spark.createDataFrame([(i, t, "z", 3) for i, t in rows], "doc_id long, text string, runs_sha256 string, period int")
    assert got(runs.digests(docs)) == sorted((row(i, t) for i, t in rows), key=repr)
    plain = runs.runs(docs.filter("doc_id in (4, 5)"))
    assert sorted(map(tuple, plain.collect())) == [(4, 0, 30, 1), (4, 0, 30, 1), (5, 0, 18, 2), (5, 18, 14, 2)]


def test_a_very_long_text_is_fast():
    words = [str(k % 1000) for k in range(200_000)] + ["a"] * 200_000
    start = time.time()
    r = runs.find(*numbered([words]))
    assert (1000, 200_000) in set(zip(r.period.tolist(), r.length.tolist())) and (1, 200_000) in set(zip(r.period.tolist(), r.length.tolist()))
    assert time.time() - start < 20


@pytest.mark.parametrize("name", ["doc_id long, text string"])
def test_empty_table(spark, name):
    assert runs.digests(spark.createDataFrame([], name)).count() == 0


def test_query(spark):
    sf = "/root/testdata/sf0.001"
    rows = spark.read.parquet(f"{sf}/documents.parquet").collect()
    assert got(queries.op13_runs(spark, sf)) == sorted((row(r.doc_id, r.text) for r in rows), key=repr)
