import random

import numpy as np

from tidewater.llm import chosen_path as cp


def words(rng, n):
    return [rng.choice("alpha beta gamma delta eps zeta eta theta iota kappa".split()) + str(rng.randint(0, 40)) for _ in range(n)]


def brute(rows, threshold=0.8):
    sets = []
    for _, t in rows:
        w = (t or "").split()
        sets.append({tuple(w[i:i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set())
    links, parent = [0] * len(rows), {i: i for i, _ in rows if i is not None}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            if None in (rows[a][0], rows[b][0]) or not sets[a] or not sets[b]:
                continue
            if len(sets[a] & sets[b]) >= threshold * len(sets[a] | sets[b]):
                links[a] += 1
                links[b] += 1
                p, q = find(rows[a][0]), find(rows[b][0])
                parent[max(p, q)] = min(p, q)
    return sorted(((i, None if i is None else find(i), n) for (i, _), n in zip(rows, links)), key=repr)


def got(df):
    return sorted((tuple(r) for r in df.select("doc_id", "class_id", "n_links").collect()), key=repr)


def family(rng, n, size, edits):
    base = words(rng, size)
    for _ in range(n):
        w = list(base)
        for _ in range(rng.randint(0, edits)):
            w[rng.randrange(len(w))] = "edit%d" % rng.randint(0, 99999)
        yield " ".join(w)


def test_odd_rows_and_families(spark):
    rng = random.Random(3)
    rows = [(1, None), (2, ""), (3, " \t\n"), (4, "a b"), (5, "a b"), (6, "a b c"), (7, "b a"), (8, "a b c d e"),
            (8, "a b c d e"), (9, "a  b\tc d e"), (None, "a b c d e"), (10, "x" * 5000), (11, "long " * 3000),
            (12, "long " * 2000), (8, "other text of this id goes here now")]
    rows += [(100 + k, t) for k, t in enumerate(family(rng, 30, 60, 4))]
    rows += [(200 + k, t) for k, t in enumerate(family(rng, 30, 200, 8))]
    rows += [(300 + k, " ".join(words(rng, rng.randint(5, 80)))) for k in range(40)]
    docs = spark.createDataFrame([(i, t, "k", 1) for i, t in rows], "doc_id long, text string, key string, rep int")
    assert got(cp.near(docs)) == brute(rows)


def test_repeated_ids_with_near_unlike_and_empty_texts(spark):
    rng = random.Random(6)
    base, other, third = (" ".join(words(rng, 60)) for _ in range(3))
    rows = [(3, base), (7, ""), (7, "real text of seven words stands here"), (7, None), (7, " \t"),
            (8, base + " one"), (8, other), (8, other + " two"), (8, other), (9, other + " two three"),
            (4, third + " x"), (5, third), (5, third + " y"), (None, base)]
    docs = spark.createDataFrame([(i, t, k) for k, (i, t) in enumerate(rows)], "doc_id long, text string, row int")
    want = [(3, 3, 1), (7, 7, 0), (7, 7, 0), (7, 7, 0), (7, 7, 0), (8, 3, 1), (8, 8, 3), (8, 8, 3), (8, 8, 3), (9, 8, 3),
            (4, 4, 2), (5, 4, 2), (5, 4, 2), (None, None, 0)]
    assert got(cp.near(docs)) == sorted(want, key=repr)
    kept = cp.representatives(docs)
    assert kept.columns == docs.columns
    stay = sorted(r.row for r in kept.collect())
    assert stay in ([0, 1, 2, 3, 4, 6, 10, 13], [0, 1, 2, 3, 4, 8, 10, 13])


def test_crowded_nodes_and_blocks(spark):
    rng = random.Random(4)
    rows = [(k, t) for k, t in enumerate(family(rng, 150, 80, 2))]
    common = " ".join(words(rng, 60))
    rows += [(1000 + k, common + " " + " ".join(words(rng, 60))) for k in range(150)]   # half alike: no links
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert got(cp.near(docs, block=40)) == brute(rows)


def test_empty_table(spark):
    assert cp.near(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_smoke_documents(spark):
    df = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    assert got(cp.near(df)) == brute([(r.doc_id, r.text) for r in df.collect()])


def test_runs_and_embedding():
    assert cp.runs(0.8) == 4
    s = np.arange(1000, dtype=np.uint64) * np.uint64(7919)
    t = s[100:]
    share = (cp.embed(cp.mixed(s)) == cp.embed(cp.mixed(t))).mean()
    assert abs(share - 0.9) < 0.12
