import numpy as np
from pyspark.sql import functions as F

from tidewater.llm import caps, queries


def brute(rows, threshold=0.95):
    """(vec_id, n_links, component, kept) of a list of (id, vector)."""
    good = [v is not None and i is not None and len(v) and all(x is not None and np.isfinite(x) for x in v) and any(v)
            for i, v in rows]
    links, parent = [0] * len(rows), {i: i for i, _ in rows if i is not None}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            if good[a] and good[b] and len(rows[a][1]) == len(rows[b][1]):
                x, y = np.array(rows[a][1], float), np.array(rows[b][1], float)
                if x @ y / np.linalg.norm(x) / np.linalg.norm(y) >= threshold:
                    links[a] += 1
                    links[b] += 1
                    p, q = find(rows[a][0]), find(rows[b][0])
                    parent[max(p, q)] = min(p, q)
    return sorted(((i, n, None if i is None else find(i), i is None or find(i) == i) for (i, _), n in zip(rows, links)),
                  key=repr)


def got(df):
    return sorted((tuple(r) for r in df.select("vec_id", "n_links", "component_id", "kept").collect()), key=repr)


def test_odd_rows(spark):
    rng = np.random.default_rng(4)
    base = rng.normal(size=8)
    near = [(20 + k, (base + rng.normal(0, 0.05, 8)).tolist()) for k in range(12)]
    rows = [(1, [1.0, 0.0]), (2, [1.0, 0.0]), (2, [1.0, 0.0]), (3, [2.0, 0.0]), (4, [0.0, 0.0]), (5, None), (6, []),
            (7, [1.0, None]), (8, [float("nan"), 1.0]), (9, [float("inf"), 1.0]), (None, [1.0, 0.0]), (2, [0.0, 1.0]),
            (10, [0.0, 3.0]), (11, [1.0, 0.0, 0.0]), (12, [-1.0, 0.0]), (13, [1e-30, 1e-32]), (14, [5.0]), (15, [7.0]), *near]
    df = spark.createDataFrame([(i, v, 1, 2) for i, v in rows], "vec_id long, embedding array<double>, cls int, m int")
    assert got(caps.near(df)) == brute(rows)


def test_crowded_filters_in_blocks(spark):
    rng = np.random.default_rng(5)
    base = rng.normal(size=(3, 16))
    rows = [(int(k), (base[k % 3] + rng.normal(0, 0.03, 16)).tolist()) for k in range(90)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    assert got(caps.near(df, block=7)) == brute(rows)


def test_empty_table(spark):
    assert caps.near(spark.createDataFrame([], "vec_id long, embedding array<float>")).count() == 0


def test_recall_of_the_query(spark):
    sf = "/root/testdata/sf0.01"
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{sf}/embeddings.parquet").collect()]
    want = {(i, n, c) for i, n, c, _ in brute(rows)}
    have = {(r.vec_id, r.n_links, r.component_id) for r in queries.op6_caps(spark, sf).select(
        "vec_id", F.col("n_links"), "component_id").collect()}
    links = sum(n for _, n, _ in want)
    assert len(have) == len(want) and sum(n for _, n, _ in have) >= 0.99 * links
