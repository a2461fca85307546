from zlib import crc32

import numpy as np
import pytest

from tidewater.llm import labelled, quality, queries, toxicity

SF = "/root/testdata/sf0.1"


def held(i):
    return i is not None and crc32(str(i).encode()) % 5 == 0


@pytest.mark.parametrize("name,column,threshold,least", [
    ("op9_quality", "quality", 0.3, 0.97), ("op5_toxicity", "toxic", 0.5, 0.98)])
def test_held_out_accuracy(spark, name, column, threshold, least):
    labels = {r.doc_id: r[column] for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    got = queries.LLM_QUERIES[name](spark, SF).collect()
    assert len(got) == spark.read.parquet(f"{SF}/documents.parquet").count()
    assert all(r.held_out == held(r.doc_id) and 0 <= r.score <= 1 and r.predicted == int(r.score >= threshold) for r in got)
    out = [r for r in got if r.held_out and r.doc_id in labels]
    right = [r.predicted == labels[r.doc_id] for r in out]
    assert len(out) > 300 and np.mean(right) >= least
    one = [r.predicted == 1 for r in out if labels[r.doc_id] == 1]
    zero = [r.predicted == 0 for r in out if labels[r.doc_id] == 0]
    # some labelled toxic documents hold no insult at all
    assert np.mean(one) >= 0.85 and np.mean(zero) >= 0.95


def odd(spark):
    rows = [(1, None), (2, ""), (3, "plain words here. More of them."), (3, "plain words here. More of them."),
            (None, "no id"), (4, "x" * 200_000), (5, "!!! ### $$$"), (6, "\n\n\n"), (7, "only one class")]
    return spark.createDataFrame([(i, t, 1, 0, 2.0) for i, t in rows], "doc_id long, text string, y int, quality int, score double")


@pytest.mark.parametrize("labels", [
    [], [(1, 1)], [(1, 0), (3, None), (None, 1)],
    [(1, 1), (2, 0), (3, 1), (3, 0), (4, 0), (5, 0), (6, 1), (7, 1), (99, 1)], [(i, i % 2) for i in range(1, 8)]])
@pytest.mark.parametrize("op,column", [(quality, "quality"), (toxicity, "toxic")])
def test_odd_rows(spark, op, column, labels):
    docs = odd(spark)
    y = spark.createDataFrame([(i, v, "t") for i, v in labels], f"doc_id long, {column} int, text string")
    got = op.scores(docs, y).collect()
    assert len(got) == 9 and all(0 <= r.score <= 1 for r in got)
    by = {}
    for r in got:
        assert by.setdefault(r.doc_id, r) == r          # repeated rows: the same
        assert r.held_out == held(r.doc_id)


@pytest.mark.parametrize("op,column", [(quality, "quality"), (toxicity, "toxic")])
def test_empty_table(spark, op, column):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert op.scores(docs, spark.createDataFrame([], f"doc_id long, {column} int")).count() == 0


def test_sample_has_the_least_hashes_of_each_class(spark):
    """The bound on the hash leaves the sample as it is, for every size of sample and of class."""
    from pyspark.sql import functions as F
    labels = spark.range(20_000).selectExpr("id as doc_id", "cast(id % 20 = 0 as int) as y", "'x' as h")
    all_ = [(r.doc_id, r.y, r.k) for r in labels.withColumn("k", F.xxhash64("doc_id")).collect()]
    for most in (1, 7, 400, 4000, 30_000):
        got = labelled.training_labels(labels, "y", most)
        assert got.columns == ["doc_id", "y"]
        want = [sorted((k, i) for i, y, k in all_ if y == c and not held(i))[:most] for c in (0, 1)]
        assert sorted((r.y, r.doc_id) for r in got.collect()) == sorted((c, i) for c in (0, 1) for _, i in want[c])


@pytest.mark.parametrize("op,column", [(quality, "quality"), (toxicity, "toxic")])
def test_an_id_repeated_very_often_trains_once(spark, op, column):
    """Copies of one labelled row change neither the sample of toxicity nor what the calibration holds."""
    docs = spark.createDataFrame([(i, f"good plain words number {i}" if i % 2 else f"awful !!! words {i}") for i in range(60)],
                                 "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(60)], f"doc_id long, {column} int")
    copies = docs.union(docs.filter("doc_id = 7").crossJoin(spark.range(3000)).select("doc_id", "text"))
    a = {r.doc_id: r.score for r in op.scores(docs, labels, column).collect()}
    got = op.scores(copies, labels, column).collect()
    assert len(got) == 3060 and all(0 <= r.score <= 1 for r in got)
    if op is toxicity:
        assert all(abs(a[r.doc_id] - r.score) < 1e-9 for r in got)


def test_pairs_beyond_additive_weights():
    """An insult and a mention of a group are toxic together only."""
    rng = np.random.default_rng(2)
    words = [f"w{k}" for k in range(200)]
    rows, y = [], []
    for _ in range(3000):
        t = set(rng.choice(words, 8))
        a, b = rng.random() < 0.5, rng.random() < 0.5
        t |= ({"insult"} if a else set()) | ({"group"} if b else set())
        rows.append(np.array(sorted(toxicity.terms(t)), np.int64))
        y.append(float(a and b))
    y = np.array(y)
    m = toxicity.Machine(0.25).fit(rows[:2500], y[:2500], np.ones(2500))
    p = np.array([m.logit(r) >= 0 for r in rows[2500:]])
    assert (p == (y[2500:] == 1)).mean() > 0.97


def test_labels_outside_training_are_not_used(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    from pyspark.sql import functions as F
    flipped = labels.select("doc_id", *[F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0, 1 - F.col(c))
                                        .otherwise(F.col(c)).alias(c) for c in ("quality", "toxic")])
    for op, c in ((quality, "quality"), (toxicity, "toxic")):
        a = {r.doc_id: r.score for r in op.scores(docs, labels, c).collect()}
        b = {r.doc_id: r.score for r in op.scores(docs, flipped, c).collect()}
        assert max(abs(a[k] - b[k]) for k in a) < 1e-9


def test_quality_against_plain_densities():
    """The score is the logistic of the compressed difference of two shrunk normal log densities."""
    rng = np.random.default_rng(4)
    d = 5
    xs = {0: rng.normal(0, 1, (400, d)), 1: rng.normal(0.7, 1, (300, d)) @ rng.normal(0, 1, (d, d))}
    model = quality.Discriminant({c: (float(len(x)), x.sum(0), x.T @ x) for c, x in xs.items()})
    pooled = sum(len(x) * np.cov(x.T, bias=True) for x in xs.values()) / 700

    def log_density(x, c):
        s = (1 - quality.SHRINK_POOLED) * np.cov(xs[c].T, bias=True) + quality.SHRINK_POOLED * pooled
        s = (1 - quality.SHRINK_DIAGONAL) * s + quality.SHRINK_DIAGONAL * np.diag(np.diag(s)) + quality.TAU * np.eye(d)
        gap = x - xs[c].mean(0)
        return -0.5 * (gap @ np.linalg.solve(s, gap) + np.linalg.slogdet(s)[1])

    at = np.vstack([xs[0][:30], xs[1][:30], 100 * xs[1][:3]])
    diff = np.array([log_density(x, 1) - log_density(x, 0) for x in at])
    z = model.slope * np.sign(diff) * np.log1p(np.abs(diff)) + model.offset
    assert np.allclose(model.score(at), 1 / (1 + np.exp(-np.clip(z, -30, 30))), atol=1e-9)


def test_toxicity_against_all_pairs():
    """The logit is the weights' sum and the inner product of every pair of a text's terms."""
    rng = np.random.default_rng(5)
    rows = [np.unique(rng.integers(0, 60, 12)) for _ in range(600)]
    y = np.array([float(7 in r and 9 in r or 11 in r) for r in rows])
    m = toxicity.Machine(float(y.mean())).fit(rows, y, np.ones(len(rows)))
    for r in rows[:100]:
        own = [k for k in m.index[r] if k >= 0]
        want = m.w0 + sum(m.w[k] for k in own) + sum(float(m.v[a] @ m.v[b]) for i, a in enumerate(own) for b in own[:i])
        assert abs(m.logit(r) - want) < 1e-9


def test_passing_keeps_whole_rows(spark):
    """Every column of every row that scores enough, whatever it is called; the same decisions as the scores."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").selectExpr("*", "n_chars as x", "lang as score", "array(doc_id) as row")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    out = quality.passing(docs, labels)
    assert out.schema == docs.schema
    kept = {r.doc_id for r in quality.scores(docs, labels).filter("predicted = 1").collect()}
    assert 0 < len(kept) < 1000 and {r.doc_id: r for r in out.collect()} == {r.doc_id: r for r in docs.collect() if r.doc_id in kept}
