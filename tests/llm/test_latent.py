import random

import numpy as np
from pyspark.sql import functions as F

from tidewater.llm import latent, queries

SF = "/root/testdata/sf0.01"


def lcs(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        old = row[:]
        for k, y in enumerate(b):
            row[k + 1] = old[k] + 1 if x == y else max(row[k], old[k + 1])
    return row[-1]


def test_subsequence_is_exact():
    rng = random.Random(1)
    for _ in range(200):
        a, b = ([rng.choice("abcde") for _ in range(rng.randint(0, 30))] for _ in range(2))
        assert latent.subsequence(a, b) == lcs(a, b)


def test_place_is_the_best_of_all_stretches():
    rng, found = random.Random(2), 0
    for _ in range(300):
        item = [rng.choice("abcdefgh") for _ in range(rng.randint(3, 12))]
        words = [rng.choice("abcdefghxyz") for _ in range(rng.randint(0, 60))]
        if rng.random() < 0.5:      # the item's words out of order twice, in order (with others between) once
            mixed = lambda: rng.sample(item, len(item))
            words = [*mixed(), *words[:20], *[x for w in item for x in (w, "z")[:rng.randint(1, 2)]], *words[20:], *mixed()]
        lo, hi = 0, rng.randint(len(words) // 2, len(words))
        got = latent.Benchmark.place(item, [], words, lo, hi)
        width = min(hi - lo, len(item) + max(4, len(item) // 4))
        best = max(lcs(item, words[a:a + width]) for a in range(lo, hi - width + 1))
        if got is None:
            assert lcs(item, words[lo:hi]) < latent.PART * len(item)
            continue
        share, a, b = got
        assert share == best / len(item) == lcs(item, words[a:b]) / len(item) and b - a == width and lo <= a <= b <= hi
        found += 1
    assert found > 100


def test_query_finds_the_items_that_stand_whole(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").collect()
    items = {r.item_id: b" ".join(latent.tokens(r.text)).decode() for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()}
    want = {}
    for r in docs:
        text = b" ".join(latent.tokens(r.text)).decode()
        want[r.doc_id] = {i for i, t in items.items() if f" {t} " in f" {text} "}
    got = {r.doc_id: set(r.item_ids) for r in queries.op3_latent(spark, SF).collect()}
    assert set(got) == set(want)
    pairs = sum(map(len, want.values()))
    found = sum(len(want[k] & got[k]) for k in want)
    extra = sum(bool(got[k] - want[k]) for k in want if not want[k])
    assert pairs > 10 and found >= 0.97 * pairs and extra <= 0.01 * len(want)


def rows_with_leaks(spark, seed=3):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("bcdfglmnprst") + rng.choice("aeiou") for _ in range(rng.randint(2, 4)))
    prose = lambda n: " ".join(rng.choice(["the", "of", "and", word()]) for _ in range(n))
    items = [(k, f"{prose(20)}. {prose(10)}. {prose(6)}.") for k in range(12)]
    docs, want = [], {}
    for k, (i, t) in enumerate(items):
        words = t.split()
        docs.append((100 + k, f"{prose(60)} {t} {prose(50)}"))
        want[100 + k] = {i}
        changed = [w if rng.random() > 0.12 else word() for w in words]      # a paraphrase: some words replaced
        docs.append((200 + k, f"{prose(40)}\n{' '.join(changed).upper()}\n{prose(80)}"))
        want[200 + k] = {i}
    docs += [(300 + k, prose(150)) for k in range(40)]
    return items, docs, want


def test_exact_and_paraphrased_leaks(spark):
    items, docs, want = rows_with_leaks(spark)
    d = spark.createDataFrame(docs, "doc_id long, text string")
    b = spark.createDataFrame(items, "item_id long, text string")
    got = {r.doc_id: {x.item_id for x in r["items"]} for r in latent.decontaminate(d, b).collect()}
    assert all(want[k] <= got[k] for k in range(100, 112))
    assert sum(want[k] <= got[k] for k in range(200, 212)) >= 11
    assert not any(got[k] for k in range(300, 340))
    parts = {r.doc_id: {x.item_id for x in r["items"]} for r in latent.decontaminate(d, b, part_bytes=700).collect()}
    assert parts == got


def test_odd_rows(spark):
    items, docs, _ = rows_with_leaks(spark)
    leak = items[0][1]
    rows = [(1, None), (2, ""), (None, leak), (3, leak), (3, leak), (3, "nothing of it"), (4, "!!! ..."), (5, leak * 400),
            (6, "long " * 30000), *docs[-20:]]
    d = spark.createDataFrame([(i, t, "a", 1) for i, t in rows], "doc_id long, text string, items string, item_id int")
    b = spark.createDataFrame([*items, (50, None), (51, ""), (52, "..."), (0, items[0][1])], "item_id long, text string")
    got = [(r.doc_id, r.contaminated) for r in latent.decontaminate(d, b).collect()]
    want = [(i, bool(t) and leak in t) for i, t in rows]
    assert sorted(got, key=repr) == sorted(want, key=repr)
    kept = latent.clean(d, b)
    assert kept.columns == d.columns
    assert sorted(((r.doc_id, r.text) for r in kept.collect()), key=repr) == sorted(
        ((i, t) for i, t in rows if not (t and leak in t)), key=repr)


def test_repeated_rows_by_parts(spark):
    items, docs, _ = rows_with_leaks(spark)
    two = items[0][1] + " and then " + items[5][1]
    rows = [(1, two), (1, two), (1, two), (None, two), (None, two), (1, "nothing"), (None, None), (None, ""), (2, items[3][1]), *docs[-4:]]
    d = spark.createDataFrame(rows, "doc_id long, text string")
    b = spark.createDataFrame([*items, items[5], (90, items[0][1])], "item_id long, text string")
    got = [sorted(((r.doc_id, r.n_items, sorted(x.item_id for x in r["items"])) for r in latent.decontaminate(
        d, b, part_bytes=size).collect()), key=repr) for size in (latent.MAX_BENCHMARK_BYTES, 700)]
    assert got[0] == got[1]
    want = [0, 5, 5, 90]
    assert [x for x in got[1] if x[1]] == sorted([(1, 4, want)] * 3 + [(None, 4, want)] * 2 + [(2, 1, [3])], key=repr)


def test_empty_tables(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    items = spark.createDataFrame([(1, "some words of an item here")], "item_id long, text string")
    assert latent.report(none, items).count() == 0
    docs = spark.createDataFrame([(1, "some words of an item here")], "doc_id long, text string")
    assert [r.contaminated for r in latent.report(docs, items.limit(0)).collect()] == [False]


def test_products_are_those_of_all_passages(monkeypatch):
    rng = np.random.default_rng(4)
    texts = [rng.integers(0, 50, n).astype("<u2") for n in (0, 1, 5, 8, 9, 16, 17, 24, 33, 0, 400, 3)]
    lift = rng.random(len(texts)).astype(np.float32) + 0.5
    rows = np.vstack([rng.normal(size=(latent.TERMS, 6)), np.zeros((1, 6))]).astype(np.float32)
    want = np.zeros((latent.TERMS, 6))
    for ids, w in zip(texts, lift):
        for k in range(0, max(len(ids) - 8, 1), 8) if len(ids) else ():
            np.add.at(want, ids[k:k + 16], w ** 2 * rows[ids[k:k + 16]].sum(axis=0))
    cut = [latent.blocks(ids) for ids in texts]
    own = np.repeat(np.arange(len(cut)), [len(x) for x in cut])
    for size in (1, 2, 5, 1 << 16):
        monkeypatch.setattr(latent, "FIT_BLOCKS", size)
        got = np.zeros((latent.TERMS, 6))
        latent.add_products(np.concatenate(cut), own, lift[own] ** 2, rows, got)
        assert np.allclose(got, want, atol=1e-3)


def test_candidates_are_those_of_each_text_alone(monkeypatch):
    items, docs, _ = rows_with_leaks(None)
    rng = np.random.default_rng(5)
    idf = rng.random(latent.TERMS) + 0.5
    bench = latent.Benchmark([(i, t, None) for i, t in items], idf, rng.normal(size=(latent.TERMS, 8)).astype(np.float32))
    texts = [latent.buckets(latent.tokens(t)) for _, t in [*docs, (0, ""), (0, "one"), *items, (0, " ".join(t for _, t in docs))]]
    want = []
    for k, ids in enumerate(texts):
        if len(ids):
            v, held = (latent.passage_sums(ids, x) for x in (bench.scaled, bench.rare))
            cosine = v @ bench.vectors.T / np.linalg.norm(v, axis=1)[:, None]
            want += [(k, i, p * latent.STRIDE) for p, i in zip(*np.nonzero(held >= bench.need))
                     if cosine[p, bench.first[i]:bench.first[i + 1]].max() >= latent.COSINE]
    assert len(want) > 50
    for size in (1, 7, 1_024):
        monkeypatch.setattr(latent, "COMPARED", size)
        assert list(bench.candidates(texts)) == want


def reach(monkeypatch, run, phrase):
    """How much of a phrase's TF-IDF vector the directions fitted in ``run`` hold."""
    seen, search = [], latent.search
    with monkeypatch.context() as m:
        m.setattr(latent, "search", lambda rows, bench: seen.append(bench) or search(rows, bench))
        run()
    directions = seen[0].scaled[:-1] / seen[0].idf[:, None]
    v = np.bincount(latent.buckets(latent.tokens(phrase)), minlength=latent.TERMS) * seen[0].idf
    return np.linalg.norm(v @ directions) / np.linalg.norm(v)


def noise(rng, n):
    return " ".join(f"w{rng.randrange(300)}" for _ in range(n))


PHRASE = " ".join(f"phrase{k}" for k in range(14))


def test_directions_are_fitted_on_every_document(spark, monkeypatch):
    rng = random.Random(6)
    ids = [r.id for r in spark.range(4_000).orderBy(F.xxhash64("id")).collect()]
    docs = [(i, noise(rng, 20)) for i in ids[:-60]] + [(i, f"{PHRASE} {noise(rng, 6)}") for i in ids[-60:]]
    d = spark.createDataFrame(docs, "doc_id long, text string")
    b = spark.createDataFrame([(1, "an item of some other words")], "item_id long, text string")
    assert reach(monkeypatch, lambda: latent.decontaminate(d, b), PHRASE) > 0.95
