import random

import corpus_pipeline as cp
from tidewater.llm import quality
from tidewater.llm.common import Scratch

from .test_chosen_path import brute as near_classes
from .test_latent import PHRASE, noise, reach
from .test_recompress import brute as repeated

SF = "/root/testdata/sf0.01"


def test_each_stage_on_its_own_input(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    scratch = Scratch(spark, "pipeline-test")
    seen = [docs]
    for name, stage in cp.STAGES:
        seen.append(scratch.write(stage(spark, seen[-1], SF), name))
    rows = [[(r.doc_id, r.text) for r in d.collect()] for d in seen[:-1]]
    for d in seen[:-1]:
        assert d.columns == docs.columns and d.dtypes == docs.dtypes

    scores = {r.doc_id: r.predicted for r in quality.scores(docs, spark.read.parquet(f"{SF}/labels.parquet")).collect()}
    assert sorted(rows[1]) == sorted((i, t) for i, t in rows[0] if scores[i] == 1)

    stay = {i for i, c, _ in near_classes(rows[1]) if i == c}
    assert sorted(rows[2]) == sorted((i, t) for i, t in rows[1] if i in stay)

    want = {i: (n, gone) for i, n, gone, _ in repeated(rows[2])}
    assert {i for i, _ in rows[3]} == {i for i, _ in rows[2]}
    before = dict(rows[2])
    for i, t in rows[3]:
        assert len(t.split()) == want[i][0] - want[i][1] or "\x85" in t or "\xa0" in t
        assert want[i][1] or t == before[i]
    assert all(r.n_chars == len(r.text) for r in seen[3].collect())

    kept = {i for i, _ in rows[4]}
    items = [r.text for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    leak = {i for i, t in rows[3] if any(x in t for x in items)}
    assert not kept & leak and kept <= {i for i, _ in rows[3]}
    assert len({i for i, _ in rows[3]} - kept - leak) <= 0.01 * len(rows[3])

    last = seen[-1].collect()
    assert {r.doc_id for r in last} == kept and all(r.n_tokens == len(r.ids) for r in last)


def test_odd_rows_through_all_stages(spark):
    text = "These are plain words of a quiet text. It says little, and says it twice."
    rows = [(1, None), (2, ""), (3, text), (3, text), (None, text), (4, text + " And more."), (5, "one two " * 20000)]
    docs = spark.createDataFrame([(i, t, "en", "s", len(t or ""), "x") for i, t in rows],
                                 "doc_id long, text string, lang string, source string, n_chars long, stay_id string")
    scratch = Scratch(spark, "pipeline-odd")
    for name, stage in cp.STAGES[:-1]:
        docs = scratch.write(stage(spark, docs, SF), name)
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars", "stay_id"]
    docs.count()


def test_empty_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(0)
    for name, stage in cp.STAGES:
        out = stage(spark, docs, SF)
        assert out.count() == 0
        docs = out if name != cp.STAGES[-1][0] else docs


def test_run(spark):
    assert cp.run(spark, "/root/testdata/sf0.001").count() > 0


def test_decontamination_is_fitted_on_every_passage(spark, monkeypatch, tmp_path):
    rng = random.Random(7)
    spark.createDataFrame([(1, "an item of some other words")], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    rows = [(k, f"{noise(rng, 96)} {PHRASE} {noise(rng, 1_500)}") for k in range(30)] + [(k, noise(rng, 20)) for k in range(30, 330)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert reach(monkeypatch, lambda: cp.decontamination(spark, docs, str(tmp_path)), PHRASE) > 0.95
