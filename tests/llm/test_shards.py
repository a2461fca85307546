import json
from collections import Counter

import numpy as np
import pytest

from tidewater.llm import queries, shards
from tidewater.llm.common import Scratch

RANKS = queries.vocabulary("byte_bpe_50k.tiktoken")


@pytest.mark.parametrize("n", [1, 2, 3, 7, 64, 1000, 4097])
def test_permutation_is_a_bijection(n):
    p = shards.Permutation(n, "k")
    s = p.slot(np.arange(n))
    assert sorted(s.tolist()) == list(range(n))
    assert (p.index(s) == np.arange(n)).all()
    if n > 100:
        assert (s != shards.Permutation(n, "other").slot(np.arange(n))).mean() > 0.9
        assert abs(np.corrcoef(s, np.arange(n))[0, 1]) < 0.1


def test_tokens_are_the_library_s():
    tok = shards.Tokens(open(RANKS).read(), 50256)
    for t in ["", "a b", " a  b\n\n c\t", "it's we'll 'tis", "x" * 500, "Ünï çà 12 34!!", "漢字 mixed", "\x00 \x1f", "end  ", "\n", "a\r\n\r\nb",
              "  !? 1a2b", " x", "a ", " ", "a \tb", "a\t b", "a\n b", "a \n\n b", "a\u3000 b", "a \u3000b", "\n x", "a\n ", " 's 'll",
              "don't \u00a0we\u00a0 've", "tab\t", "x \r\n y"]:
        assert tok.of(t).tolist() == [*tok.enc.encode_ordinary(t), 50256]


def check(spark, rows, tmp_path, **options):
    src = Scratch(spark, "t").write(spark.createDataFrame(rows, "doc_id long, text string, slot int").repartition(3), "docs")
    folder = str(tmp_path / "out")
    made = shards.materialise(src, RANKS, folder=folder, **options).collect()
    tok, length = shards.Tokens(open(RANKS).read(), 50256), options["length"]
    got = list(shards.read(folder))
    assert [s for s, _ in got] == list(range(len(made))) == sorted(r.slot for r in made)
    by = {r.slot: r for r in made}
    places = json.loads((tmp_path / "out" / "meta.json").read_text())["places"]
    perm = shards.Permutation(places, options.get("key", "epoch-0"))
    assert [by[s].place for s, _ in got] == sorted(r.place for r in made)      # slots follow the permutation
    stream = {}
    for s, ids in got:
        assert len(ids) == length
        stream[int(perm.index(np.array([by[s].place]))[0])] = ids[:by[s].n_tokens].tolist()
    stream = [stream[k] for k in sorted(stream)]
    docs, now = Counter(), []
    for i in (x for part in stream for x in part):
        now.append(i)
        if i == 50256:
            docs[tuple(now)] += 1
            now = []
    assert not now and docs == Counter(tuple(tok.of(t or "").tolist()) for _, t, _ in rows)
    assert sum(r.n_tokens for r in made) == sum(len(tok.of(t or "")) for _, t, _ in rows)
    assert {i for r in made for i in r.doc_ids} == {i for i, _, _ in rows}
    return folder, got


def test_round_trip(spark, tmp_path):
    rows = [(k, f"word{k} " * (k * 7 % 90), 0) for k in range(120)]
    rows += [(1000, None, 1), (1001, "", 1), (None, "no id", 1), (5, "again", 1), (5, "again", 1), (1002, "long " * 9000, 1)]
    folder, got = check(spark, rows, tmp_path, length=64, shard_bytes=64 * 2 * 10)
    later = list(shards.read(folder, 37, 25))                         # resume anywhere
    assert [s for s, _ in later] == list(range(37, 62))
    assert all((a == b).all() for (_, a), (_, b) in zip(later, got[37:62]))


def test_starts_of_many_shards_are_shuffled(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(shards, "BROADCAST_SHARDS", 3)
    check(spark, [(k, f"word{k} " * (k % 9), 0) for k in range(60)], tmp_path, length=16, shard_bytes=64)


def test_sequence_ends_with_a_document(spark, tmp_path):
    check(spark, [(k, "a", 0) for k in range(64)], tmp_path, length=8, shard_bytes=64)


def test_empty_table(spark, tmp_path):
    check(spark, [], tmp_path, length=16, shard_bytes=64)


def test_query(spark):
    got = queries.op7_shards(spark, "/root/testdata/sf0.01")
    n = got.count()
    assert n == got.select("slot").distinct().count() and n > 0
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    assert got.selectExpr("explode(doc_ids) as d").distinct().count() == docs.select("doc_id").distinct().count()
