import hashlib
import random

import numpy as np
import pytest
from tokenizers import Tokenizer

from tidewater.llm import bpe, queries

VOCAB = queries.vocabulary("word_bpe_49k.json")


@pytest.fixture(scope="module")
def tok():
    return Tokenizer.from_file(VOCAB)


def texts(rng, n):
    alphabets = ["ab'stre", "ÀÉßñÿ÷×µ'S!", "Plain, TEXT's. 12", "abc ", "'smlldve!", "é́e ", "0123a!", "<|endoftext|>x", "漢字かな", "̣́ae'", "aeiou\n\t"]
    for _ in range(n):
        parts = ["".join(rng.choice(a) for _ in range(rng.randint(1, 120))) for a in rng.choices(alphabets, k=rng.randint(1, 6))]
        yield "".join(parts) + rng.choice(["", "<|endoftext|>", " <|startoftext|>'ll", "x" * 700])


def test_tree_concatenation_is_exact(tok):
    rng, enc = random.Random(5), bpe.Encoder(open(VOCAB, encoding="utf-8").read())
    for text in texts(rng, 400):
        want = tok.encode(text, add_special_tokens=False).ids
        assert enc.ids([text, "", text]) == (want + want, [len(want), len(want), 2 * len(want)])
        for leaf in (7, 40, 150):
            at = bpe.cuts(text, leaf)
            leaves = [bpe._edges(enc.spans(text[a:b], a), a, b) for a, b in zip(at, at[1:])]
            assert bpe.fold(enc, text, leaves, at)[:, 0].tolist() == want, (leaf, text)


def test_long_unsplit_text(tok):
    rng, enc = random.Random(6), bpe.Encoder(open(VOCAB, encoding="utf-8").read())
    for alphabet in ("ab", "thequickbrown", "!?-", "a1"):
        text = "".join(rng.choice(alphabet) for _ in range(30_000))
        at = bpe.cuts(text, 4000)
        leaves = [bpe._edges(enc.spans(text[a:b], a), a, b) for a, b in zip(at, at[1:])]
        assert bpe.fold(enc, text, leaves, at)[:, 0].tolist() == tok.encode(text, add_special_tokens=False).ids


def test_rows_match_the_library(spark, tok):
    rng = random.Random(7)
    rows = [(1, None), (2, ""), (3, "a b"), (3, "a b"), (None, "Null id"), (4, "word " * 300), (4, "word " * 300),
            *[(10 + i, t) for i, t in enumerate(texts(rng, 40))]]
    docs = spark.createDataFrame([(i, t, "x", 1) for i, t in rows], "doc_id long, text string, ids string, decoded int")
    enc = bpe.encode(docs, VOCAB, leaf_chars=200)
    got = sorted(((r.doc_id, r.ids, r.decoded) for r in bpe.decode(enc, VOCAB).collect()), key=repr)
    want = []
    for i, t in rows:
        ids = tok.encode(t or "", add_special_tokens=False).ids
        want.append((i, ids, tok.decode(ids, skip_special_tokens=False)))
    assert got == sorted(want, key=repr)


def test_query_digests(spark, tok):
    got = {r.doc_id: r for r in queries.op10_bpe(spark, "/root/testdata/sf0.001").collect()}
    rows = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()
    assert len(got) == len(rows)
    for r in rows:
        ids = tok.encode(r.text or "", add_special_tokens=False).ids
        g = got[r.doc_id]
        assert g.n_tokens == len(ids)
        assert g.ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert g.decoded_sha256 == hashlib.sha256(tok.decode(ids, skip_special_tokens=False).encode()).hexdigest()


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert bpe.digests(docs, VOCAB).count() == 0


def test_offsets_only_near_the_ends():
    t = np.array([[1, 0, 5], [2, 5000, 5005], [3, 9990, 10000]])
    assert bpe._edges(t, 0, 10000)[:, 1].tolist() == [0, -1, 9990]
