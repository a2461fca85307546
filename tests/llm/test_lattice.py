import itertools
import math
import re
from collections import Counter
from zlib import crc32

import numpy as np

from tidewater.llm import lattice, queries

MODEL = queries.vocabulary("piece_bpe_32k.model")
SF = "/root/testdata/sf0.01"


def base(rows):
    """The contract's base model by its formula."""
    words = lambda t: re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
    c = Counter()
    for i, t in rows:
        if i is not None and crc32(str(i).encode()) % 10:
            c.update([*words(t), None])
    n, v = sum(c.values()), len(c)
    out = []
    for i, t in rows:
        w = [*words(t), None]
        out.append((i, i is not None and crc32(str(i).encode()) % 10 == 0, len(w), sum(c[x] > 0 for x in w), n,
                    sum(math.log10((c[x] + 0.1) / (n + 0.1 * (v + 1))) for x in w)))
    return out


def agree(got, rows):
    key = lambda r: (repr(r[0]), r[2], round(r[5], 6))
    have = sorted(((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, r.base_score) for r in got), key=key)
    want = sorted(base(rows), key=key)
    assert [r[:5] for r in have] == [r[:5] for r in want]
    assert np.allclose([r[5] for r in have], [r[5] for r in want], rtol=1e-9)


def small():
    names = ["<unk>", "<s>", "</s>", *[f"<0x{k:02X}>" for k in range(256)], "▁", "a", "b", "ab", "▁a", "ba", "aba", "▁abab"]
    return lattice.Pieces(names, [0.0] * 259 + [-float(k) for k in range(8)]), names


def by_hand(pieces, names, word):
    """Log of the sum over all cuts, and each piece's expected number."""
    text, index = "▁" + word, {n: i for i, n in enumerate(names)}
    total, seen = 0.0, Counter()
    for cuts in itertools.product([0, 1], repeat=len(text) - 1):
        parts, s = [], 0
        for k, c in enumerate(cuts, 1):
            if c:
                parts.append(text[s:k])
                s = k
        parts.append(text[s:])
        p, used = 1.0, []
        for x in parts:
            if x in index:
                p *= math.exp(pieces.log[index[x]])
                used.append(index[x])
            elif len(x) == 1:
                ids = [pieces.byte[b] for b in x.encode()]
                p *= math.exp(sum(pieces.log[i] for i in ids))
                used += ids
            else:
                p = 0.0
                break
        total += p
        for i in used if p else []:
            seen[i] += p
    return math.log(total), {i: v / total for i, v in seen.items()}


def test_forward_and_expectations_are_sums_over_all_cuts():
    pieces, names = small()
    for word in ["a", "ab", "abab", "babaab", "aéb", "漢a", "zzz"]:
        want, counts = by_hand(pieces, names, word)
        assert np.allclose(lattice.marginals(pieces, [word, word], [pieces.log, pieces.first_log]), want)
        got = np.zeros(len(pieces.log))
        lattice.expected(pieces, [word], np.array([2.0]), got)
        assert np.allclose(got, [2 * counts.get(i, 0.0) for i in range(len(got))], atol=1e-9)


def test_long_words_by_stretches(monkeypatch):
    """The same sums and expectations however few places are held at once."""
    pieces = lattice.read_pieces(MODEL)
    pieces.first_log = np.roll(pieces.log, 7)
    word = "understanding漢é\x00" * 9 + "zzz"
    whole, want = lattice.marginals(pieces, [word, word[::-1]], [pieces.log, pieces.first_log]), np.zeros(len(pieces.log))
    lattice.expected(pieces, [word, word[::-1]], np.array([2.0, 0.5]), want)
    for places in (pieces.longest, 17, 40, len(word), len(word) + 1):
        monkeypatch.setattr(lattice, "STRETCH", places)
        assert np.allclose(lattice.marginals(pieces, [word, word[::-1]], [pieces.log, pieces.first_log]), whole, rtol=1e-12)
        got = np.zeros(len(want))
        lattice.expected(pieces, [word, word[::-1]], np.array([2.0, 0.5]), got)
        assert np.allclose(got, want, rtol=1e-9)


def test_probabilities_sum_to_one():
    pieces = lattice.read_pieces(MODEL)
    assert abs(np.exp(pieces.log).sum() - 1) < 1e-9
    counts = np.zeros(len(pieces.log))
    for word in ("the", "reading"):
        lattice.expected(pieces, [word], np.array([5.0]), counts)
    pieces.reestimate(counts)
    assert abs(np.exp(pieces.log).sum() - 1) < 1e-9


def test_query_and_held_out_likelihood(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    got = queries.op4_lattice(spark, SF).collect()
    agree(got, rows)
    out = [r for r in got if r.held_out]
    assert all(r.score < 0 and math.isfinite(r.score) for r in got)
    # the base gives every unknown word one flat chance, this model spells each of them
    assert sum(r.score for r in out) > 1.15 * sum(r.base_score for r in out)


def test_rounds_raise_the_likelihood(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    total = [sum(r.score for r in lattice.scores(docs, MODEL, rounds=k).collect()) for k in (0, 1, 2)]
    assert total[0] < total[1] < total[2]


def test_score_by_its_formula(spark):
    rows = [(1, "Ab ab cd"), (2, "ab x"), (3, "漢 ab cd"), (10, "new"), *((k, "ab zz") for k in range(20, 30))]
    train = [(i, t) for i, t in rows if crc32(str(i).encode()) % 10]
    got = {r.doc_id: r.score for r in lattice.scores(spark.createDataFrame(rows, "doc_id long, text string"), MODEL,
                                                     rounds=0).collect()}
    pieces = lattice.read_pieces(MODEL)
    c = Counter(w for _, t in train for w in t.lower().split())
    n = sum(c.values()) + len(train)
    once, twice = (sum(v == k for v in c.values()) for k in (1, 2))
    d = min(max(once / (once + 2 * twice), 0.05), 0.95) if once else 0.5
    for i, t in rows:
        want = math.log10(len(train) / n)
        for w in t.lower().split():
            spelt = math.exp(lattice.marginals(pieces, [w], [pieces.log])[0, 0])
            want += math.log10((max(c[w] - d, 0) + d * len(c) * spelt) / n)
        assert abs(got[i] - want) < 1e-9


def test_lattice_score_is_the_vocabularys_marginal(spark):
    """Every cut of every word by the vocabulary's own scores, whatever the corpus taught the model."""
    rows = [(1, "Ab ab cd"), (2, "ab x"), (3, "漢 ab\x00cd ✂"), (10, "new"), *((k, "ab zz") for k in range(20, 30))]
    train = [(i, t) for i, t in rows if crc32(str(i).encode()) % 10]
    got = lattice.scores(spark.createDataFrame(rows, "doc_id long, text string"), MODEL).collect()
    end = len(train) / sum(len(t.split()) + 1 for _, t in train)
    pieces = lattice.read_pieces(MODEL)
    import sentencepiece
    sp = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    names = [sp.id_to_piece(k) for k in range(sp.get_piece_size())]
    for r in got:
        want = math.log10(end)
        for w in dict(rows)[r.doc_id].lower().split(" "):
            want += by_hand(pieces, names, w)[0] / math.log(10) + math.log10(1 - end)
        assert abs(r.lattice_score - want) < 1e-6


def test_odd_rows(spark):
    rows = [(1, None), (2, ""), (3, "One two\tTHREE"), (3, "One two\tTHREE"), (None, "one four"), (10, "ÉÀ ß\x00\x1f x"),
            (11, "w" * 5000), (12, "many " * 20000), (13, "\x0b\x0c one")]
    docs = spark.createDataFrame([(i, t, "z", 3) for i, t in rows], "doc_id long, text string, word string, n int")
    got = lattice.scores(docs, MODEL).collect()
    agree(got, rows)
    assert all(math.isfinite(r.score) and math.isfinite(r.lattice_score) for r in got)


def test_empty_and_untrained(spark):
    assert lattice.scores(spark.createDataFrame([], "doc_id long, text string"), MODEL).count() == 0
    alone = [(i, "a b") for i in range(60) if crc32(str(i).encode()) % 10 == 0][:3]
    agree(lattice.scores(spark.createDataFrame(alone, "doc_id long, text string"), MODEL).collect(), alone)
