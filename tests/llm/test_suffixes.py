import random

import numpy as np

from tidewater.llm.suffixes import Suffixes, Wavelet, blocks, covered, numbered


def random_texts(rng):
    out = []
    for _ in range(rng.randint(1, 4)):
        letters = rng.choice(["a", "ab", "abc", "abcdefgh"])
        out.append([rng.choice(letters) for _ in range(rng.randint(0, 40))])
        if out[-1] and rng.random() < 0.5:
            out[-1] += out[-1][:rng.randint(1, 20)]
    return out


def agree(t, i, j):
    k = 0
    while i + k < len(t) and j + k < len(t) and t[i + k] == t[j + k]:
        k += 1
    return k


def test_order_and_extensions():
    rng = random.Random(3)
    for _ in range(200):
        texts = random_texts(rng)
        s = Suffixes(*numbered(texts))
        bounds = np.cumsum([0, *map(len, texts)])
        # words are numbered by first use: compare suffixes by those numbers
        symbols, _ = numbered(texts)
        for k, t in enumerate(texts):
            num = symbols[bounds[k]:bounds[k + 1]].tolist()
            mine = [p - bounds[k] for p in s.array if s.text[p] == k]
            assert mine == sorted(range(len(t)), key=lambda i: num[i:])
            pairs = [(i, j) for i in range(len(t)) for j in range(i + 1, len(t))][:80]
            if pairs:
                i, j = np.array(pairs).T + bounds[k]
                assert s.ahead(i, j).tolist() == [agree(t, a, b) for a, b in pairs]
                back = t[::-1]
                assert s.behind(i, j).tolist() == [agree(back, len(t) - a, len(t) - b) for a, b in pairs]


def test_wavelet_successor():
    rng = np.random.default_rng(4)
    for n in (1, 2, 17, 300):
        v = rng.permutation(n * 2)[:n]
        w = Wavelet(v)
        lo = rng.integers(0, n, 200)
        hi = lo + 1 + rng.integers(0, n, 200) % (n - lo)
        pick = lo + rng.integers(0, 10 ** 6, 200) % (hi - lo)
        want = [min((x for x in v[a:b] if x > v[p]), default=-1) for a, b, p in zip(lo, hi, pick)]
        assert w.successor(lo, hi, v[pick]).tolist() == want


def test_blocks_keep_every_text_whole():
    texts = [(k, "w " * n) for k, n in enumerate([0, 3, 500, 1, 1, 0, 98, 7])]
    got = list(blocks(iter(texts), words=100))
    assert [x[0] for b in got for x in b] == list(range(8))
    assert all(len(w) == len(t.split()) for b in got for _, t, w in b)
    assert all(sum(len(w) for _, _, w in b) <= 100 or len(b) == 1 for b in got)


def test_covered():
    assert covered(np.array([0, 3, 3]), np.array([2, 1, 3]), 7).tolist() == [1, 1, 0, 1, 1, 1, 0]
    assert covered(np.zeros(0, int), np.zeros(0, int), 0).tolist() == []
