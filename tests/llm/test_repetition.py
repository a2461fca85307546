import random
from collections import Counter, defaultdict

from tidewater.llm import repetition as rp
from tidewater.llm.common import WORD


def brute(w, least):
    """(words in repeated windows of 3, maximal repeats, their words, the longest) by listing all substrings."""
    n, at = len(w), defaultdict(list)
    for size in range(1, n):
        for i in range(n - size + 1):
            at[tuple(w[i:i + size])].append(i)
    repeats, cover, longest = 0, set(), 0
    for g, places in at.items():
        size = len(g)
        if len(places) < 2 or size < least:
            continue
        longest = max(longest, size)
        before = {w[i - 1] if i else None for i in places}
        after = {w[i + size] if i + size < n else None for i in places}
        if len(before) > 1 and len(after) > 1:
            repeats += 1
            cover.update(k for i in places for k in range(i, i + size))
    three = Counter(tuple(w[i:i + 3]) for i in range(n - 2))
    window = {k for i in range(n - 2) if three[tuple(w[i:i + 3])] > 1 for k in (i, i + 1, i + 2)}
    return len(window), repeats, len(cover), longest


def test_random_texts(monkeypatch):
    monkeypatch.setattr(rp, "MIN_REPEAT", 4)
    rng = random.Random(2)
    for _ in range(400):
        texts = []
        for _ in range(rng.randint(1, 4)):
            letters = rng.choice(["a", "ab", "abc", "abcdefgh"])
            t = [rng.choice(letters) for _ in range(rng.randint(0, 25))]
            if rng.random() < 0.6:
                t += rng.choice([t, t[:9], t[3:12]]) + [rng.choice(letters) for _ in range(rng.randint(0, 5))]
            texts.append(t)
        m = rp.measured([(k, " ".join(t), t) for k, t in enumerate(texts)])
        got = zip(*[m[c].tolist() for c in ("n_repeat_words", "n_repeats", "covered_words", "longest_repeat")])
        assert list(got) == [brute(t, 4) for t in texts]


def prose(rng, n):
    return [f"w{rng.randint(0, 10 ** 6)}" for _ in range(n)]


def expected(i, text):
    w = WORD.findall(text or "")
    lines = [x for x in (text or "").split("\n") if WORD.search(x)]
    window, repeats, cover, longest = brute(w, rp.MIN_REPEAT)
    return (i, len(w), sum(map(len, w)), sum((text or "").count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), window,
            repeats, cover, longest, len(w) < 50 or 100 * window > 50 * len(w))


def test_odd_rows(spark):
    rng = random.Random(5)
    part = " ".join(prose(rng, 20))
    rows = [(1, None), (2, ""), (3, " \n \n"), (4, "a\na\n a\n\na\x0b\n#|<é 字"), (4, "a\na\n a\n\na\x0b\n#|<é 字"), (None, part),
            (5, "same " * 70), (6, " ".join(prose(rng, 60))), (7, f"{part} x {part}\n{part}"), (8, "y" * 9000)]
    docs = spark.createDataFrame([(i, t, 1, True) for i, t in rows], "doc_id long, text string, n_words int, kept boolean")
    out = rp.rules(docs)
    assert out.columns == ["doc_id", *rp.COUNTS, "base_failed", "kept"]
    got = [tuple(r) for r in out.select("doc_id", *rp.COUNTS[:7], "longest_repeat", "base_failed").collect()]
    assert sorted(got, key=repr) == sorted((expected(i, t) for i, t in rows), key=repr)


def test_verdict(spark):
    rng = random.Random(6)
    clean, long_ = " ".join(prose(rng, 400)), prose(rng, 60)
    short = " ".join(prose(rng, 12))
    docs = {
        1: clean,
        2: f"{clean} {clean}",                                            # all of it twice: by the base rule
        3: " ".join(long_ + prose(rng, 240) + long_),                     # 60 words twice, 33 % covered
        4: " ".join([short, *prose(rng, 400), short]),                    # a short repeat in a long text
        5: " ".join(x for k in range(9) for x in (short, *prose(rng, 20))),   # many short ones, 37 %
        6: " ".join(long_ + prose(rng, 900) + long_),                     # 60 words twice, of a thousand
        7: " ".join(prose(rng, 49)), 8: " ".join(prose(rng, 50)),
    }
    kept = {r.doc_id: r.kept for r in rp.rules(spark.createDataFrame(list(docs.items()), "doc_id long, text string")).collect()}
    assert kept == {1: True, 2: False, 3: False, 4: True, 5: False, 6: True, 7: False, 8: True}


def test_empty_table(spark):
    assert rp.rules(spark.createDataFrame([], "doc_id long, text string")).count() == 0
