import hashlib
import json
import random
import zlib

import pytest

from tidewater.llm import merkle


def sha(x):
    return hashlib.sha256(x.encode()).hexdigest()


def leaf(row):
    return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row))


def tree(nodes):
    """(root, for every node the siblings by level) by the plain definition."""
    paths, at, root = [[] for _ in nodes], list(range(len(nodes))), list(nodes)
    while len(root) > 1:
        for k, p in enumerate(at):
            lo = p // 16 * 16
            paths[k].append((p - lo, [x for q, x in enumerate(root[lo:lo + 16], lo) if q != p]))
        at = [p // 16 for p in at]
        root = [sha("".join(root[i:i + 16])) for i in range(0, len(root), 16)]
    return root[0], paths


def fold(value, path):
    for slot, others in path:
        value = sha("".join(others[:slot] + [value] + others[slot:]))
    return value


def brute(rows):
    """(doc_id, leaf, subroot, root, proof_sha256, folded_root, verified) of (doc_id, source, lang, n_chars, text)."""
    sources = sorted({r[1] for r in rows}, key=lambda s: (s is not None, (s or "").encode()))
    trees = {}
    for s in sources:
        mine = sorted((r for r in rows if r[1] == s), key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))
        trees[s] = (mine, *tree([leaf(r) for r in mine]))
    root, over = tree([trees[s][1] for s in sources])
    out = []
    for s, above in zip(sources, over):
        mine, subroot, paths = trees[s]
        for r, path in zip(mine, paths):
            path = path + above
            shown = r
            if r[0] is not None and zlib.crc32(str(r[0]).encode()) % 5 == 0 and r[4] is not None:
                low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in r[4])
                shown = (*r[:4], low)
            f = fold(leaf(shown), path)
            out.append((r[0], leaf(r), subroot, root, sha("".join(x for _, o in path for x in o)), f, f == root))
    return sorted(out, key=repr)


COLS = ("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")
SCHEMA = "doc_id long, source string, lang string, n_chars long, text string"


def got(df):
    return sorted((tuple(r) for r in df.select(*COLS).collect()), key=repr)


@pytest.mark.parametrize("n,first", [(1, 0), (2, 0), (16, 0), (17, 0), (300, 0), (4096, 0), (4097, 4096), (9000, 8192), (9000, 4096)])
def test_units(n, first):
    """A unit's digests and proofs are those of the whole tree, up to the unit's top node."""
    nodes = [sha(str(k)) for k in range(n)]
    mine = nodes[first:first + merkle.UNIT]
    made, _ = merkle.climb(mine, n, first)
    paths = merkle.descend(mine, n, first, [[0, ["top"]]])
    whole = tree(nodes)[1]
    levels = len(made) - 1
    for k in range(0, len(mine), max(len(mine) // 50, 1)):
        assert [tuple(s) for s in paths[k]] == [*whole[first + k][:levels], (0, ["top"])]
        assert fold(mine[k], whole[first + k][:levels]) == made[-1][0]


def rows_of(rng, n, sources):
    return [(rng.choice([None, *range(n)]) if rng.random() < 0.05 else k, rng.choice(sources), rng.choice([None, "de", "en"]),
             rng.choice([None, 3, -4]), rng.choice([None, "", "Abc É ß", f"Text {k}", "same"])) for k in range(n)]


@pytest.mark.parametrize("n,sources", [(1, ["a"]), (40, [None, "", "a", "Z", "é", "字"]), (700, ["hot"] * 9 + ["b"]), (300, [f"s{k}" for k in range(200)])])
def test_whole_manifest(spark, n, sources):
    rows = rows_of(random.Random(n), n, sources)
    rows += rows[:5]                                    # repeated rows
    docs = spark.createDataFrame([(*r, "x", 1) for r in rows], SCHEMA + ", leaf string, idx int")
    assert got(merkle.digests(docs)) == brute(rows)


def test_several_heights(spark, monkeypatch):
    monkeypatch.setattr(merkle, "HEIGHT", 1)
    monkeypatch.setattr(merkle, "UNIT", 16)
    rows = rows_of(random.Random(7), 900, ["hot"] * 400 + [None] + [f"s{k}" for k in range(90)])
    assert got(merkle.digests(spark.createDataFrame(rows, SCHEMA))) == brute(rows)


def test_proofs_are_given_and_lead_to_the_root(spark):
    rows = rows_of(random.Random(8), 200, ["a", "b", None])
    docs = spark.createDataFrame(rows, SCHEMA)
    out = merkle.manifest(docs, merkle.leaf(merkle.FIELDS), with_proof=True).collect()
    assert len(out) == 200 and all(r.verified and merkle.fold(r.leaf, json.loads(r.proof)) == r.root for r in out)


def test_empty_table(spark):
    out = merkle.digests(spark.createDataFrame([], SCHEMA))
    assert out.count() == 0 and set(COLS) <= set(out.columns)
