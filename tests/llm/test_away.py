"""Queries where the workers cannot import the package: another working folder, no PYTHONPATH."""

import os
import subprocess
import sys

import pytest

from tidewater.llm import latent, recompress

SF = "/root/testdata/sf0.001"
ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.mark.parametrize("names", [["op3_latent", "op4_lattice"], ["op1_html", "op2_chosen_path", "op5_toxicity"],
                                   ["op11_repetition", "op12_merkle", "op13_runs"]])
def test_runs_away_from_the_repository(tmp_path, names):
    code = f"""
import sys; sys.path.insert(0, {ROOT!r})
from tidewater.session import build_session
from tidewater.llm.queries import LLM_QUERIES
s = build_session("local[2]", shuffle_partitions=2)
for n in {names!r}:
    print("ROWS", n, len(LLM_QUERIES[n](s, {SF!r}).collect()))
"""
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    got = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=400)
    assert got.stdout.count("ROWS") == len(names), got.stderr[-3000:]


def test_clean_with_clashing_columns(spark):
    docs = spark.createDataFrame([(1, "the quick brown fox jumps over the lazy dog near the old river bank today", 5, 6, 7, 8),
                                  (2, "nothing of the kind", 1, 2, 3, 4), (None, None, 0, 0, 0, 0)],
                                 "doc_id long, text string, leak_id int, leak_mark int, mark int, row int")
    bench = spark.createDataFrame([(9, "the quick brown fox jumps over the lazy dog near the old river bank today")], "item_id long, text string")
    out = latent.clean(docs, bench)
    assert out.schema == docs.schema and sorted(map(repr, out.collect())) == sorted(map(repr, docs.filter("doc_id is null or doc_id = 2").collect()))


def test_the_two_halves_of_a_text_key_are_independent(spark):
    """Where the first halves are alike the second ones are not a function of them: both are parts of one sha256."""
    import hashlib
    docs = spark.createDataFrame([(k, f"text {k}" if k else "") for k in range(50)], "doc_id long, text string")
    for r in recompress.marked(docs).collect():
        sha = hashlib.sha256(r.text.encode()).digest()
        assert (r.k1, r.k2) == (int.from_bytes(sha[:8], "big", signed=True), int.from_bytes(sha[8:16], "big", signed=True))
