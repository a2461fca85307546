"""Embedding near-dedup by spherical-cap filters.

A filter is a direction; a vector falls into it if their inner product is above
a threshold. The directions are structured: after a random rotation, a product
code of PARTS short codebooks spans CODES ** PARTS directions, and a vector's
directions above the threshold are listed part by part, without looking at the
others; one that exceeds none goes to its nearest direction. Vectors that are near each other share filters. Vectors are joined on
filters and every two that share one are verified by their cosine in double
precision. ROTATIONS independent codes are used, so that a vector that lies
badly to one of them is found by another.

The size of a codebook follows the number of vectors, so that a filter holds
about as many unrelated vectors at any size. A pair that shares several filters
counts in the first of them only. A crowded filter (near copies) is cut into
blocks and each two blocks meet in a task of their own; equal vectors go
through as one with their number.

Null, zero and non-finite vectors, and those with null components, link with
nothing. Vectors of different lengths don't link. Rows that repeat a vec_id are
vectors of their own (each counts as a link of the others if it is near), but
one node of a component. A row with a null vec_id is returned with no links and
a null component. An empty table gives no rows.
"""

from __future__ import annotations

import math
from statistics import NormalDist

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Scratch, components, groups, least_labels, spread

THRESHOLD = 0.95
ROTATIONS, PARTS, PER_ROTATION = 6, 2, 10     # filters of a vector in one rotation, on average
CROWD = 16                                    # unrelated vectors in a filter, on average
BLOCK = 768
SEED = 20


def code_size(n: int) -> int:
    """Codewords in each part's book, for n vectors."""
    return max(64, math.ceil((n * PER_ROTATION / CROWD) ** (1 / PARTS)))


class Codes:
    """The rotations and codebooks for vectors of one length."""

    def __init__(self, dim: int, size: int):
        self.parts = min(PARTS, dim)
        self.size = size
        self.cut = NormalDist().inv_cdf(1 - PER_ROTATION / size ** self.parts) / math.sqrt(dim) \
            if size ** self.parts > PER_ROTATION else 0.0
        self.tables = []
        for r in range(ROTATIONS):
            rng = np.random.default_rng([SEED, r, dim])
            turn = np.linalg.qr(rng.normal(size=(dim, dim)))[0]
            books = []
            for part in np.array_split(np.arange(dim), self.parts):
                book = rng.normal(size=(size, len(part)))
                book /= np.linalg.norm(book, axis=1)[:, None]
                books.append(turn[:, part] @ book.T / math.sqrt(self.parts))     # dim x size
            self.tables.append(books)

    def listed(self, x: np.ndarray) -> list[np.ndarray]:
        """For each row the sorted ids of its filters over all rotations."""
        found: list[list[np.ndarray]] = [[] for _ in range(len(x))]
        for r, books in enumerate(self.tables):
            parts = [x @ b for b in books]
            top = [p.max(axis=1) for p in parts]
            for i in range(len(x)):
                # partial codes are dropped as soon as even the best rest can't lift them over the cut
                ids, sums = np.zeros(1, np.int64), np.zeros(1)
                for k, p in enumerate(parts):
                    rest = sum(t[i] for t in top[k + 1:])
                    s = sums[:, None] + p[i][None, :]
                    a, b = np.nonzero(s >= self.cut - rest)
                    ids, sums = ids[a] * self.size + b, s[a, b]
                if not len(ids):                            # over no cut: its nearest direction
                    for p in parts:
                        ids = ids * self.size + int(p[i].argmax()) if len(ids) else np.array([int(p[i].argmax())])
                found[i].append(ids + r * self.size ** self.parts)
        return [np.sort(np.concatenate(f)) for f in found]


def sound(v: str):
    """Not null, without null or non-finite components, not all zero."""
    return (F.col(v).isNotNull() & ~F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
            & F.exists(v, lambda x: x != 0))


def name(v: str):
    """The same for equal vectors, 128 bits."""
    return F.md5(F.concat_ws(",", F.col(v).cast("array<string>")))


def classes(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """Valid vectors: (vec_id, v, cls)."""
    return (vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("v"))
            .filter(F.col("vec_id").isNotNull() & sound("v")).withColumn("cls", name("v")))


def near(vectors: DataFrame, threshold: float = THRESHOLD, id_col: str = "vec_id", vector_col: str = "embedding",
         block: int = BLOCK) -> DataFrame:
    """(vec_id, n_links, component_id, kept) of every row."""
    spark = vectors.sparkSession
    scratch = Scratch(spark, "caps")
    members = classes(vectors, id_col, vector_col)
    one = scratch.write(members.groupBy("cls").agg(F.min("vec_id").alias("rep"), F.count("*").alias("m"),
                                                   F.first("v").alias("v")), "classes")
    n = one.count()
    size = code_size(n)

    def listing(batches):
        codes: dict[int, Codes] = {}
        for b in batches:
            dims = np.array([len(x) for x in b.column(3)])
            out: list = [None] * b.num_rows
            for dim in np.unique(dims):
                at = np.flatnonzero(dims == dim)
                x = np.array([b.column(3)[int(i)].as_py() for i in at])
                x /= np.abs(x).max(axis=1)[:, None]         # so that no square overflows or vanishes
                x /= np.linalg.norm(x, axis=1)[:, None]
                if dim not in codes:
                    codes[dim] = Codes(int(dim), size)
                for i, ids in zip(at, codes[dim].listed(x)):
                    out[i] = (ids * 4096 + dim % 4096).tolist()
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(out, pa.list_(pa.int64()))],
                                             names=["cls", "rep", "m", "v", "caps"])

    coded = scratch.write(one.mapInArrow(listing, "cls string, rep long, m long, v array<double>, caps array<long>"),
                          "coded")
    narrow = coded.select(F.explode("caps").alias("cap"), "cls")
    sizes = narrow.groupBy("cap").agg(F.count("*").alias("n")).filter("n > 1")
    meet = (spread(narrow.join(sizes, "cap"), "cap", "cls", block).join(coded, "cls")
            .repartition("cap", "lo", "hi").sortWithinPartitions("cap", "lo", "hi"))

    def verify(batches):
        for (cap, lo, hi), t in groups(batches, ["cap", "lo", "hi"]):
            vs = t.column("v").to_pylist()
            if len({len(v) for v in vs}) > 1:               # lengths that share a cap's number
                most = max(len(v) for v in vs)
                dims = np.array([len(v) for v in vs])
                vs = [v + [0.0] * (most - len(v)) for v in vs]
            else:
                dims = np.zeros(len(vs))
            x = np.array(vs)
            x /= np.abs(x).max(axis=1)[:, None]
            x /= np.linalg.norm(x, axis=1)[:, None]
            linked = (x @ x.T >= threshold) & (dims[:, None] == dims[None, :])
            np.fill_diagonal(linked, False)
            side = t.column("side").to_numpy()
            if lo != hi:
                linked &= side[:, None] != side[None, :]    # within a block they meet in its own group
            at = np.flatnonzero(linked.any(axis=1))
            if not len(at):
                continue
            linked = linked[np.ix_(at, at)]
            rep = t.column("rep").to_numpy()[at]
            m = t.column("m").to_numpy()[at]
            cls = t.column("cls").take(pa.array(at)).combine_chunks()
            label = least_labels(linked, rep)               # enough links for the components
            # a pair counts in the first cap it shares: take out those that share an earlier one
            own = [np.asarray(c, np.int64) for c in t.column("caps").take(pa.array(at)).to_pylist()]
            before = [c[c < cap] for c in own]
            flat = np.concatenate(before)
            if len(flat):
                names, col = np.unique(flat, return_inverse=True)
                row = np.repeat(np.arange(len(at)), [len(c) for c in before])
                shared = np.zeros((len(at), len(at)), bool)
                for s in range(0, len(names), 4096):
                    part = (col >= s) & (col < s + 4096)
                    has = np.zeros((len(at), min(4096, len(names) - s)), np.float32)
                    has[row[part], col[part] - s] = 1
                    shared |= has @ has.T > 0.5
                linked &= ~shared
            links = linked @ m
            yield pa.RecordBatch.from_arrays(
                [cls, pa.array(links.astype(np.int64)), pa.array(rep), pa.array(label)],
                names=["cls", "links", "a", "b"])

    found = scratch.write(meet.mapInArrow(verify, "cls string, links long, a long, b long"), "found")
    links = found.groupBy("cls").agg(F.sum("links").alias("links"))
    per_class = one.select("cls", "rep", "m").join(links, "cls", "left").select(
        "cls", (F.coalesce("links", F.lit(0)) + F.col("m") - 1).alias("n"))
    alike = members.join(one.select("cls", "rep"), "cls").filter("vec_id <> rep").select(
        F.col("vec_id").alias("a"), F.col("rep").alias("b"))
    parts = components(found.filter("a <> b").select("a", "b").union(alike), scratch)
    every = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("v"))
    every = every.select("vec_id", F.when(F.col("vec_id").isNotNull() & sound("v"), name("v")).alias("cls"))
    return (every.join(per_class, "cls", "left")
            .join(parts.withColumnRenamed("node", "vec_id"), "vec_id", "left")
            .select("vec_id", F.coalesce("n", F.lit(0)).cast("long").alias("n_links"),
                    F.coalesce("component", "vec_id").alias("component_id"))
            .withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True))))
