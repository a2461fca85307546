"""N-gram Jaccard join by chosen paths.

A document is the set of its runs of five words (fewer words: one run of all).
Every set is embedded as COORDINATES minimum hashes; two sets agree in a
coordinate with the chance of their Jaccard similarity. A run starts with all
sets in one node and splits each node by CHILDREN of its coordinates, chosen by
a hash of the node: sets with the same value go to the same child. After DEPTH
levels most nodes hold few sets, and these are compared with each other, in
blocks if there are more. A node that still holds very many is compared in
blocks, too, if its sets are alike on average (splitting would not part them),
and split by DEPTH more levels if not. Runs are repeated,
each with other coordinates, until a pair at the threshold is missed with a
chance below 1 - TARGET (``runs``).

Comparing embeddings only says which sets may be near. Exact similarity decides:
the texts of each group of such sets meet in tasks (large groups in pairs of
blocks), every two are intersected, and links are counted. Equal sets go through
as one with their number, so copies are never paired with each other.

Null and empty texts have no set and no links. Rows that repeat a doc_id are
documents of their own: each is a link of the others if it is near, and in the
class of its own set, which need not be theirs. A row with a null doc_id gets no
links and a null class. An empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import (WORD, Scratch, components, groups, id_text, joined_labels, lean, least_labels, mixed, run_hashes,
                     spread, word_hashes)

THRESHOLD = 0.8
SHINGLE = 5
COORDINATES = 128
CHILDREN, DEPTH, MAX_DEPTH = 2, 3, 9
TARGET = 0.9999
FEW = 64                # sets of a node that are compared at once
BLOCK = 256             # texts of one block of a larger group
NODE_BLOCK = 1_024      # embeddings of one block of a larger node
MANY = 4_096            # sets of a node that is split further unless they are alike
BROADCAST_ROWS = 200_000    # groups of up to so many sets (some 100 bytes each) go to the texts, not the texts to them
SLACK = 0.14            # embeddings may fall short of the threshold by four standard deviations
SEEDS = mixed(np.arange(1, COORDINATES + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)
SALTS = mixed(SEEDS)


def runs(threshold: float, target: float = TARGET) -> int:
    """Repeats until a pair at the threshold is found with the target chance."""
    stay = 1.0
    for _ in range(DEPTH):
        stay = 1 - (1 - threshold * stay) ** CHILDREN
    return math.ceil(math.log(1 - target) / math.log(1 - stay))


def shingles(text: bytes, size: int = SHINGLE) -> np.ndarray:
    """The sorted distinct hashes of a text's runs of words."""
    h = word_hashes(text.split())
    if not len(h):
        return h
    if len(h) < size:
        return run_hashes(h, len(h)) ^ np.uint64(len(h))
    return np.unique(run_hashes(h, size))


def embed(s: np.ndarray) -> np.ndarray:
    """Minimum of each coordinate's hash over the set, 16 bits."""
    low = np.full(COORDINATES, np.iinfo(np.uint64).max, np.uint64)
    for k in range(0, len(s), 8192):
        part = s[k:k + 8192]
        low = np.minimum(low, ((part[None, :] ^ SALTS[:, None]) * SEEDS[:, None]).min(axis=1))
    return (mixed(low) & np.uint64(0xFFFF)).astype(np.uint16)


def fingerprints(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(doc_id, mark, key, coords): mark a hash of the text, key the same for equal sets, null without words."""
    def run(batches):
        for b in batches:
            keys, coords = [], []
            for t in b.column(2).cast(pa.binary()):
                s = shingles(t.as_py())
                keys.append(hashlib.blake2b(s.tobytes(), digest_size=16).hexdigest() if len(s) else None)
                coords.append(embed(s).tobytes() if len(s) else None)
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.array(keys, pa.string()), pa.array(coords, pa.binary())],
                names=["doc_id", "mark", "key", "coords"])
    return (id_text(docs, id_col, text_col).select("doc_id", F.xxhash64("text").alias("mark"), "text")
            .mapInArrow(lean(run), "doc_id long, mark long, key string, coords binary"))


def children(node: np.ndarray, coords: np.ndarray) -> np.ndarray:
    """The CHILDREN nodes below each (node, embedding), shape (rows, CHILDREN)."""
    first = (mixed(node) % np.uint64(COORDINATES)).astype(np.int64)
    step = (mixed(node + np.uint64(1)) % np.uint64(COORDINATES - 1)).astype(np.int64) + 1
    out = []
    for k in range(CHILDREN):
        at = (first + k * step) % COORDINATES
        value = coords[np.arange(len(coords)), at].astype(np.uint64)
        out.append(mixed(mixed(node + at.astype(np.uint64) * np.uint64(0x10001)) ^ (value + np.uint64(1) << np.uint64(20))))
    return np.stack(out, axis=1)


def _matrix(column) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint16).reshape(-1, COORDINATES)


def leaves(sets: DataFrame, which: range) -> DataFrame:
    """(leaf, rep, known) of some runs: each set's nodes after DEPTH levels."""
    def run(batches):
        for b in batches:
            c = _matrix(b.column(1))
            for r in which:
                node = np.full((len(c), 1), mixed(np.array([r + 1], np.uint64))[0])
                for _ in range(DEPTH):
                    node = np.concatenate([children(node[:, k], c) for k in range(node.shape[1])], axis=1)
                # the same node by two ways counts once
                node = np.sort(node.view(np.int64), axis=1)
                new = np.ones(node.shape, bool)
                new[:, 1:] = node[:, 1:] != node[:, :-1]
                rep, known = (np.repeat(b.column(k).to_numpy(), node.shape[1]).reshape(node.shape) for k in (0, 2))
                yield pa.RecordBatch.from_arrays([pa.array(node[new]), pa.array(rep[new]), pa.array(known[new])],
                                                 names=["leaf", "rep", "known"])
    return sets.select("rep", "coords", "known").mapInArrow(lean(run), "leaf long, rep long, known long")


def compare_few(rows: DataFrame, least: float) -> DataFrame:
    """Links (a, b) within nodes of few sets; rows (leaf, rep, coords) sorted by leaf in their partitions."""
    def work(leaf, rep, c):
        n, left, right = len(leaf), [], []
        for k in range(1, n):
            i = np.flatnonzero(leaf[k:] == leaf[:-k]) + k
            if not len(i):
                break
            ok = (c[i] == c[i - k]).mean(axis=1) >= least
            left.append(i[ok])
            right.append(i[ok] - k)
        if not left:
            return None
        label = joined_labels(n, np.concatenate(left), np.concatenate(right))
        at = np.flatnonzero(rep != rep[label])
        return pa.RecordBatch.from_arrays([pa.array(rep[at]), pa.array(rep[label[at]])], names=["a", "b"])

    def run(batches):
        held = None
        for b in batches:
            part = (b.column(0).to_numpy(), b.column(1).to_numpy(), _matrix(b.column(2)))
            if held is not None:
                part = tuple(np.concatenate([x, y]) for x, y in zip(held, part))
            cut = int(np.searchsorted(part[0], part[0][-1])) if len(part[0]) else 0
            done, held = tuple(x[:cut] for x in part), tuple(x[cut:] for x in part)
            if cut and (out := work(*done)) is not None:
                yield out
        if held is not None and len(held[0]) and (out := work(*held)) is not None:
            yield out

    return rows.select("leaf", "rep", "coords").mapInArrow(run, "a long, b long")


def compare_blocks(rows: DataFrame, least: float) -> DataFrame:
    """Links (a, b) within nodes of many sets; rows (leaf, rep, coords, n)."""
    def run(batches):
        for (_, lo, hi), t in groups(batches, ["leaf", "lo", "hi"]):
            c, rep, side = _matrix(t.column("coords")), t.column("rep").to_numpy(), t.column("side").to_numpy()
            same = np.zeros((len(c), len(c)), np.int16)
            for k in range(COORDINATES):
                same += c[:, k][:, None] == c[:, k][None, :]
            linked = same >= least * COORDINATES
            if lo != hi:
                linked &= side[:, None] != side[None, :]
            label = least_labels(linked, rep)
            at = rep != label
            yield pa.RecordBatch.from_arrays([pa.array(rep[at]), pa.array(label[at])], names=["a", "b"])
    return (spread(rows, "leaf", "rep", NODE_BLOCK).repartition("leaf", "lo", "hi").sortWithinPartitions("leaf", "lo", "hi")
            .select("leaf", "lo", "hi", "side", "rep", "coords").mapInArrow(run, "a long, b long"))


def alike(rows: DataFrame) -> DataFrame:
    """(leaf, mean): average agreement of a node's sets with the set of its smallest rep."""
    centre = rows.groupBy("leaf").agg(F.min(F.struct("rep", "coords")).alias("c")).select(
        "leaf", F.col("c.coords").alias("centre"))

    def run(batches):
        for b in batches:
            if b.num_rows:
                m = (_matrix(b.column(1)) == _matrix(b.column(2))).mean(axis=1)
                yield pa.RecordBatch.from_arrays([b.column(0), pa.array(m)], names=["leaf", "same"])
    return (rows.join(centre, "leaf").select("leaf", "coords", "centre").mapInArrow(run, "leaf long, same double")
            .groupBy("leaf").agg(F.avg("same").alias("mean")))


def candidates(sets: DataFrame, scratch: Scratch, threshold: float) -> DataFrame:
    """Links (a, b) enough to hold together all sets whose embeddings are near.

    The first run's links already hold most groups together. The other runs then leave out
    every node whose sets are all in one group, so a large group of near copies, which no
    coordinate parts, is compared once and not in every node of every run.
    """
    alone = sets.select("rep", "coords", F.col("rep").alias("known"))
    first = _run(alone, range(1), scratch, threshold, "a")
    groups_ = components(first, scratch, "first").withColumnRenamed("node", "rep")
    known = sets.select("rep", "coords").join(groups_, "rep", "left").select(
        "rep", "coords", F.coalesce("component", "rep").alias("known"))
    return first.union(_run(known, range(1, runs(threshold)), scratch, threshold, "b"))


def _run(sets: DataFrame, which: range, scratch: Scratch, threshold: float, name: str) -> DataFrame:
    """Links of some runs over sets (rep, coords, known: the group that already holds the set)."""
    least = threshold - SLACK
    found, level = [], DEPTH
    coords = sets.select("rep", "coords")
    now = scratch.write(leaves(sets, which), f"{name}leaves3")
    while True:
        sizes = scratch.write(now.groupBy("leaf").agg(F.count("*").alias("n"), F.min("known").alias("k"), F.max("known").alias("l"))
                              .filter("n > 1 and k < l").select("leaf", "n"), f"{name}sizes{level}", narrow=True)
        most = sizes.agg(F.max("n")).first()[0] or 0
        few = (now.join(sizes.filter(F.col("n") <= FEW), "leaf").join(coords, "rep")
               .repartition("leaf").sortWithinPartitions("leaf"))
        found.append(scratch.write(compare_few(few, least), f"{name}few{level}", narrow=True))
        if most <= FEW:
            break
        last = most <= MANY or level >= MAX_DEPTH
        some = now.join(sizes.filter((F.col("n") > FEW) & (F.lit(last) | (F.col("n") <= MANY))), "leaf").join(coords, "rep")
        found.append(scratch.write(compare_blocks(some, least), f"{name}blocks{level}"))
        if last:
            break
        many = scratch.write(now.join(sizes.filter(F.col("n") > MANY), "leaf").join(coords, "rep")
                             .select("leaf", "rep", "coords", "n", "known"), f"{name}many{level}")
        mean = scratch.write(alike(many), f"{name}alike{level}")
        found.append(scratch.write(compare_blocks(
            many.join(mean.filter(F.col("mean") >= least), "leaf", "left_semi"), least), f"{name}dense{level}"))

        def split(batches):
            for b in batches:
                if b.num_rows:
                    c = _matrix(b.column(2))
                    node = b.column(0).to_numpy().view(np.uint64)[:, None]
                    for _ in range(DEPTH):
                        node = np.concatenate([children(node[:, k], c) for k in range(node.shape[1])], axis=1)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(node.view(np.int64).ravel()), *[pa.array(np.repeat(b.column(k).to_numpy(), node.shape[1]))
                                                                  for k in (1, 3)]], names=["leaf", "rep", "known"])

        loose = many.join(mean.filter(F.col("mean") < least), "leaf", "left_semi").select("leaf", "rep", "coords", "known")
        level += DEPTH
        now = scratch.write(loose.mapInArrow(split, "leaf long, rep long, known long").distinct(), f"{name}leaves{level}")
    out = found[0]
    for f in found[1:]:
        out = out.union(f)
    return out


def similar(sets: list[np.ndarray], threshold: float) -> np.ndarray:
    """Exact: which two sets have at least the Jaccard similarity."""
    sizes = np.array([len(s) for s in sets])
    flat = np.concatenate(sets)
    row = np.repeat(np.arange(len(sets)), sizes)
    _, where, times = np.unique(flat, return_inverse=True, return_counts=True)
    shared = times[where] > 1
    names, col = np.unique(where[shared], return_inverse=True)
    row = row[shared]
    order = np.argsort(col, kind="stable")
    col, row = col[order], row[order]
    both = np.zeros((len(sets), len(sets)), np.float64)
    for s in range(0, len(names), 4096):
        a, b = np.searchsorted(col, [s, s + 4096])
        has = np.zeros((len(sets), min(4096, len(names) - s)), np.float32)
        has[row[a:b], col[a:b] - s] = 1
        both += has @ has.T
    union = sizes[:, None] + sizes[None, :] - both
    linked = both >= threshold * union - 1e-9
    np.fill_diagonal(linked, False)
    return linked


def verify(docs: DataFrame, maybe: DataFrame, sets: DataFrame, threshold: float, block: int) -> DataFrame:
    """(key, links, a, b): exact links of each set, and pairs that hold its component together.

    ``maybe`` has (rep, component, n): each set's group of candidates and the group's size.
    """
    own = sets.select("rep", "key", "m", "doc_id", "mark").join(maybe, "rep")

    def run(batches):
        for (_, lo, hi), t in groups(batches, ["component", "lo", "hi"]):
            rows = {}
            for rep, key, m, side, text in zip(*(t.column(c).to_pylist() for c in ("rep", "key", "m", "side", "text"))):
                if key in rows:
                    continue
                s = shingles(text)
                if hashlib.blake2b(s.tobytes(), digest_size=16).hexdigest() == key:   # else another text with this mark
                    rows[key] = (rep, m, side, s)
            if len(rows) < 2:
                continue
            rep, m, side = (np.array([r[k] for r in rows.values()], np.int64) for k in range(3))
            linked = similar([r[3] for r in rows.values()], threshold)
            if lo != hi:
                linked &= side[:, None] != side[None, :]
            at = np.flatnonzero(linked.any(axis=1))
            if len(at):
                linked, keys = linked[np.ix_(at, at)], list(rows)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([keys[i] for i in at]), pa.array(linked @ m[at]), pa.array(rep[at]),
                     pa.array(least_labels(linked, rep[at]))], names=["key", "links", "a", "b"])

    own = F.broadcast(own) if maybe.count() <= BROADCAST_ROWS else own.hint("shuffle_hash")
    texts = docs.filter("doc_id is not null").withColumn("mark", F.xxhash64("text")).join(own, ["doc_id", "mark"])
    return (spread(texts, "component", "rep", block)
            .select("component", "lo", "hi", "side", "rep", "key", "m", F.col("text").cast("binary").alias("text"))
            .repartition("component", "lo", "hi").sortWithinPartitions("component", "lo", "hi")
            .mapInArrow(lean(run), "key string, links long, a long, b long"))


def classified(docs: DataFrame, threshold: float = THRESHOLD, id_col: str = "doc_id", text_col: str = "text",
               block: int = BLOCK) -> DataFrame:
    """(doc_id, mark, class, class_id, n_links) of every row: mark is a hash of its text, class names the
    class of its set (null without one), class_id is the smallest doc_id of the class, or the row's own."""
    scratch = Scratch(docs.sparkSession, "chosen-path")
    prints = scratch.write(fingerprints(docs, id_col, text_col), "prints")
    # each set has a number of its own: doc_id and mark only say where one of its texts is
    sets = scratch.write(prints.filter("doc_id is not null and key is not null").groupBy("key").agg(
        F.min(F.struct("doc_id", "mark")).alias("at"), F.count("*").alias("m"), F.first("coords").alias("coords")).select(
        F.monotonically_increasing_id().alias("rep"), "key", "at.doc_id", "at.mark", "m", "coords"), "sets")
    maybe = scratch.write(components(candidates(sets, scratch, threshold), scratch, "maybe"), "groups", narrow=True)
    scratch.release()
    sized = scratch.write(maybe.join(maybe.groupBy("component").agg(F.count("*").alias("n")), "component").select(
        F.col("node").alias("rep"), "component", "n"), "sized", narrow=True)
    found = scratch.write(verify(id_text(docs, id_col, text_col), sized, sets, threshold, block), "found")
    scratch.release()
    links = found.groupBy("key").agg(F.sum("links").alias("links"))
    classes = components(found.filter("a <> b").select("a", "b"), scratch, "classes")
    member = sets.select("rep", "doc_id").join(classes.withColumnRenamed("node", "rep"), "rep").select(
        "rep", F.col("component").alias("class"), "doc_id")
    member = member.select("rep", "class").join(member.groupBy("class").agg(F.min("doc_id").alias("least")), "class")
    per_set = sets.select("key", "rep", "doc_id", "m").join(links, "key", "left").join(member, "rep", "left").select(
        "key", F.coalesce("class", "rep").alias("class"), F.coalesce("least", "doc_id").alias("least"),
        (F.coalesce("links", F.lit(0)) + F.col("m") - 1).alias("n"))
    return (prints.select("doc_id", "mark", F.when(F.col("doc_id").isNotNull(), F.col("key")).alias("key"))
            .join(per_set, "key", "left")
            .select("doc_id", "mark", "class", F.coalesce("least", "doc_id").alias("class_id"),
                    F.coalesce("n", F.lit(0)).cast("long").alias("n_links")))


def near(docs: DataFrame, threshold: float = THRESHOLD, id_col: str = "doc_id", text_col: str = "text",
         block: int = BLOCK) -> DataFrame:
    """(doc_id, class_id, n_links) of every row; class_id is the smallest doc_id reachable by links."""
    return classified(docs, threshold, id_col, text_col, block).select("doc_id", "class_id", "n_links")


def representatives(docs: DataFrame, threshold: float = THRESHOLD, id_col: str = "doc_id",
                    text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, with all their columns, that stay: of each class the row of its smallest
    doc_id (of several, the one with the least text), and every row without id or without words."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    alone = F.col(id_col).cast("long").isNull() | ~text.rlike(WORD.pattern)
    stay = (classified(docs, threshold, id_col, text_col).filter("class is not null and doc_id = class_id")
            .select(F.col("doc_id").alias("stay_id"), F.col("mark").alias("stay_mark"), F.col("class").alias("stay_class"))
            .distinct())
    row = F.struct(*docs.columns)
    one = (docs.filter(~alone).select(F.col(id_col).cast("long").alias("stay_id"), F.xxhash64(text).alias("stay_mark"),
                                      row.alias("row"), text.alias("order"))
           .join(stay.hint("shuffle_hash"), ["stay_id", "stay_mark"])
           .groupBy("stay_class").agg(F.min_by("row", "order").alias("row")))
    return one.select("row.*").unionByName(docs.filter(alone))
