"""Merkle manifest of a table by time-forward processing.

Leaves are digests of rows. The leaves of a source, by id, form a tree: every ``FAN``
consecutive nodes (the last run: fewer, even one) become one node, until one remains, the
source's subroot. The subroots, by source, form a tree of the same kind; what remains is the
root. A digest is the sha256, as lowercase hex, of its inputs laid end to end.

The digests go up and the proofs come down as messages between nodes, in order of labels:

* A tree is cut into heights of ``HEIGHT`` levels. The nodes under one top node of a height
  are a unit of at most ``FAN ** HEIGHT`` rows, brought together by one shuffle and sorted by
  place, so no unit grows with the tree, whatever share of the rows its source has. The
  shuffle's sort is the outer queue: it hands every unit its messages in label order.
* In a unit a priority queue holds the messages under way, labelled by the time at which a
  node's last leaf has come and by its level. A node takes its children's digests off the
  queue and sends its own to its parent; the queue holds at most a run for each level.
* The unit's top digest is a message to the next height. Once the root is known the heights
  are gone through in reverse: the queue runs backwards, from the top node to the leaves, and
  hands every node the proof suffix of its parent, to which it adds its own siblings.

Only a height's digests are stored in between (under ``spark.checkpoint.dir``), about a
``FAN ** HEIGHT``-th of those of the height below; the driver sees one number a height.

Places: rows are numbered within their source by a range shuffle on (source, id, leaf) and
the row counts of its partitions, so a source with any share of the rows is numbered in
parallel. Equal ids take the order of their leaves; equal rows are interchangeable.

Rows: null values are digested as ``-``; a null source is a source of its own and comes first,
null ids come first within a source; an empty table gives an empty result; an empty text
differs from a null one. The table's other columns are not read.
"""

from __future__ import annotations

import hashlib
import heapq
import json
from collections.abc import Iterator, Sequence
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import Scratch, groups, remainder

FAN = 16
HEIGHT = 3                  # levels of one height: units of FAN ** HEIGHT nodes
TAMPER = 5                  # ids whose crc32 this divides are tampered with

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
Step = tuple[int, list[str]]        # a node's slot in its run, and the digests of the run's others


def digest(inputs: Sequence[str]) -> str:
    return hashlib.sha256("".join(inputs).encode("ascii")).hexdigest()


# -- native parts: leaves and places --------------------------------------------------

def leaf(columns: Sequence[str | Column]) -> Column:
    """The digest of some columns: each ``-`` if null, else ``bytes:value``."""
    def part(c: str | Column) -> Column:
        text = (F.col(c) if isinstance(c, str) else c).cast("string")
        return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))
    return F.sha2(F.concat(*[part(c) for c in columns]).cast("binary"), 256)


def lowered(text: str) -> Column:
    """The text with A-Z in lower case, all else unchanged."""
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.translate(F.col(text).cast("string"), upper, upper.lower())


def placed(rows: DataFrame, tree: str, order: Sequence[str], scratch: Scratch, name: str) -> DataFrame:
    """Adds ``idx``, the place of a row in its tree (from 0, by ``order``), and ``n``, the tree's rows."""
    order = [F.col(c).asc_nulls_first() for c in order]
    # the row number of the input splits equal rows between partitions; any order among them will do
    ranged = (rows.withColumn("_row", F.monotonically_increasing_id())
              .repartitionByRange(F.col(tree), *order, "_row")
              .sortWithinPartitions(tree, *order, "_row").drop("_row")
              .withColumn("_pos", F.monotonically_increasing_id()).withColumn("_task", F.spark_partition_id()))
    ranged = scratch.write(ranged, name)
    shares = ranged.groupBy(tree, "_task").agg(F.count(F.lit(1)).alias("_rows"), F.min("_pos").alias("_from"))
    earlier = Window.partitionBy(tree).orderBy("_task").rowsBetween(Window.unboundedPreceding, -1)
    shares = shares.select(tree, "_task", (F.coalesce(F.sum("_rows").over(earlier), F.lit(0)) - F.col("_from")).alias("_add"),
                           F.sum("_rows").over(Window.partitionBy(tree)).alias("n"))
    return (ranged.join(shares, [tree, "_task"]).withColumn("idx", F.col("_pos") + F.col("_add"))
            .drop("_pos", "_task", "_add"))


# -- one unit -----------------------------------------------------------------------

def climb(leaves: Sequence[str], n: int, first: int) -> tuple[list[list[str]], list[list[list[str]]]]:
    """Digests of a unit level by level (its leaves first), and the runs they were made of.

    ``leaves`` are the places first, first + 1, ... of a tree level with ``n`` nodes. A level
    ends where the tree has one node only.
    """
    sizes = [n]
    while len(sizes) <= HEIGHT and sizes[-1] > 1:
        sizes.append(-(-sizes[-1] // FAN))
    top = len(sizes) - 1
    spans = [FAN ** k for k in range(top + 1)]
    made: list[list[str]] = [[] for _ in sizes]
    runs: list[list[list[str]]] = [[] for _ in sizes]
    queue: list[tuple[int, int, int, str]] = []     # (time of the parent's last leaf, its level, slot, digest)

    def send(level: int, place: int, value: str) -> None:
        made[level].append(value)
        if level < top:
            due = min((place // FAN + 1) * spans[level + 1], n)
            heapq.heappush(queue, (due, level + 1, place % FAN, value))

    for k, value in enumerate(leaves):
        place = first + k
        send(0, place, value)
        while queue and queue[0][0] == place + 1:
            due, level = queue[0][:2]
            run = []
            while queue and queue[0][:2] == (due, level):
                run.append(heapq.heappop(queue)[3])
            runs[level].append(run)
            send(level, place // spans[level], digest(run))
    return made, runs


def descend(leaves: Sequence[str], n: int, first: int, above: list[Step]) -> list[list[Step]]:
    """The proof of every leaf of a unit: its own step and those of its ancestors, up to ``above``."""
    made, runs = climb(leaves, n, first)
    out: list[list[Step]] = [[] for _ in leaves]
    top = len(made) - 1
    queue: list[tuple[int, int, list[Step]]] = [(-top, 0, above)]   # parents before children, last ones first
    while queue:
        level, at, suffix = heapq.heappop(queue)
        level, at = -level, -at
        if not level:
            out[at] = suffix
            continue
        run = runs[level][at]
        for slot in range(len(run)):
            step = (slot, run[:slot] + run[slot + 1:])
            heapq.heappush(queue, (1 - level, -(at * FAN + slot), [step, *suffix]))
    return out


def fold(value: str, proof: Sequence[Step]) -> str:
    """The root that a leaf and its proof lead to."""
    for slot, others in proof:
        value = digest([*others[:slot], value, *others[slot:]])
    return value


# -- all units ------------------------------------------------------------------------

UNIT = FAN ** HEIGHT


def _units(nodes: DataFrame, messages: DataFrame | None = None) -> DataFrame:
    """Rows by unit and place; a message (tree, unit, path) to a unit comes before its rows."""
    rows = nodes.withColumn("unit", F.floor(F.col("idx") / UNIT).cast("long"))
    if messages is not None:
        rows = rows.unionByName(messages.select("tree", "unit", "path", F.lit(-1).cast("long").alias("idx")),
                                allowMissingColumns=True)
    return rows.repartition("tree", "unit").sortWithinPartitions("tree", "unit", "idx")


NODE = pa.schema([("tree", pa.string()), ("idx", pa.int64()), ("n", pa.int64()), ("digest", pa.string())])
MESSAGE = pa.schema([("tree", pa.string()), ("unit", pa.int64()), ("path", pa.string())])


def _up(batches) -> Iterator[pa.RecordBatch]:
    for (tree, unit), rows in groups(batches, ["tree", "unit"]):
        n = rows.column("n")[0].as_py()
        made, _ = climb(rows.column("digest").to_pylist(), n, unit * UNIT)
        yield pa.RecordBatch.from_pydict({"tree": [tree], "idx": [unit], "n": [-(-n // UNIT)], "digest": [made[-1][0]]},
                                         schema=NODE)


def heights(nodes: DataFrame, scratch: Scratch, name: str) -> tuple[list[DataFrame], DataFrame]:
    """The node tables of all heights, leaves first, and every tree's top node: (tree, digest, tall).

    A table holds the trees that have more than one node at its lowest level (the first one:
    all trees). ``tall`` is the number of the last table that holds the tree.
    """
    out, tops = [nodes], []
    while True:
        up = _units(out[-1].select("tree", "idx", "n", "digest")).mapInArrow(_up, "tree string, idx long, n long, digest string")
        up = scratch.write(up, f"{name}{len(out)}")
        tops.append(up.filter("n = 1").select("tree", "digest", F.lit(len(out) - 1).alias("tall")))
        if not up.filter("n > 1").head(1):
            return out, reduce(DataFrame.union, tops)
        out.append(up.filter("n > 1"))


def _split(rows: pa.Table) -> tuple[str | None, list[Step], pa.Table]:
    """A unit's message (the subroot and the proof of its top node) and its nodes."""
    if rows.column("idx")[0].as_py() >= 0:
        return None, [], rows
    of, above = json.loads(rows.column("path")[0].as_py())
    return of, above, rows.slice(1)


def _proofs(rows: pa.Table, unit: int, above: list[Step]) -> list[list[Step]]:
    return descend(rows.column("digest").to_pylist(), rows.column("n")[0].as_py(), unit * UNIT, above)


def _down(batches) -> Iterator[pa.RecordBatch]:
    for (tree, unit), rows in groups(batches, ["tree", "unit"]):
        of, above, nodes = _split(rows)
        proofs = [json.dumps([of, p]) for p in _proofs(nodes, unit, above)]
        yield pa.RecordBatch.from_pydict({"tree": [tree] * len(proofs), "unit": nodes.column("idx").combine_chunks(),
                                          "path": proofs}, schema=MESSAGE)


def _down_subroots(batches) -> Iterator[pa.RecordBatch]:
    """The messages that subroots send to the top nodes of their sources."""
    schema = pa.schema([("tree", pa.string()), ("tall", pa.int32()), ("path", pa.string())])
    for (_, unit), rows in groups(batches, ["tree", "unit"]):
        _, above, nodes = _split(rows)
        proofs = _proofs(nodes, unit, above)
        yield pa.RecordBatch.from_pydict({
            "tree": nodes.column("of").combine_chunks(), "tall": nodes.column("tall").combine_chunks(),
            "path": [json.dumps([d, p]) for d, p in zip(nodes.column("digest").to_pylist(), proofs)]}, schema=schema)


def messages_below(levels: list[DataFrame], ends: DataFrame | None, scratch: Scratch, name: str) -> DataFrame | None:
    """The messages to the units of the first height, by the heights above it in reverse.

    ``ends`` (tree, tall, path) are the messages to the top nodes of all trees, if any.
    """
    messages = None
    for k in reversed(range(len(levels))):
        if ends is not None:
            own = ends.filter(F.col("tall") == k).select("tree", F.lit(0).cast("long").alias("unit"), "path")
            messages = own if messages is None else messages.union(own)
        if k:
            messages = scratch.write(_units(levels[k], messages).mapInArrow(_down, "tree string, unit long, path string"),
                                     f"{name}{k}")
    return messages


# -- the operator ---------------------------------------------------------------------

OUT = pa.schema([("doc_id", pa.int64()), ("source", pa.string()), ("idx", pa.int64()), ("leaf", pa.string()),
                 ("subroot", pa.string()), ("proof_sha256", pa.string()), ("folded_root", pa.string()),
                 ("proof", pa.string())])


def _leaves(with_proof: bool):
    def run(batches):
        for (_, unit), rows in groups(batches, ["tree", "unit"]):
            of, above, nodes = _split(rows)
            proofs = _proofs(nodes, unit, above)
            column = {c: nodes.column(c).combine_chunks() for c in ("doc_id", "source", "idx", "digest", "shown")}
            yield pa.RecordBatch.from_pydict({
                "doc_id": column["doc_id"], "source": column["source"], "idx": column["idx"], "leaf": column["digest"],
                "subroot": [of] * len(proofs),
                "proof_sha256": [digest([x for _, others in p for x in others]) for p in proofs],
                "folded_root": [fold(value, p) for value, p in zip(column["shown"].to_pylist(), proofs)],
                "proof": [json.dumps(p) if with_proof else None for p in proofs]}, schema=OUT)
    return run


def manifest(rows: DataFrame, leaf_digest: Column, shown: Column | None = None, id_col: str = "doc_id",
             source_col: str = "source", with_proof: bool = False) -> DataFrame:
    """One row per input row: (doc_id, source, idx, leaf, subroot, root, proof_sha256, folded_root, verified).

    ``leaf_digest`` is the row's leaf, ``shown`` the leaf that is checked against the proof
    (default: the same). ``with_proof`` adds the proof as JSON: for each level the slot and
    the digests of the run's others.
    """
    scratch = Scratch(rows.sparkSession, "merkle")
    source = F.col(source_col).cast("string")
    nodes = scratch.write(rows.select(
        F.col(id_col).cast("long").alias("doc_id"), source.alias("source"), leaf_digest.alias("digest"),
        (leaf_digest if shown is None else shown).alias("shown"),
        F.coalesce(F.concat(F.lit("="), source), F.lit("")).alias("tree")), "rows")     # null first, then bytewise
    nodes = scratch.write(placed(nodes, "tree", ["doc_id", "digest"], scratch, "ranged"), "leaves")
    scratch.drop("rows", "ranged")
    levels, subroots = heights(nodes, scratch, "up")
    subroots = subroots.select(F.lit("").alias("tree"), F.col("tree").alias("of"), "digest", "tall")
    sources = scratch.write(placed(subroots, "tree", ["of"], scratch, "ordered"), "subroots")
    tops, over = heights(sources, scratch, "over")
    root = over.head()                                      # one row: all subroots are one tree
    ends = _units(sources, messages_below(tops, None, scratch, "above")).mapInArrow(
        _down_subroots, "tree string, tall int, path string")
    units = messages_below(levels, scratch.write(ends, "ends"), scratch, "below")
    types = ", ".join(f"{f.name} {'long' if pa.types.is_integer(f.type) else 'string'}" for f in OUT)
    out = (_units(levels[0], units).mapInArrow(_leaves(with_proof), types)
           .withColumn("root", F.lit(root.digest if root else None).cast("string"))
           .withColumn("verified", F.col("folded_root") == F.col("root")))
    return out if with_proof else out.drop("proof")


def digests(docs: DataFrame) -> DataFrame:
    """The manifest of ``documents``; rows whose id's crc32 TAMPER divides are checked with a lower-cased text."""
    whole = leaf(FIELDS)
    tampered = leaf([lowered(c) if c == "text" else c for c in FIELDS])
    shown = F.when(F.coalesce(remainder("doc_id", TAMPER) == 0, F.lit(False)), tampered).otherwise(whole)
    return manifest(docs, whole, shown)
