"""Training-order materialisation: token sequences in fixed-stride shards.

Documents are tokenised and packed, in the order a task reads them, into
sequences of LENGTH tokens (documents are closed by the end token; the last
sequence of a task is padded with it). A first pass only sums bytes: as a token
has at least one, they bound a task's sequences, and every task gets a range of
that many indices. A sequence's index goes through a keyed Feistel network over
the next power of four, walked until it falls among the indices, so its place in
the training order needs no sort and no second tokenising. Places are cut into
ranges; each range is written by one task, in order, as one file of fixed-stride
records. A sequence's slot is its rank among the places that are taken: the
sequences of the files before, and its record in its own. Any slot is found by
arithmetic on the files' counts, and reading can resume anywhere.

The input must come from stored files, whose scan gives the same rows in the same
task each time; the second scan compares with the first and fails if it doesn't.
A repeated task rewrites its file under another name and renames it when it is
whole.

Null and empty texts are a document of the end token alone. Null ids and
repeated rows are kept. An empty table gives no rows and no files.
"""

from __future__ import annotations

import base64
import hashlib
import json
import uuid
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater.session import shared_path

from .common import Scratch, id_text, mixed, strings

LENGTH = 1_024
SHARD_BYTES = 32_000_000       # at most; some two fifths of the places are taken
ROUNDS = 6
ROWS = 256
BROADCAST_SHARDS = 200_000      # the files' starts are broadcast up to this many, shuffled beyond

# Fixed value: the pattern that cuts text before the merges of the rank file.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


class Permutation:
    """A keyed bijection of 0..n-1."""

    def __init__(self, n: int, key: str):
        self.n = n
        self.half = max(1, (max(n - 1, 1).bit_length() + 1) // 2)
        self.mask = np.uint64((1 << self.half) - 1)
        raw = hashlib.blake2b(key.encode(), digest_size=8 * ROUNDS).digest()
        self.keys = np.frombuffer(raw, "<u8")

    def _pass(self, x: np.ndarray, keys) -> np.ndarray:
        left, right = x >> np.uint64(self.half), x & self.mask
        for k in keys:
            left, right = right, left ^ (mixed(right ^ k) & self.mask)
        return (left << np.uint64(self.half)) | right

    def _walk(self, x: np.ndarray, one) -> np.ndarray:
        out = one(np.asarray(x).astype(np.uint64))
        while (far := out >= self.n).any():
            out[far] = one(out[far])
        return out.astype(np.int64)

    def slot(self, index: np.ndarray) -> np.ndarray:
        return self._walk(index, lambda x: self._pass(x, self.keys))

    def index(self, slot: np.ndarray) -> np.ndarray:
        def back(x):
            # the network with its halves exchanged and its keys reversed
            swap = lambda v: ((v & self.mask) << np.uint64(self.half)) | (v >> np.uint64(self.half))
            return swap(self._pass(swap(x), self.keys[::-1]))
        return self._walk(slot, back)


class Tokens:
    """Ids of texts by a rank file."""

    def __init__(self, ranks: str, end: int):
        import tiktoken
        pairs = (line.split() for line in ranks.splitlines() if line)
        self.enc = tiktoken.Encoding("ranks", pat_str=PATTERN, special_tokens={},
                                     mergeable_ranks={base64.b64decode(a): int(b) for a, b in pairs})
        self.end = np.array([end], np.uint32)

    def of(self, text: str) -> np.ndarray:
        """The text's ids and the end token."""
        return np.concatenate([self.enc.encode_to_numpy(text, disallowed_special=()), self.end])


def _files(uri: str):
    """(pyarrow filesystem, path) of a folder that all executors share."""
    from pyarrow import fs
    if "://" not in uri:
        uri = "file://" + uri.removeprefix("file:")
    return fs.FileSystem.from_uri(uri)


def materialise(docs: DataFrame, ranks_file: str, folder: str | None = None, key: str = "epoch-0",
                length: int = LENGTH, shard_bytes: int = SHARD_BYTES, end: int | None = None,
                id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Writes the shards and returns their manifest, a row per sequence:
    (slot, shard, byte_offset, n_tokens, crc, doc_ids, place)."""
    spark = docs.sparkSession
    src = id_text(docs, id_col, text_col)
    with open(ranks_file) as f:
        ranks = f.read()
    end = end if end is not None else 1 + max(int(line.split()[1]) for line in ranks.splitlines() if line)
    kind = "<u2" if end < 1 << 16 else "<u4"
    folder = folder or shared_path(spark, "llm", f"shards-{uuid.uuid4().hex}")
    sent = spark.sparkContext.broadcast(ranks)      # a fixed vocabulary file
    stride = length * np.dtype(kind).itemsize

    # one row for each task of the scan, not for anything in the data
    tasks = {r["task"]: (-(-r["n"] // length), r["rows"], r["n"]) for r in
             src.select(F.spark_partition_id().alias("task"), (F.octet_length("text") + 1).alias("n"))
             .groupBy("task").agg(F.sum("n").alias("n"), F.count("*").alias("rows")).collect()}
    before, places = {}, 0
    for t in sorted(tasks):
        before[t] = places
        places += tasks[t][0]
    per = max(1, shard_bytes // stride)
    shards = -(-places // per)
    perm = Permutation(places, key)
    fs, root = _files(folder)
    fs.create_dir(root, recursive=True)
    plan = spark.sparkContext.broadcast((before, tasks))

    def pack(batches):
        tok, task = Tokens(sent.value, end), TaskContext.get().partitionId()
        first, (most, want_rows, want_bytes) = plan.value[0].get(task, 0), plan.value[1].get(task, (0, 0, 0))
        made = rows = seen = 0
        held, owners, at = [], [], []           # token arrays not yet cut, their documents and starts
        size = 0

        def cut(last: bool):
            nonlocal held, owners, at, size, made
            flat = np.concatenate(held).astype(kind)
            n = -(-size // length) if last else size // length
            begins, out = np.array(at), []
            for k in range(n):
                s, e = k * length, min((k + 1) * length, size)
                a, b = np.searchsorted(begins, s, "right") - 1, np.searchsorted(begins, e, "left")
                out.append({"n_tokens": e - s, "tokens": flat[s:e].tobytes(), "doc_ids": owners[a:b]})
            if made + n > most:
                raise RuntimeError("the two scans of the input differ; materialise needs stored files")
            spots = perm.slot(np.arange(first + made, first + made + n)) if n else np.zeros(0, np.int64)
            made += n
            if n < -(-size // length) or not last:
                s = n * length
                a = np.searchsorted(begins, s, "right") - 1 if size > s else len(owners)
                rest = flat[s:].astype(np.uint32)
                held, owners = [rest] if len(rest) else [], owners[a:]
                at = [max(0, x - s) for x in at[a:]]
                size = len(rest)
            for r, x in zip(out, spots.tolist()):
                r.update(place=x, shard=x // per)
            return pa.RecordBatch.from_pylist(out, schema=kinds)

        for whole in batches:
            for k in range(0, whole.num_rows, ROWS):
                b = whole.slice(k, ROWS)
                for doc, text in zip(b.column(0).to_pylist(), strings(b, "text")):
                    ids = tok.of(text)
                    held.append(ids)
                    owners.append(doc)
                    at.append(size)
                    size += len(ids)
                    rows += 1
                    seen += len(text.encode("utf-8", "replace")) + 1
                if size >= length:
                    yield cut(False)
        if size:
            yield cut(True)
        if (rows, seen) != (want_rows, want_bytes):
            raise RuntimeError("the two scans of the input differ; materialise needs stored files")

    kinds = pa.schema([("place", pa.int64()), ("shard", pa.int32()), ("n_tokens", pa.int32()), ("tokens", pa.binary()),
                       ("doc_ids", pa.list_(pa.int64()))])

    def write(batches):
        fs, root = _files(folder)
        out, shard, rank, tmp = None, None, 0, None

        def close():
            if out is not None:
                out.close()
                fs.move(tmp, f"{root}/shard-{shard:06d}.bin")

        for b in batches:
            got = []
            for r in b.to_pylist():
                if r["shard"] != shard:
                    close()
                    shard, rank = r["shard"], 0
                    tmp = f"{root}/.shard-{shard:06d}-{uuid.uuid4().hex}"
                    out = fs.open_output_stream(tmp)
                raw = r["tokens"] + np.full(length - r["n_tokens"], end, kind).tobytes()
                out.write(raw)
                got.append({"place": r["place"], "shard": shard, "rank": rank, "n_tokens": r["n_tokens"],
                            "crc": crc32(raw), "doc_ids": r["doc_ids"]})
                rank += 1
            if got:
                yield pa.RecordBatch.from_pylist(got, schema=lines)
        close()

    lines = pa.schema([("place", pa.int64()), ("shard", pa.int32()), ("rank", pa.int64()), ("n_tokens", pa.int32()),
                       ("crc", pa.int64()), ("doc_ids", pa.list_(pa.int64()))])
    sequences = src.mapInArrow(pack, "place long, shard int, n_tokens int, tokens binary, doc_ids array<long>")
    rows = (sequences.repartitionById(max(1, shards), "shard").sortWithinPartitions("shard", "place")
            .mapInArrow(write, "place long, shard int, rank long, n_tokens int, crc long, doc_ids array<long>"))
    made = Scratch(spark, "shards").write(rows, "manifest")
    # one number for each file
    counts = {r["shard"]: r["count"] for r in made.groupBy("shard").count().collect()}
    sizes = [counts.get(k, 0) for k in range(shards)]
    starts = np.concatenate([[0], np.cumsum(sizes)]).astype(int).tolist()
    with fs.open_output_stream(f"{root}/meta.json") as f:
        f.write(json.dumps({"length": length, "kind": kind, "sizes": sizes, "places": places, "key": key,
                            "end": end}).encode())
    offset = spark.createDataFrame([(k, starts[k]) for k in range(shards)], "shard int, start long")
    offset = F.broadcast(offset) if shards <= BROADCAST_SHARDS else offset.hint("shuffle_hash")
    return made.join(offset, "shard").select(
        (F.col("start") + F.col("rank")).alias("slot"), "shard", (F.col("rank") * stride).alias("byte_offset"),
        "n_tokens", "crc", "doc_ids", "place")


def read(folder: str, first: int = 0, count: int | None = None):
    """(slot, ids) in training order from any slot on; only the shards in question are opened."""
    fs, root = _files(folder)
    with fs.open_input_stream(f"{root}/meta.json") as f:
        meta = json.loads(f.read())
    size = meta["length"] * np.dtype(meta["kind"]).itemsize
    ends = np.cumsum(meta["sizes"]).astype(int)
    last = int(ends[-1]) if len(ends) else 0
    last = last if count is None else min(last, first + count)
    slot = first
    while slot < last:
        shard = int(np.searchsorted(ends, slot, "right"))
        stop = min(last, int(ends[shard]))
        with fs.open_input_file(f"{root}/shard-{shard:06d}.bin") as f:
            f.seek((slot - int(ends[shard]) + meta["sizes"][shard]) * size)
            while slot < stop:
                yield slot, np.frombuffer(f.read(size), meta["kind"])
                slot += 1


def manifest(spark: SparkSession, docs: DataFrame, ranks_file: str) -> DataFrame:
    """The query's row per sequence."""
    return materialise(docs, ranks_file).withColumn("n_docs", F.size("doc_ids"))
