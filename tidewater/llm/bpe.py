"""BPE encoding and decoding; long texts by tree concatenation.

``encode`` gives the ids of the tokenizers library for every whole text. Texts
up to ``leaf_chars`` are encoded where they are read: white space always
separates tokens of this vocabulary, so each distinct word is encoded by the
library once per task and then looked up (in texts of plain Latin letters, each
distinct stretch of letters, digit or other signs, as the vocabulary's own
pattern cuts them). A longer text is cut into leaves of about
``leaf_chars`` characters, the leaves are encoded in parallel tasks, and halves
are joined pairwise: a window around the join is re-encoded and doubled until
its tokens agree with the left half's before the join and with the right
half's after it (same id at the same place); the halves' tokens outside and
the window's inside are then the tokens of the joined text. If the window
comes to hold both halves, it is the exact encoding itself.

Nulls count as the empty text (no ids). A repeated row gives its result as
often as it stands in the table. A null id is kept.
"""

from __future__ import annotations

import json
import os
import re
import unicodedata

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import WORD, id_text, lean, strings

LEAF_CHARS = 32_768
EDGE = 2_048        # offsets are shipped for tokens this near to a leaf's ends
MARGIN = 16         # an agreeing token keeps this distance from cuts and window ends
LONG_WORD = 256     # longer words get offsets of their own tokens
CACHE = 400_000     # words whose ids a task keeps
ROWS = 256          # rows in hand at once

# Texts of these characters need no normalisation but lower case, letter by letter.
PLAIN = re.compile(r"[\t-\r\x20-\x7eÀ-ÖØ-öø-ÿ]*")
# The pattern of word_bpe_49k.json (a fixed value) on lower-cased plain texts.
PATTERN = "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"
STRETCH = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[^\sa-z0-9ß-öø-ÿ]+")


class Encoder:
    """The library's tokenizer with a bounded word cache."""

    def __init__(self, spec: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        self.tok = Tokenizer.from_str(spec)
        self.tok.no_truncation()
        self.tok.no_padding()
        self.cache: dict[str, tuple[int, ...]] = {}
        parts = json.loads(spec)
        lower = {"type": "Sequence", "normalizers": [
            {"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}, {"type": "Lowercase"}]}
        split = (parts.get("pre_tokenizer") or {}).get("pretokenizers", [{}])[0].get("pattern", {}).get("Regex")
        # the short way holds for this pattern and normaliser, and if every added token starts alike
        self.marks = {t["content"][:2] for t in parts.get("added_tokens", [])}
        suffix = parts["model"].get("end_of_word_suffix")
        self.plain = parts.get("normalizer") == lower and split == PATTERN and self.marks <= {"<|"} and bool(suffix)
        if self.plain:
            self.bare = Tokenizer.from_str(json.dumps(dict(
                parts, normalizer=None, added_tokens=[], post_processor=None, truncation=None, padding=None,
                pre_tokenizer={"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False})))
            self.ends = np.array([(self.tok.id_to_token(i) or "").endswith(suffix)
                                  for i in range(self.tok.get_vocab_size(with_added_tokens=True))])

    def cut(self, text: str) -> list[str]:
        """Stretches that are encoded on their own: their ids in a row are the text's."""
        if self.plain and PLAIN.fullmatch(text) and "<|" not in text:
            return STRETCH.findall(text.lower())
        return WORD.findall(text)

    def learn(self, words) -> None:
        new = [w for w in words if w not in self.cache and len(w) < LONG_WORD]
        if len(self.cache) + len(new) > CACHE:
            self.cache.clear()
            new = [w for w in words if len(w) < LONG_WORD]
        ready = [w for w in new if PLAIN.fullmatch(w) and w == w.lower() and STRETCH.fullmatch(w)] if self.plain else []
        for k in range(0, len(ready), 64):
            # already cut and normalised: many at once; the mark of a word's end parts them again
            some, ids, at = ready[k:k + 64], None, 0
            ids = self.bare.encode(some, is_pretokenized=True, add_special_tokens=False).ids
            for w, e in zip(some, np.flatnonzero(self.ends[ids]) + 1):
                self.cache[w] = tuple(ids[at:e])
                at = e
        new = [w for w in new if w not in self.cache] if ready else new
        for k in range(0, len(new), 4096):
            some = new[k:k + 4096]
            for w, e in zip(some, self.tok.encode_batch_fast(some, add_special_tokens=False)):
                self.cache[w] = tuple(e.ids)

    def ids(self, texts: list[str]) -> tuple[list[int], list[int]]:
        """All ids in a row, and where each text's end."""
        cuts_ = [self.cut(t) for t in texts]
        self.learn(dict.fromkeys(w for words in cuts_ for w in words))
        out: list[int] = []
        ends, cache = [], self.cache
        for words in cuts_:
            for w in words:
                got = cache.get(w)
                out += self.tok.encode(w, add_special_tokens=False).ids if got is None else got
            ends.append(len(out))
        return out, ends

    def spans(self, text: str, base: int) -> np.ndarray:
        """Rows (id, start, end); the tokens of a short word all carry its place."""
        found = [(m[0], m.start() + base, m.end() + base) for m in WORD.finditer(text)]
        self.learn(dict.fromkeys(w for w, _, _ in found))
        out = []
        for w, s, e in found:
            if len(w) < LONG_WORD:
                got = self.cache.get(w)
                got = self.tok.encode(w, add_special_tokens=False).ids if got is None else got
                out += [(i, s, e) for i in got]
            else:
                enc = self.tok.encode(w, add_special_tokens=False)
                out += [(i, s + a, s + b) for i, (a, b) in zip(enc.ids, enc.offsets)]
        return np.array(out, np.int64).reshape(-1, 3)


def boundary(text: str, i: int) -> int:
    """The next place from i on where normalisation can't join characters."""
    n = len(text)
    for j in range(i, min(n, i + 4096)):
        if text[j] < "\x80":
            return j
    while i < n and (unicodedata.combining(text[i]) or not unicodedata.is_normalized("NFC", text[i])
                     or "ᅠ" <= text[i] <= "ᇿ"):
        i += 1
    return i


def cuts(text: str, leaf_chars: int) -> list[int]:
    """Halve until no part is longer than leaf_chars: the sorted cut places, ends included."""
    parts = 1
    while len(text) > leaf_chars * parts:
        parts *= 2
    at = {boundary(text, len(text) * k // parts) for k in range(1, parts)}
    return sorted(at | {0, len(text)})


def join(enc: Encoder, text: str, left: np.ndarray, right: np.ndarray, lo: int, cut: int, hi: int,
         window: int = 64) -> np.ndarray:
    """Tokens of text[lo:hi] from those of text[lo:cut] and text[cut:hi] (places are absolute)."""
    while True:
        a, b = max(lo, cut - window), min(hi, boundary(text, cut + window))
        if a > lo:
            a = min(boundary(text, a), cut)
        mid = enc.spans(text[a:b], a)
        i = j = 0
        if a > lo:
            near = {tuple(t): k for k, t in _inside(left, a + MARGIN, cut - MARGIN)}
            hit = next(((near[tuple(t)], k) for k, t in _inside(mid, a + MARGIN, cut - MARGIN)
                        if tuple(t) in near and _same_rank(left, near[tuple(t)], mid, k)), None)
            i, j = hit if hit else (-1, -1)
        p, q = len(mid), len(right)
        if b < hi and i >= 0:
            near = {tuple(t): k for k, t in _inside(right, cut + MARGIN, b - MARGIN)}
            hit = next(((k, near[tuple(t)]) for k, t in reversed(_inside(mid, cut + MARGIN, b - MARGIN))
                        if tuple(t) in near and _same_rank(mid, k, right, near[tuple(t)])), None)
            p, q = hit if hit else (-1, -1)
        if i >= 0 and p >= 0:
            return np.concatenate([left[:i], mid[j:p], right[q:]])
        if a == lo and b == hi:
            return mid
        window *= 2


def _inside(tokens: np.ndarray, a: int, b: int) -> list:
    at = np.flatnonzero((tokens[:, 1] >= a) & (tokens[:, 2] <= b) & (tokens[:, 1] >= 0))
    return [(int(k), tokens[k]) for k in at]


def _same_rank(x: np.ndarray, i: int, y: np.ndarray, j: int) -> bool:
    """Several tokens of one place: the same one of them, and the same ones before and after."""
    place = x[i, 1:]
    a = x[(x[:, 1] == place[0]) & (x[:, 2] == place[1])]
    b = y[(y[:, 1] == place[0]) & (y[:, 2] == place[1])]
    if len(a) != len(b) or not (a[:, 0] == b[:, 0]).all():
        return False
    first = lambda t, k: k - int(np.flatnonzero((t[:, 1] == place[0]) & (t[:, 2] == place[1]))[0])
    return first(x, i) == first(y, j)


def fold(enc: Encoder, text: str, leaves: list[np.ndarray], at: list[int]) -> np.ndarray:
    """The leaves' tokens joined pairwise, halves of halves."""
    if len(leaves) == 1:
        return leaves[0]
    m = len(leaves) // 2
    return join(enc, text, fold(enc, text, leaves[:m], at[:m + 1]),
                fold(enc, text, leaves[m:], at[m:]), at[0], at[m], at[-1])


def _edges(tokens: np.ndarray, lo: int, hi: int) -> np.ndarray:
    """Places only near the ends (-1 elsewhere), to keep what is shuffled small."""
    t = tokens.copy()
    t[(t[:, 2] > lo + EDGE) & (t[:, 1] < hi - EDGE), 1:] = -1
    return t


def encode(docs: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text",
           leaf_chars: int = LEAF_CHARS) -> DataFrame:
    """(doc_id long, ids array<int>) of every row; ``vocabulary`` is a tokenizers JSON file."""
    with open(vocabulary, encoding="utf-8") as f:
        spec = f.read()
    src = id_text(docs, id_col, text_col)
    spec = docs.sparkSession.sparkContext.broadcast(spec)       # a fixed vocabulary file
    ids_schema = "doc_id long, ids array<int>"

    def short(batches):
        enc = Encoder(spec.value)
        for whole in batches:
            for at in range(0, whole.num_rows, ROWS):
                b = whole.slice(at, ROWS)
                flat, ends = enc.ids(list(strings(b, "text")))
                ids = pa.ListArray.from_arrays(pa.array([0, *ends], pa.int32()), pa.array(flat, pa.int32()))
                yield pa.RecordBatch.from_arrays([b.column(0), ids], names=["doc_id", "ids"])

    def cut(batches):
        for b in batches:
            keys = b.column(0).to_pylist()
            for k, text, mark in zip(keys, strings(b, "text"), strings(b, "mark")):
                at = cuts(text, leaf_chars)
                for n, (lo, hi) in enumerate(zip(at, at[1:])):
                    yield pa.RecordBatch.from_pylist(
                        [{"doc_id": k, "mark": mark, "n": n, "of": len(at) - 1, "lo": lo, "leaf": text[lo:hi]}],
                        schema=leaf_type)

    def leaf(batches):
        enc = Encoder(spec.value)
        for b in batches:
            for r in b.to_pylist():
                lo = r["lo"]
                r["tokens"] = _edges(enc.spans(r["leaf"], lo), lo, lo + len(r["leaf"])).astype("<i4").T.tobytes()
                yield pa.RecordBatch.from_pylist([r], schema=tokens_type)

    def merge(batches):
        enc, key, parts = Encoder(spec.value), None, []

        def done():
            # equal rows have equal leaves: each stands in as many copies as the row
            copies = sum(p["n"] == 0 for p in parts)
            one = list({p["n"]: p for p in parts}.values())
            at = [p["lo"] for p in one] + [one[-1]["lo"] + len(one[-1]["leaf"])]
            leaves = [np.frombuffer(p["tokens"], "<i4").reshape(3, -1).T.astype(np.int64) for p in one]
            ids = fold(enc, "".join(p["leaf"] for p in one), leaves, at)[:, 0]
            for _ in range(copies):
                yield pa.RecordBatch.from_arrays(
                    [pa.array([key[0]], pa.int64()), pa.array([ids.tolist()], pa.list_(pa.int32()))],
                    names=["doc_id", "ids"])

        for b in batches:
            for r in b.to_pylist():
                if (r["doc_id"], r["mark"]) != key:
                    if parts:
                        yield from done()
                    key, parts = (r["doc_id"], r["mark"]), []
                parts.append(r)
        if parts:
            yield from done()

    leaf_schema = "doc_id long, mark string, n int, of int, lo int, leaf string"
    leaf_type = pa.schema([("doc_id", pa.int64()), ("mark", pa.string()), ("n", pa.int32()),
                           ("of", pa.int32()), ("lo", pa.int32()), ("leaf", pa.string())])
    tokens_type = leaf_type.append(pa.field("tokens", pa.binary()))
    long = F.length("text") > leaf_chars
    leaves = (src.filter(long).withColumn("mark", F.sha2("text", 256)).mapInArrow(cut, leaf_schema)
              .repartition("doc_id", "mark", "n").mapInArrow(leaf, leaf_schema + ", tokens binary"))
    merged = (leaves.repartition("doc_id", "mark").sortWithinPartitions("doc_id", "mark", "n")
              .mapInArrow(lean(merge), ids_schema))
    return src.filter(~long).mapInArrow(lean(short), ids_schema).unionByName(merged)


def decode(encoded: DataFrame, vocabulary: str) -> DataFrame:
    """Adds ``decoded``, the library's decode(ids, skip_special_tokens=False); null ids stay null."""
    with open(vocabulary, encoding="utf-8") as f:
        spec = f.read()
    plain = json.loads(spec).get("decoder") is None     # then the tokens joined by spaces
    spec = encoded.sparkSession.sparkContext.broadcast(spec)
    columns = encoded.columns

    def run(batches):
        from tokenizers import Tokenizer
        tok = Tokenizer.from_str(spec.value)
        size = tok.get_vocab_size(with_added_tokens=True)
        words = np.array([tok.id_to_token(i) for i in range(size)], dtype=object)
        at = columns.index("ids")
        whole_table = all(t is not None for t in words)
        for whole in batches:
            for k in range(0, whole.num_rows, ROWS):
                b = whole.slice(k, ROWS)
                out = []
                for x in b.column(at):
                    if not x.is_valid:
                        out.append(None)
                    elif plain:
                        ids = x.values.to_numpy(zero_copy_only=False)
                        got = words[ids[(ids >= 0) & (ids < size)]].tolist()
                        out.append(" ".join(got if whole_table else [t for t in got if t is not None]))
                    else:
                        out.append(tok.decode(x.as_py(), skip_special_tokens=False))
                yield pa.RecordBatch.from_arrays([*b.columns, pa.array(out, pa.string())],
                                                 names=[*columns, "decoded"])

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in encoded.schema.fields)
    return encoded.mapInArrow(lean(run), f"{fields}, decoded string")


def digests(docs: DataFrame, vocabulary: str, with_ids: bool = False) -> DataFrame:
    """The query's row per document: counts and digests of ids and decoded text (and the ids)."""
    return decode(encode(docs, vocabulary), vocabulary).select(
        "doc_id", *(["ids"] if with_ids else []), F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.concat_ws(" ", F.col("ids").cast("array<string>")).cast("binary"), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))
