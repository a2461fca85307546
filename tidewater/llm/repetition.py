"""Quality rules on repetition, from a suffix array over a text's words.

Suffixes in order, with the longest common prefix of each two neighbours, show every repeat:
an interval of suffixes that share their first L words, and no more, is a substring of L
words that occurs as often as the interval is wide and that no next word prolongs. It is a
maximal repeat where the words before its occurrences differ, too. The operator counts the
maximal repeats of ``MIN_REPEAT`` words or more, takes the union of the spans of all their
occurrences, and rejects a text where that union holds more than ``MAX_COVERED`` percent of
the characters in words, or where the longest repeat has more than ``MAX_LONGEST`` words and
more than ``MAX_LONGEST_SHARE`` percent of all words.

The union is taken suffix by suffix: a suffix covers as many words as its longest common
prefix with a neighbour, which is its deepest interval. Where that interval is no maximal
repeat, the same word stands before all its occurrences, and the suffix one word earlier
covers the span as well; so both unions are one.

Base rules (``base_failed``): under ``MIN_WORDS`` words, or more than half of the words in
windows of three that the text holds twice or more.

Rows: a null text has no words and fails the base rules, an empty one likewise; a null id
stays null; equal rows give equal results; the table's other columns are not read.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import id_text, strings
from .suffixes import Suffixes, blocks, covered, numbered

MIN_WORDS = 50
WINDOW = 3                  # words of the base rule's windows
MIN_REPEAT = 10             # words of the shortest repeat that counts
MAX_COVERED = 25            # percent of the characters in words
MAX_LONGEST, MAX_LONGEST_SHARE = 50, 15     # words; percent of the words
SYMBOL = re.compile(r"[#*$%&|<>]")

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_repeats", "covered_words",
          "covered_chars", "longest_repeat")


def maximal_repeats(suffixes: Suffixes, common: np.ndarray) -> np.ndarray:
    """By text: how many maximal repeats; ``common`` is 0 where two neighbours share too little."""
    array = suffixes.array
    before = np.where(array > suffixes.start[array], suffixes.symbols[array - 1], -1)
    changes = np.append(0, np.cumsum(before[1:] != before[:-1]))
    count = np.zeros(int(suffixes.text.max(initial=-1)) + 1, np.int64)
    slots = np.flatnonzero(common)
    depth, where, seen = common[slots].tolist(), slots.tolist(), changes.tolist()
    texts = suffixes.text[array[slots]].tolist()
    open_: list[tuple[int, int]] = []       # (words shared, first slot) of intervals that may go on

    def close(upto: int, last: int, text: int) -> int:
        """Ends the intervals deeper than ``upto`` at slot ``last``; gives the first slot of the last one ended."""
        first = last
        while open_ and open_[-1][0] > upto:
            _, first = open_.pop()
            count[text] += seen[last] > seen[first]
        return first

    for k, (words, slot) in enumerate(zip(depth, where)):
        if k and where[k - 1] != slot - 1:
            close(0, where[k - 1], texts[k - 1])
        first = slot - 1
        if open_ and open_[-1][0] > words:
            first = close(words, slot - 1, texts[k])
        if not open_ or open_[-1][0] < words:
            open_.append((words, first))
    if where:
        close(0, where[-1], texts[-1])
    return count


def _duplicate_lines(text: str) -> int:
    lines = [x for x in text.split("\n") if x.strip(" \t\n\v\f\r")]
    return len(lines) - len(set(lines))


def measured(block: list[tuple[object, str, list[str]]]) -> dict[str, np.ndarray]:
    """The counts of every text of a block."""
    symbols, bounds = numbered([w for _, _, w in block])
    suffixes = Suffixes(symbols, bounds)
    n, texts = suffixes.n, len(block)
    chars = np.array([len(x) for _, _, w in block for x in w], np.int64)

    def spans(common: np.ndarray, length: np.ndarray) -> np.ndarray:
        hit = np.flatnonzero(length)
        return covered(suffixes.array[hit], length[hit], n)

    def by_text(values: np.ndarray) -> np.ndarray:
        return np.diff(np.append(0, np.cumsum(values))[bounds])

    common = suffixes.common(WINDOW)
    deepest = np.maximum(common, np.append(common[1:], 0))
    longest = np.zeros(texts, np.int64)
    np.maximum.at(longest, suffixes.text[suffixes.array], common)
    window = spans(common, np.where(deepest > 0, WINDOW, 0))
    cover = spans(common, np.where(deepest >= MIN_REPEAT, deepest, 0))
    repeats = np.zeros(texts, np.int64)
    some = maximal_repeats(suffixes, np.where(common >= MIN_REPEAT, common, 0))
    repeats[:len(some)] = some
    return {
        "n_words": np.diff(bounds), "word_chars": by_text(chars),
        "n_symbols": np.array([len(SYMBOL.findall(t)) for _, t, _ in block], np.int64),
        "n_dup_lines": np.array([_duplicate_lines(t) for _, t, _ in block], np.int64),
        "n_repeat_words": by_text(window.astype(np.int64)), "n_repeats": repeats,
        "covered_words": by_text(cover.astype(np.int64)), "covered_chars": by_text(np.where(cover, chars, 0)),
        "longest_repeat": np.where(longest >= MIN_REPEAT, longest, 0),
    }


def counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: ``COUNTS`` of its whole text (``longest_repeat``: 0 under MIN_REPEAT words)."""
    def run(batches):
        for b in batches:
            at = iter(range(b.num_rows))
            for block in blocks(zip(at, strings(b, "text"))):
                got = measured(block)
                ids = b.column(0).slice(block[0][0], len(block))
                yield pa.RecordBatch.from_arrays([ids, *[pa.array(got[c]) for c in COUNTS]], names=["doc_id", *COUNTS])

    return id_text(docs, id_col, text_col).mapInArrow(run, ", ".join(["doc_id long", *[f"{c} long" for c in COUNTS]]))


def rules(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """:func:`counts` with ``base_failed`` and ``kept``."""
    base = ((F.col("n_words") < MIN_WORDS) |
            (100 * F.col("n_repeat_words") > 50 * F.col("n_words")))
    repeats = ((100 * F.col("covered_chars") > MAX_COVERED * F.col("word_chars")) |
               ((F.col("longest_repeat") > MAX_LONGEST) &
                (100 * F.col("longest_repeat") > MAX_LONGEST_SHARE * F.col("n_words"))))
    return counts(docs, id_col, text_col).withColumn("base_failed", base).withColumn("kept", ~(base | repeats))
