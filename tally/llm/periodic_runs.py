"""Periodic runs of words, found with suffix trees.

A run is a stretch of words with a smallest period q that no neighbour extends; only runs of at least ``least_words``
words and ``least_powers`` periods count. Every run contains a Lyndon word of its period's length that is the longest one
at its place, under the order of the words or under its reverse. So the longest Lyndon words at all places (the next
smaller and the next greater suffix end them) are the candidates, and each is extended: to the right by the longest
common extension of its place and the place behind it, to the left by the same of the reversed sequence. Both come from
Ukkonen trees with constant-time ancestors.

Most words can't be in a run: each three words in a row that a run holds occur in it three times. Words outside of all
stretches of such threes are left out beforehand, a mark in their place, so trees are built for what remains alone.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tally.llm.batches import byte_slices, texts_of
from tally.llm.suffix_tree import SuffixTree
from tally.llm.words import Words, mixed

LEAST_WORDS = 6
LEAST_POWERS = 4
_ROUNDS = 8  # of narrowing; any number leaves all runs in

RUNS = "array<struct<start:bigint,length:bigint,period:bigint>>"
_RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])


def _lyndon_ends(rank: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """Where the longest Lyndon word at each place ends: the next suffix of smaller rank; under the reverse order, of greater."""
    n = len(rank)
    smaller, greater = [n] * n, [n] * n
    down: list[int] = []
    up: list[int] = []
    for i, r in enumerate(rank):
        while down and rank[down[-1]] > r:
            smaller[down.pop()] = i
        down.append(i)
        while up and rank[up[-1]] < r:
            greater[up.pop()] = i
        up.append(i)
    return np.array(smaller), np.array(greater)


def runs_of(symbols: list[int], least_words: int = LEAST_WORDS, least_powers: int = LEAST_POWERS) -> np.ndarray:
    """(start, length, period) of every run, by start, then period. ``least_powers`` is 2 or more."""
    n = len(symbols)
    if n < max(least_words, least_powers):
        return np.empty((0, 3), np.int64)
    tree = SuffixTree(symbols)
    at = np.arange(n)
    found = []
    ends = _lyndon_ends(tree.rank)
    candidates = []
    for end in ends:
        period = end[:n] - at
        fits = np.flatnonzero((end[:n] <= n) & (least_powers * period <= n))
        period = period[fits]
        right = fits + period + tree.common(fits, fits + period)
        candidates.append((fits, period, right))
    del tree
    back = SuffixTree(symbols[::-1])
    for i, period, right in candidates:
        left = i - back.common(n - i, n - i - period)
        length = right - left
        whole = length >= np.maximum(least_words, least_powers * period)
        found.append(np.column_stack([left, period, length])[whole])
    ordered = np.unique(np.concatenate(found), axis=0)
    return ordered[:, [0, 2, 1]]


def repeating_stretches(words: Words) -> tuple[np.ndarray, np.ndarray]:
    """First word and end of the stretches outside of which no run of 6 words and 4 periods or more can lie."""
    hashes, at = words.windows(3)
    text = np.searchsorted(words.first, at, side="right").astype(np.uint64)
    group = text
    for _ in range(_ROUNDS):
        if not len(at):
            break
        _, inverse, counts = np.unique(mixed(hashes ^ mixed(group)), return_inverse=True, return_counts=True)
        keep = counts[inverse] >= 3
        hashes, at = hashes[keep], at[keep]
        group = np.cumsum(np.diff(at, prepend=-2) != 1).astype(np.uint64)  # stretches of threes one word apart
        if keep.all():
            break
    if not len(at):
        return at, at
    first = np.flatnonzero(np.diff(at, prepend=-2) != 1)
    last = np.append(first[1:], len(at)) - 1
    long = at[last] + 3 - at[first] >= LEAST_WORDS
    return at[first][long], at[last][long] + 3


def text_runs(texts: list[str], least_words: int = LEAST_WORDS, least_powers: int = LEAST_POWERS) -> list[np.ndarray]:
    """The runs of each text's words, as ``runs_of``."""
    words = Words.of(texts)
    narrow = least_words >= LEAST_WORDS and least_powers >= LEAST_POWERS
    begins, ends = repeating_stretches(words) if narrow else (words.first[:-1], words.first[1:])
    owner = np.searchsorted(words.first, begins, side="right") - 1 if narrow else np.arange(len(texts))
    found = [np.empty((0, 3), np.int64)] * len(texts)
    for i in np.unique(owner).tolist():
        own = texts[i].encode("utf-8", "surrogatepass").split()
        offset = words.first[i]
        mine = np.flatnonzero(owner == i)
        number: dict[bytes, int] = {}
        stretches = [[number.setdefault(w, len(number)) for w in own[b:e]] for b, e in zip((begins[mine] - offset).tolist(), (ends[mine] - offset).tolist(), strict=True)]
        symbols: list[int] = []
        placed = []
        for k, stretch in enumerate(stretches):
            placed.append(len(symbols))
            symbols += stretch
            symbols.append(len(number) + k)  # a mark of its own, in no run
        runs = runs_of(symbols, least_words, least_powers)
        which = np.searchsorted(placed, runs[:, 0], side="right") - 1
        runs[:, 0] += (begins[mine] - offset)[which] - np.array(placed)[which]
        found[i] = runs
    return found


def collapsed(text: str, runs: np.ndarray) -> str:
    """The words one space apart, without those behind the first period of a run."""
    own = text.encode("utf-8", "surrogatepass").split()
    if len(runs):
        change = np.zeros(len(own) + 1, np.int64)
        np.add.at(change, runs[:, 0] + runs[:, 2], 1)
        np.add.at(change, runs[:, 0] + runs[:, 1], -1)
        own = compress(own, (np.cumsum(change[:-1]) == 0).tolist())
    return b" ".join(own).decode("utf-8", "surrogatepass")


def periodic_runs(
    docs: DataFrame,
    least_words: int = LEAST_WORDS,
    least_powers: int = LEAST_POWERS,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """The id, runs (start, length, period; words numbered from 0) by start, then period, and the collapsed text of every row.

    Words are runs of characters other than space, tab, line feed, vertical tab, form feed and carriage return, compared
    byte by byte. A run has a smallest period q, at least ``least_words`` words and ``least_powers`` * q of them (2 or
    more powers; below 6 words or 4 powers the trees take in whole texts), and no neighbour extends it. ``collapsed``
    holds the words one space apart, without those that some run has behind its first q words. A null or empty text has
    no runs and an empty collapsed text. Rows are judged alone: null ids, ties and repeated rows need no care, an empty
    table gives an empty one, further columns are not read. Time is linear in a text's length (up to sorting), memory
    too: some 400 bytes a word of its repeating stretches while a tree is built.
    """
    if least_powers < 2:
        raise ValueError("a run has two powers or more")

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in byte_slices(batches):
            texts = texts_of(batch)
            runs = text_runs(texts, least_words, least_powers)
            offsets = pa.array(np.concatenate([[0], np.cumsum([len(r) for r in runs])]).astype(np.int32))
            flat = np.concatenate(runs) if runs else np.empty((0, 3), np.int64)
            structs = pa.StructArray.from_arrays([pa.array(np.ascontiguousarray(flat[:, k])) for k in range(3)], fields=list(_RUN))
            kept = pa.array([collapsed(t, r) for t, r in zip(texts, runs, strict=True)], pa.string())
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.ListArray.from_arrays(offsets, structs), kept], ["id", "runs", "collapsed"])

    rows = docs.select(F.col(id_column).alias("id"), F.col(text_column).alias("text"))
    return rows.mapInArrow(scan, f"id {rows.schema['id'].dataType.simpleString()}, runs {RUNS}, collapsed string").withColumnRenamed("id", id_column)


def strongest(runs: Column) -> Column:
    """The run with the greatest length / period (compared exactly), then the smallest start, then period; null if none."""
    return F.get(
        F.array_sort(
            runs,
            lambda x, y: F.when(x["length"] * y["period"] != y["length"] * x["period"], F.when(x["length"] * y["period"] > y["length"] * x["period"], -1).otherwise(1))
            .when(x["start"] != y["start"], F.when(x["start"] < y["start"], -1).otherwise(1))
            .otherwise(F.when(x["period"] < y["period"], -1).when(x["period"] > y["period"], 1).otherwise(0)),
        ),
        0,
    )


def run_digests(found: DataFrame) -> DataFrame:
    """``periodic_runs`` with runs and text as digests: n_runs, the strongest run, exponent_milli, two sha256 strings."""
    lines = F.transform("runs", lambda r: F.concat_ws(",", r["start"].cast("string"), r["length"].cast("string"), r["period"].cast("string")))
    hashed = F.sha2(F.when(F.size("runs") > 0, F.concat(F.array_join(lines, "\n"), F.lit("\n"))).otherwise(F.lit("")), 256)
    best = found.withColumns({"best__": strongest(F.col("runs")), "runs_sha256": hashed, "collapsed_sha256": F.sha2("collapsed", 256), "n_runs": F.size("runs").cast("long")})
    named = [F.col(f"best__.{c}").alias(c) for c in ("start", "length", "period")]
    milli = F.expr("(1000 * best__.length) div best__.period").alias("exponent_milli")
    others = [c for c in found.columns if c not in ("runs", "collapsed")]
    return best.select(*others, "n_runs", *named, milli, "runs_sha256", "collapsed_sha256")
