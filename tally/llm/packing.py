"""Best-fit packing by a configuration linear program over the histogram of lengths.

A configuration says how many pieces of which lengths share one sequence. The program asks for the fewest sequences
that hold as many pieces of each length as there are. It is solved by multiplicative weights: lengths that are covered
badly so far get a high price, a knapsack dynamic program finds the most valuable configuration at these prices, and
the configuration is used until one of its lengths is covered once more. The fractional solution is rounded down; what
stays open is packed by best fit, again with whole groups of equal sequences. All of this sees the histogram only, whose
size is the capacity, however many pieces there are. Spark numbers the pieces of each length and looks their places up.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tally.llm.batches import TOKEN_BYTES, balanced, byte_slices
from tally.llm.pieces import loaded, with_end
from tally.llm.scratch import written

ROUNDS = 300
STEEPNESS = 1.0
# shares of the fractional solution that are tried when it is rounded; the one that ends in the fewest sequences stays
ROUNDINGS = (1.0, 0.75, 0.5, 0.25, 0.0)


def best_configuration(values: np.ndarray, capacity: int) -> dict[int, int]:
    """Unbounded knapsack: the counts of lengths, at most ``capacity`` in all, of the greatest total value.

    ``values[l]`` is the value of a piece of length l, 0 for lengths that are not there.
    """
    best = np.zeros(capacity + 1)
    taken = np.zeros(capacity + 1, np.int64)
    lengths = np.flatnonzero(values > 0)
    worth = values[lengths]
    fitting = np.searchsorted(lengths, np.arange(capacity + 1), side="right")
    for room in range(1, capacity + 1):
        n = fitting[room]
        best[room] = best[room - 1]
        if n:
            total = best[room - lengths[:n]] + worth[:n]
            i = int(total.argmax())
            if total[i] > best[room]:
                best[room], taken[room] = total[i], lengths[i]
    found: dict[int, int] = {}
    room = capacity
    while room > 0:
        if taken[room]:
            found[int(taken[room])] = found.get(int(taken[room]), 0) + 1
            room -= int(taken[room])
        else:
            room -= 1
    return found


def solve(histogram: np.ndarray, capacity: int, rounds: int = ROUNDS) -> list[tuple[dict[int, int], float]]:
    """A fractional solution of the covering program: (configuration, times)."""
    counts = histogram.astype(float)
    there = counts > 0
    covered = np.zeros(len(counts))
    used: dict[tuple[tuple[int, int], ...], float] = {}
    for _ in range(rounds if there.any() else 0):
        share = np.divide(covered, counts, out=np.full(len(counts), np.inf), where=there)
        if share.min() >= 1:
            break
        weights = np.zeros(len(counts))
        weights[there] = np.flatnonzero(there) * np.exp(-STEEPNESS * share[there])
        weights[share >= 1] *= 1e-3
        found = best_configuration(weights, capacity)
        times = min(max(counts[l] - covered[l], 0) / n for l, n in found.items() if share[l] < 1) if any(share[l] < 1 for l in found) else 0
        if times <= 0:
            break
        for length, n in found.items():
            covered[length] += n * times
        key = tuple(sorted(found.items(), reverse=True))
        used[key] = used.get(key, 0.0) + times
    return [(dict(k), x) for k, x in sorted(used.items(), key=lambda kx: -kx[1])]


def plan(histogram: np.ndarray, capacity: int, rounds: int = ROUNDS) -> list[tuple[dict[int, int], int]]:
    """Whole numbers of configurations that hold exactly the pieces of the histogram (``histogram[l]`` of length l).

    At most ``rounds`` configurations come from the program, and each step of best fit uses up at least one length, or
    leaves fewer than one sequence takes of it, so the plan's size depends on the capacity alone.
    """
    solution = solve(np.where(np.arange(len(histogram)) == capacity, 0, histogram), capacity, rounds)
    rounded = [_rounded(histogram, capacity, [(c, x * share) for c, x in solution]) for share in ROUNDINGS]
    return min(rounded, key=lambda out: sum(times for _, times in out))


def _rounded(histogram: np.ndarray, capacity: int, solution: list[tuple[dict[int, int], float]]) -> list[tuple[dict[int, int], int]]:
    left = histogram.astype(np.int64).copy()
    out: list[tuple[dict[int, int], int]] = []

    def use(found: dict[int, int], times: int) -> None:
        if times > 0:
            for length, n in found.items():
                left[length] -= n * times
            out.append((found, times))

    use({capacity: 1}, int(left[capacity]))
    for found, x in solution:
        use(found, min(int(x + 1e-9), *(int(left[l]) // n for l, n in found.items())))
    while left.any():
        found, room = {}, capacity
        there = np.flatnonzero(left)
        while room and len(there):
            fits = int(np.searchsorted(there, room, side="right"))
            if not fits:
                break
            length = int(there[fits - 1])
            n = min(room // length, int(left[length]))
            found[length] = n
            room -= n * length
            there = there[: fits - 1]
        use(found, min(int(left[l]) // n for l, n in found.items()))
    return out


@dataclass(frozen=True)
class Places:
    """Where the pieces go: entry i takes the pieces of ``length[i]`` numbered from ``first[i]``, ``each[i]`` per
    sequence from ``sequence[i]`` on, the first of them at ``offset[i]``."""

    length: np.ndarray
    first: np.ndarray
    each: np.ndarray
    sequence: np.ndarray
    offset: np.ndarray

    def of(self, lengths: np.ndarray, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(sequence, offset) of the pieces."""
        key = (self.length << 48) + self.first
        i = np.searchsorted(key, (lengths << 48) + numbers, side="right") - 1
        within = numbers - self.first[i]
        return self.sequence[i] + within // self.each[i], self.offset[i] + within % self.each[i] * lengths


def places(configurations: list[tuple[dict[int, int], int]]) -> Places:
    rows, numbered, sequence = [], {}, 0
    for found, times in configurations:
        offset = 0
        for length, n in sorted(found.items(), reverse=True):
            rows.append((length, numbered.get(length, 0), n, sequence, offset))
            numbered[length] = numbered.get(length, 0) + n * times
            offset += n * length
        sequence += times
    return Places(*np.array(sorted(rows), np.int64).reshape(-1, 5).T)


def token_pieces(
    docs: DataFrame, tokenizer: str, end_id: int, capacity: int = 2048, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """One row per piece: id, piece, start, length, ids_crc32, and ``task`` and ``number``, which number the pieces of
    each length within the task that made them.

    A document is its ids and ``end_id``; one longer than ``capacity`` is cut into pieces of that length, of which the
    first is shorter if it does not come out even. Null texts count as empty, so every document has a piece.
    """

    def cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, task, seen = loaded(tokenizer), TaskContext.get().partitionId(), np.zeros(capacity + 1, np.int64)
        for part in byte_slices(batches, "text", TOKEN_BYTES):
            ids, ends = with_end(*encoder.ids(part.column("text")), end_id)
            sizes = np.diff(ends, prepend=0)
            n = -(-sizes // capacity)
            row = np.repeat(np.arange(len(n)), n)
            piece = np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)
            first = sizes - (n - 1) * capacity
            start = np.where(piece == 0, 0, first[row] + (piece - 1) * capacity)
            length = np.where(piece == 0, first[row], capacity)
            at = (ends - sizes)[row] + start
            raw = memoryview(np.ascontiguousarray(ids, dtype="<u4")).cast("B")
            crcs = [zlib.crc32(raw[4 * a : 4 * b]) for a, b in zip(at.tolist(), (at + length).tolist(), strict=True)]
            by_length = np.argsort(length, kind="stable")
            run = length[by_length]
            _, heads, counts = np.unique(run, return_index=True, return_counts=True)
            number = np.empty(len(run), np.int64)
            number[by_length] = seen[run] + np.arange(len(run)) - np.repeat(heads, counts)
            seen += np.bincount(length, minlength=capacity + 1)
            yield pa.RecordBatch.from_arrays(
                [
                    part.column("id").take(pa.array(row)),
                    pa.array(piece, pa.int32()),
                    pa.array(start, pa.int64()),
                    pa.array(length, pa.int64()),
                    pa.array(crcs, pa.int64()),
                    pa.array(np.full(len(row), task, np.int32)),
                    pa.array(number, pa.int64()),
                ],
                ["id", "piece", "start", "length", "ids_crc32", "task", "number"],
            )

    narrow = balanced(docs.select(F.col(id_column).alias("id"), F.col(text_column).alias("text")))
    schema = T.StructType(
        [
            narrow.schema["id"],
            T.StructField("piece", T.IntegerType()),
            *(T.StructField(c, T.LongType()) for c in ("start", "length", "ids_crc32")),
            T.StructField("task", T.IntegerType()),
            T.StructField("number", T.LongType()),
        ]
    )
    return narrow.mapInArrow(cut, schema).withColumnRenamed("id", id_column)


def best_fit_packing(
    docs: DataFrame,
    tokenizer: str,
    end_id: int,
    capacity: int = 2048,
    id_column: str = "doc_id",
    text_column: str = "text",
    rounds: int = ROUNDS,
) -> DataFrame:
    """Pack all documents into sequences of at most ``capacity`` tokens.

    Per piece: id, piece (from 0), start (its document's ids before it), length, ids_crc32 (of its ids as
    little-endian unsigned 32-bit integers), sequence_id, offset. Every row of ``docs`` is packed, repeated rows and
    rows without an id or text included; an empty table gives an empty one; further columns are left behind. The pieces
    are written once to the shared folder. Pieces of one length are numbered by the counts of the tasks before, so a
    length that a third of all pieces have is never gathered.
    """
    pieces = written(token_pieces(docs, tokenizer, end_id, capacity, id_column, text_column), "pieces")
    per_task = pieces.groupBy("length", "task").agg(F.count("*").alias("n"))
    histogram = np.zeros(capacity + 1, np.int64)
    for row in per_task.groupBy("length").agg(F.sum("n").alias("n")).collect():  # one row per length, capacity at most
        histogram[row["length"]] = row["n"]
    table = places(plan(histogram, capacity, rounds))
    earlier = Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    before = per_task.select("length", "task", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))

    def place(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lengths, numbers = (batch.column(c).to_numpy() for c in ("length", "number"))
            sequence, offset = table.of(lengths, numbers)
            kept = [c for c in batch.schema.names if c != "number"]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in kept), pa.array(sequence), pa.array(offset)], [*kept, "sequence_id", "offset"])

    numbered = pieces.join(before, ["length", "task"]).select(
        F.col(id_column).alias("id"), "piece", "start", "length", "ids_crc32", (F.col("before") + F.col("number")).alias("number")
    )
    schema = T.StructType([*numbered.schema.fields[:-1], T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType())])
    return numbered.mapInArrow(place, schema).withColumnRenamed("id", id_column)
