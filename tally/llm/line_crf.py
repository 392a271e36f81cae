"""Document quality from a linear-chain conditional random field over lines.

Every line is labelled good or bad. Its features are shares of its own characters and words and those of the lines
before and behind it; the chain's transitions carry what neighbouring labels say about each other. Forward-backward
gives the probability that a line is good, and a document's score is their mean, weighted by the lines' lengths.

Labels exist for documents only. Training takes each line's label from its document, then lets the fitted field
correct the lines of bad documents that it finds good (and of good documents that it finds bad), and fits once more.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tally.llm.batches import balanced, byte_slices, texts_of
from tally.llm.lines import Lines
from tally.llm.words import Words

OWN = 14  # features of a line itself


def line_features(lines: Lines) -> np.ndarray:
    """Of each line: its own features, those of the line before and behind (0 where there is none), and a constant."""
    size = np.maximum(lines.ends - lines.starts, 1)
    words = np.maximum(lines.n_words, 1)
    letters = np.maximum(lines.letters, 1)
    chars = np.maximum(lines.points, 1)
    own = np.column_stack(
        [
            np.log1p(lines.n_words) / 8,
            lines.n_words == 0,
            lines.n_words < 4,
            lines.ended,
            np.minimum(lines.letters / chars, 1),
            lines.upper / letters,
            lines.digits / size,
            np.minimum(lines.symbols / words, 2),
            np.minimum(lines.bangs / words, 2),
            lines.bars / words,
            lines.stutters / words,
            lines.count_words(lines.repeated) / words,
            lines.seen_before,
            np.minimum(lines.points / words / 20, 2),
        ]
    ).astype(np.float64)
    before, behind = np.zeros_like(own), np.zeros_like(own)
    if len(own):
        same = lines.text[1:] == lines.text[:-1]
        before[1:][same] = own[:-1][same]
        behind[:-1][same] = own[1:][same]
    return np.hstack([own, before, behind, np.ones((len(own), 1))])


def weights_of(lines: Lines) -> np.ndarray:
    """Length of each line for the document's mean; a line without characters still counts a little."""
    return lines.points + 1.0


class _Chains:
    """Chains of different lengths side by side: step t of all chains that are that long."""

    def __init__(self, first: np.ndarray):
        sizes = np.diff(first)
        order = np.argsort(-sizes, kind="stable")
        self.begins, self.sizes = first[:-1][order], sizes[order]
        longest = int(self.sizes[0]) if len(sizes) else 0
        self.active = np.searchsorted(-self.sizes, -np.arange(longest), side="left")

    def marginals(self, log_odds: np.ndarray, transitions: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(probability that each line is good, expected number of each transition).

        ``log_odds`` of good to bad by the features; ``transitions[a, b]``: score of label b behind label a.
        """
        n = len(log_odds)
        forth, back = np.zeros((n, 2)), np.zeros((n, 2))
        emit = np.column_stack([np.zeros(n), log_odds])
        for t, k in enumerate(self.active.tolist()):
            at = self.begins[:k] + t
            forth[at] = emit[at]
            if t:
                before = forth[at - 1]
                forth[at] += np.logaddexp(before[:, :1] + transitions[0], before[:, 1:] + transitions[1])
        for t in range(len(self.active) - 1, 0, -1):
            at = self.begins[: self.active[t]] + t
            behind = emit[at] + back[at]
            back[at - 1] = np.logaddexp(transitions[:, 0] + behind[:, :1], transitions[:, 1] + behind[:, 1:])
        joint = forth + back
        total = np.logaddexp(joint[:, 0], joint[:, 1])
        good = np.exp(joint[:, 1] - total)
        later = np.ones(n, bool)
        later[self.begins] = False
        at = np.flatnonzero(later)
        pair = forth[at - 1][:, :, None] + transitions + (emit[at] + back[at])[:, None, :] - total[at][:, None, None]
        return good, np.exp(pair).sum(axis=0)


@dataclass(frozen=True)
class LineField:
    """A fitted field."""

    weights: np.ndarray
    transitions: np.ndarray

    def scores(self, texts: list[str]) -> np.ndarray:
        """Quality of each text, from 0 to 1."""
        if not texts:
            return np.empty(0)
        lines = Lines(Words.of(texts))
        good, _ = _Chains(lines.first).marginals(line_features(lines) @ self.weights, self.transitions)
        length = weights_of(lines)
        return np.clip(lines.per_text(good * length) / lines.per_text(length), 0, 1)


@dataclass(frozen=True)
class LineSample:
    """Stretches of lines of labelled texts: features in 32 bits, and the first line of each text's stretch."""

    features: np.ndarray
    first: np.ndarray

    def __len__(self) -> int:
        return len(self.first) - 1


def sample_of(texts: list[str], most_lines: int | None = None) -> LineSample:
    """Of each text ``most_lines`` consecutive lines, from a place that a hash of the text gives; all of shorter ones.

    Features are those of the lines within their whole texts.
    """
    lines = Lines(Words.of(texts))
    features = line_features(lines).astype(np.float32)
    kept = []
    for i, text in enumerate(texts):
        begin, end = int(lines.first[i]), int(lines.first[i + 1])
        spare = end - begin - (most_lines or end - begin)
        if spare > 0:
            begin += zlib.crc32(text.encode("utf-8", "surrogatepass")) % (spare + 1)
        kept.append(features[begin : min(end, begin + (most_lines or end))])
    first = np.concatenate([[0], np.cumsum([len(k) for k in kept])]).astype(np.int64)
    return LineSample(np.concatenate(kept) if kept else features, first)


def fit(
    texts: list[str] | LineSample, good: np.ndarray, steps: int = 80, rounds: int = 2, penalty: float = 1e-3, rate: float = 0.1, sure: float = 0.95
) -> LineField:
    """Fit the field to labelled texts (``good``: 1 or 0) by gradient ascent (Adam) on the lines' likelihood.

    Both classes weigh the same in all. Without texts of both classes every score is 0.5 or follows the one class.
    A sample of lines is worked on as it is, in 32 bits: some 400 bytes a line in all.
    """
    sample = texts if isinstance(texts, LineSample) else sample_of(texts)
    x, chains = sample.features, _Chains(sample.first)
    w, trans = np.zeros(x.shape[1]), np.zeros((2, 2))
    if not len(sample):
        return LineField(w, trans)
    y = np.repeat(good, np.diff(sample.first)).astype(np.float32)
    later = np.ones(len(y), bool)
    later[sample.first[:-1]] = False
    at = np.flatnonzero(later)
    # a class's weight is shared by its lines; a chain lies within one class, so weights go with the chain
    share = np.where(y == 1, 0.5 / max(y.sum(), 1), 0.5 / max((1 - y).sum(), 1)).astype(np.float32)
    for turn in range(rounds):
        seen = np.zeros((2, 2))
        np.add.at(seen, (y[at - 1].astype(int), y[at].astype(int)), 1.0)
        theta = np.concatenate([w, trans.ravel()])
        m, v = np.zeros_like(theta), np.zeros_like(theta)
        for step in range(1, steps + 1):
            p, expected = chains.marginals(x @ theta[:-4].astype(np.float32), theta[-4:].reshape(2, 2))
            slope = np.concatenate([x.T @ ((y - p.astype(np.float32)) * share), ((seen - expected) / len(y)).ravel()]) - penalty * theta
            m, v = 0.9 * m + 0.1 * slope, 0.999 * v + 0.001 * slope * slope
            theta += rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
        w, trans = theta[:-4], theta[-4:].reshape(2, 2)
        if turn + 1 < rounds:
            alone = 1 / (1 + np.exp(-(x @ w.astype(np.float32))))  # the line without its neighbours' labels
            y = np.where((y == 0) & (alone > sure), 1.0, np.where((y == 1) & (alone < 1 - sure), 0.0, y)).astype(np.float32)
    return LineField(w, trans)


def training_texts(
    docs: DataFrame, labels: DataFrame, per_class: int = 1000, lines_per_text: int = 64, id_column: str = "doc_id", text_column: str = "text", label_column: str = "quality"
) -> tuple[LineSample, np.ndarray]:
    """A bounded sample of labelled lines: of each class the ``per_class`` labelled ids with the smallest hash, and of each
    of their texts a stretch of ``lines_per_text`` lines, however long the text is. ``labels`` may hold ids several times;
    ids with differing or null labels, and null texts, train nothing. Features are made where the texts are; the driver
    gets 2 * per_class * lines_per_text * 43 numbers of 32 bits at most (22 MB), and no text."""
    agreed = labels.groupBy(id_column).agg(F.min(label_column).alias("low"), F.max(label_column).alias("high"))
    agreed = agreed.where((F.col("low") == F.col("high")) & F.col("low").isin(0, 1) & F.col(id_column).isNotNull()).select(
        F.col(id_column).alias("id"), F.col("low").alias("good")
    )
    order = F.xxhash64(F.col("id").cast("string"))
    chosen = agreed.where("good = 1").orderBy(order).limit(per_class).unionAll(agreed.where("good = 0").orderBy(order).limit(per_class))
    rows = chosen.collect()  # 2 * per_class rows at most
    if not rows:
        return LineSample(np.empty((0, 3 * OWN + 1), np.float32), np.zeros(1, np.int64)), np.empty(0)

    def measure(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in byte_slices(batches):
            sample = sample_of(texts_of(part), lines_per_text)
            blobs = [sample.features[a:b].tobytes() for a, b in zip(sample.first, sample.first[1:], strict=False)]
            yield pa.RecordBatch.from_arrays([part.column("id"), part.column("good"), pa.array(blobs, pa.binary())], ["id", "good", "lines"])

    wanted = docs.sparkSession.createDataFrame(rows, chosen.schema)
    texts = docs.select(F.col(id_column).alias("id"), F.col(text_column).alias("text")).where(F.col("text").isNotNull())
    once = texts.join(F.broadcast(wanted), "id").groupBy("id", "good").agg(F.min("text").alias("text"))  # the sample's size is bounded above
    schema = T.StructType([chosen.schema["id"], chosen.schema["good"], T.StructField("lines", T.BinaryType())])
    found = sorted(once.mapInArrow(measure, schema).collect(), key=lambda r: (r["good"], str(r["id"])))
    parts = [np.frombuffer(r["lines"], np.float32).reshape(-1, 3 * OWN + 1) for r in found]
    first = np.concatenate([[0], np.cumsum([len(p) for p in parts])]).astype(np.int64)
    features = np.concatenate(parts) if parts else np.empty((0, 3 * OWN + 1), np.float32)
    return LineSample(features, first), np.array([r["good"] for r in found])


def quality_scores(docs: DataFrame, field: LineField, id_column: str = "doc_id", text_column: str = "text", threshold: float = 0.3) -> DataFrame:
    """One row per row of ``docs``: id, score and predicted (1 if score >= ``threshold``).

    Only the text enters a score. Null and empty texts are one empty line and get that line's probability; repeated
    rows are scored each; an empty table gives an empty one; further columns are left behind. Texts are read whole. No
    shuffle.
    """

    def score(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in byte_slices(batches):
            yield pa.RecordBatch.from_arrays([part.column("id"), pa.array(field.scores(texts_of(part)))], ["id", "score"])

    narrow = balanced(docs.select(F.col(id_column).alias("id"), F.col(text_column).alias("text")))
    schema = T.StructType([narrow.schema["id"], T.StructField("score", T.DoubleType())])
    scored = narrow.mapInArrow(score, schema)
    return scored.select(F.col("id").alias(id_column), "score", F.when(F.col("score") >= threshold, 1).otherwise(0).alias("predicted"))


def keep_good(docs: DataFrame, field: LineField, text_column: str = "text", threshold: float = 0.3) -> DataFrame:
    """The rows of ``docs`` whose score reaches the threshold, with all their columns.

    Null and empty texts get the probability of one empty line; repeated rows are judged each; texts are read whole,
    whatever their length; an empty table gives an empty one, and columns may have any names.
    """
    at = docs.columns.index(text_column)
    names = [f"c{i}" for i in range(len(docs.columns))]

    def keep(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in byte_slices(batches, names[at]):
            yield part.filter(pa.array(field.scores(texts_of(part, names[at])) >= threshold))

    numbered = balanced(docs.toDF(*names))  # whatever the columns are called
    return numbered.mapInArrow(keep, numbered.schema).toDF(*docs.columns)


def held_out(id_column: str = "doc_id"):
    """Rows that no training sees: crc32 of the id as text is divisible by 5."""
    return F.crc32(F.col(id_column).cast("string").cast("binary")) % 5 == 0
