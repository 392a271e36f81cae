"""Hard-negative mining with angular triangle filtering.

Every row stores its angles to a few reference directions. By the triangle inequality for angles, the angle between two
rows lies between the largest difference and the smallest sum of their angles to a direction, so its cosine lies in an
interval; times both norms, widened for rounding, that bounds the rows' integer inner product without touching the
vectors. Only pairs whose bounds meet what is wanted (the best five so far, or the window below a positive's score) are
scored, in whole numbers. The bounds drop nothing that counts, so results are exact whatever the directions are.

Anchors and rows are dealt in blocks: positives within a label, negatives by nearest direction, where the bounds of a
whole group of rows against a whole group of anchors spare sending it. Blocks are cut by counts, so a label or a
direction that holds most rows makes more blocks, not larger ones.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tally.llm.scratch import written

DIRECTIONS = 16  # reference directions
DIRECTION_SAMPLE = 512  # rows from which the directions are chosen; they steer the cost, never the result
ANCHOR_BLOCK = 512
ROW_BLOCK = 4096
MARGIN = 4e-6  # on angles and cosines; stored angles are 32-bit (error below 5e-7)
MOST_NORM = 2.0**31  # the product of two such norms still fits a long
EXACT = 2.0**53  # sums of products below it are whole in double precision


def whole_components(vector: Column, scale: float = 256.0) -> Column:
    """floor(scale * x) of each component, as doubles; null where the vector, or a component, is null or not finite."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) != float("inf")))
    return F.when(finite, F.transform(vector, lambda x: F.floor(F.lit(scale) * x.cast("double")).cast("double")))


# ---------------------------------------------------------------- blocks of vectors


class Block:
    """Rows of one dimension: ids, labels, whole vectors as doubles, norms, angles to the directions."""

    def __init__(self, table: pa.Table):
        self.table = table
        self.ids, self.norms = table["id"].to_numpy(), table["norm"].to_numpy()
        self.labels = table["label"].combine_chunks().dictionary_encode()
        self.vectors, self.angles = _matrix(table["vector"], np.float64), _matrix(table["angles"], np.float32)

    def __len__(self) -> int:
        return len(self.ids)


def _matrix(column: pa.ChunkedArray, kind: type) -> np.ndarray:
    flat = column.combine_chunks().flatten().to_numpy(zero_copy_only=False).astype(kind)
    return flat.reshape(len(column), -1) if len(column) else flat.reshape(0, 0)


def blocks_of(table: pa.Table) -> dict[int, Block]:
    """By dimension."""
    if not table.num_rows:
        return {}
    sizes = table["size"].to_numpy()
    return {int(d): Block(table.filter(pa.array(sizes == d))) for d in np.unique(sizes)}


def same_label(a: Block, b: Block) -> np.ndarray:
    theirs = {v: i for i, v in enumerate(b.labels.dictionary.to_pylist())}
    number = np.array([theirs.get(v, -1) for v in a.labels.dictionary.to_pylist()], np.int64)
    return number[a.labels.indices.to_numpy()][:, None] == b.labels.indices.to_numpy()


def angle_bounds(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Least and greatest angle between each row of ``a`` and of ``b``, from their angles to the same directions."""
    least = np.zeros((len(a), len(b)), np.float32)
    most = np.full((len(a), len(b)), np.pi, np.float32)
    for mine, theirs in zip(a.T, b.T, strict=True):
        np.maximum(least, np.abs(mine[:, None] - theirs), out=least)
        total = mine[:, None] + theirs
        np.minimum(most, np.minimum(total, np.float32(2 * np.pi) - total), out=most)
    return least, most


def cosine_bounds(least: np.ndarray, most: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(lower, upper) of the cosine, safe against the rounding of stored angles and of this arithmetic."""
    lower = np.cos(np.minimum(most + np.float32(MARGIN), np.float32(np.pi))).astype(np.float64) - MARGIN
    upper = np.cos(np.maximum(least - np.float32(MARGIN), np.float32(0))).astype(np.float64) + MARGIN
    return lower, upper


def score_bounds(a: Block, b: Block) -> tuple[np.ndarray, np.ndarray]:
    """(lower, upper) of the integer inner product of all pairs."""
    norms = np.outer(a.norms, b.norms) * (1 + 1e-9)
    lower, upper = cosine_bounds(*angle_bounds(a.angles, b.angles))
    return norms * np.minimum(lower, 1.0), norms * upper


def scored(a: Block, b: Block, pairs: np.ndarray) -> np.ndarray:
    """Integer inner products where ``pairs`` says so; what the others hold means nothing."""
    out = np.zeros(pairs.shape, np.int64)
    rows, columns = np.flatnonzero(pairs.any(axis=1)), np.flatnonzero(pairs.any(axis=0))
    if not len(rows):
        return out
    x, y = a.vectors[rows], b.vectors[columns]
    if a.norms.max() * b.norms.max() >= EXACT:
        x, y = x.astype(np.int64), y.astype(np.int64)
    if np.count_nonzero(pairs) * 16 < len(rows) * len(columns):  # few: pair by pair
        i, j = np.nonzero(pairs[np.ix_(rows, columns)])
        out[rows[i], columns[j]] = np.einsum("ij,ij->i", x[i], y[j])
    else:
        out[np.ix_(rows, columns)] = x @ y.T
    return out


def first_of(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Places of the first k: highest score, then smallest id."""
    if len(scores) > 4 * k:
        near = np.flatnonzero(scores >= np.partition(scores, -k)[-k])
        return near[np.lexsort((ids[near], -scores[near]))[:k]]
    return np.lexsort((ids, -scores))[:k]


def positives_in_tile(anchors: Block, rows: Block, k: int) -> Iterator[tuple[int, int, int]]:
    """(anchor, row, score): each anchor's first k among other rows of its label in this tile."""
    wanted = same_label(anchors, rows) & (anchors.ids[:, None] != rows.ids)
    lower, upper = score_bounds(anchors, rows)
    lower[~wanted] = -np.inf
    if lower.shape[1] > k:
        bar = np.partition(lower, -k, axis=1)[:, -k]  # k rows score this much
        wanted &= upper >= bar[:, None]
    scores = scored(anchors, rows, wanted)
    for i in np.flatnonzero(wanted.any(axis=1)):
        at = np.flatnonzero(wanted[i])
        best = at[first_of(scores[i, at], rows.ids[at], k)]
        yield from zip([int(anchors.ids[i])] * len(best), rows.ids[best].tolist(), scores[i, best].tolist(), strict=True)


def negatives_in_tile(anchors: Block, rows: Block, k: int, share: int) -> Iterator[tuple[int, int, int, int, int]]:
    """(anchor, positive, positive's score, row, score): the first k of each window among rows of other labels.

    A window holds the scores s with share * positive <= 100 * s <= 100 * positive; it is empty below zero.
    """
    positive_ids = anchors.table["positive_ids"].to_pylist()
    positive_scores = [np.array(s, np.int64) for s in anchors.table["positive_scores"].to_pylist()]
    other = ~same_label(anchors, rows)
    lower, upper = score_bounds(anchors, rows)
    overlap = np.zeros(other.shape, bool)
    for i, positives in enumerate(positive_scores):
        for positive in np.unique(positives[positives >= 0]).tolist():
            overlap[i] |= (lower[i] <= positive) & (100.0 * upper[i] >= share * positive * (1 - 1e-12))
    overlap &= other
    scores = scored(anchors, rows, overlap)
    for i in np.flatnonzero(overlap.any(axis=1)):
        at = np.flatnonzero(overlap[i])
        s = scores[i, at]
        for positive_id, positive in zip(positive_ids[i], positive_scores[i].tolist(), strict=True):
            least = -(-share * positive // 100)  # rounded up
            inside = np.flatnonzero((s >= least) & (s <= positive))
            for j in inside[first_of(s[inside], rows.ids[at[inside]], k)] if len(inside) else ():
                yield int(anchors.ids[i]), positive_id, positive, int(rows.ids[at[j]]), int(s[j])


# ---------------------------------------------------------------- directions and stored angles


def reference_directions(rows: DataFrame, count: int = DIRECTIONS) -> dict[int, np.ndarray]:
    """By dimension: unit vectors far apart from each other, chosen one by one from a bounded sample of rows."""
    sample = rows.where(F.col("norm") > 0).orderBy(F.xxhash64("id"), "id").limit(DIRECTION_SAMPLE).select("vector").collect()
    by_size: dict[int, list[list[int]]] = {}
    for r in sample:
        by_size.setdefault(len(r["vector"]), []).append(r["vector"])
    chosen = {}
    for size, vectors in by_size.items():
        unit = np.array(vectors, np.float64)
        unit /= np.linalg.norm(unit, axis=1)[:, None]
        picked, nearest = [0], unit @ unit[0]
        while len(picked) < min(count, len(unit)):
            picked.append(int(np.argmin(nearest)))
            nearest = np.maximum(nearest, unit @ unit[picked[-1]])
        chosen[size] = unit[picked]
    return chosen


def with_angles(rows: DataFrame, directions: dict[int, np.ndarray]) -> DataFrame:
    """``rows`` with ``size``, ``angles`` to the directions of their dimension, and ``near``, the nearest direction.

    A dimension that no direction was chosen for, and a zero vector, whose bounds are zero whatever its angle, get none
    that say anything: the angle is a right one throughout.
    """
    width = max((len(d) for d in directions.values()), default=1)

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("vector")
            sizes = np.diff(lists.offsets.to_numpy()).astype(np.int32)
            flat, begins = lists.flatten().to_numpy().astype(np.float64), np.cumsum(sizes) - sizes
            norms = batch.column("norm").to_numpy()
            angles = np.full((len(sizes), width), np.pi / 2, np.float32)
            for size, units in directions.items():
                at = np.flatnonzero((sizes == size) & (norms > 0))
                if len(at):
                    x = flat[begins[at][:, None] + np.arange(size)]
                    angles[at[:, None], np.arange(len(units))] = np.arccos(np.clip(x @ units.T / norms[at][:, None], -1, 1))
            offsets = pa.array(np.arange(len(sizes) + 1, dtype=np.int32) * width)
            added = [pa.array(sizes), pa.ListArray.from_arrays(offsets, pa.array(angles.ravel())), pa.array(angles.argmin(axis=1).astype(np.int32) if len(sizes) else [], pa.int32())]
            yield pa.RecordBatch.from_arrays([*batch.columns, *added], [*batch.schema.names, "size", "angles", "near"])

    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema.fields)
    return rows.mapInArrow(measure, f"{fields}, size int, angles array<float>, near int")


# ---------------------------------------------------------------- the operator


def _blocks(count: Column, size: int) -> Column:
    return F.greatest(F.lit(1), F.ceil(count / size)).cast("int")


def _block(count: Column, size: int) -> Column:
    """A row's block: a hash of its id (each id is there once), so a task that runs again deals alike."""
    return F.pmod(F.xxhash64("id"), _blocks(count, size)).cast("int")


def _columns(*more: str) -> list[Column]:
    """What a tile reads, under names of its own: both sides come from one table."""
    return [F.col(c).alias(c) for c in ("id", "label", "vector", "norm", "size", "angles", *more)]


def _positives(rows: DataFrame, anchors: DataFrame, k: int) -> DataFrame:
    """id of the anchor, positive_ids and positive_scores: its first k other rows of the same label, first one first."""
    counts = rows.groupBy("label").agg(F.count("*").alias("n_rows"), F.count_if("anchor").alias("n_anchors"))
    mine = anchors.join(counts, "label").withColumn("ab", _block(F.col("n_anchors"), ANCHOR_BLOCK))
    mine = mine.withColumn("rb", F.explode(F.sequence(F.lit(0), _blocks(F.col("n_rows"), ROW_BLOCK) - 1)))
    theirs = rows.join(counts.where("n_anchors > 0"), "label").withColumn("rb", _block(F.col("n_rows"), ROW_BLOCK))
    theirs = theirs.withColumn("ab", F.explode(F.sequence(F.lit(0), _blocks(F.col("n_anchors"), ANCHOR_BLOCK) - 1)))

    def tile(a: pa.Table, b: pa.Table) -> pa.Table:
        left, right = blocks_of(a), blocks_of(b)
        found = [p for d in left if d in right for p in positives_in_tile(left[d], right[d], k)]
        return _table(found, ("id", "positive_id", "positive_score"))

    left, right = (side.select(F.col("label").alias("on_label"), "ab", "rb", *_columns()).groupBy("on_label", "ab", "rb") for side in (mine, theirs))
    near = left.cogroup(right).applyInArrow(tile, "id long, positive_id long, positive_score long")
    order = Window.partitionBy("id").orderBy(F.desc("positive_score"), "positive_id")
    first = near.withColumn("place", F.row_number().over(order)).where(F.col("place") <= k)
    listed = F.array_sort(F.collect_list(F.struct("place", "positive_id", "positive_score")))  # k at most
    return first.groupBy("id").agg(listed.alias("listed")).select(
        "id", F.col("listed.positive_id").alias("positive_ids"), F.col("listed.positive_score").alias("positive_scores")
    )


def _table(found: list[tuple], names: tuple[str, ...]) -> pa.Table:
    columns = zip(*found, strict=True) if found else [()] * len(names)
    return pa.table({n: pa.array(c, pa.int64()) for n, c in zip(names, columns, strict=True)})


def _extent(df: DataFrame, width: int, *more: Column) -> dict[int, dict]:
    """Per nearest direction: number of rows, least and greatest angle to each direction, greatest norm."""
    each = [f(F.get("angles", F.lit(i))).alias(f"{name}{i}") for i in range(width) for name, f in (("least", F.min), ("most", F.max))]
    found = df.groupBy("near").agg(F.count("*").alias("n"), F.max("norm").alias("norm"), *each, *more).collect()  # a row a direction
    return {r["near"]: r.asDict() for r in found}


def reachable(anchors: dict, rows: dict, width: int, share: int) -> bool:
    """Whether any row of one group can come into the window of any anchor of another, by the groups' extents."""
    least = 0.0
    for i in range(width):
        least = max(least, anchors[f"least{i}"] - rows[f"most{i}"], rows[f"least{i}"] - anchors[f"most{i}"])
    upper = np.cos(max(0.0, least - MARGIN)) + MARGIN
    return upper >= 0 and 100 * upper * anchors["norm"] * rows["norm"] * (1 + 1e-9) >= share * max(0, anchors["least_positive"])


def hard_negatives(
    vectors: DataFrame,
    is_anchor: Column,
    label: Column | str = "label",
    positives: int = 5,
    negatives: int = 5,
    share: int = 80,
    scale: float = 256.0,
    directions: int = DIRECTIONS,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
) -> DataFrame:
    """anchor_id, positive_id, rank (from 1), negative_id, positive_score, negative_score.

    A score is the integer inner product of two rows' components ``floor(scale * x)``; higher scores come first, ties by
    smaller id. An anchor's positives are its first ``positives`` other rows of its label; a positive's negatives the
    first ``negatives`` rows of other labels with share * positive_score <= 100 * negative_score <= 100 *
    positive_score. All are returned where there are fewer, none below a negative score. Rows with a null id, label or
    vector, or with a null or non-finite component, take no part, nor do vectors whose integer norm reaches 2^31, as
    their scores might not fit a long. Vectors are compared with those of their own dimension. Rows that repeat an id
    count as one (least label, then vector). Zero vectors take part and score 0. An empty table, one without anchors or
    with one label only gives an empty one; further columns are left behind.

    Anchors meet all rows of other labels in blocks unless the bounds of a group spare it, so the cost is in proportion
    to anchors times rows; memory is that of a tile. ``directions`` (at most ``DIRECTION_SAMPLE``) steer the cost alone.
    """
    named = vectors.withColumns({"label__": F.col(label) if isinstance(label, str) else label, "anchor__": F.coalesce(is_anchor, F.lit(False))})
    whole = named.select(
        F.col(id_column).cast("long").alias("id"), F.col("label__").alias("label"), F.col("anchor__").alias("anchor"),
        whole_components(F.col(vector_column), scale).alias("whole"),
    )
    norm = F.sqrt(F.aggregate("whole", F.lit(0.0), lambda s, x: s + x * x))
    usable = whole.where("id IS NOT NULL AND label IS NOT NULL AND whole IS NOT NULL").withColumn("norm", norm).where(F.col("norm") < MOST_NORM)
    as_int = usable.withColumn("vector", F.transform("whole", lambda x: x.cast("int")))
    once = as_int.groupBy("id").agg(F.min(F.struct("label", "vector", "norm", "anchor")).alias("r")).select("id", "r.*")
    chosen = reference_directions(as_int, min(directions, DIRECTION_SAMPLE))
    width = max((len(d) for d in chosen.values()), default=1)
    rows = written(with_angles(once, chosen), "angles")

    found = written(_positives(rows, rows.where("anchor"), positives), "positives")
    anchors = rows.where("anchor").join(found, "id").where(F.exists("positive_scores", lambda s: s >= 0))
    least = F.min(F.array_min(F.filter("positive_scores", lambda s: s >= 0))).alias("least_positive")
    mine, theirs = _extent(anchors, width, least), _extent(rows, width)
    near = {a: [r for r in theirs if reachable(mine[a], theirs[r], width, share)] for a in mine}

    def dealt(df: DataFrame, own: str, own_extent: dict, size: int, other: str, meets: dict[int, list[int]], other_extent: dict, other_size: int) -> DataFrame:
        """Rows with their own block and every block of the other side that they meet; groups are few, blocks counted."""
        def number(extent: dict, of: Column) -> Column:
            return functools.reduce(lambda c, kv: c.when(of == kv[0], F.lit(kv[1]["n"])), extent.items(), F.when(F.lit(False), F.lit(0)))

        partners = functools.reduce(lambda c, kv: c.when(F.col("near") == kv[0], F.array(*map(F.lit, kv[1])).cast("array<int>")), meets.items(), F.when(F.lit(False), F.array().cast("array<int>")))
        groups = df.withColumns({f"{own}g": F.col("near"), f"{own}b": _block(number(own_extent, F.col("near")), size)})
        met = groups.withColumn(f"{other}g", F.explode(partners))
        return met.withColumn(f"{other}b", F.explode(F.sequence(F.lit(0), _blocks(number(other_extent, F.col(f"{other}g")), other_size) - 1)))

    back = {r: [a for a in near if r in near[a]] for r in theirs}
    left = dealt(anchors, "a", mine, ANCHOR_BLOCK, "r", near, theirs, ROW_BLOCK)
    right = dealt(rows, "r", theirs, ROW_BLOCK, "a", back, mine, ANCHOR_BLOCK)

    def tile(a: pa.Table, b: pa.Table) -> pa.Table:
        asking, asked = blocks_of(a), blocks_of(b)
        pairs = [p for d in asking if d in asked for p in negatives_in_tile(asking[d], asked[d], negatives, share)]
        return _table(pairs, ("anchor_id", "positive_id", "positive_score", "negative_id", "negative_score"))

    keys = ("ag", "ab", "rg", "rb")
    ours = left.select(*keys, *_columns("positive_ids", "positive_scores")).groupBy(*keys)
    tiles = ours.cogroup(right.select(*keys, *_columns()).groupBy(*keys))
    pairs = tiles.applyInArrow(tile, "anchor_id long, positive_id long, positive_score long, negative_id long, negative_score long")
    order = Window.partitionBy("anchor_id", "positive_id").orderBy(F.desc("negative_score"), "negative_id")
    ranked = pairs.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= negatives)
    return ranked.select("anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), "negative_id", "positive_score", "negative_score")
