"""Hard-negative mining against a plain version."""

import math
import random
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tally.llm import hard_negatives as module
from tally.llm.hard_negatives import Block, angle_bounds, hard_negatives, score_bounds
from tests.llm.awkward import collected

FIELDS = "vec_id long, embedding array<double>, label int, id string, anchor string, norm string, near int, r string"


def plain(rows, is_anchor, positives=5, negatives=5):
    once = {}
    for i, v, label in rows:
        if i is None or v is None or label is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        whole = [math.floor(256 * x) for x in v]
        if sum(x * x for x in whole) < 2**62:
            once[i] = min(once.get(i, (label, whole)), (label, whole))
    out = []
    for a, (label, v) in once.items():
        if not is_anchor(a):
            continue
        scores = [(-sum(x * y for x, y in zip(v, w, strict=True)), i, other == label) for i, (other, w) in once.items() if i != a and len(w) == len(v)]
        for p, positive, _ in sorted(s for s in scores if s[2])[:positives]:
            window = sorted((s, i) for s, i, same in scores if not same and 80 * -p <= 100 * -s <= 100 * -p)
            out += [(a, positive, rank, i, -p, -s) for rank, (s, i) in enumerate(window[:negatives], 1)]
    return sorted(out)


def mined(spark, rows, **options):
    table = spark.createDataFrame([(*r, "i", "a", "n", 1, "r") for r in rows], FIELDS)
    got = collected(hard_negatives(table, F.col("vec_id") % 10 == 0, **options))
    return sorted((r["anchor_id"], r["positive_id"], r["rank"], r["negative_id"], r["positive_score"], r["negative_score"]) for r in got)


def clustered(n, d=8, seed=1, labels=4):
    rng = random.Random(seed)
    centres = [[rng.gauss(0, 1) for _ in range(d)] for _ in range(6)]
    rows = []
    for i in range(n):
        centre = rng.choice(centres)
        label = 0 if rng.random() < 0.4 else rng.randrange(labels)  # a hot one
        rows.append((i, [c + rng.gauss(0, 0.3) for c in centre], label))
    return rows


def awkward_rows():
    rows = clustered(80)
    nan, inf = float("nan"), float("inf")
    same = [0.5] * 8
    rows += [
        (100, None, 1), (101, [], 1), (110, [], 2), (102, same, None), (103, [nan] * 8, 1), (104, [inf] + same[1:], 1), (105, [None] + same[1:], 1),
        (None, same, 1), (120, [0.0] * 8, 1), (121, [0.0] * 8, 1), (122, [0.001] * 8, 2), (123, [0.0] * 8, 3),
        *((130 + k, same, k % 3) for k in range(25)),  # ties
        (130, same, 0), (131, rows[0][1], 1), (131, rows[1][1], 0),  # repeated ids
        (160, [1e30] * 8, 1), (161, [1e300] * 8, 1), (162, [1e5] * 8, 1), (163, [1e5] * 8, 2),
        (170, [0.3, 0.4], 1), (171, [0.3, 0.4], 1), (172, [0.3, 0.38], 2),  # another dimension
        (180, [-0.5] * 8, 9),  # a label of its own
        (190, [-x for x in same], 8), (191, same, 8),  # the only positive scores below zero
    ]
    return rows


def test_awkward_rows(spark):
    rows = awkward_rows()
    assert mined(spark, rows) == plain(rows, lambda i: i % 10 == 0)


@pytest.mark.parametrize("seed", [2, 3])
def test_many_blocks(spark, monkeypatch, seed):
    monkeypatch.setattr(module, "ANCHOR_BLOCK", 7)
    monkeypatch.setattr(module, "ROW_BLOCK", 40)
    rows = clustered(400, seed=seed)
    expected = plain(rows, lambda i: i % 10 == 0)
    assert mined(spark, rows) == expected and len(expected) > 300
    assert mined(spark, rows, directions=1) == expected  # the directions steer the cost alone


def test_empty_tables(spark):
    assert mined(spark, []) == []
    assert mined(spark, [(1, [1.0, 2.0], 1), (2, [1.0, 2.0], 2)]) == []  # no anchor
    assert mined(spark, [(10, [1.0, 2.0], 1), (2, [1.0, 2.0], 1)]) == []  # one label
    assert mined(spark, [(10, [1.0, 2.0], 1)]) == []


def test_other_counts_and_text_labels(spark):
    rows = clustered(120, seed=5)
    table = spark.createDataFrame([(i, v, f"label {k}") for i, v, k in rows], "vec_id long, embedding array<double>, label string")
    got = collected(hard_negatives(table, F.col("vec_id") % 10 == 0, positives=2, negatives=3))
    assert sorted(tuple(r[c] for c in ("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")) for r in got) == plain(rows, lambda i: i % 10 == 0, 2, 3)


def _block(vectors, units):
    x = np.array(vectors, np.float64)
    norms = np.linalg.norm(x, axis=1)
    angles = np.arccos(np.clip(x @ units.T / np.where(norms, norms, 1)[:, None], -1, 1)).astype(np.float32)
    angles[norms == 0] = np.pi / 2
    return Block(pa.table({"id": range(len(x)), "label": [0] * len(x), "vector": x.astype(np.int32).tolist(), "norm": norms, "angles": angles.tolist()}))


def test_bounds_hold():
    rng = np.random.default_rng(4)
    vectors = np.concatenate([rng.integers(-300, 300, (200, 6)), np.zeros((2, 6)), rng.integers(-3, 3, (50, 6)), rng.integers(-(2**28), 2**28, (50, 6))]).astype(np.int64)
    vectors = np.concatenate([vectors, -vectors[:20], 2 * vectors[:20]])  # opposite and parallel ones
    units = vectors[:5] / np.linalg.norm(vectors[:5], axis=1)[:, None]
    block = _block(vectors, units)
    lower, upper = score_bounds(block, block)
    true = vectors @ vectors.T
    assert (lower <= true).all() and (true <= upper).all()
    least, most = angle_bounds(block.angles, block.angles)
    assert (least <= most + 1e-5).all()
    assert (upper[:200, :200] < np.outer(block.norms, block.norms)[:200, :200] * 0.9).any()  # they do say something


def test_groups_out_of_reach_are_not_sent(spark):
    """Clusters far apart: the extents of directions spare most pairs of groups."""
    rows = {"least0": 0.0, "most0": 0.1, "norm": 10.0}
    near = {"least0": 0.05, "most0": 0.2, "norm": 10.0, "least_positive": 80}
    far = near | {"least0": 1.4, "most0": 1.5}
    assert module.reachable(near, rows, 1, 80) and not module.reachable(far, rows, 1, 80)


def test_hot_label_is_cut_by_counts(spark):
    rows = [(i, [1.0, i / 1000], 0) for i in range(300)] + [(300 + i, [1.0, i / 100], 1) for i in range(20)]
    sizes = defaultdict(int)
    table = spark.createDataFrame(rows, "id long, v array<double>, label int")
    for r in table.withColumn("b", module._block(F.lit(300), 40)).where("label = 0").groupBy("b").count().collect():
        sizes[r["b"]] = r["count"]
    assert len(sizes) == 8 and max(sizes.values()) < 80
