"""Shingle join, vector join and mixing against plain versions."""

import random
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from tally.llm.components import components
from tally.llm.mixing import mix_sources, mixed_rows
from tally.llm.shingle_join import _shared, _without, keep_one, shingle_components
from tally.llm.vector_join import nearest, nearest_in_tile
from tally.sources.scratch import Scratch
from tests.conftest import plan_of
from tests.llm.awkward import collected, documents, prose, texts


def shingle_set(text):
    words = (text or "").encode().lower().split()
    if not words:
        return frozenset()
    return frozenset(tuple(words[i : i + 5]) for i in range(len(words) - 4)) if len(words) >= 5 else frozenset([tuple(words)])


def classes(rows):
    sets = {i: shingle_set(t) for i, t in rows}
    at = {i: i for i in sets}

    def top(x):
        while at[x] != x:
            x = at[x]
        return x

    for i, a in sets.items():
        for j, b in sets.items():
            if i < j and a and b and 100 * len(a & b) >= 80 * len(a | b):
                x, y = top(i), top(j)
                at[max(x, y)] = min(x, y)
    return {i: (len(s), top(i)) for i, s in sets.items()}


def edited(text, rng, share):
    words = text.split()
    for k in rng.sample(range(len(words)), int(share * len(words))):
        words[k] = f"new{rng.randint(0, 10**6)}"
    return " ".join(words)


def near_copies():
    """Groups of near copies, chains of them, a passage that many texts share, and texts just above and below 80 %."""
    rng = random.Random(11)
    rows, passage = [], prose(77, 60)
    for g in range(6):
        base = prose(500 + g, 100)
        rows += [edited(base, rng, share) for share in (0, 0, 0.01, 0.02, 0.03, 0.04, 0.05, 0.1)]
    chain = prose(900, 120).split()
    for k in range(12):
        rows.append(" ".join(chain[4 * k :] + [f"tail{k}x{j}" for j in range(4 * k)]))
    rows += [prose(1000 + k, 20 + k) + " " + passage for k in range(40)]
    rows += [passage + " " + prose(1100 + k, 8) for k in range(10)]
    long = prose(1200, 204).split()
    rows += [" ".join(long), " ".join(long[:-20]), " ".join(long[:-40]), " ".join(long[:-41]), " ".join(long[:-42])]
    rng.shuffle(rows)
    return [(i * 3 + 200, t) for i, t in enumerate(rows)]


@pytest.mark.parametrize("orders", [1, 3])
def test_shingle_join_finds_every_class(spark, orders):
    rows = [r for r in texts() if r[0] is not None] + near_copies()
    got = collected(shingle_components(documents(spark, rows), orders=orders))
    expected = classes(rows)
    assert len(got) == len(rows)
    assert all((r["n_shingles"], r["component_id"]) == expected[r["doc_id"]] for r in got)


def test_shingle_join_of_odd_tables(spark):
    assert shingle_components(documents(spark, [])).count() == 0
    got = collected(shingle_components(documents(spark, [(5, None), (5, None), (None, "a b"), (4, "")])))
    assert Counter((r["doc_id"], r["n_shingles"], r["component_id"]) for r in got if r["doc_id"] is not None) == Counter({(5, 0, 5): 2, (4, 0, 4): 1})


def test_one_of_each_class_stays(spark):
    rows = [*texts(), *near_copies()]
    docs = documents(spark, rows)
    kept = keep_one(docs)
    assert kept.columns == docs.columns
    expected = classes([r for r in rows if r[0] is not None])
    assert Counter(r["doc_id"] for r in collected(kept)) == Counter([*(i for i, (_, c) in expected.items() if i == c), None])


def test_no_text_is_shuffled_to_keep_one_of_each_class(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert "Exchange" not in keep_one(documents(spark, near_copies()))._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


@pytest.mark.parametrize("every", [8, 2])
def test_ids_left_out_by_bit_tables(spark, every):
    """Both with tables that are filled enough to hold many wrong ids, and with more ids than they may hold."""
    ids = [None, None, 0, 0, *range(-500, 40_000, 7), 14, 14]
    docs = spark.createDataFrame([(i, "x") for i in ids], "doc_id long, text string")
    gone = [i for i in ids if i is not None and i % every == 0]
    got = _without(docs, "doc_id", spark.createDataFrame([(i,) for i in gone], "id long"), bits=1 << (15 if every == 8 else 13))
    assert got.columns == docs.columns
    assert Counter(r["doc_id"] for r in got.collect()) == Counter(i for i in ids if i not in set(gone))


def test_texts_under_many_shingles_are_posted_under_their_first(spark):
    groups = {10: "ab", 11: "ab", 12: "abc", 13: "bc", 14: "bc", 15: "d", 16: "dd", 17: "ab"}
    rows = [(s, ord(x), 9, s - 10, 1000 + ord(x)) for s, members in groups.items() for x in members]
    rows += [(18, ord(x), 8, 1, 1000 + ord(x)) for x in "ab"]  # texts of the same ids, but others
    got = _shared(spark.createDataFrame(rows, "shingle long, id long, n long, at long, lead long"))
    assert got.columns == ["shingle", "id", "n", "at", "lead", "first"]
    assert Counter(r["shingle"] for r in got.collect()) == {10: 2, 12: 3, 13: 2, 16: 2, 18: 2}
    assert all(r["first"] == 1000 + ord(min(groups.get(r["shingle"], "ab"))) for r in got.collect())


def test_tables_of_ids_have_few_files_in_a_session_of_many_partitions(spark, tmp_path):
    class Counted(Scratch):
        files: list[tuple[str, int]] = []

        def written(self, df, name):
            table = super().written(df, name)
            self.files.append((name, len(table.inputFiles())))
            return table

    settings = {"spark.sql.shuffle.partitions": "64", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k) for k in settings}
    rows = near_copies()
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        with Counted(spark, str(tmp_path)) as scratch:
            found = shingle_components(documents(spark, rows), scratch=scratch)
            assert found.rdd.getNumPartitions() <= 16 + 8
            assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in found.collect()} == classes(rows)
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    most = max(n for name, n in scratch.files if not name.endswith("counted-shingles"))
    assert 1 < most <= 2 * spark.sparkContext.defaultParallelism


def test_links_that_are_stars_take_no_round(spark):
    names = []

    class Counted(Scratch):
        def written(self, df, name):
            names.append(name.split("/")[-1])
            return super().written(df, name)

    edges = [(1, 10 + i) for i in range(9)] + [(50 + i, 2) for i in range(9)] + [(4, 4), (2, 50)]
    with Counted(spark) as scratch:
        got = {r["node"]: r["component"] for r in components(spark.createDataFrame(edges, "a long, b long"), scratch=scratch).collect()}
    assert got == {1: 1, 2: 2} | {10 + i: 1 for i in range(9)} | {50 + i: 2 for i in range(9)}
    assert names == ["links", "least"]


def test_components(spark):
    rng = random.Random(2)
    edges = [(i, i + 1) for i in range(0, 60)] + [(100, 100 + i) for i in range(1, 40)] + [(rng.randint(200, 260), rng.randint(200, 260)) for _ in range(40)]
    at = {x: x for e in edges for x in e}
    for _ in at:
        for a, b in edges:
            at[a] = at[b] = min(at[a], at[b])
    got = {r["node"]: r["component"] for r in collected(components(spark.createDataFrame(edges, "a long, b long")))}
    assert got == {i: c for i, c in at.items() if any(i in e and e[0] != e[1] for e in edges)}


def test_nearest_vectors_equal_brute_force(spark):
    rng = np.random.default_rng(4)
    x = rng.normal(size=(600, 12)).astype(np.float32)
    x[100:160] = x[7]  # a group of copies: ties
    x[300] *= 1e4
    rows = [(i, v.tolist()) for i, v in enumerate(x)] + [(1000, None), (1020, [0.0] * 12), (1040, [1.0] * 11 + [float("nan")]), (None, [1.0] * 12)]
    rows += [(1060, [1.0, 2.0]), (1080, [3.0, 1.0]), (1081, [None] + [1.0] * 11), (1100, []), (1101, [float("inf")] + [1.0] * 11)]
    df = spark.createDataFrame([(i, v, "x", "y") for i, v in rows], "vec_id long, embedding array<float>, id string, vector string")
    got = defaultdict(dict)
    for r in collected(nearest(df, F.col("vec_id") % 20 == 0, query_block=16, candidate_block=100)):
        got[r["query_id"]][r["rank"]] = (r["vec_id"], r["score"])
    usable = [(i, np.array(v, np.float64)) for i, v in rows if i is not None and v and None not in v and np.isfinite(v).all() and np.any(v)]
    for q, a in usable:
        if q % 20 == 0:
            scored = sorted((-float(np.cumsum(a * b)[-1]), i) for i, b in usable if i != q and len(b) == len(a))[:20]
            assert got.pop(q) == {k + 1: (i, -s) for k, (s, i) in enumerate(scored)}
    assert not got
    assert nearest(df.limit(0), F.col("vec_id") % 20 == 0).count() == 0


def test_bounds_keep_every_near_vector():
    rng = np.random.default_rng(5)
    for scale in (1e-30, 1.0, 1e20):
        c = rng.standard_t(2, size=(400, 33)) * scale
        found = nearest_in_tile(np.arange(20), c[:20], np.arange(400), c, 15)
        for i in range(20):
            s = np.cumsum(c[i] * c, axis=1)[:, -1]
            best = sorted((k for k in range(400) if k != i), key=lambda k: (-s[k], k))[:15]
            assert next(ids for a, ids, _ in found if a == i) == best


def targets(sizes, weights=(5, 2, 1)):
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [None] * (None in sizes)
    w = {s: weights[i % 3] for i, s in enumerate(names)}
    full = set()
    while True:
        level = (1.5 * sum(sizes.values()) - sum(2 * sizes[s] for s in full)) / max(sum(w[s] for s in names if s not in full), 1)
        over = {s for s in names if s not in full and level * w[s] > 2 * sizes[s]}
        if not over:
            return {s: 2.0 * sizes[s] if s in full else level * w[s] for s in names}
        full |= over


def test_mixing(spark):
    rows = [*((i, t) for i, t in texts()), *((3000 + i, prose(i, 5 + i % 40)) for i in range(400))]
    docs = documents(spark, rows)
    got = collected(mix_sources(docs))
    assert len(got) == len(rows)
    sources = [r["source"] for r in collected(docs)]
    sizes = Counter()
    for (_, t), s in zip(rows, sources, strict=True):
        sizes[s] += len((t or "").encode().split())
    expected = targets(sizes)
    by_source = {sizes[s]: s for s in sizes}
    assert len(by_source) == len(sizes)
    taken, largest = Counter(), Counter()
    for r in got:
        s = by_source[r["source_size"]]
        assert np.isclose(r["target"], expected[s])
        assert 0 <= r["taken"] <= 2 * r["size"] and (r["size"] == 0 or r["taken"] % r["size"] == 0)
        assert r["taken"] >= int(expected[s] // sizes[s]) * r["size"]
        taken[s] += r["taken"]
        largest[s] = max(largest[s], r["size"])
    assert all(abs(taken[s] - expected[s]) <= largest[s] / 2 + 1 for s in sizes)
    key = lambda r: repr(sorted(r.items(), key=str))
    assert sorted(map(key, got)) == sorted(map(key, collected(mix_sources(docs.repartition(7)))))
    mixed = mixed_rows(docs)
    assert mixed.columns == docs.columns
    assert Counter(r["doc_id"] for r in collected(mixed) if (r["text"] or "").split()) == Counter(
        {i: n for i, n in _times(got).items()}
    )


def _times(rows):
    out = Counter()
    for r in rows:
        if r["size"]:
            out[r["doc_id"]] += r["taken"] // r["size"]
    return +out


def test_better_documents_are_taken_more_often(spark):
    rows = [(i, prose(i, 20)) for i in range(4000)]
    docs = documents(spark, rows).withColumn("source", F.when(F.col("doc_id") % 2 == 0, "a").otherwise("b"))
    weight = F.when(F.col("doc_id") % 4 < 2, 1.0).otherwise(0.1)
    got = collected(mix_sources(docs, weights=(1, 1.6), quality=weight))
    extra = Counter(r["doc_id"] % 4 < 2 for r in got if r["doc_id"] % 2 == 0 and r["taken"] > r["size"] * int(r["target"] // r["source_size"]))
    assert extra[True] > 3 * extra[False]


def test_mixing_is_native_and_takes_an_empty_table(spark):
    out = mix_sources(documents(spark))
    assert "Python" not in plan_of(out) and "InArrow" not in plan_of(out)
    assert mix_sources(documents(spark, [])).count() == 0
    assert mixed_rows(documents(spark, [])).count() == 0
