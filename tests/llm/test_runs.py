"""Suffix trees and periodic runs against plain versions."""

import hashlib
import random
import re
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from tally.llm.periodic_runs import collapsed, periodic_runs, run_digests, runs_of, text_runs
from tally.llm.queries import with_planted_runs
from tally.llm.suffix_tree import SuffixTree
from tests.llm.awkward import collected, documents, texts


def plain_runs(words, least_words=6, least_powers=4):
    """By each period from the smallest on: maximal stretches that equal themselves moved by it."""
    found, seen = [], set()
    for q in range(1, len(words) // least_powers + 1):
        same = [words[k] == words[k + q] for k in range(len(words) - q)] + [False]
        start = None
        for k, equal in enumerate(same):
            if equal and start is None:
                start = k
            elif not equal and start is not None:
                if k - start >= q and (start, k + q) not in seen:
                    seen.add((start, k + q))
                    if k + q - start >= max(least_words, least_powers * q):
                        found.append((start, k + q - start, q))
                start = None
    return sorted(found, key=lambda r: (r[0], r[2]))


def words_of(text):
    return [w for w in re.split("[\x20\x09-\x0d]+", text or "") if w]


def plain_collapsed(text, runs):
    dropped = {i for start, length, period in runs for i in range(start + period, start + length)}
    return " ".join(w for i, w in enumerate(words_of(text)) if i not in dropped)


def sequences(count, seed):
    """Words over few letters, most with a periodic tail and some changes in it."""
    rng = random.Random(seed)
    for _ in range(count):
        n, letters = rng.randint(0, 60), rng.choice([1, 2, 2, 3, 5])
        words = [rng.randrange(letters) for _ in range(n)]
        if n > 5 and rng.random() < 0.6:
            a = rng.randrange(n)
            p = 1 + rng.randrange(max(1, (n - a) // 3))
            words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
            for _ in range(rng.randint(0, 2)):
                words[rng.randrange(n)] = rng.randrange(letters + 1)
        yield words


def as_tuples(found):
    return [tuple(map(int, r)) for r in found]


def test_suffix_tree_ranks_and_extensions():
    for words in sequences(200, 3):
        tree = SuffixTree(words)
        suffixes = [[*words[i:], -1] for i in range(len(words) + 1)]
        assert [i for _, i in sorted(zip(tree.rank, range(len(suffixes)), strict=True))] == sorted(range(len(suffixes)), key=lambda i: suffixes[i])
        i, j = (np.array(x, np.int64) for x in zip(*[(i, j) for i in range(len(suffixes)) for j in range(len(suffixes)) if i != j], strict=True)) if words else (np.array([], np.int64),) * 2
        common = [next(k for k, (x, y) in enumerate(zip(suffixes[a], suffixes[b], strict=False)) if x != y) for a, b in zip(i, j, strict=True)]
        assert tree.common(i, j).tolist() == common


@pytest.mark.parametrize(("least_words", "least_powers"), [(6, 4), (2, 2), (3, 3), (8, 5)])
def test_runs_equal_the_plain_version(least_words, least_powers):
    for words in sequences(500, least_words):
        expected = plain_runs(words, least_words, least_powers)
        assert as_tuples(runs_of(words, least_words, least_powers)) == expected
        assert as_tuples(text_runs([" ".join(f"w{w}" for w in words)], least_words, least_powers)[0]) == expected


def test_many_texts_at_once():
    rows = [" \n".join(f"w{w}" for w in words) for words in sequences(300, 9)]
    assert [as_tuples(r) for r in text_runs(rows)] == [plain_runs(words_of(t)) for t in rows]
    assert text_runs([]) == []


def test_collapsed_text():
    text = "a b a b a b a b c c c c c c d"
    (runs,) = text_runs([text])
    assert as_tuples(runs) == [(0, 8, 2), (8, 6, 1)]
    assert collapsed(text, runs) == plain_collapsed(text, as_tuples(runs)) == "a b c d"


def test_awkward_documents(spark):
    rows = [*texts(), (200, "\t".join(["x y z"] * 9)), (201, "same " * 5), (202, "\x1c ".join(["q"] * 30)), (203, ("a b c d " * 4 + "e ") * 5)]
    got = collected(periodic_runs(documents(spark, rows)))
    expected = []
    for i, text in rows:
        runs = plain_runs(words_of(text))
        expected.append((i, runs, plain_collapsed(text, runs)))
    assert sorted(((r["doc_id"], [(x["start"], x["length"], x["period"]) for x in r["runs"]], r["collapsed"]) for r in got), key=repr) == sorted(expected, key=repr)
    assert periodic_runs(documents(spark, [])).count() == 0
    with pytest.raises(ValueError):
        periodic_runs(documents(spark, []), least_powers=1)


def test_digests(spark):
    rows = [(1, "a b " * 5 + "c " * 10 + "d e f " * 6), (2, "a b c d e f"), (3, None), (4, "a " * 6 + "b " * 6)]
    got = {r["doc_id"]: r for r in collected(run_digests(periodic_runs(documents(spark, rows))))}
    one = got[1]
    assert (one["n_runs"], one["start"], one["length"], one["period"], one["exponent_milli"]) == (3, 10, 10, 1, 10_000)
    assert one["runs_sha256"] == hashlib.sha256(b"0,10,2\n10,10,1\n20,18,3\n").hexdigest()
    assert one["collapsed_sha256"] == hashlib.sha256(b"a b c d e f").hexdigest()
    nothing = hashlib.sha256(b"").hexdigest()
    assert [got[2][c] for c in ("n_runs", "start", "length", "period", "exponent_milli", "runs_sha256")] == [0, None, None, None, None, nothing]
    assert (got[3]["n_runs"], got[3]["collapsed_sha256"]) == (0, nothing)
    assert (got[4]["start"], got[4]["n_runs"]) == (0, 2)  # ties: smallest start


def test_planted_runs_follow_the_rule(spark):
    import zlib

    rows = [(i, t) for i, t in texts() if i != 10] + [(1000 + i, " ".join(f"w{k}" for k in range(i))) for i in range(300)]
    got = collected(with_planted_runs(documents(spark, rows)))
    expected = []
    for i, text in rows:
        h = zlib.crc32(str(i).encode()) if i is not None else 1
        words, g = words_of(text), h // 10
        if h % 10 == 0 and words:
            a = g % len(words)
            p = 1 + (len(words) - a) // (3 + g % 8)
            text = " ".join(w if k < a else words[a + (k - a) % p] for k, w in enumerate(words))
        expected.append((i, text))
    assert sorted(((r["doc_id"], r["text"]) for r in got), key=repr) == sorted(expected, key=repr)
    assert len([1 for i, _ in rows if i is not None and zlib.crc32(str(i).encode()) % 10 == 0]) > 20


def test_whole_table_equals_the_plain_version(spark):
    docs = with_planted_runs(spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text"))
    kept = {r["doc_id"]: r["text"] for r in docs.collect()}
    for row in collected(run_digests(periodic_runs(docs))):
        runs = plain_runs(words_of(kept[row["doc_id"]])) if len(words_of(kept[row["doc_id"]])) < 1500 else None
        if runs is not None:
            lines = "".join(f"{s},{n},{p}\n" for s, n, p in runs)
            assert row["runs_sha256"] == hashlib.sha256(lines.encode()).hexdigest()
            assert row["collapsed_sha256"] == hashlib.sha256(plain_collapsed(kept[row["doc_id"]], runs).encode()).hexdigest()


@pytest.mark.parametrize("text", ["a " * 100_000, "a b c d e f g " * 15_000, " ".join(f"w{i % 997}" for i in range(100_000)), "b " + "a " * 50_000 + "b " + "a " * 50_000])
def test_long_texts_take_linear_time(text):
    began = time.perf_counter()
    assert len(text_runs([text])[0]) >= 1
    assert time.perf_counter() - began < 20


def test_hot_strongest_run_is_exact(spark):
    runs = [{"start": 5, "length": 3_000_000_001, "period": 3}, {"start": 1, "length": 1_000_000_000, "period": 1}, {"start": 9, "length": 2_000_000_000, "period": 2}]
    df = spark.createDataFrame([(1, runs, "")], "doc_id long, runs array<struct<start:bigint,length:bigint,period:bigint>>, collapsed string")
    assert run_digests(df).select(F.struct("start", "length", "period")).first()[0] == (5, 3_000_000_001, 3)
