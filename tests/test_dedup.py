import random

from pyspark.sql import functions as F

from tally.operators import dedup as D

from .conftest import plan_of, rows

RAW = "fetched_at long, broker string, source string, payload_hash string, source_file string"


def test_latest_per_source_is_per_source(spark):
    data = [(1, "a", 1), (2, "a", 2), (2, "a", 3), (1, "b", 4), (5, None, 5), (6, None, 6)]
    df = spark.createDataFrame(data, "fetched_at long, source string, id long")
    assert rows(D.latest_per_source(df), "id") == [(2,), (3,), (4,), (6,)]


def test_latest_per_source_gathers_no_source(spark):
    df = spark.range(1000).selectExpr("id AS fetched_at", "'s' AS source", "id")
    assert "Window" not in plan_of(D.latest_per_source(df))


def test_latest_per_source_without_broadcast(spark):
    threshold = "spark.sql.autoBroadcastJoinThreshold"
    spark.conf.set(threshold, "-1")
    try:
        _latest_per_source_equals_brute_force(spark)
    finally:
        spark.conf.unset(threshold)


def _latest_per_source_equals_brute_force(spark):
    df = spark.createDataFrame([(i % 7, f"s{i % 50}", i) for i in range(1000)], "fetched_at long, source string, id long")
    best = {}
    for r in df.collect():
        best[r.source] = max(best.get(r.source, 0), r.fetched_at)
    expected = sorted(r.id for r in df.collect() if r.fetched_at == best[r.source])
    assert sorted(r.id for r in D.latest_per_source(df).collect()) == expected


def test_newest_version_wins_against_brute_force(spark):
    rng = random.Random(3)
    data = [(rng.randrange(50), rng.choice(["t", "u", None]), f"e{rng.randrange(40)}", i) for i in range(2000)]
    # a third of all rows are copies of one event
    data += [(99 if i == 0 else rng.randrange(50), "t", "hot", 10_000 + i) for i in range(1000)]
    df = spark.createDataFrame(data, "fetched_at long, event_type string, event_id string, n long").repartition(8)
    got = rows(D.dedup_newest(df, ["event_type", "event_id"], tiebreak=[F.col("n").desc()]))
    best = {}
    for r in data:
        if r[1:3] not in best or (r[0], r[3]) > (best[r[1:3]][0], best[r[1:3]][3]):
            best[r[1:3]] = r
    assert got == sorted(best.values(), key=repr)


def test_copies_are_folded_before_the_shuffle(spark):
    df = spark.createDataFrame([(1, "e", 1)], "fetched_at long, event_id string, n long")
    text = plan_of(D.dedup_newest(df, ["event_id"]))
    physical = text[text.index("Physical Plan"):]
    assert physical.index("Final") < physical.index("Exchange hashpartitioning") < physical.index("Partial")


def test_duplicates_removed(spark):
    df = spark.createDataFrame([("a",), ("a",), ("b",), (None,), (None,)], "k string")
    assert rows(D.duplicates_removed(df, ["k"])) == [(5, 3, 2)]


def test_drop_known_is_null_safe_and_keeps_copies_in_the_batch(spark):
    existing = spark.createDataFrame([(1, "B", "s", "h1", "f"), (1, None, "s", "h2", "f")], RAW)
    incoming = spark.createDataFrame(
        [(2, "B", "s", "h1", "f"), (2, None, "s", "h2", "f"), (2, "B", "s", "h3", "x"), (2, "B", "s", "h3", "y"), (2, "B", "t", "h1", "f")],
        RAW,
    )
    assert rows(D.drop_known(incoming, existing), "source", "payload_hash", "source_file") == [
        ("s", "h3", "x"), ("s", "h3", "y"), ("t", "h1", "f"),
    ]


def test_drop_known_against_itself(spark):
    df = spark.createDataFrame([(1, "B", "s", f"h{i}", "f") for i in range(10)], RAW)
    kept = D.drop_known(df, df.filter("payload_hash > 'h4'"))
    assert kept.count() == 5


def test_merge_keeps_the_winners_file(spark):
    df = spark.createDataFrame([(1, "B", "s", "h", "old"), (2, "B", "s", "h", "new"), (1, "B", "s", "i", "only")], RAW)
    assert rows(D.merge_newest(df), "payload_hash", "source_file") == [("h", "new"), ("i", "only")]


def stored(spark, tmp_path, *parts):
    """RAW rows written as tables and read back with their addresses."""
    tables = []
    for n, part in enumerate(parts):
        spark.createDataFrame(part, RAW).coalesce(1).write.parquet(str(tmp_path / str(n)))
        tables.append(D.addressed(spark.read.parquet(str(tmp_path / str(n)))))
    merged = tables[0]
    for table in tables[1:]:
        merged = merged.unionByName(table)
    return merged


def test_merge_of_stored_rows(spark, tmp_path):
    first = [(1, "B", "s", "h", "old"), (2, "B", "s", "h", "new"), (1, "B", "s", "i", "b"), (1, "B", "s", "i", "a"), (None, "B", "s", "j", "undated")]
    second = [(2, "B", "s", "h", "new"), (1, "B", "s", "j", "dated"), (1, None, "s", "h", "n"), (1, None, "s", "h", "n"), (1, "B", None, None, None)]
    df = stored(spark, tmp_path, first, second)
    merged = D.merge_newest(df, ["source_file"], D.ADDRESS)
    assert merged.columns == [c.split()[0] for c in RAW.split(", ")]
    assert rows(merged, "broker", "payload_hash", "source_file") == sorted(
        [("B", "h", "new"), ("B", "i", "a"), ("B", "j", "dated"), (None, "h", "n"), ("B", None, None)], key=repr
    )


def test_merge_moves_payloads_without_sorting_them(spark, tmp_path):
    spark.createDataFrame([(1, "B", "s", b"body", "h", "f")], "fetched_at int, broker string, source string, payload binary, payload_hash string, source_file string").withColumn(
        "fetched_at", D.F.timestamp_seconds("fetched_at")
    ).write.parquet(str(tmp_path / "raw"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan_of(D.merge_newest(D.addressed(spark.read.parquet(str(tmp_path / "raw"))), ["source_file"], D.ADDRESS))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    physical = text[text.index("Physical Plan"):]
    assert "ShuffledHashJoin" in physical and "Window" not in physical
    above, reads_payloads, reads_keys = physical.split("FileScan parquet")
    assert "Sort" not in above and "payload:binary" in reads_payloads and "payload:binary" not in reads_keys


def test_orphans(spark):
    held = spark.createDataFrame([(1, "B", "s", "h", "f"), (1, "B", "s", "gone", "f")], RAW)
    merged = spark.createDataFrame([(1, "B", "s", "h", "f")], RAW)
    assert rows(D.orphans(held, merged)) == [("B", "s", "gone")]
