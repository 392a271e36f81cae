"""The index of known content beside a raw table."""

import re

import pytest

from tally.plans.jobs import append_new
from tally.sources import keys
from tally.sources.keys import KeyIndex, content_key, picked
from tally.sources.lake import Lake

from .conftest import plan_of, rows
from .payloads import DAY1, raw, raw_row


@pytest.fixture
def lake(spark, tmp_path):
    return Lake(spark, str(tmp_path / "lake"))


def batch(spark, *bodies, broker="IBKR", source="flex"):
    return raw(spark, *[raw_row(broker, source, b, DAY1, "f") for b in bodies])


def stored(lake):
    return [r[0] for r in rows(lake.read("raw", "ibkr"), "payload")]


def indexed(lake):
    return KeyIndex(lake, "ibkr").keys().count()


def test_known_content_is_not_appended_again(spark, lake):
    append_new(lake, batch(spark, b"a", b"b", b"b"), "ibkr")
    assert stored(lake) == [b"a", b"b", b"b"] and indexed(lake) == 2  # copies inside a batch stay
    append_new(lake, batch(spark, b"b", b"c"), "ibkr")
    append_new(lake, batch(spark, b"a", source="flex_events"), "ibkr")  # another source is other content
    assert stored(lake) == [b"a", b"a", b"b", b"b", b"c"] and indexed(lake) == 4


def test_null_keys_are_values(spark, lake):
    nameless = batch(spark, b"a").selectExpr("* EXCEPT (source, payload_hash)", "CAST(NULL AS STRING) AS source", "CAST(NULL AS STRING) AS payload_hash")
    append_new(lake, nameless, "ibkr")
    append_new(lake, nameless, "ibkr")
    append_new(lake, batch(spark, b"a"), "ibkr")
    assert lake.read("raw", "ibkr").count() == 2


def test_nothing_new_writes_no_file(spark, lake):
    append_new(lake, batch(spark, b"a"), "ibkr")
    before = sorted(lake.read("raw", "ibkr").inputFiles())
    append_new(lake, batch(spark, b"a"), "ibkr")
    append_new(lake, batch(spark, b"z").filter("false"), "ibkr")
    assert sorted(lake.read("raw", "ibkr").inputFiles()) == before
    append_new(lake, batch(spark, b"z").filter("false"), "xtb")
    assert lake.read("raw", "xtb").count() == 0


def test_the_index_is_built_anew_from_the_table(spark, lake):
    append_new(lake, batch(spark, b"a"), "ibkr")
    lake.append(batch(spark, b"b"), "raw", "ibkr")  # past the index
    append_new(lake, batch(spark, b"a", b"b", b"c"), "ibkr")
    assert stored(lake) == [b"a", b"b", b"c"] and indexed(lake) == 3
    lake.overwrite(batch(spark, b"c"), "raw", "ibkr")
    append_new(lake, batch(spark, b"a", b"c"), "ibkr")
    assert stored(lake) == [b"a", b"c"] and indexed(lake) == 2


def test_a_run_that_stopped_between_rows_and_keys(spark, lake, monkeypatch):
    append_new(lake, batch(spark, b"a"), "ibkr")
    with monkeypatch.context() as broken:
        broken.setattr(KeyIndex, "add", lambda *_: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(RuntimeError):
            append_new(lake, batch(spark, b"b"), "ibkr")
    assert stored(lake) == [b"a", b"b"]  # the rows are there, their keys are not
    append_new(lake, batch(spark, b"a", b"b", b"c"), "ibkr")
    assert stored(lake) == [b"a", b"b", b"c"]


def test_the_history_is_not_exchanged(spark, lake):
    append_new(lake, batch(spark, *[b"%d" % n for n in range(50)]), "ibkr")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        unknown = KeyIndex(lake, "ibkr").unknown(batch(spark, b"1", b"x"))
        physical = plan_of(unknown).split("== Physical Plan ==")[1]
        assert unknown.count() == 1
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    ours, history = re.split(r"\n   \+- ", physical)  # the two sides of the join
    assert "SortMergeJoin" in ours and "Exchange" in ours
    assert "tally_keys" in history and "Bucketed: true" in history and "Exchange" not in history, physical


def test_an_index_keeps_its_number_of_buckets(spark, lake):
    append_new(lake, batch(spark, b"a"), "ibkr")
    KeyIndex(lake, "ibkr", buckets=8).keys()
    assert KeyIndex(lake, "ibkr", buckets=8).buckets == 64
    lake.forget_keys("ibkr")
    small = KeyIndex(lake, "ibkr", buckets=8)
    assert small.keys().count() == 1 and KeyIndex(lake, "ibkr").buckets == 8


@pytest.mark.parametrize("bits", [keys.BITS, 8])
def test_rows_are_picked_whether_or_not_the_bits_tell(spark, lake, monkeypatch, bits):
    monkeypatch.setattr(keys, "BITS", bits)
    append_new(lake, batch(spark, *[b"%d" % n for n in range(0, 40, 2)]), "ibkr")
    append_new(lake, batch(spark, *[b"%d" % n for n in range(40)], b"39"), "ibkr")
    assert sorted(stored(lake)) == sorted([b"%d" % n for n in range(40)] + [b"39"]) and indexed(lake) == 40


def test_payloads_are_not_shuffled_before_the_bits_have_told(spark, lake):
    rows_ = batch(spark, b"a", b"b").withColumn("key", content_key())
    told = spark.createDataFrame([(r.key, r.payload == b"a") for r in rows_.collect()], "key binary, fresh boolean")
    made = picked(rows_, told)
    assert rows(made, "payload") == [(b"a",)]
    physical = made._jdf.queryExecution().sparkPlan().toString()
    assert "LeftSemi" not in physical and physical.count("BroadcastHashJoin") >= 2
