"""Arrow batches reach a task a few MB at a time."""

import pyarrow as pa
from pyspark.sql import functions as F

from tally.llm.batches import ARROW_BYTES, balanced, byte_slices


def sizes(batches):
    for b in batches:
        yield pa.RecordBatch.from_arrays([pa.array([b.nbytes])], ["n"])


def test_batches_are_bounded_in_a_session_that_sets_no_limit(spark):
    set_before = spark.conf.get(ARROW_BYTES, None)
    texts = spark.range(0, 8000, 1, 1).select(F.repeat(F.lit("abcdefghij"), 500).alias("text"))  # 40 MB
    try:
        spark.conf.unset(ARROW_BYTES)
        found = [r[0] for r in balanced(texts).mapInArrow(sizes, "n long").collect()]
        assert max(found) < 12 << 20 and sum(found) > 40_000_000
        spark.conf.set(ARROW_BYTES, f"{2 << 20}b")
        balanced(texts)
        assert spark.conf.get(ARROW_BYTES) == f"{2 << 20}b"
    finally:
        spark.conf.unset(ARROW_BYTES) if set_before is None else spark.conf.set(ARROW_BYTES, set_before)


def test_slices_cover_all_rows_and_freed_memory_is_given_back_behind_the_last(monkeypatch):
    given_back = []

    class Pool:
        def release_unused(self):
            given_back.append(len(seen))

    monkeypatch.setattr(pa, "default_memory_pool", Pool)
    texts, seen = ["ab", None, "c" * 50, "", "dé"] * 4, []
    batches = [pa.RecordBatch.from_arrays([pa.array(t, pa.string())], ["text"]) for t in (texts[:7], [], texts[7:])]
    for part in byte_slices(iter(batches), limit=20):
        seen += part.column("text").to_pylist()
    assert seen == texts
    assert given_back == [len(texts)]
