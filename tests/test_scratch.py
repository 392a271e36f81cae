"""Tables on the way: where they lie, and that they go."""

import os
import time

import pytest

from pyspark.sql import functions as F

from tally.sources.scratch import SHUFFLE_CLEANUP, Scratch, shared_folder


def test_tables_are_read_back_and_deleted(spark, tmp_path):
    scratch = Scratch(spark, str(tmp_path))
    first, second = (scratch.written(spark.range(n), f"t{n}") for n in (3, 5))
    assert (first.count(), second.count()) == (3, 5)
    folder = shared_folder(spark, str(tmp_path)).removeprefix("file://")
    there = lambda: sorted(n[:2] for n in os.listdir(folder) if n.startswith(("t3-", "t5-")))
    assert there() == ["t3", "t5"]
    scratch.drop(first)
    assert there() == ["t5"] and second.count() == 5
    scratch.clear()
    assert there() == []


def test_a_write_takes_its_shuffle_files_along(spark, tmp_path):
    status = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().mapOutputTracker()
    held = lambda: status.shuffleStatuses().size()
    with Scratch(spark, str(tmp_path)) as scratch:
        before = held()
        table = scratch.written(spark.range(1000).groupBy((F.col("id") % 100).alias("k")).count(), "counts")
        deadline = time.time() + 20
        while held() > before and time.time() < deadline:  # they are deleted beside the driver's work
            time.sleep(0.1)
        assert held() <= before
        assert table.count() == 100
    assert spark.conf.get(SHUFFLE_CLEANUP, None) is None


def test_a_cluster_without_a_shared_folder_is_an_error():
    class Context:
        master, applicationId = "spark://host:7077", "a"

        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext = Context()

        class conf:
            get = staticmethod(lambda *_: None)

    with pytest.raises(ValueError):
        shared_folder(Session())
    assert shared_folder(Session(), "/lake/_stash/") == "/lake/_stash"
