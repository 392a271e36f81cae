"""Every registered query against its SQL twin on the smallest tables."""

import os

import pytest

import __spark_entry__ as driver
from tally.plans.catalog import QUERIES

SF = "/root/testdata/sf0.001"
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()

duckdb = pytest.importorskip("duckdb")
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="the tables are not there")


@pytest.fixture(scope="module")
def twin():
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF}/{name}.parquet'")
    return con


def ordered(records, names):
    at = sorted(range(len(names)), key=names.__getitem__)
    return sorted((tuple(r[i] for i in at) for r in records), key=repr)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_equals_its_twin(spark, twin, name):
    df = driver.queries()[name](spark, SF)
    cursor = twin.execute(driver.oracle_sql()[name])
    names = [c[0] for c in cursor.description]
    assert sorted(df.columns) == sorted(names)
    expected = ordered(cursor.fetchall(), names)
    assert ordered([tuple(r) for r in df.collect()], df.columns) == expected
    assert expected


def test_every_query_has_a_twin():
    assert set(QUERIES) <= set(driver.queries()) & set(driver.oracle_sql())


# checks of a whole table are made on the driver, so these run their aggregate when they are built; workbooks are
# written once a session, and their reports are read in rounds that depend on what the round before found; jobs write
# their tables
AT_BUILD = {
    "dq_table_checks", "crypto_decrypt_all", "workbook_cells", "xtb_snapshot", "xtb_events", "xtb_report_notes",
    "xtb_latest_report_fallback", "xtb_reports_by_rank", "ingest_batches",
}


@pytest.mark.parametrize("name", [n for n in QUERIES if n not in AT_BUILD])
def test_building_a_query_starts_no_job(spark, name):
    spark.range(1).count()
    context, group = spark.sparkContext, f"build-{name}"
    reads = len([t for t in TABLES if t != "region"])
    context.setJobGroup(group, group)
    try:
        QUERIES[name].build(spark, SF)
        started = context.statusTracker().getJobIdsForGroup(group)
    finally:
        context.setJobGroup("tests", "tests")
    # a file's schema is read by a job of one task each
    tasks = [context.statusTracker().getJobInfo(j) for j in started]
    assert len(started) <= reads and all(len(i.stageIds) == 1 for i in tasks if i)


def test_entry(spark):
    assert driver.entry(spark).count() > 0
