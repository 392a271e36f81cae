"""The registered queries on the smallest tables, and the pipeline's stages one after another."""

import os

import pytest

import __spark_entry__ as driver
import corpus_pipeline
from tally.llm.queries import ORACLE_SQL, QUERIES
from tests.llm.awkward import documents, texts
from tests.llm.test_joins_and_mixing import classes
from tests.llm.test_text_scans import spans

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="the tables are not there")


def test_ten_operators_and_the_pipeline_are_registered():
    names = set(driver.queries())
    assert {f"op{n}_" for n in range(1, 11)} == {q[: q.index("_") + 1] for q in QUERIES}
    assert set(QUERIES) | {"pipeline"} <= names
    assert set(ORACLE_SQL) <= set(driver.oracle_sql())


@pytest.mark.parametrize("name", [q for q in QUERIES if q not in ORACLE_SQL])
def test_queries_return_a_row_per_document_at_least(spark, name):
    df = QUERIES[name](spark, SF)
    ids = {r["doc_id"] for r in df.select("doc_id").collect()}
    assert ids == {r["doc_id"] for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id").collect()}


@pytest.mark.parametrize("name", list(ORACLE_SQL))
def test_queries_equal_their_twins(spark, name):
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    for table in ("documents", "embeddings"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF}/{table}.parquet'")
    cursor = con.execute(ORACLE_SQL[name])
    columns = [c[0] for c in cursor.description]
    expected = sorted(cursor.fetchall())
    assert expected and sorted(tuple(r[c] for c in columns) for r in QUERIES[name](spark, SF).collect()) == expected


def test_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "near-duplicates", "secrets", "mix", "pack"]
    good = corpus_pipeline.keep_quality(spark, docs, SF).collect()
    ids = {r["doc_id"] for r in good}
    right = [(i in ids) == bool(q) for i, q in labels.items()]
    assert sum(right) >= 0.95 * len(right)
    kept = spark.createDataFrame(good, docs.schema)
    single = corpus_pipeline.drop_near_duplicates(spark, kept, SF)
    assert single.columns == docs.columns
    expected = classes([(r["doc_id"], r["text"]) for r in good])
    assert sorted(r["doc_id"] for r in single.collect()) == sorted(i for i, (_, c) in expected.items() if i == c)
    masked = corpus_pipeline.mask_secrets(spark, kept, SF)
    assert masked.schema.names == docs.columns
    for r in masked.collect():
        assert r["n_chars"] == len(r["text"]) and not [s for s in spans(r["text"]) if s[1] < 3]
    mixed = corpus_pipeline.mix(spark, kept, SF)
    assert mixed.columns == docs.columns and mixed.count() > 0
    packed = corpus_pipeline.pack(spark, kept, SF)
    assert packed.select("doc_id").distinct().count() == len(good)


def test_stages_take_awkward_and_empty_tables(spark):
    for docs in (documents(spark), documents(spark, [])):
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, docs, SF)
            assert out.count() >= 0
            if name != "pack":
                assert out.columns == docs.columns
    assert corpus_pipeline.mask_secrets(spark, documents(spark), SF).count() == len(texts())
