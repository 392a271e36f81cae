import pytest
from pyspark.sql import functions as F

from tally.operators import maintenance as M
from tally.schemas import RAW
from tally.sources import landing
from tally.sources.lake import Lake, export, parse_alias

from .conftest import rows
from .payloads import DAY1, DAY2, raw, raw_row


@pytest.fixture
def lake(spark, tmp_path):
    return Lake(spark, str(tmp_path / "lake"))


def test_parse_alias():
    assert parse_alias("portfolio_holdings_analytics") == ("portfolio_holdings", "analytics")
    assert parse_alias("ibkr_raw") == ("ibkr", "raw")
    assert parse_alias("something_else") is None


def test_absent_tables(lake):
    assert lake.find("raw", "ibkr") is None and not lake.exists("raw", "ibkr")
    with pytest.raises(FileNotFoundError):
        lake.read("raw", "ibkr")
    assert lake.read_or_empty("raw", "ibkr", RAW).schema == RAW


def test_create_append_overwrite(spark, lake):
    lake.create(RAW, "raw", "ibkr")
    assert lake.read("raw", "ibkr").count() == 0 and lake.read("raw", "ibkr").schema == RAW
    lake.append(raw(spark, raw_row("IBKR", "flex", "<a/>")), "raw", "ibkr")
    lake.create(RAW, "raw", "ibkr")
    assert lake.read("raw", "ibkr").count() == 1
    lake.overwrite(lake.read("raw", "ibkr").drop("source_file"), "raw", "ibkr")
    assert lake.read("raw", "ibkr").columns == RAW.fieldNames()[:-1]
    lake.overwrite(lake.read("raw", "ibkr").withColumn("n", F.lit(1)), "raw", "ibkr")
    assert rows(lake.read("raw", "ibkr"), "n") == [(1,)]


def test_failed_overwrite_leaves_the_table(spark, lake):
    lake.append(spark.range(3), "raw", "t")
    with pytest.raises(Exception):
        lake.overwrite(spark.range(3).select(F.raise_error(F.lit("stop"))), "raw", "t")
    assert lake.read("raw", "t").count() == 3


def test_disapproved_overwrite_leaves_the_table(spark, lake):
    lake.append(spark.range(3), "raw", "t")

    def refuse():
        raise ValueError("no")

    with pytest.raises(ValueError):
        lake.overwrite(spark.range(9), "raw", "t", approve=refuse)
    assert lake.read("raw", "t").count() == 3 and lake.tables() == [("raw", "t")]
    lake.overwrite(spark.range(9), "raw", "t", approve=lambda: None)
    assert lake.read("raw", "t").count() == 9


def test_interrupted_swap_is_finished(spark, lake):
    spark.range(5).write.parquet(lake.path("raw", "t") + "__new")
    assert lake.read("raw", "t").count() == 5
    assert lake.tables() == [("raw", "t")]


def test_views_and_sql(spark, lake):
    lake.append(spark.range(3).withColumn("v", F.col("id") * 2), "analytics", "a_b")
    lake.append(spark.range(2), "raw", "x")
    assert lake.aliases() == ["a_b_analytics", "x_raw"]
    assert lake.register_views() == ["a_b_analytics", "x_raw"]
    joined = "SELECT a.v FROM a_b_analytics a JOIN x_raw x ON a.id = x.id WHERE a.id > 0"
    assert rows(lake.sql(joined)) == [(2,)]
    lake.append(spark.range(10, 12), "raw", "x")
    lake.refresh()
    assert lake.sql("SELECT count(*) FROM x_raw").first()[0] == 4


def test_export(spark, tmp_path, capsys):
    df = spark.createDataFrame([(1, "a")], "n int, s string")
    export(df)
    assert "a" in capsys.readouterr().out
    export(spark.createDataFrame([(n, None) for n in range(50)], "n int, s string"))
    printed = capsys.readouterr().out.splitlines()
    assert printed[0] == "n\ts" and sorted(printed[1:]) == sorted(f"{n}\tNULL" for n in range(50))  # all of them
    export(spark.range(50), limit=3)
    assert "top 3" not in capsys.readouterr().out
    export(df, "csv", str(tmp_path / "c"))
    export(df, "json", str(tmp_path / "j"))
    assert spark.read.option("header", True).csv(str(tmp_path / "c")).first().s == "a"
    assert spark.read.json(str(tmp_path / "j")).first().n == 1
    with pytest.raises(ValueError):
        export(df, "xml")


def test_drop_column(spark, lake):
    wide = raw(spark, raw_row("IBKR", "flex", "<a/>")).withColumn("gross", F.lit(1.0))
    lake.append(wide, "raw", "t")
    assert M.drop_column(lake, "raw", "t", "gross", RAW, dry_run=True) == M.Change(True, 1, False)
    assert "gross" in lake.read("raw", "t").columns
    assert M.drop_column(lake, "raw", "t", "gross", RAW) == M.Change(True, 1, True)
    assert M.drop_column(lake, "raw", "t", "gross", RAW) == M.Change(False)
    assert M.drop_column(lake, "raw", "absent", "gross", RAW) == M.Change(False)
    lake.overwrite(wide.withColumn("more", F.lit(1)), "raw", "t")
    with pytest.raises(M.SchemaConflict):
        M.drop_column(lake, "raw", "t", "gross", RAW)


def test_rewrite_value(spark, lake):
    lake.append(raw(spark, raw_row("IBKR", "flex_cdc", "a"), raw_row("IBKR", "flex", "b")), "raw", "t")
    args = (lake, "raw", "t", "source", "flex_cdc", "flex_events")
    assert M.rewrite_value(*args, dry_run=True) == M.Change(True, 1, False)
    assert M.rewrite_value(*args) == M.Change(True, 1, True)
    assert rows(lake.read("raw", "t"), "source") == [("flex",), ("flex_events",)]
    assert M.rewrite_value(*args) == M.Change(False)
    assert not M.rewrite_value(lake, "raw", "absent", "source", "a", "b").changed


def test_merge_raw_tables(spark, lake):
    lake.append(raw(spark, raw_row("XTB", "s", "a", DAY1, "old"), raw_row("XTB", "s", "b", DAY1, "b")), "raw", "x_snapshot")
    lake.append(raw(spark, raw_row("XTB", "s", "a", DAY2, "new")), "raw", "x_events")
    sources = ["x_snapshot", "x_events", "x_absent"]
    assert M.merge_raw_tables(lake, sources, "x", dry_run=True) == M.Change(True, 2, False)
    assert M.merge_raw_tables(lake, sources, "x") == M.Change(True, 2, True)
    assert rows(lake.read("raw", "x"), "source_file") == [("b",), ("new",)]
    assert M.merge_raw_tables(lake, sources, "x").rows == 2
    assert M.merge_raw_tables(lake, ["gone"], "x") == M.Change(False)
    lake.append(raw(spark, raw_row("XTB", "s", "c", DAY2, "late")), "raw", "x")
    with pytest.raises(M.RowConflict):
        M.merge_raw_tables(lake, sources, "x")
    lake.overwrite(spark.range(1), "raw", "x")
    with pytest.raises(M.SchemaConflict):
        M.merge_raw_tables(lake, sources, "x")
    assert rows(M.raw_vocabulary(lake.read("raw", "x_snapshot"))) == [("XTB", "s", 2)]


def write(path, text):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_bytes(text if isinstance(text, bytes) else text.encode())


def test_landing(spark, tmp_path):
    import hashlib

    write(tmp_path / "xml" / "a.xml", "<a/>")
    got = landing.land_files(spark, str(tmp_path / "xml"), fetched_at=DAY1).first()
    assert (got.broker, got.source, got.source_file, got.fetched_at) == ("IBKR", "flex", "", DAY1)
    assert got.payload_hash == hashlib.sha256(b"<a/>").hexdigest()

    for name in ("equity/positions/1.json", "equity/history/orders/1.json", "equity/history/orders/2.json", "equity/metadata/instruments/1.json"):
        write(tmp_path / "api" / name, "[]")
    pages = landing.land_api_dumps(spark, str(tmp_path / "api"))
    assert rows(pages, "source") == [("/equity/history/orders",), ("/equity/history/orders",), ("/equity/positions",)]
    assert pages.select("fetched_at").distinct().count() == 1

    write(tmp_path / "xlsx" / "PLN_1_a b.xlsx", b"x")
    books = landing.land_workbooks(spark, str(tmp_path / "xlsx"))
    assert rows(books, "broker", "source", "source_file") == [("XTB", "XTB_REPORT", "PLN_1_a b.xlsx")]
