import io
import tracemalloc
import zipfile

import pyarrow as pa
import pytest

from tally.brokers import xtb
from tally.functions.fernet import encrypt_payload
from tally.schemas import EVENTS, SNAPSHOT, plain
from tally.sources import workbook
from tally.sources.scratch import Scratch
from tally.sources.workbook import _read_batches, sheet_rows, typed_rows, workbook_facts, workbook_rows

from .conftest import KEY, has_schema, plan_of, rows
from .payloads import DAY1, DAY2, TIME, raw, raw_row, report

FILE = "PLN_70077007_2006-01-01_2026-08-03.xlsx"


def uploads(spark, *entries):
    return raw(spark, *[raw_row("XTB", "XTB_REPORT", body, at, file) for body, at, file in entries])


def single(spark, **options):
    return uploads(spark, (report(**options), DAY1, FILE))


def test_snapshot_golden(spark):
    df = xtb.snapshot(encrypt_payload(single(spark), KEY), KEY)
    assert has_schema(df, plain(SNAPSHOT))
    assert rows(df, "label", "position_type", "security_value", "security_ccy", "asset_class", "description", "account_id") == [
        ("CASH PLN", "CASH", 800.92, "PLN", "CASH", "Cash PLN", "70077007"),
        ("CBL.DE", "EQUITY", 1208.5, "PLN", "ETF", "Cobalt Fund", "70077007"),
        ("FJD.DE", "EQUITY", 411.3, "PLN", "ETF", "Fjord Index", "70077007"),
    ]


def test_events_golden(spark):
    df = xtb.events(encrypt_payload(single(spark), KEY), KEY)
    assert has_schema(df, plain(EVENTS))
    at = "2025-02-12T09:00:00+00:00"
    assert rows(df, "event_id", "event_type", "cash_amount", "quantity", "price", "side", "fee_amount", "settle_date", "ticker") == [
        ("21", "TRADE", -75.5, 2.5, 30.2, "BUY", None, None, "CBL.DE"),
        ("22", "TAX", -1.33, None, None, None, None, None, ""),
        ("23", "DEPOSIT", 900.0, None, None, None, None, None, ""),
        ("24", "INTEREST", 7.0, None, None, None, None, None, ""),
        ("25", "TRADE", 91.0, 2.5, 36.4, "BUY", 3.75, at, "CBL.DE"),
        ("26", "TRANSFER", -120.25, None, None, None, None, None, ""),
    ]
    assert {r[0] for r in rows(df, "event_datetime")} == {at}
    assert rows(xtb.unread_comments(df)) == [(0,)]


def test_last_closed_row_of_a_position_counts(spark):
    first = [None] * 25
    first[0], first[8], first[16], first[23] = "Cobalt Fund", TIME, 1.0, "8800"
    df = xtb.events(single(spark, extra_closed=[first]))
    assert rows(df.filter("event_id = '25'"), "fee_amount") == [(3.75,)]


def test_missing_sheets(spark):
    assert rows(xtb.snapshot(single(spark, without=("Cash Operations",))), "position_type") == [("EQUITY",), ("EQUITY",)]
    assert xtb.events(single(spark, without=("Cash Operations",))).count() == 0
    assert rows(xtb.events(single(spark, without=("Closed Positions",))).filter("event_id = '25'"), "fee_amount") == [(None,)]
    no_open = single(spark, without=("Open Positions",))
    assert rows(xtb.snapshot(no_open), "label", "security_ccy", "security_value") == [("CASH ", "", 800.92)]


def test_empty_total_is_zero_cash(spark):
    assert (("CASH", 0.0)) in rows(xtb.snapshot(single(spark, total=0.0)), "position_type", "security_value")


def test_latest_upload_per_account_with_fallback(spark):
    df = uploads(
        spark,
        (report(total=1.0), DAY1, FILE),
        (report(total=2.0), DAY2, FILE),
        (report(account="222", total=3.0), DAY1, "EUR_222_x.xlsx"),
        (b"broken", DAY2, "EUR_222_y.xlsx"),
        (b"broken", DAY2, "EUR_333_y.xlsx"),
        (report(account="444", total=4.0), DAY1, "unnamed.xlsx"),
        (report(account="555", ccy="", total=5.0), DAY1, "PLN_555_x.xlsx"),
        (report(account="666", total=6.0, stamp="yesterday"), DAY1, "PLN_666_x.xlsx"),
        (report(account="", total=7.0), DAY1, "nobody.xlsx"),
        (report(account="777", total=8.0), DAY1, "PLN_777_x.xlsx"),
        (report(account="777", total=9.0, stamp="nan"), DAY2, "PLN_777_y.xlsx"),
        (report(account="888", total=9.0, stamp="4e9"), DAY2, "PLN_888_y.xlsx"),
    )
    cash = xtb.snapshot(df).filter("position_type = 'CASH'")
    assert rows(cash, "account_id", "security_value") == [("222", 3.0), ("444", 4.0), ("70077007", 2.0), ("777", 8.0)]
    notes = xtb.report_notes(xtb.parsed_reports(df)).first()
    assert notes.unusable_reports == 6


def test_same_time_uploads_break_ties_by_file_name(spark):
    df = uploads(spark, (report(total=1.0), DAY1, "PLN_70077007_a.xlsx"), (report(total=2.0), DAY1, "PLN_70077007_b.xlsx"))
    assert (2.0,) in rows(xtb.snapshot(df).filter("position_type = 'CASH'"), "security_value")


def test_rows_carry_the_sheets_account(spark):
    df = uploads(spark, (report(account="999"), DAY1, FILE))
    assert {r[0] for r in rows(xtb.snapshot(df), "account_id")} == {"999"}
    assert xtb.report_notes(xtb.parsed_reports(df)).first().account_mismatches == 1


def test_rows_without_time_are_dropped_and_counted(spark):
    df = single(spark, stamp=None)
    assert xtb.events(df).count() == 0
    assert xtb.report_notes(xtb.parsed_reports(df)).first().dropped_cash_rows == 6


def test_undecryptable_rows_are_dropped(spark):
    assert xtb.snapshot(single(spark), KEY).count() == 0


def test_cells_in_long_form(spark):
    body = single(spark).selectExpr("payload_hash", "payload AS body")
    long = sheet_rows(body)
    assert long.filter("sheet = 'cash operation' AND row_idx = 1").first().cells[0] == "Type"
    assert long.filter("sheet = 'open position' AND row_idx = 6").first().cells == ["Plan", "Fjord Index", "FJD.DE", "ETF", None, "3", "411.3"]


@pytest.mark.parametrize("claim", ['<row r="1000000000"', '<row r="0"', '<row r="2"><c r="ZZZZ9"><v>1</v></c></row><row r="3"'])
def test_a_file_that_claims_more_than_a_sheet_holds_is_unreadable(claim):
    made, out = zipfile.ZipFile(io.BytesIO(report())), io.BytesIO()
    with zipfile.ZipFile(out, "w") as book:
        for name in made.namelist():
            book.writestr(name, made.read(name).decode().replace('<row r="3"', claim))
    with pytest.raises(ValueError):
        list(workbook_rows(out.getvalue()))


@pytest.mark.parametrize("raw_type, kind", [*xtb.OPERATION_TYPES.items(), ("Stock sale", "UNKNOWN")])
def test_operation_types(raw_type, kind):
    assert xtb.OPERATION_TYPES.get(raw_type, "UNKNOWN") == kind


# ---------------------------------------------------------------- reading no more than needed


def tried(spark, *entries):
    found = xtb.latest_reports(uploads(spark, *entries))
    return sorted((r.source_file, r.fetched_at.day) for r in found.tried.collect()), rows(found.facts, "account_id", "source_file")


def test_only_the_newest_reports_are_read_when_they_can_be_used(spark):
    good = [(report(account=str(a)), day, f"PLN_{a}_{n}.xlsx") for a in (111, 222, 333) for n, day in ((1, DAY1), (2, DAY2))]
    read, latest = tried(spark, *good)
    assert [f for f, _ in read] == ["PLN_111_2.xlsx", "PLN_222_2.xlsx", "PLN_333_2.xlsx"]
    assert latest == [("111", "PLN_111_2.xlsx"), ("222", "PLN_222_2.xlsx"), ("333", "PLN_333_2.xlsx")]


def test_accounts_without_a_usable_report_go_on_to_older_ones(spark):
    entries = [(report(account="111"), DAY1, f"PLN_111_{n}.xlsx") for n in range(9)]
    entries += [(report(account="222") if n < 5 else b"broken", DAY1, f"PLN_222_{n}.xlsx") for n in range(9)]
    entries += [(b"broken", DAY1, f"PLN_333_{n}.xlsx") for n in range(5)]
    entries += [(report(account="444"), DAY2, "other.xlsx"), (report(account="444"), DAY1, "PLN_444_1.xlsx"), (b"broken", DAY1, "none.xlsx")]
    read, latest = tried(spark, *entries)
    per_account = {a: sum(f.startswith(f"PLN_{a}_") for f, _ in read) for a in (111, 222, 333, 444)}
    assert per_account == {111: 1, 222: 8, 333: 5, 444: 1}  # one, then one, two and four more
    assert ("other.xlsx", DAY2.day) in read and ("none.xlsx", DAY1.day) in read
    assert latest == [("111", "PLN_111_8.xlsx"), ("222", "PLN_222_4.xlsx"), ("444", "other.xlsx")]


def test_a_report_that_is_stored_twice_counts_once(spark):
    once, twice = single(spark), uploads(spark, (report(), DAY1, FILE), (report(), DAY1, FILE))
    for table in (xtb.snapshot, xtb.events):
        assert rows(table(twice)) == rows(table(once))


def test_no_reports(spark):
    nothing = single(spark).filter("false")
    assert xtb.snapshot(nothing).count() == 0 and xtb.events(nothing).count() == 0
    assert xtb.report_notes(xtb.latest_reports(nothing)).first().asDict() == {"unusable_reports": 0, "dropped_cash_rows": 0, "account_mismatches": 0}


# ---------------------------------------------------------------- the streaming reader


def rewritten(change):
    """The usual report with its open-positions sheet changed as text."""
    made, out = zipfile.ZipFile(io.BytesIO(report())), io.BytesIO()
    with zipfile.ZipFile(out, "w") as book:
        for name in made.namelist():
            text = made.read(name).decode()
            book.writestr(name, change(text) if "OPEN" in text.upper() and "Fjord" in text else text)
    return out.getvalue()


def test_a_gap_between_rows_is_one_empty_row():
    found = [(at, cells[:1]) for sheet, at, cells in workbook_rows(rewritten(lambda t: t.replace('<row r="9">', '<row r="400">').replace('<row r="10">', '<row r="401">'))) if sheet == "open position"]
    assert [at for at, _ in found] == [0, 1, 2, 3, 4, 5, 6, 7, 8, 399, 400]
    assert found[8] == (8, [])


def test_a_gap_ends_the_summary_block(spark):
    moved = rewritten(lambda t: t.replace('<row r="3">', '<row r="3"></row><row r="4">').replace('<row r="4"><c r="A4"', '<row r="5"><c r="A4"').split('<row r="5">')[0] + "</sheetData></worksheet>")
    assert not xtb.parsed_reports(uploads(spark, (moved, DAY1, FILE))).facts.first().ok


def test_every_kind_of_cell():
    main = "http://schemas.openxmlformats.org/spreadsheetml/2006/main"
    office = "http://schemas.openxmlformats.org/officeDocument/2006/relationships"
    row = (
        '<x:c r="B1" t="s"><x:v>1</x:v></x:c><x:c t="b"><x:v>1</x:v></x:c><x:c r="E1" t="e"><x:v>#N/A</x:v></x:c>'
        '<x:c r="F1"><x:f>A1+1</x:f><x:v>2.50</x:v></x:c><x:c r="G1" t="inlineStr"><x:is><x:r><x:t>a</x:t></x:r><x:r><x:t> b</x:t></x:r></x:is></x:c>'
        '<x:c r="H1" t="str"><x:v></x:v></x:c><x:c r="I1"/>'
    )
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as book:
        book.writestr("xl/workbook.xml", f'<workbook xmlns="{main}" xmlns:r="{office}"><sheets><sheet name="My CASH OPERATIONS" r:id="a"/></sheets></workbook>')
        book.writestr("xl/_rels/workbook.xml.rels", '<Relationships><Relationship Id="a" Target="/xl/some/part.xml"/></Relationships>')
        book.writestr("xl/sharedStrings.xml", f'<sst xmlns="{main}"><si><t>zero</t></si><si><r><t>o</t></r><r><t>ne</t></r></si></sst>')
        book.writestr("xl/some/part.xml", f'<x:worksheet xmlns:x="{main}"><x:sheetData><x:row>{row}</x:row><x:row/></x:sheetData></x:worksheet>')
    assert list(workbook_rows(out.getvalue())) == [
        ("cash operation", 0, [None, "one", "True", None, "#N/A", "2.50", "a b", "", None]), ("cash operation", 1, []), (None, None, ["cash operation"]),
    ]


def large_report(count):
    sheet = io.BytesIO()
    with zipfile.ZipFile(sheet, "w", zipfile.ZIP_DEFLATED) as book:
        made = zipfile.ZipFile(io.BytesIO(report()))
        for name in made.namelist():
            text = made.read(name).decode()
            if "Free funds" not in text:
                book.writestr(name, text)
                continue
            with book.open(name, "w") as part:
                head, tail = text.split('<row r="3">', 1)[0], "</sheetData></worksheet>"
                part.write(head.encode())
                for n in range(count):
                    part.write(f'<row r="{n + 3}"><c r="A{n + 3}" t="inlineStr"><is><t>Deposit</t></is></c><c r="E{n + 3}"><v>45700.5</v></c><c r="F{n + 3}"><v>{n}.5</v></c><c r="G{n + 3}"><v>{n}</v></c></row>'.encode())
                part.write(tail.encode())
    return sheet.getvalue()


def _peak(count):
    batch = pa.RecordBatch.from_pydict({"k": [1], "body": [large_report(count)]})
    tracemalloc.start()
    held = tracemalloc.get_traced_memory()[0]
    total = sum(b.num_rows for b in _read_batches(iter([batch])))
    peak = tracemalloc.get_traced_memory()[1] - held
    tracemalloc.stop()
    assert total > count
    return peak - len(batch.column("body")[0].as_buffer())


def test_a_large_sheet_takes_no_more_memory_than_a_small_one():
    assert _peak(150_000) < 1.3 * _peak(15_000) + (1 << 20)


def test_a_large_report_in_whole(spark):
    made = xtb.events(uploads(spark, (large_report(30_000), DAY1, FILE)))
    assert rows(made.agg({"cash_amount": "sum", "*": "count"})) == [(sum(n + 0.5 for n in range(30_000)), 30_000)]


# ---------------------------------------------------------------- one pass over a report


def test_rows_know_the_headers_above_them(spark):
    long = sheet_rows(single(spark).selectExpr("payload_hash", "payload AS body"))
    cash = rows(long.filter("sheet = 'cash operation' AND row_idx < 4"), "row_idx", "body_at", "summary_at")
    assert cash == [(0, None, None), (1, None, None), (2, 1, None), (3, 1, None)]
    summary = long.filter("sheet = 'open position' AND summary_at IS NOT NULL").agg({"row_idx": "min", "summary_at": "max"})
    assert [a - b for a, b in rows(summary, "min(row_idx)", "max(summary_at)")] == [1]


def test_kinds_are_told_without_a_shuffle_and_facts_by_one(spark):
    typed = typed_rows(sheet_rows(single(spark).selectExpr("payload_hash", "payload AS body")))
    assert "Exchange" not in plan_of(typed) and "Join" not in plan_of(typed)
    assert "Join" not in plan_of(workbook_facts(typed, "payload_hash"))


def test_a_report_is_written_once_with_its_facts(spark):
    names = []

    class Noted(Scratch):
        def written(self, df, name):
            names.append(name)
            return super().written(df, name)

    with Noted(spark) as scratch:
        assert xtb.latest_reports(single(spark), scratch=scratch).facts.count() == 1
    assert names == ["report-heads", "report-rows", "report-facts"]


@pytest.mark.parametrize(
    "old, new",
    [("</row>", " </row>"), ("<sheetData>", "<!-- <sheetData> --><sheetData>"), ("Fjord", "&#70;jord"), ('t="inlineStr"', 'x="" t="inlineStr"'),
     ("<v>", "<f>A1</f><v>"), ("<row ", '<row hidden="0" ')],
)
def test_rows_written_unusually_are_read_like_plain_ones(old, new):
    assert list(workbook_rows(rewritten(lambda t: t.replace(old, new)))) == list(workbook_rows(report()))


def test_plain_rows_equal_the_parsers(monkeypatch):
    plain = list(workbook_rows(report()))
    monkeypatch.setattr(workbook, "_plain_rows", lambda part: None)
    assert list(workbook_rows(report())) == plain


@pytest.mark.parametrize("old, new", [("</sheetData>", "</sheetData"), ("</sheetData>", "</sheetData><row/>x</b>"), ("Fjord", "Fj]]>ord"), ("Fjord", "Fj\x01ord"), ('<row r="9">', '<row r="9" r="9">')])
def test_what_is_no_xml_is_unreadable(old, new):
    with pytest.raises(Exception):
        list(workbook_rows(rewritten(lambda t: t.replace(old, new))))
