"""Workbook reports: rows by a streaming reader, everything after it in SQL.

The reader pulls a workbook's sheets through an XML parser and hands on rows of
cell texts in bounded batches, so a sheet's size is no matter of memory. A
sheet's rows come in order, so each is handed on with the place of the header
above it; body cuts, totals and lookups are filters, joins and aggregates over
the rows.
"""

from __future__ import annotations

import io
import posixpath
import re
import zipfile
from collections.abc import Iterable, Iterator
from functools import lru_cache
from typing import IO
from xml.etree import ElementTree

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tally.functions.values import european_float, header_text, is_date_serial, round_exact

# --- fixed values: sheets by name fragment, header signatures, cell positions ---
SHEETS = ("open position", "cash operation", "closed position")
OPEN_CELLS = {"product": 0, "instrument": 1, "ticker": 2, "category": 3, "type": 4, "value": 6}
CASH_CELLS = {"type": 0, "ticker": 2, "time": 4, "amount": 5, "id": 6, "comment": 7, "position": 9}
CLOSED_CELLS = {"first": 0, "close_time": 8, "commission": 16, "position": 23}

OPEN_HEADER = ("product", ("instrument/position", "instrument"))
CASH_HEADER = ("type", "instrument")
CLOSED_HEADER = ("instrument", "ticker")
SUMMARY_HEADER = ("product", "metric", "amount", "currency")
OPEN, CASH, CLOSED = SHEETS
_HEADERS = {OPEN: OPEN_HEADER, CASH: CASH_HEADER, CLOSED: CLOSED_HEADER}

_MAIN = "{http://schemas.openxmlformats.org/spreadsheetml/2006/main}"
_SI, _T, _ROW, _C, _V, _DATA = (f"{_MAIN}{tag}" for tag in ("si", "t", "row", "c", "v", "sheetData"))
_REL_ID = "{http://schemas.openxmlformats.org/officeDocument/2006/relationships}id"


# --- fixed values: the format's own limits; a file that claims more is no workbook ---
MAX_ROWS, MAX_COLUMNS = 1_048_576, 16_384


@lru_cache(maxsize=4096)
def _column_index(letters: str) -> int:
    index = 0
    for letter in letters:
        index = index * 26 + ord(letter) - 64
    return index - 1


_CHUNK = 1 << 16


def _elements(chunk: bytes, stream: IO[bytes], tag: str, holder: str | None = None) -> Iterator[Iterable[ElementTree.Element]]:
    """The complete elements of a name, chunk by chunk; what hangs below ``holder`` (default: the root) is dropped behind
    each. A well-formed part of less than a chunk is parsed at once. ``chunk`` is the first of ``stream``."""
    if len(chunk) < _CHUNK:
        try:
            root = ElementTree.fromstring(chunk)
        except ElementTree.ParseError:
            pass  # as below, what is complete comes before the fault
        else:
            yield root.iter(tag)
            return
    parser, held = ElementTree.XMLPullParser(("start", "end")), None
    while True:
        if chunk:
            parser.feed(chunk)
        else:
            parser.close()
        found = []
        for event, element in parser.read_events():
            if element.tag == tag:
                if event == "end":
                    found.append(element)
            elif held is None or element.tag == holder:
                held = element
        yield found
        if not chunk:
            return
        if held is not None:
            del held[:]
        chunk = stream.read(_CHUNK)


def _text(element: ElementTree.Element) -> str:
    return "".join(element.itertext()) if len(element) else element.text or ""


# Rows as most programs write them, without anything that could be read in two ways: no prefixes, entities or comments,
# and the attributes in their usual order. Characters that XML does not allow or changes are left to the parser.
_PLAIN = r"[^<>&\x00-\x08\x0b-\x1f\x7f\ufffe\uffff]*"
_CELL = rf'<c r="([A-Z]{{1,3}})[0-9]+"(?: s="[0-9]+")?(?: t="([a-zA-Z]+)")?(?:/>|>(?:(<is>)<t(?: xml:space="preserve")?>({_PLAIN})</t></is>|(<v>)({_PLAIN})</v>)</c>)'
_ROW_TAG = r'<row r="([0-9]{1,9})"(?: spans="[0-9]+:[0-9]+")?>'
_CELL_OR_ROW = re.compile(f"{_CELL}|{_ROW_TAG}")
_PLAIN_ROWS = re.compile(re.sub(r"\((?!\?)", "(?:", f"(?:{_ROW_TAG}(?:{_CELL})*</row>)*"))


@lru_cache(maxsize=64)
def _is_frame(text: str) -> bool:
    """Whether a sheet without its rows is well-formed, in UTF-8, and its one ``sheetData`` holds whatever rows it has."""
    declared = re.search(r"<\?xml[^>]*encoding=.([\w-]+)", text)
    if declared and declared[1].lower() != "utf-8" or text.count("<sheetData") != 1 or "<!" in text or text[0] != "<":
        return False
    try:
        root = ElementTree.fromstring(text)
    except ElementTree.ParseError:
        return False
    return len(root.findall(_DATA)) == 1 and next(root.iter(_ROW), None) is None


def _plain_rows(part: bytes) -> list[tuple[int, list[tuple]]] | None:
    """(row number, its matches of ``_CELL``) of a whole part that is written plainly, else None: then it takes a parser."""
    try:
        text = part.decode()
    except UnicodeDecodeError:
        return None
    start, stop = text.find("<sheetData>") + 11, text.rfind("</sheetData>")
    if not 11 <= start <= stop or not _PLAIN_ROWS.fullmatch(text, start, stop) or not _is_frame(text[:start] + text[stop:]):
        return None
    rows: list[tuple[int, list[tuple]]] = []
    for *cell, number in _CELL_OR_ROW.findall(text, start, stop):
        if number:
            rows.append((int(number), []))
        else:
            rows[-1][1].append(cell)
    return rows


class _Rows:
    """(row from 0, cells) in order; a gap between rows is one row without cells, at its beginning."""

    def __init__(self, shared: list[str]):
        self._shared = shared
        self._last = 0

    def read(self, stream: IO[bytes]) -> Iterator[tuple[int, list[str | None]]]:
        chunk = stream.read(_CHUNK)
        plain = _plain_rows(chunk) if len(chunk) < _CHUNK else None
        if plain is not None:
            yield from self._placed([(number, self._plain_cells(cells)) for number, cells in plain])
            return
        for elements in _elements(chunk, stream, _ROW, _DATA):
            yield from self._placed([(element.get("r"), self._cells(element)) for element in elements])

    def _placed(self, rows: list[tuple[int | str | None, list[str | None]]]) -> list[tuple[int, list[str | None]]]:
        done: list[tuple[int, list[str | None]]] = []
        for stated, cells in rows:
            number = self._last + 1 if stated is None else int(stated)
            if not self._last < number <= MAX_ROWS:
                raise ValueError(f"row {number} is outside of a sheet or out of order")
            if number > self._last + 1:
                done.append((self._last, []))
            self._last = number
            done.append((number - 1, cells))
        return done

    def _put(self, cells: list[str | None], at: int, text: str | None) -> None:
        if not 0 <= at < MAX_COLUMNS:
            raise ValueError(f"column {at} is outside of a sheet")
        if at >= len(cells):
            cells.extend([None] * (at + 1 - len(cells)))
        cells[at] = text

    def _plain_cells(self, found: list[tuple]) -> list[str | None]:
        cells: list[str | None] = []
        for letters, kind, _, inline, has_value, value in found:
            at = _column_index(letters)
            text = inline if kind == "inlineStr" else (value if has_value else None) if not kind else self._cell_text(kind, value if has_value else None, inline)
            if at == len(cells) < MAX_COLUMNS:  # the next one, as mostly
                cells.append(text)
            else:
                self._put(cells, at, text)
        return cells

    def _cells(self, row: ElementTree.Element) -> list[str | None]:
        cells: list[str | None] = []
        for c in row.iter(_C):
            reference = c.get("r")
            at = _column_index(reference.rstrip("0123456789")) if reference else len(cells)
            first = next(c.iter(_V), None)
            inline = "".join([_text(t) for t in c.iter(_T)])
            self._put(cells, at, self._cell_text(c.get("t", "n"), None if first is None else _text(first), inline))
        return cells

    def _cell_text(self, kind: str, value: str | None, inline: str) -> str | None:
        if kind == "inlineStr":
            return inline
        if value is None or kind == "e":
            return value
        if kind == "s":
            return self._shared[int(value)]
        if kind == "b":
            return "True" if value == "1" else "False"
        return value


def _shared_texts(book: zipfile.ZipFile) -> list[str]:
    if "xl/sharedStrings.xml" not in book.namelist():
        return []
    with book.open("xl/sharedStrings.xml") as stream:
        return ["".join([_text(t) for t in item.iter(_T)]) for items in _elements(stream.read(_CHUNK), stream, _SI) for item in items]


@lru_cache(maxsize=16)
def _listed(rels: bytes, workbook: bytes) -> list[tuple[str, str]]:
    """(lower-case name, part) of the sheets; reports of one origin mostly have the same two tables of contents."""
    links = ElementTree.fromstring(rels)
    parts = {r.get("Id"): posixpath.normpath(posixpath.join("xl", r.get("Target"))).lstrip("/") for r in links}
    for target in [r for r in links if r.get("Target", "").startswith("/")]:
        parts[target.get("Id")] = target.get("Target").lstrip("/")
    return [(s.get("name", "").lower(), parts[s.get(_REL_ID)]) for s in ElementTree.fromstring(workbook).iter(f"{_MAIN}sheet")]


def workbook_rows(data: bytes) -> Iterator[tuple[str | None, int | None, list[str | None]]]:
    """(sheet, row, cells) of the report's sheets, and last (None, None, sheets that are there).

    The sheets are pulled through the parser a row at a time, so memory is that of the file itself, its table of texts
    and one row. Raises on anything but a workbook, possibly behind rows that were fine.
    """
    with zipfile.ZipFile(io.BytesIO(data)) as book:
        listed = _listed(book.read("xl/_rels/workbook.xml.rels"), book.read("xl/workbook.xml"))
        shared = _shared_texts(book)
        there = []
        for fragment in SHEETS:
            part = next((p for name, p in listed if fragment in name), None)
            if part is not None:
                there.append(fragment)
                with book.open(part) as stream:
                    for at, cells in _Rows(shared).read(stream):
                        yield fragment, at, cells
        yield None, None, there


# what Java's \s takes for white space when it reads Unicode
_BLANKS = re.compile("[\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]+")


@lru_cache(maxsize=4096)
def _header_text(text: str) -> str:
    """Like ``tally.functions.values.header_text``."""
    return _BLANKS.sub(" ", text).strip(" ").lower()


def _is_header(cells: list[str | None], names: tuple[str | tuple[str, ...], ...]) -> bool:
    """Like :func:`header_is`."""
    for index, name in enumerate(names):
        text = cells[index] if index < len(cells) else None
        if text is None or len(text) > 200 or _header_text(text) not in ((name,) if isinstance(name, str) else name):
            return False
    return True


# Rows are handed on after this many, or after about this many bytes of text.
_FLUSH_ROWS, _FLUSH_BYTES = 2048, 2 << 20


def _read_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        keys = batch.drop_columns(["body"])
        rows: list[tuple[int, str | None, int | None, list[str | None], bool | None, int | None, int | None]] = []
        size = 0

        def flushed() -> pa.RecordBatch:
            source, sheet, at, cells, readable, body_at, summary_at = zip(*rows, strict=True)
            own = keys.take(pa.array(source, pa.int64()))
            read = [pa.array(sheet, pa.string()), pa.array(at, pa.int32()), pa.array(cells, pa.list_(pa.string())), pa.array(readable, pa.bool_()), pa.array(body_at, pa.int32()), pa.array(summary_at, pa.int32())]
            return pa.RecordBatch.from_arrays([*own.columns, *read], [*keys.schema.names, "sheet", "row_idx", "cells", "readable", "body_at", "summary_at"])

        for n in range(len(batch)):
            last = body_at = summary_at = None
            try:
                for sheet, at, cells in workbook_rows(batch.column("body")[n].as_py()):
                    if sheet != last:
                        last, body_at, summary_at = sheet, None, None
                    rows.append((n, sheet, at, cells, True if sheet is None else None, body_at, summary_at))
                    if sheet is not None and body_at is None and _is_header(cells, _HEADERS[sheet]):
                        body_at = at
                    if sheet == OPEN and summary_at is None and _is_header(cells, SUMMARY_HEADER):
                        summary_at = at
                    size += 32 + 8 * len(cells) + sum(map(len, filter(None, cells)))
                    if len(rows) >= _FLUSH_ROWS or size >= _FLUSH_BYTES:
                        yield flushed()
                        rows, size = [], 0
            except Exception:  # whatever is wrong with the bytes, the report is just unreadable
                rows.append((n, None, None, [], False, None, None))
        if rows:
            yield flushed()


def sheet_rows(books: DataFrame) -> DataFrame:
    """Rows with binary ``body`` to one row per sheet row: ``sheet`` (its name fragment), ``row_idx`` (from 0), ``cells``.

    ``body_at`` is the row of the first header above it, for the open positions ``summary_at`` that of the first
    header of a summary block; null in rows that have none above. All other columns are carried along. Each workbook ends with a row without sheet that tells whether it was
    ``readable`` and lists the sheets that are there; of an unreadable one there may be rows from before the fault.
    """
    kept = [f for f in books.schema.fields if f.name != "body"]
    schema = T.StructType(
        [
            *kept, T.StructField("sheet", T.StringType()), T.StructField("row_idx", T.IntegerType()),
            T.StructField("cells", T.ArrayType(T.StringType())), T.StructField("readable", T.BooleanType()),
            T.StructField("body_at", T.IntegerType()), T.StructField("summary_at", T.IntegerType()),
        ]
    )
    return books.mapInArrow(_read_batches, schema)


# ---------------------------------------------------------------- expressions over one row


def cell(row: Column, index: int) -> Column:
    return F.get(row, F.lit(index))


def cell_text(row: Column, index: int) -> Column:
    """Trimmed text, empty when the cell is; a whole number loses its ``.0``."""
    text = F.trim(F.coalesce(cell(row, index), F.lit("")))
    return F.when(F.contains(text, F.lit(".0")), F.regexp_replace(text, r"^(\d+)\.0+$", "$1")).otherwise(text)


def with_amounts(df: DataFrame, **texts: str) -> DataFrame:
    """Add amounts with two digits read from cell texts; a null text stays null.

    The number is parsed in a projection of its own, as rounding uses it often.
    """
    parsed = {f"__{n}": F.when(F.col(t).isNotNull(), european_float(t)) for n, t in texts.items()}
    rounded = {n: round_exact(f"__{n}", 2) for n in texts}
    return df.withColumns(parsed).withColumns(rounded).drop(*parsed)


def header_is(row: Column, *names: str | tuple[str, ...]) -> Column:
    """Leading cells equal the names (a tuple lists alternatives)."""
    matched = F.lit(True)
    for index, name in enumerate(names):
        options = (name,) if isinstance(name, str) else name
        matched = matched & header_text(cell(row, index)).isin(*options)
    return matched


def _in(sheet: str) -> Column:
    return F.col("sheet") == sheet


def _below(sheet: str) -> Column:
    """Rows below the sheet's header whose first cell is filled; none without a header."""
    return _in(sheet) & F.col("body_at").isNotNull() & cell(F.col("cells"), 0).isNotNull()


def _blank(index: int) -> Column:
    return F.coalesce(cell(F.col("cells"), index), F.lit("")) == ""


def typed_rows(rows: DataFrame) -> DataFrame:
    """:func:`sheet_rows` with ``head`` (the first cell as header text), a ``kind``: position, operation, closed, total, or
    null, and a ``flaw``: untimed for an operation without time, undated for one or a closed row whose date is none.

    Positions are the aggregate rows (no type) with a ticker; operations have a type and are neither totals nor internal
    transfers; closed rows have a position and a close time. All of it is told by a row and the headers above it.
    """
    c, head = F.col("cells"), F.col("head")
    position = _below(OPEN) & (cell_text(c, OPEN_CELLS["type"]) == "") & (cell_text(c, OPEN_CELLS["ticker"]) != "")
    operation = _below(CASH) & (cell_text(c, CASH_CELLS["type"]) != "") & ~head.isin("total", "subaccount transfer")
    total = _below(CASH) & (head == "total") & (F.size(c) > 5)
    closed = _below(CLOSED) & ~head.isin("profit/loss", "total") & (cell_text(c, CLOSED_CELLS["position"]) != "") & ~_blank(CLOSED_CELLS["close_time"])
    kind = F.when(position, "position").when(operation, "operation").when(closed, "closed").when(total, "total")
    untimed = (F.col("kind") == "operation") & _blank(CASH_CELLS["time"])
    date = F.when(F.col("kind") == "operation", cell(c, CASH_CELLS["time"])).when(F.col("kind") == "closed", cell(c, CLOSED_CELLS["close_time"]))
    flaw = F.when(untimed, "untimed").when(F.col("kind").isin("operation", "closed") & ~is_date_serial(date), "undated")
    return rows.withColumn("head", header_text(cell(c, 0))).withColumn("kind", kind).withColumn("flaw", flaw)


def workbook_facts(typed: DataFrame, key: str) -> DataFrame:
    """One row per workbook: account, currency, free cash, dropped rows, and whether it can be used (``ok``).

    ``typed`` are :func:`typed_rows`. The account stands in the first row of the open-positions sheet, else of the cash
    operations, else of the closed positions. The currency is the first one of the summary block, which ends at the
    first row without first cell or with a note. Free cash is the amount text of the last total row (empty cell: ``0``).
    A workbook can be used when it is readable, its summary block names a currency (if it has an open-positions sheet at
    all) and its filled dates are dates. Operations without a time are dropped and counted.

    Only rows that tell one of these are aggregated, and folded in the task that reads them.
    """
    c, at = F.col("cells"), F.col("row_idx")
    owner = F.when((at == 0) & header_is(c, "account number"), F.nullif(cell_text(c, 1), F.lit("")))
    in_summary = _in(OPEN) & F.col("summary_at").isNotNull()
    code = cell_text(c, 3)
    total = F.when(F.col("kind") == "total", F.struct(at, F.coalesce(cell(c, CASH_CELLS["amount"]), F.lit("0")).alias("amount")))
    telling = typed.filter(F.col("sheet").isNull() | (at == 0) | F.col("summary_at").isNotNull() | (F.col("kind") == "total") | F.col("flaw").isNotNull())
    told = telling.select(
        key, "readable", "flaw",
        (F.col("sheet").isNull() & F.array_contains("cells", OPEN)).alias("has_open"),
        *[F.when(_in(sheet), owner).alias(f"owner_{n}") for n, sheet in enumerate(SHEETS)],
        F.when(in_summary & (cell(c, 0).isNull() | (F.col("head") == "note")), at).alias("stop"),
        F.when(in_summary & (code != ""), F.struct(at, code.alias("code"))).alias("first"),
        total.alias("total"),
    )
    facts = told.groupBy(key).agg(
        F.coalesce(F.max("readable"), F.lit(False)).alias("readable"),
        F.coalesce(F.max("has_open"), F.lit(False)).alias("has_open"),
        *[F.max(f"owner_{n}").alias(f"owner_{n}") for n in range(len(SHEETS))],
        F.min("stop").alias("stop"),
        F.min("first").alias("first"),
        F.max("total")["amount"].alias("free_cash"),
        F.count_if(F.col("flaw") == "untimed").alias("dropped_rows"),
        F.coalesce(F.max(F.col("flaw") == "undated"), F.lit(False)).alias("bad_date"),
    )
    in_block = F.col("first").isNotNull() & (F.col("stop").isNull() | (F.col("first.row_idx") < F.col("stop")))
    named = facts.withColumns(
        {
            "account_id": F.coalesce(*[F.col(f"owner_{n}") for n in range(len(SHEETS))], F.lit("")),
            "account_ccy": F.when(in_block, F.col("first.code")).otherwise(F.lit("")),
        }
    )
    usable = F.col("readable") & ~(F.col("has_open") & (F.col("account_ccy") == "")) & ~F.col("bad_date")
    return named.select(key, "account_id", "account_ccy", "free_cash", "dropped_rows", usable.alias("ok"))


def positions(typed: DataFrame) -> DataFrame:
    """The position rows; the value stays text."""
    c, names = F.col("cells"), ("product", "instrument", "ticker", "category")
    fields = [cell_text(c, OPEN_CELLS[n]).alias(n) for n in names]
    return typed.filter("kind = 'position'").withColumns({n: f for n, f in zip(names, fields)} | {"value": cell(c, OPEN_CELLS["value"])})


def operations(typed: DataFrame) -> DataFrame:
    """The operations that have a time; time and amount stay text."""
    c, names = F.col("cells"), ("type", "ticker", "id", "comment", "position")
    timed = typed.filter(F.col("kind") == "operation").filter(~_blank(CASH_CELLS["time"]))
    return timed.withColumns({n: cell_text(c, CASH_CELLS[n]) for n in names} | {n: cell(c, CASH_CELLS[n]) for n in ("time", "amount")})


def closed_positions(typed: DataFrame) -> DataFrame:
    """The closed rows; close time and commission stay text."""
    c = F.col("cells")
    return typed.filter("kind = 'closed'").withColumns(
        {"position": cell_text(c, CLOSED_CELLS["position"])} | {n: cell(c, CLOSED_CELLS[n]) for n in ("close_time", "commission")}
    )


# ---------------------------------------------------------------- long form


def locate_body(rows: DataFrame, keys: list[str], signature: Column, order: str = "row_idx") -> DataFrame:
    """Long cell rows below their sheet's header row.

    The header row is a map-side aggregate over signature rows only and joins
    back, so that one large sheet is not gathered in one task. How the sides
    meet is left to adaptive execution.
    """
    header = rows.filter(signature).groupBy(*keys).agg(F.min(order).alias("header_idx"))
    return rows.join(header, keys).filter(F.col(order) > F.col("header_idx"))
