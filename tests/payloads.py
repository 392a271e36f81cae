"""Broker payloads and raw rows for the tests."""

from __future__ import annotations

import hashlib
import io
import json
import zipfile
from datetime import datetime
from xml.sax.saxutils import escape

from tally.schemas import RAW

DAY1, DAY2 = datetime(2026, 8, 1), datetime(2026, 8, 2)


def raw_row(broker, source, payload, at=DAY1, file=""):
    body = payload if isinstance(payload, bytes) else payload.encode()
    return (at, broker, source, bytearray(body), hashlib.sha256(body).hexdigest(), file)


def raw(spark, *entries):
    return spark.createDataFrame(list(entries), RAW)


# ---------------------------------------------------------------- XML


def element(name, **attributes):
    return f"<{name} " + " ".join(f'{k}="{v}"' for k, v in attributes.items()) + "/>"


ACCOUNT = "K9001"


def statement(*sections, account=ACCOUNT, currency="EUR"):
    info = f"<AccountInformation>{element('AccountInformation', accountId=account, currency=currency)}</AccountInformation>"
    if currency is None:
        info = ""
    body = "".join(f"<{name}>{''.join(items)}</{name}>" for name, items in sections)
    return (
        f'<FlexQueryResponse><FlexStatements count="1"><FlexStatement accountId="{account}">{info}{body}'
        "</FlexStatement></FlexStatements></FlexQueryResponse>"
    )


def _elements(name, account, columns, table):
    """One element per row of a table written as text, cells parted by blanks; a dot is an empty cell."""
    rows = [["" if cell == "." else cell for cell in line.split()] for line in table.strip().splitlines()]
    return [element(name, accountId=account, **dict(zip(columns.split(), row, strict=True))) for row in rows]


def snapshot_xml(account=ACCOUNT):
    """One position for each branch of the mapping, and cash that is held, owed and gone."""
    positions = _elements(
        "OpenPosition", account, "symbol description assetCategory currency isin position markPrice positionValue",
        """
        MERID  Meridian  FUND  usd  xx0000000011  6   200  1200.00
        TARN   Tarn      WAR   EUR  .             16  2.5  0
        LARCH  Larch     STK   EUR  .             -3  50   -150.00
        .      Unlisted  STK   EUR  .             2   10   20.00
        PINE   Pine      .     USD  .             3   18.5 55.50
        EMPTY  Empty     STK   EUR  .             0   4    0
        """,
    )
    cash = _elements("CashReportCurrency", account, "currency endingCash", "EUR 615.40\nUSD -20.00\nPLN 0")
    return statement(("OpenPositions", positions), ("CashReport", cash), account=account)


def events_xml(account=ACCOUNT, amount="18.36"):
    """A purchase with a commission in a third currency, a sale, cash in and out, and a fee of its own; ``amount`` is the dividend's."""
    trades = _elements(
        "Trade", account, "ibExecID dateTime settleDateTarget symbol buySell quantity tradePrice currency fxRateToBase ibCommission ibCommissionCurrency netCash",
        """
        bx1  20250310;144501  20250312  LARCH  BUY   5    80     EUR  1.0  -1.50  CHF  -401.50
        sx2  20250311;100000  20250313  PINE   SELL  -12  31.25  USD  0.8  -0.75  USD  374.25
        """,
    )
    cash = _elements(
        "CashTransaction", account, "transactionID type dateTime settleDate currency fxRateToBase amount symbol",
        f"""
        ct-2  Dividends             20250321  20250324  EUR  1.0  {amount}  LARCH
        ct-5  Withholding_Tax       20250321  20250324  EUR  1.0  -2.75     LARCH
        ct-3  Deposits/Withdrawals  20250402  20250402  EUR  1.0  2500.00   .
        """,
    )
    transfers = _elements(
        "Transfer", account, "transactionID type direction dateTime settleDate currency fxRateToBase cashTransfer",
        "tr-9 INTERNAL OUT 20250317;081500 20250319 USD 0.8 -120.50",
    )
    fees = _elements("TransactionFee", account, "date settleDate currency fxRateToBase taxDescription taxAmount", "20250405 20250407 EUR 1.0 Data 4.20")
    sections = (("Trades", trades), ("CashTransactions", cash), ("Transfers", transfers), ("TransactionFees", fees))
    return statement(*sections, account=account).replace("Withholding_Tax", "Withholding Tax")


# ---------------------------------------------------------------- JSON

SUMMARY = {"currency": "GBP", "totalValue": 849.5, "cash": {"inPies": 0.0, "availableToTrade": 240.5}}


def position(ticker, name, isin, ccy, quantity, price):
    return {
        "quantity": quantity, "currentPrice": price, "walletImpact": {"currency": "GBP"},
        "instrument": {"isin": isin, "name": name, "ticker": ticker, "currency": ccy},
    }


# whole shares, part of a share, a third currency, and one that is sold out
POSITIONS = [
    position("MERIDd_EQ", "Meridian", "XX0000000021", "EUR", 3, 41.25),
    position("PINE_US_EQ", "Pine", "XX0000000022", "USD", 0.125, 88.0),
    position("EMPTYa_EQ", "Empty", "XX0000000023", "USD", 0, 7.0),
    position("TARNl_EQ", "Tarn", "XX0000000024", "GBP", 12, 2.5),
]

_NORDX = {"ticker": "NORDX_US_EQ", "isin": "XX0000000002", "name": "Nordic", "currency": "USD"}

ORDER = {
    "order": {
        "id": 90210, "side": "BUY", "ticker": "NORDX_US_EQ", "currency": "USD", "createdAt": "2025-02-11T08:05:00Z",
        "filledQuantity": 8, "value": 344.0, "filledValue": 344.0, "instrument": _NORDX,
    },
    "fill": {
        "id": 31, "price": 43.0, "quantity": 8, "filledAt": "2025-02-11T08:05:02Z",
        "walletImpact": {"netValue": 344.0, "currency": "USD", "fxRate": 1.0, "taxes": []},
    },
}

DIVIDEND = {
    "reference": "dv-5", "amount": 3.2, "currency": "EUR", "tickerCurrency": "USD", "paidOn": "2025-02-20T00:00:00Z",
    "quantity": 8, "grossAmountPerShare": 0.4, "ticker": "NORDX_US_EQ", "instrument": _NORDX,
}

DEPOSIT = {"reference": "tx-3", "dateTime": "2025-01-07T00:00:00Z", "type": "DEPOSIT", "currency": "GBP", "amount": 60.0}


def page(items, wrapped=False):
    return json.dumps({"items": items, "nextPagePath": None} if wrapped else items)


# ---------------------------------------------------------------- workbooks

TIME = 45700.0 + 9 / 24  # 2025-02-12 09:00 UTC


def _sheet(rows):
    out = []
    for number, cells in enumerate(rows, 1):
        body = ""
        for at, value in enumerate(cells):
            ref = f"{chr(65 + at)}{number}"
            if isinstance(value, (int, float)):
                body += f'<c r="{ref}"><v>{value!r}</v></c>'
            elif value is not None:
                body += f'<c r="{ref}" t="inlineStr"><is><t>{escape(value)}</t></is></c>'
        out.append(f'<row r="{number}">{body}</row>')
    main = "http://schemas.openxmlformats.org/spreadsheetml/2006/main"
    return f'<worksheet xmlns="{main}"><sheetData>{"".join(out)}</sheetData></worksheet>'


def workbook_bytes(sheets):
    """A minimal workbook with the given rows."""
    main = "http://schemas.openxmlformats.org/spreadsheetml/2006/main"
    office = "http://schemas.openxmlformats.org/officeDocument/2006/relationships"
    package = "http://schemas.openxmlformats.org/package/2006/relationships"
    names = list(sheets)
    listed = "".join(f'<sheet name="{escape(n)}" sheetId="{i}" r:id="r{i}"/>' for i, n in enumerate(names, 1))
    links = "".join(
        f'<Relationship Id="r{i}" Type="{office}/worksheet" Target="worksheets/s{i}.xml"/>' for i in range(1, len(names) + 1)
    )
    buffer = io.BytesIO()
    with zipfile.ZipFile(buffer, "w") as book:
        files = {
            "xl/workbook.xml": f'<workbook xmlns="{main}" xmlns:r="{office}"><sheets>{listed}</sheets></workbook>',
            "xl/_rels/workbook.xml.rels": f'<Relationships xmlns="{package}">{links}</Relationships>',
            **{f"xl/worksheets/s{i}.xml": _sheet(sheets[n]) for i, n in enumerate(names, 1)},
        }
        for name, text in files.items():
            book.writestr(zipfile.ZipInfo(name), text)  # a fixed date: equal contents are equal bytes
    return buffer.getvalue()


def report(account="70077007", ccy="PLN", *, without=(), commission=3.75, total=800.92, stamp=TIME, extra_closed=()):
    """Two funds and one sold out; seven kinds of operation around one closed position."""
    closed = [None] * 25
    closed[0], closed[1], closed[8], closed[16], closed[23] = "Cobalt Fund", "CBL.DE", TIME, commission, 8800
    owner = ["Account number", account]
    sheets = {
        "Closed Positions": [owner, ["Instrument", "Ticker", "Category"], *extra_closed, closed, ["Profit/loss"]],
        "Cash Operations": [
            owner,
            ["Type", "Instrument", "Ticker", "Category", "Time", "Amount", "ID", "Comment", "Product", "Position ID"],
            ["Stock purchase", "Cobalt Fund", "CBL.DE", "ETF", stamp, -75.5, 21, "OPEN BUY 2.5 @ 30.20", "Plan", 8800],
            ["Free funds interest tax", None, None, None, stamp, -1.33, 22, "levy"],
            ["Subaccount transfer", None, None, None, stamp, -300.0, 27, "aside"],
            ["Deposit", None, None, None, stamp, 900.0, 23, "top up", "Plan"],
            ["Free funds interest", None, None, None, stamp, 7.0, 24, "monthly"],
            ["Stock sell", "Cobalt Fund", "CBL.DE", "ETF", stamp, 91.0, 25, "CLOSE BUY 2.5 @ 36.40", "Plan", 8800],
            ["Transfer", None, None, None, stamp, -120.25, 26, "out"],
            ["Subaccount transfer", None, None, None, stamp, 300.0, 28, "aside"],
            ["Total", None, None, None, None, total],
        ],
        "Open Positions": [
            owner,
            ["Product", "Metric", "Amount", "Currency"],
            ["Plan", "Value", 0, ccy],
            ["Note", "late prices"],
            ["Product", "Instrument/Position", "Ticker", "Category", "Type", "Volume", "Value", "Price"],
            ["Plan", "Left Early", "LFT.DE", "ETF", None, 0, 0.0],
            ["Plan", "Fjord Index", "FJD.DE", "ETF", None, 3, 411.3],
            ["Plan", "55501", "FJD.DE", None, "BUY", 3, 411.3],
            ["Plan", "Cobalt Fund", "CBL.DE", "ETF", None, 20, 1208.5],
            ["Plan", "55502", "CBL.DE", None, "BUY", 12, 725.1],
        ],
    }
    return workbook_bytes({name: rows for name, rows in sheets.items() if name not in without})
