"""Scalar column expressions: numbers, text, dates, identifiers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tally.functions._col import ColumnLike, as_col

# ---------------------------------------------------------------- numbers

# --- fixed values: what counts as a number in a text ---
_DIGITS = r"[0-9](?:_?[0-9])*"
NUMBER = (
    rf"^[+-]?(?:(?:{_DIGITS}(?:\.(?:{_DIGITS})?)?|\.{_DIGITS})(?:[eE][+-]?{_DIGITS})?|(?i:nan|inf|infinity))$"
)
_OUTER_BLANKS = r"(?U)^[\s\x1c-\x1f]+|[\s\x1c-\x1f]+$"


def number(value: ColumnLike) -> Column:
    """Text to double, null when it is no number.

    Outer blanks of any script and single underscores between digits are
    allowed; a cast alone would take suffixes such as ``5d`` as well.
    """
    text = F.regexp_replace(as_col(value).cast("string"), _OUTER_BLANKS, "")
    return F.when(text.rlike(NUMBER), F.replace(text, F.lit("_"), F.lit("")).try_cast("double"))


def safe_float(value: ColumnLike, default: float = 0.0) -> Column:
    """Text or number to double; null, empty and unparseable give ``default``."""
    return F.coalesce(number(value), F.lit(default))


def european_float(value: ColumnLike, default: float = 0.0) -> Column:
    """Like :func:`safe_float` for cells such as ``1 234,56``.

    Blanks and no-break spaces are dropped; a comma is the decimal mark only
    when the text has no dot.
    """
    text = F.translate(F.trim(as_col(value).cast("string")), " \u00a0", "")
    comma_only = text.contains(",") & ~text.contains(".")
    return safe_float(F.when(comma_only, F.translate(text, ",", ".")).otherwise(text), default)


def round_half_even(value: ColumnLike, digits: int) -> Column:
    """Scale, round ties to even, scale back."""
    scale = float(10**digits)
    # adding zero turns a rounded negative zero into zero
    return F.rint(as_col(value) * F.lit(scale)) / F.lit(scale) + F.lit(0.0)


def round_exact(value: ColumnLike, digits: int) -> Column:
    """Round on the exact binary value of the double, true ties to even.

    ``value * 10^digits`` is rounded to a double first, which can land on a tie
    that the exact product is not. The rounding error of that product is
    recovered by splitting the operand (Dekker), and decides such ties.
    """
    x = as_col(value)
    scale = F.lit(float(10**digits))
    product = x * scale
    high_part = x * F.lit(134217729.0) - (x * F.lit(134217729.0) - x)
    error = (high_part * scale - product) + (x - high_part) * scale
    below = F.floor(product)
    tie = (product - below) == F.lit(0.5)
    whole = (
        F.when(tie & (error > 0), (below + 1).cast("double"))
        .when(tie & (error < 0), below.cast("double"))
        .otherwise(F.rint(product))
    )
    return whole / scale


# ---------------------------------------------------------------- text


def first_filled(*values: ColumnLike) -> Column:
    """First value that is neither null nor the empty string."""
    return F.coalesce(*[F.nullif(as_col(v), F.lit("")) for v in values])


def text_or_empty(value: ColumnLike) -> Column:
    return F.coalesce(as_col(value), F.lit(""))


def upper_or_empty(value: ColumnLike) -> Column:
    return F.upper(text_or_empty(value))


def header_text(value: ColumnLike) -> Column:
    """Header cell for matching: blanks collapsed, trimmed, lower case."""
    return F.lower(F.trim(F.regexp_replace(text_or_empty(value), r"(?U)\s+", " ")))


# --- fixed values: suffixes that brokers put behind a ticker ---
BROKER_SUFFIX = r"(?s)^(.*?)(_EQ|_ETF)$"
MARKET_SUFFIX = r"(?s)^(.+)_([A-Z]{2})$"
EXCHANGE_LETTER = r"(?s)^(.+)[a-z]$"


def normalize_ticker(value: ColumnLike) -> Column:
    """Strip a broker suffix, then a two-letter market or one exchange letter."""
    ticker = as_col(value)
    stripped = F.regexp_replace(ticker, BROKER_SUFFIX, "$1")
    return (
        F.when(ticker.startswith("CASH "), ticker)
        .when(stripped.rlike(MARKET_SUFFIX), F.regexp_replace(stripped, MARKET_SUFFIX, "$1"))
        .when(stripped != ticker, F.regexp_replace(stripped, EXCHANGE_LETTER, "$1"))
        .otherwise(ticker)
    )


# --- fixed value: the form of a trade's comment ---
TRADE_COMMENT = r"^(?:OPEN|CLOSE)\s+(BUY|SELL)\s+(\d+(?:\.\d+)?)\s+@\s+(\d+(?:\.\d+)?)"


def trade_comment(value: ColumnLike) -> dict[str, Column]:
    """``OPEN|CLOSE side qty @ price`` to side, quantity and price; null when it does not match."""
    text = F.trim(as_col(value))
    def part(i: int) -> Column:
        return F.nullif(F.regexp_extract(text, TRADE_COMMENT, i), F.lit(""))

    return {
        "side": part(1),
        "quantity": part(2).cast("double"),
        "price": part(3).cast("double"),
    }


def account_from_file_name(value: ColumnLike) -> Column:
    """``{CCY}_{digits}_{from}_{to}.xlsx`` to the digits, else null."""
    name = as_col(value)
    base = F.element_at(F.split(name, "/"), -1)
    stem = F.regexp_replace(base, r"(?s)(.)\.[^.]*$", "$1")
    second = F.get(F.split(stem, "_"), F.lit(1))
    return F.when(second.rlike("^[0-9]+$"), second)


def file_name(path: ColumnLike) -> Column:
    """Base name of an object key, percent-decoded once (a plus sign stays a plus)."""
    base = F.element_at(F.split(as_col(path), "/"), -1)
    return F.coalesce(F.try_url_decode(F.replace(base, F.lit("+"), F.lit("%2B"))), base)


def event_hash(source: ColumnLike, account: ColumnLike, *fields: ColumnLike) -> Column:
    """Deterministic event id: 16 hex digits of SHA-256 over the joined fields."""
    parts = [text_or_empty(p) for p in (source, account, *fields)]
    return F.substring(F.sha2(F.concat_ws("|", *parts), 256), 1, 16)


# ---------------------------------------------------------------- dates


# --- fixed values: compact forms of dates and times ---
COMPACT_TIME = r"^(\d{4})(\d{2})(\d{2});(\d{2})(\d{2})(\d{2})$"
COMPACT_DATE = r"^(\d{4})(\d{2})(\d{2})$"


def iso_datetime(value: ColumnLike) -> Column:
    """``YYYYMMDD`` and ``YYYYMMDD;HHMMSS`` to ISO 8601; anything else unchanged."""
    text = as_col(value)
    with_time = F.regexp_replace(text, COMPACT_TIME, "$1-$2-$3T$4:$5:$6Z")
    return F.regexp_replace(with_time, COMPACT_DATE, "$1-$2-$3T00:00:00Z")


# What a rewritten event time must look like to count.
_EVENT_TIME_SHAPE = (
    r"^\d{4}-\d{2}-\d{2}(?: \d{2}:\d{2}:\d{2}|T\d{2}:\d{2}:\d{2}(?:\.\d+)?[+-]\d{2}:\d{2})?$"
)


def event_time(value: ColumnLike) -> Column:
    """Event datetime text in any of the five accepted formats to a UTC timestamp.

    Accepted: compact datetime, compact date, ``Y-m-d H:M:S``, ISO with an
    offset (or ``Z``) and plain date. An ISO time without offset is not accepted.
    Each step uses the one before it once, so the input is never evaluated twice.
    """
    text = F.regexp_replace(as_col(value), r"(?s)^([^Z]*)Z", "$1+00:00")
    text = F.regexp_replace(text, r"(?s)^([^;]*);", "$1 ")
    text = F.regexp_replace(text, r"^(\d{4})(\d{2})(\d{2}) (\d{2})(\d{2})(\d{2})$", "$1-$2-$3 $4:$5:$6")
    text = F.regexp_replace(text, r"^(\d{4})(\d{2})(\d{2})$", "$1-$2-$3")
    text = F.regexp_replace(text, r"([+-]\d{2})(\d{2})$", "$1:$2")
    return F.regexp_extract(text, _EVENT_TIME_SHAPE, 0).try_cast("timestamp")


def period_month(moment: ColumnLike) -> Column:
    return F.date_format(as_col(moment), "yyyy-MM")


def period_quarter(moment: ColumnLike) -> Column:
    moment = as_col(moment)
    return F.concat(
        F.year(moment).cast("string"), F.lit("-Q"), F.quarter(moment).cast("string")
    )


# --- fixed value: the serial of 10000-01-01 in the 1900 date system ---
LAST_SERIAL = 2958466


def is_date_serial(value: ColumnLike) -> Column:
    """Whether a cell text is a workbook date (null counts as no date)."""
    serial = number(value)
    return F.coalesce((serial >= 0) & (serial < LAST_SERIAL), F.lit(False))


def excel_timestamp(value: ColumnLike) -> Column:
    """Workbook date serial to a UTC timestamp, to the millisecond; null when it is no date.

    A date is a number from 0 up to the end of the year 9999.

    The 1900 date system counts a 29 February 1900 that never was, so serials
    below 60 are shifted by a day.
    """
    serial = number(value)
    serial = F.when((serial >= 0) & (serial < LAST_SERIAL), serial)
    days = F.floor(serial) + F.when(serial < 60, F.lit(1)).otherwise(F.lit(0)) - F.lit(25569)
    millis = F.rint((serial - F.floor(serial)) * F.lit(86400000.0)).cast("long")
    return F.timestamp_micros((days * F.lit(86400000) + millis) * F.lit(1000))


def iso_offset_text(moment: ColumnLike) -> Column:
    """Timestamp to ``YYYY-MM-DDTHH:MM:SS[.ffffff]+00:00``."""
    moment = as_col(moment)
    whole = F.date_format(moment, "yyyy-MM-dd'T'HH:mm:ss")
    fraction = F.date_format(moment, "SSSSSS")
    return F.concat(
        whole, F.when(fraction != "000000", F.concat(F.lit("."), fraction)).otherwise(F.lit("")), F.lit("+00:00")
    )


def lookup(table: dict[str, str], key: ColumnLike, default: str) -> Column:
    """Literal map lookup with a default."""
    entries = [F.lit(part) for pair in table.items() for part in pair]
    return F.coalesce(F.try_element_at(F.create_map(*entries), as_col(key)), F.lit(default))
