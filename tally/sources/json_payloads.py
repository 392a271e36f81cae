"""JSON payload rows: validity, page unwrapping, per-element rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from tally.functions._col import ColumnLike, as_col
from tally.functions.fernet import Key, decrypt_payload


def is_json(text: ColumnLike) -> Column:
    """Well-formed JSON that is not the bare literal null."""
    text = as_col(text)
    return F.try_parse_json(text).isNotNull() & (F.trim(text) != "null")


def unwrap(text: ColumnLike, element_ddl: str) -> Column:
    """Elements of a bare array or of ``{"items": [...]}``; anything else has none."""
    text = as_col(text)
    head = F.substring(F.ltrim(text), 1, 1)
    return F.when(head == "[", F.from_json(text, f"array<{element_ddl}>")).when(
        head == "{", F.from_json(text, f"struct<items:array<{element_ddl}>>")["items"]
    )


def element_count(text: ColumnLike) -> Column:
    return F.coalesce(F.size(unwrap(text, "string")), F.lit(0))


def decode_rows(
    raw: DataFrame, key: Key | None, *, require_json: bool = True, observation: Observation | None = None
) -> DataFrame:
    """Raw rows with ``body`` (plain bytes) and ``text``; both are null where the row is unreadable.

    ``text`` is also null when JSON is required and the payload is not JSON.
    Unreadable rows drop out where their elements are exploded. They are not
    filtered here: a filter would move below the decryption and repeat it.

    With an ``observation`` the run reports ``rows``, ``decode_failures``,
    ``parse_failures`` and ``empty_payloads``. ``key=None`` takes payloads as plain.
    """
    plain = raw.withColumn("body", F.col("payload"))
    if key is not None:
        plain = decrypt_payload(plain, key, "body")
    rows = plain.drop("payload").withColumn("text", F.col("body").cast("string"))
    if require_json:
        rows = rows.withColumn("text", F.when(is_json("text"), F.col("text")))
    if observation is not None:
        decoded, parsed = F.col("body").isNotNull(), F.col("text").isNotNull()
        counted = [
            F.count(F.lit(1)).alias("rows"),
            F.count_if(~decoded).alias("decode_failures"),
            F.count_if(decoded & ~parsed).alias("parse_failures"),
        ]
        if require_json:
            counted.append(F.count_if(parsed & (element_count("text") == 0)).alias("empty_payloads"))
        rows = rows.observe(observation, *counted)
    return rows


def explode_events(rows: DataFrame, element_ddl: str, alias: str = "item") -> DataFrame:
    """One row per element of every page."""
    return rows.withColumn(alias, F.explode(unwrap("text", element_ddl)))
