"""Fernet tokens (AES-128-CBC + HMAC-SHA256) as Spark expressions, no Python UDF.

Token layout (public Fernet specification): version byte 0x80, 8-byte big-endian
seconds, 16-byte IV, ciphertext, 32-byte HMAC, all base64url encoded. The key is
base64url of 32 bytes: the first half signs, the second half encrypts.
"""

from __future__ import annotations

import base64
import struct
import time
from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tally.functions.values import number, round_half_even

_BLOCK = 64
_OVERHEAD = 1 + 8 + 16 + 32


class DecryptError(ValueError):
    """A token that the key does not authenticate."""


@dataclass(frozen=True, repr=False)
class FernetKey:
    sign: bytes
    encrypt: bytes

    @classmethod
    def of(cls, key: FernetKey | bytes | str) -> FernetKey:
        if isinstance(key, FernetKey):
            return key
        raw = base64.urlsafe_b64decode(key)
        if len(raw) != 32:
            raise ValueError("a Fernet key is 32 url-safe base64-encoded bytes")
        return cls(raw[:16], raw[16:])

    def pad(self, byte: int) -> Column:
        return F.lit(bytes(b ^ byte for b in self.sign.ljust(_BLOCK, b"\0")))


Key = FernetKey | bytes | str


def _hmac(key: FernetKey, message: Column) -> Column:
    inner = F.unhex(F.sha2(F.concat(key.pad(0x36), message), 256))
    return F.unhex(F.sha2(F.concat(key.pad(0x5C), inner), 256))


def _scratch(df: DataFrame, kind: str, name: str) -> str:
    return f"__{kind}_{name}"


def seal(df: DataFrame, columns: Iterable[str], key: Key, seconds: int | None = None) -> DataFrame:
    """Replace binary or text ``columns`` by Fernet tokens; null stays null.

    The IV is keyed and salted with a random value. It is projected first: being
    nondeterministic it is never evaluated twice, so the token's HMAC always
    covers the very bytes that are in the token.
    """
    key = FernetKey.of(key)
    columns = [c for c in columns if c in df.columns]
    if not columns:
        return df
    head = F.lit(b"\x80" + struct.pack(">Q", int(time.time()) if seconds is None else seconds))
    data = {c: F.col(c).cast("binary") for c in columns}
    salted = {
        _scratch(df, "iv", c): F.substring(
            F.unhex(F.sha2(F.concat(F.lit(key.encrypt), F.uuid().cast("binary"), data[c]), 256)), 1, 16
        )
        for c in columns
    }
    boxed = {
        _scratch(df, "box", c): F.concat(
            head,
            F.aes_encrypt(data[c], F.lit(key.encrypt), F.lit("CBC"), F.lit("PKCS"), F.col(_scratch(df, "iv", c))),
        )
        for c in columns
    }
    tokens = {c: _encode(key, F.col(_scratch(df, "box", c))) for c in columns}
    return df.withColumns(salted).withColumns(boxed).withColumns(tokens).select(*df.columns)


def _encode(key: FernetKey, box: Column) -> Column:
    # base64() breaks lines every 76 characters; drop the breaks.
    return _swap(F.base64(F.concat(box, _hmac(key, box))), ("\r\n", ""), ("+", "-"), ("/", "_")).cast("binary")


def _swap(text: Column, *pairs: tuple[str, str]) -> Column:
    """Plain replacements; on long text far cheaper than a character map."""
    for old, new in pairs:
        text = F.replace(text, F.lit(old), F.lit(new))
    return text


def _open_expr(key: FernetKey, raw: Column) -> tuple[Column, Column]:
    """(authentic, plain bytes) of a decoded token."""
    size = F.octet_length(raw)
    body = F.substring(raw, F.lit(1), size - 32)
    authentic = (
        (size >= _OVERHEAD + 16)
        & (F.substring(raw, 1, 1) == F.lit(b"\x80"))
        & (_hmac(key, body) == F.substring(raw, size - 31, F.lit(32)))
    )
    box = F.substring(raw, F.lit(10), size - 41)
    return (
        F.coalesce(authentic, F.lit(False)),
        F.try_aes_decrypt(box, F.lit(key.encrypt), F.lit("CBC"), F.lit("PKCS")),
    )


def unseal(df: DataFrame, columns: Iterable[str], key: Key, strict: bool = True) -> DataFrame:
    """Replace token ``columns`` by their plain bytes; null stays null.

    ``strict`` fails the job on a token the key does not authenticate, otherwise
    such tokens become null.
    """
    key = FernetKey.of(key)
    columns = [c for c in columns if c in df.columns]
    if not columns:
        return df
    decoded = {
        _scratch(df, "raw", c): F.try_to_binary(
            _swap(F.col(c).cast("string"), ("-", "+"), ("_", "/")), F.lit("base64")
        )
        for c in columns
    }
    opened = {}
    for c in columns:
        authentic, data = _open_expr(key, F.col(_scratch(df, "raw", c)))
        value = F.when(authentic, data)
        if strict:
            message = F.lit(f"column '{c}' holds a token the given key does not open")
            value = F.when(F.col(c).isNull(), F.lit(None)).when(authentic, data).otherwise(
                F.raise_error(message).cast("binary")
            )
        opened[c] = value
    return df.withColumns(decoded).withColumns(opened).select(*df.columns)


def encrypt_columns(df: DataFrame, columns: Iterable[str], key: Key) -> DataFrame:
    """Numbers to text to tokens."""
    columns = [c for c in columns if c in df.columns]
    return seal(df.withColumns({c: F.col(c).cast("double").cast("string") for c in columns}), columns, key)


def decrypt_columns(df: DataFrame, columns: Iterable[str], key: Key, strict: bool = True) -> DataFrame:
    """Tokens to text to doubles."""
    columns = [c for c in columns if c in df.columns]
    if not columns:
        return df
    opened = unseal(df, columns, key, strict)
    return opened.withColumns({c: F.col(c).cast("string").try_cast("double") for c in columns})


def encrypt_payload(df: DataFrame, key: Key, column: str = "payload") -> DataFrame:
    return seal(df, [column], key)


def decrypt_payload(df: DataFrame, key: Key, column: str = "payload", strict: bool = False) -> DataFrame:
    return unseal(df, [column], key, strict)


def decrypt_all(df: DataFrame, key: Key, columns: Iterable[str] | None = None) -> DataFrame:
    """Decrypt every binary column to numbers, text or bytes, by what all of its values are.

    One aggregate over all rows and columns decides: a column of numbers becomes
    numbers, rounded to two digits; one that holds any other text becomes text;
    one with bytes that are no text keeps its tokens. A token that the key does
    not open raises :class:`DecryptError`.
    """
    if columns is None:
        columns = [f.name for f in df.schema.fields if isinstance(f.dataType, T.BinaryType)]
    columns = [c for c in columns if c in df.columns]
    if not columns:
        return df
    numbered = df.select(*[F.col(c).alias(f"token{i}") for i, c in enumerate(columns)])
    values = numbered.withColumns({f"value{i}": F.col(f"token{i}") for i in range(len(columns))})
    opened = unseal(values, [f"value{i}" for i in range(len(columns))], key, strict=False)
    measures = []
    for i in range(len(columns)):
        value, text = F.col(f"value{i}"), F.col(f"value{i}").cast("string")
        measures += [
            F.count_if(F.col(f"token{i}").isNotNull() & value.isNull()).alias(f"unread{i}"),
            F.count_if(number(text).isNotNull()).alias(f"numbers{i}"),
            F.count_if(~F.is_valid_utf8(text)).alias(f"bytes{i}"),
            F.count(value).alias(f"values{i}"),
        ]
    facts = opened.agg(*measures).first()
    unread = [c for i, c in enumerate(columns) if facts[f"unread{i}"]]
    if unread:
        raise DecryptError(f"not encrypted with this key: {unread}")
    texts = [c for i, c in enumerate(columns) if not facts[f"bytes{i}"]]
    numbers = [c for i, c in enumerate(columns) if c in texts and 0 < facts[f"values{i}"] == facts[f"numbers{i}"]]
    if not texts:
        return df
    read = {c: F.col(c).cast("string") for c in texts}
    read |= {c: round_half_even(number(read[c]), 2) for c in numbers}
    return unseal(df, texts, key).withColumns(read)
