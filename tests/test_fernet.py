import base64

import pytest
from pyspark.sql import functions as F

from tally.functions import fernet as C

from .conftest import KEY, plan_of, rows

# public Fernet test vector
TOKEN = b"gAAAAAAdwJ6wAAECAwQFBgcICQoLDA0ODy021cpGVWKZ_eEwCGM4BLLF_5CV9dOPmrhuVUPgJobwOz7JcbmrR64jVmpU4IwqDA=="
OTHER = base64.urlsafe_b64encode(bytes(range(32))).decode()


def test_public_vector_opens(spark):
    df = spark.createDataFrame([(bytearray(TOKEN),)], "payload binary")
    assert bytes(C.decrypt_payload(df, KEY).first()[0]) == b"hello"


def test_damaged_tokens_are_null(spark):
    flipped = bytearray(TOKEN)
    flipped[40] ^= 1
    given = [bytearray(b"garbage!"), bytearray(b""), bytearray(TOKEN[:-8]), flipped, None]
    df = spark.createDataFrame([(g,) for g in given], "payload binary")
    assert [r[0] for r in C.decrypt_payload(df, KEY).collect()] == [None] * 5


def test_number_round_trip_keeps_nulls(spark):
    values = [(0.1,), (-1501.0,), (1e20,), (12345678.9,), (None,), (0.0,)]
    df = spark.createDataFrame(values, "v double")
    sealed = C.encrypt_columns(df, ["v"], KEY)
    assert dict(sealed.dtypes) == {"v": "binary"}
    assert rows(C.decrypt_columns(sealed, ["v"], KEY)) == sorted(values, key=repr)


def test_tokens_are_fernet_shaped_and_never_repeat(spark):
    df = spark.range(500).select(F.lit(1.5).alias("v"))
    tokens = [bytes(r[0]) for r in C.encrypt_columns(df, ["v"], KEY).collect()]
    assert len(set(tokens)) == 500
    raw = base64.urlsafe_b64decode(tokens[0])
    assert raw[0] == 0x80 and (len(raw) - 57) % 16 == 0


def test_long_payload(spark):
    body = bytes(range(256)) * 400
    df = spark.createDataFrame([(bytearray(body),)], "payload binary")
    opened = C.decrypt_payload(C.encrypt_payload(df, KEY), KEY, strict=True)
    assert bytes(opened.first()[0]) == body


def test_wrong_key_fails_strictly(spark):
    sealed = C.encrypt_columns(spark.createDataFrame([(1.0,)], "v double"), ["v"], KEY)
    with pytest.raises(Exception, match="does not open"):
        C.decrypt_columns(sealed, ["v"], OTHER).collect()
    assert rows(C.decrypt_columns(sealed, ["v"], OTHER, strict=False)) == [(None,)]


def test_decrypt_all(spark):
    df = spark.createDataFrame([(1.236, "text", None, "plain"), (2.0, "more", None, "p")], "n double, t string, e string, p string")
    sealed = C.seal(C.encrypt_columns(df, ["n"], KEY), ["t", "e"], KEY)
    blob = sealed.withColumn("b", F.lit(b"\xff\xfe\x00"))
    sealed = C.seal(blob, ["b"], KEY)
    opened = C.decrypt_all(sealed, KEY)
    assert dict(opened.dtypes) == {"n": "double", "t": "string", "e": "string", "p": "string", "b": "binary"}
    assert rows(opened, "n", "t", "e", "p") == [(1.24, "text", None, "plain"), (2.0, "more", None, "p")]
    assert C.decrypt_all(sealed, KEY, ["n", "unknown"]).schema["t"].dataType.simpleString() == "binary"
    with pytest.raises(C.DecryptError):
        C.decrypt_all(sealed, OTHER)


def test_no_python_in_the_plan_and_no_key(spark):
    sealed = C.encrypt_columns(spark.createDataFrame([(1.0,)], "v double"), ["v"], KEY)
    text = plan_of(C.decrypt_columns(sealed, ["v"], KEY))
    assert "Python" not in text
    key = C.FernetKey.of(KEY)
    assert key.encrypt.hex() not in text.lower() and key.sign.hex() not in text.lower()


def test_bad_key():
    with pytest.raises(ValueError):
        C.FernetKey.of("c2hvcnQ=")
