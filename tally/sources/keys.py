"""Which payloads a raw table holds already: a bucketed, sorted table of content keys beside it.

The keys of a new batch are shuffled to the buckets and merged with them, so what a lake has gathered over the years is
read in place: neither payloads nor keys of the history are exchanged.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from typing import TYPE_CHECKING

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tally.operators.dedup import RAW_KEY

if TYPE_CHECKING:
    from tally.sources.lake import Lake

BITS = 1 << 26  # of each table in :func:`picked`; with more keys than that it only shuffles more
BUCKETS = 64  # of a new index; a hundred million keys make files of some 50 MB


def content_key(columns: Sequence[str] = RAW_KEY) -> Column:
    """One binary key of several columns; null is a value of its own."""
    return F.unhex(F.sha2(F.to_json(F.struct(*columns)), 256))


def _bits(keys: DataFrame, name: str) -> DataFrame:
    """(bucket, ``name``): the places of ``keys`` in a table of ``BITS`` bits, 4 KB a row."""
    place = _place()
    return keys.groupBy(F.bitmap_bucket_number(place).alias("bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(place)).alias(name))


def _place() -> Column:
    return F.pmod(F.xxhash64("key"), F.lit(BITS)) + 1


def picked(rows: DataFrame, keys: DataFrame) -> DataFrame:
    """The rows whose ``key`` is ``fresh`` in ``keys`` (key, fresh: every key of the rows, once).

    Two bit tables of fixed size, one of the fresh keys and one of the others, go to all tasks. A row that only the
    first one names is taken and one that it does not name is left without a shuffle; the few that both name, by
    chance, are joined with the keys.
    """
    fresh = keys.filter("fresh").select("key")
    tables = _bits(fresh, "__fresh").join(_bits(keys.filter("NOT fresh"), "__others"), "bucket", "full_outer")
    at = F.bitmap_bit_position(_place())
    bit = lambda table: F.expr(f"coalesce((CAST(conv(hex(substring({table}, CAST(1 + __at DIV 8 AS INT), 1)), 16, 10) AS INT) & shiftleft(1, CAST(__at % 8 AS INT))) <> 0, false)")
    placed = rows.withColumns({"__bucket": F.bitmap_bucket_number(_place()), "__at": at})
    told = placed.join(F.broadcast(tables.withColumnRenamed("bucket", "__bucket")), "__bucket").filter(bit("__fresh"))
    own = [F.col(c) for c in rows.columns]
    # an inner join, as the optimizer would move a semi-join of all rows below the choice
    sure = told.filter(~bit("__others")).select(*own)
    return sure.unionByName(told.filter(bit("__others")).select(*own).join(fresh, "key").select(*own))


class KeyIndex:
    """The keys of raw table ``name`` of a lake.

    The index follows the table: a mark is set while both change, so a run that stopped in between makes the next one
    build the index anew from the table, as does a table that was replaced.
    """

    def __init__(self, lake: Lake, name: str, buckets: int = BUCKETS):
        self.lake, self.name = lake, name
        self._base = f"{lake.root}/_keys/{name}"
        self._mark = f"{self._base}/_changing"
        self._table = "tally_keys_" + hashlib.md5(self._base.encode()).hexdigest()
        self.buckets = self._stored() or buckets

    def _stored(self) -> int | None:
        fs, base = self.lake._fs(self._base)
        if not fs.exists(base):
            return None
        names = [s.getPath().getName() for s in fs.listStatus(base)]
        return next((int(n[1:]) for n in names if n[:1] == "b" and n[1:].isdigit()), None)

    @property
    def path(self) -> str:
        return f"{self._base}/b{self.buckets}"

    def _open(self) -> None:
        """Make the session know the table; it lies beside the raw table, the catalog only points there."""
        spark, path = self.lake.spark, self.path.replace("'", "\\'")
        spark.sql(f"DROP TABLE IF EXISTS {self._table}")
        spark.sql(f"CREATE TABLE {self._table} (key BINARY) USING parquet CLUSTERED BY (key) SORTED BY (key) INTO {self.buckets} BUCKETS LOCATION '{path}'")

    def keys(self) -> DataFrame:
        """The keys of the raw table, each once, in their buckets."""
        if self._stored() is None or self.lake._present(self._mark):
            self._build()
        self._open()
        return self.lake.spark.table(self._table)

    def _write(self, keys: DataFrame) -> None:
        self._open()
        sorted_ = keys.repartition(self.buckets, "key").write.format("parquet").mode("append")
        sorted_.bucketBy(self.buckets, "key").sortBy("key").saveAsTable(self._table)

    def _build(self) -> None:
        self.lake.forget_keys(self.name)
        held = self.lake.find("raw", self.name)
        with self.changing():
            if held is not None:
                self._write(held.select(content_key().alias("key")).distinct())

    @contextmanager
    def changing(self) -> Iterator[None]:
        """The table and its index change; the mark stays when anything fails on the way."""
        fs, mark = self.lake._fs(self._mark)
        fs.create(mark, True).close()
        fs.mkdirs(self.lake._fs(self.path)[1])
        yield
        fs.delete(mark, False)

    def marked(self, batch: DataFrame) -> DataFrame:
        """(key, fresh): the content keys of a batch, each once, and whether the table does not hold them."""
        keys = batch.select(content_key().alias("key")).distinct()
        held = self.keys().select("key", F.lit(True).alias("held"))
        return keys.join(held, "key", "left").select("key", F.col("held").isNull().alias("fresh"))

    def unknown(self, batch: DataFrame) -> DataFrame:
        """The content keys of a batch, each once, that the table does not hold."""
        return self.marked(batch).filter("fresh").select("key")

    def add(self, keys: DataFrame) -> None:
        """Add keys that are not there yet; inside :meth:`changing`, behind the rows themselves."""
        self._write(keys)
