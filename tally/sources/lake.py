"""Layered table directories ``{root}/{layer}/{name}`` and the views over them."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tally.operators.dedup import addressed
from tally.operators.shaping import empty
from tally.schemas import LAYERS, RAW
from tally.sources.scratch import Scratch

# Columns that the tables of a layer are partitioned by: each transform reads the sources it maps, no others.
PARTITIONS = {"raw": ("source",)}
_NO_VALUE = "__HIVE_DEFAULT_PARTITION__"


def parse_alias(alias: str) -> tuple[str, str] | None:
    """``{name}_{layer}`` to ``(name, layer)``; None without a known layer."""
    name, _, layer = alias.rpartition("_")
    return (name, layer) if layer in LAYERS else None


class Lake:
    """Reads and writes the ledger's tables.

    ``fmt`` is any directory-based Spark format; ``delta`` works where its
    package is on the class path.
    """

    def __init__(self, spark: SparkSession, root: str, fmt: str = "parquet"):
        self.spark = spark
        self.root = root.rstrip("/")
        self.fmt = fmt
        self._stashed = self.scratch()

    # ------------------------------------------------------------ paths

    def path(self, layer: str, name: str) -> str:
        return f"{self.root}/{layer}/{name}"

    def _fs(self, path: str):
        jvm = self.spark._jvm
        target = jvm.org.apache.hadoop.fs.Path(path)
        return target.getFileSystem(self.spark._jsc.hadoopConfiguration()), target

    def _present(self, path: str) -> bool:
        fs, target = self._fs(path)
        return fs.exists(target)

    def exists(self, layer: str, name: str) -> bool:
        """One look where the table is there; the traces of a broken swap are looked for only where it isn't."""
        path = self.path(layer, name)
        return self._present(path) or self._finish_swap(path)

    # ------------------------------------------------------------ reading

    def read(self, layer: str, name: str) -> DataFrame:
        """The table, or :class:`FileNotFoundError` when there is none."""
        found = self.find(layer, name)
        if found is None:
            raise FileNotFoundError(f"no table {name} in layer {layer} under {self.root}")
        return found

    def find(self, layer: str, name: str, with_address: bool = False) -> DataFrame | None:
        """The table, or None; ``with_address`` adds where each row lies (see ``tally.operators.dedup.addressed``)."""
        if not self.exists(layer, name):
            return None
        table = self.spark.read.format(self.fmt).load(self.path(layer, name))
        table = addressed(table) if with_address else table
        if layer not in PARTITIONS:
            return table
        # a reader puts partition columns last, and knows no type where all of their values are null
        own = [F.col(f.name).cast(f.dataType).alias(f.name) if f.name in PARTITIONS[layer] else F.col(f.name) for f in RAW if f.name in table.columns]
        return table.select(*own, *[c for c in table.columns if c not in RAW.names])

    def read_or_empty(self, layer: str, name: str, schema: T.StructType) -> DataFrame:
        found = self.find(layer, name)
        return empty(self.spark, schema) if found is None else found

    # ------------------------------------------------------------ writing

    @staticmethod
    def _parts(columns: Sequence[str], layer: str, partition_by: Sequence[str] | None) -> list[str]:
        return [c for c in (PARTITIONS.get(layer, ()) if partition_by is None else partition_by) if c in columns]

    def append(self, df: DataFrame, layer: str, name: str, partition_by: Sequence[str] | None = None, indexed: bool = False) -> None:
        """Add rows. ``indexed``: the caller keeps the index of content keys in step; else it is built anew when asked for."""
        if layer == "raw" and not indexed:
            self.forget_keys(name)
        parts = self._parts(df.columns, layer, partition_by)
        df.write.format(self.fmt).mode("append").partitionBy(*parts).save(self.path(layer, name))

    def create(self, schema: T.StructType, layer: str, name: str) -> None:
        """A table with columns and no rows, unless there is one already."""
        if self.exists(layer, name):
            return
        parts = self._parts(schema.names, layer, None)
        if not parts or not self.swaps:
            self.append(empty(self.spark, schema).coalesce(1), layer, name)
            return
        # a partitioned write of no rows leaves no file; one without rows below a partition keeps the columns
        below = "/".join([self.path(layer, name), *(f"{c}={_NO_VALUE}" for c in parts)])
        empty(self.spark, schema).drop(*parts).coalesce(1).write.format(self.fmt).save(below)

    def forget_keys(self, name: str) -> None:
        """Delete the index of a raw table's content keys (see ``tally.sources.keys``)."""
        fs, target = self._fs(f"{self.root}/_keys/{name}")
        fs.delete(target, True)

    # ------------------------------------------------------------ copies on the way

    def stash(self, df: DataFrame, name: str) -> DataFrame:
        """The rows of ``df`` computed once, written to the shared folder and read back.

        The folder is the one that the session names in ``spark.checkpoint.dir``, else one below the lake, which
        every executor reaches. :meth:`clear_stash` deletes what this lake has put there.
        """
        return self._stashed.written(df, name)

    def clear_stash(self) -> None:
        self._stashed.clear()

    def scratch(self) -> Scratch:
        """A scratch of its own, to be cleared by who asked for it."""
        return Scratch(self.spark, f"{self.root}/_stash")

    @property
    def swaps(self) -> bool:
        """Whether an overwrite is written beside the table first."""
        return self.fmt != "delta"

    def overwrite(
        self, df: DataFrame, layer: str, name: str, partition_by: Sequence[str] | None = None,
        approve: Callable[[], None] | None = None,
    ) -> None:
        """Replace the whole table, its schema included.

        The new rows are written beside the table and swapped in afterwards, so
        ``df`` may read the table it replaces and a failed job leaves it intact.
        ``approve`` runs between the two and keeps the old table by raising.
        """
        path, parts = self.path(layer, name), self._parts(df.columns, layer, partition_by)
        if layer == "raw":
            self.forget_keys(name)
        if not self.swaps:
            writer = df.write.format("delta").mode("overwrite").option("overwriteSchema", "true")
            writer.partitionBy(*parts).save(path)
            return
        self._finish_swap(path)
        df.write.format(self.fmt).mode("overwrite").partitionBy(*parts).save(f"{path}__pending")
        if approve:
            approve()
        self._rename(f"{path}__pending", f"{path}__new")
        self._swap(path)
        self.spark.catalog.refreshByPath(path)

    def _move(self, fs, old, new) -> None:
        """A rename that fails is an error, never a table inside another."""
        if not fs.rename(old, new):
            raise OSError(f"could not rename {old} to {new}")

    def _rename(self, old: str, new: str) -> None:
        fs, target = self._fs(new)
        if fs.exists(target):
            fs.delete(target, True)
        self._move(fs, self._fs(old)[1], target)

    def _swap(self, path: str) -> None:
        fs, target = self._fs(path)
        jpath = self.spark._jvm.org.apache.hadoop.fs.Path
        old, new = jpath(f"{path}__old"), jpath(f"{path}__new")
        if fs.exists(target):
            if fs.exists(old):
                fs.delete(old, True)
            self._move(fs, target, old)
        self._move(fs, new, target)
        if fs.exists(old):
            fs.delete(old, True)

    def _finish_swap(self, path: str) -> bool:
        """Complete a swap that stopped between its two renames; whether there is a table now."""
        if self.swaps and not self._present(path) and self._present(f"{path}__new/_SUCCESS"):
            self._swap(path)
            return True
        return False

    # ------------------------------------------------------------ catalog

    def tables(self) -> list[tuple[str, str]]:
        """``(layer, name)`` of every table directory."""
        found = []
        for layer in LAYERS:
            fs, base = self._fs(f"{self.root}/{layer}")
            if not fs.exists(base):
                continue
            for status in fs.listStatus(base):
                name = status.getPath().getName()
                if status.isDirectory() and not name.startswith((".", "_")) and "__" not in name:
                    found.append((layer, name))
        return sorted(found)

    def aliases(self) -> list[str]:
        return sorted(f"{name}_{layer}" for layer, name in self.tables())

    def register_views(self) -> list[str]:
        """(Re-)discover the tables and register one view ``{name}_{layer}`` each."""
        names = []
        for layer, name in self.tables():
            alias = f"{name}_{layer}"
            path = self.path(layer, name)
            self.spark.catalog.refreshByPath(path)
            try:
                self.find(layer, name).createOrReplaceTempView(alias)
            except AnalysisException:  # a directory without data files is not a table
                continue
            names.append(alias)
        return sorted(names)

    refresh = register_views

    def sql(self, text: str) -> DataFrame:
        """Any query over the registered views."""
        return self.spark.sql(text)


def _print_rows(df: DataFrame) -> None:
    """All rows as text, a partition at a time; the driver never holds more."""
    print("\t".join(df.columns))
    for row in df.toLocalIterator():
        print("\t".join("NULL" if v is None else str(v) for v in row))


def export(df: DataFrame, fmt: str = "table", path: str | None = None, limit: int | None = None) -> None:
    """Show a result whole (or its first ``limit`` rows), or write it as csv or json files.

    A whole table is printed row by row as its partitions arrive, tabs between the columns.
    """
    shown = df if limit is None else df.limit(limit)
    if fmt == "table" and limit is None:
        _print_rows(df)
    elif fmt == "table":
        shown.show(limit, truncate=False)
    elif fmt == "csv":
        shown.write.mode("overwrite").option("header", "true").csv(path)
    elif fmt == "json":
        shown.write.mode("overwrite").json(path)
    else:
        raise ValueError(f"unknown export format {fmt!r}")
