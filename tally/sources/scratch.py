"""Tables written on the way, in the folder that all executors share."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_LOCAL: dict[str, str] = {}

# Spark's setting that deletes an action's shuffle files behind it, instead of whenever the driver collects garbage
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def shared_folder(spark: SparkSession, fallback: str | None = None) -> str:
    """The folder named by ``spark.checkpoint.dir``, else ``fallback``.

    Without either, a session on one machine gets a temporary folder that is deleted when Python ends; a cluster has
    no such folder, so that is an error.
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir() or fallback
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors reach")
    app = spark.sparkContext.applicationId
    if app not in _LOCAL:
        folder = tempfile.mkdtemp(prefix="tally-")
        atexit.register(shutil.rmtree, folder, ignore_errors=True)
        _LOCAL[app] = f"file://{folder}"
    return _LOCAL[app]


class Scratch:
    """Writes tables into the shared folder; each is deleted by :meth:`drop`, all that are left by :meth:`clear`."""

    def __init__(self, spark: SparkSession, fallback: str | None = None):
        self.spark = spark
        self._fallback = fallback
        self._tables: list[tuple[DataFrame | None, str]] = []

    def new_path(self, name: str) -> str:
        """A path in the shared folder that nothing has used yet."""
        path = f"{shared_folder(self.spark, self._fallback)}/{name}-{uuid.uuid4().hex}"
        self._tables.append((None, path))
        return path

    def written(self, df: DataFrame, name: str) -> DataFrame:
        """The rows of ``df`` computed once and read back, which cuts the lineage: no lost executor costs them.

        The shuffle files of the write go with its end, as nothing reads them again.
        """
        path = self.new_path(name)
        before = self.spark.conf.get(SHUFFLE_CLEANUP, None)
        self.spark.conf.set(SHUFFLE_CLEANUP, "true")
        try:
            df.write.parquet(path)
        finally:
            if before is None:
                self.spark.conf.unset(SHUFFLE_CLEANUP)
            else:
                self.spark.conf.set(SHUFFLE_CLEANUP, before)
        table = self.spark.read.schema(df.schema).parquet(path)
        self._tables[-1] = table, path
        return table

    def drop(self, *tables: DataFrame) -> None:
        """Delete tables that :meth:`written` returned; call it behind the last action that reads them."""
        for table in tables:
            for entry in [e for e in self._tables if e[0] is table]:
                self._tables.remove(entry)
                self._delete(entry[1])

    def clear(self) -> None:
        while self._tables:
            self._delete(self._tables.pop()[1])

    def _delete(self, path: str) -> None:
        target = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(target, True)

    def __enter__(self) -> Scratch:
        return self

    def __exit__(self, *_) -> None:
        self.clear()
