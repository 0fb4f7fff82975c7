"""A ledger of landed files, so that a run reads only what is new.

Bill pages land as files. ``PageLedger`` remembers each file by name, size and time, and
keeps what was read from it as *parts* (partial sums by file and key). A run

1. lists the landed files (names only, no content) and takes those that the ledger does not
   hold as they are now: new files, and files that were landed again with other content;
2. reads exactly these and writes their parts under its own run number;
3. notes which earlier parts they replace (``replaced``);
4. commits by writing its ledger rows, last of all.

A run that dies before its commit leaves parts that no ledger names: the next run has the
same number and removes them first. A file that was landed again counts once, by its
latest content; a file that is deleted after it was read keeps its parts. One run at a time.

Layout below ``base``: ``parts/run=N/<month>=.../``, ``replaced/by_run=N/``, ``ledger/run=N/``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import shuffles_freed

_LEDGER = "path string, file string, length long, modified timestamp, run int"
PAGES = "*.{json,json.gz}"  # pages land as they are or compressed
_REPLACED = "file string, run int, by_run int"


def landed_files(spark: SparkSession, path: str, pattern: str = PAGES) -> DataFrame:
    """``path`` (to open it), ``file`` (as ``_metadata.file_path`` names it), ``length``,
    ``modified`` of every landed file; contents are not read."""
    return (spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", "true")
            .load(path).select("path", F.col("_metadata.file_path").alias("file"), "length",
                               F.col("modificationTime").alias("modified")))


def _exists(spark: SparkSession, path: str) -> bool:
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return bool(folder.getFileSystem(spark._jsc.hadoopConfiguration()).exists(folder))


class PageLedger:
    """The ledger at ``base``; ``month`` is the parts' partition column below the run."""

    def __init__(self, spark: SparkSession, base: str, month: str):
        self.spark, self.base, self.month = spark, base.rstrip("/"), month
        self.opened: list[str] = []

    def _table(self, name: str, schema: str) -> DataFrame:
        path = f"{self.base}/{name}"
        if not _exists(self.spark, path):
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(path)

    def ledger(self) -> DataFrame:
        return self._table("ledger", _LEDGER)

    def committed(self) -> int:
        """Number of the last committed run, -1 before the first."""
        last = self.ledger().agg(F.max("run").alias("r")).first().r
        return -1 if last is None else last

    def pending(self, path: str, pattern: str = PAGES) -> DataFrame:
        """Landed files that no committed run has read as they are now."""
        known = self.ledger().select("file", "length", "modified")
        return landed_files(self.spark, path, pattern).join(known, ["file", "length", "modified"], "left_anti")

    def read_new(self, path: str, parse: Callable[[list[str]], DataFrame], pattern: str = PAGES) -> int | None:
        """Read the pending files with ``parse`` (paths -> parts with the columns ``file`` and
        the month) and write their parts; None if there are none. The names of the new files
        pass through the driver, as they do for any scan."""
        run = self.committed() + 1
        for left in (f"parts/run={run}", f"replaced/by_run={run}", f"ledger/run={run}"):
            delete(self.spark, f"{self.base}/{left}")
        new = self.pending(path, pattern).collect()
        self.opened = sorted(r.path for r in new)
        if not new:
            return None
        self._new = self.spark.createDataFrame([(r.path, r.file, r.length, r.modified) for r in new],
                                               "path string, file string, length long, modified timestamp")
        # gathered by month: else every task would write a file into every month
        parts = parse(self.opened).hint("rebalance", self.month)
        with shuffles_freed(self.spark):
            parts.write.partitionBy(self.month).parquet(f"{self.base}/parts/run={run}")
        old = self.ledger().join(self._new.select("file"), "file", "left_semi").select("file", "run")
        if not old.isEmpty():
            old.write.parquet(f"{self.base}/replaced/by_run={run}")
        return run

    def commit(self, run: int | None) -> None:
        """The run's parts count from now on; call it after the tables are written."""
        if run is not None:
            self._new.write.parquet(f"{self.base}/ledger/run={run}")

    def parts(self, run: int | None = None) -> DataFrame | None:
        """Parts in force for ``run`` (the last committed one by default): replaced ones are out."""
        every = self.all_parts(run)
        return None if every is None else every.join(self._replaced(run), ["file", "run"], "left_anti")

    def all_parts(self, run: int | None = None) -> DataFrame | None:
        run = self.committed() if run is None else run
        path = f"{self.base}/parts"
        if run < 0 or not _exists(self.spark, path):
            return None
        return self.spark.read.parquet(path).filter(F.col("run") <= run)

    def _replaced(self, run: int | None = None) -> DataFrame:
        run = self.committed() if run is None else run
        return self._table("replaced", _REPLACED).filter(F.col("by_run") <= run).select("file", "run").distinct()

    def withdrawn(self, run: int) -> DataFrame | None:
        """Parts that ``run`` has replaced; None if there are none."""
        if not _exists(self.spark, f"{self.base}/replaced/by_run={run}"):
            return None
        every = self.all_parts(run)
        gone = self._table("replaced", _REPLACED).filter(F.col("by_run") == run).select("file", "run")
        return None if every is None else every.join(gone, ["file", "run"], "left_semi")


def delete(spark: SparkSession, path: str) -> None:
    """Remove a folder on whatever store it lies."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


__all__ = ["PageLedger", "landed_files", "delete"]
