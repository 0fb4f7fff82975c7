"""Relational scan with bound dates (S8) as a Python data source.

``spark.read.format("date_slices")`` plans one partition for each slice of a date range, as a partitioned
JDBC read does, and takes the date bounds of the query: filters ``>=``, ``>``, ``<=``, ``<`` and
``=`` on the date column narrow the range before it is sliced and are not evaluated again;
all other filters stay with Spark. A slice reads its rows with the bounds as parameters, in
Arrow batches, and only the columns of the declared schema.

What a slice reads from is a landed table (Parquet, on any store that Arrow's file systems open).
No database may run where this library is tested, so the JDBC connection itself is unproven:
``spark.read.jdbc(..., predicates=[...])`` with one predicate a slice takes this place.

Options: ``path``; ``date_col``; ``lo`` and ``hi`` (ISO dates, inclusive: the range the table
can hold); ``days`` a slice (default 31). Rows outside ``lo .. hi`` and rows without a date are
not read, as with the bound parameters of the query it stands for.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterator

from pyspark.sql import SparkSession
from pyspark.sql.datasource import (DataSource, DataSourceReader, EqualTo, Filter, GreaterThan, GreaterThanOrEqual,
                                    InputPartition, IsNotNull, LessThan, LessThanOrEqual)
from pyspark.sql.types import StructType

PUSHDOWN = "spark.sql.python.filterPushdown.enabled"
ONE = dt.timedelta(days=1)


class Slice(InputPartition):
    def __init__(self, lo: dt.date, hi: dt.date):
        self.lo, self.hi = lo, hi


class DateSliceReader(DataSourceReader):
    def __init__(self, schema: StructType, options: dict):
        self.columns = schema.names
        self.path, self.date_col = options["path"], options["date_col"]
        self.lo, self.hi = dt.date.fromisoformat(options["lo"]), dt.date.fromisoformat(options["hi"])
        self.days = int(options.get("days", 31))
        if self.days < 1:
            raise ValueError("a slice has at least one day")

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        """Date bounds are taken; the others are handed back."""
        for f in filters:
            if getattr(f, "attribute", None) != (self.date_col,):
                yield f
            elif isinstance(f, (GreaterThan, GreaterThanOrEqual)):
                self.lo = max(self.lo, f.value + ONE if isinstance(f, GreaterThan) else f.value)
            elif isinstance(f, (LessThan, LessThanOrEqual)):
                self.hi = min(self.hi, f.value - ONE if isinstance(f, LessThan) else f.value)
            elif isinstance(f, EqualTo):
                self.lo, self.hi = max(self.lo, f.value), min(self.hi, f.value)
            elif not isinstance(f, IsNotNull):  # every row that is read has a date
                yield f

    def partitions(self) -> list[Slice]:
        out, at = [], self.lo
        while at <= self.hi:
            end = min(at + (self.days - 1) * ONE, self.hi)
            out.append(Slice(at, end))
            at = end + ONE
        return out or [Slice(self.lo, self.lo - ONE)]

    def read(self, partition: Slice):
        import pyarrow.dataset as ds
        from pyarrow import fs
        if partition.hi < partition.lo:
            return
        store, path = fs.FileSystem.from_uri(self.path) if "://" in self.path or self.path.startswith("file:") else (None, self.path)
        day = ds.field(self.date_col)
        table = ds.dataset(path, filesystem=store, format="parquet", partitioning="hive")
        yield from table.to_batches(columns=self.columns, filter=(day >= partition.lo) & (day <= partition.hi))


class DateSlices(DataSource):
    @classmethod
    def name(cls) -> str:
        return "date_slices"

    def reader(self, schema: StructType) -> DateSliceReader:
        return DateSliceReader(schema, self.options)


def read_date_slices(spark: SparkSession, path: str, schema: StructType, date_col: str, lo: dt.date, hi: dt.date, days: int = 31):
    """Rows of a relational table whose dates lie in ``lo .. hi``, read slice by slice."""
    spark.conf.set(PUSHDOWN, "true")
    spark.dataSource.register(DateSlices)
    return (spark.read.format("date_slices").schema(schema).option("path", path).option("date_col", date_col)
            .option("lo", lo.isoformat()).option("hi", hi.isoformat()).option("days", str(days)).load())
