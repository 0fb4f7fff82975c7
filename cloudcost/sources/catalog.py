"""Fan-in over catalog tables (S7): the tables of a database whose names share a prefix, with
columns of their own, read as one."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def catalog_tables(spark: SparkSession, database: str, prefix: str, exclude: Iterable[str] = ()) -> list[str]:
    """Qualified names of the tables of ``database`` with a name prefix, minus the excluded
    names; sorted so that the plan is stable. Temporary views are not tables of a database."""
    left_out = set(exclude)
    return sorted(f"{database}.{t.name}" for t in spark.catalog.listTables(database)
                  if not t.isTemporary and t.name.startswith(prefix) and t.name not in left_out)


def _family(t: T.DataType) -> str:
    if isinstance(t, T.NumericType):
        return "number"
    if isinstance(t, (T.DateType, T.TimestampType, T.TimestampNTZType)):
        return "time"
    return t.simpleString()


def reconciled(frames: list[DataFrame]) -> DataFrame:
    """Union by column name. A column that a table lacks is null there; numbers widen to a type
    that holds all of them, dates to timestamps. Any other difference of types is an error:
    a text column silently read as numbers would fail, or change, only at some row."""
    families: dict[str, str] = {}
    for df in frames:
        for f in df.schema:
            if isinstance(f.dataType, T.NullType):
                continue
            if families.setdefault(f.name, _family(f.dataType)) != _family(f.dataType):
                raise ValueError(f"column {f.name} is {families[f.name]} in one table and {_family(f.dataType)} in another")
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def union_catalog_tables(spark: SparkSession, names: list[str]) -> DataFrame:
    """S7 body: the named tables as one. Predicates on the partition columns prune each table's
    partitions in the catalog."""
    return reconciled([spark.table(n) for n in names])
