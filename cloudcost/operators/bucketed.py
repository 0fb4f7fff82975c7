"""Keyed merge into bucketed tables: the target is not shuffled.

``keyed_merge`` (merge.py) re-groups the target with the batches. Here the target lies in a
catalog table that is partitioned by month and, inside, bucketed and sorted by a hash of the merge
key. A merge brings the batches to one row a key first (their *deltas*), shuffles these to
the target's buckets and joins; the months the deltas name are read and replaced. The
work above the scan of the target is one sort-merge join, the shuffle has the size of the
batches, and the rewritten files keep their buckets.

The hash only deals rows out: the join also compares the key columns, null-safe, so equal
hashes of different keys stay apart. The month must follow from the key (a key never moves).

The number of buckets is fixed when the table is made: about (bytes of a month) / (bytes a
task should merge). Bucket metadata lie in the catalog; ``attach`` names an existing folder in a new
session's catalog with the same number.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..session import shuffles_freed
from .merge import _SEQ, Batch, _last_per_key, owner_groups

KEY = "merge_key"
_MODE = "spark.sql.sources.partitionOverwriteMode"


def key_hash(keys: list[str]) -> Column:
    return F.xxhash64(*[F.col(c) for c in keys])


def deltas(batches: list[Batch], keys: list[str], columns: list[str]) -> tuple[DataFrame, dict[str, str]]:
    """One row a key of the batches: ``merge_key``, the keys, ``first`` (values of the first
    batch that has the key: they count where the target lacks it and nobody owns them; columns
    that every batch owns are not in it) and one struct for each set of batches that own the
    same columns (values of the latest of them, null where none has the key). Also the struct
    in which each owned column lies."""
    values = [c for c in columns if c not in keys]
    groups = owner_groups(batches, values)
    everywhere = groups.get(tuple(range(1, len(batches) + 1)), [])
    first = [c for c in values if c not in everywhere]
    if len(batches) == 1:
        # a batch is unique on its key already: its rows are neither sorted nor dealt out for that
        structs = ([F.struct(*first).alias("first")] if first else []) + ([F.struct(*everywhere).alias("own0")] if everywhere else [])
        one = _last_per_key(batches[0], keys, columns).select(*keys, *structs)
        return one.withColumn(KEY, key_hash(keys)), {c: "own0" for c in everywhere}
    rows = None
    for i, b in enumerate(batches, start=1):
        frame = _last_per_key(b, keys, columns).withColumn(_SEQ, F.lit(i))
        rows = frame if rows is None else rows.unionByName(frame)
    aggs = [F.min_by(F.struct(*first), F.col(_SEQ)).alias("first")] if first else []
    where: dict[str, str] = {}
    for n, (owners, cols) in enumerate(groups.items()):
        aggs.append(F.max_by(F.struct(*cols), F.when(F.col(_SEQ).isin(*owners), F.col(_SEQ))).alias(f"own{n}"))
        where.update({c: f"own{n}" for c in cols})
    one = rows.groupBy(*keys).agg(*aggs) if aggs else rows.select(*keys).distinct()
    return one.withColumn(KEY, key_hash(keys)), where


@dataclass
class BucketedTable:
    """A catalog table: ``columns`` with the unique ``keys``, partitioned by ``month`` (a
    column, or a name for ``month_of``, an expression over the keys) and bucketed."""
    spark: SparkSession
    name: str
    path: str
    keys: list[str]
    columns: list[str]
    month: str
    buckets: int
    month_of: Column | None = None

    def attach(self, schema: StructType) -> BucketedTable:
        """Name the folder in the catalog, new or with the partitions it already has."""
        plain = [c for c in self.columns if c != self.month]
        cols = ", ".join(f"`{c}` {schema[c].dataType.simpleString()}" for c in plain)
        folder = self.spark._jvm.org.apache.hadoop.fs.Path(self.path)
        folder.getFileSystem(self.spark._jsc.hadoopConfiguration()).mkdirs(folder)
        self.spark.sql(f"DROP TABLE IF EXISTS {self.name}")  # external: the files stay
        self.spark.sql(f"CREATE TABLE {self.name} ({cols}, `{KEY}` BIGINT, `{self.month}` DATE) USING parquet "
                       f"PARTITIONED BY (`{self.month}`) CLUSTERED BY (`{KEY}`) SORTED BY (`{KEY}`) "
                       f"INTO {self.buckets} BUCKETS LOCATION '{self.path}'")
        self.spark.sql(f"MSCK REPAIR TABLE {self.name}")
        return self

    def read(self) -> DataFrame:
        return self.spark.table(self.name).select(*self.columns)

    def merged(self, change: DataFrame, where: dict[str, str], months: list) -> DataFrame:
        """The rows of ``months`` after the deltas ``change``, with key hash and month last."""
        from ..plans.jobs import is_one_of
        t = self.spark.table(self.name).filter(is_one_of(self.month, months)).alias("t")
        d = change.alias("d")
        # all keys equal, as one value: separate equalities would become join keys, by which
        # the target is not bucketed
        equal = F.least(F.lit(True), *[F.col(f"d.{c}").eqNullSafe(F.col(f"t.{c}")) for c in self.keys])
        same = (F.col(f"d.{KEY}") == F.col(f"t.{KEY}")) & equal
        new, old = F.col(f"d.{KEY}").isNotNull(), F.col(f"t.{KEY}").isNotNull()
        out = {}
        for c in self.columns:
            if c in self.keys:
                out[c] = F.when(new, F.col(f"d.{c}")).otherwise(F.col(f"t.{c}"))
                continue
            first = "first" in change.columns and c in change.schema["first"].dataType.names
            value = F.when(old, F.col(f"t.{c}"))
            if first:
                value = value.otherwise(F.col(f"d.first.{c}"))
            if c in where:
                own = f"d.{where[c]}"
                value = F.when(F.col(own).isNotNull(), F.col(f"{own}.{c}")).otherwise(value)
            out[c] = value
        rows = d.join(t, same, "full_outer").select(
            *[v.alias(c) for c, v in out.items()],
            F.when(new, F.col(f"d.{KEY}")).otherwise(F.col(f"t.{KEY}")).alias(KEY))
        if self.month_of is not None:
            rows = rows.withColumn(self.month, self.month_of)
        return rows.select(*[c for c in self.columns if c != self.month], KEY, self.month)

    def merge(self, batches: list[Batch], stage: Callable[[DataFrame], DataFrame]) -> list:
        """Apply ``batches`` in order and replace the months they touch, which are returned.
        ``stage`` writes a table and reads it back: the deltas are computed once."""
        from ..plans.jobs import values_of
        change, where = deltas(batches, self.keys, self.columns)
        change = stage(change)
        by_month = change if self.month_of is None else change.withColumn(self.month, self.month_of)
        months = values_of(by_month, self.month)
        if months:
            with _dynamic_overwrite(self.spark), shuffles_freed(self.spark):
                self.merged(change, where, months).write.mode("overwrite").insertInto(self.name)
        return months


@contextmanager
def _dynamic_overwrite(spark: SparkSession) -> Iterator[None]:
    """``insertInto`` takes the mode from the session alone."""
    before = spark.conf.get(_MODE)
    spark.conf.set(_MODE, "dynamic")
    try:
        yield
    finally:
        spark.conf.set(_MODE, before)
