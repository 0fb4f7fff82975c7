"""Compaction of partitioned tables that grow by small files.

Parts tables get a folder a run and day. ``compact`` lists the files of a table (names and
sizes, no content), finds the partitions that hold more files than their bytes need, and rewrites
only these: their rows are rebalanced by partition to files of about ``target_bytes``, staged, and
replace the old files by dynamic partition overwrite. The other partitions are not opened. Rows
do not change; a run that dies leaves the old files.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.ledger import landed_files
from .jobs import overwrite_partitions, read_table

TARGET_BYTES = 128 << 20
_ADVISORY = "spark.sql.adaptive.advisoryPartitionSizeInBytes"


def partition_files(spark: SparkSession, path: str, partition_by: list[str]) -> DataFrame:
    """``p0 .. pn`` (partition values as in the folder names), ``files``, ``bytes``."""
    names = [F.regexp_extract("path", f"/{c}=([^/]*)/", 1).alias(f"p{i}") for i, c in enumerate(partition_by)]
    return (landed_files(spark, path, "*.parquet").select(*names, "length").groupBy(*[f"p{i}" for i in range(len(names))])
            .agg(F.count(F.lit(1)).alias("files"), F.sum("length").alias("bytes")))


def crowded(spark: SparkSession, path: str, partition_by: list[str], target_bytes: int = TARGET_BYTES,
            slack: int = 2) -> list[tuple[str, ...]]:
    """Partitions with more than ``slack`` times the files that their bytes need."""
    need = F.greatest(F.ceil(F.col("bytes") / target_bytes), F.lit(1))
    rows = partition_files(spark, path, partition_by).filter(F.col("files") > need * slack)
    return sorted(tuple(r[f"p{i}"] for i in range(len(partition_by))) for r in rows.collect())


def _any_of(partition_by: list[str], values: list[tuple[str, ...]]) -> Column:
    """The rows of the given partitions, as a condition that prunes."""
    by_first: dict[str, list[tuple[str, ...]]] = {}
    for v in values:
        by_first.setdefault(v[0], []).append(v[1:])
    cond = F.lit(False)
    for first, rest in by_first.items():
        c = _is(partition_by[0], first)
        if len(partition_by) > 1:
            c = c & _any_of(partition_by[1:], rest)
        cond = cond | c
    return cond


def _is(col: str, value: str) -> Column:
    return F.col(col).isNull() if value == "__HIVE_DEFAULT_PARTITION__" else F.col(col).cast("string") == value


def compact(spark: SparkSession, path: str, partition_by: list[str], target_bytes: int = TARGET_BYTES,
            slack: int = 2) -> int:
    """Rewrite the crowded partitions of the table at ``path``; how many there were."""
    table = read_table(spark, path)
    if table is None:
        return 0
    found = crowded(spark, path, partition_by, target_bytes, slack)
    if not found:
        return 0
    rows = table.filter(_any_of(partition_by, found))
    before = spark.conf.get(_ADVISORY, None)
    spark.conf.set(_ADVISORY, str(target_bytes))
    try:
        overwrite_partitions(rows, path, partition_by, gather=True)
    finally:
        if before is None:
            spark.conf.unset(_ADVISORY)
        else:
            spark.conf.set(_ADVISORY, before)
    return len(found)
