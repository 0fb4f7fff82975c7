"""The daily and service-level tables as bucketed catalog tables (see operators/bucketed.py)."""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from .. import schemas as S
from ..operators.bucketed import BucketedTable
from ..operators.rollup import SLB_KEYS


def _with_month(schema: StructType, month: str) -> StructType:
    return schema if month in schema.names else StructType(schema.fields).add(month, "date")


def aws_table(spark: SparkSession, name: str, path: str, schema: StructType, buckets: int) -> BucketedTable:
    """K2: by billing month, which is part of the key."""
    return BucketedTable(spark, name, path, S.AWS_KEYS, S.AWS_COLUMNS, "billing_month", buckets).attach(schema)


def gcp_table(spark: SparkSession, name: str, path: str, schema: StructType, buckets: int) -> BucketedTable:
    """K3: by usage month; the billing month is a descriptor and may change."""
    return BucketedTable(spark, name, path, S.GCP_KEYS, S.GCP_COLUMNS, "usage_month", buckets,
                         F.trunc("usage_date", "MM")).attach(_with_month(schema, "usage_month"))


def huawei_table(spark: SparkSession, name: str, path: str, schema: StructType, buckets: int) -> BucketedTable:
    """K4: by billing month."""
    return BucketedTable(spark, name, path, S.HWC_KEYS, S.HWC_COLUMNS, "billing_month", buckets).attach(schema)


def service_level_table(spark: SparkSession, name: str, path: str, schema: StructType, buckets: int) -> BucketedTable:
    """K5: by usage month; every column but the key is replaced."""
    return BucketedTable(spark, name, path, SLB_KEYS, schema.names, "usage_month", buckets,
                         F.trunc("usage_date", "MM")).attach(_with_month(schema, "usage_month"))
