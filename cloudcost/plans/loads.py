"""Ingest flows F1-F3: raw exports -> keyed daily tables (internal and external
measures), merged into the existing table."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import daily
from ..operators.merge import Batch, keyed_merge, window_delete
from ..sources import cur as cur_src
from ..sources.catalog import union_catalog_tables
from ..functions.dates import add_months, first_of_month


def union_tables(spark: SparkSession, names: list[str]) -> DataFrame:
    """S7 body: read the named tables or views alike, reconcile their columns, union them."""
    return union_catalog_tables(spark, names)


def list_tables(spark: SparkSession, prefix: str, exclude: set[str], database: str | None = None) -> list[str]:
    """Tables of a database (temp views included) with a name prefix, minus
    the excluded names; sorted so the plan is stable."""
    tabs = spark.catalog.listTables(database) if database else spark.catalog.listTables()
    return sorted(t.name for t in tabs if t.name.startswith(prefix) and t.name not in exclude)


def scan_view_window(view: DataFrame, ws: dt.date, we: dt.date) -> DataFrame:
    """S3 over a whole window: per period P, usage dates in [max(ws,P), min(we,end of P)]
    or on/after the first of the month after P."""
    bm = F.make_date(F.col("year").cast("int"), F.col("month").cast("int"), F.lit(1))
    ym = F.col("year").cast("int") * 12 + F.col("month").cast("int")
    lo, hi = first_of_month(ws), first_of_month(we)
    d = F.col("usage_date")
    per = ((d >= F.greatest(F.lit(ws), bm)) & (d <= F.least(F.lit(we), F.last_day(bm)))) \
        | (d >= F.add_months(bm, 1))
    zero = F.lit(0).cast("decimal(20,8)")
    return view.filter(ym.between(lo.year * 12 + lo.month, hi.year * 12 + hi.month) & per).select(
        "usage_date", "billing_month", "usage_account_id", "service_code", "service_name",
        "sku_id", "region", "location", "currency", "pricing_type", "billing_type", "usage_type",
        "usage_amount", "usage_unit",
        F.col("cost").cast("decimal(20,8)").alias("unblended_cost"),
        zero.alias("blended_cost"), zero.alias("net_unblended_cost"))


def aws_cleanup_applies(as_of: dt.date, cleanup: bool) -> bool:
    """K9 runs only when asked for and only on a full-refresh day (the reload
    window then covers everything the delete removes)."""
    from .. import config as C
    return cleanup and as_of.day in C.AWS_FULL_REFRESH_DAYS


def aws_window_delete(existing: DataFrame, as_of: dt.date) -> DataFrame:
    """K9: before a reload, drop rows with usage date and billing month both on
    or after the first of the previous month."""
    d = add_months(first_of_month(as_of), -1)
    return window_delete(existing, (F.col("usage_date") >= F.lit(d)) & (F.col("billing_month") >= F.lit(d)))


@dataclass(frozen=True)
class AwsInput:
    """One source of the AWS load: a CUR table (``layout`` says which report version) or a
    pre-aggregated view, internal or external, with its own refresh window."""
    df: DataFrame
    kind: str                                # "internal", "external" or "view"
    window: tuple[dt.date, dt.date]
    layout: cur_src.CurLayout = cur_src.V1

    def batch(self) -> Batch:
        if self.kind == "view":
            rows = daily.aws_daily_from_view(scan_view_window(self.df, *self.window))
        else:
            rows = daily.aws_daily_cost_window(self.df, self.layout, *self.window, self.kind == "internal")
        own = daily.AWS_INTERNAL if self.kind == "internal" else daily.AWS_EXTERNAL
        return Batch(rows, daily.AWS_DESCRIPTORS + own)


def aws_merge(batches: list[Batch], existing: DataFrame | None) -> DataFrame:
    """Batches applied in order (the order is observable on the shared descriptors)."""
    return keyed_merge(existing, batches, daily.AWS_KEYS, daily.AWS_COLUMNS)


def aws_load(internal_cur: DataFrame, external_cur: DataFrame | None, views: DataFrame | None,
             ws: dt.date, we: dt.date, existing: DataFrame | None = None,
             layout: cur_src.CurLayout = cur_src.V1, delete_window_as_of: dt.date | None = None) -> DataFrame:
    """internal CUR -> internal measures; external CURs -> external measures;
    amortized views -> external measures; applied in that order."""
    if existing is not None and delete_window_as_of is not None:
        existing = aws_window_delete(existing, delete_window_as_of)
    inputs = [AwsInput(internal_cur, "internal", (ws, we), layout)]
    if external_cur is not None:
        inputs.append(AwsInput(external_cur, "external", (ws, we), layout))
    if views is not None:
        inputs.append(AwsInput(views, "view", (ws, we)))
    return aws_merge([i.batch() for i in inputs], existing)


def gcp_load(export: DataFrame | None, ws: dt.date, we: dt.date, existing: DataFrame | None = None,
             external_export: DataFrame | None = None) -> DataFrame:
    """internal and external export windows -> daily -> merge (billing month is a
    descriptor here)."""
    batches = [Batch(daily.gcp_daily_cost(df, ws, we, internal),
                     daily.GCP_DESCRIPTORS + (daily.GCP_INTERNAL if internal else daily.GCP_EXTERNAL))
               for df, internal in ((export, True), (external_export, False)) if df is not None]
    return keyed_merge(existing, batches, daily.GCP_KEYS, daily.GCP_COLUMNS)


def huawei_load(internal_records: DataFrame | None, external_records: DataFrame | None,
                ws: dt.date, we: dt.date, existing: DataFrame | None = None) -> DataFrame:
    """Huawei records (internal and external accounts) -> daily -> merge."""
    batches = []
    if internal_records is not None:
        batches.append(Batch(daily.huawei_daily_cost(internal_records, ws, we, True),
                             daily.HWC_DESCRIPTORS + daily.HWC_INTERNAL))
    if external_records is not None:
        batches.append(Batch(daily.huawei_daily_cost(external_records, ws, we, False),
                             daily.HWC_DESCRIPTORS + daily.HWC_EXTERNAL))
    return keyed_merge(existing, batches, daily.HWC_KEYS, daily.HWC_COLUMNS)
