"""AWS Cost and Usage Report scans (v1 year/month partitions, v2 billing_period,
pre-aggregated views) with the billing-period and usage-window predicates.

All predicates are written so that Catalyst can use them: the period test is on
the bare partition columns (partition pruning), the usage-date test is on the
raw timestamp (parquet filter pushdown).
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.dates import add_months, first_of_month, ts_date_between, ts_date_from

TS = "line_item_usage_start_date"


@dataclass(frozen=True)
class CurLayout:
    """Column differences between report versions."""
    billing_month: str          # SQL expression giving the billing month DATE
    service_name: str           # SQL expression of the service name
    region: str                 # region column
    version: int


V1 = CurLayout("make_date(cast(year as int), cast(month as int), 1)",
               "product_servicename", "product_region", 1)
V2 = CurLayout("to_date(concat(billing_period, '-01'))",
               "try_element_at(product, 'servicename')", "product_region_code", 2)


def read_cur(spark: SparkSession, path: str) -> DataFrame:
    """Scan a CUR parquet dataset (partition columns are discovered)."""
    return spark.read.parquet(path)


def period_predicate(layout: CurLayout, year: int, month: int) -> Column:
    """One billing period, on the partition columns."""
    if layout.version == 1:
        return (F.col("year").cast("int") == year) & (F.col("month").cast("int") == month)
    return F.col("billing_period") == f"{year:d}-{month:02d}"


def periods_predicate(layout: CurLayout, lo: dt.date, hi: dt.date) -> Column:
    """Billing periods lo..hi (first days of month), on the partition columns."""
    if layout.version == 1:
        ym = F.col("year").cast("int") * 12 + F.col("month").cast("int")
        return ym.between(lo.year * 12 + lo.month, hi.year * 12 + hi.month)
    return F.col("billing_period").between(f"{lo.year:d}-{lo.month:02d}", f"{hi.year:d}-{hi.month:02d}")


def usage_window_predicate(start: dt.date, end: dt.date, ts: str = TS) -> Column:
    """``date in [start, end] OR date >= first of the month after end``.

    The tail picks up lines dated after the period end that are billed in it;
    lines dated before ``start`` are not read.
    """
    tail = first_of_month(add_months(first_of_month(end), 1))
    return ts_date_between(ts, start, end) | ts_date_from(ts, tail)


def scan_period(cur: DataFrame, layout: CurLayout, start: dt.date, end: dt.date) -> DataFrame:
    """The lines one (start, end) slice of one billing period reads."""
    return cur.filter(period_predicate(layout, start.year, start.month)
                      & usage_window_predicate(start, end))


def scan_window(cur: DataFrame, layout: CurLayout, ws: dt.date, we: dt.date) -> DataFrame:
    """The union of all slice reads of a multi-month window, in one pass.

    For every billing period P with first day in [month(ws), month(we)] a line
    is read when its usage date lies in [max(ws, P), min(we, last_day(P))] or is
    on/after the first day of the month after P. Every such line is dated on or
    after ``ws``; that bound is added as a pushable conjunct.
    """
    bm = F.expr(layout.billing_month)
    d = F.to_date(TS)
    per_period = ((d >= F.greatest(F.lit(ws), bm)) & (d <= F.least(F.lit(we), F.last_day(bm)))) \
        | (d >= F.add_months(bm, 1))
    return cur.filter(periods_predicate(layout, first_of_month(ws), first_of_month(we))
                      & ts_date_from(TS, ws) & per_period)


def scan_view(view: DataFrame, start: dt.date, end: dt.date) -> DataFrame:
    """S3: pre-aggregated amortized view, one period, same window rule, costs
    renamed to the daily shape (blended/net are zero placeholders)."""
    y, m = start.year, start.month
    tail = first_of_month(add_months(first_of_month(end), 1))
    in_period = (F.col("year").cast("int") == y) & (F.col("month").cast("int") == m)
    window = F.col("usage_date").between(F.lit(start), F.lit(end)) | (F.col("usage_date") >= F.lit(tail))
    zero = F.lit(0).cast("decimal(20,8)")
    return view.filter(in_period & window).select(
        "usage_date", "billing_month", "usage_account_id", "service_code", "service_name",
        "sku_id", "region", "location", "currency", "pricing_type", "billing_type", "usage_type",
        "usage_amount", "usage_unit",
        F.col("cost").cast("decimal(20,8)").alias("unblended_cost"),
        zero.alias("blended_cost"), zero.alias("net_unblended_cost"))
