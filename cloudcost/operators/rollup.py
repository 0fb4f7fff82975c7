"""Daily tables -> service-level billing rows (A5-A10), union (U1), category.

In-month rows keep their usage date; outside-of-month rows (billing month
differs from the usage month) are re-dated to the last day of the billing
month and flagged. A NULL billing month fails both tests and is dropped.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import config as C
from ..functions.classify import billing_type_class
from ..functions.dates import first_of_month, same_month

SLB_KEYS = ["usage_date", "cloud_provider", "billing_account_id", "usage_account_id",
            "service_code", "billing_type", "is_li_outside_of_month"]
SLB_COLUMNS = ["usage_date", "cloud_provider", "billing_account_id", "usage_account_id",
               "usage_account_name", "service_code", "service_name", "billing_type",
               "is_li_outside_of_month", "cost", "ext_cost"]


def _rollup(df: DataFrame, provider: str, outside: bool | None, date_col: str, ws: dt.date, we: dt.date,
            billing_account: Column, usage_account: Column, account_name: Column | None,
            service_code: Column, service_name: Column, billing_type: Column,
            cost: Column, ext_cost: Column) -> DataFrame:
    """In-month and outside-of-month rows of one provider.

    ``outside=None`` computes both in ONE scan and ONE aggregation: the flag is
    a grouping column, so the two row sets never mix. ``True``/``False`` keep
    only one of them.
    """
    d = F.col(date_col)
    bm = F.col("billing_month")
    in_month = d.between(F.lit(ws), F.lit(we)) & same_month(bm, d)
    out_month = (bm >= F.lit(ws)) & ~same_month(bm, d)
    cond = in_month if outside is False else out_month if outside is True else (in_month | out_month)
    # either branch implies this bound, which prunes the month partitions of the table
    cond = cond & (bm >= F.lit(first_of_month(ws)))
    flag = ~same_month(bm, d)
    rows = df.filter(cond).select(
        F.when(flag, F.last_day(bm)).otherwise(d).alias("usage_date"),
        billing_account.alias("billing_account_id"),
        usage_account.alias("usage_account_id"),
        (account_name if account_name is not None else F.lit(None).cast("string")).alias("_uan"),
        service_code.alias("service_code"),
        service_name.alias("_sn"),
        billing_type.alias("billing_type"),
        flag.alias("is_li_outside_of_month"),
        cost.alias("_c"), ext_cost.alias("_e"))
    g = rows.groupBy("usage_date", "billing_account_id", "usage_account_id", "service_code",
                     "billing_type", "is_li_outside_of_month").agg(
        F.max("_uan").alias("usage_account_name"),
        F.max("_sn").alias("service_name"),
        F.sum("_c").cast(C.MONEY).alias("cost"),
        F.sum("_e").cast(C.MONEY).alias("ext_cost"))
    return g.select(
        "usage_date", F.lit(provider).alias("cloud_provider"), "billing_account_id",
        "usage_account_id", "usage_account_name", "service_code", "service_name", "billing_type",
        "is_li_outside_of_month", "cost", "ext_cost")


def rollup_huawei(hw: DataFrame, ws: dt.date, we: dt.date, outside: bool | None = False) -> DataFrame:
    """cost = consume amount, ext cost = external official amount."""
    return _rollup(hw, C.HWC, outside, "bill_date", ws, we,
                   F.col("payer_account_id"), F.col("customer_id"), None,
                   F.col("cloud_service_type"), F.col("cloud_service_type_name"),
                   F.col("bill_type").cast("string"),
                   F.col("consume_amount"), F.col("ext_official_amount"))


def rollup_gcp(gcp: DataFrame, ws: dt.date, we: dt.date, outside: bool | None = False) -> DataFrame:
    """cost = cost + credits (NULL as 0), both internal and external."""
    z = F.lit(0).cast(C.MONEY)
    return _rollup(gcp, C.GCP, outside, "usage_date", ws, we,
                   F.col("billing_account_id"), F.col("project_id"), F.col("project_name"),
                   F.col("service_code"), F.col("service_name"), F.col("cost_type"),
                   F.coalesce("cost", z) + F.coalesce("credits", z),
                   F.coalesce("ext_cost", z) + F.coalesce("ext_credits", z))


def rollup_aws(aws: DataFrame, ws: dt.date, we: dt.date, outside: bool | None = False) -> DataFrame:
    """cost = unblended, ext cost = external unblended; no billing account."""
    return _rollup(aws, C.AWS, outside, "usage_date", ws, we,
                   F.lit(""), F.col("usage_account_id"), None,
                   F.col("service_code"), F.col("service_name"), F.col("billing_type"),
                   F.col("unblended_cost"), F.col("ext_unblended_cost"))


def service_level_rows(aws: DataFrame, gcp: DataFrame, hw: DataFrame, ws: dt.date, we: dt.date) -> DataFrame:
    """The six rollups (three fused in/outside-month aggregations) in one frame."""
    return (rollup_huawei(hw, ws, we, None)
            .unionByName(rollup_gcp(gcp, ws, we, None))
            .unionByName(rollup_aws(aws, ws, we, None)))


def with_parent_category(slb: DataFrame, service_types: DataFrame) -> DataFrame:
    """Parent category of each row.

    * service code ``''``  -> class of the billing type (C2);
    * known (code, provider) -> its category, or the billing-type class when
      that category is ``''``;
    * anything else (NULL code included) -> ``Unknown``.

    The service-type table is a catalogue; it is de-duplicated per key, so it
    can never multiply rows.
    """
    st = (service_types.groupBy(F.col("code").alias("_code"), F.col("cloud_provider").alias("_cp"))
          .agg(F.max("parent_category").alias("_pc"))
          .withColumn("_hit", F.lit(True)))
    j = slb.join(st, (slb["service_code"] == st["_code"]) & (slb["cloud_provider"] == st["_cp"]), "left")
    cls = billing_type_class(F.col("billing_type"))
    cat = (F.when(F.col("service_code") == "", cls)
           .when(F.col("_hit") & (F.col("_pc") == ""), cls)
           .when(F.col("_hit"), F.col("_pc"))
           .otherwise(F.lit(C.UNKNOWN_CATEGORY)))
    return j.select(*slb.columns, cat.alias("parent_category"))
