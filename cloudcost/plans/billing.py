"""Service-level billing (F4), daily contract pricing (F5), monthly invoice
and customer daily cost (F7)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .. import config as C
from ..functions.dates import add_months, first_of_month, previous_month, rollup_window, same_month
from ..operators import costs, pricing, rollup
from ..operators.merge import Batch, keyed_merge, upsert_all, window_delete

SLB_OUT = rollup.SLB_COLUMNS[:9] + ["parent_category", "cost", "ext_cost", "last_updated_at"]


def service_level_billing(aws_daily: DataFrame, gcp_daily: DataFrame, hw_daily: DataFrame,
                          service_types: DataFrame, as_of: dt.date, run_ts: dt.datetime,
                          existing: DataFrame | None = None) -> DataFrame:
    """six rollups over the rewrite window -> category -> upsert (every non-key
    column replaced) -> purge window rows this run did not touch (K10)."""
    ws, we = rollup_window(as_of)
    rows = rollup.with_parent_category(rollup.service_level_rows(aws_daily, gcp_daily, hw_daily, ws, we),
                                       service_types)
    rows = rows.withColumn("last_updated_at", F.lit(run_ts).cast("timestamp")).select(*SLB_OUT)
    if existing is None:
        return rows
    merged = upsert_all(existing.select(*SLB_OUT), rows, rollup.SLB_KEYS)
    return purge_stale(merged, ws, run_ts)


def purge_stale(slb: DataFrame, window_start: dt.date, run_ts: dt.datetime) -> DataFrame:
    """Drop rows in the window that the last run did not write."""
    return window_delete(slb, (F.col("usage_date") >= F.lit(window_start))
                         & (F.col("last_updated_at") < F.lit(run_ts).cast("timestamp")))


def daily_pricing_job(pricing_rows: DataFrame, as_of: dt.date, existing: DataFrame | None = None) -> DataFrame:
    """F5 + K6: expand contract prices to days and upsert (fees replaced)."""
    d = pricing.daily_org_pricing(pricing_rows, as_of)
    if existing is None:
        return d
    return upsert_all(existing.select(*d.columns), d, pricing.DAILY_KEYS)


def monthly_invoice(slb: DataFrame, products: DataFrame, organizations: DataFrame,
                    product_accounts: DataFrame, daily_pricing: DataFrame, pricing_rows: DataFrame,
                    billings: DataFrame, as_of: dt.date) -> DataFrame:
    """one invoice per (product, provider) for the previous month.

    cost = after-discount cost (A14, daily pricing); handling/support fees from
    the pricing in force on ``as_of`` (W3), 2 decimals half-up; invoice numbers
    continue each product's sequence in provider order.
    """
    start, end = previous_month(as_of)
    prods = costs.products_with_org(products, organizations)
    pc = costs.invoice_provider_cost(slb, prods, product_accounts, daily_pricing, start, end)
    last = costs.latest_invoice_number(billings).withColumnRenamed("invoice_number", "_last")
    act = pricing.active_pricing(pricing_rows, as_of).select(
        "organization_id", "cloud_provider", F.col("handling_fee").alias("_h"), F.col("support_fee").alias("_s"))
    j = pc.join(last, "product_id", "left").join(act, ["organization_id", "cloud_provider"], "left")
    w = Window.partitionBy("product_id").orderBy("cloud_provider")
    created = dt.date(start.year, start.month, C.INVOICE_DAY_OF_MONTH)
    return j.select(
        F.lit(start).alias("month_date"), "product_id", "organization_id", "cloud_provider",
        F.col("cost").cast(C.MONEY).alias("cost"),
        costs.fee_of(F.col("cost"), F.col("_h")).alias("handling_fee"),
        costs.fee_of(F.col("cost"), F.col("_s")).alias("support_fee"),
        (F.coalesce(F.col("_last"), F.lit(0).cast("bigint")) + F.row_number().over(w)).cast("bigint")
        .alias("invoice_number"),
        F.lit(created).alias("created_date"),
        F.lit(add_months(created, 1)).alias("due_date"))


def customer_daily_cost(slb: DataFrame, aws_daily: DataFrame, products: DataFrame, organizations: DataFrame,
                        product_accounts: DataFrame, daily_pricing: DataFrame, amortized: DataFrame,
                        billing_entity_map: DataFrame, as_of: dt.date, hwc_factor: str = "0.45") -> DataFrame:
    """per external product, day and provider: what the reseller pays
    (payer cost) and what the customer is charged.

    payer cost: HWC cost x factor; GCP after-discount cost; AWS regular org:
    in-month + outside-month net cost of that date; AWS exceptional org: the
    amortized cost of the product's billing entity (0 without one). Only
    (day, provider) pairs with customer cost rows are emitted.
    """
    start = add_months(first_of_month(as_of), -1)
    prods = costs.products_with_org(products, organizations, external_only=True)
    k = ["product_id", "organization_id", "usage_date", "cloud_provider"]
    z = F.lit(0).cast(C.MONEY)
    none = F.lit(None).cast(C.MONEY)
    # customer-cost rows (A13 input) and AWS payer-cost rows (A15/A16 input) are
    # unioned and aggregated ONCE on (product, org, day, provider): one shuffle
    # instead of three aggregations and two shuffle joins
    cc_rows = costs.costs_with_pricing(slb, prods, product_accounts, daily_pricing, start, as_of).select(
        *k, "c", "ad", "hf", "sf", none.alias("_in"), none.alias("_out"), F.lit(True).alias("_cc"))
    acc = costs.product_account_map(prods, product_accounts)
    # both branches below imply the bound on the billing month, which prunes the table
    a = aws_daily.filter((F.col("billing_type") != "Tax") & (F.col("billing_month") >= F.lit(start)))
    inm = (a.filter(F.col("usage_date").between(F.lit(start), F.lit(as_of))
                    & same_month(F.col("usage_date"), F.col("billing_month")))
           .select("usage_account_id", "usage_date", F.col("net_unblended_cost").alias("_in"),
                   none.alias("_out")))
    outm = (a.filter(~same_month(F.col("usage_date"), F.col("billing_month")))
            .select("usage_account_id", F.last_day("billing_month").alias("usage_date"),
                    none.alias("_in"), F.col("net_unblended_cost").alias("_out")))
    payer = inm.unionByName(outm)
    payer = payer.join(acc, payer["usage_account_id"] == acc["account_id"]).select(
        "product_id", "organization_id", "usage_date", F.lit(C.AWS).alias("cloud_provider"),
        none.alias("c"), none.alias("ad"), none.alias("hf"), none.alias("sf"), "_in", "_out",
        F.lit(False).alias("_cc"))
    g = cc_rows.unionByName(payer).groupBy(*k).agg(
        F.sum("c").cast(C.MONEY).alias("cost"),
        F.sum("ad").cast(C.MONEY).alias("after_discount_cost"),
        F.sum("hf").cast(C.MONEY).alias("handling_fee"),
        F.sum("sf").cast(C.MONEY).alias("support_fee"),
        F.sum("_in").alias("_in"), F.sum("_out").alias("_out"),
        F.max("_cc").alias("_cc"))
    cc = g.filter("_cc")   # only (day, provider) pairs that have customer-cost rows
    am = (amortized.join(billing_entity_map, "billing_entity")
          .select("product_id", "usage_date", F.col("cost").alias("_am")))
    aws = F.col("cloud_provider") == C.AWS
    j = (cc.join(prods, ["product_id", "organization_id"])
         .join(am, ["product_id", "usage_date"], "left"))
    regular_aws = (F.coalesce("_in", z) + F.coalesce("_out", z)).cast(C.MONEY)
    payer_cost = (F.when(F.col("cloud_provider") == C.HWC,
                         (F.col("cost") * F.lit(hwc_factor).cast("decimal(9,6)")).cast(C.MONEY))
                  .when(aws & F.col("exceptional"), F.coalesce("_am", z))
                  .when(aws, regular_aws)
                  .otherwise(F.col("after_discount_cost")))
    return j.select(
        F.col("usage_date").alias("day"),
        F.col("organization_id").alias("mc_org_id"),
        F.col("organization_name").alias("mc_org_name"),
        F.col("product_name").alias("customer_name"),
        "cloud_provider",
        payer_cost.cast(C.MONEY).alias("payer_cost"),
        (F.col("after_discount_cost") + F.col("handling_fee") + F.col("support_fee")).cast(C.MONEY)
        .alias("customer_cost"),
        (~F.col("internal")).alias("external"))


CDC_KEYS = ["day", "mc_org_id", "customer_name", "cloud_provider"]


def customer_cost_upsert(existing: DataFrame, new_rows: DataFrame) -> DataFrame:
    """K7: upsert customer daily cost; only the two costs are replaced."""
    return keyed_merge(existing, [Batch(new_rows, ["payer_cost", "customer_cost"])], CDC_KEYS,
                       new_rows.columns)
