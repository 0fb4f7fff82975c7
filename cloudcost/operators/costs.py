"""Customer-side costs: products with organizations (J4), product accounts
(J2 semi join), daily pricing join (J3), per-day customer cost (A13), monthly
provider cost (A14), payer cost in/outside the month (A15/A16).

The reference computes these one product at a time (N+1 queries). Here the
product is a grouping column: one plan for all products. The account list is
a dimension: Spark broadcasts it below its size threshold; above, the join
shuffles and AQE splits a hot account (a third of all billing rows).
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import config as C
from ..functions.dates import same_month
from ..functions.money import after_discount, pct_of

PRODUCT_COLS = ["product_id", "product_name", "organization_id", "organization_name",
                "internal", "exceptional"]


def products_with_org(products: DataFrame, organizations: DataFrame,
                      external_only: bool = False) -> DataFrame:
    """J4 (+P14): products joined to their organization; optionally external only."""
    org = organizations.select(F.col("id").alias("organization_id"),
                               F.col("name").alias("organization_name"), "internal", "exceptional")
    if external_only:
        org = org.filter(~F.col("internal"))
    p = products.select(F.col("id").alias("product_id"), F.col("name").alias("product_name"),
                        "organization_id")
    return p.join(org, "organization_id").select(*PRODUCT_COLS)


def product_account_map(prods: DataFrame, product_accounts: DataFrame) -> DataFrame:
    """(product, organization, account) of the given products, de-duplicated so a
    repeated account row never multiplies costs (IN-subquery semantics). The
    provider of the account is not compared (as in the reference)."""
    pa = product_accounts.select("product_id", "organization_id", "account_id").distinct()
    return pa.join(prods, ["product_id", "organization_id"], "left_semi")


def accounts_by_org_provider(product_accounts: DataFrame, organization_id: int, provider: str) -> DataFrame:
    """S9 finder: accounts of one organization and provider."""
    return (product_accounts.filter((F.col("organization_id") == organization_id)
                                    & (F.col("cloud_provider") == provider))
            .select("product_id", "organization_id", "account_id", "cloud_provider"))


def organization_by_id(organizations: DataFrame, organization_id: int) -> DataFrame:
    """S9 finder: one organization by id."""
    return organizations.filter(F.col("id") == organization_id)


def costs_with_pricing(slb: DataFrame, prods: DataFrame, product_accounts: DataFrame,
                        daily_pricing: DataFrame, start: dt.date, end: dt.date) -> DataFrame:
    """Service-level rows of each product's accounts in [start, end], with the
    daily pricing of the product's organization (unmatched -> 0 %)."""
    acc = product_account_map(prods, product_accounts)
    acc = acc.join(prods.select("product_id", "organization_id", "internal"),
                   ["product_id", "organization_id"])
    rows = (slb.filter(F.col("usage_date").between(F.lit(start), F.lit(end)))
            .select("usage_date", "cloud_provider", "usage_account_id", "cost", "ext_cost"))
    j = rows.join(acc, rows["usage_account_id"] == acc["account_id"])
    dp = (daily_pricing.filter(F.col("pricing_date").between(F.lit(start), F.lit(end)))
          .select(F.col("pricing_date").alias("usage_date"), "organization_id", "cloud_provider",
                  "discount", "handling_fee", "support_fee"))
    # daily prices of a window: organizations x providers x days
    j = j.join(dp, ["usage_date", "organization_id", "cloud_provider"], "left")
    z = F.lit(0).cast(C.MONEY)
    c = F.when(F.col("internal"), F.coalesce("cost", z)).otherwise(F.coalesce("ext_cost", z))
    ad = after_discount(c, F.col("discount"))
    return j.select("product_id", "organization_id", "usage_date", "cloud_provider",
                    c.alias("c"), ad.alias("ad"),
                    pct_of(ad, F.col("handling_fee")).cast(C.MONEY).alias("hf"),
                    pct_of(ad, F.col("support_fee")).cast(C.MONEY).alias("sf"))


def customer_cost_per_day(slb: DataFrame, prods: DataFrame, product_accounts: DataFrame,
                          daily_pricing: DataFrame, start: dt.date, end: dt.date) -> DataFrame:
    """Per (product, organization, day, provider): cost, after-discount cost,
    handling fee, support fee (cost or external cost by the organization flag)."""
    x = costs_with_pricing(slb, prods, product_accounts, daily_pricing, start, end)
    return x.groupBy("product_id", "organization_id", "usage_date", "cloud_provider").agg(
        F.sum("c").cast(C.MONEY).alias("cost"),
        F.sum("ad").cast(C.MONEY).alias("after_discount_cost"),
        F.sum("hf").cast(C.MONEY).alias("handling_fee"),
        F.sum("sf").cast(C.MONEY).alias("support_fee"))


def invoice_provider_cost(slb: DataFrame, prods: DataFrame, product_accounts: DataFrame,
                          daily_pricing: DataFrame, start: dt.date, end: dt.date) -> DataFrame:
    """After-discount cost per (product, organization, provider) for a month."""
    x = costs_with_pricing(slb, prods, product_accounts, daily_pricing, start, end)
    return x.groupBy("product_id", "organization_id", "cloud_provider").agg(
        F.sum("ad").cast(C.MONEY).alias("cost"))


def _payer_rows(aws_daily: DataFrame, prods: DataFrame, product_accounts: DataFrame) -> DataFrame:
    acc = product_account_map(prods, product_accounts)
    a = aws_daily.filter(F.col("billing_type") != "Tax")  # NULL type drops, as in SQL
    return a.join(acc, a["usage_account_id"] == acc["account_id"])


def payer_cost_in_month(aws_daily: DataFrame, prods: DataFrame, product_accounts: DataFrame,
                        start: dt.date, end: dt.date) -> DataFrame:
    """In-month net unblended cost per product and usage day, tax excluded."""
    a = (aws_daily.filter(F.col("usage_date").between(F.lit(start), F.lit(end))
                          & same_month(F.col("usage_date"), F.col("billing_month"))))
    j = _payer_rows(a, prods, product_accounts)
    return j.groupBy("product_id", "organization_id", "usage_date").agg(
        F.coalesce(F.sum("net_unblended_cost"), F.lit(0)).cast(C.MONEY).alias("cost"))


def payer_cost_outside_month(aws_daily: DataFrame, prods: DataFrame, product_accounts: DataFrame,
                             start: dt.date) -> DataFrame:
    """Outside-of-month net cost per product, dated last day of the billing month."""
    a = aws_daily.filter(~same_month(F.col("usage_date"), F.col("billing_month"))
                         & (F.col("billing_month") >= F.lit(start)))
    j = _payer_rows(a, prods, product_accounts)
    return j.groupBy("product_id", "organization_id",
                     F.last_day("billing_month").alias("usage_date")).agg(
        F.coalesce(F.sum("net_unblended_cost"), F.lit(0)).cast(C.MONEY).alias("cost"))


def latest_invoice_number(billings: DataFrame) -> DataFrame:
    """Highest invoice number per product (missing product -> 0 at use)."""
    return billings.groupBy("product_id").agg(F.max("invoice_number").alias("invoice_number"))


def fee_of(cost: Column, pct: Column) -> Column:
    """Invoice fee: cost * pct / 100 rounded half-up to 2 places; NULL cost -> 0."""
    return F.when(cost.isNull(), F.lit(0).cast(C.FEE2)).otherwise(pct_of(cost, pct).cast(C.FEE2))
