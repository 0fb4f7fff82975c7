"""Named queries over the driver tables: one entry per operator/flow key of the
survey inventory. Each entry takes ``(spark, sf_dir)`` and returns a DataFrame.

The fixture parameters (as-of date, periods, entity lists) are fixed here and
mirrored by ``cloudcost.oracle``.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections import Counter
from collections.abc import Callable
from dataclasses import replace
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import config as C
from .functions.classify import billing_type_class
from .functions.dates import previous_month, refresh_window, rollup_window
from .operators import amortized, costs, daily, pricing, reports, rollup
from .operators.merge import Batch, append_new, keyed_merge, upsert_all
from .plans import billing, compaction, jobs, loads, tables
from .session import COMPRESSION, scratch_path, shuffles_freed
from .sources import catalog
from .sources import cur as cur_src
from .sources import files, relational
from .sources import fixtures as fx
from .streaming import incremental

AS_OF = fx.AS_OF
WS, WE = rollup_window(AS_OF)                 # 2001-02-01 .. 2001-08-15
PREV_START, PREV_END = previous_month(AS_OF)  # July 2001
RUN_TS = dt.datetime(2001, 8, 15, 6, 0, 0)
OLD_AS_OF = dt.date(2001, 7, 15)
OLD_RUN_TS = dt.datetime(2001, 7, 15, 6, 0, 0)
Y, M = fx.CUR_PERIOD
REPORT_LO, REPORT_HI = dt.date(2001, 7, 1), dt.date(2001, 7, 31)
UNCLASSIFIED_HI = dt.date(2001, 7, 7)
REFRESH_AS_OF = dt.date(2001, 7, 20)
ORG_FINDER = (2, C.AWS)
LATE_FROM = dt.date(2001, 7, 15)
# first run, full-refresh days, and days with a ten-day window that starts inside a month
GCP_RUNS = [dt.date(2001, 6, 25), dt.date(2001, 7, 3), dt.date(2001, 7, 12), dt.date(2001, 7, 21),
            dt.date(2001, 7, 30), dt.date(2001, 8, 2)]
HW_RUNS = [dt.date(2001, 6, 25), dt.date(2001, 7, 4), dt.date(2001, 7, 12), dt.date(2001, 7, 21),
           dt.date(2001, 7, 30), dt.date(2001, 8, 4), dt.date(2001, 8, 13), dt.date(2001, 8, 15)]
SOURCES_AS_OF = dt.date(2001, 7, 21)
CLEANUP_AS_OF = dt.date(2001, 8, 14)
HISTORY = (dt.date(1992, 1, 1), dt.date(2001, 12, 31))
SIDE_BY_SIDE = 64 << 20  # bytes of source files up to which the daily loads run at the same time
PURGE_START = dt.date(2001, 7, 1)
SLB_CMP = [c for c in billing.SLB_OUT if c != "last_updated_at"]


class Fixture:
    """Lazily built billing inputs and loaded tables over one driver folder."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.d = spark, sf_dir

    def _table(self, df: DataFrame, name: str) -> DataFrame:
        """Write a loaded table once (parquet under the shared checkpoint folder)
        and read it back: consumers then scan it with pruning and pushdown
        instead of re-deriving it from raw exports, and its lineage is cut."""
        path = scratch_path(self.spark, f"{name}-{uuid.uuid4().hex}")
        with shuffles_freed(self.spark):
            df.write.mode("overwrite").parquet(path, compression=COMPRESSION)
        # the schema is known: no footer-reading inference job on the way back
        return self.spark.read.schema(df.schema).parquet(path)

    # raw inputs ---------------------------------------------------------
    @cached_property
    def cur(self) -> DataFrame:
        return fx.landed_cur(self.spark, self.d)

    @cached_property
    def gcp_export(self) -> DataFrame:
        return fx.landed_gcp_export(self.spark, self.d)

    @cached_property
    def hw_records(self) -> DataFrame:
        return fx.landed_huawei_records(self.spark, self.d)

    @cached_property
    def hw_external_records(self) -> DataFrame:
        return fx.huawei_external_records(self.hw_records)

    @cached_property
    def gcp_external_export(self) -> DataFrame:
        return fx.gcp_external_export(self.gcp_export)

    @cached_property
    def org_accounts(self) -> DataFrame:
        return fx.landed_dimension(self.spark, self.d, "org_accounts")

    @cached_property
    def view(self) -> DataFrame:
        return fx.amortized_view(self.spark, self.d, self.cur)

    def external_cur(self) -> DataFrame:
        fx.register_cur_external_tables(self.spark, self.d, self.cur)
        names = loads.list_tables(self.spark, fx.CUR_EXT_PREFIX, {fx.EXCLUDED_CUR_TABLE})
        return loads.union_tables(self.spark, names)

    # dimensions ---------------------------------------------------------
    @cached_property
    def organizations(self) -> DataFrame:
        return fx.landed_dimension(self.spark, self.d, "organizations")

    @cached_property
    def products(self) -> DataFrame:
        return fx.landed_dimension(self.spark, self.d, "products")

    @cached_property
    def product_accounts(self) -> DataFrame:
        return fx.landed_dimension(self.spark, self.d, "product_accounts")

    @cached_property
    def pricing_rows(self) -> DataFrame:
        return fx.landed_dimension(self.spark, self.d, "organization_pricing")

    @cached_property
    def service_types(self) -> DataFrame:
        return fx.landed_dimension(self.spark, self.d, "service_types")

    @cached_property
    def billings(self) -> DataFrame:
        return fx.landed_dimension(self.spark, self.d, "existing_billings")

    @cached_property
    def billing_entity_map(self) -> DataFrame:
        return fx.landed_dimension(self.spark, self.d, "billing_entity_map")

    # loaded tables ------------------------------------------------------
    def _daily_job(self, name: str) -> DataFrame:
        if name == "aws_daily":
            return loads.aws_load(self.cur, self.external_cur(), self.view, WS, WE)
        if name == "gcp_daily":
            return loads.gcp_load(self.gcp_export, WS, WE, external_export=self.gcp_external_export)
        return loads.huawei_load(self.hw_records, self.hw_external_records, WS, WE)

    def _daily(self, name: str) -> DataFrame:
        done = self.__dict__.setdefault("_daily_tables", {})
        if name not in done:
            done[name] = self._table(self._daily_job(name), name)
        return done[name]

    def load_daily_tables(self) -> None:
        """F1-F3 are independent: small ones are submitted together from driver threads so the
        scheduler runs their stages side by side. Large ones fill the cores by themselves and run
        one after the other, so that the shuffles of only one are on disk."""
        from concurrent.futures import ThreadPoolExecutor
        todo = [n for n in ("aws_daily", "gcp_daily", "hw_daily") if n not in self.__dict__.get("_daily_tables", {})]
        if not todo:
            return
        workers = len(todo) if fx.source_bytes(self.spark, self.d) <= SIDE_BY_SIDE else 1
        with ThreadPoolExecutor(max_workers=workers) as pool:
            for done in [pool.submit(self._daily, n) for n in todo]:
                done.result()

    @property
    def aws_daily(self) -> DataFrame:
        return self._daily("aws_daily")

    @property
    def gcp_daily(self) -> DataFrame:
        return self._daily("gcp_daily")

    @property
    def hw_daily(self) -> DataFrame:
        return self._daily("hw_daily")

    def slb_at(self, as_of: dt.date, run_ts: dt.datetime) -> DataFrame:
        self.load_daily_tables()
        return billing.service_level_billing(self.aws_daily, self.gcp_daily, self.hw_daily,
                                             self.service_types, as_of, run_ts)

    @cached_property
    def slb(self) -> DataFrame:
        return self._table(self.slb_at(AS_OF, RUN_TS), "service_level")

    @cached_property
    def daily_pricing(self) -> DataFrame:
        return pricing.daily_org_pricing(self.pricing_rows, AS_OF)

    @cached_property
    def daily_pricing_window(self) -> DataFrame:
        """Daily pricing cut to the days the invoice / customer-cost runs read."""
        return pricing.daily_org_pricing(self.pricing_rows, AS_OF, clip=(PREV_START, AS_OF))

    @cached_property
    def external_products(self) -> DataFrame:
        return costs.products_with_org(self.products, self.organizations, external_only=True)

    @cached_property
    def amortized(self) -> DataFrame:
        # its own first step: written once, small, then joined like any table
        return self._table(amortized.amortized_two_month(self.cur, self.org_accounts, fx.AMORTIZED, AS_OF), "amortized")

    def customer_daily_cost(self) -> DataFrame:
        return billing.customer_daily_cost(self.slb, self.aws_daily, self.products, self.organizations,
                                           self.product_accounts, self.daily_pricing_window, self.amortized,
                                           self.billing_entity_map, AS_OF)

    def monthly_invoice(self) -> DataFrame:
        return billing.monthly_invoice(self.slb, self.products, self.organizations, self.product_accounts,
                                       self.daily_pricing_window, self.pricing_rows, self.billings, AS_OF)


Query = Callable[[SparkSession, str], DataFrame]
_REGISTRY: dict[str, Callable[[Fixture], DataFrame]] = {}


def query(name: str):
    def deco(fn: Callable[[Fixture], DataFrame]):
        _REGISTRY[name] = fn
        return fn
    return deco


def queries() -> dict[str, Query]:
    return {name: (lambda spark, sf_dir, _f=fn: _f(Fixture(spark, sf_dir))) for name, fn in _REGISTRY.items()}


# --- sources / scans -------------------------------------------------------

@query("cur_usage_window_filter")
def _q_p2(f: Fixture) -> DataFrame:
    rows = cur_src.scan_period(f.cur, cur_src.V1, fx.CUR_START, fx.CUR_END)
    return rows.select(F.to_date(cur_src.TS).alias("usage_date"), "line_item_usage_account_id",
                       "line_item_line_item_type", "line_item_unblended_cost")


@query("aws_amortized_view_load")
def _q_s3(f: Fixture) -> DataFrame:
    return cur_src.scan_view(f.view, fx.CUR_START, fx.CUR_END)


@query("multi_table_union")
def _q_s7(f: Fixture) -> DataFrame:
    return f.external_cur().select(F.to_date(cur_src.TS).alias("usage_date"), "line_item_usage_account_id",
                                   "line_item_line_item_type", "line_item_unblended_cost")


@query("catalog_fan_in")
def _q_s7b(f: Fixture) -> DataFrame:
    """Catalog tables of a database with an extra, a missing and a narrower column; one
    period, which prunes in the catalog."""
    database = f"external_{uuid.uuid4().hex}"
    fx.create_external_database(f.spark, f.d, database, f.cur)
    names = catalog.catalog_tables(f.spark, database, fx.CUR_EXT_PREFIX, {fx.EXCLUDED_CUR_TABLE})
    rows = catalog.union_catalog_tables(f.spark, names).filter(cur_src.period_predicate(cur_src.V1, Y, M))
    return rows.select(F.to_date(cur_src.TS).alias("usage_date"), "line_item_usage_account_id", "product_location",
                       "resource_tags_user_team", "line_item_usage_amount", "line_item_unblended_cost")


@query("huawei_json_explode")
def _q_s5(f: Fixture) -> DataFrame:
    recs = files.read_huawei_pages(f.spark, fx.landed_exports(f.spark, f.d)["huawei"])
    return daily.huawei_daily_cost(recs, WS, WE, True)


@query("csv_gzip_roundtrip")
def _q_s6(f: Fixture) -> DataFrame:
    a1 = daily.aws_daily_cost(f.cur, cur_src.V1, fx.CUR_START, fx.CUR_END, True)
    path = scratch_path(f.spark, f"cur-unload-{uuid.uuid4().hex}")
    files.unload_csv(a1, path)
    return files.read_daily_csv(f.spark, path, daily.AWS_COLUMNS)


@query("refresh_window_scan")
def _q_p16(f: Fixture) -> DataFrame:
    lo, hi = refresh_window(REFRESH_AS_OF, C.GCP, first_run=False)
    return daily.gcp_daily_cost(f.gcp_export, lo, hi, True)


@query("external_organizations")
def _q_s9a(f: Fixture) -> DataFrame:
    return f.organizations.filter(~F.col("internal")).select("id", "name", "internal", "exceptional")


@query("accounts_by_org_provider")
def _q_s9b(f: Fixture) -> DataFrame:
    return costs.accounts_by_org_provider(f.product_accounts, *ORG_FINDER)


@query("organization_by_id")
def _q_s9c(f: Fixture) -> DataFrame:
    return costs.organization_by_id(f.organizations, ORG_FINDER[0]).select("id", "name", "internal", "exceptional")


# --- daily aggregation ---------------------------------------------------------

@query("aws_daily_cost_v1")
def _q_a1(f: Fixture) -> DataFrame:
    return daily.aws_daily_cost(f.cur, cur_src.V1, fx.CUR_START, fx.CUR_END, True)


@query("aws_daily_cost_v2")
def _q_a2(f: Fixture) -> DataFrame:
    return daily.aws_daily_cost(fx.landed_cur_v2(f.spark, f.d), cur_src.V2, fx.CUR_START, fx.CUR_END, True)


@query("route_internal_external")
def _q_p10(f: Fixture) -> DataFrame:
    return daily.aws_daily_cost(f.cur, cur_src.V1, fx.CUR_START, fx.CUR_END, False)


@query("gcp_daily_cost")
def _q_a3(f: Fixture) -> DataFrame:
    return daily.gcp_daily_cost(f.gcp_export, WS, WE, True)


@query("huawei_daily_cost")
def _q_a4(f: Fixture) -> DataFrame:
    return daily.huawei_daily_cost(f.hw_records, WS, WE, True)


# --- merges / loads ------------------------------------------------------------

@query("merge_aws_internal_external")
def _q_k2(f: Fixture) -> DataFrame:
    i = daily.aws_daily_cost_window(f.cur, cur_src.V1, WS, WE, True)
    e = daily.aws_daily_cost_window(f.external_cur(), cur_src.V1, WS, WE, False)
    return keyed_merge(None, [Batch(i, daily.AWS_DESCRIPTORS + daily.AWS_INTERNAL),
                              Batch(e, daily.AWS_DESCRIPTORS + daily.AWS_EXTERNAL)],
                       daily.AWS_KEYS, daily.AWS_COLUMNS)


@query("merge_gcp_internal_external")
def _q_k3(f: Fixture) -> DataFrame:
    base = loads.gcp_load(f.gcp_export, WS, WE)
    return loads.gcp_load(None, WS, WE, existing=base, external_export=f.gcp_external_export)


@query("merge_huawei_internal_external")
def _q_k4(f: Fixture) -> DataFrame:
    base = loads.huawei_load(f.hw_records, None, WS, WE)
    return loads.huawei_load(None, f.hw_external_records, WS, WE, existing=base)


@query("aws_load")
def _q_f1(f: Fixture) -> DataFrame:
    return f.aws_daily


@query("gcp_load")
def _q_f2(f: Fixture) -> DataFrame:
    return f.gcp_daily


@query("huawei_load")
def _q_f3(f: Fixture) -> DataFrame:
    return f.hw_daily


@query("aws_window_delete")
def _q_k9(f: Fixture) -> DataFrame:
    return loads.aws_window_delete(f.aws_daily, AS_OF)


# --- service level ---------------------------------------------------------------

@query("rollup_aws")
def _q_a9(f: Fixture) -> DataFrame:
    return rollup.rollup_aws(f.aws_daily, WS, WE, False)


@query("rollup_aws_extra")
def _q_a10(f: Fixture) -> DataFrame:
    return rollup.rollup_aws(f.aws_daily, WS, WE, True)


@query("rollup_gcp")
def _q_a7(f: Fixture) -> DataFrame:
    return rollup.rollup_gcp(f.gcp_daily, WS, WE, False)


@query("rollup_gcp_extra")
def _q_a8(f: Fixture) -> DataFrame:
    return rollup.rollup_gcp(f.gcp_daily, WS, WE, True)


@query("rollup_huawei")
def _q_a5(f: Fixture) -> DataFrame:
    return rollup.rollup_huawei(f.hw_daily, WS, WE, False)


@query("rollup_huawei_extra")
def _q_a6(f: Fixture) -> DataFrame:
    return rollup.rollup_huawei(f.hw_daily, WS, WE, True)


@query("service_level_billing")
def _q_f4(f: Fixture) -> DataFrame:
    return f.slb.select(*SLB_CMP)


@query("service_category")
def _q_c1(f: Fixture) -> DataFrame:
    return f.slb.select("cloud_provider", "service_code", "billing_type", "parent_category").distinct()


@query("billing_type_class")
def _q_c2(f: Fixture) -> DataFrame:
    t = (f.aws_daily.select(F.lit(C.AWS).alias("cloud_provider"), "billing_type")
         .unionByName(f.gcp_daily.select(F.lit(C.GCP).alias("cloud_provider"),
                                         F.col("cost_type").alias("billing_type")))
         .unionByName(f.hw_daily.select(F.lit(C.HWC).alias("cloud_provider"),
                                        F.col("bill_type").cast("string").alias("billing_type")))
         .distinct())
    return t.select("cloud_provider", "billing_type", billing_type_class(F.col("billing_type")).alias("billing_class"))


def _slb_history(f: Fixture) -> DataFrame:
    """An earlier run's table plus rows of services that no longer bill."""
    old = f.slb_at(OLD_AS_OF, OLD_RUN_TS)
    codes = F.array("service_code", F.concat("service_code", F.lit("-retired")))
    return old.select(*[F.explode(codes).alias(c) if c == "service_code" else F.col(c) for c in old.columns])


@query("service_level_upsert")
def _q_k5(f: Fixture) -> DataFrame:
    return upsert_all(_slb_history(f), f.slb, rollup.SLB_KEYS).select(*SLB_CMP)


@query("service_level_purge_stale")
def _q_k10(f: Fixture) -> DataFrame:
    merged = upsert_all(_slb_history(f), f.slb, rollup.SLB_KEYS)
    return billing.purge_stale(merged, PURGE_START, RUN_TS).select(*SLB_CMP)


# --- pricing ----------------------------------------------------------------------

@query("pricing_validity_intervals")
def _q_w1(f: Fixture) -> DataFrame:
    return pricing.pricing_validity_intervals(f.pricing_rows, AS_OF)


@query("date_spine")
def _q_u3(f: Fixture) -> DataFrame:
    return pricing.date_spine(f.spark, f.pricing_rows, AS_OF)


@query("daily_org_pricing")
def _q_f5(f: Fixture) -> DataFrame:
    return f.daily_pricing


@query("active_pricing")
def _q_w3(f: Fixture) -> DataFrame:
    return pricing.active_pricing(f.pricing_rows, AS_OF)


@query("daily_pricing_upsert")
def _q_k6(f: Fixture) -> DataFrame:
    old_rows = f.pricing_rows.filter(F.col("organization_id") % 2 == 0)
    old = pricing.daily_org_pricing(old_rows.withColumn("discount", F.col("discount") + F.lit(1)), OLD_AS_OF)
    return billing.daily_pricing_job(f.pricing_rows, AS_OF, existing=old)


# --- customer side ---------------------------------------------------------------

@query("products_with_org")
def _q_j4(f: Fixture) -> DataFrame:
    return costs.products_with_org(f.products, f.organizations)


@query("product_cost_semi_join")
def _q_j2(f: Fixture) -> DataFrame:
    prods = costs.products_with_org(f.products, f.organizations)
    acc = costs.product_account_map(prods, f.product_accounts)
    rows = f.slb.filter(F.col("usage_date").between(F.lit(PREV_START), F.lit(PREV_END)))
    j = rows.join(acc, rows["usage_account_id"] == acc["account_id"])
    return j.select("product_id", "organization_id", "usage_date", "cloud_provider", "usage_account_id",
                    "service_code", "billing_type", "is_li_outside_of_month", "cost", "ext_cost")


@query("customer_cost_per_day")
def _q_a13(f: Fixture) -> DataFrame:
    return costs.customer_cost_per_day(f.slb, f.external_products, f.product_accounts, f.daily_pricing_window,
                                       PREV_START, AS_OF)


@query("invoice_provider_cost")
def _q_a14(f: Fixture) -> DataFrame:
    prods = costs.products_with_org(f.products, f.organizations)
    return costs.invoice_provider_cost(f.slb, prods, f.product_accounts, f.daily_pricing_window, PREV_START, PREV_END)


@query("payer_cost_in_month")
def _q_a15(f: Fixture) -> DataFrame:
    return costs.payer_cost_in_month(f.aws_daily, f.external_products, f.product_accounts, PREV_START, AS_OF)


@query("payer_cost_outside_month")
def _q_a16(f: Fixture) -> DataFrame:
    return costs.payer_cost_outside_month(f.aws_daily, f.external_products, f.product_accounts, PREV_START)


@query("latest_invoice_number")
def _q_t1(f: Fixture) -> DataFrame:
    return costs.latest_invoice_number(f.billings)


@query("monthly_invoice")
def _q_f6(f: Fixture) -> DataFrame:
    return f.monthly_invoice()


@query("invoice_append_new")
def _q_k8(f: Fixture) -> DataFrame:
    inv = f.monthly_invoice()
    guard = ["month_date", "product_id", "cloud_provider"]
    once = append_new(f.billings, inv, guard)
    return append_new(once, inv, guard)  # a replayed run appends nothing


@query("customer_daily_cost")
def _q_f7(f: Fixture) -> DataFrame:
    return f.customer_daily_cost()


@query("customer_cost_upsert")
def _q_k7(f: Fixture) -> DataFrame:
    new = f.customer_daily_cost()
    old = new.select(*[F.concat(F.lit("old-"), F.col(c)).alias(c) if c == "mc_org_name"
                       else F.lit(0).cast(C.MONEY).alias(c) if c in ("payer_cost", "customer_cost")
                       else F.lit(False).alias(c) if c == "external" else F.col(c) for c in new.columns])
    return billing.customer_cost_upsert(old, new)


# --- amortized ---------------------------------------------------------------------

@query("join_org_accounts")
def _q_j1(f: Fixture) -> DataFrame:
    j = amortized.join_org_accounts(f.cur, f.org_accounts, fx.AMORTIZED.entities, Y, M)
    return j.select(F.to_date(cur_src.TS).alias("usage_date"), "line_item_usage_account_id",
                    "billing_entity", "line_item_line_item_type", "line_item_net_unblended_cost")


@query("amortized_cost_by_entity")
def _q_a11(f: Fixture) -> DataFrame:
    return amortized.amortized_cost_by_entity(f.cur, f.org_accounts, fx.AMORTIZED, Y, M)


@query("amortized_cost_tagged")
def _q_a12(f: Fixture) -> DataFrame:
    return amortized.amortized_cost_tagged(f.cur, fx.AMORTIZED, Y, M)


@query("amortized_two_month")
def _q_u2(f: Fixture) -> DataFrame:
    return f.amortized


# --- reports -------------------------------------------------------------------------

@query("report_product_cost")
def _q_d1(f: Fixture) -> DataFrame:
    return reports.report_product_cost(f.cur, Y, M)


@query("report_unclassified_lines")
def _q_d2(f: Fixture) -> DataFrame:
    return reports.report_unclassified_lines(f.cur, Y, M, REPORT_LO, UNCLASSIFIED_HI)


@query("report_distinct_entities")
def _q_d3(f: Fixture) -> DataFrame:
    return reports.report_distinct_entities(f.cur, f.org_accounts, Y, M)


@query("report_entity_accounts")
def _q_d4(f: Fixture) -> DataFrame:
    return reports.report_entity_accounts(f.cur, f.org_accounts, fx.AMORTIZED.entities, Y, M)


@query("report_entity_account_list")
def _q_d5(f: Fixture) -> DataFrame:
    return reports.report_entity_account_list(f.org_accounts)


@query("report_entity_cost")
def _q_d6(f: Fixture) -> DataFrame:
    return reports.report_entity_cost(f.cur, f.org_accounts, Y, REPORT_LO, REPORT_HI)


@query("report_account_cost")
def _q_d7(f: Fixture) -> DataFrame:
    return reports.report_account_cost(f.cur, Y, REPORT_LO, REPORT_HI)


@query("report_total_cost")
def _q_d7b(f: Fixture) -> DataFrame:
    return reports.report_total_cost(f.cur, Y, REPORT_LO, REPORT_HI)


@query("report_dimension_entities")
def _q_d3b(f: Fixture) -> DataFrame:
    return reports.report_dimension_entities(f.org_accounts)


@query("report_daily_cost")
def _q_d8(f: Fixture) -> DataFrame:
    return reports.report_daily_cost(f.cur, Y, REPORT_LO, REPORT_HI)


@query("report_coverage_gaps")
def _q_r2(f: Fixture) -> DataFrame:
    return reports.report_coverage_gaps(f.aws_daily)


# --- scalar families -------------------------------------------------------------------

@query("scalar_date_ops")
def _q_sd(f: Fixture) -> DataFrame:
    a = f.aws_daily
    return a.select(
        "usage_date", "billing_month",
        F.last_day("billing_month").alias("billing_month_end"),
        F.trunc("usage_date", "MM").alias("usage_month"),
        F.date_add("usage_date", 1).alias("next_day"),
        F.add_months("billing_month", 1).alias("next_billing_month"),
        F.date_format("usage_date", "yyyy-MM").alias("usage_ym"),
        F.to_date(F.date_format("billing_month", "yyyyMM"), "yyyyMM").alias("billing_month_parsed"),
        (F.trunc("usage_date", "MM") == F.trunc("billing_month", "MM")).alias("in_month"))


@query("scalar_struct_array_map")
def _q_ss(f: Fixture) -> DataFrame:
    g = f.gcp_export
    return g.select(
        F.to_date("usage_start_time").alias("usage_date"),
        F.coalesce(F.col("project.id"), F.lit("")).alias("project_id"),
        F.col("service.description").alias("service_name"),
        F.col("location.region").alias("region"),
        daily.credits_total().cast(C.MONEY).alias("credits_total"),
        F.col("credits").isNull().alias("credits_missing"),
        F.try_element_at(F.create_map(F.lit("unit"), F.col("usage.unit")), F.lit("unit")).alias("usage_unit"))


@query("relational_date_slices")
def _q_s8(f: Fixture) -> DataFrame:
    """The service-level rows of a product's accounts between two bound dates, read in
    date slices."""
    path = _job_table(f, "relational")
    rows = f.slb.select(*SLB_CMP)
    with shuffles_freed(f.spark):
        rows.write.parquet(path)
    table = relational.read_date_slices(f.spark, path, rows.schema, "usage_date", WS, WE, days=10)
    return table.filter(F.col("usage_date").between(F.lit(PREV_START), F.lit(PREV_END)) & (F.col("cloud_provider") == C.AWS))


# --- streaming ---------------------------------------------------------------------------

@query("stream_incremental_daily")
def _q_r1(f: Fixture) -> DataFrame:
    return incremental.run_fixture_stream(f.spark, f.gcp_export, WS, WE)


@query("stream_late_lines")
def _q_r1b(f: Fixture) -> DataFrame:
    """Lines of every ingestion day from the middle of a month on land a second time,
    five days late: their usage days were complete before."""
    late = f.gcp_export.withColumn("partition_date", F.date_add("partition_date", 5))
    both = f.gcp_export.filter(F.col("partition_date") < F.lit(LATE_FROM)).unionByName(
        late.filter(F.col("partition_date") >= F.lit(LATE_FROM)))
    return incremental.run_fixture_stream(f.spark, both, WS, AS_OF, late_from=LATE_FROM)


# --- jobs: a first run and incremental runs over the same table --------------------------------

def _job_table(f: Fixture, name: str) -> str:
    return scratch_path(f.spark, f"{name}-{uuid.uuid4().hex}")


@query("gcp_load_incremental")
def _q_f2_jobs(f: Fixture) -> DataFrame:
    """F2 as a job, run after run; the windows overlap and cut usage days."""
    path = _job_table(f, "gcp-job")
    for i, as_of in enumerate(GCP_RUNS):
        jobs.run_gcp_load(f.spark, fx.landed_exports(f.spark, f.d)["gcp"], path, as_of, first_run=i == 0)
    return jobs.read_gcp_table(f.spark, path).select(*daily.GCP_COLUMNS)


@query("gcp_parts_compacted")
def _q_f2_compacted(f: Fixture) -> DataFrame:
    """F2 run after run with its parts compacted after each; rows are those of the parts alone."""
    path = _job_table(f, "gcp-compacted")
    for i, as_of in enumerate(GCP_RUNS):
        jobs.run_gcp_load(f.spark, fx.landed_exports(f.spark, f.d)["gcp"], path, as_of, first_run=i == 0)
        compaction.compact(f.spark, jobs.gcp_parts_path(path, True), ["partition_date", "usage_month"])
    parts = f.spark.read.parquet(jobs.gcp_parts_path(path, True))
    return daily.gcp_daily_from_parts(parts).select(*daily.GCP_COLUMNS)


@query("aws_load_all_sources")
def _q_f1_sources(f: Fixture) -> DataFrame:
    """F1 as a job: the v1 report, two v2 reports, external catalog tables and a view, each with
    its own window: the second v2 report is new and back-fills."""
    path = _job_table(f, "aws-sources")
    v2 = fx.land_v2_reports(fx.landed_cur_v2(f.spark, f.d), _job_table(f, "v2-reports"))
    database = f"external_{uuid.uuid4().hex}"
    fx.create_external_database(f.spark, f.d, database, f.cur)
    external = catalog.catalog_tables(f.spark, database, fx.CUR_EXT_PREFIX, {fx.EXCLUDED_CUR_TABLE})
    view = f"amortized_{uuid.uuid4().hex}"
    f.view.createOrReplaceTempView(view)
    jobs.run_aws_load(f.spark, fx.landed_exports(f.spark, f.d)["cur"], external, [view], path, SOURCES_AS_OF,
                      v2_paths=v2, new_tables=[v2[1]])
    return jobs.read_table(f.spark, path).select(*daily.AWS_COLUMNS)


# --- merges into bucketed tables: the target is not shuffled ------------------------------------

BUCKETS = 8


def _bucketed(f: Fixture, make, batches: list[list[Batch]]) -> DataFrame:
    """A new bucketed table after ``batches``, merge by merge. A batch that is merged more than once
    is computed for its first merge and read by the others."""
    name = f"merged_{uuid.uuid4().hex}"
    table = make(f.spark, name, _job_table(f, "bucketed"), batches[0][0].df.schema, BUCKETS)
    merges = Counter(id(b) for some in batches for b in some)
    with jobs.staging(f.spark) as keep:
        kept: dict[int, Batch] = {}
        for some in batches:
            for b in some:
                if merges[id(b)] > 1 and id(b) not in kept:
                    kept[id(b)] = replace(b, df=keep(b.df))
            with jobs.staging(f.spark) as stage:
                table.merge([kept.get(id(b), b) for b in some], stage)
    return table.read()


@query("aws_bucketed_load")
def _q_k2b(f: Fixture) -> DataFrame:
    """K2 with an earlier run, then the whole window over it, then the same run replayed."""
    def run(we: dt.date) -> list[Batch]:
        return [i.batch() for i in (loads.AwsInput(f.cur, "internal", (WS, we)),
                                    loads.AwsInput(f.external_cur(), "external", (WS, we)),
                                    loads.AwsInput(f.view, "view", (WS, we)))]
    whole = run(WE)
    return _bucketed(f, tables.aws_table, [run(REFRESH_AS_OF), whole, whole])


@query("gcp_bucketed_load")
def _q_k3b(f: Fixture) -> DataFrame:
    i = Batch(daily.gcp_daily_cost(f.gcp_export, WS, WE, True), daily.GCP_DESCRIPTORS + daily.GCP_INTERNAL)
    e = Batch(daily.gcp_daily_cost(f.gcp_external_export, WS, WE, False), daily.GCP_DESCRIPTORS + daily.GCP_EXTERNAL)
    return _bucketed(f, tables.gcp_table, [[i], [e], [i, e]])


@query("huawei_bucketed_load")
def _q_k4b(f: Fixture) -> DataFrame:
    i = Batch(daily.huawei_daily_cost(f.hw_records, WS, WE, True), daily.HWC_DESCRIPTORS + daily.HWC_INTERNAL)
    e = Batch(daily.huawei_daily_cost(f.hw_external_records, WS, WE, False), daily.HWC_DESCRIPTORS + daily.HWC_EXTERNAL)
    return _bucketed(f, tables.huawei_table, [[i, e], [e]])


@query("service_level_bucketed_upsert")
def _q_k5b(f: Fixture) -> DataFrame:
    own = [c for c in f.slb.columns if c not in rollup.SLB_KEYS]
    return _bucketed(f, tables.service_level_table, [[Batch(_slb_history(f), own)], [Batch(f.slb, own)]]).select(*SLB_CMP)


HW_DELIVERIES = 4


@query("huawei_pages_incremental")
def _q_s5_jobs(f: Fixture) -> DataFrame:
    """F3 over pages that arrive in four deliveries, in no order of bill dates; each run opens the
    new files alone, and late records change their whole days."""
    base = _job_table(f, "hw-pages")
    landing, table = f"{base}/landing", f"{base}/table"
    turn = F.pmod(F.xxhash64("customer_id", "bill_date", "consume_amount"), F.lit(HW_DELIVERIES))
    for n in range(HW_DELIVERIES):
        files.write_huawei_pages(f.hw_records.filter(turn == n), f"{landing}/{n}")
        jobs.run_huawei_load(f.spark, landing, None, table, HISTORY[1], first_run=n == 0, explicit_start=HISTORY[0])
    return jobs.read_table(f.spark, table).select(*daily.HWC_COLUMNS)


@query("huawei_load_incremental")
def _q_f3_jobs(f: Fixture) -> DataFrame:
    """F3 as a job, run after run; some records belong to the cycle after their bill date."""
    path = _job_table(f, "hw-job")
    for i, as_of in enumerate(HW_RUNS):
        jobs.run_huawei_load(f.spark, fx.landed_exports(f.spark, f.d)["huawei"], None, path, as_of, first_run=i == 0)
    return jobs.read_table(f.spark, path).select(*daily.HWC_COLUMNS)


@query("aws_cleanup_job")
def _q_f1_jobs(f: Fixture) -> DataFrame:
    """F1 as a job with the clean-up of K9: the table holds a later month that nothing
    reloads, which the delete empties."""
    path = _job_table(f, "aws-job")
    old = daily.aws_daily_cost_window(f.cur, cur_src.V1, WS, WE, True)
    stray = old.filter(F.col("billing_month") == F.lit(PREV_START)).withColumn(
        "billing_month", F.lit(dt.date(2001, 12, 1))).withColumn("usage_date", F.add_months("usage_date", 5))
    jobs.overwrite_partitions(old.unionByName(stray), path, ["billing_month"])
    jobs.run_aws_load(f.spark, fx.landed_exports(f.spark, f.d)["cur"], [], [], path, CLEANUP_AS_OF, cleanup=True)
    return jobs.read_table(f.spark, path).select(*daily.AWS_COLUMNS)


@query("service_level_job")
def _q_f4_jobs(f: Fixture) -> DataFrame:
    """F4 as a job over a table with a window month that this run leaves empty."""
    paths = {k: _job_table(f, k) for k in ("aws", "gcp", "hw", "slb")}
    f.load_daily_tables()
    jobs.overwrite_partitions(f.aws_daily, paths["aws"], ["billing_month"])
    jobs.write_gcp_table(f.gcp_daily, paths["gcp"], [])
    jobs.overwrite_partitions(f.hw_daily, paths["hw"], ["billing_month"])
    stale = f.slb.limit(5).withColumn("usage_date", F.lit(dt.date(2002, 3, 5)))
    jobs.overwrite_partitions(stale.withColumn("usage_month", F.trunc("usage_date", "MM")), paths["slb"], ["usage_month"])
    jobs.run_service_level(f.spark, paths["aws"], paths["gcp"], paths["hw"], f.service_types, paths["slb"], AS_OF, RUN_TS)
    return jobs.read_table(f.spark, paths["slb"]).select(*SLB_CMP)


# --- operators that the flows use internally, each with its own key ------------------------

@query("cur_v1_period_scan")
def _q_s1(f: Fixture) -> DataFrame:
    rows = f.cur.filter(cur_src.period_predicate(cur_src.V1, Y, M))
    return rows.select(F.to_date(cur_src.TS).alias("usage_date"), "line_item_usage_account_id",
                       "line_item_line_item_type", "line_item_unblended_cost")


@query("cur_v2_period_scan")
def _q_s2(f: Fixture) -> DataFrame:
    rows = fx.landed_cur_v2(f.spark, f.d).filter(cur_src.period_predicate(cur_src.V2, Y, M))
    return rows.select(F.to_date(cur_src.TS).alias("usage_date"), "line_item_usage_account_id",
                       F.expr(cur_src.V2.service_name).alias("service_name"),
                       F.col(cur_src.V2.region).alias("region"))


@query("gcp_partition_scan")
def _q_s4(f: Fixture) -> DataFrame:
    lo, hi = refresh_window(REFRESH_AS_OF, C.GCP, first_run=False)
    rows = f.gcp_export.filter(F.col("partition_date").between(F.lit(lo), F.lit(hi)))
    return rows.select(F.to_date("usage_start_time").alias("usage_date"), "partition_date",
                       "billing_account_id", F.col("project.id").alias("project_id"), "cost")


@query("huawei_typed_records")
def _q_s12(f: Fixture) -> DataFrame:
    return daily.huawei_typed(f.hw_records)


@query("pricing_start_bounds")
def _q_a17(f: Fixture) -> DataFrame:
    return f.pricing_rows.agg(F.min("start_date").alias("min_start"), F.max("start_date").alias("max_start"))


@query("distinct_accounts_in_range")
def _q_u4(f: Fixture) -> DataFrame:
    lines = f.cur.filter((F.col("year") == str(Y)) & reports.ts_date_between(cur_src.TS, REPORT_LO, REPORT_HI))
    return lines.select("line_item_usage_account_id").distinct()


@query("daily_pricing_join")
def _q_j3(f: Fixture) -> DataFrame:
    x = costs.costs_with_pricing(f.slb, f.external_products, f.product_accounts, f.daily_pricing_window,
                                  PREV_START, AS_OF)
    return x.select("product_id", "organization_id", "usage_date", "cloud_provider",
                    F.col("c").alias("cost"), F.col("ad").alias("after_discount_cost"))


@query("amortized_by_product")
def _q_j7(f: Fixture) -> DataFrame:
    return (f.amortized.join(f.billing_entity_map, "billing_entity")
            .select("product_id", "usage_date", "billing_entity", "cost"))
