"""Raw billing lines -> keyed daily cost rows (A1-A4) with internal/external
measure routing (P10).

Each aggregation is one ``groupBy`` on the merge key: Spark runs a partial
(map-side) aggregate before the shuffle, so a hot key (one account holding a
third of the lines) is reduced to one row per task before it moves.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import config as C
from ..schemas import (  # noqa: F401 (callers take them from here)
    AWS_COLUMNS, AWS_DESCRIPTORS, AWS_EXTERNAL, AWS_INTERNAL, AWS_KEYS,
    GCP_COLUMNS, GCP_DESCRIPTORS, GCP_EXTERNAL, GCP_INTERNAL, GCP_KEYS,
    HWC_COLUMNS, HWC_DESCRIPTORS, HWC_EXTERNAL, HWC_INTERNAL, HWC_KEYS)
from ..sources import cur as cur_src


def route_internal_external(df: DataFrame, internal: bool, internal_cols: list[str],
                            external_cols: list[str]) -> DataFrame:
    """P10: an internal load fills the plain measures and zeroes the ``ext_``
    twins; an external load moves its measures to the ``ext_`` columns."""
    zero = F.lit(0).cast(C.MONEY)
    out = []
    for i, e in zip(internal_cols, external_cols):
        v = F.col(i).cast(C.MONEY)
        out += [(v if internal else zero).alias(i), (zero if internal else v).alias(e)]
    keep = [c for c in df.columns if c not in internal_cols]
    return df.select(*keep, *out)


def group_with_descriptors(df: DataFrame, keys: list[Column], descriptors: list[tuple[str, Column]],
                           sums: list[tuple[str, Column]], pick=F.max) -> DataFrame:
    """``groupBy(keys)`` with ``max`` (or another ``pick``) of string descriptors and ``sum`` of
    measures, in two phases.

    ``MAX(string)`` has no fixed-width buffer, so Spark would run the whole
    aggregation - including the map-side partial aggregation over every raw
    line - as a sort-based aggregate. Descriptors are (nearly) determined by the
    key, so phase 1 groups by key *and* descriptor values with numeric sums
    only: a hash aggregate over the raw lines. Phase 2 groups the few
    resulting rows by key, taking ``max`` of the descriptors and summing the
    sums (exactly the same result). Returns columns ``keys``, descriptor maxima
    (NULL if all NULL) and sums (NULL if all NULL).
    """
    phase1 = df.groupBy(*keys, *[c.alias(n) for n, c in descriptors]).agg(*[F.sum(c).alias(n) for n, c in sums])
    key_names = [c for c in phase1.columns if c not in {n for n, _ in descriptors} | {n for n, _ in sums}]
    return phase1.groupBy(*key_names).agg(*[pick(n).alias(n) for n, _ in descriptors],
                                          *[F.sum(n).alias(n) for n, _ in sums])


# ---------------------------------------------------------------------------
# A1 / A2: AWS CUR -> daily
# ---------------------------------------------------------------------------

def _coalesce_empty(c: str) -> Column:
    return F.coalesce(F.col(c), F.lit(""))


def aws_daily_from_lines(lines: DataFrame, layout: cur_src.CurLayout, internal: bool) -> DataFrame:
    """Group CUR lines by the 8-part key. Descriptors take MAX, measures are
    exact decimal sums; the net cost of an external load is 0."""
    keys = [
        F.to_date(cur_src.TS).alias("usage_date"),
        F.expr(layout.billing_month).alias("billing_month"),
        F.col("line_item_usage_account_id").alias("usage_account_id"),
        _coalesce_empty("product_servicecode").alias("service_code"),
        _coalesce_empty("product_sku").alias("sku_id"),
        _coalesce_empty(layout.region).alias("region"),
        _coalesce_empty("line_item_line_item_type").alias("billing_type"),
        _coalesce_empty("line_item_usage_type").alias("usage_type"),
    ]
    m = lambda c: F.col(c).cast(C.MONEY)
    g = group_with_descriptors(
        lines, keys,
        [("service_name", F.expr(layout.service_name)), ("location", F.col("product_location")),
         ("currency", F.col("line_item_currency_code")), ("pricing_type", F.col("pricing_term")),
         ("usage_unit", F.col("pricing_unit"))],
        [("usage_amount", m("line_item_usage_amount")), ("unblended_cost", m("line_item_unblended_cost")),
         ("blended_cost", m("line_item_blended_cost")), ("net_unblended_cost", m("line_item_net_unblended_cost"))])
    z = F.lit(0)
    agg = g.select(
        *[F.col(c) for c in AWS_KEYS],
        F.coalesce("service_name", F.lit("")).alias("service_name"),
        F.coalesce("location", F.lit("")).alias("location"),
        F.coalesce("currency", F.lit("")).alias("currency"),
        F.coalesce("pricing_type", F.lit(C.DEFAULT_PRICING_TERM)).alias("pricing_type"),
        F.coalesce("usage_amount", z).cast(C.USAGE).alias("usage_amount"),
        "usage_unit",
        F.coalesce("unblended_cost", z).cast(C.MONEY).alias("unblended_cost"),
        F.coalesce("blended_cost", z).cast(C.MONEY).alias("blended_cost"),
        (F.coalesce("net_unblended_cost", z).cast(C.MONEY) if internal else F.lit(0).cast(C.MONEY))
        .alias("net_unblended_cost"))
    return route_internal_external(agg, internal, AWS_INTERNAL, AWS_EXTERNAL).select(*AWS_COLUMNS)


def aws_daily_cost(cur: DataFrame, layout: cur_src.CurLayout, start: dt.date, end: dt.date,
                   internal: bool = True) -> DataFrame:
    """A1 (v1) / A2 (v2) for one (start, end) slice of one billing period."""
    return aws_daily_from_lines(cur_src.scan_period(cur, layout, start, end), layout, internal)


def aws_daily_cost_window(cur: DataFrame, layout: cur_src.CurLayout, ws: dt.date, we: dt.date,
                          internal: bool = True) -> DataFrame:
    """A1/A2 over a whole refresh window (all periods) in one scan."""
    return aws_daily_from_lines(cur_src.scan_window(cur, layout, ws, we), layout, internal)


def aws_daily_from_view(view_rows: DataFrame) -> DataFrame:
    """S3 rows (already daily) as an external load."""
    return route_internal_external(view_rows, False, AWS_INTERNAL, AWS_EXTERNAL).select(*AWS_COLUMNS)


# ---------------------------------------------------------------------------
# A3: GCP export -> daily
# ---------------------------------------------------------------------------

def credits_total(credits: str = "credits") -> Column:
    """Sum of ``credits[].amount`` per row, NULL array/amounts as 0, without
    exploding (higher-order function, stays in codegen)."""
    acc_t = "decimal(38,8)"
    empty = F.array().cast("array<struct<amount:decimal(20,8)>>")
    return F.aggregate(F.coalesce(F.col(credits), empty), F.lit(0).cast(acc_t),
                       lambda acc, x: (acc + F.coalesce(x["amount"].cast(acc_t), F.lit(0).cast(acc_t)))
                       .cast(acc_t))


_GCP_DESCRIBED = ["project_name", "service_name", "sku_description", "location", "currency", "usage_unit", "invoice_month"]
_GCP_SUMS = ["usage_amount", "cost", "credits"]


def _gcp_grouped(lines: DataFrame, *extra: Column) -> DataFrame:
    """Lines grouped by the 7-part key (and ``extra``): descriptor maxima and raw sums."""
    keys = [
        F.to_date("usage_start_time").alias("usage_date"),
        F.col("billing_account_id"),
        F.coalesce(F.col("project.id"), F.lit("")).alias("project_id"),
        F.coalesce(F.col("service.id"), F.lit("")).alias("service_code"),
        F.coalesce(F.col("sku.id"), F.lit("")).alias("sku_id"),
        F.coalesce(F.col("location.region"), F.lit("")).alias("region"),
        F.coalesce(F.col("cost_type"), F.lit("")).alias("cost_type"),
    ]
    values = [F.col("project.name"), F.col("service.description"), F.col("sku.description"), F.col("location.location"),
              F.col("currency"), F.col("usage.unit"), F.col("invoice.month")]
    sums = [F.col("usage.amount").cast(C.MONEY), F.col("cost").cast(C.MONEY), credits_total()]
    return group_with_descriptors(lines, [*extra, *keys], list(zip(_GCP_DESCRIBED, values)), list(zip(_GCP_SUMS, sums)))


def _gcp_shaped(g: DataFrame, internal: bool) -> DataFrame:
    z = F.lit(0)
    agg = g.select(
        *GCP_KEYS,
        F.to_date("invoice_month", "yyyyMM").alias("billing_month"),
        *[F.coalesce(c, F.lit("")).alias(c) for c in
          ("project_name", "service_name", "sku_description", "location", "currency")],
        F.round(F.coalesce("usage_amount", z), 8).cast(C.USAGE).alias("usage_amount"),
        F.coalesce("usage_unit", F.lit("")).alias("usage_unit"),
        F.round(F.coalesce("cost", z), 8).cast(C.MONEY).alias("cost"),
        F.round(F.col("credits"), 8).cast(C.MONEY).alias("credits"))
    return route_internal_external(agg, internal, GCP_INTERNAL, GCP_EXTERNAL).select(*GCP_COLUMNS)


def gcp_daily_cost(export: DataFrame, start: dt.date, end: dt.date, internal: bool = True) -> DataFrame:
    """S4 partition pruning on the ingestion date, then A3 grouped by usage date."""
    lines = export.filter(F.col("partition_date").between(F.lit(start), F.lit(end)))
    return _gcp_shaped(_gcp_grouped(lines), internal)


def gcp_parts(lines: DataFrame) -> DataFrame:
    """Partial sums of A3 by (ingestion date, key). A usage day's lines arrive on several
    ingestion days; the day's row is the sum of its parts (``gcp_daily_from_parts``)."""
    return _gcp_grouped(lines, F.col("partition_date")).withColumn("usage_month", F.trunc("usage_date", "MM"))


def gcp_daily_from_parts(parts: DataFrame, internal: bool = True) -> DataFrame:
    """A3 rows of the usage days whose parts are given."""
    g = parts.groupBy(*GCP_KEYS).agg(*[F.max(c).alias(c) for c in _GCP_DESCRIBED],
                                     *[F.sum(c).alias(c) for c in _GCP_SUMS])
    return _gcp_shaped(g, internal)


# ---------------------------------------------------------------------------
# A4: Huawei records -> daily
# ---------------------------------------------------------------------------

def huawei_typed(records: DataFrame, *origin: str) -> DataFrame:
    """Typed record: NULL strings -> '', cycle yyyy-MM -> first of month; ``origin``
    columns are kept as they are."""
    e = lambda c: F.coalesce(F.col(c), F.lit(""))
    return records.select(
        *origin,
        F.to_date("bill_date").alias("bill_date"),
        F.to_date(F.concat(F.col("cycle"), F.lit("-01"))).alias("billing_month"),
        e("payer_account_id").alias("payer_account_id"),
        e("customer_id").alias("customer_id"),
        e("enterprise_project_id").alias("enterprise_project_id"),
        e("enterprise_project_name").alias("enterprise_project_name"),
        e("cloud_service_type").alias("cloud_service_type"),
        e("cloud_service_type_name").alias("cloud_service_type_name"),
        e("sku_code").alias("sku_code"),
        e("product_spec_desc").alias("product_spec_desc"),
        e("resource_Type_code").alias("resource_type_code"),
        e("resource_type_name").alias("resource_type_name"),
        e("resource_name").alias("resource_name"),
        e("region").alias("region"),
        e("region_name").alias("region_name"),
        F.col("charge_mode").cast("int").alias("charge_mode"),
        F.col("bill_type").cast("int").alias("bill_type"),
        F.col("consume_amount").cast(C.MONEY).alias("consume_amount"),
        F.col("debt_amount").cast(C.MONEY).alias("debt_amount"),
        F.col("official_amount").cast(C.MONEY).alias("official_amount"),
    )


_HWC_DESCRIBED = [c for c in HWC_DESCRIPTORS if c != "usage_amount"]


def _huawei_grouped(typed: DataFrame, *extra: str) -> DataFrame:
    """Typed records grouped by the 11-part key (and ``extra``). Records meet in a hash
    aggregate by key and descriptors; only its rows, not the records, reach the sort-based
    aggregate that MIN(string) needs."""
    return group_with_descriptors(
        typed, [F.col(c) for c in (*extra, *HWC_KEYS)], [(c, F.col(c)) for c in _HWC_DESCRIBED],
        [(c, F.col(c)) for c in HWC_INTERNAL], pick=F.min)


def _huawei_shaped(grouped: DataFrame, internal: bool) -> DataFrame:
    agg = grouped.select(*HWC_KEYS, *_HWC_DESCRIBED, F.lit(None).cast(C.USAGE).alias("usage_amount"),
                         *[F.coalesce(c, F.lit(0)).cast(C.MONEY).alias(c) for c in HWC_INTERNAL])
    return route_internal_external(agg, internal, HWC_INTERNAL, HWC_EXTERNAL).select(*HWC_COLUMNS)


def huawei_daily_cost(records: DataFrame, start: dt.date, end: dt.date, internal: bool = True) -> DataFrame:
    """A4: records of bill dates in [start, end] grouped by the 11-part key;
    descriptors take MIN (deterministic), NULL amounts count 0, usage NULL."""
    typed = huawei_typed(records).filter(F.col("bill_date").between(F.lit(start), F.lit(end)))
    return _huawei_shaped(_huawei_grouped(typed), internal)


def huawei_parts(records: DataFrame, *origin: str) -> DataFrame:
    """Partial sums of A4 by (``origin`` columns of the records, key), with the month of the
    bill date as ``bill_month``. A key's row is the sum of its parts. Records without a bill
    date belong to no day and are left out, as A4 leaves them out."""
    typed = huawei_typed(records, *origin).filter(F.col("bill_date").isNotNull())
    return _huawei_grouped(typed, *origin).withColumn("bill_month", F.trunc("bill_date", "MM"))


def huawei_daily_from_parts(parts: DataFrame, internal: bool = True) -> DataFrame:
    """A4 rows of the keys whose parts are given."""
    g = parts.groupBy(*HWC_KEYS).agg(*[F.min(c).alias(c) for c in _HWC_DESCRIBED],
                                     *[F.sum(c).alias(c) for c in HWC_INTERNAL])
    return _huawei_shaped(g, internal)


def huawei_withdrawn(parts: DataFrame, live: DataFrame, internal: bool = True) -> DataFrame:
    """Rows with zero amounts for the keys of ``parts`` that ``live`` rows no longer have:
    their records were landed again without them."""
    gone = parts.select(*HWC_KEYS).distinct().alias("p")
    same = [F.col(f"p.{c}").eqNullSafe(F.col(f"l.{c}")) for c in HWC_KEYS]
    gone = gone.join(live.select(*HWC_KEYS).alias("l"), same, "left_anti")
    empty = gone.select(*HWC_KEYS, *[F.lit("").alias(c) for c in _HWC_DESCRIBED],
                        *[F.lit(None).cast(C.MONEY).alias(c) for c in HWC_INTERNAL])
    return _huawei_shaped(empty, internal)
