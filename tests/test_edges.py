"""Hand-made edge cases the driver tables do not contain (FIXTURES §4) and
properties of the merge."""

import datetime as dt
from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cloudcost import config as C
from cloudcost.functions.classify import billing_type_class
from cloudcost.functions.dates import refresh_window, rollup_window
from cloudcost.operators import amortized, pricing, reports, rollup
from cloudcost.operators.merge import Batch, append_new, keyed_merge
from cloudcost.plans import billing
from cloudcost.sources import files

d = dt.date
PR_SCHEMA = ("organization_id bigint, cloud_provider string, start_date date, "
             "discount decimal(9,4), handling_fee decimal(9,4), support_fee decimal(9,4)")


def rows(df, *cols):
    key = lambda t: tuple((v is None, v if v is not None else 0) for v in t)
    return sorted((tuple(r[c] for c in cols) for r in df.collect()), key=key)


# --- pricing -----------------------------------------------------------------------

def test_pricing_equal_starts_do_not_overlap(spark):
    p = spark.createDataFrame([
        (1, "AWS", d(2001, 8, 1), D("5"), D("1"), D("1")),
        (1, "AWS", d(2001, 8, 1), D("7"), D("1"), D("1")),
        (1, "AWS", d(2001, 8, 10), D("9"), D("2"), D("2")),
    ], PR_SCHEMA)
    daily = pricing.daily_org_pricing(p, d(2001, 8, 15))
    keys = rows(daily, "pricing_date", "organization_id", "cloud_provider")
    assert len(keys) == len(set(keys)) == 15
    first = daily.filter(F.col("pricing_date") == d(2001, 8, 1)).first()
    assert first["discount"] == D("7")   # the later of the equal starts wins
    act = pricing.active_pricing(p, d(2001, 8, 15)).first()
    assert act["discount"] == D("9")


def test_pricing_future_start_and_single_row(spark):
    p = spark.createDataFrame([
        (1, "GCP", d(2001, 8, 10), D("5"), D("1"), D("1")),
        (1, "GCP", d(2001, 9, 1), D("6"), D("1"), D("1")),
        (2, "HWC", d(2001, 8, 14), D("1"), D("0"), D("0")),
    ], PR_SCHEMA)
    daily = pricing.daily_org_pricing(p, d(2001, 8, 15))
    org1 = rows(daily.filter("organization_id = 1"), "pricing_date", "discount")
    assert org1[0] == (d(2001, 8, 10), D("5")) and org1[-1] == (d(2001, 9, 1), D("6"))
    assert len(org1) == 23           # 08-10 .. 09-01: future start open for one day
    org2 = rows(daily.filter("organization_id = 2"), "pricing_date")
    assert org2[0][0] == d(2001, 8, 14) and org2[-1][0] == d(2001, 9, 1)
    act = rows(pricing.active_pricing(p, d(2001, 8, 15)), "organization_id", "start_date")
    assert act == [(1, d(2001, 8, 10)), (2, d(2001, 8, 14))]   # future row not active yet


def test_pricing_empty(spark):
    p = spark.createDataFrame([], PR_SCHEMA)
    assert pricing.daily_org_pricing(p, d(2001, 8, 15)).count() == 0
    assert pricing.date_spine(spark, p, d(2001, 8, 15)).count() == 0
    assert pricing.active_pricing(p, d(2001, 8, 15)).count() == 0


# --- merge ----------------------------------------------------------------------------
M_SCHEMA = "k string, desc string, a decimal(20,8), ext_a decimal(20,8)"


def _batches(spark):
    internal = spark.createDataFrame([("x", "i", D(1), D(0)), ("y", "i", D(2), D(0))], M_SCHEMA)
    external = spark.createDataFrame([("x", "e", D(0), D(10)), ("z", "e", D(0), D(30))], M_SCHEMA)
    return Batch(internal, ["desc", "a"]), Batch(external, ["desc", "ext_a"])


def test_merge_column_scoped(spark):
    i, e = _batches(spark)
    out = rows(keyed_merge(None, [i, e], ["k"]), "k", "desc", "a", "ext_a")
    assert out == [("x", "e", D(1), D(10)), ("y", "i", D(2), D(0)), ("z", "e", D(0), D(30))]


def test_merge_order_independent_on_costs(spark):
    i, e = _batches(spark)
    a = rows(keyed_merge(None, [i, e], ["k"]), "k", "a", "ext_a")
    b = rows(keyed_merge(None, [e, i], ["k"]), "k", "a", "ext_a")
    assert a == b


def test_merge_replay_is_idempotent(spark):
    i, e = _batches(spark)
    once = keyed_merge(None, [i, e], ["k"])
    twice = keyed_merge(once, [e], ["k"])
    assert rows(once, "k", "desc", "a", "ext_a") == rows(twice, "k", "desc", "a", "ext_a")


def test_merge_keeps_untouched_partitions(spark):
    schema = "m date, k string, v decimal(20,8)"
    target = spark.createDataFrame([(d(2001, 6, 1), "a", D(1)), (d(2001, 7, 1), "a", D(2))], schema)
    upd = spark.createDataFrame([(d(2001, 7, 1), "a", D(5)), (d(2001, 7, 1), "b", D(6))], schema)
    out = rows(keyed_merge(target, [Batch(upd, ["v"])], ["m", "k"], partition_col="m",
                           partitions=[d(2001, 7, 1)]), "m", "k", "v")
    assert out == [(d(2001, 6, 1), "a", D(1)), (d(2001, 7, 1), "a", D(5)), (d(2001, 7, 1), "b", D(6))]


def test_merge_duplicate_key_in_batch_last_wins(spark):
    schema = "k string, v decimal(20,8), n int"
    t = spark.createDataFrame([("a", D(1), 0)], schema)
    u = spark.createDataFrame([("a", D(5), 2), ("a", D(9), 1), ("b", D(3), 1)], schema)
    out = keyed_merge(t, [Batch(u, ["v"], order="n")], ["k"], ["k", "v"])
    assert rows(out, "k", "v") == [("a", D(5)), ("b", D(3))]


def test_merge_null_keys_match(spark):
    schema = "k string, n int, v decimal(20,8)"
    t = spark.createDataFrame([("a", None, D(1))], schema)
    u = spark.createDataFrame([("a", None, D(2))], schema)
    assert rows(keyed_merge(t, [Batch(u, ["v"])], ["k", "n"]), "k", "n", "v") == [("a", None, D(2))]


def test_append_guard(spark):
    schema = "m date, p bigint, c string, n bigint"
    t = spark.createDataFrame([(d(2001, 6, 1), 1, "AWS", 1)], schema)
    new = spark.createDataFrame([(d(2001, 7, 1), 1, "AWS", 2)], schema)
    once = append_new(t, new, ["m", "p", "c"])
    assert once.count() == 2 and append_new(once, new, ["m", "p", "c"]).count() == 2


# --- category ----------------------------------------------------------------------------

def test_category_rules(spark):
    st = spark.createDataFrame([("EC2", "AWS", "Compute"), ("Blank", "AWS", "")],
                               "code string, cloud_provider string, parent_category string")
    types = ["Usage", "Fee", "Credit", "Tax", "weird"]
    data = [("", "AWS", t) for t in types] + [(None, "AWS", "Usage"), ("EC2", "AWS", "Tax"),
                                              ("Blank", "AWS", "RIFee"), ("S3", "AWS", "Usage"),
                                              ("EC2", "GCP", "Usage")]
    slb = spark.createDataFrame(data, "service_code string, cloud_provider string, billing_type string")
    out = rows(rollup.with_parent_category(slb, st), "service_code", "cloud_provider", "billing_type",
               "parent_category")
    got = {(a, b, c): p for a, b, c, p in out}
    assert [got[("", "AWS", t)] for t in types] == ["Regular", "Fee", "Discount", "Tax", "Other"]
    assert got[(None, "AWS", "Usage")] == "Unknown"
    assert got[("EC2", "AWS", "Tax")] == "Compute"
    assert got[("Blank", "AWS", "RIFee")] == "Fee"
    assert got[("S3", "AWS", "Usage")] == "Unknown"
    assert got[("EC2", "GCP", "Usage")] == "Unknown"


def test_billing_type_class_all_lists(spark):
    vals = [(v,) for _, vs in C.BILLING_TYPE_CLASSES for v in vs] + [("x",), (None,)]
    df = spark.createDataFrame(vals, "t string").select("t", billing_type_class(F.col("t")).alias("c"))
    got = dict(rows(df, "t", "c"))
    for name, vs in C.BILLING_TYPE_CLASSES:
        assert all(got[v] == name for v in vs)
    assert got["x"] == "Other" and got[None] == "Other"


# --- month edges -----------------------------------------------------------------------------
AWS_ROLL = ("usage_date date, billing_month date, usage_account_id string, service_code string, "
            "service_name string, billing_type string, unblended_cost decimal(20,8), "
            "ext_unblended_cost decimal(20,8)")


def test_month_edges(spark):
    df = spark.createDataFrame([
        (d(2001, 7, 31), d(2001, 7, 1), "1", "S", "s", "Usage", D(1), D(1)),    # last day, in month
        (d(2000, 2, 29), d(2000, 2, 1), "1", "S", "s", "Usage", D(2), D(2)),    # leap day
        (d(2001, 7, 5), None, "1", "S", "s", "Usage", D(4), D(4)),              # NULL month: dropped
        (d(2001, 8, 2), d(2001, 7, 1), "1", "S", "s", "Usage", D(8), D(8)),     # late line
    ], AWS_ROLL)
    ws, we = d(2000, 1, 1), d(2001, 8, 15)
    inm = rows(rollup.rollup_aws(df, ws, we, False), "usage_date", "cost")
    out = rows(rollup.rollup_aws(df, ws, we, True), "usage_date", "cost", "is_li_outside_of_month")
    both = rows(rollup.rollup_aws(df, ws, we, None), "usage_date", "cost")
    assert inm == [(d(2000, 2, 29), D(2)), (d(2001, 7, 31), D(1))]
    assert out == [(d(2001, 7, 31), D(8), True)]
    assert sorted(inm + [(a, b) for a, b, _ in out]) == both


# --- CSV -----------------------------------------------------------------------------------------

def test_csv_roundtrip_and_malformed(spark, tmp_path):
    cols = ["usage_date", "service_name", "usage_amount", "unblended_cost"]
    src = spark.createDataFrame([(d(2001, 7, 1), 'a "quoted", name', "1.5", ""), (d(2001, 7, 2), "", None, "2")],
                                "usage_date date, service_name string, usage_amount string, unblended_cost string")
    files.unload_csv(src, str(tmp_path / "ok"))
    back = rows(files.read_daily_csv(spark, str(tmp_path / "ok"), cols), *cols)
    assert back == [(d(2001, 7, 1), 'a "quoted", name', D("1.5"), D(0)), (d(2001, 7, 2), "", D(0), D(2))]
    bad = spark.createDataFrame([(d(2001, 7, 1), "x", "1", "abc")], src.schema)
    files.unload_csv(bad, str(tmp_path / "bad"))
    with pytest.raises(Exception):
        files.read_daily_csv(spark, str(tmp_path / "bad"), cols).collect()


# --- amortized: two periods, previous wins ---------------------------------------------------------
CUR_MIN = T.StructType([T.StructField(n, t) for n, t in [
    ("line_item_usage_start_date", T.TimestampType()), ("year", T.StringType()), ("month", T.StringType()),
    ("line_item_usage_account_id", T.StringType()), ("bill_billing_entity", T.StringType()),
    ("line_item_line_item_type", T.StringType()), ("line_item_net_unblended_cost", T.DecimalType(20, 8)),
    ("reservation_net_effective_cost", T.DecimalType(20, 8)),
    ("savings_plan_net_savings_plan_effective_cost", T.DecimalType(20, 8)),
    ("reservation_net_unused_recurring_fee", T.DecimalType(20, 8)),
    ("resource_tags_user_client_env", T.StringType())]])


def test_amortized_previous_period_wins(spark):
    ts = dt.datetime(2001, 8, 1)
    cur = spark.createDataFrame([
        (ts, "2001", "8", "1", "AWS", "Usage", D(10), None, None, None, "e"),
        (ts, "2001", "7", "1", "AWS", "Usage", D(3), None, None, None, "e"),
        (ts, "2001", "7", "1", "AWS", "Fee", D(100), None, None, None, "e"),   # plain-AWS fee counts 0
    ], CUR_MIN)
    org = spark.createDataFrame([("1", "ent-0")], "account_id string, billing_entity string")
    p = C.AmortizedParams(entities=("ent-0",), marketplace_account="9", tag_entity="t", tag_value="none",
                          tag_account="none")
    out = rows(amortized.amortized_two_month(cur, org, p, d(2001, 8, 15)), "usage_date", "billing_entity", "cost")
    assert out == [(d(2001, 8, 1), "ent-0", D(3))]


# --- invoice -------------------------------------------------------------------------------------------

def test_invoice_numbers_and_fees(spark):
    slb = spark.createDataFrame([
        (d(2001, 7, 3), "AWS", "a1", D("1.00"), D("1.00")),
        (d(2001, 7, 3), "GCP", "a1", D("2.00"), D("2.00")),
        (d(2001, 7, 3), "AWS", "b1", D("3.00"), D("3.00")),
    ], "usage_date date, cloud_provider string, usage_account_id string, cost decimal(20,8), "
       "ext_cost decimal(20,8)")
    products = spark.createDataFrame([(1, "p1", 10), (2, "p2", 20)], "id bigint, name string, organization_id bigint")
    orgs = spark.createDataFrame([(10, "o1", True, False), (20, "o2", False, False)],
                                 "id bigint, name string, internal boolean, exceptional boolean")
    pa = spark.createDataFrame([(1, 10, "a1", "AWS"), (2, 20, "b1", "AWS")],
                               "product_id bigint, organization_id bigint, account_id string, cloud_provider string")
    pr = spark.createDataFrame([(10, "AWS", d(2001, 1, 1), D(0), D("0.5"), D(0))], PR_SCHEMA)
    dp = pricing.daily_org_pricing(pr, d(2001, 8, 15))
    bills = spark.createDataFrame([(d(2001, 6, 1), 1, 10, "AWS", D(0), D(0), D(0), 41, d(2001, 6, 4), d(2001, 7, 4))],
                                  "month_date date, product_id bigint, organization_id bigint, cloud_provider string, "
                                  "cost decimal(20,8), handling_fee decimal(20,2), support_fee decimal(20,2), "
                                  "invoice_number bigint, created_date date, due_date date")
    inv = billing.monthly_invoice(slb, products, orgs, pa, dp, pr, bills, d(2001, 8, 15))
    out = rows(inv, "product_id", "cloud_provider", "invoice_number", "handling_fee", "support_fee")
    # product 1 continues at 42, 43 (provider order); 1.00 * 0.5 % = 0.005 -> 0.01 (half up)
    assert out == [(1, "AWS", 42, D("0.01"), D("0.00")), (1, "GCP", 43, D("0.00"), D("0.00")),
                   (2, "AWS", 1, D("0.00"), D("0.00"))]
    r = inv.first()
    assert r["month_date"] == d(2001, 7, 1) and r["created_date"] == d(2001, 7, 4) and r["due_date"] == d(2001, 8, 4)


# --- coverage gaps -------------------------------------------------------------------------------------------

def test_coverage_gaps(spark):
    df = spark.createDataFrame([("a", d(2001, 7, 1)), ("a", d(2001, 7, 3)), ("a", d(2001, 7, 3)), ("b", d(2001, 7, 9))],
                               "usage_account_id string, usage_date date")
    assert rows(reports.report_coverage_gaps(df), "account_id", "missing_day") == [("a", d(2001, 7, 2))]


# --- windows ---------------------------------------------------------------------------------------------------

def test_refresh_windows():
    assert refresh_window(d(2001, 8, 15), C.AWS, True) == (d(2001, 2, 1), d(2001, 8, 15))
    assert refresh_window(d(2001, 8, 14), C.AWS, False) == (d(2001, 7, 1), d(2001, 8, 14))
    assert refresh_window(d(2001, 8, 14), C.GCP, False) == (d(2001, 8, 5), d(2001, 8, 14))
    assert refresh_window(d(2001, 8, 3), C.GCP, False) == (d(2001, 7, 1), d(2001, 8, 3))
    assert refresh_window(d(2001, 8, 7), C.HWC, False) == (d(2001, 8, 1), d(2001, 8, 7))
    assert refresh_window(d(2001, 8, 7), C.HWC, False, d(2001, 5, 5)) == (d(2001, 5, 5), d(2001, 8, 7))
    assert rollup_window(d(2001, 1, 31)) == (d(2000, 7, 1), d(2001, 1, 31))
