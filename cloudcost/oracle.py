"""DuckDB SQL for every registered query (the correctness oracle).

The adapters and the billing semantics are written a second time, as plain SQL
over the driver tables, independent of the Spark code. Each query is one
``WITH ... SELECT`` built from named CTEs; dependencies are pulled in
automatically.
"""

from __future__ import annotations

import re

from . import config as C

AS_OF = "DATE '2001-08-15'"
WS, WE = "DATE '2001-02-01'", "DATE '2001-08-15'"
OLD_WS, OLD_WE = "DATE '2001-01-01'", "DATE '2001-07-15'"
PREV_LO, PREV_HI = "DATE '2001-07-01'", "DATE '2001-07-31'"


def _lst(vals) -> str:
    return ", ".join(f"'{v}'" for v in vals)


def _class(col: str) -> str:
    parts = " ".join(f"WHEN {col} IN ({_lst(v)}) THEN '{n}'" for n, v in C.BILLING_TYPE_CLASSES)
    return f"CASE {parts} ELSE '{C.BILLING_TYPE_OTHER}' END"


def _same_month(a: str, b: str) -> str:
    return f"date_diff('month', {a}, {b}) = 0"


LT = ("CASE WHEN l_returnflag = 'A' AND l_linestatus = 'F' THEN 'Usage' "
      "WHEN l_returnflag = 'A' AND l_linestatus = 'O' THEN 'DiscountedUsage' "
      "WHEN l_returnflag = 'N' AND l_linestatus = 'F' THEN 'SavingsPlanCoveredUsage' "
      "WHEN l_returnflag = 'N' AND l_linestatus = 'O' THEN 'Fee' "
      "WHEN l_returnflag = 'R' AND l_linestatus = 'F' THEN 'RIFee' "
      "WHEN l_returnflag = 'R' AND l_linestatus = 'O' THEN 'Tax' END")

CTE: dict[str, str] = {}

CTE["cur"] = f"""
SELECT l.l_shipdate AS line_item_usage_start_date,
  CAST(year(l.bm) AS VARCHAR) AS year, CAST(month(l.bm) AS VARCHAR) AS month,
  strftime(l.bm, '%Y-%m') AS billing_period,
  CAST(l.l_suppkey AS VARCHAR) AS line_item_usage_account_id,
  'payer-' || CAST(l.l_suppkey % 3 AS VARCHAR) AS bill_payer_account_id,
  CASE WHEN l.l_suppkey % 10 = 0 THEN 'AWS Marketplace' ELSE 'AWS' END AS bill_billing_entity,
  CASE WHEN p.p_size % 11 = 0 THEN NULL WHEN p.p_size % 13 = 0 THEN '' ELSE p.p_type END AS product_servicecode,
  p.p_name AS product_servicename, p.p_brand AS product_sku,
  'r-' || CAST(s.s_nationkey AS VARCHAR) AS product_region,
  'loc-' || CAST(s.s_nationkey AS VARCHAR) AS product_location,
  'EUR' AS line_item_currency_code,
  CASE WHEN CAST(floor(l.l_quantity) AS BIGINT) % 2 = 0 THEN NULL ELSE 'Reserved' END AS pricing_term,
  'Hrs' AS pricing_unit,
  l.lt AS line_item_line_item_type,
  'ut-' || CAST(l.l_linenumber AS VARCHAR) AS line_item_usage_type,
  CAST(l.l_quantity AS DECIMAL(20,8)) AS line_item_usage_amount,
  CAST(l.l_extendedprice AS DECIMAL(20,8)) AS line_item_unblended_cost,
  CAST(CAST(l.l_extendedprice AS DECIMAL(20,8)) * (1 - CAST(l.l_tax AS DECIMAL(10,4))) AS DECIMAL(20,8)) AS line_item_blended_cost,
  CAST(CAST(l.l_extendedprice AS DECIMAL(20,8)) * (1 - CAST(l.l_discount AS DECIMAL(10,4))) AS DECIMAL(20,8)) AS line_item_net_unblended_cost,
  CASE WHEN l.lt = 'DiscountedUsage' THEN CAST(l.l_quantity AS DECIMAL(20,8)) END AS reservation_net_effective_cost,
  CASE WHEN l.lt = 'SavingsPlanCoveredUsage' THEN CAST(l.l_quantity AS DECIMAL(20,8)) END AS savings_plan_net_savings_plan_effective_cost,
  CASE WHEN l.lt = 'RIFee' THEN CAST(l.l_quantity AS DECIMAL(20,8)) END AS reservation_net_unused_recurring_fee,
  CAST(CAST(l.l_extendedprice AS DECIMAL(20,8)) * (1 + CAST(l.l_tax AS DECIMAL(10,4))) AS DECIMAL(20,8)) AS pricing_public_on_demand_cost,
  p.p_type AS line_item_product_code,
  'env-' || CAST(l.l_partkey % 4 AS VARCHAR) AS resource_tags_user_client_env,
  CAST(l.l_shipdate AS DATE) AS d
FROM (SELECT *, {LT} AS lt,
        CAST(CASE WHEN l_linenumber = 7 THEN date_trunc('month', l_shipdate) - INTERVAL 1 MONTH
                  WHEN l_linenumber = 6 THEN date_trunc('month', l_shipdate) + INTERVAL 1 MONTH
                  ELSE date_trunc('month', l_shipdate) END AS DATE) AS bm
      FROM lineitem) l
JOIN part p ON l.l_partkey = p.p_partkey
JOIN supplier s ON l.l_suppkey = s.s_suppkey
"""

# the external accounts' tables: the same lines at other prices
CTE["cur_ext"] = """
SELECT * REPLACE (CAST(line_item_unblended_cost * 1.25 AS DECIMAL(20,8)) AS line_item_unblended_cost,
  CAST(line_item_blended_cost * 1.5 AS DECIMAL(20,8)) AS line_item_blended_cost,
  CAST(line_item_net_unblended_cost * 1.75 AS DECIMAL(20,8)) AS line_item_net_unblended_cost) FROM cur"""

BM_V1 = "make_date(CAST(year AS INTEGER), CAST(month AS INTEGER), 1)"
BM_V2 = "CAST(billing_period || '-01' AS DATE)"


_AWS_MEASURES = ("unblended_cost", "blended_cost", "net_unblended_cost")


def aws_daily_select(where: str, bm: str = BM_V1, internal: bool = True, src: str = "cur") -> str:
    """Named per-line values first, then one aggregation over them. The measures of an
    external load go to the ``ext_`` columns, where the net cost counts 0."""
    own, other = ("", "ext_") if internal else ("ext_", "")
    net = "SUM(net)" if internal else "0"
    totals = dict(zip(_AWS_MEASURES, ("SUM(unblended)", "SUM(blended)", net)))
    measures = ", ".join([f"CAST({totals[m]} AS DECIMAL(20,8)) AS {own}{m}" for m in _AWS_MEASURES]
                         + [f"CAST(0 AS DECIMAL(20,8)) AS {other}{m}" for m in _AWS_MEASURES])
    keys = "usage_date, billing_month, usage_account_id, service_code, sku_id, region, billing_type, usage_type"
    return f"""
SELECT {keys}, MAX(name) AS service_name, MAX(place) AS location, MAX(money) AS currency,
  COALESCE(MAX(term), 'OnDemand') AS pricing_type, CAST(SUM(amount) AS DECIMAL(30,8)) AS usage_amount,
  MAX(unit) AS usage_unit, {measures}
FROM (
  SELECT d AS usage_date, {bm} AS billing_month, line_item_usage_account_id AS usage_account_id,
    ifnull(product_servicecode, '') AS service_code, ifnull(product_sku, '') AS sku_id,
    ifnull(product_region, '') AS region, ifnull(line_item_line_item_type, '') AS billing_type,
    ifnull(line_item_usage_type, '') AS usage_type, ifnull(product_servicename, '') AS name,
    ifnull(product_location, '') AS place, ifnull(line_item_currency_code, '') AS money,
    pricing_term AS term, pricing_unit AS unit, ifnull(line_item_usage_amount, 0) AS amount,
    ifnull(line_item_unblended_cost, 0) AS unblended, ifnull(line_item_blended_cost, 0) AS blended,
    ifnull(line_item_net_unblended_cost, 0) AS net
  FROM {src} WHERE {where}) line
GROUP BY {keys}"""


P2_JULY = ("CAST(year AS INTEGER) = 2001 AND CAST(month AS INTEGER) = 7 AND "
           "((d >= DATE '2001-07-01' AND d <= DATE '2001-07-11') OR d >= DATE '2001-08-01')")
P2_JULY_V2 = ("billing_period = '2001-07' AND "
              "((d >= DATE '2001-07-01' AND d <= DATE '2001-07-11') OR d >= DATE '2001-08-01')")


def window_rule(ws: str, we: str, bm: str = BM_V1, d: str = "d") -> str:
    return (f"{bm} BETWEEN date_trunc('month', {ws}) AND date_trunc('month', {we}) AND "
            f"(({d} >= greatest({ws}, {bm}) AND {d} <= least({we}, last_day({bm}))) "
            f"OR {d} >= CAST({bm} + INTERVAL 1 MONTH AS DATE))")


CTE["aws_a1_v1"] = aws_daily_select(P2_JULY)
CTE["aws_a1_v2"] = aws_daily_select(P2_JULY_V2, BM_V2)
CTE["aws_a1_ext"] = aws_daily_select(P2_JULY, internal=False)
CTE["aws_i"] = aws_daily_select(window_rule(WS, WE))
CTE["aws_e"] = aws_daily_select(window_rule(WS, WE), internal=False, src="cur_ext")

# the reload of the clean-up run: a full-refresh day, so the previous month on
CTE["aws_clean"] = aws_daily_select(window_rule("DATE '2001-07-01'", "DATE '2001-08-14'"))

# the run over all sources: ten days, and a back-fill for the new version 2 report
_SHORT = ("DATE '2001-07-12'", "DATE '2001-07-21'")
for _name, _rule, _bm, _internal, _src in (
        ("src_v1", window_rule(*_SHORT), BM_V1, True, "cur"),
        ("src_a", window_rule(*_SHORT, BM_V2), BM_V2, True, "cur_v2_a"),
        ("src_b", window_rule("DATE '2001-01-01'", _SHORT[1], BM_V2), BM_V2, True, "cur_v2_b"),
        ("src_e", window_rule(*_SHORT), BM_V1, False, "cur_db")):
    CTE[_name] = aws_daily_select(_rule, _bm, _internal, _src)
# the third of the external database's tables has no location
CTE["cur_db"] = """
SELECT * REPLACE (CASE WHEN CAST(line_item_usage_account_id AS INTEGER) % 3 <> 2 THEN product_location END AS product_location)
FROM cur_ext"""
CTE["cur_v2_a"], CTE["cur_v2_b"] = (f"""
SELECT * REPLACE (CAST(line_item_unblended_cost * {_x} AS DECIMAL(20,8)) AS line_item_unblended_cost,
  CAST(line_item_blended_cost * {_x} AS DECIMAL(20,8)) AS line_item_blended_cost) FROM cur
WHERE CAST(line_item_usage_account_id AS INTEGER) % 4 = {_n}""" for _n, _x in ((1, "1.1"), (2, "1.2")))

CTE["aws_view"] = """
SELECT d AS usage_date, make_date(CAST(year AS INTEGER), CAST(month AS INTEGER), 1) AS billing_month,
  line_item_usage_account_id AS usage_account_id, COALESCE(product_servicecode, '') AS service_code,
  COALESCE(product_sku, '') AS sku_id, COALESCE(product_region, '') AS region,
  COALESCE(line_item_line_item_type, '') AS billing_type, COALESCE(line_item_usage_type, '') AS usage_type,
  year, month,
  COALESCE(MAX(product_servicename), '') AS service_name, COALESCE(MAX(product_location), '') AS location,
  COALESCE(MAX(line_item_currency_code), '') AS currency, COALESCE(MAX(pricing_term), 'OnDemand') AS pricing_type,
  CAST(COALESCE(SUM(line_item_usage_amount), 0) AS DECIMAL(30,8)) AS usage_amount,
  MAX(pricing_unit) AS usage_unit,
  CAST(COALESCE(SUM(line_item_net_unblended_cost), 0) AS DECIMAL(20,8)) AS cost
FROM cur WHERE line_item_line_item_type IN ('Usage', 'DiscountedUsage')
GROUP BY 1, 2, 3, 4, 5, 6, 7, 8, 9, 10"""

CTE["aws_vw"] = f"""
SELECT * FROM aws_view WHERE {window_rule(WS, WE, "billing_month", "usage_date")}"""

CTE["src_w"] = f"""
SELECT * FROM aws_view WHERE {window_rule(*_SHORT, "billing_month", "usage_date")}"""

_AK = ["usage_date", "billing_month", "usage_account_id", "service_code", "sku_id", "region",
       "billing_type", "usage_type"]
_ON = " AND ".join(f"i.{k} = v.{k}" for k in _AK)

CTE["aws_daily"] = f"""
SELECT {", ".join("i." + k for k in _AK)},
  CASE WHEN v.usage_date IS NULL THEN i.service_name ELSE v.service_name END AS service_name,
  CASE WHEN v.usage_date IS NULL THEN i.location ELSE v.location END AS location,
  CASE WHEN v.usage_date IS NULL THEN i.currency ELSE v.currency END AS currency,
  CASE WHEN v.usage_date IS NULL THEN i.pricing_type ELSE v.pricing_type END AS pricing_type,
  CASE WHEN v.usage_date IS NULL THEN i.usage_amount ELSE v.usage_amount END AS usage_amount,
  CASE WHEN v.usage_date IS NULL THEN i.usage_unit ELSE v.usage_unit END AS usage_unit,
  i.unblended_cost, i.blended_cost, i.net_unblended_cost,
  CASE WHEN v.usage_date IS NULL THEN e.ext_unblended_cost ELSE v.cost END AS ext_unblended_cost,
  CASE WHEN v.usage_date IS NULL THEN e.ext_blended_cost ELSE CAST(0 AS DECIMAL(20,8)) END AS ext_blended_cost,
  CAST(0 AS DECIMAL(20,8)) AS ext_net_unblended_cost
FROM aws_i i JOIN aws_e e USING ({", ".join(_AK)}) LEFT JOIN aws_vw v ON {_ON}"""

# descriptors from the last source that has the key, measures from the last one that owns them
_DESCRIBED = ["service_name", "location", "currency", "pricing_type", "usage_amount", "usage_unit"]
_OWN = ", ".join([f"ifnull(arg_max({m}, seq) FILTER (seq < 4), 0) AS {m}" for m in _AWS_MEASURES]
                 + [f"ifnull(arg_max(ext_{m}, seq) FILTER (seq > 3), 0) AS ext_{m}" for m in _AWS_MEASURES])
CTE["aws_sources"] = f"""
SELECT {", ".join(_AK)}, {", ".join(f"arg_max({c}, seq) AS {c}" for c in _DESCRIBED)}, {_OWN}
FROM (SELECT *, 1 AS seq FROM src_v1 UNION ALL BY NAME SELECT *, 2 AS seq FROM src_a
      UNION ALL BY NAME SELECT *, 3 AS seq FROM src_b UNION ALL BY NAME SELECT *, 4 AS seq FROM src_e
      UNION ALL BY NAME SELECT * EXCLUDE (year, month, cost), cost AS ext_unblended_cost,
        CAST(0 AS DECIMAL(20,8)) AS ext_blended_cost, CAST(0 AS DECIMAL(20,8)) AS ext_net_unblended_cost, 5 AS seq FROM src_w)
GROUP BY ALL"""

# --- GCP -------------------------------------------------------------------------
CTE["gcp"] = r"""
SELECT ust AS usage_start_time,
  CAST(ust AS DATE) + CAST(event_id % 3 AS INTEGER) AS partition_date,
  'ba-' || CAST(user_id % 3 AS VARCHAR) AS billing_account_id,
  CASE WHEN user_id % 20 = 0 THEN NULL ELSE 'p-' || CAST(user_id AS VARCHAR) END AS project_id,
  'proj ' || CAST(user_id AS VARCHAR) AS project_name,
  event_type AS service_id, upper(event_type) AS service_description,
  'sku-' || CAST(k % 10 AS VARCHAR) AS sku_id, 'SKU-' || CAST(k % 10 AS VARCHAR) AS sku_description,
  'eu-' || CAST(k % 3 AS VARCHAR) AS region, 'EU' AS location, 'EUR' AS currency,
  CASE event_type WHEN 'error' THEN 'tax' WHEN 'signup' THEN 'adjustment' ELSE 'regular' END AS cost_type,
  CAST(value AS DECIMAL(20,8)) AS usage_amount, 'h' AS usage_unit, CAST(value AS DECIMAL(20,8)) AS cost,
  CAST(CASE k % 4 WHEN 0 THEN a1 WHEN 1 THEN 0 WHEN 2 THEN 0 ELSE a1 + a2 END AS DECIMAL(20,8)) AS credit_sum,
  (k % 4 = 2) AS credits_null,
  CASE WHEN k = 97 THEN NULL
       WHEN k % 13 = 0 THEN strftime(date_trunc('month', ust) - INTERVAL 1 MONTH, '%Y%m')
       ELSE strftime(date_trunc('month', ust), '%Y%m') END AS invoice_month
FROM (SELECT *, CAST(CAST(value AS DECIMAL(20,8)) * -0.1 AS DECIMAL(20,8)) AS a1,
             CAST(CAST(value AS DECIMAL(20,8)) * -0.01 AS DECIMAL(20,8)) AS a2
      FROM (SELECT *, CAST(regexp_extract(props, '(\d+)', 1) AS INTEGER) AS k,
                   ts - INTERVAL 8219 DAY AS ust FROM events))"""


# every line under the names of the daily table, before anything is summed
CTE["gcp_lines"] = """
SELECT partition_date, usage_start_time::DATE AS usage_date, strptime(invoice_month, '%Y%m')::DATE AS month,
  billing_account_id, ifnull(project_id, '') AS project_id, ifnull(service_id, '') AS service_code,
  ifnull(sku_id, '') AS sku_id, ifnull(region, '') AS region, ifnull(cost_type, '') AS cost_type,
  {'project_name': ifnull(project_name, ''), 'service_name': ifnull(service_description, ''),
   'sku_description': ifnull(sku_description, ''), 'location': ifnull(location, ''),
   'currency': ifnull(currency, ''), 'usage_unit': ifnull(usage_unit, '')} AS words,
  ifnull(usage_amount, 0) AS amount, ifnull(cost, 0) AS price, credit_sum AS credit
FROM gcp"""
_GCP_KEY = "usage_date, billing_account_id, project_id, service_code, sku_id, region, cost_type"
_GCP_WORDS = ("project_name", "service_name", "sku_description", "location", "currency", "usage_unit")


def gcp_daily_select(lo: str, hi: str, internal: bool = True, src: str = "gcp_lines") -> str:
    """One aggregate over the lines of an ingestion window. The external accounts' lines have
    twice the price and three times the credit, and fill the ``ext_`` columns."""
    own, other, price, credit = ("", "ext_", 1, 1) if internal else ("ext_", "", 2, 3)
    return f"""
SELECT {_GCP_KEY}, max(month) AS billing_month, {", ".join(f"max(words.{w}) AS {w}" for w in _GCP_WORDS)},
  sum(amount)::DECIMAL(30,8) AS usage_amount,
  sum(price * {price})::DECIMAL(20,8) AS {own}cost, sum(credit * {credit})::DECIMAL(20,8) AS {own}credits,
  0::DECIMAL(20,8) AS {other}cost, 0::DECIMAL(20,8) AS {other}credits
FROM {src} WHERE partition_date BETWEEN {lo} AND {hi} GROUP BY ALL"""


CTE["gcp_daily"] = gcp_daily_select(WS, WE)
CTE["gcp_e"] = gcp_daily_select(WS, WE, internal=False)
CTE["gcp_both"] = """
SELECT gcp_daily.* REPLACE (gcp_e.ext_cost AS ext_cost, gcp_e.ext_credits AS ext_credits) FROM gcp_daily
JOIN gcp_e USING (usage_date, billing_account_id, project_id, service_code, sku_id, region, cost_type)"""
CTE["gcp_runs"] = gcp_daily_select("DATE '2000-12-01'", "DATE '2001-08-02'")
# the lines from 15 July on arrive five days late
CTE["gcp_late"] = gcp_daily_select(WS, AS_OF, src="(SELECT * FROM gcp_lines WHERE partition_date < DATE '2001-07-15' UNION ALL "
                                   "SELECT * FROM gcp_moved)")
CTE["gcp_moved"] = """
SELECT * REPLACE (partition_date + 5 AS partition_date) FROM gcp_lines WHERE partition_date + 5 >= DATE '2001-07-15'"""
CTE["gcp_refresh"] = gcp_daily_select("DATE '2001-07-11'", "DATE '2001-07-20'")

# --- Huawei -------------------------------------------------------------------------
CTE["hw"] = """
SELECT strftime(CASE WHEN o_orderkey % 9 = 0 THEN date_trunc('month', o_orderdate) + INTERVAL 1 MONTH
                     ELSE date_trunc('month', o_orderdate) END, '%Y-%m') AS cycle,
  CAST(o_orderdate AS DATE) AS bill_date,
  CASE o_orderstatus WHEN 'F' THEN 5 WHEN 'O' THEN 15 WHEN 'P' THEN 4 END AS bill_type,
  CAST(o_custkey AS VARCHAR) AS customer_id,
  'eu-west-' || CAST(o_custkey % 2 AS VARCHAR) AS region,
  'EU West ' || CAST(o_custkey % 2 AS VARCHAR) AS region_name,
  o_orderpriority AS cloud_service_type,
  'rt-' || CAST(o_orderkey % 2 AS VARCHAR) AS resource_type_code,
  lower(o_orderpriority) AS cloud_service_type_name,
  'type ' || CAST(o_orderkey % 2 AS VARCHAR) AS resource_type_name,
  'res-' || CAST(o_orderkey % 7 AS VARCHAR) AS resource_name,
  'hw-' || CAST(o_orderkey % 4 AS VARCHAR) AS sku_code,
  CASE WHEN o_orderkey % 5 = 0 THEN NULL ELSE '0' END AS enterprise_project_id,
  CASE WHEN o_orderkey % 5 = 0 THEN NULL ELSE 'default' END AS enterprise_project_name,
  CASE o_orderkey % 3 WHEN 0 THEN 1 WHEN 1 THEN 3 ELSE 10 END AS charge_mode,
  CAST(o_totalprice AS DECIMAL(20,8)) AS consume_amount,
  CAST(NULL AS DECIMAL(20,8)) AS debt_amount,
  CAST(CAST(o_totalprice AS DECIMAL(20,8)) * 1.2 AS DECIMAL(20,8)) AS official_amount,
  'spec-' || CAST(o_orderkey % 4 AS VARCHAR) AS product_spec_desc,
  'payer-' || CAST(o_custkey % 3 AS VARCHAR) AS payer_account_id
FROM orders"""

def hw_daily_select(lo: str, hi: str) -> str:
    return f"""
SELECT bill_date, CAST(cycle || '-01' AS DATE) AS billing_month,
  COALESCE(payer_account_id, '') AS payer_account_id, COALESCE(customer_id, '') AS customer_id,
  COALESCE(enterprise_project_id, '') AS enterprise_project_id,
  MIN(COALESCE(enterprise_project_name, '')) AS enterprise_project_name,
  COALESCE(cloud_service_type, '') AS cloud_service_type,
  MIN(COALESCE(cloud_service_type_name, '')) AS cloud_service_type_name,
  COALESCE(sku_code, '') AS sku_code, MIN(COALESCE(product_spec_desc, '')) AS product_spec_desc,
  COALESCE(resource_type_code, '') AS resource_type_code,
  MIN(COALESCE(resource_type_name, '')) AS resource_type_name,
  MIN(COALESCE(resource_name, '')) AS resource_name,
  COALESCE(region, '') AS region, MIN(COALESCE(region_name, '')) AS region_name,
  CAST(charge_mode AS INTEGER) AS charge_mode, CAST(bill_type AS INTEGER) AS bill_type,
  CAST(NULL AS DECIMAL(30,8)) AS usage_amount,
  CAST(COALESCE(SUM(consume_amount), 0) AS DECIMAL(20,8)) AS consume_amount,
  CAST(COALESCE(SUM(debt_amount), 0) AS DECIMAL(20,8)) AS debt_amount,
  CAST(COALESCE(SUM(official_amount), 0) AS DECIMAL(20,8)) AS official_amount,
  CAST(0 AS DECIMAL(20,8)) AS ext_consume_amount, CAST(0 AS DECIMAL(20,8)) AS ext_debt_amount,
  CAST(0 AS DECIMAL(20,8)) AS ext_official_amount
FROM hw WHERE bill_date BETWEEN {lo} AND {hi}
GROUP BY 1, 2, 3, 4, 5, 7, 9, 11, 14, 16, 17"""


CTE["hw_daily_int"] = hw_daily_select(WS, WE)

# every external amount is a fixed multiple of the line's internal one, so the sums are too
CTE["hw_daily"] = """
SELECT * REPLACE (CAST(consume_amount * 1.1 AS DECIMAL(20,8)) AS ext_consume_amount, debt_amount AS ext_debt_amount,
  CAST(official_amount * 1.3 AS DECIMAL(20,8)) AS ext_official_amount)
FROM hw_daily_int"""


# --- service level ----------------------------------------------------------------------

# per provider: source and its date, accounts, service, type and costs under common names
_LINES = {
    "HWC": """SELECT bill_date AS day, billing_month, payer_account_id AS ba, customer_id AS ua, CAST(NULL AS VARCHAR) AS uan,
        cloud_service_type AS sc, cloud_service_type_name AS sn, CAST(bill_type AS VARCHAR) AS bt,
        consume_amount AS c, ext_official_amount AS e FROM hw_daily""",
    "GCP": """SELECT usage_date AS day, billing_month, billing_account_id AS ba, project_id AS ua, project_name AS uan,
        service_code AS sc, service_name AS sn, cost_type AS bt, ifnull(cost, 0) + ifnull(credits, 0) AS c,
        ifnull(ext_cost, 0) + ifnull(ext_credits, 0) AS e FROM gcp_both""",
    "AWS": """SELECT usage_date AS day, billing_month, '' AS ba, usage_account_id AS ua, CAST(NULL AS VARCHAR) AS uan,
        service_code AS sc, service_name AS sn, billing_type AS bt, unblended_cost AS c,
        ext_unblended_cost AS e FROM aws_daily""",
}


def rollup_select(provider: str, outside: bool, ws: str, we: str) -> str:
    """A late row moves to the end of its billing month."""
    late = f"NOT ({_same_month('billing_month', 'day')})"
    keep = f"{late} AND billing_month >= {ws}" if outside else f"NOT ({late}) AND day BETWEEN {ws} AND {we}"
    return f"""
SELECT moved AS usage_date, '{provider}' AS cloud_provider, ba AS billing_account_id, ua AS usage_account_id,
  MAX(uan) AS usage_account_name, sc AS service_code, MAX(sn) AS service_name, bt AS billing_type,
  {str(outside).lower()} AS is_li_outside_of_month,
  CAST(SUM(c) AS DECIMAL(20,8)) AS cost, CAST(SUM(e) AS DECIMAL(20,8)) AS ext_cost
FROM (SELECT *, {"last_day(billing_month)" if outside else "day"} AS moved FROM ({_LINES[provider]}) WHERE {keep})
GROUP BY moved, ba, ua, sc, bt"""


def slb_rows(ws: str, we: str) -> str:
    return "\nUNION ALL\n".join(rollup_select(p, o, ws, we) for p in ("HWC", "GCP", "AWS") for o in (False, True))


for _p in ("HWC", "GCP", "AWS"):
    for _o in (False, True):
        CTE[f"rollup_{_p}_{int(_o)}"] = rollup_select(_p, _o, WS, WE)

CTE["service_types"] = """
SELECT DISTINCT p_type AS code, 'AWS' AS cloud_provider,
  CASE WHEN p_type = 'ECONOMY' THEN '' ELSE 'cat-' || lower(p_type) END AS parent_category
FROM part WHERE p_type <> 'LARGE'
UNION ALL SELECT DISTINCT event_type, 'GCP', 'cat-' || event_type FROM events
UNION ALL SELECT DISTINCT o_orderpriority, 'HWC', 'cat-' || o_orderpriority FROM orders"""


def slb_select(rows_cte: str) -> str:
    cls = _class("r.billing_type")
    return f"""
SELECT r.usage_date, r.cloud_provider, r.billing_account_id, r.usage_account_id, r.usage_account_name,
  r.service_code, r.service_name, r.billing_type, r.is_li_outside_of_month,
  CASE WHEN r.service_code = '' THEN {cls}
       WHEN st.code IS NOT NULL AND st.parent_category = '' THEN {cls}
       WHEN st.code IS NOT NULL THEN st.parent_category
       ELSE 'Unknown' END AS parent_category,
  r.cost, r.ext_cost
FROM {rows_cte} r
LEFT JOIN (SELECT code, cloud_provider, MAX(parent_category) AS parent_category
           FROM service_types GROUP BY 1, 2) st
  ON r.service_code = st.code AND r.cloud_provider = st.cloud_provider"""


CTE["slb_rows"] = slb_rows(WS, WE)
CTE["slb"] = slb_select("slb_rows")
CTE["slb_rows_old"] = slb_rows(OLD_WS, OLD_WE)
CTE["slb_old"] = slb_select("slb_rows_old")
CTE["slb_hist"] = """
SELECT * FROM slb_old
UNION ALL SELECT * REPLACE (service_code || '-retired' AS service_code) FROM slb_old"""

# --- dimensions -----------------------------------------------------------------------
CTE["organizations"] = """
SELECT CAST(n_nationkey + 1 AS BIGINT) AS id, n_name AS name,
  n_regionkey = 0 AS internal, n_regionkey = 1 AS exceptional FROM nation"""
CTE["products"] = """
SELECT CAST(s_suppkey AS BIGINT) AS id, s_name AS name, CAST(s_nationkey + 1 AS BIGINT) AS organization_id
FROM supplier"""
CTE["product_accounts"] = """
SELECT CAST(s_suppkey AS BIGINT) AS product_id, CAST(s_nationkey + 1 AS BIGINT) AS organization_id,
  CAST(s_suppkey AS VARCHAR) AS account_id, 'AWS' AS cloud_provider FROM supplier
UNION ALL SELECT CAST(s_suppkey AS BIGINT), CAST(s_nationkey + 1 AS BIGINT),
  'p-' || CAST(s_suppkey AS VARCHAR), 'GCP' FROM supplier
UNION ALL SELECT CAST(s_suppkey AS BIGINT), CAST(s_nationkey + 1 AS BIGINT),
  CAST(s_suppkey + 5 AS VARCHAR), 'HWC' FROM supplier
UNION ALL SELECT CAST(s_suppkey AS BIGINT), CAST(s_nationkey + 1 AS BIGINT),
  CAST(s_suppkey AS VARCHAR), 'AWS' FROM supplier WHERE s_suppkey % 10 = 0"""
CTE["prods"] = """
SELECT p.id AS product_id, p.name AS product_name, p.organization_id, o.name AS organization_name,
  o.internal, o.exceptional
FROM products p JOIN organizations o ON p.organization_id = o.id"""
CTE["ext_prods"] = "SELECT * FROM prods WHERE NOT internal"
CTE["acc_all"] = """
SELECT DISTINCT pa.product_id, pa.organization_id, pa.account_id
FROM product_accounts pa JOIN prods p ON pa.product_id = p.product_id AND pa.organization_id = p.organization_id"""
CTE["acc_ext"] = """
SELECT DISTINCT pa.product_id, pa.organization_id, pa.account_id
FROM product_accounts pa JOIN ext_prods p ON pa.product_id = p.product_id AND pa.organization_id = p.organization_id"""
CTE["billings"] = """
SELECT DATE '2001-06-01' AS month_date, CAST(s_suppkey AS BIGINT) AS product_id,
  CAST(s_nationkey + 1 AS BIGINT) AS organization_id, 'AWS' AS cloud_provider,
  CAST(0 AS DECIMAL(20,8)) AS cost, CAST(0 AS DECIMAL(20,2)) AS handling_fee,
  CAST(0 AS DECIMAL(20,2)) AS support_fee, CAST(s_suppkey AS BIGINT) AS invoice_number,
  DATE '2001-06-04' AS created_date, DATE '2001-07-04' AS due_date
FROM supplier WHERE s_suppkey % 2 = 0"""
CTE["bem"] = """
SELECT p.id AS product_id, 'ent-' || CAST(p.id % 6 AS VARCHAR) AS billing_entity
FROM products p JOIN organizations o ON p.organization_id = o.id
WHERE o.exceptional AND p.id % 2 = 0"""
CTE["org_accounts"] = """
SELECT CAST(s_suppkey AS VARCHAR) AS account_id,
  CASE WHEN s_suppkey % 7 = 0 THEN NULL ELSE 'ent-' || CAST(s_suppkey % 6 AS VARCHAR) END AS billing_entity
FROM supplier WHERE s_suppkey % 10 <> 9"""

# --- pricing ----------------------------------------------------------------------------
CTE["pricing_raw"] = """
SELECT c_custkey, CAST(c_nationkey + 1 AS BIGINT) AS organization_id,
  CASE c_custkey % 3 WHEN 0 THEN 'AWS' WHEN 1 THEN 'GCP' ELSE 'HWC' END AS cloud_provider,
  DATE '1995-01-01' + CAST((c_custkey * 37) % 2400 AS INTEGER) AS start_date,
  CAST(c_custkey % 20 AS DECIMAL(9,4)) AS discount,
  CAST(c_custkey % 7 AS DECIMAL(9,4)) AS handling_fee,
  CAST(CAST(c_custkey % 5 AS DECIMAL(9,4)) + 0.25 AS DECIMAL(9,4)) AS support_fee
FROM customer"""
CTE["pricing"] = """
SELECT organization_id, cloud_provider, start_date,
  arg_max(discount, c_custkey) AS discount, arg_max(handling_fee, c_custkey) AS handling_fee,
  arg_max(support_fee, c_custkey) AS support_fee
FROM pricing_raw GROUP BY 1, 2, 3"""
CTE["pricing_old"] = """
SELECT organization_id, cloud_provider, start_date, CAST(discount + 1 AS DECIMAL(10,4)) AS discount,
  handling_fee, support_fee FROM pricing WHERE organization_id % 2 = 0"""


def intervals_select(src: str, as_of: str) -> str:
    return f"""
SELECT organization_id, cloud_provider, start_date,
  COALESCE(LEAD(start_date) OVER (PARTITION BY organization_id, cloud_provider
                                  ORDER BY start_date, discount, handling_fee, support_fee),
           CAST(greatest((SELECT MAX(start_date) FROM {src}), {as_of}) + 1 AS DATE)) AS next_start_date,
  discount, handling_fee, support_fee
FROM {src}"""


def daily_pricing_select(iv: str) -> str:
    return f"""
SELECT CAST(unnest(generate_series(start_date, CAST(next_start_date - 1 AS DATE), INTERVAL 1 DAY)) AS DATE)
         AS pricing_date,
  organization_id, cloud_provider,
  CAST(COALESCE(discount, 0) AS DECIMAL(9,4)) AS discount,
  CAST(COALESCE(handling_fee, 0) AS DECIMAL(9,4)) AS handling_fee,
  CAST(COALESCE(support_fee, 0) AS DECIMAL(9,4)) AS support_fee
FROM {iv} WHERE start_date < next_start_date"""


CTE["intervals"] = intervals_select("pricing", AS_OF)
CTE["daily_pricing"] = daily_pricing_select("intervals")
CTE["intervals_old"] = intervals_select("pricing_old", "DATE '2001-07-15'")
CTE["daily_pricing_old"] = daily_pricing_select("intervals_old")
CTE["active_pricing"] = f"""
SELECT organization_id, cloud_provider, start_date, discount, handling_fee, support_fee FROM (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY organization_id, cloud_provider
                               ORDER BY start_date DESC, discount DESC, handling_fee DESC, support_fee DESC) AS rn
  FROM pricing WHERE start_date <= {AS_OF}) WHERE rn = 1"""


# --- customer cost ------------------------------------------------------------------------

def cc_calc(prods: str, acc: str, lo: str, hi: str) -> str:
    return f"""
SELECT product_id, organization_id, usage_date, cloud_provider, c,
  CAST(c - c * COALESCE(discount, 0) * 0.01 AS DECIMAL(20,8)) AS ad, handling_fee, support_fee
FROM (
  SELECT a.product_id, a.organization_id, s.usage_date, s.cloud_provider,
    CASE WHEN p.internal THEN COALESCE(s.cost, 0) ELSE COALESCE(s.ext_cost, 0) END AS c,
    dp.discount, dp.handling_fee, dp.support_fee
  FROM slb s
  JOIN {acc} a ON s.usage_account_id = a.account_id
  JOIN {prods} p ON p.product_id = a.product_id AND p.organization_id = a.organization_id
  LEFT JOIN daily_pricing dp ON dp.organization_id = a.organization_id AND dp.cloud_provider = s.cloud_provider
    AND dp.pricing_date = s.usage_date
  WHERE s.usage_date BETWEEN {lo} AND {hi})"""


def a13_select(calc: str) -> str:
    return f"""
SELECT product_id, organization_id, usage_date, cloud_provider,
  CAST(SUM(c) AS DECIMAL(20,8)) AS cost,
  CAST(SUM(ad) AS DECIMAL(20,8)) AS after_discount_cost,
  CAST(SUM(CAST(ad * COALESCE(handling_fee, 0) * 0.01 AS DECIMAL(20,8))) AS DECIMAL(20,8)) AS handling_fee,
  CAST(SUM(CAST(ad * COALESCE(support_fee, 0) * 0.01 AS DECIMAL(20,8))) AS DECIMAL(20,8)) AS support_fee
FROM {calc} GROUP BY 1, 2, 3, 4"""


CTE["calc_ext"] = cc_calc("ext_prods", "acc_ext", PREV_LO, AS_OF)
CTE["cc"] = a13_select("calc_ext")
CTE["calc_all_prev"] = cc_calc("prods", "acc_all", PREV_LO, PREV_HI)
CTE["a14"] = """
SELECT product_id, organization_id, cloud_provider, CAST(SUM(ad) AS DECIMAL(20,8)) AS cost
FROM calc_all_prev GROUP BY 1, 2, 3"""
# taxed lines never count for the payer; a late line counts at the end of its billing month
CTE["payer_lines"] = f"""
SELECT a.product_id, a.organization_id, d.usage_date, d.billing_month, ifnull(d.net_unblended_cost, 0) AS net,
  {_same_month("d.usage_date", "d.billing_month")} AS in_month
FROM (FROM aws_daily WHERE billing_type <> 'Tax') d JOIN acc_ext a ON a.account_id = d.usage_account_id"""
CTE["a15"] = f"""
SELECT product_id, organization_id, usage_date, CAST(SUM(net) AS DECIMAL(20,8)) AS cost
FROM payer_lines WHERE in_month AND usage_date BETWEEN {PREV_LO} AND {AS_OF} GROUP BY ALL"""
CTE["a16"] = f"""
SELECT product_id, organization_id, last_day(billing_month) AS usage_date, CAST(SUM(net) AS DECIMAL(20,8)) AS cost
FROM payer_lines WHERE NOT in_month AND billing_month >= {PREV_LO} GROUP BY ALL"""

# --- amortized -------------------------------------------------------------------------------
_AM_TYPES = _lst(C.AMORTIZED_LINE_TYPES)
_ENTS = "'ent-0', 'ent-1', 'ent-2', 'ent-3'"
# each line's plain share (fees that are spread elsewhere count 0) and its three spread shares
CTE["amort_lines"] = f"""
SELECT d AS usage_date, CAST(year AS INTEGER) AS y, CAST(month AS INTEGER) AS m, line_item_usage_account_id AS account,
  resource_tags_user_client_env AS env,
  list_sum([ifnull(reservation_net_effective_cost, 0), ifnull(savings_plan_net_savings_plan_effective_cost, 0),
            ifnull(reservation_net_unused_recurring_fee, 0), plain]) AS share
FROM (SELECT *, CASE WHEN bill_billing_entity = 'AWS' AND line_item_line_item_type IN ('Fee', 'RIFee') THEN 0
                     WHEN bill_billing_entity = 'AWS Marketplace' AND line_item_line_item_type = 'Fee'
                          AND line_item_usage_account_id = '10' THEN 0
                     ELSE ifnull(line_item_net_unblended_cost, 0) END AS plain
      FROM cur WHERE line_item_line_item_type IN ({_AM_TYPES}))"""


def a11_select(y: int, m: int) -> str:
    return f"""
SELECT * FROM (
  SELECT l.usage_date, o.billing_entity, CAST(SUM(l.share) AS DECIMAL(20,8)) AS cost
  FROM amort_lines l JOIN org_accounts o ON o.account_id = l.account AND o.billing_entity IN ({_ENTS})
  WHERE l.y = {y} AND l.m = {m} GROUP BY ALL)
WHERE cost > 0"""


def a12_select(y: int, m: int) -> str:
    return f"""
SELECT * FROM (
  SELECT usage_date, 'ent-4' AS billing_entity, CAST(SUM(share) AS DECIMAL(20,8)) AS cost
  FROM amort_lines WHERE env = 'env-1' AND account = '7' AND y = {y} AND m = {m} GROUP BY ALL)
WHERE cost > 0"""


CTE["a11"] = a11_select(2001, 7)
CTE["a12"] = a12_select(2001, 7)
CTE["amort"] = f"""
SELECT usage_date, billing_entity, arg_max(cost, seq) AS cost FROM (
  SELECT *, 1 AS seq FROM ({a11_select(2001, 8)})
  UNION ALL SELECT *, 2 FROM ({a12_select(2001, 8)})
  UNION ALL SELECT *, 3 FROM ({a11_select(2001, 7)})
  UNION ALL SELECT *, 4 FROM ({a12_select(2001, 7)}))
GROUP BY 1, 2"""

CTE["f7"] = """
SELECT cc.usage_date AS day, cc.organization_id AS mc_org_id, p.organization_name AS mc_org_name,
  p.product_name AS customer_name, cc.cloud_provider,
  CAST(CASE WHEN cc.cloud_provider = 'HWC' THEN CAST(cc.cost * 0.45 AS DECIMAL(20,8))
            WHEN cc.cloud_provider = 'AWS' AND p.exceptional THEN COALESCE(am.cost, 0)
            WHEN cc.cloud_provider = 'AWS' THEN COALESCE(i.cost, 0) + COALESCE(o.cost, 0)
            ELSE cc.after_discount_cost END AS DECIMAL(20,8)) AS payer_cost,
  CAST(cc.after_discount_cost + cc.handling_fee + cc.support_fee AS DECIMAL(20,8)) AS customer_cost,
  NOT p.internal AS external
FROM cc JOIN ext_prods p ON cc.product_id = p.product_id AND cc.organization_id = p.organization_id
LEFT JOIN a15 i ON i.product_id = cc.product_id AND i.organization_id = cc.organization_id AND i.usage_date = cc.usage_date
LEFT JOIN a16 o ON o.product_id = cc.product_id AND o.organization_id = cc.organization_id AND o.usage_date = cc.usage_date
LEFT JOIN (SELECT b.product_id, a.usage_date, a.cost FROM amort a JOIN bem b ON a.billing_entity = b.billing_entity) am
  ON am.product_id = cc.product_id AND am.usage_date = cc.usage_date"""

CTE["invoice"] = """
SELECT DATE '2001-07-01' AS month_date, pc.product_id, pc.organization_id, pc.cloud_provider, pc.cost,
  CASE WHEN pc.cost IS NULL THEN CAST(0 AS DECIMAL(20,2))
       ELSE CAST(pc.cost * COALESCE(ap.handling_fee, 0) * 0.01 AS DECIMAL(20,2)) END AS handling_fee,
  CASE WHEN pc.cost IS NULL THEN CAST(0 AS DECIMAL(20,2))
       ELSE CAST(pc.cost * COALESCE(ap.support_fee, 0) * 0.01 AS DECIMAL(20,2)) END AS support_fee,
  CAST(COALESCE(lb.last_no, 0) + ROW_NUMBER() OVER (PARTITION BY pc.product_id ORDER BY pc.cloud_provider)
       AS BIGINT) AS invoice_number,
  DATE '2001-07-04' AS created_date, DATE '2001-08-04' AS due_date
FROM a14 pc
LEFT JOIN (SELECT product_id, MAX(invoice_number) AS last_no FROM billings GROUP BY 1) lb ON lb.product_id = pc.product_id
LEFT JOIN active_pricing ap ON ap.organization_id = pc.organization_id AND ap.cloud_provider = pc.cloud_provider"""

# lines with the entity of their account, null where the dimension does not know it
CTE["entity_lines"] = """
SELECT make_date(year::INTEGER, month::INTEGER, 1) AS period, year(make_date(year::INTEGER, 1, 1)) AS y, d,
  bill_payer_account_id, line_item_usage_account_id, line_item_unblended_cost AS unblended,
  known.entity AS billing_entity
FROM cur LEFT JOIN (SELECT account_id, billing_entity AS entity FROM org_accounts) known
  ON known.account_id = line_item_usage_account_id"""
# ---------------------------------------------------------------------------------------------
# Final queries
# ---------------------------------------------------------------------------------------------
_SLB_COLS = ("usage_date, cloud_provider, billing_account_id, usage_account_id, usage_account_name, service_code, "
             "service_name, billing_type, is_li_outside_of_month, parent_category, cost, ext_cost")
_SLB_KEYS = ["usage_date", "cloud_provider", "billing_account_id", "usage_account_id", "service_code",
             "billing_type", "is_li_outside_of_month"]
_PRICING_KEYS = ["pricing_date", "organization_id", "cloud_provider"]


def _anti(old: str, new: str, keys: list[str]) -> str:
    on = " AND ".join(f"n.{k} IS NOT DISTINCT FROM o.{k}" for k in keys)
    return f"NOT EXISTS (SELECT 1 FROM {new} n WHERE {on})"


FINAL: dict[str, str] = {
    "cur_usage_window_filter": f"""SELECT d AS usage_date, line_item_usage_account_id, line_item_line_item_type,
        line_item_unblended_cost FROM cur WHERE {P2_JULY}""",
    "aws_amortized_view_load": """SELECT usage_date, billing_month, usage_account_id, service_code, service_name,
        sku_id, region, location, currency, pricing_type, billing_type, usage_type, usage_amount, usage_unit,
        cost AS unblended_cost, CAST(0 AS DECIMAL(20,8)) AS blended_cost, CAST(0 AS DECIMAL(20,8)) AS net_unblended_cost
        FROM aws_view WHERE CAST(year AS INTEGER) = 2001 AND CAST(month AS INTEGER) = 7
        AND (usage_date BETWEEN DATE '2001-07-01' AND DATE '2001-07-11' OR usage_date >= DATE '2001-08-01')""",
    "multi_table_union": """SELECT d AS usage_date, line_item_usage_account_id, line_item_line_item_type,
        line_item_unblended_cost FROM cur_ext""",
    "huawei_json_explode": "SELECT * FROM hw_daily_int",
    "csv_gzip_roundtrip": "SELECT * FROM aws_a1_v1",
    "refresh_window_scan": "SELECT * FROM gcp_refresh",
    "external_organizations": "SELECT id, name, internal, exceptional FROM organizations WHERE NOT internal",
    "accounts_by_org_provider": """SELECT product_id, organization_id, account_id, cloud_provider
        FROM product_accounts WHERE organization_id = 2 AND cloud_provider = 'AWS'""",
    "aws_daily_cost_v1": "SELECT * FROM aws_a1_v1",
    "aws_daily_cost_v2": "SELECT * FROM aws_a1_v2",
    "route_internal_external": "SELECT * FROM aws_a1_ext",
    "gcp_daily_cost": "SELECT * FROM gcp_daily",
    "huawei_daily_cost": "SELECT * FROM hw_daily_int",
    "merge_aws_internal_external": f"""SELECT aws_i.* REPLACE (aws_e.ext_unblended_cost AS ext_unblended_cost,
        aws_e.ext_blended_cost AS ext_blended_cost) FROM aws_i JOIN aws_e USING ({", ".join(_AK)})""",
    "merge_gcp_internal_external": "SELECT * FROM gcp_both",
    "merge_huawei_internal_external": "SELECT * FROM hw_daily",
    "aws_load": "SELECT * FROM aws_daily",
    "gcp_load": "SELECT * FROM gcp_both",
    "huawei_load": "SELECT * FROM hw_daily",
    "aws_window_delete": """SELECT * FROM aws_daily
        WHERE NOT (usage_date >= DATE '2001-07-01' AND billing_month >= DATE '2001-07-01')""",
    "rollup_aws": "SELECT * FROM rollup_AWS_0",
    "rollup_aws_extra": "SELECT * FROM rollup_AWS_1",
    "rollup_gcp": "SELECT * FROM rollup_GCP_0",
    "rollup_gcp_extra": "SELECT * FROM rollup_GCP_1",
    "rollup_huawei": "SELECT * FROM rollup_HWC_0",
    "rollup_huawei_extra": "SELECT * FROM rollup_HWC_1",
    "service_level_billing": f"SELECT {_SLB_COLS} FROM slb",
    "service_category": "SELECT DISTINCT cloud_provider, service_code, billing_type, parent_category FROM slb",
    "billing_type_class": f"""SELECT cloud_provider, billing_type, {_class('billing_type')} AS billing_class FROM (
        SELECT DISTINCT 'AWS' AS cloud_provider, billing_type FROM aws_daily
        UNION SELECT DISTINCT 'GCP', cost_type FROM gcp_daily
        UNION SELECT DISTINCT 'HWC', CAST(bill_type AS VARCHAR) FROM hw_daily)""",
    "service_level_upsert": f"""SELECT {_SLB_COLS} FROM slb
        UNION ALL SELECT {_SLB_COLS} FROM slb_hist o WHERE {_anti('o', 'slb', _SLB_KEYS)}""",
    "service_level_purge_stale": f"""SELECT {_SLB_COLS} FROM slb
        UNION ALL SELECT {_SLB_COLS} FROM slb_hist o
        WHERE o.usage_date < DATE '2001-07-01' AND {_anti('o', 'slb', _SLB_KEYS)}""",
    "pricing_validity_intervals": "SELECT * FROM intervals",
    "date_spine": f"""SELECT CAST(unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS DATE) AS pricing_date
        FROM (SELECT MIN(start_date) AS lo, greatest(MAX(start_date), {AS_OF}) AS hi FROM pricing)""",
    "daily_org_pricing": "SELECT * FROM daily_pricing",
    "active_pricing": "SELECT * FROM active_pricing",
    "daily_pricing_upsert": f"""SELECT * FROM daily_pricing
        UNION ALL SELECT * FROM daily_pricing_old o WHERE {_anti('o', 'daily_pricing', _PRICING_KEYS)}""",
    "products_with_org": "SELECT * FROM prods",
    "product_cost_semi_join": f"""SELECT a.product_id, a.organization_id, s.usage_date, s.cloud_provider,
        s.usage_account_id, s.service_code, s.billing_type, s.is_li_outside_of_month, s.cost, s.ext_cost
        FROM slb s JOIN acc_all a ON s.usage_account_id = a.account_id
        WHERE s.usage_date BETWEEN {PREV_LO} AND {PREV_HI}""",
    "customer_cost_per_day": "SELECT * FROM cc",
    "invoice_provider_cost": "SELECT * FROM a14",
    "payer_cost_in_month": "SELECT * FROM a15",
    "payer_cost_outside_month": "SELECT * FROM a16",
    "latest_invoice_number": "SELECT product_id, MAX(invoice_number) AS invoice_number FROM billings GROUP BY 1",
    "monthly_invoice": "SELECT * FROM invoice",
    "invoice_append_new": "SELECT * FROM billings UNION ALL SELECT * FROM invoice",
    "customer_daily_cost": "SELECT * FROM f7",
    "customer_cost_upsert": """SELECT day, mc_org_id, 'old-' || mc_org_name AS mc_org_name, customer_name,
        cloud_provider, payer_cost, customer_cost, false AS external FROM f7""",
    "join_org_accounts": f"""SELECT a.d AS usage_date, a.line_item_usage_account_id, o.billing_entity,
        a.line_item_line_item_type, a.line_item_net_unblended_cost
        FROM cur a LEFT JOIN org_accounts o ON a.line_item_usage_account_id = o.account_id
        WHERE CAST(a.year AS INTEGER) = 2001 AND CAST(a.month AS INTEGER) = 7 AND o.billing_entity IN ({_ENTS})""",
    "amortized_cost_by_entity": "SELECT * FROM a11",
    "amortized_cost_tagged": "SELECT * FROM a12",
    "amortized_two_month": "SELECT * FROM amort",
    "report_product_cost": """SELECT line_item_product_code, month, year,
        CAST(ROUND(SUM(line_item_unblended_cost), 2) AS DECIMAL(22,2)) AS total_cost,
        CAST(ROUND(SUM(pricing_public_on_demand_cost), 2) AS DECIMAL(22,2)) AS on_demand_cost
        FROM cur WHERE CAST(year AS INTEGER) = 2001 AND CAST(month AS INTEGER) = 7
        GROUP BY 1, 2, 3 ORDER BY total_cost DESC""",
    "report_unclassified_lines": """SELECT d AS usage_date, kind AS billing_type, count(*) AS rows,
          sum(unblended)::DECIMAL(20,8) AS unblended_cost
        FROM (SELECT d, ifnull(line_item_line_item_type, 'UNKNOWN') AS kind, ifnull(line_item_unblended_cost, 0) AS unblended
              FROM cur WHERE len(product_servicecode) = 0 AND (year, month) = ('2001', '7') AND day(d) <= 7
                AND date_trunc('month', d) = DATE '2001-07-01') empty
        GROUP BY ALL ORDER BY usage_date""",
    "report_distinct_entities": "SELECT DISTINCT billing_entity FROM entity_lines WHERE period = DATE '2001-07-01'",
    "report_entity_accounts": f"""SELECT billing_entity, bill_payer_account_id, line_item_usage_account_id
        FROM entity_lines WHERE period = DATE '2001-07-01' AND billing_entity IN ({_ENTS}) GROUP BY ALL""",
    "report_entity_account_list": """SELECT ifnull(entity, 'UNKNOWN') AS billing_entity, accounts AS account_ids FROM (
        SELECT billing_entity AS entity, string_agg(account_id, ',' ORDER BY account_id) AS accounts
        FROM org_accounts GROUP BY ALL)""",
    "report_entity_cost": """SELECT billing_entity, sum(unblended)::DECIMAL(20,8) AS total_cost FROM entity_lines
        WHERE y = 2001 AND date_trunc('month', d) = DATE '2001-07-01' GROUP BY ALL""",
    "report_account_cost": """SELECT bill_payer_account_id, line_item_usage_account_id,
        CAST(SUM(line_item_unblended_cost) AS DECIMAL(20,8)) AS cost,
        CAST(SUM(line_item_blended_cost) AS DECIMAL(20,8)) AS blended_cost
        FROM cur WHERE year = '2001' AND d BETWEEN DATE '2001-07-01' AND DATE '2001-07-31' GROUP BY 1, 2""",
    "report_total_cost": """SELECT CAST(SUM(line_item_unblended_cost) AS DECIMAL(20,8)) AS cost,
        CAST(SUM(line_item_blended_cost) AS DECIMAL(20,8)) AS blended_cost
        FROM cur WHERE year = '2001' AND d BETWEEN DATE '2001-07-01' AND DATE '2001-07-31'""",
    "report_dimension_entities": "SELECT DISTINCT billing_entity FROM org_accounts",
    "organization_by_id": "SELECT id, name, internal, exceptional FROM organizations WHERE id = 2",
    "report_daily_cost": """SELECT d AS day, CAST(SUM(line_item_unblended_cost) AS DECIMAL(20,8)) AS cost
        FROM cur WHERE year = '2001' AND d BETWEEN DATE '2001-07-01' AND DATE '2001-07-31' GROUP BY 1 ORDER BY 1""",
    "report_coverage_gaps": """SELECT c.account_id, c.missing_day FROM (
        SELECT account_id, CAST(unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS DATE) AS missing_day
        FROM (SELECT usage_account_id AS account_id, MIN(usage_date) AS lo, MAX(usage_date) AS hi
              FROM aws_daily GROUP BY 1)) c
        LEFT JOIN (SELECT DISTINCT usage_account_id AS account_id, usage_date AS day FROM aws_daily) d
        ON c.account_id = d.account_id AND c.missing_day = d.day WHERE d.day IS NULL""",
    "scalar_date_ops": """SELECT usage_date, billing_month, last_day(billing_month) AS billing_month_end,
        CAST(date_trunc('month', usage_date) AS DATE) AS usage_month, CAST(usage_date + 1 AS DATE) AS next_day,
        CAST(billing_month + INTERVAL 1 MONTH AS DATE) AS next_billing_month,
        strftime(usage_date, '%Y-%m') AS usage_ym,
        CAST(strptime(strftime(billing_month, '%Y%m'), '%Y%m') AS DATE) AS billing_month_parsed,
        {same} AS in_month FROM aws_daily""".replace("{same}", _same_month("usage_date", "billing_month")),
    "scalar_struct_array_map": """SELECT CAST(usage_start_time AS DATE) AS usage_date,
        COALESCE(project_id, '') AS project_id, service_description AS service_name, region,
        credit_sum AS credits_total, credits_null AS credits_missing, usage_unit FROM gcp""",
    "stream_incremental_daily": "SELECT * FROM gcp_daily",
    "stream_late_lines": "SELECT * FROM gcp_late",
    "gcp_load_incremental": "SELECT * FROM gcp_runs",
    "catalog_fan_in": """SELECT d AS usage_date, line_item_usage_account_id, product_location,
        CASE WHEN CAST(line_item_usage_account_id AS INTEGER) % 3 = 1 THEN 'team-' || line_item_usage_account_id END
          AS resource_tags_user_team, line_item_usage_amount, line_item_unblended_cost
        FROM cur_db WHERE CAST(year AS INTEGER) = 2001 AND CAST(month AS INTEGER) = 7""",
    "relational_date_slices": f"""SELECT {_SLB_COLS} FROM slb
        WHERE usage_date BETWEEN {PREV_LO} AND {PREV_HI} AND cloud_provider = 'AWS'""",
    "gcp_parts_compacted": "SELECT * FROM gcp_runs",
    "aws_load_all_sources": "SELECT * FROM aws_sources",
    "aws_bucketed_load": "SELECT * FROM aws_daily",
    "gcp_bucketed_load": "SELECT * FROM gcp_both",
    "huawei_bucketed_load": "SELECT * FROM hw_daily",
    "service_level_bucketed_upsert": f"""SELECT {_SLB_COLS} FROM slb
        UNION ALL SELECT {_SLB_COLS} FROM slb_hist o WHERE {_anti('o', 'slb', _SLB_KEYS)}""",
    "huawei_pages_incremental": hw_daily_select("DATE '1992-01-01'", "DATE '2001-12-31'"),
    "huawei_load_incremental": hw_daily_select("DATE '2000-12-01'", "DATE '2001-08-15'"),
    "aws_cleanup_job": f"""SELECT * FROM aws_i WHERE NOT (usage_date >= DATE '2001-07-01' AND billing_month >= DATE '2001-07-01')
        AND NOT EXISTS (SELECT 1 FROM aws_clean n WHERE {" AND ".join(f"n.{k} = aws_i.{k}" for k in _AK)})
        UNION ALL SELECT * FROM aws_clean""",
    "service_level_job": f"SELECT {_SLB_COLS} FROM slb",
    "cur_v1_period_scan": """SELECT d AS usage_date, line_item_usage_account_id, line_item_line_item_type,
        line_item_unblended_cost FROM cur WHERE CAST(year AS INTEGER) = 2001 AND CAST(month AS INTEGER) = 7""",
    "cur_v2_period_scan": """SELECT d AS usage_date, line_item_usage_account_id, product_servicename AS service_name,
        product_region AS region FROM cur WHERE billing_period = '2001-07'""",
    "gcp_partition_scan": """SELECT CAST(usage_start_time AS DATE) AS usage_date, partition_date, billing_account_id,
        project_id, cost FROM gcp WHERE partition_date BETWEEN DATE '2001-07-11' AND DATE '2001-07-20'""",
    "huawei_typed_records": """SELECT bill_date, CAST(cycle || '-01' AS DATE) AS billing_month,
        COALESCE(payer_account_id, '') AS payer_account_id, COALESCE(customer_id, '') AS customer_id,
        COALESCE(enterprise_project_id, '') AS enterprise_project_id,
        COALESCE(enterprise_project_name, '') AS enterprise_project_name,
        COALESCE(cloud_service_type, '') AS cloud_service_type,
        COALESCE(cloud_service_type_name, '') AS cloud_service_type_name, COALESCE(sku_code, '') AS sku_code,
        COALESCE(product_spec_desc, '') AS product_spec_desc, COALESCE(resource_type_code, '') AS resource_type_code,
        COALESCE(resource_type_name, '') AS resource_type_name, COALESCE(resource_name, '') AS resource_name,
        COALESCE(region, '') AS region, COALESCE(region_name, '') AS region_name,
        CAST(charge_mode AS INTEGER) AS charge_mode, CAST(bill_type AS INTEGER) AS bill_type,
        consume_amount, debt_amount, official_amount FROM hw""",
    "pricing_start_bounds": "SELECT MIN(start_date) AS min_start, MAX(start_date) AS max_start FROM pricing",
    "distinct_accounts_in_range": """SELECT DISTINCT line_item_usage_account_id FROM cur
        WHERE year = '2001' AND d BETWEEN DATE '2001-07-01' AND DATE '2001-07-31'""",
    "daily_pricing_join": "SELECT product_id, organization_id, usage_date, cloud_provider, c AS cost, "
                          "ad AS after_discount_cost FROM calc_ext",
    "amortized_by_product": """SELECT b.product_id, a.usage_date, a.billing_entity, a.cost
        FROM amort a JOIN bem b ON a.billing_entity = b.billing_entity""",
}


def _deps(sql: str) -> list[str]:
    found = []
    for name in CTE:
        if re.search(rf"\b{re.escape(name)}\b", sql):
            found.append(name)
    return found


def build(final: str) -> str:
    """Prefix ``final`` with every CTE it needs (transitively), in dependency order."""
    order: list[str] = []
    seen: set[str] = set()

    def visit(name: str, stack: tuple[str, ...] = ()) -> None:
        if name in seen:
            return
        for dep in _deps(CTE[name]):
            if dep != name and dep not in stack:
                visit(dep, stack + (name,))
        seen.add(name)
        order.append(name)
    for n in _deps(final):
        visit(n)
    if not order:
        return final
    ctes = ",\n".join(f"{n} AS ({CTE[n]})" for n in order)
    return f"WITH {ctes}\n{final}"


def oracle_sql() -> dict[str, str]:
    return {k: build(v) for k, v in FINAL.items()}
