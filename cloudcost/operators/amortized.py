"""Amortized AWS cost per (day, billing entity): A11 (entities via the account
dimension), A12 (one tagged workload), U2 (two billing periods, older wins),
J1 (line items with their billing entity)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import config as C
from ..functions.dates import add_months, first_of_month
from ..sources import cur as cur_src


def amortized_line_cost(params: C.AmortizedParams) -> Column:
    """Effective cost of one line: RI effective + SP effective + net unblended
    (0 for plain-AWS fees and for marketplace fees of the configured account)
    + unused RI fee; every part NULL -> 0."""
    z = F.lit(0).cast(C.MONEY)
    lt = F.col("line_item_line_item_type")
    ent = F.col("bill_billing_entity")
    net = (F.when(lt.isin(*C.AMORTIZED_ZERO_FEE_TYPES) & (ent == C.AWS_ENTITY), z)
           .when((lt == "Fee") & (ent == C.AWS_MARKETPLACE_ENTITY)
                 & (F.col("line_item_usage_account_id") == params.marketplace_account), z)
           .otherwise(F.col("line_item_net_unblended_cost").cast(C.MONEY)))
    return (F.coalesce(F.col("reservation_net_effective_cost").cast(C.MONEY), z)
            + F.coalesce(F.col("savings_plan_net_savings_plan_effective_cost").cast(C.MONEY), z)
            + F.coalesce(net, z)
            + F.coalesce(F.col("reservation_net_unused_recurring_fee").cast(C.MONEY), z))


def _period_lines(cur: DataFrame, year: int, month: int) -> DataFrame:
    return cur.filter(cur_src.period_predicate(cur_src.V1, year, month)
                      & F.col("line_item_line_item_type").isin(*C.AMORTIZED_LINE_TYPES))


def join_org_accounts(cur: DataFrame, org_accounts: DataFrame, entities: tuple[str, ...],
                      year: int, month: int) -> DataFrame:
    """Lines of one period with the billing entity of their account; the
    LEFT JOIN + ``entity IN (...)`` is an inner join on the filtered dimension."""
    org = org_accounts.filter(F.col("billing_entity").isin(*entities)).select("account_id", "billing_entity")
    lines = cur.filter(cur_src.period_predicate(cur_src.V1, year, month))
    return lines.join(org, lines["line_item_usage_account_id"] == org["account_id"]).drop("account_id")


def amortized_cost_by_entity(cur: DataFrame, org_accounts: DataFrame, params: C.AmortizedParams,
                             year: int, month: int) -> DataFrame:
    """Positive amortized cost per (usage day, billing entity) of one period."""
    org = org_accounts.filter(F.col("billing_entity").isin(*params.entities)).select("account_id", "billing_entity")
    lines = _period_lines(cur, year, month)
    j = lines.join(org, lines["line_item_usage_account_id"] == org["account_id"])
    return (j.groupBy(F.to_date(cur_src.TS).alias("usage_date"), "billing_entity")
            .agg(F.sum(amortized_line_cost(params)).cast(C.MONEY).alias("cost"))
            .filter(F.col("cost") > 0))


def amortized_cost_tagged(cur: DataFrame, params: C.AmortizedParams, year: int, month: int) -> DataFrame:
    """The same cost for one tagged workload in one account, entity a literal."""
    lines = _period_lines(cur, year, month).filter(
        (F.col("resource_tags_user_client_env") == params.tag_value)
        & (F.col("line_item_usage_account_id") == params.tag_account))
    return (lines.groupBy(F.to_date(cur_src.TS).alias("usage_date"),
                          F.lit(params.tag_entity).alias("billing_entity"))
            .agg(F.sum(amortized_line_cost(params)).cast(C.MONEY).alias("cost"))
            .filter(F.col("cost") > 0))


def amortized_two_month(cur: DataFrame, org_accounts: DataFrame, params: C.AmortizedParams,
                        as_of: dt.date) -> DataFrame:
    """Both queries for the current and the previous billing period; on a
    (day, entity) present more than once the later result wins, i.e. the
    previous period beats the current one (tagged beats general in a period).

    One scan of the CUR: a line carries its period's place in that order and the list of
    entities it counts for (those of its account by the dimension, and the tagged workload's),
    which is inlined; place and entity are grouping columns. The dimension has one row an
    account, so a line stays one row in the join."""
    current = first_of_month(as_of)
    previous = add_months(current, -1)
    in_current, in_previous = (cur_src.period_predicate(cur_src.V1, m.year, m.month) for m in (current, previous))
    org = (org_accounts.filter(F.col("billing_entity").isin(*params.entities))
           .groupBy("account_id").agg(F.collect_list("billing_entity").alias("entities")))
    lines = cur.filter((in_current | in_previous) & F.col("line_item_line_item_type").isin(*C.AMORTIZED_LINE_TYPES))
    tagged = ((F.col("resource_tags_user_client_env") == params.tag_value)
              & (F.col("line_item_usage_account_id") == params.tag_account))
    period = F.when(in_previous, 2).otherwise(0)

    def rule(entity, place: int):
        return F.struct((period + F.lit(place)).alias("seq"), entity.alias("billing_entity"))
    none = F.array().cast("array<struct<seq:int,billing_entity:string>>")
    rules = F.concat(F.coalesce(F.transform("entities", lambda e: rule(e, 0)), none),
                     F.when(tagged, F.array(rule(F.lit(params.tag_entity), 1))).otherwise(none))
    counted = lines.join(org, lines["line_item_usage_account_id"] == org["account_id"], "left").select(
        F.to_date(cur_src.TS).alias("usage_date"), amortized_line_cost(params).alias("line_cost"), F.inline(rules))
    totals = (counted.groupBy("usage_date", "billing_entity", "seq")
              .agg(F.sum("line_cost").cast(C.MONEY).alias("cost")).filter(F.col("cost") > 0))
    return totals.groupBy("usage_date", "billing_entity").agg(F.max_by("cost", "seq").alias("cost"))
