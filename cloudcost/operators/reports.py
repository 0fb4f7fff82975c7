"""Ad-hoc cost reports over CUR line items (D1-D8) and the coverage-gap check (R2)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import config as C
from ..functions.dates import ts_date_between
from ..sources import cur as cur_src

TS = cur_src.TS


def _month(cur: DataFrame, year: int, month: int) -> DataFrame:
    return cur.filter(cur_src.period_predicate(cur_src.V1, year, month))


def report_product_cost(cur: DataFrame, year: int, month: int) -> DataFrame:
    """Cost and on-demand cost by product code for one month, largest first."""
    return (_month(cur, year, month)
            .groupBy("line_item_product_code", "month", "year")
            .agg(F.round(F.sum(F.col("line_item_unblended_cost").cast(C.MONEY)), 2).cast("decimal(22,2)")
                 .alias("total_cost"),
                 F.round(F.sum(F.col("pricing_public_on_demand_cost").cast(C.MONEY)), 2).cast("decimal(22,2)")
                 .alias("on_demand_cost"))
            .orderBy(F.col("total_cost").desc()))


def report_unclassified_lines(cur: DataFrame, year: int, month: int, lo: dt.date, hi: dt.date) -> DataFrame:
    """Lines whose service code is empty, per day and line type (a missing code is
    not an empty one)."""
    lines = _month(cur, year, month).filter(
        (F.col("product_servicecode") == "") & ts_date_between(TS, lo, hi))
    return (lines.groupBy(F.to_date(TS).alias("usage_date"),
                          F.coalesce("line_item_line_item_type", F.lit("UNKNOWN")).alias("billing_type"))
            .agg(F.count(F.lit(1)).alias("rows"),
                 F.coalesce(F.sum(F.col("line_item_unblended_cost").cast(C.MONEY)), F.lit(0))
                 .cast(C.MONEY).alias("unblended_cost"))
            .orderBy("usage_date"))


def _with_entity(lines: DataFrame, org_accounts: DataFrame) -> DataFrame:
    org = org_accounts.select("account_id", "billing_entity")
    return lines.join(org, lines["line_item_usage_account_id"] == org["account_id"], "left")


def report_distinct_entities(cur: DataFrame, org_accounts: DataFrame, year: int, month: int) -> DataFrame:
    """D3: billing entities seen on the month's lines (NULL for unmatched accounts)."""
    return _with_entity(_month(cur, year, month), org_accounts).select("billing_entity").distinct()


def report_entity_accounts(cur: DataFrame, org_accounts: DataFrame, entities: tuple[str, ...],
                           year: int, month: int) -> DataFrame:
    """(entity, payer, account) combinations of the listed entities."""
    j = _with_entity(_month(cur, year, month), org_accounts).filter(F.col("billing_entity").isin(*entities))
    return j.select("billing_entity", "bill_payer_account_id", "line_item_usage_account_id").dropDuplicates()


def report_entity_account_list(org_accounts: DataFrame) -> DataFrame:
    """Accounts of each entity as a sorted comma list; NULL entity -> 'UNKNOWN'."""
    return (org_accounts.groupBy("billing_entity")
            .agg(F.array_join(F.array_sort(F.collect_list("account_id")), ",").alias("account_ids"))
            .select(F.coalesce("billing_entity", F.lit("UNKNOWN")).alias("billing_entity"), "account_ids"))


def report_entity_cost(cur: DataFrame, org_accounts: DataFrame, year: int, lo: dt.date, hi: dt.date) -> DataFrame:
    """Unblended cost by entity over a date range; unmatched accounts form the NULL group."""
    lines = cur.filter((F.col("year") == str(year)) & ts_date_between(TS, lo, hi))
    return (_with_entity(lines, org_accounts).groupBy("billing_entity")
            .agg(F.sum(F.col("line_item_unblended_cost").cast(C.MONEY)).cast(C.MONEY).alias("total_cost")))


def report_account_cost(cur: DataFrame, year: int, lo: dt.date, hi: dt.date) -> DataFrame:
    """Unblended and blended cost per (payer, account) over a date range."""
    lines = cur.filter((F.col("year") == str(year)) & ts_date_between(TS, lo, hi))
    return (lines.groupBy("bill_payer_account_id", "line_item_usage_account_id")
            .agg(F.sum(F.col("line_item_unblended_cost").cast(C.MONEY)).cast(C.MONEY).alias("cost"),
                 F.sum(F.col("line_item_blended_cost").cast(C.MONEY)).cast(C.MONEY).alias("blended_cost")))


def report_total_cost(cur: DataFrame, year: int, lo: dt.date, hi: dt.date) -> DataFrame:
    """Unblended and blended cost of all accounts over a date range (one row)."""
    lines = cur.filter((F.col("year") == str(year)) & ts_date_between(TS, lo, hi))
    return lines.agg(F.sum(F.col("line_item_unblended_cost").cast(C.MONEY)).cast(C.MONEY).alias("cost"),
                     F.sum(F.col("line_item_blended_cost").cast(C.MONEY)).cast(C.MONEY).alias("blended_cost"))


def report_dimension_entities(org_accounts: DataFrame) -> DataFrame:
    """D3: billing entities of the account dimension itself (NULL included)."""
    return org_accounts.select("billing_entity").distinct()


def report_daily_cost(cur: DataFrame, year: int, lo: dt.date, hi: dt.date) -> DataFrame:
    """Daily unblended cost series."""
    lines = cur.filter((F.col("year") == str(year)) & ts_date_between(TS, lo, hi))
    return (lines.groupBy(F.to_date(TS).alias("day"))
            .agg(F.sum(F.col("line_item_unblended_cost").cast(C.MONEY)).cast(C.MONEY).alias("cost"))
            .orderBy("day"))


_WORDS = 6  # 64-day words that hold a year


def _year_words(day: Column) -> list[Column]:
    """The bit of ``day`` in the words of its year (null in the others)."""
    at = F.dayofyear(day) - 1
    bit = F.expr("shiftleft(1L, (dayofyear(day) - 1) % 64)")
    return [F.when(F.floor(at / 64) == w, bit) for w in range(_WORDS)]


def day_bitmaps(daily: DataFrame, account_col: str = "usage_account_id", date_col: str = "usage_date") -> DataFrame:
    """``account_id, year, w0 .. w5, lo, hi``: a bitmap of the billed days of each account and
    year and their first and last one. Bitmaps merge by OR, in a hash aggregate of long
    integers: a task sends one row for an account and year, however many rows it read."""
    days = daily.select(F.col(account_col).alias("account_id"), F.col(date_col).alias("day")).filter("day is not null")
    marked = days.select("account_id", F.year("day").alias("year"), "day",
                         *[w.alias(f"w{i}") for i, w in enumerate(_year_words(F.col("day")))])
    return marked.groupBy("account_id", "year").agg(
        *[F.coalesce(F.bit_or(f"w{i}"), F.lit(0).cast("long")).alias(f"w{i}") for i in range(_WORDS)],
        F.min("day").alias("lo"), F.max("day").alias("hi"))


def report_coverage_gaps(daily: DataFrame, account_col: str = "usage_account_id",
                         date_col: str = "usage_date") -> DataFrame:
    """R2: per account, the days between its first and last billed day that
    have no daily row.

    Read from day bitmaps: an account's years (one small row each) meet, every year between
    its first and last day is compared with the days expected in it, and only the missing
    bits are exploded. Neither a window over days nor an account x calendar product."""
    years = day_bitmaps(daily, account_col, date_col)
    words = F.array(*[f"w{i}" for i in range(_WORDS)])
    accounts = years.groupBy("account_id").agg(
        F.min("lo").alias("lo"), F.max("hi").alias("hi"),
        F.map_from_entries(F.collect_list(F.struct("year", words.alias("words")))).alias("seen"))
    each = accounts.select("account_id", "lo", "hi", "seen",
                           F.explode(F.sequence(F.year("lo"), F.year("hi"))).alias("year"))
    jan1 = F.make_date("year", F.lit(1), F.lit(1))
    dec31 = F.make_date("year", F.lit(12), F.lit(31))
    bounds = each.select("account_id", jan1.alias("jan1"), F.try_element_at("seen", F.col("year")).alias("words"),
                         F.datediff(F.greatest("lo", jan1), jan1).alias("a"),
                         F.datediff(F.least("hi", dec31), jan1).alias("b"))
    # expected days of word w: bits max(a - 64 w, 0) .. min(b - 64 w, 63)
    missing = [F.expr(f"""CASE WHEN a <= {64 * w + 63} AND b >= {64 * w} THEN
        shiftleft(-1L, greatest(a - {64 * w}, 0)) & shiftrightunsigned(-1L, 63 - least(b - {64 * w}, 63))
        & ~coalesce(words[{w}], 0L) ELSE 0L END""") for w in range(_WORDS)]
    holes = bounds.select("account_id", "jan1", F.array(*missing).alias("missing")).filter(
        F.exists("missing", lambda m: m != 0))
    by_word = holes.select("account_id", "jan1", F.posexplode("missing").alias("w", "bits")).filter("bits <> 0")
    return by_word.select("account_id", F.explode(F.expr(
        "transform(filter(sequence(0, 63), i -> (shiftright(bits, i) & 1L) = 1L), i -> date_add(jan1, w * 64 + i))"))
        .alias("missing_day"))
