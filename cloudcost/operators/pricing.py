"""Contract pricing: validity intervals (W1/W2), date spine (U3), daily
expansion (J5 range join as explode), active pricing as of a date (W3)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .. import config as C

PRICING_KEY = ["organization_id", "cloud_provider"]
FEES = ["discount", "handling_fee", "support_fee"]
DAILY_KEYS = ["pricing_date", "organization_id", "cloud_provider"]


def _start_bounds(pricing: DataFrame) -> tuple[dt.date | None, dt.date | None]:
    """Global MIN/MAX start date (A17): one scalar aggregate, two values to the driver."""
    r = pricing.agg(F.min("start_date").alias("lo"), F.max("start_date").alias("hi")).first()
    return r["lo"], r["hi"]


def open_end(pricing: DataFrame, as_of: dt.date) -> dt.date:
    """The end (exclusive) of every last interval: greatest(max start, as_of) + 1 day."""
    _, hi = _start_bounds(pricing)
    return max(hi, as_of) + dt.timedelta(days=1) if hi is not None else as_of + dt.timedelta(days=1)


def pricing_validity_intervals(pricing: DataFrame, as_of: dt.date) -> DataFrame:
    """Each pricing row valid on [start_date, next_start_date).

    ``next_start_date`` is the next start of the same (organization, provider)
    or the open end. Equal starts are ordered by the fees so the result is
    deterministic (the earlier of two equal starts gets an empty interval).
    """
    end = open_end(pricing, as_of)
    w = Window.partitionBy(*PRICING_KEY).orderBy("start_date", *FEES)
    return pricing.select(
        *PRICING_KEY, "start_date",
        F.coalesce(F.lead("start_date").over(w), F.lit(end)).alias("next_start_date"),
        *FEES)


def date_spine(spark: SparkSession, pricing: DataFrame, as_of: dt.date) -> DataFrame:
    """Every day from the first start to greatest(max start, as_of),
    generated in parallel from ``range`` (no recursion, no single-row explode)."""
    lo, hi = _start_bounds(pricing)
    if lo is None:
        return spark.range(0).select(F.lit(None).cast("date").alias("pricing_date"))
    top = max(hi, as_of)
    n = (top - lo).days + 1
    return spark.range(n).select(F.date_add(F.lit(lo), F.col("id").cast("int")).alias("pricing_date"))


def daily_org_pricing(pricing: DataFrame, as_of: dt.date,
                      clip: tuple[dt.date, dt.date] | None = None) -> DataFrame:
    """One row per (day, organization, provider) with the fees in force.

    The range join ``day >= start AND day < next`` becomes a per-row explode of
    ``sequence(start, next - 1)``; empty intervals are dropped first (sequence
    would count backwards otherwise). Work is spread over the pricing rows.
    ``clip=(lo, hi)`` cuts every interval to the days a consumer needs *before*
    exploding (a filter on the generated day cannot be pushed below the explode).
    """
    iv = pricing_validity_intervals(pricing, as_of)
    lo, hi = F.col("start_date"), F.date_sub(F.col("next_start_date"), 1)
    if clip is not None:
        lo, hi = F.greatest(lo, F.lit(clip[0])), F.least(hi, F.lit(clip[1]))
    iv = iv.select("*", lo.alias("_lo"), hi.alias("_hi")).filter(F.col("_lo") <= F.col("_hi"))
    days = F.explode(F.sequence(F.col("_lo"), F.col("_hi")))
    z = F.lit(0).cast(C.PERCENT)
    return iv.select(days.alias("pricing_date"), *PRICING_KEY,
                     *[F.coalesce(F.col(c).cast(C.PERCENT), z).alias(c) for c in FEES])


def active_pricing(pricing: DataFrame, as_of: dt.date) -> DataFrame:
    """Latest pricing with start_date <= as_of per (organization, provider).

    Written as an aggregate (``max_by``), which combines map-side, instead of a
    rank window; ties on start date resolve by the fees (deterministic).
    """
    order = F.struct("start_date", *FEES)
    best = (pricing.filter(F.col("start_date") <= F.lit(as_of))
            .groupBy(*PRICING_KEY)
            .agg(F.max_by(F.struct("start_date", *FEES), order).alias("p")))
    return best.select(*PRICING_KEY, "p.start_date", *[F.col(f"p.{c}").alias(c) for c in FEES])
