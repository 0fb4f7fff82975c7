"""Fixed values and run parameters.

Fixed values are the ones results depend on; they must stay exactly as listed.
Deployment-specific values (billing entities, special accounts, tag values,
product -> entity maps, excluded table names) are *parameters* with no default
taken from any real deployment.
"""

from __future__ import annotations

from dataclasses import dataclass

# ---------------------------------------------------------------------------
# FIXED VALUES (must match the billing semantics exactly)
# ---------------------------------------------------------------------------

# Billing-type classes, tested in this order: Regular, Fee, Discount, Tax; else Other.
# Values cover AWS line-item types, GCP cost types and Huawei bill-type codes.
BILLING_TYPE_REGULAR = ("Usage", "DiscountedUsage", "SavingsPlanCoveredUsage",
                        "regular",
                        "1", "2", "3", "5", "8", "17")
BILLING_TYPE_FEE = ("Fee", "RIFee", "SavingsPlanRecurringFee",
                    "14", "20", "24")
BILLING_TYPE_DISCOUNT = ("BundledDiscount", "PrivateRateDiscount", "EdpDiscount",
                         "SavingsPlanNegation", "Credit", "Refund",
                         "adjustment", "rounding_error",
                         "4", "9", "16", "101", "102")
BILLING_TYPE_TAX = ("Tax", "tax", "15", "100")
BILLING_TYPE_CLASSES = (
    ("Regular", BILLING_TYPE_REGULAR),
    ("Fee", BILLING_TYPE_FEE),
    ("Discount", BILLING_TYPE_DISCOUNT),
    ("Tax", BILLING_TYPE_TAX),
)
BILLING_TYPE_OTHER = "Other"

# Category given to a service code that is not in the service-type table.
UNKNOWN_CATEGORY = "Unknown"

# Line-item types that take part in the amortized cost.
AMORTIZED_LINE_TYPES = ("Usage", "SavingsPlanCoveredUsage", "DiscountedUsage", "RIFee", "Fee")
# Fee line types that count 0 when billed by the plain AWS entity.
AMORTIZED_ZERO_FEE_TYPES = ("Fee", "RIFee")
AWS_ENTITY = "AWS"
AWS_MARKETPLACE_ENTITY = "AWS Marketplace"

# Default pricing term when a group has none.
DEFAULT_PRICING_TERM = "OnDemand"

# Cloud provider codes.
AWS, GCP, HWC = "AWS", "GCP", "HWC"

# Refresh window (ingest): months of back-fill on a first run, and the days of
# month on which the whole previous month is re-read.
BACKFILL_MONTHS = 6
AWS_FULL_REFRESH_DAYS = (1, 2, 3, 4, 5, 8, 11, 14, 17, 20, 23, 26, 29)
OTHER_FULL_REFRESH_DAYS = (1, 2, 3, 4)
RECENT_DAYS_CAP = 10

# Invoice: created on this day of the billed month, due one month later.
INVOICE_DAY_OF_MONTH = 4

# ---------------------------------------------------------------------------
# Money types
# ---------------------------------------------------------------------------
MONEY = "decimal(20,8)"
USAGE = "decimal(30,8)"
PERCENT = "decimal(9,4)"
FEE2 = "decimal(20,2)"


@dataclass(frozen=True)
class AmortizedParams:
    """Parameters of the amortized-cost report (deployment specific)."""
    entities: tuple[str, ...]            # billing entities reported by org join
    marketplace_account: str             # account whose marketplace fees count 0
    tag_entity: str = ""                 # literal entity of the tagged workload
    tag_value: str = ""                  # resource tag value of that workload
    tag_account: str = ""                # account of that workload
