"""Billing-type classification (Regular / Fee / Discount / Tax / Other)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import config as C


def billing_type_class(billing_type: Column | str) -> Column:
    """Class of a billing type, tested in the fixed order; anything else
    (NULL included) is ``Other``. Pure expression: stays in codegen."""
    c = F.col(billing_type) if isinstance(billing_type, str) else billing_type
    expr = None
    for name, values in C.BILLING_TYPE_CLASSES:
        cond = c.isin(*values)
        expr = F.when(cond, F.lit(name)) if expr is None else expr.when(cond, F.lit(name))
    return expr.otherwise(F.lit(C.BILLING_TYPE_OTHER))
