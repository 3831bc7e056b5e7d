"""Money as exact cents.

The interface is ``DOUBLE``. Sums run on whole cents in ``DECIMAL``, so that neither the partitioning
nor the order of micro-batches can move a cent. An amount that has no exact cents (NaN, infinity, 1e16
and above) is summed beside them as a double, so no row is lost.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

CENTS = "decimal(18,0)"
CENTS_TOTAL = "decimal(38,0)"

LIMIT = 1e16
SAFE = 1e11
TIE_MARGIN = 0.01


def line_amount() -> Column:
    return F.col("quantity") * F.col("unit_price")


def _fits(amount: Column) -> Column:
    return F.abs(amount) < LIMIT


def exact_cents(amount: Column) -> Column:
    """The amount in whole cents, its decimal text rounded half up; NULL if it does not fit.

    Going through the text is what ``round`` does and costs as much as the rest of the aggregate.
    Below `SAFE` the product with 100 is off by less than `TIE_MARGIN`, so binary arithmetic gives the
    same cent unless the amount is that close to half a cent; only then the text decides.
    """
    scaled = amount * 100
    to_tie = F.abs(scaled - F.floor(scaled) - 0.5)
    needs_text = (to_tie < TIE_MARGIN) | (F.abs(amount) >= SAFE)
    by_text = F.when(needs_text & _fits(amount), amount).cast("decimal(18,2)") * 100
    return (
        F.when(needs_text, by_text.cast("bigint")).otherwise(F.floor(scaled + 0.5)).cast(CENTS)
    )


def beyond_cents(amount: Column) -> Column:
    """The amount where `exact_cents` gives NULL, else NULL."""
    return F.when(~_fits(amount), amount)


def as_double(cents: Column, beyond: Column) -> Column:
    """Total of the two sums; NULL only if both are NULL."""
    exact = (cents * F.lit(Decimal("0.01"))).cast("double")
    return F.when(beyond.isNull(), exact).otherwise(
        F.coalesce(exact, F.lit(0.0)) + beyond
    )
