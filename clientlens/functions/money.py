from __future__ import annotations

from pyspark.sql import Column, functions as F

# All money is added at this scale: 26 digits before the point, 12 after it.
AMOUNT = "decimal(38,12)"


def fits(c: Column) -> Column:
    """True for NULL and for every number AMOUNT can hold; false for NaN, infinities and larger ones."""
    return c.isNull() | c.try_cast(AMOUNT).isNotNull()


def exact(c: Column) -> Column:
    """The value at the scale of AMOUNT.

    One that does not fit is an error here; the quality contracts set such rows aside before.
    """
    unfit = F.raise_error(F.lit(f"amount does not fit {AMOUNT}"))
    return F.coalesce(c.try_cast(AMOUNT), F.when(c.isNotNull(), unfit).cast(AMOUNT))


def decimal_total(c: Column) -> Column:
    """Exact sum, the same whatever the row order. NULL when all are NULL; one of over 38 digits is an error."""
    added = F.sum(exact(c))
    too_large = F.raise_error(F.lit(f"total does not fit {AMOUNT}"))
    return F.coalesce(added, F.when(F.count(c) > 0, too_large).cast(AMOUNT))


def total(c: Column) -> Column:
    """decimal_total as a double."""
    return decimal_total(c).cast("double")


def mean(c: Column) -> Column:
    """Average as total over the number of non-null values; NULL when there are none."""
    return total(c) / F.nullif(F.count(c), F.lit(0))
