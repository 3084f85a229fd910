"""Exact rates and means.

Counts and totals are kept as integers or decimals and divided once, so the
result does not depend on the order in which Spark merges partial sums, and
rounding is HALF_UP on the decimal quotient.
"""

from pyspark.sql import Column
from pyspark.sql import functions as F


def exact(c: Column) -> Column:
    """A metric as DECIMAL, so that its sum is the same in any order."""
    return c.cast("decimal(18,6)")


def total(c: Column) -> Column:
    """Sum of a counter; 0 (not NULL) for a group without values."""
    return F.coalesce(F.sum(c), F.lit(0)).cast("bigint")


def quotient(num: Column, den: Column, factor: int = 1) -> Column:
    """Unrounded decimal num*factor/den; NULL when den is 0 or NULL."""
    scaled = num.cast("decimal(28,6)") * F.lit(factor)
    return F.try_divide(scaled, den.cast("decimal(18,0)"))


def ratio(num: Column, den: Column, digits: int = 2, factor: int = 1) -> Column:
    """num*factor/den rounded HALF_UP; NULL when den is 0 or NULL."""
    return F.round(quotient(num, den, factor), digits).cast("double")


def pct(num: Column, den: Column) -> Column:
    """Percentage with two decimals, 0 when there is nothing to divide by."""
    return F.coalesce(ratio(num, den, factor=100), F.lit(0.0))


def mean(c: Column, digits: int = 2) -> Column:
    """Mean of the non-null values, rounded HALF_UP; NULL for none."""
    return ratio(F.sum(exact(c)), F.count(c), digits)


def truncated(num: Column, den: Column, factor: int = 1) -> Column:
    """num*factor/den cut towards zero, the way integer report cells show it."""
    return quotient(num, den, factor).cast("bigint")


def decimal_total(c: Column, digits: int = 2) -> Column:
    """Sum of a decimal metric, 0 for a group without values."""
    return F.round(F.coalesce(F.sum(exact(c)), F.lit(0)), digits).cast("double")


def count_if(condition: Column) -> Column:
    return F.count_if(condition)


def brazilian_number(c: Column, digits: int = 2, prefix: str = "") -> Column:
    """1234.5 -> '1.234,50', optionally after a currency prefix."""
    text = F.translate(F.format_number(c, digits), ",.", ".,")
    return F.concat(F.lit(prefix), text) if prefix else text


def card_text(value: Column, decimals: Column) -> Column:
    """Card cell: two decimals where ``decimals`` is true, else an integer, '' for null."""
    dec = value.cast("decimal(38,6)")
    return F.coalesce(
        F.when(decimals, F.round(dec, 2).cast("decimal(38,2)").cast("string"))
        .otherwise(dec.cast("bigint").cast("string")),
        F.lit(""),
    )
