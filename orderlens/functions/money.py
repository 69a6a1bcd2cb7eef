"""Exact money arithmetic.

Amounts are DECIMAL(18,4) per row. Sums keep the wider type Spark gives them,
so a total over billions of rows cannot overflow. A figure is rounded as a
decimal and only then turned into a double for display.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

MONEY = "decimal(18,4)"
WIDE = "decimal(24,4)"


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def dec(value: float | int | str | Decimal) -> Column:
    """A decimal literal, so a threshold never meets a binary fraction."""
    return F.lit(Decimal(str(value)))


def money(c: Column | str) -> Column:
    return col(c).cast(MONEY)


def zero_if_null(c: Column | str) -> Column:
    return F.coalesce(col(c), F.lit(0).cast(MONEY))


def ratio(num: Column | str, den: Column | str) -> Column:
    """num / den, NULL when the denominator is zero or NULL."""
    return F.try_divide(col(num), col(den))


def rounded(c: Column | str, digits: int = 2) -> Column:
    return F.round(col(c), digits).cast("double")


def share(num: Column | str, den: Column | str, digits: int = 2) -> Column:
    """Rounded num / den of two counts or sums, NULL when den is zero."""
    return rounded(ratio(col(num).cast(WIDE), col(den).cast(WIDE)), digits)


def pct(num: Column | str, den: Column | str, digits: int = 1) -> Column:
    """Rounded 100 * num / den, NULL when den is zero."""
    return rounded(ratio(col(num).cast(WIDE) * 100, col(den).cast(WIDE)), digits)


def sum_when(cond: Column, value: Column | str) -> Column:
    """Conditional sum that counts the other rows as zero."""
    return F.sum(F.when(cond, col(value)).otherwise(F.lit(0).cast(MONEY)))


def row_count() -> Column:
    return F.count(F.lit(1)).cast("bigint")
