"""Numbers as text and rounding as in the reports: decimal half-even on the exact binary value."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F


def fixed(x: Column, digits: int) -> Column:
    """Text with so many decimals, without grouping. The formatter takes values whose first kept digit would be rounded up from nothing for ties; those are compared with the tie's exact value."""
    x = x.cast("double")
    text = F.call_function("format_number", x, F.lit("0." + "0" * digits if digits else "0"))
    unit = 10.0**-digits
    tie = 0.5 * unit
    above = Decimal(tie) > Decimal(5).scaleb(-digits - 1)
    up = F.abs(x) >= tie if above else F.abs(x) > tie
    small = F.concat(F.when(x < 0, "-").otherwise(""), F.when(up, f"{unit:.{digits}f}").otherwise(f"{0:.{digits}f}"))
    return F.when((F.abs(x) < unit) & (x != 0), small).otherwise(text)


def rounded(x: Column, digits: int) -> Column:
    return fixed(x, digits).cast("double")


def upper_median(x: str) -> Column:
    """Aggregate: the element at n // 2 in the order of a whole number x (an SQL expression); the lower median from the other end. It holds each different value with its count, not the rows."""
    return F.expr(f"cast(percentile_disc(0.5) WITHIN GROUP (ORDER BY {x} DESC) AS bigint)")


def percent(n: Column, total: Column) -> Column:
    """Percentage text with one decimal, NA for a total of zero."""
    return F.when(total > 0, fixed(n * 100.0 / total, 1)).otherwise("NA")
