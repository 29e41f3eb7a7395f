"""Small column builders shared by every operator. All stay inside the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

AMOUNT = "decimal(18,2)"
# A sum of amounts over a large fact passes 18 digits, so totals get ten more.
TOTAL = "decimal(28,2)"


def amount(value: Column | str) -> Column:
    return _col(value).cast(AMOUNT)


def total(value: Column | str) -> Column:
    return F.sum(_col(value)).cast(TOTAL)


def total_where(condition: Column, value: Column | str) -> Column:
    return F.sum(F.when(condition, _col(value)).otherwise(F.lit(0).cast(AMOUNT))).cast(TOTAL)


def count_where(condition: Column) -> Column:
    return F.count(F.when(condition, F.lit(1)))


def blank_to_null(value: Column | str) -> Column:
    return F.nullif(F.trim(_col(value)), F.lit(""))


def month_of(value: Column | str) -> Column:
    return F.trunc(_col(value), "month")


def settle(value: Column, digits: int) -> Column:
    """Round half up after dropping float noise, so 12.249999999999998 counts as 12.25."""
    return F.round(F.round(value.cast("double"), 10), digits)


def share(part: Column, whole: Column, digits: int = 1) -> Column:
    """100 * part / whole; NULL when the whole is zero."""
    return settle(100 * part.cast("double") / F.nullif(whole.cast("double"), F.lit(0.0)), digits)


def share_true(flag: Column, digits: int = 1) -> Column:
    """Percent of rows where the flag holds; a NULL flag counts as not holding."""
    return settle(100 * F.avg(F.when(flag, F.lit(1.0)).otherwise(F.lit(0.0))), digits)


def brazilian(value: Column, digits: int = 2) -> Column:
    """1234567.8 -> '1.234.567,80'."""
    return F.translate(F.format_number(value.cast("double"), digits), ",.", ".,")


def _col(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value
