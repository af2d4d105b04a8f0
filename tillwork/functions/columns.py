"""Column expressions shared by the operators. All stay inside generated JVM code."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# The holiday dates flagged by default.
HOLIDAYS = ("2023-12-25", "2024-01-01")

HASH_RANGE = 2**32


def row_total(quantity: str = "quantity", price: str = "price") -> Column:
    return F.col(quantity) * F.col(price)


def discount_amount(discount_pct: str = "discount_pct", price: str = "price") -> Column:
    return F.col(discount_pct) / F.lit(100.0) * F.col(price)


def date_parts(ts: str) -> dict[str, Column]:
    """Calendar features; the week starts on Monday = 0."""
    c = F.col(ts)
    return {
        "year": F.year(c),
        "month": F.month(c),
        "day": F.dayofmonth(c),
        "hour": F.hour(c),
        "day_of_week": F.weekday(c),
    }


def weekend_flag(ts: str) -> Column:
    return F.when(F.weekday(F.col(ts)).isin(5, 6), 1).otherwise(0)


def holiday_flag(ts: str, holidays: Sequence[str] = HOLIDAYS) -> Column:
    return F.when(F.date_format(F.col(ts), "yyyy-MM-dd").isin(*holidays), 1).otherwise(0)


def hash32(key: str | Column, seed: int) -> Column:
    """Uniform 32-bit hash of a key: the same value on every engine, run and partitioning."""
    k = F.col(key) if isinstance(key, str) else key
    text = F.concat(k.cast("string"), F.lit(f":{seed}"))
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("bigint")


def hash_fraction(key: str | Column, seed: int) -> Column:
    return hash32(key, seed) / F.lit(float(HASH_RANGE))


def bucket(key: str | Column, seed: int, n: int) -> Column:
    return (hash32(key, seed) % F.lit(n)).cast("int")


def ratio(numerator: Column, denominator: Column, empty: float = 0.0) -> Column:
    """Division that yields ``empty`` where the denominator is zero (ANSI mode raises)."""
    return F.when(denominator != 0, numerator / denominator).otherwise(F.lit(empty))


def money(total: str | Column) -> Column:
    """Exact decimal view of an amount, so that sums do not depend on the order of addition."""
    c = F.col(total) if isinstance(total, str) else total
    return c.cast("decimal(18,4)")


def exact_sum(amount: str | Column) -> Column:
    return F.sum(money(amount)).cast("double")
