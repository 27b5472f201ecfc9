"""Exact, engine-independent means.

A double average depends on summation order, so the same group can round to
different 4th decimals on different engines or partitionings. We sum values
as integer micro-units (fixed point, 6 decimals) and round the mean half up
with integer division, which is exact and order-free; threshold tests compare
integers instead of doubles. Micro-units are DECIMAL(20,0), so their sums don't
overflow. A value that is no number of that range (NaN, infinite, or beyond
9.2e12) counts as missing: it is left out of sum and count."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

UNIT_DIGITS = 6
UNIT = 10 ** UNIT_DIGITS


def units(c: str | Column) -> Column:
    """Value -> integer micro-units (rounded half away from zero)."""
    c = F.col(c) if isinstance(c, str) else c
    return F.round(c * float(UNIT)).try_cast("bigint").cast("decimal(20,0)")


def rounded_sum(sum_units: str, scale: int = 4) -> Column:
    """Micro-unit sum rounded half away from zero to `scale` decimals."""
    c = 10 ** (UNIT_DIGITS - scale)
    return F.expr(f"CAST(signum({sum_units}) * ((2 * abs({sum_units}) + {c}) div {2 * c}) AS DOUBLE) / {10 ** scale}")


def rounded_mean(sum_units: str, count: str, scale: int = 4) -> Column:
    """Mean of a group from its micro-unit sum and non-null count, rounded half
    away from zero to `scale` decimals; NULL for an empty group."""
    c = 10 ** (UNIT_DIGITS - scale)
    return F.expr(
        f"CASE WHEN {count} > 0 THEN CAST(signum({sum_units}) * "
        f"((2 * abs({sum_units}) + {c} * {count}) div (2 * {c} * {count})) AS DOUBLE) / {10 ** scale} END")


def mean_above(sum_units: str, count: str, threshold: float) -> Column:
    """Exact `mean > threshold` (threshold with at most 6 decimals)."""
    t = int(round(threshold * UNIT))
    return F.expr(f"{count} > 0 AND {sum_units} > CAST({t} AS BIGINT) * {count}")


# SQL spellings of the same rules for the reference queries.
def sql_units(expr: str) -> str:
    return f"CAST(round(({expr}) * {float(UNIT)}) AS BIGINT)"


def sql_rounded_mean(sum_units: str, count: str, scale: int = 4) -> str:
    c = 10 ** (UNIT_DIGITS - scale)
    return (f"CASE WHEN {count} > 0 THEN CAST(sign({sum_units}) * "
            f"((2 * abs({sum_units}) + {c} * {count}) // (2 * {c} * {count})) AS DOUBLE) / {10 ** scale} END")


def sql_mean_above(sum_units: str, count: str, threshold: float) -> str:
    t = int(round(threshold * UNIT))
    return f"({count} > 0 AND {sum_units} > {t} * {count})"
