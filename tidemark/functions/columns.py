"""Column expressions shared by the operators; all stay inside Spark's codegen."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark.functions.fixed_values import PLAN_PRICES, SLA_HOURS

MICROS_PER_DAY = 86_400_000_000
MICROS_PER_HUNDREDTH_HOUR = 36_000_000


def lookup(key: Column, table: dict) -> Column:
    """Constant lookup; NULL for keys outside ``table``."""
    pairs = iter(table.items())
    first_key, first_value = next(pairs)
    found = F.when(key == first_key, F.lit(first_value))
    for name, value in pairs:
        found = found.when(key == name, F.lit(value))
    return found


def plan_price(plan: Column) -> Column:
    """Monthly price of a plan name, 0 when the plan is unknown."""
    return F.coalesce(lookup(plan, PLAN_PRICES), F.lit(0)).cast("bigint")


def sla_hours(severity: Column) -> Column:
    return lookup(severity, SLA_HOURS)


def banded(value: Column, bands, floor: int, *, at_least: bool) -> Column:
    """Score of the first band whose limit ``value`` meets, else ``floor``."""
    score = None
    for limit, points in bands:
        meets = value >= limit if at_least else value <= limit
        score = F.when(meets, points) if score is None else score.when(meets, points)
    return score.otherwise(floor)


def micros_between(start: Column, end: Column) -> Column:
    """Microseconds from start to end on the wall clock, whatever the session's zone."""
    return F.timestamp_diff("MICROSECOND", start.cast("timestamp_ntz"), end.cast("timestamp_ntz"))


def integer_quotient(dividend: Column, divisor) -> Column:
    """Whole-number division that never passes through a double."""
    divisor = divisor if isinstance(divisor, Column) else F.lit(divisor)
    return F.call_function("div", dividend, divisor)


def hundredth_hours(start: Column, end: Column) -> Column:
    """Elapsed hundredths of an hour, halves rounded away from zero, exact."""
    gap = micros_between(start, end)
    whole = integer_quotient(F.abs(gap) + MICROS_PER_HUNDREDTH_HOUR // 2, MICROS_PER_HUNDREDTH_HOUR)
    return F.signum(gap).cast("bigint") * whole


def as_hundredths(hours: Column) -> Column:
    """Back from a two-decimal double to the integer it stands for."""
    return F.round(hours * 100).cast("bigint")


def percent(part: Column, whole: Column) -> Column:
    """``part / whole`` in percent, two decimals, halves up, exact for counts.

    NULL when ``whole`` is zero.  The integers are widened to decimals so that
    multiplying large totals cannot overflow.
    """
    part, whole = part.cast("decimal(28,0)"), whole.cast("decimal(28,0)")
    doubled = F.nullif(whole * 2, F.lit(0).cast("decimal(28,0)"))
    hundredths = integer_quotient(part * 20000 + whole, doubled)
    return hundredths.cast("double") / 100


def whole_days(start: Column, end: Column) -> Column:
    """Full days from start to end, rounded toward minus infinity."""
    gap = micros_between(start, end)
    return integer_quotient(gap - F.pmod(gap, F.lit(MICROS_PER_DAY)), MICROS_PER_DAY)


def month_of(day: Column) -> Column:
    return F.trunc(day, "month")


def json_text(*fields: Column) -> Column:
    """JSON object that keeps fields whose value is NULL."""
    return F.to_json(F.struct(*fields), {"ignoreNullFields": "false"})
