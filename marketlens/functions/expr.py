"""Column-expression helpers shared by the analyses (all JVM-side built-ins)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

def col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def month_start(c) -> Column:
    """First day of the month, as a DATE."""
    return F.trunc(col(c), "month")


def month_label(c) -> Column:
    """'yyyy-MM' text; sorts chronologically."""
    return F.date_format(col(c), "yyyy-MM")


def month_diff(later, earlier) -> Column:
    """Whole calendar months between two dates: year*12 + month difference."""
    later, earlier = col(later), col(earlier)
    return ((F.year(later) - F.year(earlier)) * 12 + (F.month(later) - F.month(earlier))).cast("int")


def month_label_diff(later_label, earlier_label) -> Column:
    """`month_diff` for 'yyyy-MM' labels."""
    return month_diff(F.to_date(col(later_label), "yyyy-MM"), F.to_date(col(earlier_label), "yyyy-MM"))


def time_of_day(c) -> Column:
    """Seconds since midnight, with the fraction (a field read: no time zone)."""
    c = col(c)
    return F.hour(c) * 3600 + F.minute(c) * 60 + F.date_part(F.lit("SECOND"), c)


def floor_days(later, earlier) -> Column:
    """Whole days between two timestamps, floored (5 h late -> 0, 1 h early -> -1).

    Calendar days between the dates, minus one when the later timestamp is
    earlier in its day. Built from field reads only, so a daylight-saving
    change in the session time zone cannot shift it (a microsecond
    difference of wall-clock timestamps can).
    """
    days = F.datediff(F.to_date(col(later)), F.to_date(col(earlier)))
    borrow = F.when(time_of_day(later) < time_of_day(earlier), F.lit(1)).otherwise(F.lit(0))
    return (days - borrow).cast("int")


def safe_div(num, den) -> Column:
    """num / den, null when den is 0 or null (SQL NULLIF, DAX DIVIDE)."""
    return F.try_divide(col(num), col(den))


def pct(num, den, digits: int | None = None, half_even: bool = False) -> Column:
    """100 * num / den in double precision; null on a zero denominator."""
    v = F.try_divide(F.lit(100.0) * col(num), col(den).cast("double"))
    if digits is None:
        return v
    return F.bround(v, digits) if half_even else F.round(v, digits)


def money(c, digits: int = 2) -> Column:
    """Round an exact decimal amount half away from zero, output as double."""
    return F.round(col(c), digits).cast("double")


def money_mean(total, count, digits: int = 2) -> Column:
    """Rounded mean of an exact decimal sum: the quotient is taken at full
    scale (``avg`` would round it first) and rounded once."""
    return money(F.try_divide(col(total), col(count)), digits)


def money_even(c, digits: int = 2) -> Column:
    """Round half to even (pandas' rule), output as double."""
    return F.bround(col(c), digits).cast("double")


def mean(c) -> Column:
    """Mean of the non-null values as double: exact sum / count."""
    c = col(c)
    return F.try_divide(F.sum(c).cast("double"), F.count(c))


def to_flag(cond: Column) -> Column:
    """Boolean -> 0/1 int, null counting as 0 (pandas NaN > 0 is False)."""
    return F.coalesce(cond, F.lit(False)).cast("int")
