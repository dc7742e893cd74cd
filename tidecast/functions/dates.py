"""Calendar helpers as Spark Columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Holiday flag names by month (month -> column name).
HOLIDAY_MONTHS = {2: "superbowl", 11: "thanksgiving", 12: "christmas"}


def _c(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def day_number(dt: str | Column) -> Column:
    """Days since 1970-01-01; the RANGE-window order key (frames in days)."""
    return F.unix_date(_c(dt))


def unix_seconds(dt: str | Column) -> Column:
    """Seconds since epoch of the date at UTC midnight."""
    return day_number(dt).cast("long") * F.lit(86400)


def week_us(dt: str | Column) -> Column:
    """Sunday-start week of year, 0..53; days before the first Sunday are week 0."""
    d = _c(dt)
    return F.floor((F.dayofyear(d) + F.lit(7) - F.dayofweek(d)) / F.lit(7)).cast("int")


def week_of_month(dt: str | Column, clamp_december: bool = True) -> Column:
    """Day-of-month div 7 with 4 folded into 3.

    ``clamp_december=False`` keeps December's fifth bucket (C6).
    """
    d = _c(dt)
    raw = F.floor(F.dayofmonth(d) / F.lit(7)).cast("int")
    clamped = F.least(raw, F.lit(3))
    if clamp_december:
        return clamped
    return F.when(F.month(d) == 12, raw).otherwise(clamped)


def with_date_parts(df: DataFrame, dt: str = "dt", clamp_december: bool = True) -> DataFrame:
    """Training-time date features: month, day, week (of month), weekofyear (ISO)."""
    return df.withColumns(
        {
            "month": F.month(dt),
            "day": F.dayofmonth(dt),
            "week": week_of_month(dt, clamp_december),
            "weekofyear": F.weekofyear(dt),
        }
    )


def holiday_flags(df: DataFrame, months: dict[int, str] | None = None, flag: str = "is_holiday",
                  dt: str = "dt") -> DataFrame:
    """0/1 columns: holiday week falling in the given month."""
    months = HOLIDAY_MONTHS if months is None else months
    hol = F.coalesce(F.col(flag), F.lit(False))
    return df.withColumns({name: (hol & (F.month(dt) == m)).cast("int") for m, name in months.items()})


def row_weight(flag: str | Column = "is_holiday") -> Column:
    """Evaluation weight: 5 for holiday weeks, 1 otherwise (C11)."""
    return F.coalesce(_c(flag), F.lit(False)).cast("int") * F.lit(4) + F.lit(1)
