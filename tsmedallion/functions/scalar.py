"""Column expressions shared by the layers. All are JVM-side built-ins."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the text a source sends for "no observation".
MISSING_MARK = "."

# Fixed value: the name of an export, with the day it was made.
EXPORT_NAME = "economic_indicators_%Y%m%d.csv"


def parse_date(text: Column) -> Column:
    """ISO text to date; text that is no date gives NULL, also in ANSI mode."""
    return F.try_to_date(text)


def parse_value(text: Column) -> Column:
    """Text to double; the missing mark and unparseable text give NULL."""
    return F.when(text == MISSING_MARK, F.lit(None)).otherwise(text.try_cast("double"))


def finite(value: Column) -> Column:
    """``value``, or NULL if it is infinite or NaN."""
    return F.when(F.abs(value) < F.lit(float("inf")), value)


def is_missing(text: Column) -> Column:
    """True only for the missing mark; a NULL text is not *marked* missing."""
    return F.coalesce(text == MISSING_MARK, F.lit(False))


def pct_change(current: Column, previous: Column) -> Column:
    """Change in percent; NULL where the previous value is NULL or zero."""
    return F.when(
        previous.isNotNull() & (previous != 0), ((current - previous) / previous) * 100
    )


def pct_of(part: Column, whole: Column) -> Column:
    """Share in percent with two decimals; NULL for an empty whole."""
    return two_decimals(F.try_divide(F.lit(100) * part, whole)).cast("double")


def day_of_week(d: Column) -> Column:
    """Sunday 0 to Saturday 6."""
    return F.dayofweek(d) - 1


def is_weekend(d: Column) -> Column:
    return F.coalesce(F.dayofweek(d).isin(1, 7), F.lit(False))


def period_start(d: Column, unit: str) -> Column:
    """First date of the month, quarter or year."""
    return F.trunc(d, unit)


def two_decimals(value: Column) -> Column:
    """Text with two decimals, rounded from the exact binary value.

    ``format_number`` rounds half to even on the exact value, as C and Python
    do; ``format_string`` and ``round`` start from the shortest decimal text
    and give 2.68 for 2.675.
    """
    return (
        F.when(F.isnan(value), "nan")
        .when(value == float("inf"), "inf")
        .when(value == float("-inf"), "-inf")
        .otherwise(F.call_function("format_number", value, F.lit("0.00")))
    )


def change_label(pct: Column) -> Column:
    """``12.34% YoY``, or ``N/A`` where there is no change to show."""
    return F.when(pct.isNull() | F.isnan(pct), "N/A").otherwise(
        F.concat(two_decimals(pct), F.lit("% YoY"))
    )


def at(moment: datetime | None) -> Column:
    """A run's timestamp: given, so that runs reproduce, or the current time."""
    return F.current_timestamp() if moment is None else F.lit(moment).cast("timestamp")


def export_name(day: date) -> str:
    return day.strftime(EXPORT_NAME)
