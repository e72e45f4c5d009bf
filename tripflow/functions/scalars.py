"""Column expressions. All are built-ins, so they stay on the JVM side."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_NAME_WIDTH = 9  # month and day names are blank-padded to this width
_EVENT_TIME = r"^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}\z"


def fold_case(text: Column) -> Column:
    return F.lower(text)


def parse_event_time(text: Column) -> Column:
    """Exactly ``yyyy-MM-dd'T'HH:mm:ss``, else null.

    The cast to a zone-free timestamp does not pass through the session time zone, so a wall-clock
    time that a daylight-saving change skips is kept as written.
    """
    return F.when(text.rlike(_EVENT_TIME), text.try_cast("timestamp_ntz"))


def to_money(amount: Column) -> Column:
    """Two decimals, half up; null when the value does not fit ``numeric(10,2)``."""
    return amount.try_cast("decimal(10,2)")


def date_key(day: Column) -> Column:
    return (F.year(day) * 10000 + F.month(day) * 100 + F.dayofmonth(day)).cast("int")


def date_parts(day: Column) -> dict[str, Column]:
    return {
        "date_key": date_key(day),
        "full_date": day,
        "day_of_month": F.dayofmonth(day),
        "month_number": F.month(day),
        "month_name": F.rpad(F.date_format(day, "MMMM"), _NAME_WIDTH, " "),
        "quarter_number": F.quarter(day),
        "year_number": F.year(day),
        "day_name": F.rpad(F.date_format(day, "EEEE"), _NAME_WIDTH, " "),
        "is_weekend": F.weekday(day) >= 5,
    }
