"""Date expressions. "Now" is always an argument, so every result can be reproduced."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def moment(value: dt.datetime | dt.date | None) -> Column:
    """A timestamp literal without zone; it is folded, so comparisons with it reach the scan."""
    if value is None:
        return F.lit(None).cast("timestamp_ntz")
    if not isinstance(value, dt.datetime):
        value = dt.datetime.combine(value, dt.time())
    return F.to_timestamp_ntz(F.lit(value.isoformat(sep=" ")))


def parse_date(c: Column | str, fmt: str) -> Column:
    """Date by format; NULL when the text does not parse."""
    return F.try_to_date(_col(c), fmt)


def parse_timestamp(c: Column | str, fmt: str) -> Column:
    """Timestamp without zone by format; NULL when the text does not parse."""
    return F.try_to_timestamp(_col(c), F.lit(fmt)).cast("timestamp_ntz")


def month_key(c: Column | str) -> Column:
    """``yyyyMM`` text, by arithmetic (``date_format`` would format every row)."""
    c = _col(c)
    return F.lpad((F.year(c) * 100 + F.month(c)).cast("string"), 6, "0")


def date_key(c: Column | str) -> Column:
    """``yyyymmdd`` integer, by arithmetic (no text formatting per row)."""
    c = _col(c)
    return F.year(c) * 10000 + F.month(c) * 100 + F.dayofmonth(c)


def weekday_name(c: Column | str) -> Column:
    return F.date_format(_col(c), "EEEE")


def month_name(c: Column | str) -> Column:
    return F.date_format(_col(c), "MMMM")


def quarter_label(c: Column | str) -> Column:
    return F.concat(F.lit("Q"), F.quarter(_col(c)).cast("string"))


def date_parts(c: Column | str) -> dict[str, Column]:
    """Calendar attributes by name."""
    c = _col(c)
    return {
        "date_key": date_key(c),
        "day_name": weekday_name(c),
        "day_of_month": F.dayofmonth(c),
        "day_of_year": F.dayofyear(c),
        "week_of_year": F.weekofyear(c),
        "month": F.month(c),
        "month_name": month_name(c),
        "quarter": quarter_label(c),
        "year": F.year(c),
    }
