"""Calendar helpers returning Columns: fiscal periods and formatted names."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from quillmart.constants import FISCAL_START_MONTH


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def _shift(start: int) -> int:
    # Months to add so the fiscal year's first month lands in January.
    return (13 - start) % 12


def fiscal_year(d, start: int = FISCAL_START_MONTH) -> Column:
    """Fiscal year, named after the calendar year in which it ends."""
    return F.year(F.add_months(_c(d), _shift(start))).cast("int")


def fiscal_quarter(d, start: int = FISCAL_START_MONTH) -> Column:
    return F.quarter(F.add_months(_c(d), _shift(start))).cast("int")


def fiscal_month(d, start: int = FISCAL_START_MONTH) -> Column:
    return F.month(F.add_months(_c(d), _shift(start))).cast("int")


def month_start(d) -> Column:
    return F.trunc(_c(d), "month")


def month_name(d, pad: bool = True) -> Column:
    """Full month name; blank-padded to 9 characters like ``TO_CHAR(d, 'Month')``."""
    name = F.date_format(_c(d), "MMMM")
    return F.rpad(name, 9, " ") if pad else name


def date_key(d) -> Column:
    """yyyymmdd as int."""
    d = _c(d)
    return (F.year(d) * 10000 + F.month(d) * 100 + F.dayofmonth(d)).cast("int")


def iso_dow(d) -> Column:
    """ISO day of week, 1 = Monday .. 7 = Sunday."""
    return (F.weekday(_c(d)) + 1).cast("int")
