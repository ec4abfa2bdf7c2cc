"""Month strings."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column
from pyspark.sql import functions as F


def parse_month(text: Column) -> Column:
    """First day of a ``YYYY-MM`` month, null for anything else."""
    wellformed = text.rlike(r"^[0-9]{4}-[0-9]{2}$") & ~text.startswith("0000")
    return F.when(wellformed, F.concat(text, F.lit("-01"))).try_cast("date")


def month_argument(text: str | date) -> date:
    """The same contract for a parameter; raises ``ValueError``."""
    if isinstance(text, date):
        return text.replace(day=1)
    year, dash, month = text.partition("-")
    digits = year.isdecimal() and month.isdecimal()
    if not (dash and digits and len(year) == 4 and len(month) == 2):
        raise ValueError("a month is written YYYY-MM")
    try:
        return date(int(year), int(month), 1)
    except ValueError:
        raise ValueError("a month is written YYYY-MM") from None
