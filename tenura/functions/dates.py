"""Calendar helpers for dates stored as YYYYMMDD integers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def date_from_int(value: Column | str, lenient: bool = False) -> Column:
    """YYYYMMDD integer to date. A bad value raises; with ``lenient`` it becomes NULL."""
    value = F.col(value) if isinstance(value, str) else value
    if lenient:
        return F.try_to_date(value.cast("string"), "yyyyMMdd")
    return F.to_date(value.cast("string"), "yyyyMMdd")


def int_from_date(value: Column | str) -> Column:
    """Date or timestamp to YYYYMMDD integer."""
    value = F.col(value) if isinstance(value, str) else value
    return F.year(value) * 10000 + F.month(value) * 100 + F.dayofmonth(value)


def date_parts(name: str) -> list[Column]:
    """Year, month and day columns of one date column."""
    return [
        F.year(name).alias(f"{name}_year"),
        F.month(name).alias(f"{name}_month"),
        F.dayofmonth(name).alias(f"{name}_day"),
    ]
