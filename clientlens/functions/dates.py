from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import Column, functions as F


def yyyymm(c: Column) -> Column:
    return (F.year(c) * 100 + F.month(c)).cast("int")


def as_date(as_of: date | str | None) -> Column:
    return F.current_date() if as_of is None else F.lit(str(as_of)).cast("date")


def as_timestamp(at: datetime | date | str | None) -> Column:
    return F.current_timestamp() if at is None else F.lit(str(at)).cast("timestamp")
