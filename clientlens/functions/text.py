from __future__ import annotations

from pyspark.sql import Column, functions as F


def trimmed(c: Column) -> Column:
    return F.trim(c)


def code(c: Column) -> Column:
    """Canonical spelling of a category code."""
    return F.upper(F.trim(c))


def digits(c: Column) -> Column:
    return F.regexp_replace(c, "[^0-9]", "")


RULES = {"trim": trimmed, "code": code, "digits": digits}
