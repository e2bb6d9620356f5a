"""Entity rows as they arrive: spelled untidily, replayed with old versions, or broken.

Each feed holds every base row, so the operator under test has a known answer.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from clientlens.schemas import Entity


def dirty(df: DataFrame, entity: Entity) -> DataFrame:
    """Same rows in a form that the cleaning rules bring back to the base."""

    def spoil(column: str, rule: str) -> Column:
        c = F.col(column)
        if rule == "digits":
            parts = [c.substr(1, 1), c.substr(2, 3), c.substr(5, 3), F.substring(c, 8, 100)]
            return F.concat(F.lit("+"), parts[0], F.lit(" ("), parts[1], F.lit(") "), parts[2], F.lit("-"), parts[3])
        if rule == "code":
            c = F.lower(c)
        return F.concat(F.lit("  "), c, F.lit(" "))

    return df.withColumns({c: spoil(c, rule) for c, rule in entity.cleaning.items()})


def with_copies(df: DataFrame, changed: dict[str, Column]) -> DataFrame:
    """The rows, and one copy of each with other values in some columns; the rows are computed once for both."""
    row = lambda values: F.struct(*[values.get(c, F.col(c)).alias(c) for c in df.columns])
    return df.select(F.inline(F.array(row({}), row(changed))))


def replayed(df: DataFrame, entity: Entity) -> DataFrame:
    """Base rows and one older version of each: undated, from 1990, or (clients) same date
    and a later name."""
    last = F.substring(F.col(entity.key), -1, 1)
    kind = df.schema[entity.newest_by].dataType
    old = F.when(last.isin(*"02468ace"), F.lit(None)).otherwise(F.lit("1990-01-01"))
    changed = {entity.newest_by: old.cast(kind)}
    if entity.name == "clients":
        tie = last == "3"
        changed[entity.newest_by] = F.when(tie, F.col(entity.newest_by)).otherwise(old.cast(kind))
        changed["client_name"] = F.when(tie, F.concat(F.lit("ZZZ "), "client_name")).otherwise(F.col("client_name"))
    return with_copies(df, changed)


# Column made too long in the broken copy of each entity.
TOO_LONG = {
    "clients": "city",
    "bank_transactions": "currency",
    "client_logins": "browser",
    "client_activities": "activity_type",
    "payments": "currency",
    "portfolios": "security_name",
    "currency_rates": "currency_pair",
}


def faulty(df: DataFrame, entity: Entity) -> DataFrame:
    """Base rows and one broken copy of each: without key, or with a value that is too long."""
    lost_key = F.substring(F.col(entity.key), -1, 1).isin(*"01234")
    column = TOO_LONG[entity.name]
    broken = {
        entity.key: F.when(~lost_key, F.col(entity.key)),
        column: F.when(lost_key, F.col(column)).otherwise("X" * (entity.max_length[column] + 1)),
    }
    return with_copies(df, broken)


# Column whose values are added up.
AMOUNT_COLUMN = {"bank_transactions": "amount", "payments": "amount", "portfolios": "current_price"}


def finer_and_larger(df: DataFrame, entity: Entity) -> DataFrame:
    """Base rows, and where an amount is added up copies with a thousandth of it and with 9e11 more."""
    if entity.name not in AMOUNT_COLUMN:
        return df
    column = AMOUNT_COLUMN[entity.name]
    c = F.col(column)
    return df.unionByName(df.withColumn(column, c / F.lit(1000.0))).unionByName(df.withColumn(column, c + F.lit(9e11)))


# Column that a corrected version changes, and its new value.
CORRECTED = {
    "clients": ("client_name", "client_name || ' II'"),
    "bank_transactions": ("amount", "amount / 2"),
    "client_logins": ("success", "NOT success"),
    "client_activities": ("duration_minutes", "duration_minutes + 1"),
    "payments": ("amount", "amount / 2"),
    "portfolios": ("current_price", "current_price / 2"),
}
# Client that takes over the facts whose key ends with 5.
TAKES_OVER = "CLIENT_000001"


def corrected(df: DataFrame, entity: Entity, last: str, day: str) -> DataFrame:
    """A version of the rows whose key ends with one of `last`, dated `day`, with another value or client."""
    column, value = CORRECTED[entity.name]
    end = F.substring(F.col(entity.key), -1, 1)
    rows = df.where(end.isin(*last)).withColumns(
        {column: F.expr(value).cast(df.schema[column].dataType), entity.newest_by: F.lit(day).cast(df.schema[entity.newest_by].dataType)}
    )
    if entity.name == "clients":
        return rows
    return rows.withColumn("client_id", F.when(end == "5", TAKES_OVER).otherwise(F.col("client_id")))


def arrivals(df: DataFrame, entity: Entity) -> list[DataFrame]:
    """Three arrivals: the base rows; corrections of some; all of them again in older versions, and corrections
    of some others and of some once more."""
    return [
        df,
        corrected(df, entity, "35", "2030-01-01"),
        replayed(df, entity).unionByName(corrected(df, entity, "57", "2031-01-01")),
    ]
