"""Per-client aggregates of the five fact entities.

All are plain hash aggregates with map-side combine: the shuffle carries one row per
client and map task, however many facts one client has.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions import money


def transactions_by_client(df: DataFrame) -> DataFrame:
    return df.groupBy("client_id").agg(
        F.count("*").alias("transaction_count"),
        money.total(F.col("amount")).alias("total_transaction_amount"),
        money.mean(F.col("amount")).alias("avg_transaction_amount"),
        F.max("amount").alias("max_transaction_amount"),
    )


def logins_by_client(df: DataFrame) -> DataFrame:
    return df.groupBy("client_id").agg(
        F.count("*").alias("login_count"),
        F.count_if(F.col("success")).alias("successful_logins"),
    )


def activities_by_client(df: DataFrame) -> DataFrame:
    return df.groupBy("client_id").agg(
        F.count("*").alias("activity_count"),
        F.sum("duration_minutes").alias("total_activity_minutes"),
        F.sum("page_views").alias("total_page_views"),
    )


def payments_by_client(df: DataFrame) -> DataFrame:
    return df.groupBy("client_id").agg(
        F.count("*").alias("payment_count"),
        money.total(F.col("amount")).alias("total_payment_amount"),
    )


def portfolios_by_client(df: DataFrame) -> DataFrame:
    value = F.col("quantity") * F.col("current_price")
    return df.groupBy("client_id").agg(
        F.count("*").alias("portfolio_count"),
        money.total(value).alias("portfolio_value"),
    )


BY_ENTITY = {
    "bank_transactions": transactions_by_client,
    "client_logins": logins_by_client,
    "client_activities": activities_by_client,
    "payments": payments_by_client,
    "portfolios": portfolios_by_client,
}
