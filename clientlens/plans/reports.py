from __future__ import annotations

from collections.abc import Mapping
from datetime import date, datetime
from functools import reduce

from pyspark.sql import DataFrame, functions as F

from ..functions import money
from ..functions.dates import as_date, as_timestamp
from ..schemas import ENTITIES


# --- daily analytics over the client mart -------------------------------------------


def daily_segment_metrics(
    clients: DataFrame, as_of: date | str | None = None, created_at: datetime | str | None = None
) -> DataFrame:
    """Clients and revenue per segment, in the layout of the daily analytics mart."""
    return (
        clients.groupBy(F.col("combined_segment").alias("segment"))
        .agg(
            F.count("*").alias("clients_count"),
            money.decimal_total(F.col("total_value")).alias("total_revenue"),
            money.mean(F.col("total_value")).alias("avg_revenue"),
        )
        .select(
            as_date(as_of).alias("analysis_date"),
            "segment",
            "clients_count",
            "total_revenue",
            "avg_revenue",
            F.col("clients_count").alias("active_clients"),
            F.lit(0).cast("bigint").alias("new_clients"),
            as_timestamp(created_at).alias("created_at"),
        )
    )


def segment_summary(clients: DataFrame) -> DataFrame:
    return (
        clients.groupBy("combined_segment")
        .agg(
            F.count("*").alias("clients_count"),
            money.decimal_total(F.col("total_value")).alias("total_value"),
            money.mean(F.col("total_value")).alias("avg_value"),
            F.avg("activity_score").alias("avg_activity"),
        )
        .orderBy(F.col("total_value").desc_nulls_last(), F.col("combined_segment").asc_nulls_last())
    )


# --- reports over the offer mart ----------------------------------------------------


def offers_by_type_and_segment(offers: DataFrame) -> DataFrame:
    return (
        offers.groupBy("offer_type", "combined_segment")
        .agg(
            F.count("*").alias("offers_count"),
            money.decimal_total(F.col("expected_revenue")).alias("total_expected_revenue"),
            money.mean(F.col("expected_revenue")).alias("avg_expected_revenue"),
            F.min("days_valid").alias("min_validity_days"),
            F.max("days_valid").alias("max_validity_days"),
        )
        .orderBy(F.col("total_expected_revenue").desc_nulls_last(), "offer_type", "combined_segment")
    )


def top_clients(offers: DataFrame, limit: int = 10) -> DataFrame:
    """Clients with the highest expected revenue; equal totals by client id.

    Only `limit` rows leave each task, so the final order is not a full sort.
    """
    return (
        offers.groupBy("client_id", "client_name", "combined_segment")
        .agg(
            F.count("*").alias("offers_count"),
            money.decimal_total(F.col("expected_revenue")).alias("total_expected_revenue"),
            money.mean(F.col("expected_revenue")).alias("avg_offer_value"),
        )
        .orderBy(
            F.col("total_expected_revenue").desc_nulls_last(), "client_id", "client_name", "combined_segment"
        )
        .limit(limit)
    )


def priority_grid(offers: DataFrame) -> DataFrame:
    return (
        offers.groupBy("priority_level", "offer_priority")
        .agg(
            F.count("*").alias("offers_count"),
            money.decimal_total(F.col("expected_revenue")).alias("total_revenue"),
            F.avg("days_valid").alias("avg_validity"),
        )
        .orderBy(F.col("priority_level").asc_nulls_last(), F.col("offer_priority").asc_nulls_last())
    )


def top_offer_types(offers: DataFrame, limit: int = 10) -> DataFrame:
    return (
        offers.groupBy("offer_type")
        .agg(
            F.count("*").alias("offers_count"),
            money.decimal_total(F.col("expected_revenue")).alias("total_expected_revenue"),
            money.mean(F.col("expected_revenue")).alias("avg_expected_revenue"),
        )
        .orderBy(F.col("total_expected_revenue").desc_nulls_last(), "offer_type")
        .limit(limit)
    )


# --- verification of the segmentation -----------------------------------------------


def segmentation_report(segmentation: DataFrame) -> DataFrame:
    """Total, distinct and per-segment client counts as (metric, value) rows.

    The three plain counts share one scan: they are read off the counts per pair of
    computed and original segment.
    """
    pairs = segmentation.groupBy("segment", "original_segment").agg(F.count("*").alias("clients"))

    def by(column: str, label: str) -> DataFrame:
        return (
            pairs.groupBy(column)
            .agg(F.sum("clients").alias("value"))
            .select(F.concat(F.lit(label), F.col(column)).alias("metric"), "value")
        )

    total = pairs.agg(F.coalesce(F.sum("clients"), F.lit(0)).alias("value")).select(
        F.lit("Total clients").alias("metric"), "value"
    )
    unique = segmentation.agg(F.countDistinct("client_id").alias("value")).select(
        F.lit("Unique client_ids").alias("metric"), "value"
    )
    parts = [total, unique, by("segment", "Calculated Segment: "), by("original_segment", "Original Segment: ")]
    return reduce(DataFrame.unionByName, parts).orderBy(F.col("metric").asc_nulls_last())


def segment_drift(segmentation: DataFrame) -> DataFrame:
    """Clients whose computed segment equals or differs from the original one, in one pass.

    A client without an original segment counts in neither row.
    """
    counts = segmentation.agg(
        F.count_if(F.col("segment") == F.col("original_segment")).alias("matched"),
        F.count_if(F.col("segment") != F.col("original_segment")).alias("changed"),
    )
    return counts.select(
        F.stack(
            F.lit(2), F.lit("Segments matched"), F.col("matched"), F.lit("Segments changed"), F.col("changed")
        ).alias("comparison", "clients")
    )


def table_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Rows per entity table; Parquet tables are counted from file footers."""
    parts = [
        tables[e.name].agg(F.count("*").alias("row_count")).select(F.lit(e.label).alias("table_name"), "row_count")
        for e in ENTITIES.values()
        if e.name in tables
    ]
    return reduce(DataFrame.unionByName, parts)
