from __future__ import annotations

from collections.abc import Mapping
from datetime import date, datetime

from pyspark.sql import Column, DataFrame, functions as F

from ..functions import rules
from ..functions.dates import as_date, as_timestamp
from ..schemas import SEGMENTATION_DDL, struct
from .aggregates import BY_ENTITY

SEGMENTATION = struct(SEGMENTATION_DDL)
SEGMENTATION_COLUMNS = SEGMENTATION.names
# The numeric columns, which are 0 for a client without facts.
MEASURES = [f for f in SEGMENTATION.fields if f.dataType.typeName() in ("long", "double")]


def segment_clients(
    entities: Mapping[str, DataFrame],
    as_of: date | str | None = None,
    created_at: datetime | str | None = None,
    thresholds: rules.SegmentThresholds = rules.SegmentThresholds(),
    aggregated: Mapping[str, DataFrame] | None = None,
) -> DataFrame:
    """One row per client with its measures and computed segment.

    `aggregated` has the per-client aggregates of facts where they are at hand; the others are made of `entities`.

    Facts are aggregated before they are joined. The aggregates come out hash-partitioned
    by client, so the five left joins add one exchange only, that of the clients.
    """
    joined = entities["clients"].select(
        "client_id", "client_name", "city", "status", F.col("segment").alias("original_segment")
    )
    made = aggregated or {}
    for name, aggregate in BY_ENTITY.items():
        joined = joined.join(made[name] if name in made else aggregate(entities[name]), "client_id", "left")
    measured = joined.withColumns(
        {f.name: F.coalesce(F.col(f.name), F.lit(0).cast(f.dataType)) for f in MEASURES}
    )
    return measured.withColumns(
        {
            "segment": rules.segment(
                F.col("total_transaction_amount"),
                F.col("login_count"),
                F.col("activity_count"),
                F.col("portfolio_value"),
                thresholds,
            ),
            "processing_date": as_date(as_of),
            "created_at": as_timestamp(created_at),
        }
    ).select(*SEGMENTATION_COLUMNS)


def latest_snapshot(segmentation: DataFrame, as_of: date | str | None = None) -> DataFrame:
    """Rows of the given processing date, or of the newest one present."""
    if as_of is not None:
        return segmentation.where(F.col("processing_date") == F.lit(str(as_of)).cast("date"))
    newest = segmentation.agg(F.max("processing_date")).scalar()
    return segmentation.where(F.col("processing_date") == newest)


def combine_segments(
    segmentation: DataFrame, thresholds: rules.ActivityThresholds = rules.ActivityThresholds()
) -> DataFrame:
    """Activity-aware segment, score and priority per client.

    `login_count` is kept as a trailing column because the offer order needs it.
    """
    seg = F.col("segment")
    return segmentation.select(
        F.col("client_id").cast("string").alias("client_id"),
        "client_name",
        seg.alias("portfolio_segment"),
        seg.alias("transaction_segment"),
        rules.combined_segment(seg, F.col("login_count"), F.col("transaction_count"), thresholds).alias(
            "combined_segment"
        ),
        F.col("total_transaction_amount").alias("total_value"),
        (F.col("login_count") + F.col("activity_count")).alias("activity_score"),
        rules.priority(seg).alias("priority_level"),
        "login_count",
    )


def client_order() -> list[Column]:
    """Order in which clients are numbered: by value, then logins; client_id makes it total."""
    return [
        F.col("total_value").desc_nulls_last(),
        F.col("login_count").desc_nulls_last(),
        F.col("client_id").asc_nulls_last(),
    ]
