from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions.text import RULES
from ..schemas import Entity


def clean(df: DataFrame, entity: Entity) -> DataFrame:
    """Apply the entity's cleaning rules to those of its columns that are present."""
    present = {c: RULES[rule](F.col(c)) for c, rule in entity.cleaning.items() if c in df.columns}
    return df.withColumns(present) if present else df


def to_cleaned(df: DataFrame, entity: Entity, processing_date: str) -> DataFrame:
    """Raw rows -> cleaned rows: rules, guaranteed partition column, no ingest-only column."""
    cleaned = clean(df, entity)
    if "processing_date" not in cleaned.columns:
        cleaned = cleaned.withColumn("processing_date", F.lit(processing_date))
    return cleaned.drop("ingestion_timestamp")
