"""Catalog tables over the layers: external tables, managed tables, partitions, statistics."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager, nullcontext

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..schemas import ENTITIES, MARTS, Entity
from .layers import Layers, folders, read_cleaned


def create_external_table(spark: SparkSession, name: str, ddl: str, path: str, partitioned_by: str = "") -> None:
    """Table over existing Parquet files; dropping it leaves the files."""
    clause = f"PARTITIONED BY ({partitioned_by})" if partitioned_by else ""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({ddl}) USING parquet {clause} LOCATION '{path}'")


def register_cleaned(spark: SparkSession, layers: Layers, entity: Entity, name: str | None = None) -> str:
    """External table of a cleaned layer with its date partitions."""
    name = name or f"ext_{entity.structured_table}"
    create_external_table(
        spark, name, f"{entity.ddl}, processing_date date", layers.cleaned(entity), "processing_date"
    )
    recover_partitions(spark, name)
    return name


def recover_partitions(spark: SparkSession, name: str) -> None:
    """Make date folders written since the last call visible in the catalog."""
    spark.sql(f"MSCK REPAIR TABLE {name}")


def create_views(spark: SparkSession, layers: Layers) -> list[str]:
    """Session views over all cleaned tables, for catalogs that cannot be written."""
    names = []
    for entity in ENTITIES.values():
        name = f"ext_{entity.structured_table}"
        read_cleaned(spark, layers.cleaned(entity), entity).createOrReplaceTempView(name)
        names.append(name)
    return names


def create_mart_tables(spark: SparkSession, layers: Layers, prefix: str = "") -> list[str]:
    """Empty or existing tables of all five marts, partitioned by month and run date; what has
    been loaded already is registered with them."""
    names = []
    for mart in MARTS.values():
        create_external_table(
            spark,
            f"{prefix}{mart.name}",
            f"{mart.ddl}, yyyymm int, run_date date",
            layers.mart(mart),
            "yyyymm, run_date",
        )
        if folders(spark, layers.mart(mart)):
            recover_partitions(spark, f"{prefix}{mart.name}")
        names.append(f"{prefix}{mart.name}")
    return names


def save_table(
    df: DataFrame,
    name: str,
    bucket_by: str | None = None,
    buckets: int | None = None,
    compression: str = "zstd",
) -> None:
    """Managed table, replaced as a whole.

    Bucketing by client saves the shuffle of later per-client joins, but gives a client
    with a large share of the rows one large bucket; leave it off for fact tables where
    such clients occur, since map-side aggregation handles them.
    """
    writer = df.write.mode("overwrite").format("parquet").option("compression", compression)
    if bucket_by:
        writer = writer.bucketBy(buckets, bucket_by).sortBy(bucket_by)
    writer.saveAsTable(name)


def save_co_located(df: DataFrame, name: str, by: list[str], buckets: int) -> None:
    """Managed table in buckets of some columns, one sorted file each.

    Aggregates and joins by these columns run where the rows lie. The rows are dealt by the same hash that the
    buckets have, so a task writes whole buckets.
    """
    placed = df.repartition(buckets, *by)
    placed.write.mode("overwrite").bucketBy(buckets, *by).sortBy(*by).saveAsTable(name)


def salted(df: DataFrame, key: str, salts: int) -> DataFrame:
    """The rows with a `salt` by their key, for bucketing by client and salt.

    A client with a large share of the rows then lies in several buckets; aggregation by client exchanges one
    partial row for each client and bucket.
    """
    return df.withColumn("salt", F.pmod(F.xxhash64(key), F.lit(salts)).cast("int"))


# Settings under which the optimizer uses the statistics of columns, for estimates and the order of joins.
COST_BASED = {
    "spark.sql.cbo.enabled": "true",
    "spark.sql.cbo.joinReorder.enabled": "true",
    "spark.sql.cbo.planStats.enabled": "true",
    "spark.sql.statistics.histogram.enabled": "true",
}


@contextmanager
def cost_based(spark: SparkSession) -> Iterator[None]:
    before = {k: spark.conf.get(k, None) for k in COST_BASED}
    for k, v in COST_BASED.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def analyze(spark: SparkSession, name: str, histograms: bool = False) -> None:
    """Statistics for the cost-based optimizer; `histograms` adds the distribution of each column's values."""
    with cost_based(spark) if histograms else nullcontext():
        spark.sql(f"ANALYZE TABLE {name} COMPUTE STATISTICS FOR ALL COLUMNS")


def expected_rows(df: DataFrame) -> int | None:
    """Rows that the cost-based optimizer expects a query over analysed tables to give; None if it cannot tell."""
    spark = df.sparkSession
    with cost_based(spark):
        rows = df.select("*")._jdf.queryExecution().optimizedPlan().stats().rowCount()
        return int(str(rows.get())) if rows.isDefined() else None
