from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..schemas import Entity


# Text of a line that has a cell its column's type cannot hold; NULL for all other lines.
BROKEN = "_broken_line"
# Quotes inside a quoted cell are doubled, as most writers of CSV do.
CSV = {"header": "true", "escape": '"'}


def read_file(
    spark: SparkSession, path: str, entity: Entity, multi_line: bool = False, keep_broken: bool = False
) -> DataFrame:
    """Entity rows from a file or folder; `.parquet` is read as Parquet, anything else as CSV.

    The schema is the entity's, so no pass over the data is spent on inferring one. A CSV
    header that does not match the schema is an error rather than shifted columns.
    `multi_line` allows line breaks inside quotes; a file is then read by one task as a whole.
    With `keep_broken` the column BROKEN is added; without it cells that do not parse are NULL.
    """
    if path.rstrip("/").lower().endswith(".parquet"):
        rows = spark.read.schema(entity.schema).parquet(path)
        return rows.withColumn(BROKEN, F.lit(None).cast("string")) if keep_broken else rows
    schema = f"{entity.ddl}, {BROKEN} string" if keep_broken else entity.schema
    reader = spark.read.schema(schema).options(**CSV).option("enforceSchema", False)
    return reader.option("multiLine", multi_line).option("columnNameOfCorruptRecord", BROKEN).csv(path)


def input_path(folder: str, entity: Entity, suffix: str = "csv") -> str:
    return f"{folder.rstrip('/')}/{entity.source_file}.{suffix}"
