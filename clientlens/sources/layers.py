"""Raw, cleaned, structured, segmentation and mart layers as Parquet folders.

raw/<date>/<table>                         one overwrite per date
cleaned/<table>/processing_date=<date>     a run replaces its own date only
structured/<table>                         replaced as a whole; in buckets after incremental runs
partials/<table>                           aggregates per client and day, in buckets
segmentation/processing_date=<date>        history kept
marts/<table>/yyyymm=<month>/run_date=<d>  a run replaces its own date only
reports/<report>/run_date=<date>           a run replaces its own date only
arrivals/<table>/rejected=<r>/processing_date=<date>   appended by the incremental ingest; true: what could not be read
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F

from ..functions.dates import yyyymm
from ..functions.zorder import place
from ..operators.segmentation import SEGMENTATION
from ..schemas import Entity, Mart
from ..workspace import CODEC
from . import swap


@dataclass(frozen=True)
class Layers:
    root: str

    def raw(self, entity: Entity, processing_date: str) -> str:
        return f"{self.root}/raw/{processing_date}/{entity.raw_table}"

    def unreadable(self, entity: Entity, processing_date: str) -> str:
        return f"{self.root}/unreadable/{processing_date}/{entity.raw_table}"

    def cleaned(self, entity: Entity) -> str:
        return f"{self.root}/cleaned/{entity.structured_table}"

    def quarantine(self, entity: Entity) -> str:
        return f"{self.root}/quarantine/{entity.structured_table}"

    def structured(self, entity: Entity) -> str:
        return f"{self.root}/structured/{entity.structured_table}"

    def partials(self, entity: Entity) -> str:
        return f"{self.root}/partials/{entity.structured_table}"

    @property
    def segmentation(self) -> str:
        return f"{self.root}/segmentation/client_segmentation"

    def mart(self, mart: Mart) -> str:
        return f"{self.root}/marts/{mart.name}"

    def report(self, name: str, run_date: str) -> str:
        return f"{self.root}/reports/{name}/run_date={run_date}"

    def arrivals(self, entity: Entity) -> str:
        return f"{self.root}/arrivals/{entity.raw_table}"

    def arrived(self, entity: Entity, unreadable: bool = False) -> str:
        return f"{self.arrivals(entity)}/rejected={'true' if unreadable else 'false'}"

    def arrivals_log(self, entity: Entity) -> str:
        return f"{self.root}/checkpoints/arrivals/{entity.raw_table}"


def counted(df: DataFrame, **extra: Column) -> tuple[DataFrame, Observation]:
    """The same rows plus an observation that counts them while they are written."""
    observation = Observation()
    metrics = [F.count(F.lit(1)).alias("rows"), *[c.alias(n) for n, c in extra.items()]]
    return df.observe(observation, *metrics), observation


def write_raw(df: DataFrame, path: str) -> int:
    watched, seen = counted(df)
    watched.write.mode("overwrite").option("compression", CODEC).parquet(path)
    return seen.get["rows"]


def read_raw(spark: SparkSession, path: str, entity: Entity) -> DataFrame:
    ddl = f"{entity.ddl}, ingestion_timestamp timestamp, processing_date string"
    return spark.read.schema(ddl).parquet(path)


def overwrite_partitions(df: DataFrame, path: str, by: Sequence[str]) -> None:
    """Replace only the partitions that occur in `df`; all others stay."""
    writer = df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").option("compression", CODEC)
    writer.partitionBy(*by).parquet(path)


def replace_folder(df: DataFrame, folder: str) -> None:
    """Replace what a folder holds, also by no rows at all."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "static").option("compression", CODEC).parquet(folder)


def dated(path: str, processing_date: str) -> str:
    return f"{path}/processing_date={processing_date}"


def write_dated(df: DataFrame, path: str, processing_date: str) -> None:
    """Replace one date of a table, by its folder: no sort by partition column, and an empty
    result empties the date."""
    replace_folder(df.drop("processing_date"), dated(path, processing_date))


def folders(spark: SparkSession, pattern: str) -> list[str]:
    """Folders that match a pattern, from the file system's listing; no file is opened."""
    place = spark._jvm.org.apache.hadoop.fs.Path(pattern)
    found = place.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).globStatus(place)
    return sorted(f.getPath().toString() for f in found or [] if f.isDirectory())


def clear(spark: SparkSession, folder: str, ddl: str) -> None:
    """Leave a folder without rows, if it is there."""
    if folders(spark, folder):
        replace_folder(spark.createDataFrame([], ddl), folder)


def write_halves(
    df: DataFrame, flag: str, root: str, lane: str, kept: tuple[str, str], rejected: tuple[str, str]
) -> tuple[int, int]:
    """Write rows to one of two folders below `root` by a boolean column, in one pass; gives the rows of each.

    `kept` and `rejected` are (folder, columns). Both folders are replaced as one change, by renaming what
    a single job wrote, so they always come from the same reading of the input.
    """
    spark = df.sparkSession
    change, parts = swap.begin(spark, root, lane), []
    watched, seen = counted(df, flagged=F.count_if(flag))
    watched.write.option("compression", CODEC).partitionBy(flag).parquet(f"{change}/raw")
    for value, (folder, ddl) in (("false", kept), ("true", rejected)):
        part = folder.removeprefix(f"{root}/")
        if swap.exists(spark, f"{change}/raw/{flag}={value}"):
            swap.move(spark, f"{change}/raw/{flag}={value}", f"{change}/new/{part}")
        elif value == "false" or swap.exists(spark, folder):
            spark.createDataFrame([], ddl).write.parquet(f"{change}/new/{part}")
        else:
            continue
        parts.append(part)
    swap.commit(spark, change, parts)
    swap.settle(spark, root, lane)
    metrics = seen.get
    return metrics["rows"] - metrics["flagged"], metrics["flagged"]


def newest_date(spark: SparkSession, path: str, upto: str) -> str | None:
    """Newest date of a dated table that is not after `upto`; a date loaded with no rows counts."""
    dates = [f.rsplit("=", 1)[1] for f in folders(spark, dated(path, "*"))]
    return max((d for d in dates if d <= upto), default=None)


def write_cleaned(df: DataFrame, path: str, processing_date: str) -> int:
    watched, seen = counted(df)
    write_dated(watched, path, processing_date)
    return seen.get["rows"]


def read_cleaned(spark: SparkSession, path: str, entity: Entity) -> DataFrame:
    """All dates of a cleaned table; filter on processing_date to prune folders."""
    return spark.read.schema(f"{entity.ddl}, processing_date date").parquet(path)


def write_full_refresh(df: DataFrame, path: str, compression: str = CODEC) -> int:
    watched, seen = counted(df)
    watched.write.mode("overwrite").option("compression", compression).parquet(path)
    return seen.get["rows"]


def write_in_parts(parts: Sequence[DataFrame], path: str) -> int:
    """Replace a table by rows that are made part by part; a part that fails leaves no half of a table."""
    rows = 0
    for n, part in enumerate(parts):
        watched, seen = counted(part)
        try:
            watched.write.mode("append" if n else "overwrite").option("compression", CODEC).parquet(path)
        except Exception:
            if n:
                swap.remove(part.sparkSession, path)
            raise
        rows += seen.get["rows"]
    return rows


def read_arrived(
    spark: SparkSession, layers: Layers, entity: Entity, processing_date: str, unreadable: bool = False
) -> DataFrame:
    """Rows that the incremental ingest appended on a date, or what it could not read; none if nothing has arrived yet.

    The table is read as a whole, as only there the log of the ingest says which files count.
    """
    lineage = "ingestion_timestamp timestamp, processing_date string"
    own = f"{'raw_value string, violations string' if unreadable else entity.ddl}, {lineage}"
    path = layers.arrivals(entity)
    if not folders(spark, path):
        return spark.createDataFrame([], own)
    rows = spark.read.schema(f"{own}, rejected boolean").parquet(path)
    wanted = (F.col("rejected") == unreadable) & (F.col("processing_date") == processing_date)
    return rows.where(wanted).drop("rejected")


def read_structured(spark: SparkSession, path: str, entity: Entity) -> DataFrame:
    return swap.read(spark, path, entity.schema).select(*entity.columns)


def write_segmentation(df: DataFrame, path: str, processing_date: str | None = None) -> int:
    """Replace the given date, or the dates that occur in the rows. Rows are sorted inside each file by the columns that reads
    filter on, so Parquet row-group statistics can skip."""
    watched, seen = counted(df)
    placed = watched.sortWithinPartitions("processing_date", "segment", "city", "status")
    if processing_date is None:
        overwrite_partitions(placed, path, ["processing_date"])
    else:
        write_dated(placed, path, processing_date)
    return seen.get["rows"]


# Columns that reads of the segmentation filter on.
ACCESS_COLUMNS = ("segment", "city", "status")


def write_clustered(
    df: DataFrame, path: str, processing_date: str, by: Sequence[str] = ACCESS_COLUMNS, files: int | None = None
) -> int:
    """Replace a date of the segmentation, its files narrow in each of the columns `by`.

    Rows are dealt to files by ranges of a common order of these columns, so a filter on any of them skips files
    by their smallest and largest values, where an order by one after the other serves only the first.
    """
    watched, seen = counted(df)
    order = [place(df, by), *[F.col(c) for c in by], F.col("client_id")]
    placed = watched.repartitionByRange(*([files] if files else []), *order)
    write_dated(placed.sortWithinPartitions(*order), path, processing_date)
    return seen.get["rows"]


def read_snapshot(spark: SparkSession, path: str, as_of: str | None = None) -> DataFrame:
    """The segmentation of a date, or of the newest one that has a folder; other dates are not opened."""
    newest = as_of or newest_date(spark, path, "9999-12-31")
    if newest is None:
        raise LookupError(f"{path} has no date")
    return read_segmentation(spark, path).where(F.col("processing_date") == F.lit(newest).cast("date"))


def of_runs(segmentation: DataFrame, runs: DataFrame) -> DataFrame:
    """Segmentation rows of the dates that `runs` has in `processing_date`, with its other columns.

    The dates are known only while the query runs; Spark then reads their folders and no others.
    """
    return segmentation.join(runs, "processing_date")


def read_segmentation(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(SEGMENTATION).parquet(path).select(*SEGMENTATION.names)


def to_mart(df: DataFrame, mart: Mart) -> DataFrame:
    """Rows cast to the layout of the mart."""
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in mart.schema.fields])


def write_mart(df: DataFrame, path: str, mart: Mart, run_date: str) -> int:
    """Load one run: its rows replace what an earlier run of the same date wrote.

    Sorted inside each file by the mart's sort key; no shuffle is added. Months the earlier
    run wrote and this one has no rows for are emptied.
    """
    swap.settle(df.sparkSession, path)
    earlier = folders(df.sparkSession, f"{path}/yyyymm=*/run_date={run_date}")
    month = {f: int(f.rsplit("/", 2)[1].removeprefix("yyyymm=")) for f in earlier}
    rows = to_mart(df, mart).withColumns(
        {"yyyymm": yyyymm(F.col(mart.month_of)), "run_date": F.lit(run_date).cast("date")}
    )
    placed, seen = counted(rows, **{f"in_{m}": F.count_if(F.col("yyyymm") == m) for m in month.values()})
    overwrite_partitions(
        placed.sortWithinPartitions("yyyymm", "run_date", *mart.sort_by), path, ["yyyymm", "run_date"]
    )
    for folder, m in month.items():
        if not seen.get[f"in_{m}"]:
            clear(df.sparkSession, folder, mart.ddl)
    return seen.get["rows"]


def prepare_month(df: DataFrame, path: str, month: int) -> tuple[str, int]:
    """Write the new rows of a month beside the old ones, which `df` may read; gives the change and its rows."""
    change = swap.begin(df.sparkSession, path)
    watched, seen = counted(df)
    watched.write.option("compression", CODEC).partitionBy("run_date").parquet(f"{change}/new/yyyymm={month}")
    return change, seen.get["rows"]


def replace_month(df: DataFrame, path: str, month: int) -> int:
    """Replace one month of a mart, with the run dates that have no rows any more; gives the number of rows.

    A failed write leaves the old month as it was; once the new one is complete, a stop at any step is made
    good by the next load, and readers see the whole month meanwhile.
    """
    change, rows = prepare_month(df, path, month)
    swap.commit(df.sparkSession, change, [f"yyyymm={month}"])
    swap.settle(df.sparkSession, path)
    return rows


def read_mart(spark: SparkSession, path: str, mart: Mart) -> DataFrame:
    return swap.read(spark, path, f"{mart.ddl}, yyyymm int, run_date date")


def write_jdbc(df: DataFrame, url: str, table: str, batch_size: int = 10_000, **properties: str) -> None:
    """Append to a table of an external database, each task in batches (needs its JDBC driver)."""
    df.write.format("jdbc").mode("append").option("url", url).option("dbtable", table).option(
        "batchsize", batch_size
    ).options(**properties).save()


def read_jdbc(
    spark: SparkSession,
    url: str,
    table: str,
    partition_column: str | None = None,
    bounds: tuple[str, str] | None = None,
    partitions: int = 1,
    **properties: str,
) -> DataFrame:
    """Table of an external database; with a partition column every executor reads a slice."""
    reader = spark.read.format("jdbc").option("url", url).option("dbtable", table).options(**properties)
    if partition_column:
        low, high = bounds
        reader = (
            reader.option("partitionColumn", partition_column)
            .option("lowerBound", low)
            .option("upperBound", high)
            .option("numPartitions", partitions)
        )
    return reader.load()
