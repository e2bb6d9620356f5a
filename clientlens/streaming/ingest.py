from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from ..schemas import MESSAGE_FILE_DDL, Entity
from ..sources.envelope import IS_REJECTED, read_messages, topic_folder, with_lineage
from ..workspace import CODEC


def stream_files(spark: SparkSession, path: str, topic: str, **options: str) -> DataFrame:
    """New messages of one file-based topic."""
    reader = spark.readStream.schema(MESSAGE_FILE_DDL).options(**options)
    return reader.parquet(topic_folder(path, topic))


def stream_topic(spark: SparkSession, servers: str, topic: str, **options: str) -> DataFrame:
    """New messages of one Kafka topic (needs the Kafka connector)."""
    return (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("startingOffsets", "earliest")
        .options(**options)
        .load()
    )


def start_ingest(
    messages: DataFrame,
    entity: Entity,
    target: str,
    checkpoint: str,
    processing_date: str,
    unreadable: bool = False,
) -> StreamingQuery:
    """Parse what arrived since the last run and append it below `target`, then stop.

    The transform is the one of the batch ingest. The file sink's log makes every message
    appear exactly once, also after a failure. With `unreadable` the query writes the
    messages that could not be read instead, with what is wrong; it needs a checkpoint of its own.
    """
    kept, aside = read_messages(messages, entity)
    rows = aside if unreadable else kept
    return _append(with_lineage(rows, processing_date), target, checkpoint, ["processing_date"])


def start_ingest_halves(
    messages: DataFrame, entity: Entity, target: str, checkpoint: str, processing_date: str
) -> StreamingQuery:
    """As `start_ingest`, but every message is parsed once: rows and messages that could not be read, told apart by
    `rejected`, come from the same pass, and one log counts the files of both."""
    checked, _ = read_messages(messages, entity, together=True)
    rejected = F.expr(IS_REJECTED)
    rows = with_lineage(checked, processing_date).withColumns(
        {
            "raw_value": F.when(rejected, F.col("raw_value")),
            "violations": F.when(rejected, F.col("violations")),
            "rejected": rejected,
        }
    )
    return _append(rows, target, checkpoint, ["rejected", "processing_date"])


def _append(rows: DataFrame, target: str, checkpoint: str, by: list[str]) -> StreamingQuery:
    return (
        rows.writeStream.format("parquet")
        .option("path", target)
        .option("checkpointLocation", checkpoint)
        .option("compression", CODEC)
        .partitionBy(*by)
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )
