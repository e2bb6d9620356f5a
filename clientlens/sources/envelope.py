"""Rows as JSON messages: encode, decode, route, and the Kafka ends.

A message envelope has the columns of Spark's Kafka source. Kept as Parquet files it
stands in for a topic where no broker or connector is available.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..schemas import ENTITIES, ENVELOPE_DDL, Entity
from ..workspace import CODEC
from . import offsets, swap

# Same text a JSON encoder that falls back to str() gives for dates and timestamps.
JSON_FORMATS = {"timestampFormat": "yyyy-MM-dd HH:mm:ss.SSSSSS", "dateFormat": "yyyy-MM-dd"}

# Delivery settings of the message writer.
PRODUCER = {
    "kafka.compression.type": "lz4",
    "kafka.acks": "1",
    "kafka.retries": "3",
    "kafka.retry.backoff.ms": "300",
    "kafka.batch.size": "32768",
    "kafka.linger.ms": "10",
    "kafka.buffer.memory": "33554432",
    "kafka.max.in.flight.requests.per.connection": "5",
    "kafka.request.timeout.ms": "30000",
}


def routes(prefix: str = "") -> dict[str, Entity]:
    """topic -> entity; `prefix` is put before every topic name."""
    return {f"{prefix}{e.topic}": e for e in ENTITIES.values()}


def parse_topics(text: str) -> list[str]:
    """Topic names from a list separated by commas or blanks."""
    return text.replace(",", " ").split()


def entities_of(topics: list[str], prefix: str = "") -> tuple[list[Entity], list[str]]:
    """(entities of the known topics, names of the unknown ones, which are skipped)."""
    known = routes(prefix)
    return [known[t] for t in topics if t in known], [t for t in topics if t not in known]


def to_messages(df: DataFrame, topic: str) -> DataFrame:
    """(topic, value): the whole row as JSON, no key."""
    return df.select(F.lit(topic).alias("topic"), F.to_json(F.struct("*"), JSON_FORMATS).alias("value"))


def to_envelope(df: DataFrame, topic: str, at: str | None = None) -> DataFrame:
    """Messages with all columns of the Kafka source, for file-based topics."""
    sent = F.current_timestamp() if at is None else F.lit(at).cast("timestamp")
    slot = F.monotonically_increasing_id()
    return to_messages(df, topic).select(
        F.lit(None).cast("binary").alias("key"),
        F.col("value").cast("binary").alias("value"),
        "topic",
        F.shiftright(slot, 33).cast("int").alias("partition"),
        slot.bitwiseAND(F.lit((1 << 33) - 1)).alias("offset"),
        sent.alias("timestamp"),
        F.lit(0).alias("timestampType"),
    )


def write_topic(df: DataFrame, servers: str, topic: str, **options: str) -> None:
    """Send a DataFrame to a Kafka topic (needs the Kafka connector on the classpath)."""
    writer = to_messages(df, topic).select("value").write.format("kafka")
    writer.option("kafka.bootstrap.servers", servers).option("topic", topic).options(
        **{**PRODUCER, **options}
    ).save()


def read_topic(spark: SparkSession, servers: str, topic: str, **options: str) -> DataFrame:
    """Everything a topic holds now, earliest to latest (needs the Kafka connector)."""
    return (
        spark.read.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("startingOffsets", "earliest")
        .option("endingOffsets", "latest")
        .options(**options)
        .load()
    )


def topic_folder(path: str, topic: str) -> str:
    return f"{path}/topic={topic}"


def write_envelope(
    df: DataFrame, path: str, topic: str, at: str | None = None, partitions: int | None = None
) -> None:
    """Append rows to a file-based topic: one folder per topic below `path`.

    `partitions` spreads the rows over that many files, as over the partitions of a topic,
    so that reading is not bound to the few tasks a small or unsplittable input gives.

    Each topic is written to its own folder rather than with `partitionBy`, so that topics
    can be written at the same time: Spark writers of one folder remove each other's
    temporary files.
    """
    spread = df if partitions is None else df.repartition(partitions)
    sent, folder = to_envelope(spread, topic, at).drop("topic"), topic_folder(path, topic)
    begun = offsets.ends(read_envelope(df.sparkSession, path, topic)) if swap.exists(df.sparkSession, folder) else {}
    if begun:
        # Offsets go on from those of the messages that are there.
        after = F.create_map(*[F.lit(x) for pair in begun.items() for x in pair])
        sent = sent.withColumn("offset", F.col("offset") + F.coalesce(after[F.col("partition")], F.lit(0)))
    sent.write.mode("append").option("compression", CODEC).parquet(folder)


def read_envelope(spark: SparkSession, path: str, topic: str | None = None) -> DataFrame:
    """Messages of one file-based topic, or of all topics below `path`."""
    if topic is None:
        return spark.read.schema(ENVELOPE_DDL).parquet(path)
    reader = spark.read.schema(ENVELOPE_DDL).option("basePath", path)
    return reader.parquet(topic_folder(path, topic))


def parse_messages(envelope: DataFrame, entity: Entity) -> DataFrame:
    """Typed columns of the entity plus `raw_value`, the message text.

    Text that is not JSON gives NULL in every typed column, as does a missing value.

    The struct is unpacked by `inline`, not by selecting its fields: the optimizer would
    copy the parse into every later filter on a field, and parse each message many times.
    """
    text = F.col("value").cast("string")
    return envelope.select(F.inline(F.array(F.from_json(text, entity.schema))), text.alias("raw_value"))


def is_unreadable(entity: Entity) -> Column:
    return reduce(lambda a, b: a & b, [F.col(c).isNull() for c in entity.columns])


def type_violations(entity: Entity) -> Column:
    """Fields that a message has a value for and whose type that value does not fit: array of (field, text).

    Works on the columns of `parse_messages`. Only messages with an empty field are parsed again, as VARIANT. Text
    that the reader of typed fields takes but VARIANT does not, as NaN, is searched for the field's name.
    """
    raw = F.col("raw_value")
    # A field whose name the text does not have, spelled out or escaped, has no value in it.
    named_in = {c: F.col(c).isNull() & (raw.contains(f'"{c}"') | raw.contains("\\")) for c in entity.columns}
    empty = reduce(lambda a, b: a | b, named_in.values())

    def named(v: Column) -> Column:
        found = []
        for c in entity.columns:
            plain = F.regexp_extract(raw, rf'"{c}"\s*:\s*([^,}}\s]+)', 1)
            plain = F.when(v.isNull() & ~plain.isin("", "null"), plain)
            text = F.coalesce(F.try_variant_get(v, f"$.{c}", "string"), plain)
            found.append(F.when(named_in[c] & text.isNotNull(), F.struct(F.lit(c).alias("field"), text.alias("text"))))
        return F.filter(F.array(*found), lambda f: f.isNotNull())

    # The variable of a lambda is a value, so a message is parsed once for all its fields.
    found = F.get(F.transform(F.array(F.expr("try_parse_json(raw_value)")), named), F.lit(0))
    return F.when(empty, found).otherwise(F.array().cast("array<struct<field:string,text:string>>"))


def with_violations(parsed: DataFrame, entity: Entity) -> DataFrame:
    """Parsed messages with `violations`: `unreadable`, or `type:<field>=<text>` of each field; empty if none."""
    listed = F.transform(type_violations(entity), lambda f: F.concat(F.lit("type:"), f["field"], F.lit("="), f["text"]))
    found = F.when(is_unreadable(entity), F.lit("unreadable")).otherwise(F.array_join(listed, ","))
    # Out of an explode the text is a value, which later filters do not compute again.
    return parsed.select("*", F.explode(F.array(found)).alias("violations"))


IS_REJECTED = "violations <> ''"


def read_messages(
    envelope: DataFrame, entity: Entity, strict: bool = False, together: bool = False
) -> tuple[DataFrame, DataFrame | None]:
    """(typed rows, messages that could not be read with their violations).

    A message that is not JSON, or has a field of the wrong type, is in the second part. `strict` keeps such
    a message as a row with NULLs instead and returns no second part. `together` keeps both in the first part, parsed
    once, with `raw_value` and `violations`, which are empty where the message could be read.
    """
    parsed = parse_messages(envelope, entity)
    if strict:
        return parsed.drop("raw_value"), None
    checked = with_violations(parsed, entity)
    if together:
        return checked, None
    kept = checked.where(f"not ({IS_REJECTED})").drop("raw_value", "violations")
    return kept, checked.where(IS_REJECTED).select("raw_value", "violations")


def with_lineage(df: DataFrame, processing_date: str, at: str | None = None) -> DataFrame:
    stamp = F.current_timestamp() if at is None else F.lit(at).cast("timestamp")
    return df.withColumns({"ingestion_timestamp": stamp, "processing_date": F.lit(processing_date)})


def topic_report(envelope: DataFrame, prefix: str = "") -> DataFrame:
    """Messages per topic, with the entity they are routed to; NULL entity = unknown topic."""
    known = routes(prefix)
    target = F.lit(None).cast("string")
    for topic, entity in known.items():
        target = F.when(F.col("topic") == topic, F.lit(entity.raw_table)).otherwise(target)
    return (
        envelope.groupBy("topic")
        .agg(F.count("*").alias("messages"))
        .select("topic", "messages", target.alias("raw_table"), target.isNotNull().alias("known"))
    )


def send_report(rows: DataFrame, entity: Entity, seconds: float | None = None) -> DataFrame:
    """Sent and failed rows of one entity with error rate, and throughput if `seconds` is given."""
    from ..operators.quality import is_broken

    counts = rows.agg(
        F.count_if(~is_broken(entity)).alias("sent"), F.count_if(is_broken(entity)).alias("errors")
    )
    attempts = F.greatest(F.lit(1), F.col("sent") + F.col("errors"))
    return counts.select(
        F.lit(entity.topic).alias("topic"),
        "sent",
        "errors",
        (F.lit(None) if not seconds else F.col("sent") / F.lit(seconds))
        .cast("double")
        .alias("records_per_second"),
        (F.col("errors") * 100.0 / attempts).alias("error_rate_percent"),
    )
