"""Every operator as a query (spark, sf_dir) -> DataFrame over the provided tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from functools import partial, reduce, wraps
from itertools import islice
from math import ceil

from pyspark.sql import DataFrame, SparkSession, functions as F

from clientlens.operators import deltas
from clientlens.operators.aggregates import BY_ENTITY
from clientlens.operators.cleaning import clean, to_cleaned
from clientlens.operators.dedup import dedup_entity
from clientlens.operators.maintenance import replace_latest, sum_merge
from clientlens.operators.offers import TEMPLATES, expand_offers, offers_with_ids
from clientlens.operators.quality import split_quality
from clientlens.operators.segmentation import combine_segments, segment_clients
from clientlens.plans import pipeline, reports
from clientlens.schemas import DEDUPLICATED, ENTITIES, MARTS, Entity
from clientlens.sources import buckets, catalog, envelope, files, layers as io, swap
from clientlens.streaming.ingest import start_ingest, stream_files
from clientlens.workspace import CODEC, run_settings, scratch_path

from . import feeds
from .adapters import ADAPTERS, spark_entities, spark_entity, tables_of

Query = Callable[[SparkSession, str], DataFrame]

# Fixed dates, so that results do not depend on the day of the run.
AS_OF = "2024-06-30"
EARLIER = "2024-06-29"
AT = "2024-06-30 12:00:00"
AT_EARLIER = "2024-06-29 12:00:00"
AT_NEXT_MONTH = "2024-07-01 12:00:00"


def side_by_side(job, items) -> list:
    """Run one independent Spark job per item from its own thread."""
    with ThreadPoolExecutor(max_workers=8) as pool:
        return list(pool.map(job, items))


def plain(df: DataFrame) -> DataFrame:
    """Decimals as doubles, for comparison with another engine."""
    return df.select(
        *[
            F.col(f.name).cast("double").alias(f.name) if f.dataType.typeName() == "decimal" else F.col(f.name)
            for f in df.schema.fields
        ]
    )


def base(spark: SparkSession, sf: str) -> dict[str, DataFrame]:
    return spark_entities(spark, sf, *ADAPTERS)


def segmented(spark: SparkSession, sf: str) -> DataFrame:
    return segment_clients(spark_entities(spark, sf, "clients", *BY_ENTITY), AS_OF, AT)


def combined(spark: SparkSession, sf: str) -> DataFrame:
    return combine_segments(segmented(spark, sf))


def staged_rows(df: DataFrame, label: str) -> DataFrame:
    path = scratch_path(df.sparkSession, label)
    df.write.option("compression", CODEC).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def client_mart(spark: SparkSession, sf: str, at: str = AT) -> DataFrame:
    rows = combined(spark, sf).withColumn("last_updated", F.lit(at).cast("timestamp"))
    return io.to_mart(rows, MARTS["marketing_clients"])


def offers(spark: SparkSession, sf: str) -> DataFrame:
    return expand_offers(combined(spark, sf))


# --- one entity at a time ---------------------------------------------------


def clean_one(entity: Entity, spark: SparkSession, sf: str) -> DataFrame:
    return clean(feeds.dirty(spark_entity(spark, sf, entity.name), entity), entity)


def dedup_one(entity: Entity, spark: SparkSession, sf: str) -> DataFrame:
    return dedup_entity(feeds.replayed(spark_entity(spark, sf, entity.name), entity), entity)


def json_one(entity: Entity, spark: SparkSession, sf: str) -> DataFrame:
    messages = envelope.to_envelope(spark_entity(spark, sf, entity.name), entity.topic)
    return envelope.read_messages(messages, entity)[0]


def csv_one(entity: Entity, spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_path(spark, f"csv-{entity.name}")
    rows = spark_entity(spark, sf, entity.name)
    rows.write.options(**files.CSV).option("timestampFormat", "yyyy-MM-dd HH:mm:ss.SSSSSS").csv(path)
    return files.read_file(spark, path, entity)


def csv_quoted(spark: SparkSession, sf: str) -> DataFrame:
    """Clients with quotes, separators and line breaks in their names."""
    path, entity = scratch_path(spark, "csv-quoted"), ENTITIES["clients"]
    name = F.concat("client_name", F.lit(' "Jr", of\n"x'))
    spark_entity(spark, sf, "clients").withColumn("client_name", name).write.options(**files.CSV).csv(path)
    return files.read_file(spark, path, entity, multi_line=True)


def parquet_scan(spark: SparkSession, sf: str) -> DataFrame:
    path = f"{scratch_path(spark, 'scan')}.parquet"
    spark_entity(spark, sf, "clients").write.parquet(path)
    return files.read_file(spark, path, ENTITIES["clients"])


def quality_one(entity: Entity, spark: SparkSession, sf: str) -> DataFrame:
    valid, broken = split_quality(feeds.faulty(spark_entity(spark, sf, entity.name), entity), entity)
    return valid.withColumn("violations", F.lit("")).unionByName(broken)


def aggregate_one(name: str, spark: SparkSession, sf: str) -> DataFrame:
    return BY_ENTITY[name](feeds.finer_and_larger(spark_entity(spark, sf, name), ENTITIES[name]))


# Bytes of a table that a task of its own reads at the least (Spark's cost of opening a file).
SPLIT_BYTES = 4 << 20


def stored_bytes(spark: SparkSession, sf: str, *names: str) -> int:
    """Size of the tables that some entities are read from."""
    return sum(swap.size(spark, f"{sf}/{t}.parquet") for t in {t for n in names for t in tables_of(n)})


# --- sources and sinks ------------------------------------------------------


def write_messages(
    spark: SparkSession, sf: str, names=tuple(ENTITIES), feed=None, path: str | None = None, rows_of=None
) -> str:
    """All entities as file-based topics in one folder, a new one if none is given; `rows_of` has their rows where they are at hand."""
    path = path or scratch_path(spark, "messages")

    def write(name: str) -> None:
        rows = rows_of[name] if rows_of else spark_entity(spark, sf, name)
        if feed is not None:
            rows = feed(rows, ENTITIES[name])
        # Large tables are read in that many tasks as they are.
        tasks = spark.sparkContext.defaultParallelism
        spread = tasks if stored_bytes(spark, sf, name) < tasks * SPLIT_BYTES else None
        envelope.write_envelope(rows, path, ENTITIES[name].topic, AT, spread)

    side_by_side(write, names)
    return path


def topic_routing(spark: SparkSession, sf: str) -> DataFrame:
    """Known topics and an unknown one in a common folder of messages."""
    path = write_messages(spark, sf)
    envelope.write_envelope(spark_entity(spark, sf, "clients"), path, "other_topic", AT)
    return envelope.topic_report(envelope.read_envelope(spark, path))


def unreadable_messages(spark: SparkSession, sf: str) -> DataFrame:
    """Every transaction as a good message and once more as text that is not JSON."""
    entity = ENTITIES["bank_transactions"]
    rows = spark_entity(spark, sf, entity.name)
    good = envelope.to_messages(rows, entity.topic)
    bad = rows.select(
        F.lit(entity.topic).alias("topic"), F.concat(F.lit("not json "), F.col(entity.key)).alias("value")
    )
    read, unreadable = envelope.read_messages(good.unionByName(bad), entity)
    return read.select(F.lit("read").alias("status"), F.col(entity.key).alias("content")).unionByName(
        unreadable.select(F.lit("unreadable").alias("status"), F.col("raw_value").alias("content"))
    )


# Field of an entity, and the text that stands in its place in a message of the wrong type.
MISTYPED = {
    "clients": ("birth_date", '"soon"'),
    "bank_transactions": ("amount", '"12,50"'),
    "client_logins": ("success", '"yes"'),
    "client_activities": ("page_views", "3.5"),
    "payments": ("amount", '{"rub": 1}'),
    "portfolios": ("quantity", "[1,2]"),
    "currency_rates": ("rate_value", "true"),
}


def json_type_violations(spark: SparkSession, sf: str) -> DataFrame:
    """Every record as a good message and once more with one field of the wrong type: what is kept of each."""

    def read(entity: Entity) -> DataFrame:
        field, text = MISTYPED[entity.name]
        good = envelope.to_messages(spark_entity(spark, sf, entity.name), entity.topic)
        rest = envelope.to_messages(spark_entity(spark, sf, entity.name).drop(field), entity.topic)
        bad = rest.withColumn("value", F.concat(F.lit(f'{{"{field}": {text},'), F.col("value").substr(F.lit(2), F.length("value"))))
        checked, _ = envelope.read_messages(good.unionByName(bad), entity, together=True)
        key = F.when(F.expr(envelope.IS_REJECTED), F.get_json_object("raw_value", f"$.{entity.key}")).otherwise(F.col(entity.key))
        return checked.select(F.lit(entity.name).alias("entity"), key.alias("record"), "violations")

    return reduce(DataFrame.unionByName, [read(e) for e in ENTITIES.values()])


def ingest_one_pass(spark: SparkSession, sf: str) -> DataFrame:
    """Ingest and cleaning of messages that are other ones at each reading: rows kept and set aside add up to those read.

    A third of the messages, drawn anew whenever they are read, is not JSON; a half of the rest breaks a contract.
    """
    layers = io.Layers(scratch_path(spark, "one-pass"))
    path = write_messages(spark, sf, feed=feeds.faulty)

    def changing(entity: Entity) -> DataFrame:
        lost = F.rand() < 1 / 3
        messages = envelope.read_envelope(spark, path, entity.topic)
        return messages.withColumn("value", F.when(lost, F.lit(b"not json")).otherwise(F.col("value")))

    lines = [*pipeline.ingest(spark, changing, layers, AS_OF, at=AT), *pipeline.clean_layer(spark, layers, AS_OF)]
    if any(line.error for line in lines):
        raise RuntimeError(f"ingest failed: {lines}")

    def counted(entity: Entity) -> DataFrame:
        day = F.col("processing_date") == F.lit(AS_OF).cast("date")
        sides = {
            "raw": io.read_raw(spark, layers.raw(entity, AS_OF), entity),
            "unreadable": spark.read.parquet(layers.unreadable(entity, AS_OF)),
            "cleaned": io.read_cleaned(spark, layers.cleaned(entity), entity).where(day),
            "quarantine": spark.read.parquet(layers.quarantine(entity)).where(day),
        }
        sizes = [rows.agg(F.count("*").alias("n")).select(F.lit(side).alias("side"), "n") for side, rows in sides.items()]
        found = reduce(DataFrame.unionByName, sizes).agg(*[F.max(F.when(F.col("side") == side, F.col("n"))).alias(side) for side in sides])
        said = {line.table: line for line in lines if line.table == entity.raw_table}[entity.raw_table]
        return found.select(
            F.lit(entity.name).alias("entity"),
            (F.col("raw") + F.col("unreadable")).alias("messages"),
            ((F.col("raw") == said.rows) & (F.col("unreadable") == said.rejected)).alias("as_reported"),
            (F.col("cleaned") + F.col("quarantine") == F.col("raw")).alias("nothing_lost"),
        )

    return reduce(DataFrame.unionByName, [counted(e) for e in ENTITIES.values()])


def bounded_offsets(spark: SparkSession, sf: str) -> DataFrame:
    """Payments that two runs read, when more arrive after the first run's offsets were fixed; the first is read twice."""
    entity, layers = ENTITIES["payments"], io.Layers(scratch_path(spark, "bounded"))
    path = write_messages(spark, sf, [entity.name])

    def run(name: str) -> DataFrame:
        # Listed anew, as a run that is started again does.
        read = pipeline.fixed_messages(spark, layers, lambda e: envelope.read_envelope(spark, path, e.topic), name, go_on=True)
        return envelope.read_messages(read(entity), entity)[0].select(F.lit(name).alias("run"), entity.key)

    run("2024-06-29")
    late = spark_entity(spark, sf, entity.name).withColumn(entity.key, F.concat(F.lit("L"), F.col(entity.key)))
    envelope.write_envelope(late, path, entity.topic, AT, 3)
    return run("2024-06-29").unionByName(run("2024-06-30"))


def send_metrics(spark: SparkSession, sf: str) -> DataFrame:
    parts = [
        envelope.send_report(feeds.faulty(spark_entity(spark, sf, e.name), e), e).drop("records_per_second")
        for e in ENTITIES.values()
    ]
    return reduce(DataFrame.unionByName, parts)


def layered_write(spark: SparkSession, sf: str) -> DataFrame:
    """Raw and cleaned writes of two dates, the second one twice; rows found per date."""
    layers = io.Layers(scratch_path(spark, "layers"))

    def write(entity: Entity) -> DataFrame:
        rows = feeds.dirty(staged_rows(spark_entity(spark, sf, entity.name), f"base-{entity.name}"), entity)
        for day in (EARLIER, AS_OF, AS_OF):
            io.write_raw(envelope.with_lineage(rows, day, AT), layers.raw(entity, day))
            raw = io.read_raw(spark, layers.raw(entity, day), entity)
            io.write_cleaned(to_cleaned(raw, entity, day), layers.cleaned(entity), day)
        return (
            io.read_cleaned(spark, layers.cleaned(entity), entity)
            .groupBy("processing_date")
            .agg(F.count("*").alias("row_count"))
            .select(F.lit(entity.structured_table).alias("table_name"), "processing_date", "row_count")
        )

    return reduce(DataFrame.unionByName, side_by_side(write, ENTITIES.values()))


def external_tables(spark: SparkSession, sf: str) -> DataFrame:
    """Cleaned layers seen through session views, counted per table."""
    layers = io.Layers(scratch_path(spark, "external"))

    def write(entity: Entity) -> None:
        rows = to_cleaned(spark_entity(spark, sf, entity.name), entity, AS_OF)
        io.write_cleaned(rows, layers.cleaned(entity), AS_OF)

    side_by_side(write, ENTITIES.values())
    catalog.create_views(spark, layers)
    return reports.table_counts({e.name: spark.table(f"ext_{e.structured_table}") for e in ENTITIES.values()})


def full_refresh(spark: SparkSession, sf: str) -> DataFrame:
    """A local table replaced twice by the deduplicated rows; the second load leaves no trace."""
    entity = ENTITIES["clients"]
    path = io.Layers(scratch_path(spark, "refresh")).structured(entity)
    for _ in range(2):
        io.write_full_refresh(dedup_one(entity, spark, sf), path)
    return io.read_structured(spark, path, entity)


def stream_ingest(spark: SparkSession, sf: str) -> DataFrame:
    entity = ENTITIES["bank_transactions"]
    path = write_messages(spark, sf, [entity.name])
    root = scratch_path(spark, "stream")
    query = start_ingest(
        stream_files(spark, path, entity.topic), entity, f"{root}/rows", f"{root}/checkpoint", AS_OF
    )
    query.awaitTermination()
    return io.read_raw(spark, f"{root}/rows", entity).select(*entity.columns)


# --- segmentation and offers ------------------------------------------------


def history(spark: SparkSession, sf: str, *days: str) -> str:
    """Folder of a segmentation table with the given dates."""
    path = io.Layers(scratch_path(spark, "history")).segmentation
    dates = F.array(*[F.lit(day).cast("date") for day in days])
    io.write_segmentation(segmented(spark, sf).withColumn("processing_date", F.explode(dates)), path)
    return path


def snapshot(spark: SparkSession, sf: str) -> DataFrame:
    """Two dates of the segmentation table on disk; the newest one is read back."""
    return io.read_snapshot(spark, history(spark, sf, EARLIER, AS_OF))


def snapshot_by_run(spark: SparkSession, sf: str) -> DataFrame:
    """Clients per segment of the runs that are final; their dates, found while the query runs, decide what is read."""
    path, runs = history(spark, sf, "2024-06-28", EARLIER, AS_OF), scratch_path(spark, "runs")
    said = f"('first', DATE '2024-06-28', 'draft'), ('second', DATE '{EARLIER}', 'final'), ('third', DATE '{AS_OF}', 'draft')"
    spark.sql(f"SELECT * FROM VALUES {said} AS runs(run, processing_date, state)").write.parquet(runs)
    final = spark.read.parquet(runs).where("state = 'final'")
    found = io.of_runs(io.read_segmentation(spark, path), final)
    return found.groupBy("run", "processing_date", "segment").agg(F.count("*").alias("clients"))


# Filter on the segmentation -> a value of it.
ACCESS = {"segment": "VIP", "city": "FRANCE", "status": "Inactive"}


def clustered_reads(spark: SparkSession, sf: str) -> DataFrame:
    """Clients found by segment, by city and by status in a segmentation whose files are narrow in all three."""
    path = io.Layers(scratch_path(spark, "clustered")).segmentation
    io.write_clustered(segmented(spark, sf), path, AS_OF, files=8)
    rows = io.read_segmentation(spark, path)
    parts = [
        rows.where(F.col(c) == value).agg(F.count("*").alias("clients")).select(F.lit(c).alias("filter"), "clients")
        for c, value in ACCESS.items()
    ]
    return reduce(DataFrame.unionByName, parts)


# Bytes of all tables for each bucket: a task writes and reads whole buckets, so their number follows the tables.
BUCKET_BYTES = 16 << 20


def co_located(spark: SparkSession, sf: str, salts: int = 1) -> dict[str, DataFrame]:
    """Clients and facts as managed tables, bucketed by client."""
    mark = uuid.uuid4().hex
    names = ("clients", *BY_ENTITY)
    buckets = max(8, ceil(stored_bytes(spark, sf, *names) / BUCKET_BYTES))

    def save(name: str) -> str:
        table, rows = f"b_{name}_{mark}", spark_entity(spark, sf, name)
        if name == "clients" or salts == 1:
            catalog.save_co_located(rows, table, ["client_id"], buckets)
        else:
            catalog.save_co_located(catalog.salted(rows, ENTITIES[name].key, salts), table, ["client_id", "salt"], buckets)
        return table

    return dict(zip(names, map(spark.table, side_by_side(save, names))))


def bucketed_segmentation(spark: SparkSession, sf: str) -> DataFrame:
    """Segments from tables bucketed by client: aggregated and joined where they lie."""
    return segment_clients(co_located(spark, sf), AS_OF, AT)


def bucketed_segmentation_salted(spark: SparkSession, sf: str) -> DataFrame:
    """Segments from facts whose clients are spread over four buckets each, so that no client fills one."""
    return segment_clients(co_located(spark, sf, salts=4), AS_OF, AT)


# Join or filter whose rows are estimated -> SQL over the analysed tables.
ESTIMATED = {
    "clients": "SELECT * FROM {clients}",
    "transactions": "SELECT * FROM {bank_transactions}",
    "older clients": "SELECT * FROM {clients} WHERE registration_date < DATE '2022-06-19'",
    "small transactions": "SELECT * FROM {bank_transactions} WHERE amount < 6000",
    "transactions of clients": "SELECT t.* FROM {clients} c JOIN {bank_transactions} t ON c.client_id = t.client_id",
}


def statistics_plan(spark: SparkSession, sf: str) -> DataFrame:
    """Rows that the cost-based optimizer expects of analysed tables, and whether they are within a fifth of the real ones."""
    mark = uuid.uuid4().hex
    names = {n: f"s_{n}_{mark}" for n in ("clients", "bank_transactions")}
    for name, table in names.items():
        spark_entity(spark, sf, name).write.saveAsTable(table)
        catalog.analyze(spark, table, histograms=True)
    parts = []
    for step, sql in ESTIMATED.items():
        rows = spark.sql(sql.format(**names))
        expected = catalog.expected_rows(rows)
        real = F.count("*")
        near = F.abs(F.lit(expected) - real) <= F.greatest(0.2 * real, F.lit(2))
        parts.append(rows.agg(real.alias("row_count"), near.alias("near")).select(F.lit(step).alias("step"), "row_count", "near"))
    return reduce(DataFrame.unionByName, parts)


def offer_ids(spark: SparkSession, sf: str) -> DataFrame:
    return offers_with_ids(combined(spark, sf)).select("client_id", "offer_type", "offer_id")


# Templates in unequal numbers: one of the passive segments, all of the others.
UNEVEN = tuple(t for t in TEMPLATES if t.position == 1 or "Passive" not in t.combined_segment)


def offer_ids_uneven(spark: SparkSession, sf: str) -> DataFrame:
    return offers_with_ids(combined(spark, sf), UNEVEN).select("client_id", "offer_type", "offer_id")


def offer_mart(spark: SparkSession, sf: str) -> DataFrame:
    """The offer mart as it is read back after the load; loading the date again replaces it."""
    mart = MARTS["targeted_offers"]
    path = io.Layers(scratch_path(spark, "offers")).mart(mart)
    rows = offers_with_ids(combined(spark, sf)).withColumn("created_at", F.lit(AT).cast("timestamp"))
    for _ in range(2):
        io.write_mart(rows, path, mart, AS_OF)
    return plain(io.read_mart(spark, path, mart))


def client_mart_load(spark: SparkSession, sf: str) -> DataFrame:
    mart = MARTS["marketing_clients"]
    path = io.Layers(scratch_path(spark, "clients")).mart(mart)
    io.write_mart(client_mart(spark, sf), path, mart, AS_OF)
    return plain(io.read_mart(spark, path, mart))


# --- maintenance ------------------------------------------------------------


def client_runs(spark: SparkSession, sf: str) -> DataFrame:
    """Client mart rows of three runs, two of them in one month; the clients are computed once."""
    runs = [F.struct(F.lit(n).alias("n"), F.lit(at).cast("timestamp").alias("at")) for n, at in enumerate((AT_EARLIER, AT, AT_NEXT_MONTH))]
    rows = client_mart(spark, sf)
    return rows.select("*", F.inline(F.array(*runs))).select(
        *[
            F.col("at").alias(c) if c == "last_updated" else (F.col(c) + F.col("n")).alias(c) if c == "activity_score" else F.col(c)
            for c in rows.columns
        ]
    )


def replaced(spark: SparkSession, sf: str) -> DataFrame:
    return plain(replace_latest(client_runs(spark, sf), MARTS["marketing_clients"]))


def daily_runs(spark: SparkSession, sf: str) -> DataFrame:
    """Daily figures of two runs of one date."""
    mart = MARTS["marketing_analytics_daily"]
    daily = io.to_mart(reports.daily_segment_metrics(client_mart(spark, sf), AS_OF, AT), mart)
    runs = F.array(*[F.lit(at).cast("timestamp") for at in (AT, AT_NEXT_MONTH)])
    return daily.withColumn("created_at", F.explode(runs))


def summed(spark: SparkSession, sf: str) -> DataFrame:
    return plain(sum_merge(daily_runs(spark, sf), MARTS["marketing_analytics_daily"]))


def compact_interrupted(spark: SparkSession, sf: str) -> DataFrame:
    """Compaction of a month stopped before its journal and after each step of the change; then another date of the
    month is loaded, then the month is compacted. Rows and scores that a reader finds at each point."""
    mart, runs = MARTS["marketing_clients"], client_mart(spark, sf)
    runs = staged_rows(runs, "client-run")

    def run(day: str, more: int) -> DataFrame:
        at = F.lit(f"{day} 12:00:00").cast("timestamp")
        return runs.withColumns({"last_updated": at, "activity_score": F.col("activity_score") + more})

    def stopped(stop: int) -> list[DataFrame]:
        layers = io.Layers(scratch_path(spark, f"stop{stop}"))
        path = layers.mart(mart)

        def seen(point: str) -> DataFrame:
            rows = io.read_mart(spark, path, mart).groupBy("run_date")
            found = rows.agg(F.count("*").alias("row_count"), F.sum("activity_score").alias("score"))
            # Kept as it is now: the folders change afterwards.
            return staged_rows(found.select(F.lit(stop).alias("stop"), F.lit(point).alias("point"), "*"), "seen")

        for day, more in ((EARLIER, 0), (AS_OF, 1)):
            io.write_mart(run(day, more), path, mart, day)
        change, _ = io.prepare_month(pipeline.compacted_month(spark, layers, mart, 202406), path, 202406)
        if stop >= 0:
            swap.commit(spark, change, ["yyyymm=202406"])
        for _ in islice(swap.steps(spark, path), max(stop, 0)):
            pass
        found = [seen("stopped")]
        io.write_mart(run("2024-06-28", 2), path, mart, "2024-06-28")
        found.append(seen("loaded"))
        pipeline.compact(spark, layers, mart, 202406)
        return [*found, seen("compacted")]

    return reduce(DataFrame.unionByName, [df for parts in side_by_side(stopped, range(-1, 4)) for df in parts])


def compacted(spark: SparkSession, sf: str) -> DataFrame:
    """Client mart with two runs in June and one in July, June compacted in place."""
    mart = MARTS["marketing_clients"]
    layers = io.Layers(scratch_path(spark, "compact"))
    runs = staged_rows(client_runs(spark, sf), "client-runs")
    for at in (AT_EARLIER, AT, AT_NEXT_MONTH):
        run = runs.where(F.col("last_updated") == F.lit(at).cast("timestamp"))
        io.write_mart(run, layers.mart(mart), mart, at[:10])
    pipeline.compact(spark, layers, mart, 202406)
    return plain(io.read_mart(spark, layers.mart(mart), mart))


# --- end to end -------------------------------------------------------------


def arriving(rows: DataFrame, entity: Entity) -> DataFrame:
    """Untidy, replayed rows: what the run has to bring back to the base."""
    rows = feeds.replayed(rows, entity) if entity.newest_by else rows
    return feeds.dirty(rows, entity)


def run(spark: SparkSession, sf: str) -> tuple[list[pipeline.Loaded], io.Layers]:
    path = write_messages(spark, sf, feed=arriving)
    root = scratch_path(spark, "run")
    lines = pipeline.run_pipeline(
        spark, lambda e: envelope.read_envelope(spark, path, e.topic), root, AS_OF, AT
    )
    failed = [line for line in lines if line.error]
    if failed:
        raise RuntimeError(f"run failed: {failed}")
    return lines, io.Layers(root)


def run_offers(spark: SparkSession, sf: str) -> DataFrame:
    _, layers = run(spark, sf)
    mart = MARTS["targeted_offers"]
    return plain(io.read_mart(spark, layers.mart(mart), mart))


def _rows_by_layer(spark: SparkSession, layers: io.Layers) -> DataFrame:
    """Rows of every structured table, and of the dates of payments, segmentation and client mart."""
    mart = MARTS["marketing_clients"]
    payments = ENTITIES["payments"]
    dates = {
        "cleaned payments": io.read_cleaned(spark, layers.cleaned(payments), payments).withColumnRenamed("processing_date", "day"),
        "segmentation": io.read_segmentation(spark, layers.segmentation).withColumnRenamed("processing_date", "day"),
        "client mart": io.read_mart(spark, layers.mart(mart), mart).withColumnRenamed("run_date", "day"),
    }
    parts = [
        io.read_structured(spark, layers.structured(e), e)
        .agg(F.count("*").alias("row_count"))
        .select(F.lit(e.structured_table).alias("layer"), F.lit(None).cast("date").alias("day"), "row_count")
        for e in DEDUPLICATED
    ]
    parts += [
        rows.groupBy("day").agg(F.count("*").alias("row_count")).select(F.lit(name).alias("layer"), "day", "row_count")
        for name, rows in dates.items()
    ]
    return reduce(DataFrame.unionByName, parts)


def run_one_topic(spark: SparkSession, sf: str) -> DataFrame:
    """A run over all topics, then one over payments only on the next date."""
    path, root = write_messages(spark, sf), scratch_path(spark, "one-topic")

    def read(entity: Entity) -> DataFrame:
        return envelope.read_envelope(spark, path, entity.topic)

    pipeline.run_pipeline(spark, read, root, EARLIER, f"{EARLIER} 12:00:00")
    pipeline.run_pipeline(spark, read, root, AS_OF, AT, entities=[ENTITIES["payments"]])
    return _rows_by_layer(spark, io.Layers(root))


def rerun_replaces(spark: SparkSession, sf: str) -> DataFrame:
    """Two dates; the second one is run again when payments and clients have lost all their rows."""
    path, root = write_messages(spark, sf), scratch_path(spark, "rerun")

    def read(entity: Entity) -> DataFrame:
        return envelope.read_envelope(spark, path, entity.topic)

    def emptied(entity: Entity) -> DataFrame:
        gone = entity.name in ("payments", "clients")
        return read(entity).where(F.lit(not gone))

    pipeline.run_pipeline(spark, read, root, EARLIER, f"{EARLIER} 12:00:00")
    pipeline.run_pipeline(spark, read, root, AS_OF, AT)
    pipeline.run_pipeline(spark, emptied, root, AS_OF, AT)
    return _rows_by_layer(spark, io.Layers(root))


def incremental_run(spark: SparkSession, sf: str) -> DataFrame:
    """Offer mart after two arrivals: plain rows on the first date, replayed and untidy ones on the second."""
    base = dict(zip(ENTITIES, side_by_side(lambda name: staged_rows(spark_entity(spark, sf, name), f"base-{name}"), ENTITIES)))
    path, root = write_messages(spark, sf, rows_of=base), scratch_path(spark, "increments")

    def stream(entity: Entity) -> DataFrame:
        return stream_files(spark, path, entity.topic)

    lines = pipeline.run_incremental(spark, stream, root, EARLIER, AT_EARLIER)
    write_messages(spark, sf, feed=arriving, path=path, rows_of=base)
    lines += pipeline.run_incremental(spark, stream, root, AS_OF, AT)
    failed = [line for line in lines if line.error]
    if failed:
        raise RuntimeError(f"run failed: {failed}")
    mart = MARTS["targeted_offers"]
    return plain(io.read_mart(spark, io.Layers(root).mart(mart), mart).where(F.col("run_date") == F.lit(AS_OF).cast("date")))


def merged(entity: Entity, spark: SparkSession, sf: str) -> str:
    """Folder of a structured table after three arrivals, the second of them merged twice."""
    path = io.Layers(scratch_path(spark, f"merge-{entity.name}")).structured(entity)
    first, second, third = feeds.arrivals(staged_rows(spark_entity(spark, sf, entity.name), f"base-{entity.name}"), entity)
    for day, rows in (("2024-06-28", first), (EARLIER, second), (EARLIER, second), (AS_OF, third)):
        buckets.merge_newest(spark, path, rows, entity, day, buckets=4)
    return path


def merge_one(entity: Entity, spark: SparkSession, sf: str) -> DataFrame:
    return io.read_structured(spark, merged(entity, spark, sf), entity)


def aggregate_deltas(spark: SparkSession, sf: str) -> DataFrame:
    """Aggregates of all facts, kept up over three arrivals by what came and went; one row per client and measure."""

    def kept_up(entity: Entity) -> DataFrame:
        layers = io.Layers(scratch_path(spark, f"deltas-{entity.name}"))
        table, partials = layers.structured(entity), layers.partials(entity)
        base = staged_rows(spark_entity(spark, sf, entity.name), f"base-{entity.name}")
        for day, rows in zip(("2024-06-28", EARLIER, AS_OF), feeds.arrivals(base, entity)):
            buckets.merge_newest(spark, table, rows, entity, day, buckets=4)
            buckets.update_partials(spark, table, partials, entity, buckets=4)
        found = deltas.by_client(buckets.read_partials(spark, partials, entity), entity)
        named = [F.struct(F.lit(c).alias("measure"), F.col(c).cast("double").alias("value")) for c in found.columns[1:]]
        return found.select("client_id", F.inline(F.array(*named)))

    return reduce(DataFrame.unionByName, side_by_side(kept_up, deltas.FACTS))


# Report -> its key columns, its count and its total.
REPORT_COLUMNS = {
    "segmentation_report": (["metric"], "value", None),
    "segment_drift": (["comparison"], "clients", None),
    "segment_summary": (["combined_segment"], "clients_count", "total_value"),
    "offers_by_type_segment": (["offer_type", "combined_segment"], "offers_count", "total_expected_revenue"),
    "top_clients": (["client_id"], "offers_count", "total_expected_revenue"),
    "priority_grid": (["priority_level", "offer_priority"], "offers_count", "total_revenue"),
    "top_offer_types": (["offer_type"], "offers_count", "total_expected_revenue"),
}


def stored_reports(spark: SparkSession, sf: str) -> DataFrame:
    """All reports of a date, made from its stored segmentation and read back."""
    layers = io.Layers(scratch_path(spark, "reports"))
    io.write_segmentation(segmented(spark, sf), layers.segmentation, AS_OF)
    failed = [line for line in pipeline.report_layer(spark, layers, AS_OF) if line.error]
    if failed:
        raise RuntimeError(f"reports failed: {failed}")
    parts = [
        spark.read.parquet(layers.report(name, AS_OF)).select(
            F.lit(name).alias("report"),
            F.concat_ws("|", *[F.col(k).cast("string") for k in keys]).alias("key"),
            F.col(count).cast("bigint").alias("row_count"),
            (F.col(total) if total else F.lit(None)).cast("double").alias("total"),
        )
        for name, (keys, count, total) in REPORT_COLUMNS.items()
    ]
    return reduce(DataFrame.unionByName, parts)


def catalog_partitions(spark: SparkSession, sf: str) -> DataFrame:
    """Cleaned layers as catalog tables: registered on the first date, the second one recovered later."""
    layers, mark = io.Layers(scratch_path(spark, "catalog")), uuid.uuid4().hex

    def write(entity: Entity) -> DataFrame:
        name = f"ext_{entity.structured_table}_{mark}"
        for day in (EARLIER, AS_OF):
            rows = to_cleaned(spark_entity(spark, sf, entity.name), entity, day)
            io.write_cleaned(rows, layers.cleaned(entity), day)
            if day == EARLIER:
                catalog.register_cleaned(spark, layers, entity, name)
        catalog.recover_partitions(spark, name)
        found = spark.table(name).groupBy("processing_date").agg(F.count("*").alias("row_count"))
        return found.select(F.lit(entity.structured_table).alias("table_name"), "processing_date", "row_count")

    return reduce(DataFrame.unionByName, [write(e) for e in ENTITIES.values()])


def mart_tables(spark: SparkSession, sf: str) -> DataFrame:
    """The catalog tables of all marts after a load of clients and daily figures; rows by table and month."""
    layers, prefix = io.Layers(scratch_path(spark, "mart-tables")), f"m{uuid.uuid4().hex}_"
    rows = client_mart(spark, sf)
    io.write_mart(rows, layers.mart(MARTS["marketing_clients"]), MARTS["marketing_clients"], AS_OF)
    daily = MARTS["marketing_analytics_daily"]
    io.write_mart(reports.daily_segment_metrics(rows, AS_OF, AT), layers.mart(daily), daily, AS_OF)
    parts = []
    for name in catalog.create_mart_tables(spark, layers, prefix):
        found = spark.table(name).groupBy("yyyymm").agg(F.count("*").alias("row_count"))
        parts.append(found.select(F.lit(name.removeprefix(prefix)).alias("table_name"), "yyyymm", "row_count"))
    return reduce(DataFrame.unionByName, parts)


def table_statistics(spark: SparkSession, sf: str) -> DataFrame:
    """Row counts that the optimizer has of structured tables after they were analysed."""
    layers, mark = io.Layers(scratch_path(spark, "statistics")), uuid.uuid4().hex
    parts = []
    for entity in ENTITIES.values():
        name = f"st_{entity.structured_table}_{mark}"
        io.write_full_refresh(spark_entity(spark, sf, entity.name).select(*entity.columns), layers.structured(entity))
        catalog.create_external_table(spark, name, entity.ddl, layers.structured(entity))
        catalog.analyze(spark, name)
        said = spark.sql(f"DESCRIBE EXTENDED {name}").where("col_name = 'Statistics'")
        rows = F.regexp_extract("data_type", r"(\d+) rows", 1).cast("bigint")
        parts.append(said.select(F.lit(entity.label).alias("table_name"), rows.alias("row_count")))
    return reduce(DataFrame.unionByName, parts)


def campaigns(spark: SparkSession, sf: str) -> DataFrame:
    """Campaign results: one campaign per segment and city, in an older and a newer version."""
    measured = combined(spark, sf).groupBy("combined_segment", "priority_level").agg(F.count("*").alias("n"))
    version = F.explode(F.array(F.lit(AT_EARLIER), F.lit(AT))).alias("created_at")
    rows = measured.select("*", version).select(
        F.concat(F.lit("C"), F.col("priority_level").cast("string"), F.lit("-"), F.col("combined_segment")).alias("campaign_id"),
        F.lit("summer").alias("campaign_name"),
        F.col("combined_segment").alias("target_segment"),
        F.lit("2024-06-01").alias("start_date"),
        F.lit(AS_OF).alias("end_date"),
        F.col("n").alias("total_clients"),
        F.when(F.col("created_at") == AT, F.col("n")).otherwise(0).alias("response_count"),
        F.lit(1.0).alias("response_rate"),
        F.lit(0).alias("revenue_generated"),
        F.lit(0.0).alias("roi"),
        "created_at",
    )
    mart = MARTS["marketing_campaign_results"]
    return plain(replace_latest(io.to_mart(rows, mart), mart)).drop("response_rate", "roi")


def run_report(spark: SparkSession, sf: str) -> DataFrame:
    lines, _ = run(spark, sf)
    return pipeline.load_report(spark, lines).drop("seconds", "error")


def _utc(query: Query) -> Query:
    @wraps(query)
    def runs(spark: SparkSession, sf: str) -> DataFrame:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
        with run_settings(spark):
            return query(spark, sf)

    return runs


def all_queries() -> dict[str, Query]:
    found: dict[str, Query] = {}
    for e in ENTITIES.values():
        found[f"clean_{e.name}"] = partial(clean_one, e)
        found[f"json_round_trip_{e.name}"] = partial(json_one, e)
        found[f"csv_scan_{e.name}"] = partial(csv_one, e)
        found[f"quality_split_{e.name}"] = partial(quality_one, e)
    for e in DEDUPLICATED:
        found[f"dedup_{e.name}"] = partial(dedup_one, e)
        found[f"incremental_merge_{e.name}"] = partial(merge_one, e)
    for name in BY_ENTITY:
        found[f"agg_{name}"] = partial(aggregate_one, name)
    found |= {
        "csv_quoted_clients": csv_quoted,
        "parquet_scan_clients": parquet_scan,
        "topic_routing": topic_routing,
        "unreadable_messages": unreadable_messages,
        "json_type_violations": json_type_violations,
        "ingest_one_pass": ingest_one_pass,
        "bounded_offsets": bounded_offsets,
        "send_metrics": send_metrics,
        "layered_write": layered_write,
        "external_tables": external_tables,
        "full_refresh": full_refresh,
        "stream_ingest": stream_ingest,
        "client_segmentation": segmented,
        "latest_snapshot": snapshot,
        "snapshot_by_run": snapshot_by_run,
        "clustered_reads": clustered_reads,
        "bucketed_segmentation": bucketed_segmentation,
        "bucketed_segmentation_salted": bucketed_segmentation_salted,
        "statistics_plan": statistics_plan,
        "combined_segments": combined,
        "targeted_offers": offers,
        "offer_ids": offer_ids,
        "offer_ids_uneven": offer_ids_uneven,
        "run_one_topic": run_one_topic,
        "rerun_replaces": rerun_replaces,
        "incremental_run": incremental_run,
        "stored_reports": stored_reports,
        "catalog_partitions": catalog_partitions,
        "mart_tables": mart_tables,
        "table_statistics": table_statistics,
        "campaign_latest": campaigns,
        "client_mart": client_mart_load,
        "offer_mart": offer_mart,
        "segmentation_report": lambda s, d: reports.segmentation_report(segmented(s, d)),
        "segment_drift": lambda s, d: reports.segment_drift(segmented(s, d)),
        "table_counts": lambda s, d: reports.table_counts(base(s, d)),
        "daily_segment_metrics": lambda s, d: plain(
            io.to_mart(
                reports.daily_segment_metrics(client_mart(s, d), AS_OF, AT), MARTS["marketing_analytics_daily"]
            )
        ),
        "segment_summary": lambda s, d: plain(reports.segment_summary(client_mart(s, d))),
        "offers_by_type_segment": lambda s, d: plain(reports.offers_by_type_and_segment(offers(s, d))),
        "top_clients": lambda s, d: plain(reports.top_clients(offers(s, d))),
        "priority_grid": lambda s, d: plain(reports.priority_grid(offers(s, d))),
        "top_offer_types": lambda s, d: plain(reports.top_offer_types(offers(s, d))),
        "replace_latest": replaced,
        "sum_merge": summed,
        "table_compact": compacted,
        "compact_interrupted": compact_interrupted,
        "aggregate_deltas": aggregate_deltas,
        "run_pipeline": run_offers,
        "load_report": run_report,
    }
    return {name: _utc(q) for name, q in found.items()}
