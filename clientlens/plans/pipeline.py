"""The end-to-end run: ingest, clean, dedup, segment, offers, marts, daily analytics."""

from __future__ import annotations

import time
from collections.abc import Callable, Iterable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from datetime import UTC, datetime
from math import ceil

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..operators import deltas
from ..operators.cleaning import to_cleaned
from ..operators.dedup import dedup_entity, key_parts
from ..operators.maintenance import merged
from ..operators.offers import expand_offers, offers_with_ids
from ..operators.quality import flag_broken, violations
from ..operators.segmentation import combine_segments, latest_snapshot, segment_clients
from ..schemas import DEDUPLICATED, ENTITIES, MARTS, Entity, Mart
from ..sources import buckets, layers as io, offsets, swap
from ..sources.envelope import IS_REJECTED, parse_messages, with_lineage, with_violations
from ..sources.files import BROKEN, input_path, read_file
from ..streaming.ingest import start_ingest_halves
from ..workspace import run_settings
from . import reports


@dataclass(frozen=True)
class Loaded:
    """One line of the load report."""

    stage: str
    table: str
    rows: int
    rejected: int
    ok: bool
    seconds: float
    error: str | None = None


LOAD_REPORT_DDL = (
    "stage string, table string, rows bigint, rejected bigint, ok boolean, seconds double, error string"
)


def publish(
    spark: SparkSession,
    folder: str,
    send: Callable[[DataFrame, Entity], None],
    suffix: str = "csv",
    entities: Iterable[Entity] = tuple(ENTITIES.values()),
    aside: str | None = None,
    multi_line: bool = False,
) -> list[Loaded]:
    """Files of a folder -> messages. `send` writes one entity's rows to its topic.

    Lines with a cell that does not parse are not sent but counted as rejected; below the folder
    `aside` their text is kept, in one folder per entity.
    """

    def load(entity: Entity) -> tuple[int, int]:
        rows = read_file(spark, input_path(folder, entity, suffix), entity, multi_line, keep_broken=True)
        bad = F.col(BROKEN).isNotNull()
        watched, seen = io.counted(rows, rejected=F.count_if(bad))
        send(watched.where(~bad).drop(BROKEN), entity)
        metrics = seen.get
        if aside is not None:
            if metrics["rejected"]:
                io.replace_folder(rows.where(bad), f"{aside}/{entity.name}")
            else:
                io.clear(spark, f"{aside}/{entity.name}", f"{entity.ddl}, {BROKEN} string")
        return metrics["rows"] - metrics["rejected"], metrics["rejected"]

    return _each("publish", entities, lambda e: e.topic, load)


def ingest(
    spark: SparkSession,
    messages_of: Callable[[Entity], DataFrame],
    layers: io.Layers,
    processing_date: str,
    entities: Iterable[Entity] = tuple(ENTITIES.values()),
    at: str | None = None,
) -> list[Loaded]:
    """Messages -> typed raw rows, in one pass over the messages.

    Messages that are not JSON, or have a field of the wrong type, are kept aside as text with what is wrong.
    """

    def load(entity: Entity) -> tuple[int, int]:
        checked = with_violations(parse_messages(messages_of(entity), entity), entity)
        rejected = F.expr(IS_REJECTED)
        rows = with_lineage(checked, processing_date, at).withColumns(
            {
                "raw_value": F.when(rejected, F.col("raw_value")),
                "violations": F.when(rejected, F.col("violations")),
                "rejected": rejected,
            }
        )
        kept = layers.raw(entity, processing_date), f"{entity.ddl}, ingestion_timestamp timestamp, processing_date string"
        aside = layers.unreadable(entity, processing_date), "raw_value string, violations string"
        return io.write_halves(rows, "rejected", layers.root, f"ingest-{entity.name}", kept, aside)

    return _each("ingest", entities, lambda e: e.raw_table, load)


def fixed_messages(
    spark: SparkSession,
    layers: io.Layers,
    messages_of: Callable[[Entity], DataFrame],
    run: str,
    go_on: bool = False,
) -> Callable[[Entity], DataFrame]:
    """`messages_of` within offsets that are resolved once for the run and kept with it."""

    def bounded(entity: Entity) -> DataFrame:
        messages = messages_of(entity)
        bounds = offsets.fix(spark, layers.root, entity.topic, run, lambda: offsets.ends(messages), go_on)
        return offsets.within(messages, bounds)

    return bounded


def arrive(
    stream_of: Callable[[Entity], DataFrame],
    layers: io.Layers,
    processing_date: str,
    entities: Iterable[Entity] = tuple(ENTITIES.values()),
) -> list[Loaded]:
    """Messages that came since the last call -> raw rows appended under the date.

    Every message is taken once, also when a call is repeated after a failure. Messages that
    cannot be read are kept aside, in the same pass. No new message is not a failure.
    """

    def take(entity: Entity) -> tuple[int, int]:
        stream = stream_of(entity)
        start_ingest_halves(
            stream, entity, layers.arrivals(entity), layers.arrivals_log(entity), processing_date
        ).awaitTermination()
        halves = [io.read_arrived(stream.sparkSession, layers, entity, processing_date, side) for side in (False, True)]
        return halves[0].count(), halves[1].count()

    return _each("arrive", entities, lambda e: e.raw_table, take)


def clean_layer(
    spark: SparkSession,
    layers: io.Layers,
    processing_date: str,
    entities: Iterable[Entity] = tuple(ENTITIES.values()),
    arrived: bool = False,
) -> list[Loaded]:
    """Raw rows of a date -> cleaned rows of that date; contract breakers go to quarantine, in the same pass.

    With `arrived` the rows are those that the incremental ingest appended on the date.
    """

    def load(entity: Entity) -> tuple[int, int]:
        if arrived:
            raw = io.read_arrived(spark, layers, entity, processing_date)
        else:
            raw = io.read_raw(spark, layers.raw(entity, processing_date), entity)
        flagged = flag_broken(to_cleaned(raw, entity, processing_date), entity).drop("processing_date")
        rows = flagged.withColumn("violations", F.when(F.col("broken"), violations(entity)))
        kept = io.dated(layers.cleaned(entity), processing_date), entity.ddl
        aside = io.dated(layers.quarantine(entity), processing_date), f"{entity.ddl}, violations string"
        return io.write_halves(rows, "broken", layers.root, f"clean-{entity.name}", kept, aside)

    return _each("clean", entities, lambda e: e.structured_table, load)


# Stored bytes that are deduplicated in one job, and the most jobs for a table: what is shuffled at a time follows them.
DEDUP_BYTES = 1 << 30
DEDUP_PARTS = 8


def dedup_layer(
    spark: SparkSession,
    layers: io.Layers,
    processing_date: str | None = None,
    entities: Iterable[Entity] = tuple(DEDUPLICATED),
) -> list[Loaded]:
    """Newest version of every record of one cleaned date, or of all dates.

    A date ingested from the beginning of the topics holds every record, so reading older
    dates again would only repeat it; an entity that was not ingested on the date is taken
    from its newest date before. One without any is an error, and its table stays as it is.
    Leave the date out where each date holds what arrived since the one before, as after the
    incremental ingest. Large tables are worked on in parts, one after the other, so that the disk holds the
    shuffle files of one part.
    """

    def load(entity: Entity) -> tuple[int, int]:
        newest = processing_date and io.newest_date(spark, layers.cleaned(entity), processing_date)
        if processing_date is not None and newest is None:
            raise LookupError(f"{entity.structured_table} has no cleaned date up to {processing_date}")
        cleaned = io.read_cleaned(spark, layers.cleaned(entity), entity)
        if newest is not None:
            cleaned = cleaned.where(F.col("processing_date") == F.lit(newest).cast("date"))
        stored = layers.cleaned(entity) if newest is None else io.dated(layers.cleaned(entity), newest)
        parts = key_parts(cleaned, [entity.key], min(DEDUP_PARTS, ceil(swap.size(spark, stored) / DEDUP_BYTES) or 1))
        return io.write_in_parts([dedup_entity(part, entity) for part in parts], layers.structured(entity)), 0

    return _each("dedup", entities, lambda e: e.structured_table, load)


def merge_layer(
    spark: SparkSession, layers: io.Layers, as_of: str, entities: Iterable[Entity] = tuple(DEDUPLICATED)
) -> list[Loaded]:
    """Newest version of every record, by merging what was cleaned since the last merge into the structured table.

    The newest date merged before is taken again, as more can have arrived on it; so is `as_of`. Only buckets
    with arrivals are read and rewritten.
    """

    def load(entity: Entity) -> tuple[int, int]:
        path = layers.structured(entity)
        if io.newest_date(spark, layers.cleaned(entity), as_of) is None:
            raise LookupError(f"{entity.structured_table} has no cleaned date up to {as_of}")
        state = buckets.state_of(spark, path)
        if state is None and io.folders(spark, path):
            raise ValueError(f"{path} was loaded by a full refresh; increments need a folder of their own")
        cleaned, day = io.read_cleaned(spark, layers.cleaned(entity), entity), F.col("processing_date")
        since = as_of if state is None else min(state.through, as_of)
        pending = cleaned if state is None else cleaned.where((day >= F.lit(since).cast("date")))
        buckets.merge_newest(spark, path, pending, entity, as_of)
        return io.read_structured(spark, path, entity).count(), 0

    return _each("merge", entities, lambda e: e.structured_table, load)


def partials_layer(spark: SparkSession, layers: io.Layers) -> list[Loaded]:
    """Per-client aggregates brought up to the last merge by its changes."""

    def load(entity: Entity) -> tuple[int, int]:
        buckets.update_partials(spark, layers.structured(entity), layers.partials(entity), entity)
        return buckets.read_partials(spark, layers.partials(entity), entity).count(), 0

    return _each("partials", deltas.FACTS, lambda e: e.structured_table, load)


def run_stamp(as_of: str, at: str | None = None) -> str:
    """Timestamp of the rows of a run: on its date, at the present time of day.

    It lies on the run's date also when an older date is run again, so the rows land in
    the month they were in before and replace them.
    """
    return at or f"{as_of} {datetime.now(UTC):%H:%M:%S}"


def segmentation_layer(
    spark: SparkSession, layers: io.Layers, as_of: str, at: str | None = None, from_partials: bool = False
) -> list[Loaded]:
    """Segments of all clients; `from_partials` takes the kept aggregates instead of reading all facts."""
    stamp = run_stamp(as_of, at)

    def load(_) -> tuple[int, int]:
        tables = {e.name: io.read_structured(spark, layers.structured(e), e) for e in DEDUPLICATED}
        made = {}
        if from_partials:
            made = {e.name: deltas.by_client(buckets.read_partials(spark, layers.partials(e), e), e) for e in deltas.FACTS}
        rows = segment_clients(tables, as_of, stamp, aggregated=made)
        return io.write_segmentation(rows, layers.segmentation, as_of), 0

    return _each("segment", ["client_segmentation"], str, load)


def mart_layer(spark: SparkSession, layers: io.Layers, as_of: str, at: str | None = None) -> list[Loaded]:
    """Client mart and offer mart of one run date."""
    stamp = F.lit(run_stamp(as_of, at)).cast("timestamp")
    snapshot = latest_snapshot(io.read_segmentation(spark, layers.segmentation), as_of)
    clients = combine_segments(snapshot)

    def load(mart: Mart) -> tuple[int, int]:
        if mart.name == "marketing_clients":
            rows = clients.withColumn("last_updated", stamp)
        else:
            rows = offers_with_ids(clients).withColumn("created_at", stamp)
        return io.write_mart(rows, layers.mart(mart), mart, as_of), 0

    marts = [MARTS["marketing_clients"], MARTS["targeted_offers"]]
    return _each("mart", marts, lambda m: m.name, load)


def analytics_layer(
    spark: SparkSession, layers: io.Layers, as_of: str, at: str | None = None
) -> list[Loaded]:
    """Daily figures of the run, computed on the segmentation of its date.

    The client mart loses rows of older runs when it is compacted; the segmentation keeps
    every date. Values are rounded as the client mart holds them.
    """
    mart = MARTS["marketing_analytics_daily"]

    def load(_) -> tuple[int, int]:
        stamp = run_stamp(as_of, at)
        clients = combine_segments(latest_snapshot(io.read_segmentation(spark, layers.segmentation), as_of))
        clients = clients.withColumn("last_updated", F.lit(stamp).cast("timestamp"))
        daily = reports.daily_segment_metrics(io.to_mart(clients, MARTS["marketing_clients"]), as_of, stamp)
        return io.write_mart(daily, layers.mart(mart), mart, as_of), 0

    return _each("analytics", [mart], lambda m: m.name, load)


# Reports of a run: name -> function of segmentation, clients and offers of its date.
REPORTS: dict[str, Callable[[DataFrame, DataFrame, DataFrame], DataFrame]] = {
    "segmentation_report": lambda segmentation, clients, offers: reports.segmentation_report(segmentation),
    "segment_drift": lambda segmentation, clients, offers: reports.segment_drift(segmentation),
    "segment_summary": lambda segmentation, clients, offers: reports.segment_summary(clients),
    "offers_by_type_segment": lambda segmentation, clients, offers: reports.offers_by_type_and_segment(offers),
    "top_clients": lambda segmentation, clients, offers: reports.top_clients(offers),
    "priority_grid": lambda segmentation, clients, offers: reports.priority_grid(offers),
    "top_offer_types": lambda segmentation, clients, offers: reports.top_offer_types(offers),
}


def report_layer(
    spark: SparkSession, layers: io.Layers, as_of: str, names: Iterable[str] = tuple(REPORTS)
) -> list[Loaded]:
    """The reports of a run, each stored in its order below its name and date.

    They are made from the stored segmentation of the date, as the daily figures are, since
    the marts lose rows of older runs when they are compacted. A report without rows is
    reported as not ok.
    """
    segmentation = latest_snapshot(io.read_segmentation(spark, layers.segmentation), as_of)
    clients = combine_segments(segmentation)
    offers = expand_offers(clients)

    def load(name: str) -> tuple[int, int]:
        watched, seen = io.counted(REPORTS[name](segmentation, clients, offers))
        io.replace_folder(watched, layers.report(name, as_of))
        return seen.get["rows"], 0

    return _each("report", names, str, load)


def compacted_month(spark: SparkSession, layers: io.Layers, mart: Mart, month: int) -> DataFrame:
    """One month of a mart merged by its own rule and clustered by its sort key.

    Rows keep the run date they came with, or the newest one of their key where rows were
    added up.

    Rows are placed by ranges of the sort key and then of all other columns, so a client
    with very many rows is split over several tasks.
    """
    rows = io.read_mart(spark, layers.mart(mart), mart).where(F.col("yyyymm") == month).drop("yyyymm")
    order = ["run_date", *mart.sort_by]
    placed = merged(rows, mart).repartitionByRange(*order, *[c for c in mart.columns if c not in order])
    return placed.sortWithinPartitions(*order)


def compact(spark: SparkSession, layers: io.Layers, mart: Mart, month: int) -> int:
    """Merge one month of a mart and rewrite it in place; gives the rows left."""
    path = layers.mart(mart)
    swap.settle(spark, path)
    return io.replace_month(compacted_month(spark, layers, mart, month), path, month)


# The marts that a run loads, and that are compacted after it.
LOADED_MARTS = ("marketing_clients", "targeted_offers", "marketing_analytics_daily")


def compact_layer(spark: SparkSession, layers: io.Layers, month: int) -> list[Loaded]:
    marts = [MARTS[name] for name in LOADED_MARTS]
    return _each("compact", marts, lambda m: m.name, lambda m: (compact(spark, layers, m, month), 0))


def run_pipeline(
    spark: SparkSession,
    messages_of: Callable[[Entity], DataFrame],
    root: str,
    as_of: str,
    at: str | None = None,
    compact_month: int | None = None,
    entities: Iterable[Entity] = tuple(ENTITIES.values()),
    with_reports: bool = False,
    fixed_offsets: bool = False,
) -> list[Loaded]:
    """All stages in dependency order for one date; running a date again replaces it.

    `messages_of` gives the message envelope of an entity, from files or from a topic.
    `entities` limits what is ingested; the others keep what an earlier run cleaned.
    A failed table ends the run after its stage, as later stages need it. An empty one is
    reported as not ok, but the run goes on. With `compact_month` the marts of that month
    are merged and rewritten at the end; `with_reports` stores the reports of the date. With `fixed_offsets` the
    run reads up to the offsets that it found when it was first started, also when it is repeated.
    """
    layers, at = io.Layers(root), run_stamp(as_of, at)
    if fixed_offsets:
        messages_of = fixed_messages(spark, layers, messages_of, as_of)
    stages = [
        lambda: ingest(spark, messages_of, layers, as_of, entities, at),
        lambda: clean_layer(spark, layers, as_of, entities),
        lambda: dedup_layer(spark, layers, as_of),
    ]
    with run_settings(spark):
        return _in_order(stages + _after_dedup(spark, layers, as_of, at, compact_month, with_reports))


def run_incremental(
    spark: SparkSession,
    stream_of: Callable[[Entity], DataFrame],
    root: str,
    as_of: str,
    at: str | None = None,
    compact_month: int | None = None,
    entities: Iterable[Entity] = tuple(ENTITIES.values()),
    with_reports: bool = False,
) -> list[Loaded]:
    """As `run_pipeline`, but reads only messages that came since the last incremental run.

    `stream_of` gives the stream of an entity's messages. What arrived is merged into the structured tables, and
    the per-client aggregates are kept up by the rows that came and went, so a run costs its increment and
    the buckets it touches. An entity without new messages is reported as not ok, and keeps its rows.
    """
    layers, at = io.Layers(root), run_stamp(as_of, at)
    stages = [
        lambda: arrive(stream_of, layers, as_of, entities),
        lambda: clean_layer(spark, layers, as_of, entities, arrived=True),
        lambda: merge_layer(spark, layers, as_of),
        lambda: partials_layer(spark, layers),
    ]
    with run_settings(spark):
        return _in_order(stages + _after_dedup(spark, layers, as_of, at, compact_month, with_reports, from_partials=True))


def _after_dedup(
    spark: SparkSession, layers: io.Layers, as_of: str, at: str, compact_month: int | None, with_reports: bool,
    from_partials: bool = False,
) -> list[Callable[[], list[Loaded]]]:
    stages = [
        lambda: segmentation_layer(spark, layers, as_of, at, from_partials),
        lambda: mart_layer(spark, layers, as_of, at),
        lambda: analytics_layer(spark, layers, as_of, at),
    ]
    if with_reports:
        stages.append(lambda: report_layer(spark, layers, as_of))
    if compact_month is not None:
        stages.append(lambda: compact_layer(spark, layers, compact_month))
    return stages


def _in_order(stages: Iterable[Callable[[], list[Loaded]]]) -> list[Loaded]:
    """Run stages until one has a failed table."""
    done: list[Loaded] = []
    for stage in stages:
        done += stage()
        if any(line.error for line in done):
            break
    return done


def load_report(spark: SparkSession, lines: list[Loaded]) -> DataFrame:
    return spark.createDataFrame([tuple(vars(x).values()) for x in lines], LOAD_REPORT_DDL)


def load_totals(report: DataFrame) -> DataFrame:
    """Per stage: tables that went well or not, rows, rejected rows, throughput and error rate.

    Tables of a stage run side by side, so the slowest one is the time of the stage. A
    table that failed as a whole counts as one error.
    """
    errors = F.sum("rejected") + F.count("error")
    return report.groupBy("stage").agg(
        F.count_if("ok").alias("successful_tables"),
        F.count_if(~F.col("ok")).alias("failed_tables"),
        F.sum("rows").alias("total_rows"),
        errors.alias("total_errors"),
        F.max("seconds").alias("seconds"),
        F.coalesce(F.try_divide(F.sum("rows"), F.max("seconds")), F.lit(0.0)).alias("rows_per_second"),
        (errors * 100.0 / F.greatest(F.lit(1), F.sum("rows") + errors)).alias("error_rate_percent"),
    )


def _each(stage: str, items: Iterable, name: Callable, load: Callable[..., tuple[int, int]]) -> list[Loaded]:
    """Run one independent Spark job per table side by side; a failure is reported, not raised."""

    def one(item) -> Loaded:
        begun = time.monotonic()
        try:
            rows, rejected = load(item)
            return Loaded(stage, name(item), rows, rejected, rows > 0, time.monotonic() - begun)
        except Exception as e:  # noqa: BLE001
            return Loaded(stage, name(item), 0, 0, False, time.monotonic() - begun, f"{type(e).__name__}: {e}")

    items = list(items)
    with ThreadPoolExecutor(max_workers=max(1, len(items))) as pool:
        return list(pool.map(one, items))
