"""The end-to-end run: reruns, history, rejected rows, maintenance."""

import pytest
from pyspark.sql import functions as F

from clientlens.plans import pipeline, reports
from clientlens.schemas import ENTITIES, MARTS
from clientlens.sources import envelope, layers as io, swap
from clientlens.operators.segmentation import latest_snapshot
from workload.adapters import spark_entity
from workload.queries import arriving

CLIENTS, OFFERS, DAILY = (MARTS[n] for n in pipeline.LOADED_MARTS)


@pytest.fixture(scope="module")
def finished(spark, tiny, tmp_path_factory):
    """Two dates, the second one run twice and compacted the second time."""
    home = tmp_path_factory.mktemp("run")
    source = str(home / "messages")
    for name, e in ENTITIES.items():
        envelope.write_envelope(arriving(spark_entity(spark, tiny, name), e), source, e.topic)
    bad = spark.createDataFrame([("not json",)], "value string")
    envelope.to_envelope(bad, ENTITIES["payments"].topic).withColumn("value", F.lit(b"not json")).write.mode(
        "append"
    ).partitionBy("topic").parquet(source)

    def read(entity):
        return envelope.read_envelope(spark, source, entity.topic)

    root = str(home / "layers")
    lines = []
    for day, month in (("2024-06-29", None), ("2024-06-30", None), ("2024-06-30", 202406)):
        lines.append(pipeline.run_pipeline(spark, read, root, day, f"{day} 12:00:00", compact_month=month))
    return io.Layers(root), lines


def rows_of(lines, stage):
    return {x.table: (x.rows, x.rejected) for x in lines if x.stage == stage}


def test_no_stage_failed(finished):
    for lines in finished[1]:
        assert [x for x in lines if x.error or not x.ok] == []
        assert {x.stage for x in lines} >= {"ingest", "clean", "dedup", "segment", "mart", "analytics"}


def test_rejected_rows_are_kept(spark, finished):
    layers, (first, *_) = finished
    payments = ENTITIES["payments"]
    assert rows_of(first, "ingest")["payments_raw"][1] == 1
    aside = spark.read.parquet(layers.unreadable(payments, "2024-06-29"))
    assert [r.raw_value for r in aside.collect()] == ["not json"]
    good, rejected = rows_of(first, "clean")["payments_structured"]
    quarantined = spark.read.parquet(layers.quarantine(payments)).where("processing_date = DATE '2024-06-29'")
    assert rejected == quarantined.count() > 0
    assert {r.violations for r in quarantined.select("violations").distinct().collect()} == {"not_null:payment_date"}
    assert good + rejected == rows_of(first, "ingest")["payments_raw"][0]


def test_history_and_latest_snapshot(spark, finished):
    segmentation = io.read_segmentation(spark, finished[0].segmentation)
    per_day = {str(r[0]): r[1] for r in segmentation.groupBy("processing_date").count().collect()}
    assert per_day == {"2024-06-29": 150, "2024-06-30": 150}
    latest = latest_snapshot(segmentation)
    assert latest.count() == latest.select("client_id").distinct().count() == 150


def test_rerun_and_compaction(spark, finished):
    layers, _ = finished
    clients = io.read_mart(spark, layers.mart(CLIENTS), CLIENTS)
    # One version per client and priority is left in the month, the newest.
    assert clients.count() == 150 and {str(r[0]) for r in clients.select("run_date").distinct().collect()} == {
        "2024-06-30"
    }
    offers = io.read_mart(spark, layers.mart(OFFERS), OFFERS)
    assert offers.count() == 2 * 450
    one = offers.where("run_date = DATE '2024-06-30'")
    assert one.count() == one.select("client_id", "offer_type").distinct().count() == 450
    daily = io.read_mart(spark, layers.mart(DAILY), DAILY)
    assert daily.groupBy("analysis_date").agg(F.sum("clients_count")).select(F.max("sum(clients_count)")).first()[0] == 150


def test_segment_counts_add_up(spark, finished):
    layers, _ = finished
    snapshot = latest_snapshot(io.read_segmentation(spark, layers.segmentation))
    report = {r.metric: r.value for r in reports.segmentation_report(snapshot).collect() if r.metric}
    assert sum(v for k, v in report.items() if k.startswith("Calculated")) == report["Total clients"]
    assert report["Total clients"] == report["Unique client_ids"] == 150


def test_failure_is_reported_and_ends_the_run(spark, tmp_path):
    def broken(entity):
        return spark.read.schema("value string").parquet(str(tmp_path / "nowhere"))

    lines = pipeline.run_pipeline(spark, broken, str(tmp_path / "x"), "2024-06-30")
    assert len(lines) == 7 and all(x.stage == "ingest" and x.error and not x.ok for x in lines)
    report = pipeline.load_report(spark, lines)
    assert report.where("not ok").count() == 7


def test_empty_topic_is_reported_but_does_not_end_the_run(spark, tmp_path):
    nothing = spark.createDataFrame([], "value string")
    lines = pipeline.run_pipeline(spark, lambda e: nothing, str(tmp_path / "y"), "2024-06-30")
    assert [x for x in lines if x.error] == []
    assert all(not x.ok and x.rows == 0 for x in lines)


def test_repaired_and_partial_runs(spark, tiny, tmp_path):
    """Rejects of a repaired date go away; topics left out keep their newest date; nothing cleaned is an error."""
    payments = ENTITIES["payments"]
    layers = io.Layers(str(tmp_path / "z"))
    rows = spark_entity(spark, tiny, "payments")
    undated = rows.withColumn("payment_date", F.lit(None).cast("date"))
    bad = spark.createDataFrame([("not json",)], "value string")
    good = envelope.to_envelope(rows, payments.topic).select("value")
    spoilt = envelope.to_envelope(rows.unionByName(undated), payments.topic).select("value")
    for messages, rejected in ((spoilt.unionByName(bad.select(F.col("value").cast("binary"))), True), (good, False)):
        lines = pipeline.ingest(spark, lambda e: messages, layers, "2024-06-30", [payments])
        lines += pipeline.clean_layer(spark, layers, "2024-06-30", [payments])
        assert all(x.ok and (x.rejected > 0) == rejected for x in lines)
        aside = spark.read.parquet(layers.unreadable(payments, "2024-06-30"))
        assert (aside.count() > 0) == (spark.read.parquet(layers.quarantine(payments)).count() > 0) == rejected
    clients = ENTITIES["clients"]
    later = pipeline.dedup_layer(spark, layers, "2024-07-01", [payments, clients])
    assert later[0].ok and later[0].rows == rows.count()
    assert not later[1].ok and "no cleaned date" in later[1].error
    assert pipeline.dedup_layer(spark, layers, "2024-06-29", [payments])[0].error


def test_daily_figures_after_compaction(spark, finished):
    """Compaction has dropped the first day's client rows; its daily figures come out whole again."""
    layers, _ = finished
    assert pipeline.analytics_layer(spark, layers, "2024-06-29", "2024-06-29 12:00:00")[0].ok
    daily = io.read_mart(spark, layers.mart(DAILY), DAILY).where("analysis_date = DATE '2024-06-29'")
    assert daily.agg(F.sum("clients_count")).first()[0] == 150


def test_command_line_from_files_to_marts(spark, tiny, tmp_path, capsys):
    from clientlens.__main__ import main

    source, topics, root = (str(tmp_path / n) for n in ("files", "topics", "layers"))
    for name, e in ENTITIES.items():
        rows = spark_entity(spark, tiny, name)
        rows.write.option("header", True).option("timestampFormat", "yyyy-MM-dd HH:mm:ss.SSSSSS").csv(
            f"{source}/{e.source_file}.csv"
        )
    common = ["2024-06-30", "--root", root, "--messages", topics, "--prefix", "X_"]
    assert main(["publish", *common, "--files", source]) == 0
    assert main(["ingest", *common, "--topics", "X_clients,X_nothing X_payments"]) == 0
    assert main(["run", *common, "--compact"]) == 0
    assert main(["analytics", *common]) == 0
    assert io.read_mart(spark, io.Layers(root).mart(OFFERS), OFFERS).count() == 450
    assert main(["ingest", *common[:3], "--messages", str(tmp_path / "none")]) == 1
    assert "successful_tables" in capsys.readouterr().out


def test_totals_of_a_report(spark):
    lines = [
        pipeline.Loaded("ingest", "a", 90, 9, True, 2.0),
        pipeline.Loaded("ingest", "b", 0, 0, False, 1.0, "boom"),
    ]
    row = pipeline.load_totals(pipeline.load_report(spark, lines)).first()
    assert (row.successful_tables, row.failed_tables, row.total_rows, row.total_errors) == (1, 1, 90, 10)
    assert (row.rows_per_second, row.error_rate_percent) == (45.0, 10.0)


def test_reports_of_a_date_survive_compaction(spark, finished):
    layers, _ = finished
    lines = pipeline.report_layer(spark, layers, "2024-06-29")
    assert {x.table for x in lines} == set(pipeline.REPORTS) and all(x.ok for x in lines), lines
    read = lambda name: spark.read.parquet(layers.report(name, "2024-06-29")).collect()
    assert sum(r.clients_count for r in read("segment_summary")) == 150
    assert sum(r.offers_count for r in read("priority_grid")) == 450
    assert len(read("top_clients")) == 10


def test_order_of_the_reports(spark, finished):
    layers, _ = finished
    segmentation = latest_snapshot(io.read_segmentation(spark, layers.segmentation), "2024-06-30")
    clients = pipeline.combine_segments(segmentation)
    offers = pipeline.expand_offers(clients)
    made = {name: make(segmentation, clients, offers).collect() for name, make in pipeline.REPORTS.items()}
    names = [r.metric for r in made["segmentation_report"]]
    assert names == sorted(names, key=lambda n: (n is None, n or ""))
    for name, column in (
        ("segment_summary", "total_value"),
        ("offers_by_type_segment", "total_expected_revenue"),
        ("top_clients", "total_expected_revenue"),
        ("top_offer_types", "total_expected_revenue"),
    ):
        values = [r[column] for r in made[name]]
        assert values == sorted(values, reverse=True) and len(values) > 1, name
    grid = [(r.priority_level, r.offer_priority) for r in made["priority_grid"]]
    assert grid == sorted(grid)


def test_compaction_that_fails_leaves_the_month_whole(spark, tmp_path, monkeypatch):
    path, month = f"{tmp_path}/mart", 202406
    day = "DATE '2024-06-30' AS run_date"
    spark.sql(f"SELECT 1 AS n, {day}").write.partitionBy("run_date").parquet(f"{path}/yyyymm={month}")
    read = lambda: sorted(r.n for r in spark.read.parquet(path).collect())

    broken = spark.sql(f"SELECT raise_error('lost') AS n, {day}")
    with pytest.raises(Exception, match="lost"):
        io.replace_month(broken, path, month)
    assert read() == [1]

    # Complete but not yet in its place: the next load brings it there, and readers see it between its places.
    change, rows = io.prepare_month(spark.sql(f"SELECT explode(array(2, 3)) AS n, {day}"), path, month)
    swap.commit(spark, change, [f"yyyymm={month}"])
    assert rows == 2 and read() == [1]
    next(swap.steps(spark, path))
    assert swap.listed(spark, f"{path}/yyyymm=*") == []
    assert sorted(r.n for r in swap.read(spark, path, "n int, yyyymm int, run_date date").collect()) == [2, 3]
    swap.settle(spark, path)
    assert read() == [2, 3]
    assert io.replace_month(spark.sql(f"SELECT 4 AS n, {day}"), path, month) == 1
    assert read() == [4] and swap.listed(spark, f"{path}/_swap/*") == []


def test_increment_without_new_messages_keeps_the_rows(spark, tiny, tmp_path):
    from clientlens.__main__ import main

    for name, e in ENTITIES.items():
        envelope.write_envelope(spark_entity(spark, tiny, name), f"{tmp_path}/messages", e.topic)
    bad = spark.createDataFrame([("not json",)], "value string")
    envelope.to_envelope(bad, ENTITIES["payments"].topic).withColumn("value", F.lit(b"not json")).drop("topic").write.mode(
        "append"
    ).parquet(envelope.topic_folder(f"{tmp_path}/messages", ENTITIES["payments"].topic))
    common = ["--root", f"{tmp_path}/layers", "--messages", f"{tmp_path}/messages"]
    assert main(["increment", "2024-06-29", *common]) == 0
    layers = io.Layers(f"{tmp_path}/layers")
    aside = spark.read.parquet(layers.arrived(ENTITIES["payments"], unreadable=True))
    assert [r.raw_value for r in aside.collect()] == ["not json"]
    # Nothing has arrived: the status says so, and the later tables are the same.
    assert main(["increment", "2024-06-30", *common]) == 1
    for day in ("2024-06-29", "2024-06-30"):
        clients = io.read_mart(spark, layers.mart(CLIENTS), CLIENTS).where(F.col("run_date") == F.lit(day).cast("date"))
        assert clients.count() == 150
