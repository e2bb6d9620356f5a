"""Messages, files, layers, catalog tables and incremental ingest."""

import math
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from clientlens.schemas import ENTITIES, ENVELOPE_DDL, MARTS
from clientlens.sources import catalog, envelope, files, layers as io, offsets
from clientlens.streaming.ingest import start_ingest, stream_files

ACT = ENTITIES["client_activities"]
RATE = ENTITIES["currency_rates"]
LOGIN = ENTITIES["client_logins"]


def messages(spark, *texts, topic="t"):
    return spark.createDataFrame([(topic, t) for t in texts], "topic string, value string")


def activities(spark, *ids, day=date(2024, 1, 1)):
    return spark.createDataFrame([(i, "C1", day, "LOGIN", 3, 4) for i in ids], ACT.schema)


# --- JSON edge cases ---


def parse_one(spark, text, entity):
    return envelope.parse_messages(messages(spark, text), entity).first()


def test_json_nan_by_type(spark):
    assert math.isnan(parse_one(spark, '{"rate_id": "R", "rate_value": NaN}', RATE).rate_value)
    assert parse_one(spark, '{"activity_id": "A", "page_views": NaN}', ACT).page_views is None
    assert parse_one(spark, '{"rate_id": NaN, "rate_value": 1.0}', RATE).rate_id == '"NaN"'


def test_json_mismatches_become_null(spark):
    row = parse_one(spark, '{"activity_id": "A", "page_views": 3.0, "activity_date": "2024-02-03", "more": 1}', ACT)
    assert (row.activity_id, row.page_views, row.activity_date) == ("A", None, date(2024, 2, 3))
    assert parse_one(spark, '{"login_id": "L", "success": "true"}', LOGIN).success is None
    assert parse_one(spark, '{"rate_id": "R", "rate_value": "2.5"}', RATE).rate_value is None


def test_timestamps_keep_microseconds_and_text_keeps_its_alphabet(spark):
    stamp = datetime(2024, 1, 1, 10, 20, 30, 123456)
    df = spark.createDataFrame([("L", "Клиент", stamp, None, None, None, True)], LOGIN.schema)
    sent = envelope.to_messages(df, "t")
    assert "Клиент" in sent.first().value and "2024-01-01 10:20:30.123456" in sent.first().value
    assert tuple(envelope.parse_messages(sent, LOGIN).drop("raw_value").first()) == tuple(df.first())


def test_fields_of_the_wrong_type_are_named(spark):
    texts = {
        '{"activity_id": "A", "page_views": 3}': "",
        '{"activity_id": "A", "page_views": null, "more": "x"}': "",
        '{"activity_id": "A", "page_views": 3.5, "duration_minutes": "4"}': "type:duration_minutes=4,type:page_views=3.5",
        '{"activity_id": "A", "page_views": NaN}': "type:page_views=NaN",
        '{"activity_id": "A", "activity_date": "2024-13-01"}': "type:activity_date=2024-13-01",
        '{"activity_id": "A", "client_id": null, "page_views": {"n": 1}}': 'type:page_views={"n":1}',
        "{}": "unreadable",
        '["A"]': "unreadable",
        "": "unreadable",
    }
    checked = envelope.with_violations(envelope.parse_messages(messages(spark, *texts), ACT), ACT)
    assert {r.raw_value: r.violations for r in checked.collect()} == texts


def test_unreadable_messages_are_set_aside_or_kept_as_nulls(spark):
    df = messages(spark, '{"activity_id": "A"}', "not json", None)
    rows, bad = envelope.read_messages(df, ACT)
    assert [r.activity_id for r in rows.collect()] == ["A"]
    assert sorted(str(r.raw_value) for r in bad.collect()) == ["None", "not json"]
    strict, nothing = envelope.read_messages(df, ACT, strict=True)
    assert nothing is None and strict.count() == 3 and strict.where("activity_id IS NULL").count() == 2


def test_envelope_has_the_columns_of_the_kafka_source(spark):
    from clientlens.schemas import struct

    out = envelope.to_envelope(activities(spark, "A"), "t", "2024-01-01 00:00:00")
    assert [(f.name, f.dataType) for f in out.schema] == [(f.name, f.dataType) for f in struct(ENVELOPE_DDL)]
    assert out.first().key is None


# --- routing ---


def test_topic_list_and_routes(spark):
    assert envelope.parse_topics("A,B  C") == ["A", "B", "C"]
    assert envelope.parse_topics(" , ") == []
    routes = envelope.routes("X_")
    assert len(routes) == 7 and routes["X_securities_portfolios"].name == "portfolios"


def test_topic_report_names_unknown_topics(spark):
    df = messages(spark, "a", "b", topic="clients").unionByName(messages(spark, "c", topic="other"))
    assert {tuple(r) for r in envelope.topic_report(df).collect()} == {
        ("clients", 2, "clients_raw", True),
        ("other", 1, None, False),
    }


def test_send_report(spark):
    df = activities(spark, "A", "B", None)
    row = envelope.send_report(df, ACT, seconds=2.0).first()
    assert (row.topic, row.sent, row.errors, row.records_per_second) == ("client_activities", 2, 1, 1.0)
    assert row.error_rate_percent == pytest.approx(100 / 3)
    nothing = envelope.send_report(df.limit(0), ACT).first()
    assert (nothing.sent, nothing.errors, nothing.error_rate_percent) == (0, 0, 0.0)


# --- files ---


def test_format_follows_suffix(spark, tmp_path):
    df = activities(spark, "A", None)
    df.write.parquet(str(tmp_path / "a.parquet"))
    df.write.option("header", True).csv(str(tmp_path / "a.csv"))
    for name in ("a.parquet", "a.csv"):
        read = files.read_file(spark, str(tmp_path / name), ACT)
        assert sorted(read.collect(), key=str) == sorted(df.collect(), key=str)


def test_csv_with_another_header_is_an_error(spark, tmp_path):
    activities(spark, "A").select(*reversed(ACT.columns)).write.option("header", True).csv(str(tmp_path / "b.csv"))
    with pytest.raises(Exception, match="header"):
        files.read_file(spark, str(tmp_path / "b.csv"), ACT).collect()


# --- layers ---


def test_a_date_replaces_itself_only(spark, tmp_path):
    path = str(tmp_path / "cleaned")
    assert io.write_cleaned(activities(spark, "A", "B"), path, "2024-01-01") == 2
    assert io.write_cleaned(activities(spark, "C"), path, "2024-01-02") == 1
    assert io.write_cleaned(activities(spark, "D"), path, "2024-01-01") == 1
    found = {(r.activity_id, str(r.processing_date)) for r in io.read_cleaned(spark, path, ACT).collect()}
    assert found == {("C", "2024-01-02"), ("D", "2024-01-01")}


def test_raw_round_trip_with_lineage(spark, tmp_path):
    rows = envelope.with_lineage(activities(spark, "A"), "2024-01-01", "2024-01-01 08:00:00")
    assert io.write_raw(rows, str(tmp_path / "raw")) == 1
    row = io.read_raw(spark, str(tmp_path / "raw"), ACT).first()
    assert row.processing_date == "2024-01-01" and row.ingestion_timestamp == datetime(2024, 1, 1, 8)


def test_mart_load_casts_and_partitions(spark, tmp_path):
    mart = MARTS["marketing_clients"]
    df = spark.createDataFrame(
        [("A", "N", "S", "S", "S", 1.005, 1, 2, datetime(2024, 6, 30))],
        "client_id string, client_name string, portfolio_segment string, transaction_segment string, "
        "combined_segment string, total_value double, activity_score long, priority_level int, last_updated timestamp",
    )
    assert io.write_mart(df, str(tmp_path / "mart"), mart, "2024-06-30") == 1
    row = io.read_mart(spark, str(tmp_path / "mart"), mart).first()
    assert (row.yyyymm, row.run_date) == (202406, date(2024, 6, 30))
    assert (tmp_path / "mart" / "yyyymm=202406" / "run_date=2024-06-30").exists()


def test_all_marts_are_declared():
    assert set(MARTS) == {
        "marketing_clients",
        "targeted_offers",
        "marketing_campaign_results",
        "marketing_analytics_daily",
        "campaign_performance",
    }
    for mart in MARTS.values():
        assert {*mart.sort_by, mart.month_of} <= set(mart.columns)


# --- catalog ---


def test_external_table_sees_new_dates_after_recovery(spark, tmp_path):
    layers = io.Layers(str(tmp_path))
    io.write_cleaned(activities(spark, "A"), layers.cleaned(ACT), "2024-01-01")
    name = catalog.register_cleaned(spark, layers, ACT, "ext_activities_test")
    assert spark.table(name).count() == 1
    io.write_cleaned(activities(spark, "B", "C"), layers.cleaned(ACT), "2024-01-02")
    catalog.recover_partitions(spark, name)
    assert spark.table(name).where("processing_date = DATE '2024-01-02'").count() == 2
    spark.sql(f"DROP TABLE {name}")
    assert io.read_cleaned(spark, layers.cleaned(ACT), ACT).count() == 3


def test_managed_table_is_replaced_bucketed_and_analyzed(spark):
    catalog.save_table(activities(spark, "A", "B"), "acts", bucket_by="client_id", buckets=4)
    catalog.save_table(activities(spark, "C"), "acts", bucket_by="client_id", buckets=4)
    catalog.analyze(spark, "acts")
    assert [r.activity_id for r in spark.table("acts").collect()] == ["C"]
    facts = {r.col_name: r.data_type for r in spark.sql("DESCRIBE EXTENDED acts").collect()}
    assert facts["Num Buckets"] == "4" and "1 rows" in facts["Statistics"]
    plan = spark.table("acts").groupBy("client_id").count()._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan
    spark.sql("DROP TABLE acts")


def test_mart_tables(spark, tmp_path):
    names = catalog.create_mart_tables(spark, io.Layers(str(tmp_path)), "m_")
    assert len(names) == 5 and all(spark.table(n).count() == 0 for n in names)
    for n in names:
        spark.sql(f"DROP TABLE {n}")


# --- incremental ingest ---


def ingest(spark, source, root, topic, unreadable=False):
    part = "bad" if unreadable else "rows"
    start_ingest(
        stream_files(spark, source, topic), ACT, f"{root}/{part}", f"{root}/{part}-checkpoint", "2024-01-01", unreadable
    ).awaitTermination()


def test_stream_equals_batch_and_takes_every_message_once(spark, tmp_path):
    source, root = str(tmp_path / "topic"), str(tmp_path / "out")
    topic = ACT.topic
    envelope.write_envelope(activities(spark, "A", "B"), source, topic)
    ingest(spark, source, root, topic)
    ingest(spark, source, root, topic)
    assert io.read_raw(spark, f"{root}/rows", ACT).count() == 2
    envelope.write_envelope(activities(spark, "C"), source, topic)
    envelope.write_envelope(activities(spark, "X"), source, "other_topic")
    broken = envelope.to_envelope(activities(spark, "D"), topic).withColumn("value", F.lit(b"not json"))
    broken.write.mode("append").partitionBy("topic").parquet(source)
    ingest(spark, source, root, topic)
    ingest(spark, source, root, topic, unreadable=True)

    batch = envelope.read_messages(envelope.read_envelope(spark, source, topic), ACT)[0]
    stream = io.read_raw(spark, f"{root}/rows", ACT).select(*ACT.columns)
    assert sorted(stream.collect()) == sorted(batch.collect())
    assert stream.count() == 3
    assert [r.raw_value for r in spark.read.parquet(f"{root}/bad").collect()] == ["not json"]


def test_csv_cells_that_do_not_parse_are_set_aside(spark, tmp_path):
    from clientlens.plans import pipeline

    payments = ENTITIES["payments"]
    head = ",".join(payments.columns)
    lines = [head, 'a,c,2024-01-01,1.5,RUB,"Say ""hi"", ok",Completed', "b,c,2024-01-01,oops,RUB,UTILITY,Completed"]
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / f"{payments.source_file}.csv").write_text("\n".join(lines) + "\n")
    sent = []
    (line,) = pipeline.publish(
        spark, str(tmp_path / "in"), lambda rows, e: sent.extend(rows.collect()), "csv", [payments], str(tmp_path / "aside")
    )
    assert (line.rows, line.rejected, line.error) == (1, 1, None)
    assert [(r.payment_id, r.amount, r.payment_type) for r in sent] == [("a", 1.5, 'Say "hi", ok')]
    aside = spark.read.parquet(str(tmp_path / "aside" / "payments"))
    assert [r["_broken_line"] for r in aside.collect()] == [lines[2]]


# --- offsets ---


def test_a_run_keeps_its_offsets(spark, tmp_path):
    root, topic, known = str(tmp_path), "t", [{0: 5, 1: 2}, {0: 9, 1: 2, 2: 1}, {0: 10}]
    fix = lambda run, n, **more: offsets.fix(spark, root, topic, run, lambda: known[n], **more)
    assert fix("1", 0) == fix("1", 1) == {0: (0, 5), 1: (0, 2)}
    assert fix("2", 1, go_on=True) == {0: (5, 9), 1: (2, 2), 2: (0, 1)}
    assert fix("3", 1) == {0: (0, 9), 1: (0, 2), 2: (0, 1)}
    rows = spark.sql("SELECT explode(sequence(0, 9)) AS offset, 0 AS partition UNION ALL SELECT 0, 7")
    assert sorted(r.offset for r in offsets.within(rows, {0: (5, 9)}).collect()) == [5, 6, 7, 8]
    assert offsets.within(rows, {}).count() == 0 and offsets.ends(rows) == {0: 10, 7: 1}
    assert offsets.kafka_options("t", {1: (2, 3), 0: (4, 5)}) == {
        "startingOffsets": '{"t": {"0": 4, "1": 2}}', "endingOffsets": '{"t": {"0": 5, "1": 3}}',
    }


def test_appended_messages_have_offsets_of_their_own(spark, tmp_path):
    for ids in ("AB", "CD"):
        envelope.write_envelope(activities(spark, *ids).coalesce(1), str(tmp_path), "t")
    assert sorted(r.offset for r in envelope.read_envelope(spark, str(tmp_path), "t").collect()) == [0, 1, 2, 3]


def test_rows_of_one_pass_go_to_one_folder_or_the_other(spark, tmp_path):
    root, ddl = str(tmp_path), "n bigint"
    folders = (f"{root}/kept/a", ddl), (f"{root}/aside/a", ddl)
    read = lambda side: sorted(r.n for r in spark.read.schema(ddl).parquet(f"{root}/{side}/a").collect())
    write = lambda n, bad: io.write_halves(spark.range(n).selectExpr("id AS n", f"{bad} AS bad"), "bad", root, "a", *folders)
    assert write(3, "false") == (3, 0) and read("kept") == [0, 1, 2] and not (tmp_path / "aside").exists()
    assert write(4, "id > 1") == (2, 2) and (read("kept"), read("aside")) == ([0, 1], [2, 3])
    assert write(2, "true") == (0, 2) and (read("kept"), read("aside")) == ([], [0, 1])
    assert write(0, "true") == (0, 0) and (read("kept"), read("aside")) == ([], [])


def test_shared_folder_is_never_a_local_one_on_a_cluster(spark, monkeypatch):
    from types import SimpleNamespace

    from clientlens import workspace

    session = lambda master, **conf: SimpleNamespace(
        conf=SimpleNamespace(get=lambda k, *d: conf.get(k.rsplit(".", 2)[1], d[0] if d else None)),
        sparkContext=SimpleNamespace(master=master, applicationId="app"),
    )
    assert workspace.shared_folder(session("yarn", checkpoint="hdfs:///c/")) == "hdfs:///c"
    assert workspace.shared_folder(session("local[2]", warehouse="file:/w")) == "file:/w/_staged"
    assert workspace.shared_folder(session("yarn", warehouse="hdfs:///w")) == "hdfs:///w/_staged"
    with pytest.raises(ValueError, match="checkpoint.dir"):
        workspace.shared_folder(session("yarn", warehouse="file:/w"))


def test_scratch_of_an_application_can_be_dropped(spark):
    from pathlib import Path

    from clientlens import workspace

    folder = workspace.scratch_path(spark, "x")
    application = Path(folder.removeprefix("file:")).parent
    assert application.name == spark.sparkContext.applicationId
    other = workspace.scratch_path(spark, "y")
    assert other != folder and other.rsplit("/", 1)[0] == folder.rsplit("/", 1)[0]
