"""What is written, dealt and read follows the size of the tables."""

from __future__ import annotations

from pathlib import Path

import pyarrow.parquet as pq
from pyspark.sql import functions as F

from clientlens.schemas import ENTITIES
from clientlens.sources import envelope, layers as io
from workload import feeds, queries

PAYMENTS = ENTITIES["payments"]


def payments(spark, *keys):
    given = {"client_id": "A", "amount": 1.5, "currency": "RUB"}
    rows = [tuple({**given, PAYMENTS.key: k}.get(c) for c in PAYMENTS.columns) for k in keys]
    return spark.createDataFrame(rows, PAYMENTS.schema)


def test_layers_and_messages_are_written_with_zstd(spark, tmp_path):
    before = spark.conf.get("spark.sql.parquet.compression.codec")
    spark.conf.set("spark.sql.parquet.compression.codec", "snappy")
    try:
        rows = payments(spark, "p1", "p2")
        io.write_raw(rows, f"{tmp_path}/raw")
        envelope.write_envelope(rows, f"{tmp_path}/messages", PAYMENTS.topic)
    finally:
        spark.conf.set("spark.sql.parquet.compression.codec", before)
    files = list(Path(tmp_path).rglob("*.parquet"))
    assert files and {pq.ParquetFile(f).metadata.row_group(0).column(0).compression for f in files if pq.ParquetFile(f).metadata.num_rows} == {"ZSTD"}


def test_a_feed_reads_its_rows_once(spark, tmp_path):
    io.write_raw(payments(spark, "p1", "p7"), f"{tmp_path}/rows")
    rows = spark.read.schema(PAYMENTS.schema).parquet(f"{tmp_path}/rows")
    for feed in (feeds.faulty, feeds.replayed):
        made = feed(rows, PAYMENTS)
        assert made.count() == 4 and made._jdf.queryExecution().optimizedPlan().toString().count("Relation [") == 1


def test_checked_messages_together_are_both_parts(spark):
    good = envelope.to_messages(payments(spark, "p1"), "t")
    texts = ['not json', '{"payment_id": "p2", "amount": {"rub": 1}}', '{"payment_id": "p3", "am\\u006funt": "x"}', '{"payment_id": "p4"}', None]
    messages = good.unionByName(spark.createDataFrame([("t", x) for x in texts], "topic string, value string"))
    kept, aside = envelope.read_messages(messages, PAYMENTS)
    both, _ = envelope.read_messages(messages, PAYMENTS, together=True)
    assert sorted(map(str, both.where("violations = ''").select(*PAYMENTS.columns).collect())) == sorted(map(str, kept.select(*PAYMENTS.columns).collect()))
    found = {r.raw_value: r.violations for r in both.where(F.expr(envelope.IS_REJECTED)).collect()}
    assert found == {r.raw_value: r.violations for r in aside.collect()}
    assert found[texts[1]].startswith("type:amount=") and found[texts[2]] == "type:amount=x" and texts[3] not in found


def test_buckets_follow_the_tables(spark, tiny, monkeypatch):
    monkeypatch.setattr(queries, "BUCKET_BYTES", 10_000)
    want = -(-queries.stored_bytes(spark, tiny, "clients", *queries.BY_ENTITY) // 10_000)
    assert want > 8 and queries.co_located(spark, tiny)["payments"]._jdf.inputFiles() is not None
    names = [t.name for t in spark.catalog.listTables() if t.name.startswith("b_payments_")]
    said = [r.data_type for n in names for r in spark.sql(f"DESCRIBE EXTENDED {n}").where("col_name = 'Num Buckets'").collect()]
    assert str(want) in said
