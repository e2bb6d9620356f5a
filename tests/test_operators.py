"""Cleaning, quality, dedup, money, ordinals and maintenance on small hand-written rows."""

import random
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from clientlens.functions import money
from clientlens.functions.dates import yyyymm
from clientlens.operators.aggregates import transactions_by_client
from clientlens.operators.cleaning import clean, to_cleaned
from clientlens.operators.dedup import dedup_entity, newest_per_key
from clientlens.operators.maintenance import merged, replace_latest, sum_merge
from clientlens.operators.ordinal import with_global_ordinal
from clientlens.operators.quality import split_quality
from clientlens.operators.segmentation import latest_snapshot
from clientlens.plans import reports
from clientlens.schemas import ENTITIES, MARTS

TX = ENTITIES["bank_transactions"]


def tx(spark, *rows):
    return spark.createDataFrame(list(rows), TX.schema)


# --- cleaning ---


def test_cleaning_strips_blanks_only_and_keeps_null(spark):
    df = spark.createDataFrame(
        [("C1", "  Ann\t ", "+7 (911) 12-34", " a@b ", None, None, None, None, None), ("C2", None, None) + (None,) * 6],
        ENTITIES["clients"].schema,
    )
    a, b = clean(df, ENTITIES["clients"]).orderBy("client_id").collect()
    assert (a.client_name, a.phone, a.email) == ("Ann\t", "79111234", "a@b")
    assert (b.client_name, b.phone, b.email) == (None, None, None)


def test_cleaning_skips_missing_columns(spark):
    df = spark.createDataFrame([(" usd ",)], "currency string")
    assert clean(df, TX).collect()[0][0] == "USD"
    assert clean(df, ENTITIES["clients"]).columns == ["currency"]


def test_cleaned_has_date_and_no_ingest_column(spark):
    df = tx(spark, ("T", "C", None, 1.0, "rub", "debit", None))
    assert to_cleaned(df, TX, "2024-01-02").first().processing_date == "2024-01-02"
    dated = df.withColumns({"processing_date": F.lit("2024-01-01"), "ingestion_timestamp": F.current_timestamp()})
    out = to_cleaned(dated, TX, "2024-01-02")
    assert "ingestion_timestamp" not in out.columns and out.first().processing_date == "2024-01-01"


# --- quality ---


def test_quality_names_every_broken_rule_and_loses_nothing(spark):
    day = date(2024, 1, 1)
    df = tx(
        spark,
        ("T1", "C1", day, 1.0, "RUB", "DEBIT", None),
        ("T2", None, day, 1.0, "RUBX", "DEBIT", None),
        ("T3", "C1", None, None, "RUB", "DEBIT", "x" * 51),
        ("T" * 20, "C" * 20, day, 1.0, "RUB", "D" * 50, "c" * 50),
    )
    valid, broken = split_quality(df, TX)
    assert {r.transaction_id for r in valid.collect()} == {"T1", "T" * 20}
    assert {r.transaction_id: r.violations for r in broken.collect()} == {
        "T2": "not_null:client_id,length:currency",
        "T3": "not_null:transaction_date,not_null:amount,length:channel",
    }


# --- dedup ---


def test_newest_wins_null_is_oldest_and_rest_breaks_ties(spark):
    d1, d2 = date(2024, 1, 1), date(2024, 1, 2)
    df = tx(
        spark,
        ("A", "C1", None, 9.0, "RUB", "X", None),
        ("A", "C1", d1, 1.0, "RUB", "X", None),
        ("A", "C1", d2, 2.0, "RUB", "X", None),
        ("B", "C1", None, 5.0, "RUB", "X", None),
        ("C", "C2", d1, 3.0, "RUB", "X", None),
        ("C", "C1", d1, 4.0, "RUB", "X", None),
        (None, "C1", d1, 4.0, "RUB", "X", None),
    ).withColumn("extra", F.lit(1))
    out = dedup_entity(df, TX)
    assert out.columns == TX.columns
    assert {r.transaction_id: r.amount for r in out.collect()} == {"A": 2.0, "B": 5.0, "C": 4.0, None: 4.0}


def test_client_tie_goes_to_first_name(spark):
    e = ENTITIES["clients"]
    day = date(2024, 1, 1)
    rows = [("C", n, p, None, None, day, None, None, None) for n, p in (("Zoe", "1"), ("Ann", "9"), ("Ann", "2"))]
    assert dedup_entity(spark.createDataFrame(rows, e.schema), e).first()[:3] == ("C", "Ann", "2")


def test_dedup_equals_brute_force(spark):
    rng = random.Random(7)
    rows = [
        (f"T{rng.randrange(40)}", f"C{rng.randrange(5)}", rng.choice([None, date(2024, 1, rng.randint(1, 4))]),
         rng.choice([None, 1.5, 2.5]), "RUB", rng.choice(["A", "B", None]), None)
        for _ in range(600)
    ]

    def last(v):
        return (v is None, v if v is not None else 0)

    best = {}
    for r in rows:
        rank = (r[2] is None, -r[2].toordinal() if r[2] else 0, *[(v is None, v or "") for v in (r[1],)], last(r[3]),
                *[(v is None, v or "") for v in (r[4], r[5])])
        if r[0] not in best or rank < best[r[0]][0]:
            best[r[0]] = (rank, r)
    found = {tuple(r) for r in dedup_entity(tx(spark, *rows).repartition(7), TX).collect()}
    assert found == {r for _, r in best.values()}


# --- money ---


def sums(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "v double")
    return tuple(df.agg(money.total(F.col("v")), money.mean(F.col("v"))).first())


def test_money_is_exact_and_independent_of_order(spark):
    values = [0.1] * 1000 + [0.2] * 500 + [-0.3] * 7
    assert sums(spark, values)[0] == sums(spark, values[::-1])[0] == 197.9
    assert sums(spark, [None, None]) == (None, None)
    assert sums(spark, [0.1, 0.2, None]) == (0.3, 0.15)
    assert sums(spark, []) == (None, None)


def test_money_has_one_arithmetic_for_all_sizes(spark):
    assert sums(spark, [0.004] * 1000)[0] == 4.0
    assert sums(spark, [899_999_999_999.004, 0.001])[0] == 899_999_999_999.005
    assert sums(spark, [1.5, 3e15])[0] == 3e15 + 1.5
    assert spark.range(200_000).select(money.total(F.lit(8e11))).first()[0] == 1.6e17
    mixed = [1e15, 0.001, -1e15, 8e11, 0.002, -8e11]
    assert sums(spark, mixed)[0] == sums(spark, mixed[::-1])[0] == 0.003


@pytest.mark.parametrize("value", [float("nan"), float("inf"), 1e27])
def test_money_that_does_not_fit_is_an_error(spark, value):
    with pytest.raises(Exception, match="amount does not fit"):
        sums(spark, [1.0, value])


def test_amounts_that_do_not_fit_go_to_quarantine(spark):
    held = ENTITIES["portfolios"]
    rows = [
        ("a", "c", "STOCK", "n", 1, 1.0, 2.0, date(2024, 1, 1)),
        ("b", "c", "STOCK", "n", 2, 1.0, 1e308, date(2024, 1, 1)),
        ("d", "c", "STOCK", "n", 2, 1.0, float("nan"), date(2024, 1, 1)),
        ("e", "c", "STOCK", "n", 2, 1.0, None, date(2024, 1, 1)),
    ]
    valid, broken = split_quality(spark.createDataFrame(rows, held.schema), held)
    assert {r.portfolio_id for r in valid.collect()} == {"a", "e"}
    assert {(r.portfolio_id, r.violations) for r in broken.collect()} == {
        ("b", "amount:quantity * current_price"),
        ("d", "amount:quantity * current_price"),
    }


# --- ordinal ---


def test_ordinal_is_the_rank_in_the_whole_table(spark):
    rng = random.Random(1)
    rows = [(n, rng.choice([0, 0, 0, 1, 5, None])) for n in range(5000)]
    df = spark.createDataFrame(rows, "id int, v int").repartition(13)
    out = with_global_ordinal(df, [F.col("v").desc_nulls_last(), F.col("id").asc()])
    expected = sorted(rows, key=lambda r: (r[1] is None, -(r[1] or 0), r[0]))
    assert {r.id: r.ordinal for r in out.collect()} == {r[0]: i for i, r in enumerate(expected, 1)}


def test_ordinal_of_nothing(spark):
    df = spark.createDataFrame([], "id int")
    assert with_global_ordinal(df, [F.col("id").asc()]).count() == 0


# --- snapshot, maintenance ---


def test_latest_snapshot(spark):
    df = spark.createDataFrame([(1, date(2024, 1, 1)), (2, date(2024, 1, 2))], "id int, processing_date date")
    assert [r.id for r in latest_snapshot(df).collect()] == [2]
    assert [r.id for r in latest_snapshot(df, "2024-01-01").collect()] == [1]


def test_yyyymm(spark):
    assert spark.range(1).select(yyyymm(F.lit("2024-03-09").cast("date"))).first()[0] == 202403


def client_rows(spark, *rows):
    full = [(c, c, "S", "S", "S", v, 1, p, datetime.fromisoformat(t)) for c, p, v, t in rows]
    return spark.createDataFrame(
        [r[:5] + (None,) + r[6:] for r in full], MARTS["marketing_clients"].schema
    ).withColumn("client_name", F.concat("client_name", F.lit("@"), F.col("last_updated").cast("string")))


def test_replace_latest_keeps_one_version_per_month_and_priority(spark):
    mart = MARTS["marketing_clients"]
    df = client_rows(
        spark,
        ("A", 1, 1, "2024-06-01 10:00:00"),
        ("A", 1, 1, "2024-06-20 10:00:00"),
        ("A", 2, 1, "2024-06-02 10:00:00"),
        ("A", 1, 1, "2024-07-01 10:00:00"),
    )
    kept = {(r.priority_level, str(r.last_updated)) for r in replace_latest(df, mart).collect()}
    assert kept == {(1, "2024-06-20 10:00:00"), (2, "2024-06-02 10:00:00"), (1, "2024-07-01 10:00:00")}
    assert [str(r.last_updated) for r in replace_latest(df, mart, ["client_id"]).collect()] == ["2024-07-01 10:00:00"]


def test_replace_latest_of_campaigns(spark):
    mart = MARTS["marketing_campaign_results"]
    base = ("K", "Name", "VIP", date(2024, 6, 1), None, 10, 1, 0.1, None, 0.5)
    rows = [base + (datetime(2024, 7, d),) for d in (1, 3, 2)] + [
        ("K", "Name", "VIP", date(2024, 7, 1), None, 10, 1, 0.1, None, 0.5, datetime(2024, 7, 1))
    ]
    out = replace_latest(spark.createDataFrame(rows, mart.schema), mart)
    assert {(r.start_date, r.created_at) for r in out.collect()} == {
        (date(2024, 6, 1), datetime(2024, 7, 3)),
        (date(2024, 7, 1), datetime(2024, 7, 1)),
    }


def test_sum_merge_adds_and_takes_the_average_again(spark):
    from decimal import Decimal as D

    mart = MARTS["marketing_analytics_daily"]
    day = date(2024, 6, 1)
    rows = [
        (day, "A", 2, D("10.00"), D("5.00"), 2, 0, datetime(2024, 6, 1)),
        (day, "A", 1, D("5.00"), D("5.00"), 1, 1, datetime(2024, 6, 2)),
        (day, "B", 0, D("0.00"), D("0.00"), 0, 0, datetime(2024, 6, 1)),
    ]
    df = spark.createDataFrame(rows, mart.schema)
    out = {r.segment: r for r in sum_merge(df, mart).collect()}
    a = out["A"]
    assert (a.clients_count, a.total_revenue, a.avg_revenue, a.active_clients, a.new_clients) == (
        3, D("15.00"), D("5.00"), 3, 1,
    )
    assert out["B"].avg_revenue is None
    assert {r.segment for r in sum_merge(df, mart, drop_zero_rows=True).collect()} == {"A"}
    assert merged(df, mart).count() == 2


def test_plain_mart_keeps_all_rows(spark):
    df = spark.createDataFrame([(1,), (1,)], "v int")
    assert merged(df, MARTS["targeted_offers"]).count() == 2


# --- reports ---


def test_report_labels_missing_segment_null_and_sorts_it_last(spark):
    df = spark.createDataFrame(
        [("A", "VIP", "VIP"), ("B", "VIP", "Basic"), ("C", "Basic", None)],
        "client_id string, segment string, original_segment string",
    )
    rows = [tuple(r) for r in reports.segmentation_report(df).collect()]
    assert rows == [
        ("Calculated Segment: Basic", 1),
        ("Calculated Segment: VIP", 2),
        ("Original Segment: Basic", 1),
        ("Original Segment: VIP", 1),
        ("Total clients", 3),
        ("Unique client_ids", 3),
        (None, 1),
    ]
    assert [tuple(r) for r in reports.segment_drift(df).collect()] == [
        ("Segments matched", 1),
        ("Segments changed", 1),
    ]


def test_reports_of_nothing(spark):
    df = spark.createDataFrame([], "client_id string, segment string, original_segment string")
    assert [tuple(r) for r in reports.segmentation_report(df).collect()] == [
        ("Total clients", 0),
        ("Unique client_ids", 0),
    ]


@pytest.mark.parametrize("partitions", [1, 5])
def test_top_clients_breaks_ties_by_id(spark, partitions):
    rows = [(f"C{n:02d}", "N", "S", 100) for n in range(30)]
    df = spark.createDataFrame(rows, "client_id string, client_name string, combined_segment string, expected_revenue long")
    top = reports.top_clients(df.repartition(partitions)).collect()
    assert [r.client_id for r in top] == [f"C{n:02d}" for n in range(10)]


# --- a client, or a record, with a third of all rows ---


def test_hot_client_and_hot_record(spark):
    n = 60_000
    hot = F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id"))
    df = spark.range(n).select(
        F.concat(F.lit("T"), hot).alias("transaction_id"),
        F.concat(F.lit("C"), hot).alias("client_id"),
        F.date_add(F.lit("2020-01-01").cast("date"), (F.col("id") % 1000).cast("int")).alias("transaction_date"),
        F.lit(0.1).alias("amount"),
        F.lit("RUB").alias("currency"),
        F.lit("DEBIT").alias("transaction_type"),
        F.col("id").cast("string").alias("channel"),
    )
    assert dedup_entity(df, TX).count() == 2 * n // 3 + 1
    top = transactions_by_client(df).orderBy(F.col("transaction_count").desc()).first()
    assert (top.client_id, top.transaction_count, top.total_transaction_amount) == ("C0", n // 3, 2000.0)
    newest = newest_per_key(df, ["client_id"], "transaction_date").where("client_id = 'C0'").first()
    assert newest.transaction_date == date(2022, 9, 26)
