
import re
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from clientlens.operators.offers import offers_with_ids
from clientlens.operators.segmentation import combine_segments, segment_clients
from clientlens.plans.reports import segment_drift

TEXT = (Path(__file__).resolve().parents[1] / "FIXTURES.md").read_text()
ADAPTERS = dict(re.findall(r"<!-- adapter:(\w+) -->\n```sql\n(.*?)```", TEXT, re.S))
TABLES = ["customer", "nation", "orders", "events", "lineitem", "part"]

# The listed counts at scale 0.01.
SEGMENTS = {"VIP": 131, "Premium": 630, "Standard": 511, "Basic": 228}
COMBINED = {
    "VIP Active": 96,
    "VIP Passive": 35,
    "Premium Active": 40,
    "Premium Passive": 590,
    "Standard Active": 62,
    "Standard Passive": 449,
    "Transaction Only": 153,
    "Low Engagement": 75,
}


@pytest.fixture(scope="module")
def segmented(spark, small):
    for t in TABLES:
        spark.read.parquet(f"{small}/{t}.parquet").createOrReplaceTempView(t)
    entities = {name: spark.sql(sql) for name, sql in ADAPTERS.items()}
    return segment_clients(entities, "2024-06-30", "2024-06-30 00:00:00").cache()


def counts(df, column):
    return {r[0]: r[1] for r in df.groupBy(column).count().collect()}


def test_segments(segmented):
    assert counts(segmented, "segment") == SEGMENTS


def test_combined_segments(segmented):
    assert counts(combine_segments(segmented), "combined_segment") == COMBINED


def test_special_clients(segmented):
    row = segmented.agg(
        F.count_if(F.expr("segment = 'Premium' AND total_transaction_amount < 100000")),
        F.count_if(F.expr("transaction_count = 0")),
        F.count_if(F.expr("portfolio_count = 0")),
        F.count_if(F.expr("total_transaction_amount > 1000000")),
        F.count_if(F.expr("total_transaction_amount > 500000 AND total_transaction_amount <= 1000000")),
        F.count_if(F.expr("total_transaction_amount < 50000")),
    ).first()
    assert tuple(row) == (19, 75, 554, 57, 72, 229)


def test_drift(segmented):
    assert counts_of(segment_drift(segmented)) == {"Segments matched": 528, "Segments changed": 942}


def counts_of(df):
    return {r[0]: r[1] for r in df.collect()}


def test_offers(segmented):
    offers = offers_with_ids(combine_segments(segmented))
    row = offers.agg(F.count("*"), F.sum("expected_revenue"), F.countDistinct("offer_id")).first()
    assert tuple(row) == (4500, 39_016_850, 4500)
