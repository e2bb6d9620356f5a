"""What the optimizer makes of the operators."""

import re

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from clientlens.operators.cleaning import clean
from clientlens.operators.dedup import dedup_entity
from clientlens.operators.offers import expand_offers, offers_with_ids
from clientlens.operators.quality import split_quality
from clientlens.operators.segmentation import combine_segments, latest_snapshot, segment_clients
from clientlens.plans import reports
from clientlens.schemas import ENTITIES
from clientlens.sources import envelope, layers as io
from workload.adapters import ADAPTERS, spark_entity
from workload.queries import UNEVEN, all_queries, co_located, combined, snapshot_by_run


def physical(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def final(df) -> str:
    """Plan after adaptive execution."""
    df.write.format("noop").mode("overwrite").save()
    df.collect()
    return physical(df)


@pytest.fixture(scope="module")
def stored(spark, tiny, tmp_path_factory):
    """The entities as plain Parquet tables, as the structured layer has them."""
    layers = io.Layers(str(tmp_path_factory.mktemp("stored")))
    for name in ADAPTERS:
        io.write_full_refresh(spark_entity(spark, tiny, name), layers.structured(ENTITIES[name]))
    return {n: io.read_structured(spark, layers.structured(e), e) for n, e in ENTITIES.items()}


@pytest.fixture()
def shuffled(spark):
    """Joins as they are when no side is small enough to broadcast."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_no_python_and_no_cross_join(spark, tiny):
    # All queries that run no job of their own before their result is asked for.
    kinds = "clean_|json_round_trip_|quality_split_|dedup_|agg_|client_segmentation|combined|targeted|segment|offers_by|top_|priority|daily|table_counts|replace_latest|sum_merge"
    for name in (n for n in all_queries() if re.match(kinds, n)):
        plan = physical(entry.queries()[name](spark, tiny))
        assert not re.search(r"Python|ArrowEval|MapInPandas|CartesianProduct|NestedLoop", plan), name


def test_dedup_limits_before_the_shuffle(stored):
    plan = physical(dedup_entity(stored["payments"], ENTITIES["payments"]))
    limits = [m.start() for m in re.finditer("WindowGroupLimit", plan)]
    assert len(limits) == 2 and limits[0] < plan.index("Exchange hashpartitioning") < limits[1]


def test_segmentation_shuffles_each_input_once(stored, shuffled):
    plan = physical(segment_clients(stored, "2024-06-30"))
    assert plan.count("Exchange hashpartitioning(client_id") == 6
    assert plan.count("SortMergeJoin") == 5
    # Partial aggregation on both sides of each fact's exchange.
    assert plan.count("HashAggregate") == 10
    assert "SinglePartition" not in plan


def test_aggregates_read_only_their_columns(stored):
    plan = physical(segment_clients(stored, "2024-06-30"))
    schemas = re.findall(r"ReadSchema: struct<([^>]*)>", plan)
    assert "client_id:string,amount:double" in schemas
    assert "client_id:string,success:boolean" in schemas
    assert "client_id:string,quantity:int,current_price:double" in schemas


def test_offers_need_no_shuffle_and_no_join(stored):
    clients = spark_clients(stored)
    plan = physical(expand_offers(clients))
    assert "Exchange" not in plan and "Join" not in plan and "Generate inline" in plan


def spark_clients(stored):
    return stored["clients"].select(
        "client_id",
        "client_name",
        *[F.col("segment").alias(c) for c in ("portfolio_segment", "transaction_segment", "combined_segment")],
        F.lit(1.0).alias("total_value"),
        F.lit(1).alias("priority_level"),
    )


def test_top_clients_sorts_only_ten_rows(stored):
    plan = physical(reports.top_clients(expand_offers(spark_clients(stored))))
    assert "TakeOrderedAndProject(limit=10" in plan and "rangepartitioning" not in plan


def test_report_scans_the_table_twice_only(stored, shuffled):
    seg = segment_clients(stored, "2024-06-30")
    plan = final(reports.segmentation_report(seg))
    done = plan.split("== Initial Plan ==")[0]
    assert done.count("ReusedExchange") >= 1


def test_message_is_parsed_once(spark, stored):
    e = ENTITIES["client_logins"]
    messages = envelope.to_messages(stored["client_logins"], e.topic).select("topic", "value")
    messages.write.mode("overwrite").parquet(f"{spark.conf.get('spark.checkpoint.dir')}/parse-once")
    stored_messages = spark.read.schema("topic string, value string").parquet(
        f"{spark.conf.get('spark.checkpoint.dir')}/parse-once"
    )
    rows, bad = envelope.read_messages(stored_messages, e)
    assert physical(rows).count("from_json(") == 1
    assert physical(bad).count("from_json(") == 1


def test_quality_rules_are_evaluated_once_over_computed_columns(stored):
    e = ENTITIES["bank_transactions"]
    plan = physical(split_quality(clean(stored["bank_transactions"], e), e)[0])
    assert plan.count("length(transaction_id") == 1


def test_snapshot_prunes_dates(spark, stored):
    path = f"{spark.conf.get('spark.checkpoint.dir')}/history"
    for day in ("2024-06-29", "2024-06-30"):
        io.write_segmentation(segment_clients(stored, day), path)
    plan = physical(combine_segments(latest_snapshot(io.read_segmentation(spark, path))))
    filters = re.findall(r"PartitionFilters: \[([^\]]*)\]", plan)
    assert any("processing_date" in f and "ubquery" in f for f in filters)
    assert "city" not in re.findall(r"ReadSchema: struct<([^>]*)>", plan)[0]


def test_writing_one_date_needs_no_sort(spark, stored, tmp_path):
    store = spark._jsparkSession.sharedState().statusStore()
    io.write_cleaned(stored["payments"], str(tmp_path / "c"), "2024-06-30")
    runs = store.executionsList()
    plans = [runs.apply(i).physicalPlanDescription() for i in range(runs.size())]
    last = [p for p in plans if "InsertIntoHadoopFsRelationCommand" in p][-1]
    assert "Sort" not in last.split("(1)")[0]


def test_bucketed_tables_are_joined_where_they_lie(spark, tiny, shuffled):
    plan = physical(segment_clients(co_located(spark, tiny), "2024-06-30", "2024-06-30 12:00:00"))
    assert plan.count("Join") == 5 and "Exchange" not in plan
    # Spread over several buckets, a client's facts are aggregated in each before they are exchanged.
    plan = physical(segment_clients(co_located(spark, tiny, salts=4), "2024-06-30", "2024-06-30 12:00:00"))
    after = [line for above, line in zip(plan.splitlines(), plan.splitlines()[1:]) if "Exchange hashpartitioning" in above]
    assert len(after) == 5 and all("partial_" in line for line in after)


def test_dates_of_runs_prune_folders_while_the_query_runs(spark, tiny):
    assert "dynamicpruning" in physical(snapshot_by_run(spark, tiny))


def test_clustered_files_are_skipped_by_each_filter(spark, tmp_path):
    import pyarrow.parquet as pq

    names = io.SEGMENTATION.names
    rows = spark.range(4000).selectExpr(
        "cast(id as string) AS client_id", "concat('S', id % 4) AS segment", "concat('C', id div 7 % 30) AS city",
        "if(id % 3 = 0, 'Active', 'Inactive') AS status",
    )
    rows = rows.selectExpr(*[n if n in rows.columns else f"cast(NULL AS {io.SEGMENTATION[n].dataType.simpleString()}) AS {n}" for n in names])
    io.write_clustered(rows, f"{tmp_path}/t", "2024-06-30", files=16)
    found = list((tmp_path / "t").rglob("*.parquet"))

    def kept(column, value):
        index = pq.read_schema(found[0]).names.index(column)
        stats = [pq.ParquetFile(f).metadata.row_group(0).column(index).statistics for f in found]
        return sum(s.min <= value <= s.max for s in stats)

    assert len(found) == 16
    assert kept("segment", "S2") <= 8 and kept("city", "C17") <= 8 and kept("status", "Active") <= 10


def test_uneven_offers_sort_and_stage_clients_only(spark, tiny):
    df = offers_with_ids(combined(spark, tiny), UNEVEN)
    plan = physical(df)
    assert plan.index("Generate inline") < plan.index("Window")
    staged = {f.rsplit("/", 1)[0] for f in df.inputFiles() if "/ordinal-" in f and "-offsets" not in f}
    (folder,) = staged
    columns = spark.read.parquet(folder).columns
    assert "client_id" in columns and "offer_type" not in columns and len(columns) <= 12
