"""What the plans must look like for inputs that do not fit one task."""

import pytest
from conftest import SMALL, settings
from pyspark.sql import functions as F

from lapstar.operators import facts, results
from lapstar.plans import reports
from lapstar.session import save, shared_folder
from lapstar.sources.files import read_results
from workload.queries import QUERIES
from workload.staging import AS_OF, GATES, SRC, raw_results, results_folder, warehouse


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


REPORTS = [
    "swimmer_rankings", "club_region_performance", "swimmer_demographics", "olympic_cuts", "last_five_rankings",
    "olympic_qualifications", "olympic_qualified_swimmers", "qualified_summary",
]
LAZY = [
    *REPORTS, "eligible_entries", "parse_results", "project_swimmers", "distinct_events", "event_places", "event_top5",
    "place_counts", "personal_bests", "rolling_history", "rankings_summary", "top_entries", "scd2_snapshot",
    "build_performance", "fact_rankings", "surrogate_keys", "scan_results_csv", "dq_foreign_key",
]


@pytest.mark.parametrize("name", LAZY)
def test_no_python_and_no_all_pairs(spark, name):
    text = plan(QUERIES[name](spark, SMALL))
    for word in ("Python", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert word not in text


@pytest.mark.parametrize("name", [n for n in LAZY if n not in ("build_performance", "fact_rankings", "surrogate_keys")])
def test_no_step_gathers_all_rows(spark, name):
    assert "SinglePartition" not in plan(QUERIES[name](spark, SMALL))


@pytest.mark.parametrize("name", ["build_performance", "fact_rankings", "surrogate_keys"])
def test_numbering_gathers_only_partition_sizes(spark, name):
    text = plan(QUERIES[name](spark, SMALL))
    assert text.count("SinglePartition") == 1
    below = text[text.index("SinglePartition"):]
    assert "HashAggregate" in below.splitlines()[1]


TOP_K = ["event_top5", "place_counts", "top_entries", "last_five_rankings", "swimmer_rankings"]


@pytest.mark.parametrize("name", TOP_K)
def test_top_k_is_cut_before_the_shuffle(spark, name):
    text = plan(QUERIES[name](spark, SMALL))
    assert "WindowGroupLimit" in text and "Partial" in text


def test_columns_are_pruned_and_filters_pushed(spark):
    wh = warehouse(spark, SMALL)
    cuts = plan(reports.olympic_cuts(wh, GATES))
    assert "fact_swimming_performance" not in cuts
    assert "PushedFilters: [IsNotNull(is_current), EqualTo(is_current,true)" in cuts
    scan = next(line for line in plan(reports.swimmer_rankings(wh)).splitlines() if "fact_swimming" in line)
    schema = scan[scan.index("ReadSchema"):]
    assert "time_seconds" in schema and "performance_id" not in schema and "age" not in schema


def test_csv_columns_are_pruned(spark):
    text = plan(read_results(spark, results_folder(spark, SMALL)).groupBy("Event").agg(F.min("Time")))
    assert "ReadSchema: struct<Event:string,Time:string>" in text


NO_BROADCAST = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
}


def test_results_do_not_depend_on_broadcasts(spark):
    wh = warehouse(spark, SMALL)
    small = {tuple(r) for r in reports.olympic_qualified_swimmers(wh, AS_OF, GATES).collect()}
    with settings(spark, NO_BROADCAST):
        large = reports.olympic_qualified_swimmers(wh, AS_OF, GATES)
        assert "BroadcastHashJoin" not in plan(large) and "SortMergeJoin" in plan(large)
        assert {tuple(r) for r in large.collect()} == small


def test_hot_keys_of_the_fact_join_are_split(spark):
    """Without broadcasts, a swimmer with a third of all rows must not become one task."""
    wh = warehouse(spark, SMALL)
    copies = raw_results(spark, SMALL).withColumn("copy", F.explode(F.sequence(F.lit(1), F.lit(3))))
    hot = F.when(F.col("copy") == 1, F.lit("SWM000000007")).otherwise(F.col("SwimmerId"))
    skewed = save(copies.withColumn("SwimmerId", hot))
    small_steps = {
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10KB",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.sql.shuffle.partitions": "24",
    }
    with settings(spark, {**NO_BROADCAST, **small_steps}):
        swims = facts.performance(skewed, wh.swimmers, wh.events, wh.competitions, [*SRC, "copy"], False)
        assert len(swims.collect()) == skewed.count()
        joins = [line for line in plan(swims).splitlines() if "SortMergeJoin" in line]
        assert "skew=true" in next(line for line in joins if "swimmer_id" in line)


def test_places_equal_the_staged_places(spark):
    placed = results.places(raw_results(spark, SMALL), SRC)
    assert placed.filter(~F.col("place").eqNullSafe(F.col("Overall_Rank").cast("bigint"))).isEmpty()


def test_written_tables_go_to_the_shared_folder(spark):
    folder = spark.conf.get("spark.checkpoint.dir")
    assert shared_folder(spark).startswith(folder)
    assert all(folder in f for f in raw_results(spark, SMALL).inputFiles())
