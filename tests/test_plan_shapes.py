"""Physical-plan properties the design relies on (checked on the planned queries)."""

import os
import tempfile
import time

import pytest

from helpers import SF001

from fareline.operators import insights as B
from fareline.plans import registry, tpch_trips
from fareline.plans.store import Store
from fareline.plans.warehouse import build_marts, write_warehouse
from fareline.sources import fixture

FORBIDDEN = ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython", "PythonUDF", "ExistingRDD")


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(registry.QUERIES))
def test_no_cross_joins_python_or_row_checkpoints(spark, name):
    plan = plan_of(registry.QUERIES[name](spark, SF001))
    small = name in ("raw_file_report", "raw_schema_families")  # a report's rows, made from the build's counters
    for bad in FORBIDDEN:
        assert bad not in plan or (small and bad == "ExistingRDD"), f"{name}: {bad}"


def test_queries_are_cheap_to_construct_once_layers_are_built(spark):
    names = [n for n in registry.QUERIES if n not in ("check_results", "strict_check_results", "table_profile", "table_columns", "table_relationships")]
    for n in names:
        registry.QUERIES[n](spark, SF001)
    t = time.perf_counter()
    for n in ("dim_vendor", "fact_trips", "mart_kpi_daily", "stg_trips"):
        registry.QUERIES[n](spark, SF001)
    assert time.perf_counter() - t < 4 * 0.25


def test_small_key_set_is_met_in_a_broadcast_anti_join(spark):
    """Default bronze: rows meet the written repeated-key set map-side; no row shuffle, no sort."""
    plan = plan_of(tpch_trips.bronze(spark, SF001))
    assert "Window" not in plan and "SortAggregate" not in plan
    assert "BroadcastHashJoin" in plan and "LeftAnti" in plan


def test_dedup_aggregate_is_a_partial_aggregate_not_a_window(spark):
    from fareline.plans.bronze import bronze_from_raw
    from fareline.sources import fixture

    plan = plan_of(bronze_from_raw(fixture.raw_trips(spark, SF001), canonical=True, dedup="aggregate"))
    assert "Window" not in plan
    assert plan.count("SortAggregate") + plan.count("HashAggregate") >= 2  # partial + final
    assert "partial_count" in plan


def test_repeated_key_set_is_a_hash_aggregate(spark):
    from fareline.operators.dedup import duplicate_keys
    from fareline.sources import fixture

    plan = plan_of(duplicate_keys(fixture.raw_trips(spark, SF001)))
    assert "HashAggregate" in plan and "SortAggregate" not in plan and "partial_count" in plan


def test_written_fact_is_pruned_by_month(spark):
    wh = tpch_trips.warehouse(spark, SF001, materialize="silver")
    out = tempfile.mkdtemp(prefix="fareline-shape-")
    built = write_warehouse(spark, wh, out, fixture.vendors(spark), fixture.payment_types(spark),
                            fixture.zones(spark, SF001), airport=fixture.FIXTURE_AIRPORTS)
    assert any(x.startswith("date_month=") for x in Store(spark, out).tables()["fact_trips"].units)
    w = B.reporting_window(built["mart_kpi_daily"], 30)
    q = B.vendor_cards(built["fact_trips"], built["dim_vendor"], w)
    text = q._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(date_month" in text or "date_month" in text.split("PartitionFilters")[1]
    assert len(q.collect()) <= 2


def test_marts_read_only_needed_columns(spark):
    wh = tpch_trips.warehouse(spark, SF001, materialize=None)
    plan = plan_of(wh["mart_kpi_daily"])
    scans = [line for line in plan.splitlines() if "ReadSchema" in line and "lineitem" in line]
    assert scans and all("l_extendedprice" not in s and "l_comment" not in s for s in scans)


def test_built_dimensions_are_broadcast_from_the_first_plan(spark):
    """Written dims carry file statistics, so the planner broadcasts them before any runtime re-plan."""
    wh = tpch_trips.warehouse(spark, SF001, materialize="gold")
    marts = build_marts(wh["fact_trips"], wh["fact_revenue_adjustments"], wh["dim_zone"], fixture.FIXTURE_AIRPORTS)
    initial = marts["mart_airport_daily"]._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in initial and "SortMergeJoin" not in initial


def test_profile_reads_no_data_page(spark):
    """Row counts and date ranges come from Parquet footers."""
    plan = plan_of(registry.QUERIES["table_profile"](spark, SF001))
    scans = [x for x in plan.splitlines() if "BatchScan" in x]
    assert scans and all("PushedAggregation: [COUNT(*)" in x for x in scans) and "FileScan" not in plan
    assert sum("MIN(date_day), MAX(date_day)" in x for x in scans) == 10


def test_a_session_of_others_runs_no_method_too_long_to_compile(spark):
    """Bronze and silver hold sessions made elsewhere to methods that the JVM compiles."""
    from fareline.plans.bronze import bronze_from_raw
    from fareline.plans.silver import silver_from_bronze

    key = "spark.sql.codegen.hugeMethodLimit"
    plain = spark.newSession()
    plain.conf.set(key, "65535")
    bronze = bronze_from_raw(fixture.raw_trips(plain, SF001), canonical=True, dedup="aggregate")
    assert plain.conf.get(key) == "8000"
    plain.conf.set(key, "65535")
    silver_from_bronze(bronze)
    assert plain.conf.get(key) == "8000"
    plain.conf.set(key, "4000")  # a lower limit is left alone
    silver_from_bronze(bronze)
    assert plain.conf.get(key) == "4000"
