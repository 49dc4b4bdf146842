"""Writers, readers, views, catalog listing and small rule helpers."""

import datetime as dt
import os
import tempfile

from pyspark.sql import functions as F

from helpers import T0, frame, trip

from fareline.config import BRONZE_COLUMNS, REQUIRED_FOR_ROW
from fareline.functions.expressions import is_near
from fareline.operators.catalog import column_report, list_catalog_tables
from fareline.operators.dedup import add_alt_dup_key
from fareline.operators.quality import classify_rows, missing_critical
from fareline.plans.bronze import bronze_from_raw, write_bronze
from fareline.plans.silver import read_silver, read_split, silver_from_bronze, silver_report, splits, write_silver
from fareline.plans.store import Store, read_table
from fareline.plans.warehouse import register_views
from fareline.plans import tpch_trips

from helpers import SF001


def test_bronze_and_silver_writers_round_trip(spark):
    rows = [trip(pickup_at=T0 + dt.timedelta(seconds=i)) for i in range(5)] + [
        trip(pu_location_id=0), trip(payment_type=3, pickup_at=T0 + dt.timedelta(seconds=30))]
    bronze = bronze_from_raw(frame(spark, rows), canonical=True)
    d = tempfile.mkdtemp(prefix="fareline-w-")
    counters = write_bronze(bronze, os.path.join(d, "bronze"))
    assert counters == {"rows_written": 7}
    assert list(Store(spark, os.path.join(d, "bronze")).tables()["rows"].units) == ["source_year=2024/source_month=1/source_file=trips_2024-01.parquet"]
    back = read_table(spark, os.path.join(d, "bronze"))
    assert set(back.columns) == set(BRONZE_COLUMNS)
    silver = silver_from_bronze(back.select(*BRONZE_COLUMNS))
    write_silver(silver, os.path.join(d, "silver"))
    assert read_split(read_silver(spark, os.path.join(d, "silver")), "trips_clean").count() == 5
    assert read_split(read_silver(spark, os.path.join(d, "silver")), "rejected").count() == 1
    assert read_split(read_silver(spark, os.path.join(d, "silver")), "trips_admin").count() == 1
    parts = splits(silver)
    assert {k: v.count() for k, v in parts.items()} == {
        "rejected": 1, "trips_admin": 1, "trips_anomalies": 0, "trips_clean": 5, "trips_fare_miss": 0}
    counts, cov = silver_report(silver)
    assert cov.collect()[0]["coverage_ok"] is True


def test_views_and_catalog_listing(spark):
    wh = tpch_trips.warehouse(spark, SF001, materialize="gold")
    names = register_views(spark, wh)
    assert "fact_trips" in names
    assert spark.sql("select count(*) from gold_fact_trips").collect()[0][0] == wh["fact_trips"].count()
    listed = {t for _, t, _ in list_catalog_tables(spark, ["default"])}
    assert {"gold_fact_trips", "marts_mart_kpi_daily"} <= listed
    cols = column_report({"dim_zone": wh["dim_zone"]}, {"dim_zone": "gold"}).orderBy("ordinal").collect()
    assert [c["column_name"] for c in cols] == ["location_id", "borough", "zone", "service_zone"]
    assert cols[0]["data_type"] == "int" and cols[0]["table_schema"] == "gold"


def test_alt_key_and_near(spark):
    df = frame(spark, [trip(), trip(tip_amount=9.0), trip(payment_type=2)])
    keys = [r["dup_key"] for r in add_alt_dup_key(df).collect()]
    assert keys[0] == keys[1] != keys[2]  # tip is not in the key, payment type is
    near = spark.createDataFrame([(10.0, 10.02), (10.0, 10.03)], "a double, b double").select(is_near("a", "b"))
    assert [r[0] for r in near.collect()] == [True, False]


def test_required_columns_option_and_classify(spark):
    b = bronze_from_raw(frame(spark, [trip(vendor_id=None), trip(pickup_at=T0 + dt.timedelta(seconds=1))]), canonical=True)
    assert b.where(missing_critical()).count() == 0
    assert b.where(missing_critical(REQUIRED_FOR_ROW)).count() == 1
    c = classify_rows(b.withColumn("qa_in_file_window", F.lit(None).cast("boolean"))).collect()
    assert all(r["is_anomaly"] for r in c)  # NULL window flag counts as out of window
    assert not any(r["is_rejected_missing"] or r["is_admin_issue"] or r["is_fare_mismatch"] for r in c)


def test_run_bronze_and_silver_report_in_one_job(spark):
    from test_normalize import _raw_cols, _write
    from fareline.plans.bronze import run_bronze
    from fareline.plans.silver import run_silver

    d = tempfile.mkdtemp(prefix="fareline-run-")
    raw = os.path.join(d, "raw")
    os.makedirs(raw)
    cols = _raw_cols(4, dt.datetime(2024, 1, 3))
    cols["tpep_pickup_datetime"] = cols["tpep_pickup_datetime"].take([0, 0, 2, 3])
    cols["tpep_dropoff_datetime"] = cols["tpep_dropoff_datetime"].take([0, 0, 2, 3])
    _write(os.path.join(raw, "yellow_tripdata_2024-01.parquet"), cols)
    _write(os.path.join(raw, "yellow_tripdata_2024-02.parquet"), _raw_cols(3, dt.datetime(2024, 2, 3)))
    rep = run_bronze(spark, raw, os.path.join(d, "bronze"))
    assert rep == {"files": 2, "rows_in": 7, "rows_written": 5, "duplicates_removed": 2}
    srep = run_silver(read_table(spark, os.path.join(d, "bronze")), os.path.join(d, "silver"))
    assert srep["total_rows"] == 5 and srep["trips_clean"] == 5 and srep["coverage_ok"] is True


def test_register_catalog_tables(spark):
    from fareline.plans.warehouse import register_tables, write_warehouse
    from fareline.sources import fixture

    d = tempfile.mkdtemp(prefix="fareline-cat-")
    wh = tpch_trips.warehouse(spark, SF001, materialize="silver")
    built = write_warehouse(spark, wh, d, fixture.vendors(spark), fixture.payment_types(spark),
                            fixture.zones(spark, SF001), airport=fixture.FIXTURE_AIRPORTS)
    names = register_tables(spark, d)
    assert "gold.fact_trips" in names and "marts.mart_kpi_daily" in names
    assert spark.table("gold.fact_trips").count() == built["fact_trips"].count()
    listed = list_catalog_tables(spark, ["gold", "marts"])
    assert ("gold", "dim_zone", "EXTERNAL") in listed
    # partition pruning through the catalog table
    plan = spark.table("gold.fact_trips").where("date_month = '1996-03'")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(date_month" in plan


def test_write_warehouse_with_rebalance_option(spark):
    from fareline.plans.warehouse import write_warehouse
    from fareline.sources import fixture

    d = tempfile.mkdtemp(prefix="fareline-rb-")
    wh = tpch_trips.warehouse(spark, SF001, materialize="silver")
    built = write_warehouse(spark, wh, d, fixture.vendors(spark), fixture.payment_types(spark),
                            fixture.zones(spark, SF001), airport=fixture.FIXTURE_AIRPORTS, rebalance=True)
    store = Store(spark, d)
    fact = store.tables()["fact_trips"]
    months = [store.folder("fact_trips", fact, u) for u in fact.units if u.startswith("date_month=")]
    assert months and built["fact_trips"].count() == wh["fact_trips"].count()
    files = sum(len([f for f in os.listdir(m) if f.endswith(".parquet")]) for m in months)
    assert files == len(months)  # rebalanced: one file per month at this size


def test_file_builds_can_run_again_after_a_failure(spark, monkeypatch):
    import pytest

    rules = tpch_trips.QaRules(near_eps=0.03)  # layers of its own
    whole_bronze, whole_refresh = tpch_trips.run_bronze, tpch_trips.refresh
    calls = []

    def once(fn):
        def run(*args, **kw):
            calls.append(fn.__name__)
            if calls.count(fn.__name__) == 1:
                raise RuntimeError("stopped")
            return fn(*args, **kw)

        return run

    monkeypatch.setattr(tpch_trips, "run_bronze", once(whole_bronze))
    monkeypatch.setattr(tpch_trips, "refresh", once(whole_refresh))
    for build in (tpch_trips.file_build, tpch_trips.incremental_build):
        with pytest.raises(RuntimeError, match="stopped"):
            build(spark, SF001, rules)
        assert build(spark, SF001, rules)


def test_file_queries_in_a_session_without_the_librarys_settings(spark, monkeypatch):
    """One query after the other in a plain session: the nanosecond family is read, and none trips over another's files."""
    from fareline.plans.registry import QUERIES

    monkeypatch.setattr(tpch_trips, "_BUILDS", {})
    plain = spark.newSession()
    plain.conf.set("spark.sql.legacy.parquet.nanosAsLong", "false")
    report = QUERIES["raw_file_report"](plain, SF001).first()
    families = QUERIES["raw_schema_families"](plain, SF001).collect()
    assert len(families) == 5 and sum(r["files"] for r in families) == report["files"]
    bronze = QUERIES["bronze_from_files"](plain, SF001)
    assert bronze.count() == report["rows_written"] == report["rows_in"] - report["duplicates_removed"]
    # the last query opens the raw files again: nanosecond times lose nothing
    lost = {r["source_file"] for r in QUERIES["cast_losses"](plain, SF001).select("source_file").collect()}
    assert lost and not any(int(name[-10:-8]) % 5 == 1 for name in lost)
