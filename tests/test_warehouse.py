"""Invariants of the star schema and marts over the sf0.001 driver tables."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from helpers import SF001
from fareline.operators.marts import count_true, mart_airport_daily, mart_kpi_daily
from fareline.plans import tpch_trips


@pytest.fixture(scope="module")
def wh(spark):
    return tpch_trips.warehouse(spark, SF001, materialize="gold")


def test_splits_partition_the_deduplicated_rows(spark):
    s = tpch_trips.silver(spark, SF001)
    counts = {r[0]: r[1] for r in s.groupBy("silver_split").count().collect()}
    assert counts == {"rejected": 212, "trips_admin": 718, "trips_anomalies": 610, "trips_clean": 4362}
    assert s.where("silver_split = 'trips_clean' and qa_is_fare_mismatch").count() == 151
    assert tpch_trips.bronze(spark, SF001).count() == sum(counts.values())


def test_mart_totals_equal_fact_totals(wh):
    fact = wh["fact_trips"].agg(F.count(F.lit(1)), F.sum("total_amount")).collect()[0]
    for name, trips_col, rev_col in [
        ("mart_revenue_daily_zone", "trips", "total_revenue"),
        ("mart_kpi_daily", "trips", "gross_revenue"),
        ("mart_payment_mix_daily", "trips", "revenue"),
        ("mart_vendor_scorecard_monthly", "trips", "revenue"),
        ("mart_od_matrix_monthly", "trips", "revenue"),
        ("mart_trips_hourly_vendor", "trips", "revenue"),
    ]:
        m = wh[name].agg(F.sum(trips_col), F.sum(rev_col)).collect()[0]
        assert m[0] == fact[0], name
        assert m[1] == pytest.approx(fact[1], rel=1e-9), name


def test_shares_sum_to_one(wh):
    for name, group, share in [
        ("mart_payment_mix_daily", "date_day", "share"),
        ("mart_vendor_scorecard_monthly", "year_month", "revenue_share"),
    ]:
        sums = wh[name].groupBy(group).agg(F.sum(share).alias("s")).where(F.abs(F.col("s") - 1) > 1e-9)
        assert sums.count() == 0, name


def test_dim_date_is_continuous_and_covers_facts(wh):
    d = wh["dim_date"].agg(F.min("date_day"), F.max("date_day"), F.count(F.lit(1))).collect()[0]
    f = wh["fact_trips"].agg(F.min("date_day"), F.max("date_day")).collect()[0]
    a = wh["fact_revenue_adjustments"].agg(F.min("date_day"), F.max("date_day")).collect()[0]
    assert d[0] == min(f[0], a[0]) - dt.timedelta(days=2)
    assert d[1] == max(f[1], a[1]) + dt.timedelta(days=2)
    assert d[2] == (d[1] - d[0]).days + 1
    row = wh["dim_date"].where(F.col("date_day") == dt.date(1996, 3, 2)).collect()[0]
    assert (row["day_name"], row["iso_dow"], row["is_weekend"], row["year_month"], row["quarter"]) == (
        "Saturday", 6, True, "1996-03", 1)


def test_payment_codes_in_clean(wh):
    codes = {r[0] for r in wh["fact_trips"].select("payment_type").distinct().collect()}
    assert codes <= {1, 2, 5}


def test_airport_mart_counts_each_direction(spark, wh):
    fact = wh["fact_trips"].select("pu_location_id", "do_location_id").collect()
    zones = {r["location_id"]: r for r in wh["dim_zone"].collect()}

    def label(loc):
        z = zones.get(loc)
        if z is None or z["service_zone"] != "Airports":
            return None
        return {"NATION_3": "N3", "NATION_8": "N8"}.get(z["zone"].upper())

    expected = sum((label(r[0]) is not None) + (label(r[1]) is not None) for r in fact)
    got = wh["mart_airport_daily"].agg(F.sum("trips")).collect()[0][0]
    assert got == expected


def test_count_true_is_null_when_predicate_always_null(spark):
    df = spark.createDataFrame([(1, None), (1, None), (2, 90.0), (2, None)], "g int, speed double")
    got = {r[0]: r[1] for r in df.groupBy("g").agg(count_true(F.col("speed") > 80)).collect()}
    assert got == {1: None, 2: 1}


def test_all_null_airport_fee_sums_to_null(spark):
    zones = spark.createDataFrame([(1, "Queens", "JFK Airport", "Airports")], "location_id int, borough string, zone string, service_zone string")
    fact = spark.createDataFrame(
        [(dt.date(2024, 1, 1), 1, 2, 10.0, 8.0, 1.0, 3.0, None)],
        "date_day date, pu_location_id int, do_location_id int, total_amount double, fare_amount double, "
        "tip_amount double, trip_distance_mi double, airport_fee double",
    )
    r = mart_airport_daily(fact, zones).collect()[0]
    assert (r["airport"], r["direction"], r["trips"], r["airport_fee_total"]) == ("JFK", "PU", 1, None)


def test_zero_denominators_give_null(spark):
    fact = spark.createDataFrame(
        [(dt.date(2024, 1, 1), dt.datetime(2024, 1, 1, 10), dt.datetime(2024, 1, 1, 10), 0.0, 0.0, 0.0, 0.0, 0.0)],
        "date_day date, pickup_at timestamp_ntz, dropoff_at timestamp_ntz, total_amount double, tip_amount double, "
        "congestion_surcharge double, tolls_amount double, trip_distance_mi double",
    )
    adj = spark.createDataFrame([], "date_day date, total_amount double")
    r = mart_kpi_daily(fact, adj).collect()[0]
    assert r["tip_rate"] is None and r["avg_speed_mph"] is None and r["net_revenue"] == 0.0


def test_rebuilds_replace_what_was_there(spark):
    """One file fewer, and a corrected file: bronze, silver and the warehouse hold the new rows alone."""
    import datetime as dt
    import os
    import tempfile

    from test_normalize import _raw_cols, _write

    from fareline.plans.bronze import run_bronze
    from fareline.plans.silver import run_silver
    from fareline.plans.store import read_table
    from fareline.plans.warehouse import build_warehouse, write_warehouse
    from fareline.sources import seeds

    d = tempfile.mkdtemp(prefix="fareline-again-")
    raw, b, s, w = (os.path.join(d, x) for x in ("raw", "bronze", "silver", "warehouse"))
    os.makedirs(raw)
    jan, feb = (os.path.join(raw, f"y_2024-0{m}.parquet") for m in (1, 2))
    zones = spark.createDataFrame([(5, "Queens", "JFK Airport", "Airports")], seeds.ZONE_SCHEMA)

    def build():
        rep = run_bronze(spark, raw, b)
        srep = run_silver(read_table(spark, b), s)
        vendors, payments = seeds.vendors_seed(spark), seeds.payment_types_seed(spark)
        wh = write_warehouse(spark, build_warehouse(read_table(spark, s), vendors, payments, zones), w, vendors, payments, zones)
        kpi = sum(r["trips"] for r in wh["mart_kpi_daily"].collect())
        counts = (rep["rows_written"], read_table(spark, b).count(), read_table(spark, s).count(), wh["fact_trips"].count(), kpi)
        assert srep["coverage_ok"] and srep["total_rows"] == rep["rows_written"]
        return counts

    _write(jan, _raw_cols(10, dt.datetime(2024, 1, 3)))
    _write(feb, _raw_cols(7, dt.datetime(2024, 2, 3)))
    assert build() == (17,) * 5
    os.remove(feb)
    assert build() == (10,) * 5
    _write(jan, _raw_cols(10, dt.datetime(2020, 1, 3)))  # out of the file's window: anomalies
    assert build() == (10, 10, 10, 0, 0)
    _write(jan, _raw_cols(6, dt.datetime(2024, 1, 3)))
    assert build() == (6,) * 5
