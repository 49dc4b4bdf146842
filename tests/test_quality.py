"""Boundary cases of the bronze QA rules and the silver split (literal rows)."""

import datetime as dt

import pytest

from helpers import T0, frame, trip

from fareline.plans.bronze import bronze_from_raw
from fareline.plans.silver import silver_from_bronze


def bronze_rows(spark, rows):
    # distinct pickup times keep rows from being duplicates of each other
    rows = [dict(r, pickup_at=r["pickup_at"] + dt.timedelta(microseconds=i) if r["pickup_at"] else None)
            for i, r in enumerate(rows)]
    return bronze_from_raw(frame(spark, rows), canonical=True)


def flags(spark, rows, flag):
    df = bronze_rows(spark, rows).orderBy("pickup_at")
    return [r[flag] for r in df.select(flag, "pickup_at").collect()]


def test_distance_outlier_bounds(spark):
    rows = [trip(trip_distance_mi=m) for m in (0.0, 0.01, 150.0, 150.01)]
    assert flags(spark, rows, "qa_outlier_distance") == [True, False, False, True]
    null_row = bronze_rows(spark, [trip(trip_distance_mi=None)]).collect()[0]
    assert null_row["qa_outlier_distance"] is False  # NULL outcome -> false


@pytest.mark.parametrize(
    "seconds,expected",
    [(59, True), (60, False), (360 * 60, False), (360 * 60 + 1, True)],
)
def test_duration_outlier_bounds(spark, seconds, expected):
    r = trip(dropoff_at=T0 + dt.timedelta(seconds=seconds), trip_distance_mi=0.5)
    assert flags(spark, [r], "qa_outlier_speed") == [expected]


def test_speed_outlier_bounds(spark):
    # 60 minutes: speed = miles
    rows = [trip(dropoff_at=T0 + dt.timedelta(hours=1), trip_distance_mi=m) for m in (80.0, 80.1)]
    assert flags(spark, rows, "qa_outlier_speed") == [False, True]


def test_speed_null_without_positive_duration(spark):
    r = bronze_rows(spark, [trip(dropoff_at=T0)]).collect()[0]
    assert r["speed_mph"] is None and r["duration_min"] == 0.0


def test_file_window_ends_inclusive(spark):
    lo = dt.datetime(2023, 12, 30)  # 2024-01-01 - 2 days
    hi = dt.datetime(2024, 2, 3)  # 2024-02-01 + 2 days
    rows = [
        trip(pickup_at=lo, dropoff_at=lo + dt.timedelta(minutes=10)),
        trip(pickup_at=hi - dt.timedelta(minutes=10), dropoff_at=hi),
        trip(pickup_at=hi - dt.timedelta(minutes=10), dropoff_at=hi + dt.timedelta(microseconds=1)),
    ]
    df = bronze_from_raw(frame(spark, rows), canonical=True)
    got = sorted((r["dropoff_at"], r["qa_in_file_window"]) for r in df.collect())
    assert [g[1] for g in got] == [True, True, False]


def test_fare_mismatch_tolerance(spark):
    # manual total is 29.0
    rows = [trip(total_amount=28.5), trip(total_amount=29.75), trip(total_amount=None)]
    df = bronze_rows(spark, rows)
    got = {r["total_amount"]: r["qa_is_fare_mismatch"] for r in df.collect()}
    assert got == {28.5: False, 29.75: True, None: False}


def test_adjustment_rule(spark):
    rows = [
        trip(tip_amount=-1.0, total_amount=24.0),
        trip(fare_amount=-1.0, total_amount=8.0),
        trip(payment_type=3),
        trip(payment_type=4),
        trip(payment_type=6),
        trip(payment_type=2),
    ]
    assert flags(spark, rows, "qa_is_adjustment") == [False, True, True, True, True, False]


def test_manual_total_treats_null_as_zero(spark):
    r = bronze_rows(spark, [trip(airport_fee=None, cbd_congestion_fee=None)]).collect()[0]
    assert r["manualTotal"] == pytest.approx(29.0)


def split_of(spark, rows):
    s = silver_from_bronze(bronze_rows(spark, rows)).orderBy("pickup_at")
    return [(r["silver_split"], r["qa_is_fare_mismatch"]) for r in s.collect()]


@pytest.mark.parametrize("loc", [0, -1, None])
def test_rejected_locations(spark, loc):
    assert split_of(spark, [trip(pu_location_id=loc)])[0][0] == "rejected"
    assert split_of(spark, [trip(do_location_id=loc)])[0][0] == "rejected"


def test_outlier_with_mismatch_stays_clean(spark):
    r = trip(trip_distance_mi=200.0, total_amount=35.0)
    assert split_of(spark, [r]) == [("trips_clean", True)]


def test_split_precedence(spark):
    rows = [
        trip(total_amount=None, payment_type=3),  # rejected before admin
        trip(payment_type=4, trip_distance_mi=0.0),  # admin before anomaly
        trip(trip_distance_mi=0.0),  # anomaly
        trip(),  # clean
    ]
    assert [s for s, _ in split_of(spark, rows)] == ["rejected", "trips_admin", "trips_anomalies", "trips_clean"]


def test_missing_columns_raise_contract_error(spark):
    from fareline.operators.normalize import check_contract

    df = bronze_rows(spark, [trip()]).drop("dup_key")
    with pytest.raises(ValueError, match="missing columns"):
        check_contract(df, [*df.columns, "dup_key"])
