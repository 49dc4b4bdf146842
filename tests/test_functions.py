import datetime as dt

from pyspark.sql import functions as F

from fareline.functions.expressions import (
    airport_label,
    hour_floor,
    minute_boundaries,
    months_touched,
    payment_code,
    safe_ratio,
)
from fareline.functions.rounding import round_doubles, round_sql
from fareline.config import AirportRule


def test_payment_code(spark):
    df = spark.createDataFrame([(0,), (7,), (None,), (1,), (6,)], "p smallint")
    assert [r[0] for r in df.select(payment_code("p")).collect()] == [5, 5, 5, 1, 6]


def test_minute_boundaries(spark):
    a = dt.datetime(2024, 1, 1, 0, 0, 59)
    rows = [(a, dt.datetime(2024, 1, 1, 0, 1, 1)), (a, a), (dt.datetime(2024, 1, 1, 23, 59, 59), dt.datetime(2024, 1, 2, 0, 0, 0))]
    df = spark.createDataFrame(rows, "a timestamp_ntz, b timestamp_ntz")
    assert [r[0] for r in df.select(minute_boundaries("a", "b")).collect()] == [1, 0, 1]


def test_minute_boundaries_independent_of_session_zone(spark):
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        a, b = dt.datetime(2024, 3, 10, 1, 59, 30), dt.datetime(2024, 3, 10, 3, 0, 10)  # DST gap locally
        df = spark.createDataFrame([(a, b)], "a timestamp_ntz, b timestamp_ntz")
        assert df.select(minute_boundaries("a", "b")).collect()[0][0] == 61
        assert df.select(hour_floor("b")).collect()[0][0] == dt.datetime(2024, 3, 10, 3, 0)
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_safe_ratio_zero_is_null(spark):
    df = spark.createDataFrame([(1.0, 0.0), (1.0, None), (3.0, 2.0)], "a double, b double")
    assert [r[0] for r in df.select(safe_ratio("a", "b")).collect()] == [None, None, 1.5]


def test_airport_label_order_and_wildcards(spark):
    rule = AirportRule()
    df = spark.createDataFrame([("JFK Airport",), ("LaGuardia Airport",), ("Newark Airport",), ("Midtown",)], "z string")
    assert [r[0] for r in df.select(airport_label("z", rule)).collect()] == ["JFK", "LGA", "EWR", None]


def test_months_touched(spark):
    df = spark.createDataFrame([(dt.date(2024, 1, 20), dt.date(2024, 3, 2))], "a date, b date")
    assert df.select(months_touched("a", "b")).collect()[0][0] == ["2024-01", "2024-02", "2024-03"]


def test_rounding_same_as_sql(spark):
    import duckdb

    vals = [20.3203125, 20.32031249999999, 2.675, -1.005, 1234567.125, None]
    df = spark.createDataFrame([(v,) for v in vals], "avg_x double")
    got = [r[0] for r in round_doubles(df).collect()]
    con = duckdb.connect()
    sql = "select " + round_sql("avg_x") + " from (values " + ", ".join(f"({v if v is not None else 'null'}::double)" for v in vals) + ") t(avg_x)"
    assert got == [r[0] for r in con.execute(sql).fetchall()]


def test_fractional_minutes_in_dst_gap(spark):
    from fareline.functions.expressions import fractional_minutes

    spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
    try:
        rows = [(dt.datetime(1995, 4, 2, 2, 49), dt.datetime(1995, 4, 2, 3, 28)),  # starts inside the gap
                (dt.datetime(2024, 1, 1, 0, 0, 0, 500000), dt.datetime(2024, 1, 1, 0, 1, 0))]
        df = spark.createDataFrame(rows, "a timestamp_ntz, b timestamp_ntz")
        assert [r[0] for r in df.select(fractional_minutes("a", "b")).collect()] == [39.0, 59.5 / 60.0]
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
