"""A group of copies holding a third of all rows: results stay exact, the plan pre-aggregates."""

import datetime as dt

from pyspark.sql import functions as F

from helpers import T0

from fareline.operators.dedup import dedup_in_file, dedup_report
from fareline.operators.marts import mart_revenue_daily_zone


def skewed(spark, n=90_000):
    """n rows; rows with id % 3 == 0 are copies of one trip, the others are all distinct."""
    ids = spark.range(n).repartition(8)
    hot = (F.col("id") % 3) == 0
    cols = {
        "vendor_id": F.lit(1).cast("smallint"),
        "pickup_at": F.when(hot, F.lit(T0)).otherwise(F.lit(T0) + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), F.col("id").cast("decimal(18,6)"))),
        "dropoff_at": F.lit(T0 + dt.timedelta(hours=1)),
        "passenger_count": F.lit(1).cast("smallint"),
        "trip_distance_mi": F.lit(3.0),
        "rate_code_id": F.lit(1).cast("smallint"),
        "store_and_fwd_flag": F.lit("N"),
        "pu_location_id": F.lit(7),
        "do_location_id": F.lit(9),
        "payment_type": F.lit(1).cast("smallint"),
        **{c: F.lit(1.0) for c in ("fare_amount", "extra", "mta_tax", "tip_amount", "tolls_amount",
                                   "improvement_surcharge", "total_amount", "congestion_surcharge", "airport_fee")},
        "cbd_congestion_fee": F.lit(None).cast("double"),
        "source_file": F.lit("trips_2024-01.parquet"),
    }
    return ids.select(*[v.alias(k) for k, v in cols.items()])


def test_hot_group_of_copies_is_dropped_exactly(spark):
    df = skewed(spark)
    out = dedup_in_file(df)
    assert out.count() == 60_000  # every one of the 30,000 copies removed, nothing else
    rep = dedup_report(df).collect()[0]
    assert (rep["rows_in"], rep["duplicates_removed"], rep["rows_written"]) == (90_000, 30_000, 60_000)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "partial_count" in plan and "Window" not in plan  # copies collapse before the shuffle


def test_hot_group_with_key_set_strategy(spark):
    from fareline.plans.bronze import dedup_with_key_set

    out = dedup_with_key_set(skewed(spark))
    assert out.count() == 60_000
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "LeftAnti" in plan


def test_hot_key_in_marts_is_pre_aggregated(spark):
    fact = skewed(spark).withColumn("date_day", F.to_date("pickup_at"))
    m = mart_revenue_daily_zone(fact)
    rows = m.collect()
    assert sum(r["trips"] for r in rows) == 90_000
    assert "partial_sum" in m._jdf.queryExecution().executedPlan().toString()
