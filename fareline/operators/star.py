"""Staging views, facts and dimensions of the star schema."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fareline.config import DEFAULT_PAYMENT, PaymentCodeRule
from fareline.functions.expressions import payment_code

# The staging contract - (output name, source column, strict type), in order.
_STG_COLUMNS = (
    ("vendor_id", "vendor_id", T.ShortType()),
    ("pickup_at", "pickup_at", None),
    ("dropoff_at", "dropoff_at", None),
    ("pickup_date", None, None),
    ("pickup_hour", None, None),
    ("passenger_count", "passenger_count", T.ShortType()),
    ("trip_distance_mi", "trip_distance_mi", T.DoubleType()),
    ("rate_code_id", "rate_code_id", T.ShortType()),
    ("store_and_fwd_flag", "store_and_fwd_flag", None),
    ("pu_location_id", "pu_location_id", T.IntegerType()),
    ("do_location_id", "do_location_id", T.IntegerType()),
    ("payment_type", None, None),
    ("fare_amount", "fare_amount", T.DoubleType()),
    ("extra", "extra", T.DoubleType()),
    ("mta_tax", "mta_tax", T.DoubleType()),
    ("tip_amount", "tip_amount", T.DoubleType()),
    ("tolls_amount", "tolls_amount", T.DoubleType()),
    ("improvement_surcharge", "improvement_surcharge", T.DoubleType()),
    ("total_amount", "total_amount", T.DoubleType()),
    ("congestion_surcharge", "congestion_surcharge", T.DoubleType()),
    ("airport_fee", "airport_fee", T.DoubleType()),
    ("cbd_congestion_fee", "cbd_congestion_fee", T.DoubleType()),
    ("manual_total", "manualTotal", T.DoubleType()),
    ("duration_min", "duration_min", T.DoubleType()),
    ("speed_mph", "speed_mph", T.DoubleType()),
    ("qa_in_file_window", "qa_in_file_window", T.BooleanType()),
    ("qa_outlier_distance", "qa_outlier_distance", T.BooleanType()),
    ("qa_outlier_speed", "qa_outlier_speed", T.BooleanType()),
    ("qa_is_fare_mismatch", "qa_is_fare_mismatch", T.BooleanType()),
    ("qa_is_adjustment", "qa_is_adjustment", T.BooleanType()),
    ("dup_key", "dup_key", None),
    ("qa_is_duplicate_in_file", "qa_is_duplicate_in_file", T.BooleanType()),
    ("source_year", "source_year", T.IntegerType()),
    ("source_month", "source_month", T.IntegerType()),
    ("source_file", "source_file", None),
)


def stg_trips(clean: DataFrame, rule: PaymentCodeRule = DEFAULT_PAYMENT) -> DataFrame:
    """Staged clean trips: strict casts, pickup date/hour, payment code, manual_total."""
    exprs = []
    for name, src, dtype in _STG_COLUMNS:
        if name == "pickup_date":
            exprs.append(F.to_date("pickup_at").alias(name))
        elif name == "pickup_hour":
            exprs.append(F.hour("pickup_at").cast("short").alias(name))
        elif name == "payment_type":
            exprs.append(payment_code("payment_type", rule).alias(name))
        else:
            c = F.col(src)
            exprs.append((c.cast(dtype) if dtype is not None else c).alias(name))
    return clean.select(*exprs)


def stg_with_pickup_date(split_rows: DataFrame) -> DataFrame:
    """stg_admin / stg_anomalies / stg_fare_miss: every column + pickup_date."""
    return split_rows.withColumn("pickup_date", F.to_date("pickup_at"))


# Measures of the trip fact.
_FACT_TRIP_MEASURES = (
    "pickup_at",
    "dropoff_at",
    "passenger_count",
    "trip_distance_mi",
    "rate_code_id",
    "store_and_fwd_flag",
    "fare_amount",
    "extra",
    "mta_tax",
    "tip_amount",
    "tolls_amount",
    "improvement_surcharge",
    "congestion_surcharge",
    "airport_fee",
    "cbd_congestion_fee",
    "total_amount",
    "manual_total",
    "duration_min",
    "speed_mph",
    "qa_in_file_window",
    "qa_outlier_distance",
    "qa_outlier_speed",
    "qa_is_fare_mismatch",
    "qa_is_adjustment",
    "source_file",
)


def fact_trips(stg: DataFrame) -> DataFrame:
    """One row per staged trip: key, date and dimension keys, measures."""
    return stg.select(
        F.col("dup_key").alias("trip_key"),
        F.to_date("pickup_at").alias("date_day"),
        "vendor_id",
        "payment_type",
        "pu_location_id",
        "do_location_id",
        *_FACT_TRIP_MEASURES,
    )


# Measures of the adjustments fact.
_ADJ_MEASURES = (
    "total_amount",
    "fare_amount",
    "extra",
    "mta_tax",
    "tip_amount",
    "tolls_amount",
    "improvement_surcharge",
    "congestion_surcharge",
    "airport_fee",
    "cbd_congestion_fee",
)


def fact_revenue_adjustments(admin: DataFrame, rule: PaymentCodeRule = DEFAULT_PAYMENT) -> DataFrame:
    """One row per admin/adjustment trip that has a date (pickup, else dropoff)."""
    date_day = F.coalesce(F.to_date("pickup_at"), F.to_date("dropoff_at"))
    return admin.where(date_day.isNotNull()).select(
        date_day.alias("date_day"),
        payment_code("payment_type", rule).alias("payment_type"),
        "pu_location_id",
        "do_location_id",
        *_ADJ_MEASURES,
        F.lit(True).alias("is_adjustment"),
        "source_year",
        "source_month",
        "source_file",
    )


def date_bounds(*facts: DataFrame, pad_days: int = 2) -> DataFrame:
    """One row (dmin, dmax): min/max date_day over all facts, widened by ``pad_days``."""
    per_fact = [f.agg(F.min("date_day").alias("lo"), F.max("date_day").alias("hi")) for f in facts]
    both = per_fact[0]
    for p in per_fact[1:]:
        both = both.unionByName(p)
    return both.agg(
        F.date_sub(F.min("lo"), pad_days).alias("dmin"),
        F.date_add(F.max("hi"), pad_days).alias("dmax"),
    )


def calendar(days: DataFrame, day_col: str = "date_day") -> DataFrame:
    """Calendar attributes of a date column."""
    d = F.col(day_col)
    iso = F.extract(F.lit("DAYOFWEEK_ISO"), d).cast("int")
    return days.select(
        d.alias("date_day"),
        F.year(d).alias("year"),
        F.quarter(d).alias("quarter"),
        F.month(d).alias("month"),
        F.dayofmonth(d).alias("day"),
        F.date_format(d, "yyyy-MM").alias("year_month"),
        F.date_format(d, "EEEE").alias("day_name"),
        iso.alias("iso_dow"),
        iso.isin(6, 7).alias("is_weekend"),
    )


def dim_date(*facts: DataFrame, pad_days: int = 2) -> DataFrame:
    """One row per day from min(date_day) - pad to max(date_day) + pad over the facts.

    The day span is the only size driver (a few thousand rows for a decade).
    """
    bounds = date_bounds(*facts, pad_days=pad_days)
    days = bounds.select(F.explode(F.sequence("dmin", "dmax", F.expr("interval 1 day"))).alias("date_day"))
    return calendar(days)


def dim_payment(payment_seed: DataFrame) -> DataFrame:
    return payment_seed.select(F.col("payment_type").cast("short").alias("payment_type"), "payment_desc")


def dim_vendor(stg: DataFrame, vendor_seed: DataFrame, unknown: str = "Unknown") -> DataFrame:
    """Distinct non-NULL vendor ids of the staged trips, named from the seed."""
    ids = stg.where(F.col("vendor_id").isNotNull()).select("vendor_id").distinct()
    seed = vendor_seed.select(F.col("vendor_id").cast("short").alias("vendor_id"), "vendor_name")
    return ids.join(seed, "vendor_id", "left").select(
        "vendor_id", F.coalesce("vendor_name", F.lit(unknown)).alias("vendor_name")
    )


def dim_zone(stg: DataFrame, zone_seed: DataFrame, unknown: str = "Unknown") -> DataFrame:
    """Distinct pickup/dropoff location ids, described from the zone seed."""
    ids = (
        stg.select(F.explode(F.array("pu_location_id", "do_location_id")).alias("location_id"))
        .where(F.col("location_id").isNotNull())
        .distinct()
    )
    seed = zone_seed.select(F.col("location_id").cast("int").alias("location_id"), "borough", "zone", "service_zone")
    return ids.join(seed, "location_id", "left").select(
        "location_id",
        F.coalesce("borough", F.lit(unknown)).alias("borough"),
        F.coalesce("zone", F.lit(unknown)).alias("zone"),
        F.coalesce("service_zone", F.lit(unknown)).alias("service_zone"),
    )
