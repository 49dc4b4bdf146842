"""The ten daily / monthly marts.

Each is one grouped aggregate over a fact (partial aggregation before the
shuffle, so a hot day or zone costs one row per map task). Shares of a
group total are window sums over the *aggregated* rows (a handful per
group), never over trips.

Two rewrites relative to a literal reading of the reference SQL:
* the monthly marts join ``dim_date`` only to get ``year_month``; every
  non-NULL fact date lies inside ``dim_date`` by construction, so the inner
  join is the same as deriving ``year_month`` from ``date_day`` and dropping
  NULL dates - no join, no extra scan;
* the vendor scorecard's join of the aggregate with its own month totals
  is a window sum.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fareline.config import DEFAULT_AIRPORT, DEFAULT_ANOMALY, DEFAULT_PAYMENT, AirportRule, AnomalyMartRules, PaymentCodeRule
from fareline.functions.expressions import (
    airport_label,
    minute_boundaries,
    payment_code,
    safe_ratio,
    year_month,
)


def duration() -> Column:
    """Trip duration in whole minute boundaries (the marts' duration measure)."""
    return minute_boundaries("pickup_at", "dropoff_at")


def mart_kpi_daily(fact: DataFrame, adjustments: DataFrame) -> DataFrame:
    """Daily KPIs of clean trips, net of the day's adjustments (days without trips are absent)."""
    trips = fact.groupBy("date_day").agg(
        F.count(F.lit(1)).alias("trips"),
        F.sum("total_amount").alias("gross_revenue"),
        F.sum("tip_amount").alias("tips"),
        F.sum("congestion_surcharge").alias("congestion"),
        F.sum("tolls_amount").alias("tolls"),
        F.avg("trip_distance_mi").alias("avg_miles"),
        F.avg(duration()).alias("avg_duration_min"),
    )
    adj = adjustments.groupBy("date_day").agg(F.sum("total_amount").alias("adj_revenue"))
    return kpi_columns(trips.join(adj, "date_day", "left"))


def kpi_columns(j: DataFrame) -> DataFrame:
    """The KPI mart's columns from a day's sums and averages."""
    return j.select(
        "date_day",
        "trips",
        "gross_revenue",
        (F.coalesce("gross_revenue", F.lit(0.0)) + F.coalesce("adj_revenue", F.lit(0.0))).alias("net_revenue"),
        "tips",
        F.when(F.col("gross_revenue") > 0, F.col("tips") / F.col("gross_revenue")).alias("tip_rate"),
        "congestion",
        "tolls",
        "avg_miles",
        "avg_duration_min",
        F.when(
            F.col("avg_duration_min") > 0, F.lit(60.0) * F.col("avg_miles") / F.col("avg_duration_min")
        ).alias("avg_speed_mph"),
    )


def mart_revenue_daily_zone(fact: DataFrame) -> DataFrame:
    """Per day and pickup zone: total, fare and tip revenue, miles and trips."""
    return fact.groupBy("date_day", F.col("pu_location_id").alias("location_id")).agg(
        F.sum("total_amount").alias("total_revenue"),
        F.sum("fare_amount").alias("fare_revenue"),
        F.sum("tip_amount").alias("tip_revenue"),
        F.sum("trip_distance_mi").alias("total_miles"),
        F.count(F.lit(1)).alias("trips"),
    )


def mart_trips_hourly_vendor(fact: DataFrame) -> DataFrame:
    """Per pickup hour and vendor. Grouped on (day, hour) and turned into an hour
    timestamp once per group rather than once per trip."""
    g = fact.groupBy(
        F.to_date("pickup_at").alias("_d"), F.hour("pickup_at").alias("_h"), "vendor_id"
    ).agg(
        F.count(F.lit(1)).alias("trips"),
        F.sum("total_amount").alias("revenue"),
        F.avg("trip_distance_mi").alias("avg_miles"),
        F.avg(duration()).alias("avg_duration_min"),
    )
    return hour_columns(g)


def hour_columns(g: DataFrame) -> DataFrame:
    """Groups of (_d, _h, vendor) with the hour as a timestamp."""
    hour = F.make_timestamp_ntz(F.year("_d"), F.month("_d"), F.dayofmonth("_d"), F.col("_h"), F.lit(0), F.lit(0))
    return g.select(hour.alias("hour"), "vendor_id", "trips", "revenue", "avg_miles", "avg_duration_min")


def mart_payment_mix_daily(fact: DataFrame) -> DataFrame:
    """Per day and payment code: trips, revenue, average ticket and share of the day's trips."""
    d = fact.groupBy("date_day", "payment_type").agg(
        F.count(F.lit(1)).alias("trips"), F.sum("total_amount").alias("revenue")
    )
    return payment_columns(d)


def payment_columns(d: DataFrame) -> DataFrame:
    """Ticket and share of the day's trips for (day, payment code) groups."""
    day = Window.partitionBy("date_day")
    return d.select(
        "date_day",
        "payment_type",
        "trips",
        "revenue",
        safe_ratio("revenue", "trips").alias("avg_ticket"),
        safe_ratio(F.col("trips").cast("double"), F.sum("trips").over(day)).alias("share"),
    )


def mart_vendor_scorecard_monthly(fact: DataFrame) -> DataFrame:
    """Per month and vendor: trips, revenue, ticket, miles, duration, tip rate, share of month revenue."""
    x = (
        fact.where(F.col("date_day").isNotNull())
        .groupBy(year_month("date_day").alias("year_month"), "vendor_id")
        .agg(
            F.count(F.lit(1)).alias("trips"),
            F.sum("total_amount").alias("revenue"),
            F.avg("trip_distance_mi").alias("avg_miles"),
            F.avg(duration()).alias("avg_duration_min"),
            F.sum("tip_amount").alias("tips"),
        )
    )
    return scorecard_columns(x)


def scorecard_columns(x: DataFrame) -> DataFrame:
    """Ticket, tip rate and share of the month's revenue for (month, vendor) groups."""
    month = Window.partitionBy("year_month")
    return x.select(
        "year_month",
        "vendor_id",
        "trips",
        "revenue",
        safe_ratio("revenue", "trips").alias("avg_ticket"),
        "avg_miles",
        "avg_duration_min",
        safe_ratio("tips", "revenue").alias("tip_rate"),
        safe_ratio("revenue", F.sum("revenue").over(month)).alias("revenue_share"),
    )


def mart_od_matrix_monthly(fact: DataFrame) -> DataFrame:
    """Per month and (pickup, dropoff) zone pair: trips, revenue, average miles and duration."""
    return (
        fact.where(F.col("date_day").isNotNull())
        .groupBy(year_month("date_day").alias("year_month"), "pu_location_id", "do_location_id")
        .agg(
            F.count(F.lit(1)).alias("trips"),
            F.sum("total_amount").alias("revenue"),
            F.avg("trip_distance_mi").alias("avg_miles"),
            F.avg(duration()).alias("avg_duration_min"),
        )
    )


def mart_adjustments_daily_zone(adjustments: DataFrame, rule: PaymentCodeRule = DEFAULT_PAYMENT) -> DataFrame:
    """Per day, payment code and pickup zone: adjustment trips and their total."""
    return (
        adjustments.where(F.col("date_day").isNotNull())
        .groupBy("date_day", payment_code("payment_type", rule).alias("payment_type"), F.col("pu_location_id").alias("location_id"))
        .agg(F.count(F.lit(1)).alias("trips"), F.sum("total_amount").alias("total_revenue"))
    )


def mart_congestion_impact_daily(fact: DataFrame) -> DataFrame:
    """Per day: trips and revenue with / without a congestion surcharge (NULL counts as without)."""
    has = F.coalesce(F.col("congestion_surcharge") > 0, F.lit(False))
    return fact.groupBy("date_day").agg(
        F.count_if(has).cast("long").alias("trips_with_congestion"),
        F.count(F.lit(1)).alias("trips_total"),
        F.sum(F.when(has, F.col("total_amount")).otherwise(F.lit(0.0))).alias("revenue_with_congestion"),
        F.sum(F.when(~has, F.col("total_amount")).otherwise(F.lit(0.0))).alias("revenue_without_congestion"),
        F.avg(F.when(has, F.col("fare_amount"))).alias("avg_fare_with_congestion"),
        F.avg(F.when(~has, F.col("fare_amount"))).alias("avg_fare_without_congestion"),
    )


def airport_zones(zones: DataFrame, rule: AirportRule = DEFAULT_AIRPORT) -> DataFrame:
    """(location_id, airport) of airport zones with a label; bounded by the zone table."""
    return (
        zones.where(F.col("service_zone") == rule.service_zone)
        .select("location_id", airport_label("zone", rule).alias("airport"))
        .where(F.col("airport").isNotNull())
    )


def mart_airport_daily(fact: DataFrame, zones: DataFrame, rule: AirportRule = DEFAULT_AIRPORT) -> DataFrame:
    """Airport trips per day, airport and direction (PU / DO).

    One scan of the fact: both ends are looked up against the (small)
    airport-zone table, and only the matching directions are exploded; a
    trip between two airports counts once per direction.
    """
    base = airport_ends(fact, zones, rule)
    return base.groupBy("date_day", "airport", "direction").agg(
        F.count(F.lit(1)).alias("trips"),
        F.sum("total_amount").alias("total_revenue"),
        F.sum("fare_amount").alias("fare_revenue"),
        F.sum("tip_amount").alias("tip_revenue"),
        F.sum("airport_fee").alias("airport_fee_total"),
        F.avg("trip_distance_mi").alias("avg_miles"),
    )


def airport_ends(fact: DataFrame, zones: DataFrame, rule: AirportRule = DEFAULT_AIRPORT, keep=()) -> DataFrame:
    """A row per trip end at an airport, with the measures and the columns ``keep`` of the trip."""
    ap = airport_zones(zones, rule)
    pu = ap.select(F.col("location_id").alias("pu_location_id"), F.col("airport").alias("pu_airport"))
    do = ap.select(F.col("location_id").alias("do_location_id"), F.col("airport").alias("do_airport"))
    measures = ("date_day", "total_amount", "fare_amount", "tip_amount", "trip_distance_mi", "airport_fee", *keep)
    t = fact.select("pu_location_id", "do_location_id", *measures)
    j = t.join(pu, "pu_location_id", "left").join(do, "do_location_id", "left")
    j = j.where(F.col("pu_airport").isNotNull() | F.col("do_airport").isNotNull())
    sides = F.filter(
        F.array(
            F.struct(F.lit("PU").alias("direction"), F.col("pu_airport").alias("airport")),
            F.struct(F.lit("DO").alias("direction"), F.col("do_airport").alias("airport")),
        ),
        lambda s: s["airport"].isNotNull(),
    )
    return j.select(*measures, F.explode(sides).alias("s")).select(*measures, "s.airport", "s.direction")


def count_true(cond: Column) -> Column:
    """Rows where ``cond`` holds; NULL when ``cond`` is NULL on every row of the group.

    This is how the reference's SQL engine evaluates ``count_if`` (a sum of
    the predicate as 0/1), so a day/zone whose trips all lack a speed reports
    NULL speed outliers (and NULL anomalies), not 0.
    """
    return F.sum(cond.cast("int")).cast("long")


def mart_anomaly_summary_daily(fact: DataFrame, rules: AnomalyMartRules = DEFAULT_ANOMALY) -> DataFrame:
    """Per day and pickup zone: distance, duration, speed and negative-total outliers and their sum."""
    out = fact.groupBy("date_day", F.col("pu_location_id").alias("location_id"))
    return anomaly_columns(out.agg(*[count_true(c).alias(k) for k, c in outlier_conditions(rules).items()]))


def outlier_conditions(rules: AnomalyMartRules = DEFAULT_ANOMALY) -> dict[str, Column]:
    """The counted conditions of a trip, by column of the mart."""
    dur, miles = duration(), F.col("trip_distance_mi")
    return {
        "distance_outliers": (miles > rules.max_distance_mi) | (miles < 0),
        "duration_outliers": (dur < rules.min_duration_min) | (dur > rules.max_duration_min),
        "speed_outliers": F.when(dur > 0, F.lit(60.0) * miles / dur) > rules.max_speed_mph,
        "negative_total": F.col("total_amount") < 0,
    }


def anomaly_columns(counts: DataFrame) -> DataFrame:
    """The four counts and their sum."""
    return counts.withColumn(
        "anomalies",
        F.col("distance_outliers") + F.col("duration_outliers") + F.col("speed_outliers") + F.col("negative_total"),
    )


MART_BUILDERS = (
    "mart_kpi_daily",
    "mart_revenue_daily_zone",
    "mart_trips_hourly_vendor",
    "mart_payment_mix_daily",
    "mart_vendor_scorecard_monthly",
    "mart_od_matrix_monthly",
    "mart_adjustments_daily_zone",
    "mart_congestion_impact_daily",
    "mart_airport_daily",
    "mart_anomaly_summary_daily",
)
