"""The marts as mergeable partial sums.

A mart's part is its aggregate over one raw file, with averages kept as sum and count.
Parts of several files merge by adding up, and the merged rows get the mart's final
columns (``marts``). A replaced file swaps its parts; nothing is subtracted, so doubles
keep no residue of what went.

A part never mixes months: every key determines ``date_month``, the month of the fact's
``date_day``. Shares of a day or month are therefore complete within a month's rows.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fareline.config import DEFAULT_ANOMALY, AnomalyMartRules
from fareline.functions.expressions import year_month
from fareline.operators import marts as M

MONTH, FILE = "date_month", "source_file"
TRIPS, ADJUSTMENTS = "fact_trips", "fact_revenue_adjustments"


@dataclass(frozen=True)
class MartPart:
    """A mart's parts: the fact they come from, the key columns, the sums, and the mart from merged rows."""

    name: str
    fact: str
    keys: dict[str, Column]
    sums: dict[str, Column]
    finish: Callable[[DataFrame], DataFrame]

    def of(self, fact: DataFrame) -> DataFrame:
        """Parts of a fact's rows, per month and file."""
        keys = [c.alias(k) for k, c in self.keys.items()]
        return fact.groupBy(MONTH, FILE, *keys).agg(*[c.alias(k) for k, c in self.sums.items()])

    def merge(self, parts: DataFrame) -> DataFrame:
        """Parts of any number of files added up, per month and key."""
        return parts.groupBy(MONTH, *self.keys).agg(*[F.sum(k).alias(k) for k in self.sums])


def _mean(total: str, n: str) -> Column:
    return F.try_divide(F.col(total).cast("double"), F.col(n))


def _count() -> Column:
    return F.count(F.lit(1))


def _sum(column: str) -> Column:
    return F.sum(column)


def _miles() -> dict[str, Column]:
    return {"miles_sum": _sum("trip_distance_mi"), "miles_n": F.count("trip_distance_mi")}


def _durations() -> dict[str, Column]:
    return {"minutes_sum": F.sum(M.duration()), "minutes_n": F.count(M.duration())}


def _averages(df: DataFrame) -> DataFrame:
    """avg_miles and avg_duration_min in place of their sums and counts."""
    return df.withColumns({"avg_miles": _mean("miles_sum", "miles_n"), "avg_duration_min": _mean("minutes_sum", "minutes_n")}).drop(
        "miles_sum", "miles_n", "minutes_sum", "minutes_n"
    )


def _plain(*columns: str) -> Callable[[DataFrame], DataFrame]:
    return lambda df: df.select(*columns)


def mart_parts(anomaly: AnomalyMartRules = DEFAULT_ANOMALY) -> dict[str, MartPart]:
    """Every mart's parts by name; the airport mart's are of the rows that ``marts.airport_ends`` gives."""
    day, pu = {"date_day": F.col("date_day")}, F.col("pu_location_id")
    trips_day = MartPart(
        "kpi_trips", TRIPS, day,
        {"trips": _count(), "gross_revenue": _sum("total_amount"), "tips": _sum("tip_amount"), "congestion": _sum("congestion_surcharge"), "tolls": _sum("tolls_amount"), **_miles(), **_durations()},
        _averages,
    )
    adjustments_day = MartPart("kpi_adjustments", ADJUSTMENTS, day, {"adj_revenue": _sum("total_amount")}, _plain("date_day", "adj_revenue"))
    revenue = MartPart(
        "mart_revenue_daily_zone", TRIPS, {**day, "location_id": pu},
        {"total_revenue": _sum("total_amount"), "fare_revenue": _sum("fare_amount"), "tip_revenue": _sum("tip_amount"), "total_miles": _sum("trip_distance_mi"), "trips": _count()},
        _plain("date_day", "location_id", "total_revenue", "fare_revenue", "tip_revenue", "total_miles", "trips"),
    )
    hourly = MartPart(
        "mart_trips_hourly_vendor", TRIPS, {"_d": F.to_date("pickup_at"), "_h": F.hour("pickup_at"), "vendor_id": F.col("vendor_id")},
        {"trips": _count(), "revenue": _sum("total_amount"), **_miles(), **_durations()},
        lambda df: M.hour_columns(_averages(df)),
    )
    payment = MartPart(
        "mart_payment_mix_daily", TRIPS, {**day, "payment_type": F.col("payment_type")}, {"trips": _count(), "revenue": _sum("total_amount")}, M.payment_columns
    )
    scorecard = MartPart(
        "mart_vendor_scorecard_monthly", TRIPS, {"year_month": year_month("date_day"), "vendor_id": F.col("vendor_id")},
        {"trips": _count(), "revenue": _sum("total_amount"), **_miles(), **_durations(), "tips": _sum("tip_amount")},
        lambda df: M.scorecard_columns(_averages(df)),
    )
    corridors = MartPart(
        "mart_od_matrix_monthly", TRIPS, {"year_month": year_month("date_day"), "pu_location_id": pu, "do_location_id": F.col("do_location_id")},
        {"trips": _count(), "revenue": _sum("total_amount"), **_miles(), **_durations()},
        lambda df: _averages(df).select("year_month", "pu_location_id", "do_location_id", "trips", "revenue", "avg_miles", "avg_duration_min"),
    )
    # the adjustments fact holds payment codes already
    adjustments = MartPart(
        "mart_adjustments_daily_zone", ADJUSTMENTS, {**day, "payment_type": F.col("payment_type"), "location_id": pu}, {"trips": _count(), "total_revenue": _sum("total_amount")},
        _plain("date_day", "payment_type", "location_id", "trips", "total_revenue"),
    )
    has = F.coalesce(F.col("congestion_surcharge") > 0, F.lit(False))
    congestion = MartPart(
        "mart_congestion_impact_daily", TRIPS, day,
        {
            "trips_with_congestion": F.count_if(has).cast("long"), "trips_total": _count(),
            "revenue_with_congestion": F.sum(F.when(has, F.col("total_amount")).otherwise(F.lit(0.0))),
            "revenue_without_congestion": F.sum(F.when(~has, F.col("total_amount")).otherwise(F.lit(0.0))),
            "with_sum": F.sum(F.when(has, F.col("fare_amount"))), "with_n": F.count(F.when(has, F.col("fare_amount"))),
            "without_sum": F.sum(F.when(~has, F.col("fare_amount"))), "without_n": F.count(F.when(~has, F.col("fare_amount"))),
        },
        lambda df: df.select(
            "date_day", "trips_with_congestion", "trips_total", "revenue_with_congestion", "revenue_without_congestion",
            _mean("with_sum", "with_n").alias("avg_fare_with_congestion"), _mean("without_sum", "without_n").alias("avg_fare_without_congestion"),
        ),
    )
    airport = MartPart(
        "mart_airport_daily", TRIPS, {**day, "airport": F.col("airport"), "direction": F.col("direction")},
        {
            "trips": _count(), "total_revenue": _sum("total_amount"), "fare_revenue": _sum("fare_amount"), "tip_revenue": _sum("tip_amount"),
            "airport_fee_total": _sum("airport_fee"), **_miles(),
        },
        lambda df: df.select(
            "date_day", "airport", "direction", "trips", "total_revenue", "fare_revenue", "tip_revenue", "airport_fee_total", _mean("miles_sum", "miles_n").alias("avg_miles")
        ),
    )
    outliers = M.outlier_conditions(anomaly)
    summary = MartPart(
        "mart_anomaly_summary_daily", TRIPS, {**day, "location_id": pu}, {k: M.count_true(c) for k, c in outliers.items()},
        lambda df: M.anomaly_columns(df).select("date_day", "location_id", *outliers, "anomalies"),
    )
    parts = (trips_day, adjustments_day, revenue, hourly, payment, scorecard, corridors, adjustments, congestion, airport, summary)
    return {p.name: p for p in parts}
