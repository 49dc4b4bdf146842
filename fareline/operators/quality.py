"""Row derivations, QA predicates, silver classification and splits."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fareline.config import (
    ADJUSTMENT_NEGATIVE_COLUMNS,
    DEFAULT_QA,
    QA_FLAG_COLUMNS,
    SPLIT_ADMIN,
    SPLIT_ANOMALIES,
    SPLIT_CLEAN,
    SPLIT_FARE_MISS,
    SPLIT_REJECTED,
    TOTAL_COMPONENTS,
    QaRules,
)
from fareline.functions.expressions import any_true, false_if_null, fractional_minutes, sum_filled


def derive_measures(df: DataFrame) -> DataFrame:
    """duration_min (fractional), speed_mph (NULL unless duration > 0), manualTotal."""
    out = df.withColumn("duration_min", fractional_minutes("pickup_at", "dropoff_at"))
    return out.withColumns(
        {
            "speed_mph": F.when(
                F.col("duration_min") > 0, F.lit(60.0) * F.col("trip_distance_mi") / F.col("duration_min")
            ),
            "manualTotal": sum_filled(TOTAL_COMPONENTS),
        }
    )


def file_window(year: Column, month: Column, rules: QaRules = DEFAULT_QA) -> tuple[Column, Column]:
    """[first of month - before days, first of next month + after days] as TIMESTAMP_NTZ."""
    first = F.make_date(year, month, F.lit(1))
    lo = F.date_sub(first, rules.window_days_before).cast("timestamp_ntz")
    hi = F.date_add(F.add_months(first, 1), rules.window_days_after).cast("timestamp_ntz")
    return lo, hi


def in_file_window(rules: QaRules = DEFAULT_QA, year: str = "source_year", month: str = "source_month") -> Column:
    lo, hi = file_window(F.col(year), F.col(month), rules)
    return F.col("pickup_at").between(lo, hi) & F.col("dropoff_at").between(lo, hi)


def outlier_distance(rules: QaRules = DEFAULT_QA) -> Column:
    d = F.col("trip_distance_mi")
    return ~((d > 0) & (d <= rules.max_distance_mi))


def outlier_speed(rules: QaRules = DEFAULT_QA) -> Column:
    return (
        (F.col("duration_min") < rules.min_duration_min)
        | (F.col("duration_min") > rules.max_duration_min)
        | (F.col("speed_mph") > rules.max_speed_mph)
    )


def fare_mismatch(rules: QaRules = DEFAULT_QA, actual: str = "manualTotal", expected: str = "total_amount") -> Column:
    return F.abs(F.col(actual) - F.col(expected)) > rules.fare_tolerance


def adjustment(rules: QaRules = DEFAULT_QA) -> Column:
    negatives = [F.col(c) < 0 for c in ADJUSTMENT_NEGATIVE_COLUMNS]
    return any_true([*negatives, F.col("payment_type").isin(list(rules.adjustment_payment_codes))])


def qa_flags(df: DataFrame, rules: QaRules = DEFAULT_QA) -> DataFrame:
    """The five bronze QA flags; a NULL outcome is false."""
    return df.withColumns(
        {
            "qa_in_file_window": false_if_null(in_file_window(rules)),
            "qa_outlier_distance": false_if_null(outlier_distance(rules)),
            "qa_outlier_speed": false_if_null(outlier_speed(rules)),
            "qa_is_fare_mismatch": false_if_null(fare_mismatch(rules)),
            "qa_is_adjustment": false_if_null(adjustment(rules)),
        }
    )


def missing_critical(required: tuple[str, ...] | None = None) -> Column:
    """Reject rule: pickup, dropoff, miles or total NULL, or a location NULL or <= 0.

    ``required`` adds further must-be-present columns (e.g. ``REQUIRED_FOR_ROW``).
    """
    conds = [
        F.col("pickup_at").isNull(),
        F.col("dropoff_at").isNull(),
        F.col("trip_distance_mi").isNull(),
        F.col("total_amount").isNull(),
        F.col("pu_location_id").isNull() | (F.col("pu_location_id") <= 0),
        F.col("do_location_id").isNull() | (F.col("do_location_id") <= 0),
    ]
    conds += [F.col(c).isNull() for c in (required or ())]
    return any_true(conds)


def _flag(name: str) -> Column:
    return false_if_null(F.col(name))


def anomaly() -> Column:
    """Operational anomaly: out of window or an outlier, unless the fare mismatches."""
    return (
        ~_flag("qa_in_file_window") | _flag("qa_outlier_distance") | _flag("qa_outlier_speed")
    ) & ~_flag("qa_is_fare_mismatch")


def classify_rows(df: DataFrame, required: tuple[str, ...] | None = None) -> DataFrame:
    """Adds is_rejected_missing, is_admin_issue, is_fare_mismatch, is_anomaly."""
    return df.withColumns(
        {
            "is_rejected_missing": missing_critical(required),
            "is_admin_issue": _flag("qa_is_adjustment"),
            "is_fare_mismatch": _flag("qa_is_fare_mismatch"),
            "is_anomaly": anomaly(),
        }
    )


def split_label(required: tuple[str, ...] | None = None) -> Column:
    """One CASE for the four disjoint silver splits (rejected > admin > anomaly > clean)."""
    return (
        F.when(missing_critical(required), F.lit(SPLIT_REJECTED))
        .when(_flag("qa_is_adjustment"), F.lit(SPLIT_ADMIN))
        .when(anomaly(), F.lit(SPLIT_ANOMALIES))
        .otherwise(F.lit(SPLIT_CLEAN))
    )


def with_split(df: DataFrame, column: str = "silver_split", required: tuple[str, ...] | None = None) -> DataFrame:
    return df.withColumn(column, split_label(required))


def split(df: DataFrame, name: str, column: str = "silver_split") -> DataFrame:
    """Rows of one split from a frame labelled by ``with_split``; fare_miss overlaps clean."""
    if name == SPLIT_FARE_MISS:
        return df.where((F.col(column) == SPLIT_CLEAN) & _flag("qa_is_fare_mismatch"))
    return df.where(F.col(column) == name)


def split_counts(df: DataFrame, column: str = "silver_split") -> DataFrame:
    """Rows and total_amount per split (+ the fare_miss subset) from ONE aggregate.

    Output: silver_split, rows, total_amount_sum. The fare_miss row is produced
    from counters of the same aggregate (no second pass, no union).
    """
    fm = (F.col(column) == SPLIT_CLEAN) & _flag("qa_is_fare_mismatch")
    agg = df.groupBy(column).agg(
        F.count(F.lit(1)).alias("_n"),
        F.sum("total_amount").alias("_t"),
        F.count_if(fm).alias("_fn"),
        F.sum(F.when(fm, F.col("total_amount"))).alias("_ft"),
    )
    rows = F.array(
        F.struct(F.col(column).alias(column), F.col("_n").alias("rows"), F.col("_t").alias("total_amount_sum")),
        F.struct(
            F.when(F.col(column) == SPLIT_CLEAN, F.lit(SPLIT_FARE_MISS)).alias(column),
            F.col("_fn").alias("rows"),
            F.col("_ft").alias("total_amount_sum"),
        ),
    )
    return (
        agg.select(F.inline(rows))
        .where(F.col(column).isNotNull())
        .withColumn("rows", F.col("rows").cast("long"))
    )


def coverage(df: DataFrame, column: str = "silver_split") -> DataFrame:
    """One row: split sizes and whether clean + anomalies == total - rejected - admin."""
    s = F.col(column)
    out = df.agg(
        F.count(F.lit(1)).alias("total_rows"),
        F.count_if(s == SPLIT_REJECTED).alias("rejected"),
        F.count_if(s == SPLIT_ADMIN).alias("admin"),
        F.count_if(s == SPLIT_ANOMALIES).alias("anomalies"),
        F.count_if(s == SPLIT_CLEAN).alias("clean"),
        F.count_if((s == SPLIT_CLEAN) & _flag("qa_is_fare_mismatch")).alias("fare_miss"),
    )
    return out.withColumns(
        {
            "base_good": F.col("total_rows") - F.col("rejected") - F.col("admin"),
            "covered": F.col("clean") + F.col("anomalies"),
        }
    ).withColumn("coverage_ok", F.col("base_good") == F.col("covered"))


__all__ = [
    "QA_FLAG_COLUMNS",
    "adjustment",
    "anomaly",
    "classify_rows",
    "coverage",
    "derive_measures",
    "fare_mismatch",
    "file_window",
    "in_file_window",
    "missing_critical",
    "outlier_distance",
    "outlier_speed",
    "qa_flags",
    "split",
    "split_counts",
    "split_label",
    "with_split",
]
