"""Contract, rule thresholds and lookup values.

Everything a user may want to tune is a dataclass field with the
reference behaviour as its default; the operators take these objects as
parameters instead of reading module globals.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# Fixed values that must equal the reference for identical results.
# Raw column names as they appear in monthly trip files, mapped to the
# canonical names used from bronze on.
# ---------------------------------------------------------------------------
CANONICAL_NAMES: dict[str, str] = {
    "tpep_pickup_datetime": "pickup_at",
    "tpep_dropoff_datetime": "dropoff_at",
    "VendorID": "vendor_id",
    "vendor_id": "vendor_id",
    "payment_type": "payment_type",
    "PULocationID": "pu_location_id",
    "DOLocationID": "do_location_id",
    "passenger_count": "passenger_count",
    "trip_distance": "trip_distance",
    "fare_amount": "fare_amount",
    "extra": "extra",
    "mta_tax": "mta_tax",
    "tip_amount": "tip_amount",
    "tolls_amount": "tolls_amount",
    "improvement_surcharge": "improvement_surcharge",
    "congestion_surcharge": "congestion_surcharge",
    "airport_fee": "airport_fee",
    "Airport_fee": "airport_fee",
    "cbd_congestion_fee": "cbd_congestion_fee",
    "total_amount": "total_amount",
    "store_and_fwd_flag": "store_and_fwd_flag",
    "ratecodeid": "rate_code_id",
    "RatecodeID": "rate_code_id",
}

# Money columns that may be absent from a raw file (added as NULL).
MONEY_COLUMNS: tuple[str, ...] = (
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
)

# The nine components of the computed total, in adding order
# (order matters for double rounding).
TOTAL_COMPONENTS: tuple[str, ...] = (
    "fare_amount",
    "extra",
    "mta_tax",
    "tolls_amount",
    "improvement_surcharge",
    "congestion_surcharge",
    "airport_fee",
    "cbd_congestion_fee",
    "tip_amount",
)

# Columns whose negative value marks an adjustment (tip excluded).
ADJUSTMENT_NEGATIVE_COLUMNS: tuple[str, ...] = (
    "total_amount",
    "fare_amount",
    "extra",
    "mta_tax",
    "tolls_amount",
    "improvement_surcharge",
    "congestion_surcharge",
    "airport_fee",
    "cbd_congestion_fee",
)

# The bronze duplicate key.
DUP_KEY_COLUMNS: tuple[str, ...] = (
    "vendor_id",
    "pickup_at",
    "dropoff_at",
    "pu_location_id",
    "do_location_id",
    "fare_amount",
    "trip_distance_mi",
)

# The alternative (declared, unused) duplicate key.
ALT_DUP_KEY_COLUMNS: tuple[str, ...] = (
    "vendor_id",
    "pickup_at",
    "dropoff_at",
    "passenger_count",
    "trip_distance_mi",
    "fare_amount",
    "total_amount",
    "payment_type",
)

# Declared list of fields a usable row needs (not used by the
# reference's split; available as the ``required=`` option of the reject rule).
REQUIRED_FOR_ROW: tuple[str, ...] = (
    "pickup_at",
    "dropoff_at",
    "vendor_id",
    "payment_type",
    "trip_distance_mi",
    "fare_amount",
    "total_amount",
)

# The 33-column bronze contract, in order.
BRONZE_CONTRACT = T.StructType(
    [
        T.StructField("vendor_id", T.ShortType()),
        T.StructField("pickup_at", T.TimestampNTZType()),
        T.StructField("dropoff_at", T.TimestampNTZType()),
        T.StructField("passenger_count", T.ShortType()),
        T.StructField("trip_distance_mi", T.DoubleType()),
        T.StructField("rate_code_id", T.ShortType()),
        T.StructField("store_and_fwd_flag", T.StringType()),
        T.StructField("pu_location_id", T.IntegerType()),
        T.StructField("do_location_id", T.IntegerType()),
        T.StructField("payment_type", T.ShortType()),
        T.StructField("fare_amount", T.DoubleType()),
        T.StructField("extra", T.DoubleType()),
        T.StructField("mta_tax", T.DoubleType()),
        T.StructField("tip_amount", T.DoubleType()),
        T.StructField("tolls_amount", T.DoubleType()),
        T.StructField("improvement_surcharge", T.DoubleType()),
        T.StructField("total_amount", T.DoubleType()),
        T.StructField("congestion_surcharge", T.DoubleType()),
        T.StructField("airport_fee", T.DoubleType()),
        T.StructField("cbd_congestion_fee", T.DoubleType()),
        T.StructField("manualTotal", T.DoubleType()),
        T.StructField("duration_min", T.DoubleType()),
        T.StructField("speed_mph", T.DoubleType()),
        T.StructField("qa_in_file_window", T.BooleanType()),
        T.StructField("qa_outlier_distance", T.BooleanType()),
        T.StructField("qa_outlier_speed", T.BooleanType()),
        T.StructField("qa_is_fare_mismatch", T.BooleanType()),
        T.StructField("qa_is_adjustment", T.BooleanType()),
        T.StructField("dup_key", T.StringType()),
        T.StructField("qa_is_duplicate_in_file", T.BooleanType()),
        T.StructField("source_year", T.IntegerType()),
        T.StructField("source_month", T.IntegerType()),
        T.StructField("source_file", T.StringType()),
    ]
)

BRONZE_COLUMNS: tuple[str, ...] = tuple(f.name for f in BRONZE_CONTRACT.fields)

# The 20 raw-derived columns of the contract (everything before the derivations).
BASE_COLUMNS: tuple[str, ...] = BRONZE_COLUMNS[:20]

# QA flag columns.
QA_FLAG_COLUMNS: tuple[str, ...] = (
    "qa_in_file_window",
    "qa_outlier_distance",
    "qa_outlier_speed",
    "qa_is_fare_mismatch",
    "qa_is_adjustment",
)

# Optional columns silver drops when an older bronze still carries them.
# Optional columns that silver drops.
SILVER_DROP_COLUMNS: tuple[str, ...] = ("qa_is_fee_misflag", "fee_misflag_delta")

# Silver split names (rows of the four disjoint splits) and the
# overlapping fare-mismatch subset of clean.
SPLIT_REJECTED = "rejected"
SPLIT_ADMIN = "trips_admin"
SPLIT_ANOMALIES = "trips_anomalies"
SPLIT_CLEAN = "trips_clean"
SPLIT_FARE_MISS = "trips_fare_miss"
DISJOINT_SPLITS: tuple[str, ...] = (SPLIT_REJECTED, SPLIT_ADMIN, SPLIT_ANOMALIES, SPLIT_CLEAN)

# Pattern that carries year and month in a raw file name, e.g. ..._2024-01.parquet
# Fixed value: year and month in a file name.
FILE_YEAR_MONTH_PATTERN = r"(\d{4})-(\d{2})"


@dataclass(frozen=True)
class QaRules:
    """Bronze QA thresholds (defaults = reference behaviour)."""

    window_days_before: int = 2
    window_days_after: int = 2
    max_distance_mi: float = 150.0  # outlier when NOT (0 < miles <= max)
    min_duration_min: float = 1.0
    max_duration_min: float = 360.0
    max_speed_mph: float = 80.0
    fare_tolerance: float = 0.50
    adjustment_payment_codes: tuple[int, ...] = (3, 4, 6)
    near_eps: float = 0.02


@dataclass(frozen=True)
class PaymentCodeRule:
    """Payment codes kept as-is; anything else (and NULL) maps to ``unknown``."""

    min_code: int = 1
    max_code: int = 6
    unknown: int = 5


@dataclass(frozen=True)
class AirportRule:
    """Airport labelling of zones (``service_zone`` filter + ordered ilike patterns)."""

    service_zone: str = "Airports"
    # Label -> zone-name patterns, tried in this order.
    labels: tuple[tuple[str, tuple[str, ...]], ...] = (
        ("JFK", ("%JFK%",)),
        ("LGA", ("%LGA%", "%LaGuardia%")),
        ("EWR", ("%EWR%", "%Newark%")),
    )


@dataclass(frozen=True)
class AnomalyMartRules:
    """Outlier rules of the daily anomaly mart (they differ from bronze's)."""

    max_distance_mi: float = 150.0  # outlier when > max or < 0
    min_duration_min: int = 1
    max_duration_min: int = 360
    max_speed_mph: float = 80.0


@dataclass(frozen=True)
class DashboardRules:
    """Parameters of the executive questions."""

    # The reference clamps "today" to a fixed first day of its dataset; None
    # means "the first day present in the data".
    min_date: str | None = None
    trips_alert: float = -0.05
    revenue_alert: float = -0.05
    tip_alert: float = 0.0
    no_alert_window_days: int = 90
    top_vendors: int = 2
    top_zones: int = 12
    top_corridors: int = 20
    top_hotspots: int = 8
    hotspot_min_trips: int = 100
    shift_pp: float = 0.5
    card_token: str = "card"
    cash_token: str = "cash"
    unknown_vendor_token: str = "unknown"
    label_separator: str = " — "
    corridor_arrow: str = " → "


# Table-kind prefixes of the catalog profile.
TABLE_KIND_PREFIXES: tuple[tuple[str, str], ...] = (
    ("dim_", "DIMENSION"),
    ("fact_", "FACT"),
    ("mart_", "MART"),
)

# Known foreign-key columns -> (dimension table, key column).
FOREIGN_KEY_MAP: dict[str, tuple[str, str]] = {
    "date_day": ("dim_date", "date_day"),
    "vendor_id": ("dim_vendor", "vendor_id"),
    "payment_type": ("dim_payment", "payment_type"),
    "location_id": ("dim_zone", "location_id"),
    "pu_location_id": ("dim_zone", "location_id"),
    "do_location_id": ("dim_zone", "location_id"),
}

# Preferred dimension key names, in order.
PREFERRED_DIM_KEYS: tuple[str, ...] = ("date_day", "vendor_id", "payment_type", "location_id")

# Columns profiled for a date range, first present wins.
DATE_COLUMN_CANDIDATES: tuple[str, ...] = ("date_day", "date", "ds")


@dataclass(frozen=True)
class Layers:
    """Schema (database) names used when a warehouse is registered."""

    staging: str = "staging"
    gold: str = "gold"
    marts: str = "marts"


DEFAULT_QA = QaRules()
DEFAULT_PAYMENT = PaymentCodeRule()
DEFAULT_AIRPORT = AirportRule()
DEFAULT_ANOMALY = AnomalyMartRules()
DEFAULT_DASHBOARD = DashboardRules()
