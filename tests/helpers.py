"""Literal-row frames for unit tests."""

from __future__ import annotations

import datetime as dt

from fareline.config import BASE_COLUMNS, BRONZE_CONTRACT

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"

BASE_SCHEMA = ", ".join(
    f"{f.name} {f.dataType.simpleString()}" for f in BRONZE_CONTRACT.fields if f.name in BASE_COLUMNS
)

T0 = dt.datetime(2024, 1, 10, 12, 0, 0)


def trip(**over):
    """A clean, ordinary trip of January 2024 (file trips_2024-01.parquet); override any field."""
    row = {
        "vendor_id": 1,
        "pickup_at": T0,
        "dropoff_at": T0 + dt.timedelta(minutes=20),
        "passenger_count": 1,
        "trip_distance_mi": 5.0,
        "rate_code_id": 1,
        "store_and_fwd_flag": "N",
        "pu_location_id": 10,
        "do_location_id": 20,
        "payment_type": 1,
        "fare_amount": 20.0,
        "extra": 1.0,
        "mta_tax": 0.5,
        "tip_amount": 4.0,
        "tolls_amount": 0.0,
        "improvement_surcharge": 1.0,
        "total_amount": 29.0,
        "congestion_surcharge": 2.5,
        "airport_fee": 0.0,
        "cbd_congestion_fee": None,
        "source_file": "trips_2024-01.parquet",
    }
    row.update(over)
    return row


def frame(spark, rows):
    cols = [*BASE_COLUMNS, "source_file"]
    return spark.createDataFrame([tuple(r[c] for c in cols) for r in rows], BASE_SCHEMA + ", source_file string")
