"""Lookup seeds: vendors, payment types, taxi zones."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

VENDOR_SCHEMA = T.StructType(
    [T.StructField("vendor_id", T.ShortType()), T.StructField("vendor_name", T.StringType())]
)
PAYMENT_SCHEMA = T.StructType(
    [T.StructField("payment_type", T.ShortType()), T.StructField("payment_desc", T.StringType())]
)
ZONE_CSV_SCHEMA = T.StructType(
    [
        T.StructField("LocationID", T.IntegerType()),
        T.StructField("Borough", T.StringType()),
        T.StructField("Zone", T.StringType()),
        T.StructField("service_zone", T.StringType()),
    ]
)
ZONE_SCHEMA = T.StructType(
    [
        T.StructField("location_id", T.IntegerType()),
        T.StructField("borough", T.StringType()),
        T.StructField("zone", T.StringType()),
        T.StructField("service_zone", T.StringType()),
    ]
)

# The vendor seed, in file order.
VENDORS = [
    (1, "Creative Mobile Technologies"),
    (2, "VeriFone Inc."),
]

# The payment-type seed, in file order.
PAYMENT_TYPES = [
    (1, "Credit card"),
    (2, "Cash"),
    (3, "No charge"),
    (4, "Dispute"),
    (5, "Unknown"),
    (6, "Voided trip"),
]


def vendors_seed(spark: SparkSession, rows=None) -> DataFrame:
    return spark.createDataFrame(rows if rows is not None else VENDORS, VENDOR_SCHEMA)


def payment_types_seed(spark: SparkSession, rows=None) -> DataFrame:
    return spark.createDataFrame(rows if rows is not None else PAYMENT_TYPES, PAYMENT_SCHEMA)


def read_seed_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Header CSV read with an explicit schema (no inference pass)."""
    return spark.read.option("header", True).schema(schema).csv(path)


def read_zones_csv(spark: SparkSession, path: str) -> DataFrame:
    """Taxi-zone lookup CSV (LocationID, Borough, Zone, service_zone) -> zone columns."""
    z = read_seed_csv(spark, path, ZONE_CSV_SCHEMA)
    return z.select(
        F.col("LocationID").alias("location_id"),
        F.col("Borough").alias("borough"),
        F.col("Zone").alias("zone"),
        F.col("service_zone"),
    )


def read_vendors_csv(spark: SparkSession, path: str) -> DataFrame:
    return read_seed_csv(spark, path, VENDOR_SCHEMA)


def read_payment_types_csv(spark: SparkSession, path: str) -> DataFrame:
    return read_seed_csv(spark, path, PAYMENT_SCHEMA)
