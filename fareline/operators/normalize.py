"""Normalising projections: raw trip columns -> bronze contract types.

Every function inspects ``df.schema`` on the driver (metadata only) and
returns a projection; no job runs here.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fareline.config import (
    BASE_COLUMNS,
    BRONZE_CONTRACT,
    CANONICAL_NAMES,
    MONEY_COLUMNS,
    QA_FLAG_COLUMNS,
    SILVER_DROP_COLUMNS,
)

# time texts: (pattern, layout), month first where both could be meant. The first pattern
# found in a text decides, with whatever stands before and after it.
ISO_TIME = r"(?<!\d)\d{4}-\d{1,2}-\d{1,2}[ T]\d{1,2}:\d{2}(?::\d{2}(?:\.\d{1,9})?)?(?!\d)"
TEXT_TIME_LAYOUTS = (
    (r"(?<!\d)\d{1,2}/\d{1,2}/\d{4} \d{1,2}:\d{2}:\d{2} [AaPp][Mm]", "M/d/yyyy h:mm:ss a"),
    (r"(?<!\d)\d{1,2}/\d{1,2}/\d{4} \d{1,2}:\d{2} [AaPp][Mm]", "M/d/yyyy h:mm a"),
    (r"(?<!\d)\d{1,2}/\d{1,2}/\d{4} \d{1,2}:\d{2}:\d{2}(?!\d)", "M/d/yyyy H:mm:ss"),
    (r"(?<!\d)\d{1,2}/\d{1,2}/\d{4} \d{1,2}:\d{2}(?!\d)", "M/d/yyyy H:mm"),
    (r"(?<!\d)\d{1,2}/\d{1,2}/\d{4}(?!\d)", "M/d/yyyy"),
    (r"(?<!\d)\d{4}/\d{1,2}/\d{1,2} \d{1,2}:\d{2}:\d{2}(?!\d)", "yyyy/M/d H:mm:ss"),
    (r"(?<!\d)\d{4}/\d{1,2}/\d{1,2}(?!\d)", "yyyy/M/d"),
    (r"(?<!\d)\d{8} \d{6}(?!\d)", "yyyyMMdd HHmmss"),
    (r"(?<!\d)\d{14}(?!\d)", "yyyyMMddHHmmss"),
    (r"(?<!\d)\d{1,2}-[A-Za-z]{3}-\d{4} \d{1,2}:\d{2}:\d{2}(?!\d)", "d-MMM-yyyy H:mm:ss"),
    (r"[A-Z][a-z]{2} \d{1,2}, \d{4} \d{1,2}:\d{2}:\d{2}(?!\d)", "MMM d, yyyy H:mm:ss"),
    (r"[A-Z][a-z]{2} \d{1,2} \d{4} \d{1,2}:\d{2}[AP]M", "MMM d yyyy h:mma"),
)

# column metadata: what the integers of a time column count ("s", "ms", "us", "ns"), or
# "plain" for integers that are no time type in the file (``sources.raw`` sets it from the footer)
TIME_UNIT = "time_unit"
PLAIN_INTEGER = "plain"
_PER_SECOND = {"s": 1, "ms": 1_000, "us": 1_000_000, "ns": 1_000_000_000}

INTEGER_ID_COLUMNS = (
    "vendor_id",
    "payment_type",
    "rate_code_id",
    "passenger_count",
    "pu_location_id",
    "do_location_id",
)


def canonicalize_names(df: DataFrame, rename: Mapping[str, str] = CANONICAL_NAMES) -> DataFrame:
    """Rename known raw names to canonical ones; unknown columns are kept.

    Matching is exact (case-sensitive) on the file's own names, so case
    variants such as ``Airport_fee`` / ``airport_fee`` are both resolved.
    """
    mapping = {c: rename[c] for c in df.columns if c in rename and rename[c] != c}
    targets = [rename.get(c, c) for c in df.columns]
    clashes = sorted({t for t in targets if targets.count(t) > 1})
    if clashes:
        raise ValueError(f"several raw columns map to the same canonical name: {clashes}")
    return df.withColumnsRenamed(mapping) if mapping else df


def _time_from_text(c: Column) -> Column:
    """The time in a text: the whole text as ISO, else the first layout found in it; NULL when that isn't a time."""
    text = F.trim(c.cast("string"))
    ntz = T.TimestampNTZType()
    found = F.when(text.rlike(ISO_TIME), F.regexp_extract(text, ISO_TIME, 0).try_cast(ntz))
    for pattern, layout in TEXT_TIME_LAYOUTS:
        found = found.when(text.rlike(pattern), F.try_to_timestamp(F.regexp_extract(text, pattern, 0), F.lit(layout)).cast(ntz))
    return F.coalesce(text.try_cast(ntz), found)


def _time_from_integer(c: Column, unit: str) -> Column:
    """Integers since the epoch; what is finer than microseconds is cut off."""
    per = _PER_SECOND[unit]
    micros = F.floor(c.cast("long") / F.lit(Decimal(per // 1_000_000))) if per > 1_000_000 else c.cast("decimal(38,0)") * F.lit(Decimal(1_000_000 // per))
    seconds = (micros / F.lit(Decimal(1_000_000))).cast("decimal(18,6)")
    return F.to_timestamp_ntz(F.lit("1970-01-01 00:00:00")) + F.make_dt_interval(secs=seconds)


def to_timestamp_ntz(df: DataFrame, name: str) -> Column:
    """Timestamp coercion: NTZ kept, LTZ/date cast, integers by their unit, text parsed.

    An integer column's unit is its ``TIME_UNIT`` metadata, and nanoseconds without it
    (what nanosecond files are read as). Plain integers and all other types go through
    their text: ISO first, then the layouts of ``TEXT_TIME_LAYOUTS``, with any text
    around them; what none of them reads gives NULL.
    """
    f = df.schema[name]
    c = F.col(name)
    if isinstance(f.dataType, T.TimestampNTZType):
        return c
    if isinstance(f.dataType, (T.TimestampType, T.DateType)):
        return c.cast(T.TimestampNTZType())
    unit = (f.metadata or {}).get(TIME_UNIT, "ns")
    if isinstance(f.dataType, T.IntegralType) and unit != PLAIN_INTEGER:
        return _time_from_integer(c, unit)
    return _time_from_text(c)


RESCUED = "_rescued"


def with_raw_texts(df: DataFrame) -> DataFrame:
    """Canonically named raw rows with the texts of the values that a lenient cast may lose (``_rescued``)."""
    contract = {f.name: f.dataType for f in BRONZE_CONTRACT.fields}
    at = {c: "trip_distance" if c == "trip_distance_mi" and c not in df.columns else c for c in BASE_COLUMNS}
    # a column that has its type already loses nothing
    texts = [F.col(r).cast("string").alias(c) for c, r in at.items() if r in df.columns and df.schema[r].dataType != contract[c]]
    return df.withColumn(RESCUED, F.struct(*texts) if texts else F.struct(F.lit(None).cast("string").alias("none")))


def rescued_values(df: DataFrame) -> Column:
    """Of typed rows with their raw texts: a map from column to the text whose cast gave NULL."""
    names = [f.name for f in df.schema[RESCUED].dataType.fields if f.name in df.columns]
    lost = [F.struct(F.lit(c).alias("k"), F.when(F.col(c).isNull(), F.col(RESCUED)[c]).alias("v")) for c in names]
    if not lost:
        return F.create_map().cast("map<string,string>")
    return F.map_from_entries(F.filter(F.array(*lost), lambda e: e["v"].isNotNull()))


def cast_losses(rows: DataFrame) -> DataFrame:
    """Per file and column: values that a lenient cast lost, and the first of their texts."""
    each = rows.select("source_file", F.explode(RESCUED).alias("column_name", "raw_value"))
    return each.groupBy("source_file", "column_name").agg(F.count(F.lit(1)).alias("lost"), F.min("raw_value").alias("example"))


def canonicalize(df: DataFrame, rename: Mapping[str, str] = CANONICAL_NAMES) -> DataFrame:
    """Names, lenient types, absent money columns as NULL, flag as text."""
    out = canonicalize_names(df, rename)
    cols = set(out.columns)
    updates: dict[str, Column] = {}
    for ts in ("pickup_at", "dropoff_at"):
        if ts in cols:
            updates[ts] = to_timestamp_ntz(out, ts)
    for c in INTEGER_ID_COLUMNS:
        if c in cols:
            updates[c] = F.col(c).try_cast(T.LongType())
    for c in ("trip_distance", *MONEY_COLUMNS):
        if c in cols:
            updates[c] = F.col(c).try_cast(T.DoubleType())
    for c in MONEY_COLUMNS:
        if c not in cols:
            updates[c] = F.lit(None).cast(T.DoubleType())
    if "store_and_fwd_flag" in cols:
        updates["store_and_fwd_flag"] = F.col("store_and_fwd_flag").cast(T.StringType())
    return out.withColumns(updates) if updates else out


def narrow_base_types(df: DataFrame) -> DataFrame:
    """Distance renamed to ``trip_distance_mi``; ids narrowed (overflow -> NULL).

    Fails like the reference does when a base column is missing altogether.
    """
    out = df
    if "trip_distance_mi" not in out.columns and "trip_distance" in out.columns:
        out = out.withColumnRenamed("trip_distance", "trip_distance_mi")
    contract = {f.name: f.dataType for f in BRONZE_CONTRACT.fields}
    missing = [c for c in BASE_COLUMNS if c not in out.columns]
    if missing:
        raise ValueError(f"raw data lacks required columns: {missing}")
    return out.withColumns({c: F.col(c).try_cast(contract[c]) for c in BASE_COLUMNS})


def select_contract(df: DataFrame, contract: T.StructType = BRONZE_CONTRACT) -> DataFrame:
    """Add absent contract columns as NULL, cast leniently, keep only the contract, in order."""
    present = set(df.columns)
    return df.select(
        *[
            (F.col(f.name).try_cast(f.dataType) if f.name in present else F.lit(None).cast(f.dataType)).alias(
                f.name
            )
            for f in contract.fields
        ]
    )


def check_contract(df: DataFrame, expected: Iterable[str]) -> None:
    """Name-only contract check (driver side, no job): raise on missing or extra columns."""
    names = set(df.columns)
    want = set(expected)
    missing, extra = sorted(want - names), sorted(names - want)
    if missing or extra:
        raise ValueError(
            "bronze schema mismatch\n"
            f"missing columns: {missing}\n"
            f"extra columns:   {extra}\n"
            "rebuild bronze before running silver"
        )


def drop_optional(df: DataFrame, names: Iterable[str] = SILVER_DROP_COLUMNS) -> DataFrame:
    return df.drop(*[n for n in names if n in df.columns])


def silver_normalize(df: DataFrame) -> DataFrame:
    """Silver re-normalisation: six dependent columns typed, QA flags NULL -> false."""
    updates = {
        "pickup_at": F.col("pickup_at").try_cast(T.TimestampNTZType()),
        "dropoff_at": F.col("dropoff_at").try_cast(T.TimestampNTZType()),
        "pu_location_id": F.col("pu_location_id").try_cast(T.IntegerType()),
        "do_location_id": F.col("do_location_id").try_cast(T.IntegerType()),
        "trip_distance_mi": F.col("trip_distance_mi").try_cast(T.DoubleType()),
        "total_amount": F.col("total_amount").try_cast(T.DoubleType()),
    }
    for flag in QA_FLAG_COLUMNS:
        updates[flag] = F.coalesce(F.col(flag).cast(T.BooleanType()), F.lit(False))
    return df.withColumns(updates)
