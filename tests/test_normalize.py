"""Canonicalisation of drifting raw files (names, types, absent columns, lineage)."""

import datetime as dt
import os
import tempfile

import pyarrow as pa
import pyarrow.parquet as pq
import pytest

from fareline.config import BRONZE_COLUMNS
from fareline.operators.normalize import canonicalize, narrow_base_types, select_contract
from fareline.plans.bronze import build_bronze
from fareline.sources.raw import list_raw_files, parse_year_month


def test_text_timestamps_and_numbers_are_lenient(spark):
    df = spark.createDataFrame(
        [("2024-01-05 10:00:00", "x", "3"), ("not a time", "2.5", "99999")],
        "tpep_pickup_datetime string, fare_amount string, VendorID string",
    )
    out = canonicalize(df).collect()
    assert out[0]["pickup_at"] == dt.datetime(2024, 1, 5, 10) and out[1]["pickup_at"] is None
    assert out[0]["fare_amount"] is None and out[1]["fare_amount"] == 2.5
    assert canonicalize(df).schema["vendor_id"].dataType.simpleString() == "bigint"


def test_absent_money_columns_are_null(spark):
    df = spark.createDataFrame([(1,)], "VendorID int")
    out = canonicalize(df)
    assert out.collect()[0]["cbd_congestion_fee"] is None
    assert out.schema["airport_fee"].dataType.simpleString() == "double"


def test_narrowing_overflow_is_null(spark):
    df = spark.createDataFrame([(40000,)], "vendor_id bigint")
    df = canonicalize(df)
    base = select_contract(df)
    assert base.collect()[0]["vendor_id"] is None
    assert base.columns == list(BRONZE_COLUMNS)


def test_missing_base_column_fails(spark):
    df = canonicalize(spark.createDataFrame([(1,)], "VendorID int"))
    with pytest.raises(ValueError, match="lacks required columns"):
        narrow_base_types(df)


def test_year_month_from_name():
    assert parse_year_month("/x/yellow_tripdata_2024-03.parquet") == (2024, 3)
    with pytest.raises(ValueError):
        parse_year_month("/x/trips.parquet")


def _write(path, cols):
    pq.write_table(pa.table(cols), path)


def _raw_cols(n, pickup, *, fee_name="airport_fee", distance_type=pa.float64(), with_cbd=False):
    cols = {
        "VendorID": pa.array([1] * n, pa.int32()),
        "tpep_pickup_datetime": pa.array([pickup + dt.timedelta(minutes=i) for i in range(n)], pa.timestamp("us")),
        "tpep_dropoff_datetime": pa.array([pickup + dt.timedelta(minutes=i + 15) for i in range(n)], pa.timestamp("us")),
        "passenger_count": pa.array([1.0] * n),
        "trip_distance": pa.array([3] * n, distance_type),
        "RatecodeID": pa.array([1.0] * n),
        "store_and_fwd_flag": pa.array(["N"] * n),
        "PULocationID": pa.array([5] * n, pa.int32()),
        "DOLocationID": pa.array([7] * n, pa.int32()),
        "payment_type": pa.array([1] * n, pa.int64()),
        "fare_amount": pa.array([10.0] * n),
        "extra": pa.array([0.0] * n),
        "mta_tax": pa.array([0.5] * n),
        "tip_amount": pa.array([2.0] * n),
        "tolls_amount": pa.array([0.0] * n),
        "improvement_surcharge": pa.array([1.0] * n),
        "total_amount": pa.array([13.5] * n),
        "congestion_surcharge": pa.array([0.0] * n),
        fee_name: pa.array([0.0] * n),
    }
    if with_cbd:
        cols["cbd_congestion_fee"] = pa.array([0.0] * n)
    return cols


def test_bronze_over_drifting_files(spark):
    d = tempfile.mkdtemp(prefix="fareline-raw-")
    _write(os.path.join(d, "yellow_tripdata_2024-01.parquet"), _raw_cols(3, dt.datetime(2024, 1, 3)))
    _write(
        os.path.join(d, "yellow_tripdata_2024-02.parquet"),
        _raw_cols(4, dt.datetime(2024, 2, 3), fee_name="Airport_fee", distance_type=pa.int64()),
    )
    _write(os.path.join(d, "yellow_tripdata_2025-01.parquet"), _raw_cols(2, dt.datetime(2025, 1, 3), with_cbd=True))
    assert [os.path.basename(f) for f in list_raw_files(spark, d)] == [
        "yellow_tripdata_2024-01.parquet", "yellow_tripdata_2024-02.parquet", "yellow_tripdata_2025-01.parquet"]
    b = build_bronze(spark, d)
    assert b.columns == list(BRONZE_COLUMNS)
    rows = b.collect()
    assert len(rows) == 9
    per_file = {}
    for r in rows:
        per_file.setdefault(r["source_file"], []).append(r)
    assert {k: len(v) for k, v in per_file.items()} == {
        "yellow_tripdata_2024-01.parquet": 3, "yellow_tripdata_2024-02.parquet": 4, "yellow_tripdata_2025-01.parquet": 2}
    feb = per_file["yellow_tripdata_2024-02.parquet"][0]
    assert (feb["source_year"], feb["source_month"], feb["trip_distance_mi"], feb["airport_fee"]) == (2024, 2, 3.0, 0.0)
    assert per_file["yellow_tripdata_2024-01.parquet"][0]["cbd_congestion_fee"] is None
    assert all(r["qa_in_file_window"] for r in rows)


def test_empty_folder_raises(spark):
    d = tempfile.mkdtemp(prefix="fareline-empty-")
    with pytest.raises(FileNotFoundError):
        list_raw_files(spark, d)


def test_distributed_footer_scan_finds_the_same_families(spark):
    from fareline.sources.raw import schema_families

    d = tempfile.mkdtemp(prefix="fareline-foot-")
    _write(os.path.join(d, "a_2024-01.parquet"), _raw_cols(2, dt.datetime(2024, 1, 3)))
    _write(os.path.join(d, "b_2024-02.parquet"), _raw_cols(2, dt.datetime(2024, 2, 3), fee_name="Airport_fee"))
    _write(os.path.join(d, "c_2024-03.parquet"), _raw_cols(2, dt.datetime(2024, 3, 3)))
    files = list_raw_files(spark, d)
    found = [[os.path.basename(p) for p in v] for v in schema_families(spark, files).values()]
    assert found == [["a_2024-01.parquet", "c_2024-03.parquet"], ["b_2024-02.parquet"]]


def test_footer_schemas_read_by_tasks(spark):
    from fareline.sources.raw import footer_schemas

    d = tempfile.mkdtemp(prefix="fareline-foot2-")
    _write(os.path.join(d, "a_2024-01.parquet"), _raw_cols(2, dt.datetime(2024, 1, 3)))
    _write(os.path.join(d, "b_2024-02.parquet"), _raw_cols(2, dt.datetime(2024, 2, 3), fee_name="Airport_fee"))
    files = list_raw_files(spark, d)
    found = {r["path"]: r["schema"] for r in footer_schemas(spark, files, partitions=2).collect()}
    assert set(found) == set(files)
    assert "Airport_fee" in found[files[1]] and "Airport_fee" not in found[files[0]]


def test_unreadable_folder_is_not_called_empty(spark):
    d = tempfile.mkdtemp(prefix="fareline-bad-")
    with open(os.path.join(d, "a_2024-01.parquet"), "w") as f:
        f.write("not parquet")
    assert len(list_raw_files(spark, d)) == 1  # listing opens no file
    from fareline.sources.raw import schema_families

    with pytest.raises(Exception, match="(?i)parquet"):
        schema_families(spark, list_raw_files(spark, d))
    with pytest.raises(FileNotFoundError):
        list_raw_files(spark, os.path.join(d, "missing"))


def test_nanosecond_files_and_time_texts(spark):
    import pyarrow as pa
    import pyarrow.parquet as pq

    from fareline.plans.bronze import build_bronze

    d = tempfile.mkdtemp(prefix="fareline-nanos-")
    cols = _raw_cols(3, dt.datetime(2024, 1, 3))
    for c in ("tpep_pickup_datetime", "tpep_dropoff_datetime"):
        cols[c] = cols[c].cast(pa.timestamp("ns"))
    pq.write_table(pa.table(cols), os.path.join(d, "y_2024-01.parquet"), version="2.6")
    assert pq.read_schema(os.path.join(d, "y_2024-01.parquet")).field("tpep_pickup_datetime").type == pa.timestamp("ns")
    want = dt.datetime(2024, 2, 3, 14, 5, 6)
    texts = ["2/3/2024 2:05:06 PM", "02/03/2024 14:05:06", "2024/02/03 14:05:06", "20240203 140506", "20240203140506", "3-Feb-2024 14:05:06", "Feb 3, 2024 14:05:06", "2024-02-03T14:05:06", "13/45/2024 1:00:00", "no time"]
    cols = _raw_cols(len(texts), dt.datetime(2024, 2, 3))
    cols["tpep_pickup_datetime"] = pa.array(texts)
    pq.write_table(pa.table(cols), os.path.join(d, "y_2024-02.parquet"))
    rows = build_bronze(spark, d).collect()
    jan = [r["pickup_at"] for r in rows if r["source_month"] == 1]
    assert len(jan) == 3 and all(t.year == 2024 and t.month == 1 for t in jan) and min(jan) == dt.datetime(2024, 1, 3)
    feb = sorted(str(r["pickup_at"]) for r in rows if r["source_month"] == 2)
    # equal times are equal keys unless other key columns differ; both unreadable texts give NULL
    assert set(feb) <= {str(want), "None"}


def test_integer_times_are_nanoseconds(spark):
    from fareline.operators.normalize import to_timestamp_ntz

    df = spark.createDataFrame([(1_704_245_400_123_456_789,), (None,), (-1_000,)], "t long")
    assert [r[0] for r in df.select(to_timestamp_ntz(df, "t")).collect()] == [dt.datetime(2024, 1, 3, 1, 30, 0, 123456), None, dt.datetime(1969, 12, 31, 23, 59, 59, 999999)]


def test_time_units_come_from_the_footer(spark):
    """Nanoseconds are told from plain integers by the file's own type; a plain integer is read as its text."""
    from fareline.sources.raw import time_units

    d = tempfile.mkdtemp(prefix="fareline-units-")
    want = dt.datetime(2024, 2, 3, 14, 5, 6)
    for month, unit in enumerate(("ns", "us", "ms"), start=1):
        cols = _raw_cols(1, want)
        for c in ("tpep_pickup_datetime", "tpep_dropoff_datetime"):
            cols[c] = cols[c].cast(pa.timestamp(unit))
        pq.write_table(pa.table(cols), os.path.join(d, f"y_2024-0{month}.parquet"), version="2.6")
    cols = _raw_cols(2, want)
    # a written-out time, and seconds of the epoch, which no layout reads
    cols["tpep_pickup_datetime"] = pa.array([20240203140506, 1706968800], pa.int64())
    pq.write_table(pa.table(cols), os.path.join(d, "y_2024-04.parquet"))
    rows = build_bronze(spark, d).collect()
    got = {}
    for r in rows:
        got.setdefault(r["source_month"], []).append(r["pickup_at"])
    assert got[1] == got[2] == got[3] == [want] and sorted(got[4], key=str) == [want, None]
    assert time_units("a: timestamp[ns]\nb: int64\nc: timestamp[us, tz=UTC]") == {"a": "ns", "c": "us"}
    assert time_units("message m {\n  optional int64 a (TIMESTAMP(NANOS,false));\n  required int64 c (TIMESTAMP(MILLIS,true));\n  optional int64 b;\n}") == {"a": "ns", "c": "ms"}


def test_times_with_words_around_them(spark):
    want = dt.datetime(2024, 2, 3, 14, 5, 6)
    texts = {
        "picked up 2024-02-03 14:05:06 (local)": want, "2024-02-03T14:05:06.250 EST?": want.replace(microsecond=250000), "at 2/3/2024 2:05:06 PM sharp": want,
        "x20240203140506": want, "120240203140506": None, "on 2024/02/03 14:05:06!": want, "13/45/2024 1:00:00 am": None, "soon": None, "2024-02-30 14:05:06 no day": None,
    }
    df = spark.createDataFrame([(t,) for t in texts], "tpep_pickup_datetime string")
    assert [r["pickup_at"] for r in canonicalize(df).collect()] == list(texts.values())


def test_lost_values_are_counted_and_kept(spark):
    from fareline.plans.bronze import run_bronze
    from fareline.plans.store import Store

    d = tempfile.mkdtemp(prefix="fareline-lost-")
    raw, out = os.path.join(d, "raw"), os.path.join(d, "bronze")
    os.makedirs(raw)
    cols = _raw_cols(4, dt.datetime(2024, 1, 3))
    cols["fare_amount"] = pa.array(["10.0", "ten", "ten", None])
    cols["payment_type"] = pa.array([1, 99999, 1, None], pa.int64())
    _write(os.path.join(raw, "a_2024-01.parquet"), cols)
    _write(os.path.join(raw, "b_2024-02.parquet"), _raw_cols(3, dt.datetime(2024, 2, 3)))
    report = run_bronze(spark, raw, out)
    assert report["rows_written"] == 7 and report["cast_losses"] == {"fare_amount": 2, "payment_type": 1}
    kept = {(r.source_file, r.column_name, r.raw_value): r.rows for r in Store(spark, out).read("rescued").collect()}
    assert kept == {("a_2024-01.parquet", "fare_amount", "ten"): 2, ("a_2024-01.parquet", "payment_type", "99999"): 1}
    # a build without losses leaves none of an earlier one behind
    os.remove(os.path.join(raw, "a_2024-01.parquet"))
    assert "cast_losses" not in run_bronze(spark, raw, out) and Store(spark, out).read("rescued").collect() == []


def test_footers_on_storage_that_only_hadoop_opens(spark):
    """A mount that Arrow doesn't know: footers, families and rows come through Spark's own file systems."""
    from fareline.sources.raw import schema_families

    d = tempfile.mkdtemp(prefix="fareline-view-")
    cols = _raw_cols(2, dt.datetime(2024, 1, 3))
    cols["tpep_pickup_datetime"] = cols["tpep_pickup_datetime"].cast(pa.timestamp("ns"))
    pq.write_table(pa.table(cols), os.path.join(d, "a_2024-01.parquet"), version="2.6")
    _write(os.path.join(d, "b_2024-02.parquet"), _raw_cols(3, dt.datetime(2024, 2, 3), fee_name="Airport_fee"))
    spark.sparkContext._jsc.hadoopConfiguration().set("fs.viewfs.mounttable.raw.link./in", f"file://{d}")
    files = list_raw_files(spark, "viewfs://raw/in")
    assert [len(v) for v in schema_families(spark, files).values()] == [1, 1]
    rows = build_bronze(spark, "viewfs://raw/in").collect()
    assert len(rows) == 5 and min(r["pickup_at"] for r in rows) == dt.datetime(2024, 1, 3)


def test_nanosecond_files_in_a_session_without_the_librarys_settings(spark):
    import pyarrow as pa
    import pyarrow.parquet as pq

    from fareline.plans.bronze import build_bronze

    d = tempfile.mkdtemp(prefix="fareline-nanos-plain-")
    cols = _raw_cols(3, dt.datetime(2024, 1, 3))
    for c in ("tpep_pickup_datetime", "tpep_dropoff_datetime"):
        cols[c] = cols[c].cast(pa.timestamp("ns"))
    pq.write_table(pa.table(cols), os.path.join(d, "y_2024-01.parquet"), version="2.6")
    for uniform in (False, True):
        plain = spark.newSession()
        plain.conf.set("spark.sql.legacy.parquet.nanosAsLong", "false")
        rows = build_bronze(plain, d, uniform=uniform).collect()
        assert len(rows) == 3 and min(r["pickup_at"] for r in rows) == dt.datetime(2024, 1, 3)
