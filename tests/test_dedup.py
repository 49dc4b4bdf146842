"""Per-file de-duplication (every copy of a repeated key is removed)."""

import datetime as dt

from helpers import T0, frame, trip

from fareline.operators.dedup import add_dup_key, dedup_in_file, dedup_report
from fareline.plans.bronze import bronze_from_raw


def test_three_copies_in_one_file_are_all_dropped(spark):
    rows = [trip(), trip(), trip(), trip(pickup_at=T0 + dt.timedelta(seconds=1))]
    out = bronze_from_raw(frame(spark, rows), canonical=True)
    assert out.count() == 1
    assert out.collect()[0]["qa_is_duplicate_in_file"] is False


def test_equal_keys_in_two_files_are_both_kept(spark):
    rows = [trip(), trip(source_file="trips_2024-02.parquet")]
    assert bronze_from_raw(frame(spark, rows), canonical=True).count() == 2


def test_equal_keys_with_null_parts_are_dropped(spark):
    rows = [trip(vendor_id=None, fare_amount=None)] * 2
    assert bronze_from_raw(frame(spark, rows), canonical=True).count() == 0


def test_non_key_columns_do_not_matter(spark):
    rows = [trip(tip_amount=1.0), trip(tip_amount=2.0)]  # same key, different tip
    assert bronze_from_raw(frame(spark, rows), canonical=True).count() == 0


def test_keep_first_keeps_one(spark):
    rows = [trip(tip_amount=1.0), trip(tip_amount=2.0), trip(pickup_at=T0 + dt.timedelta(seconds=5))]
    out = dedup_in_file(frame(spark, rows), keep="first")
    assert out.count() == 2
    kept = [r for r in out.collect() if r["pickup_at"] == T0][0]
    assert kept["tip_amount"] == 1.0 and kept["qa_is_duplicate_in_file"] is True


def test_report_counts(spark):
    rows = [trip(), trip(), trip(pickup_at=T0 + dt.timedelta(seconds=1))]
    r = dedup_report(frame(spark, rows)).collect()[0]
    assert (r["rows_in"], r["duplicates_removed"], r["rows_written"]) == (3, 2, 1)


def test_dup_key_null_safe(spark):
    df = spark.createDataFrame([(1, None), (None, 1), (1, None)], "a int, b int")
    keys = [r["k"] for r in add_dup_key(df, ["a", "b"], "k").collect()]
    assert keys[0] == keys[2] and keys[0] != keys[1]
    assert all(len(k) == 32 for k in keys)


def test_dup_key_keeps_microseconds(spark):
    a, b = T0, T0 + dt.timedelta(microseconds=1)
    df = spark.createDataFrame([(a,), (b,)], "t timestamp_ntz")
    keys = [r["k"] for r in add_dup_key(df, ["t"], "k").collect()]
    assert keys[0] != keys[1]


def test_key_set_keep_first(spark):
    from fareline.operators.dedup import drop_duplicate_keys, duplicate_keys

    rows = [trip(tip_amount=1.0), trip(tip_amount=2.0), trip(vendor_id=None), trip(vendor_id=None),
            trip(pickup_at=T0 + dt.timedelta(seconds=5))]
    df = frame(spark, rows)
    dups = duplicate_keys(df)
    assert sorted(r["_copies"] for r in dups.collect()) == [2, 2]
    none = drop_duplicate_keys(df, dups)
    assert [r["pickup_at"] for r in none.collect()] == [T0 + dt.timedelta(seconds=5)]
    first = drop_duplicate_keys(df, dups, keep="first").collect()
    assert len(first) == 3
    kept = [r for r in first if r["pickup_at"] == T0 and r["vendor_id"] == 1][0]
    assert kept["tip_amount"] == 1.0 and kept["qa_is_duplicate_in_file"] is True


def test_report_shuffles_hashes_and_checks_repeated_ones_on_the_columns(spark, monkeypatch):
    from pyspark.sql import functions as F

    from fareline.operators import dedup

    rows = [trip(), trip(), trip(fare_amount=0.0), trip(fare_amount=-0.0), trip(vendor_id=None), trip(vendor_id=None),
            trip(pickup_at=T0 + dt.timedelta(seconds=1)), trip(source_file="trips_2024-02.parquet"), trip(source_file=None)]
    want = {("trips_2024-01.parquet", 7, 6, 1), ("trips_2024-02.parquet", 1, 0, 1), (None, 1, 0, 1)}
    written = []
    shared = dedup.write_shared
    monkeypatch.setattr(dedup, "write_shared", lambda df, name: written.append(df.columns) or shared(df, name))
    assert {tuple(r) for r in dedup_report(frame(spark, rows)).collect()} == want
    assert written == [["_key_hash"]]  # nothing but hashes of all rows
    monkeypatch.setattr(dedup, "_key_hash", lambda df, cols: F.lit(1).cast("long"))  # every row collides
    assert {tuple(r) for r in dedup_report(frame(spark, rows)).collect()} == want
