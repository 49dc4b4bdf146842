"""Repeated keys too many to broadcast: the same rows stay, and those without a repeated key aren't shuffled."""

import datetime as dt
import os
import tempfile

from pyspark.sql import functions as F

from helpers import T0, frame, trip

from fareline.operators import dedup
from fareline.operators.dedup import duplicate_keys, key_filter, may_hold
from fareline.plans import bronze as B

NAN = float("nan")
ROWS = [
    trip(), trip(tip_amount=9.0), trip(fare_amount=0.0), trip(fare_amount=-0.0), trip(fare_amount=NAN), trip(fare_amount=NAN),
    trip(vendor_id=None), trip(vendor_id=None), trip(source_file="trips_2024-02.parquet"), trip(source_file=None), trip(source_file=None),
    *[trip(pickup_at=T0 + dt.timedelta(seconds=i)) for i in range(1, 40)],
]


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def as_rows(df):
    return sorted(map(str, df.collect()))


def plain(spark):
    """A session whose planner broadcasts nothing by size."""
    s = spark.newSession()
    s.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    return s


def test_large_key_set_gives_the_rows_of_a_small_one(spark, monkeypatch):
    for keep in ("none", "first"):
        want = as_rows(B.dedup_with_key_set(frame(spark, ROWS), keep))
        assert len(want) == 40 + (5 if keep == "first" else 0)
        assert as_rows(B.dedup_with_key_set(frame(plain(spark), ROWS), keep)) == want
    # every row passes the filter when all hashes are equal
    monkeypatch.setattr(dedup, "_key_hash", lambda df, cols: F.lit(7).cast("long"))
    assert as_rows(B.dedup_with_key_set(frame(plain(spark), ROWS), "first")) == want


def test_rows_without_a_repeated_key_stay_in_their_task(spark):
    s = plain(spark)
    d = tempfile.mkdtemp(prefix="fareline-stay-")
    months = [f"trips_2024-{m:02d}.parquet" for m in range(1, 13)]
    rows = [trip(source_file=f, pickup_at=T0 + dt.timedelta(seconds=i // 2 if i < 20 else i)) for f in months for i in range(200)]
    frame(s, rows).repartition("source_file").write.partitionBy("source_file").parquet(os.path.join(d, "raw"))
    raw = s.read.parquet(os.path.join(d, "raw"))
    s.conf.set("spark.sql.files.openCostInBytes", "128m")  # a task for each file
    s.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    out = B.bronze_from_raw(raw, canonical=True)
    assert B.write_bronze(out, os.path.join(d, "bronze")) == {"rows_written": 12 * 180}
    files = [f for _, _, names in os.walk(os.path.join(d, "bronze")) for f in names if f.endswith(".parquet")]
    assert len(files) == 12  # a shuffled anti join of all rows writes every month from every task


def test_filter_holds_every_key_and_few_others(spark, monkeypatch):
    cols = [*B.DUP_KEY_COLUMNS, "source_file"]
    df = frame(spark, ROWS)
    dups = duplicate_keys(df)
    for chunk in (4096, 64):  # several chunks as well
        monkeypatch.setattr(dedup, "CHUNK", chunk)
        monkeypatch.setattr(dedup, "LEAST_CHUNKS", 4)
        bits, cells = key_filter(dups, cols)
        assert [len(x) for x in bits.first()["bits"]] == [chunk] * 4 and cells == chunk * 256
        held = df.where(may_hold(bits.scalar(), cells, df, cols))
        assert 10 <= held.count() <= 13
        assert sum(r["_copies"] for r in duplicate_keys(held).collect()) == 10
    assert key_filter(dups.limit(0), cols)[0].count() == 1  # no key, no row held


def test_the_filter_is_not_worked_out_from_raw_texts(spark):
    """Casts of the key columns run once for a row, not once more below them for the filter."""
    text = frame(plain(spark), ROWS).withColumn("fare_amount", F.col("fare_amount").cast("string"))
    out = B.bronze_from_raw(text.select("*", F.col("trip_distance_mi").alias("trip_distance")).drop("trip_distance_mi"))
    optimized = out._jdf.queryExecution().optimizedPlan().toString()
    filters = [line for line in optimized.splitlines() if "Filter" in line and "scalar-subquery" in line]
    assert len(filters) == 2 and not any("try_cast" in line.lower() or "cast(fare_amount" in line for line in filters)
