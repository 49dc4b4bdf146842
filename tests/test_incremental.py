"""Refreshing a store file by file gives the tables of a full build, and only touched months are merged anew."""

import datetime as dt
import math
import os
import tempfile

import pytest
from test_normalize import _raw_cols, _write

from fareline.operators.marts import MART_BUILDERS
from fareline.plans.bronze import run_bronze
from fareline.plans.incremental import Seeds, refresh
from fareline.plans.silver import read_silver, run_silver, read_bronze
from fareline.plans.store import Store
from fareline.plans.warehouse import build_warehouse, read_warehouse, write_warehouse
from fareline.sources import seeds as S
from fareline.streaming.landing import start_warehouse_stream

TABLES = ("fact_trips", "fact_revenue_adjustments", "dim_date", "dim_payment", "dim_vendor", "dim_zone", *MART_BUILDERS)


@pytest.fixture
def seeds(spark):
    zones = spark.createDataFrame([(5, "Queens", "JFK Airport", "Airports"), (7, "Manhattan", "Midtown", "Yellow Zone")], S.ZONE_SCHEMA)
    return Seeds(S.vendors_seed(spark), S.payment_types_seed(spark), zones)


def landed(folder, name, n, when, change=None):
    cols = _raw_cols(n, when)
    if change:
        change(cols)
    path = os.path.join(folder, name)
    _write(path, cols)
    return path


def table(df):
    """Rows without the month column, doubles to nine digits, in a fixed order."""
    def plain(v):
        return None if v is None or isinstance(v, float) and math.isnan(v) else float(f"{v:.9g}") if isinstance(v, float) else v

    names = sorted(c for c in df.columns if c != "date_month")
    return sorted((tuple(plain(r[c]) for c in names) for r in df.collect()), key=repr)


def full(spark, raw, seeds):
    d = tempfile.mkdtemp(prefix="fareline-full-")
    b, s, w = (os.path.join(d, x) for x in "bsw")
    run_bronze(spark, raw, b)
    run_silver(read_bronze(spark, b), s)
    lazy = build_warehouse(read_silver(spark, s), seeds.vendors, seeds.payment_types, seeds.zones)
    return write_warehouse(spark, lazy, w, seeds.vendors, seeds.payment_types, seeds.zones)


def same(spark, root, raw, seeds):
    got, want = read_warehouse(spark, root), full(spark, raw, seeds)
    for name in TABLES:
        assert sorted(c for c in got[name].columns if c != "date_month") == sorted(c for c in want[name].columns if c != "date_month"), name
        assert table(got[name]) == table(want[name]), name


def test_replaced_files_give_the_full_build(spark, seeds):
    base = tempfile.mkdtemp(prefix="fareline-inc-")
    raw, root = os.path.join(base, "raw"), os.path.join(base, "store")
    os.makedirs(raw)
    files = [
        landed(raw, "yellow_tripdata_2024-01.parquet", 40, dt.datetime(2024, 1, 30, 23)),
        landed(raw, "green_tripdata_2024-01.parquet", 9, dt.datetime(2024, 1, 5)),
        landed(raw, "yellow_tripdata_2024-02.parquet", 12, dt.datetime(2024, 2, 3)),
    ]
    assert refresh(spark, root, files, seeds)["version"] == 1
    same(spark, root, raw, seeds)
    # a file lands again with other rows: its months, before and now, are merged anew
    march = Store(spark, root).tables()["mart_kpi_daily"].units
    again = landed(raw, "green_tripdata_2024-01.parquet", 4, dt.datetime(2024, 1, 5), lambda c: c.update(fare_amount=c["fare_amount"].take([0] * 4)))
    out = refresh(spark, root, [again], seeds)
    assert out["months"] == ["2024-01"]
    now = Store(spark, root).tables()["mart_kpi_daily"].units
    assert {u for u in march if march[u] != now.get(u)} == {"date_month=2024-01"}
    same(spark, root, raw, seeds)
    # the file's rows all go (copies of one key), with its month's share of every mart
    gone = landed(raw, "yellow_tripdata_2024-02.parquet", 2, dt.datetime(2024, 2, 3), lambda c: c.update({k: v.take([0, 0]) for k, v in c.items()}))
    refresh(spark, root, [gone], seeds)
    assert not any("2024-02" in u and "yellow" in u for u in Store(spark, root).tables()["fact_trips"].units)
    same(spark, root, raw, seeds)
    # the version before is still there
    assert read_warehouse(spark, root, version=1)["fact_trips"].count() > read_warehouse(spark, root)["fact_trips"].count()


def test_a_refresh_that_dies_changes_nothing(spark, seeds, monkeypatch):
    from fareline.plans import incremental

    base = tempfile.mkdtemp(prefix="fareline-inc2-")
    root = os.path.join(base, "store")
    f = landed(base, "yellow_tripdata_2024-01.parquet", 10, dt.datetime(2024, 1, 3))
    refresh(spark, root, [f], seeds)
    before = table(read_warehouse(spark, root)["mart_kpi_daily"])
    landed(base, "yellow_tripdata_2024-01.parquet", 5, dt.datetime(2024, 1, 3))
    with monkeypatch.context() as m:
        m.setattr(incremental, "_write_dimensions", lambda *_: (_ for _ in ()).throw(RuntimeError("killed")))
        with pytest.raises(RuntimeError, match="killed"):
            refresh(spark, root, [f], seeds)
    assert table(read_warehouse(spark, root)["mart_kpi_daily"]) == before and Store(spark, root).read("bronze").count() == 10
    refresh(spark, root, [f], seeds)
    assert Store(spark, root).read("bronze").count() == 5
    assert refresh(spark, root, [], seeds) == {"version": 2, "months": []}


def test_stream_reaches_the_marts(spark, seeds):
    base = tempfile.mkdtemp(prefix="fareline-inc3-")
    raw, root, ckpt = (os.path.join(base, x) for x in ("raw", "store", "ckpt"))
    os.makedirs(raw)
    landed(raw, "yellow_tripdata_2024-01.parquet", 8, dt.datetime(2024, 1, 3))
    start_warehouse_stream(spark, raw, root, ckpt, seeds).awaitTermination(240)
    landed(raw, "yellow_tripdata_2024-02.parquet", 6, dt.datetime(2024, 2, 3))
    start_warehouse_stream(spark, raw, root, ckpt, seeds).awaitTermination(240)
    assert Store(spark, root).version() == 2
    same(spark, root, raw, seeds)
