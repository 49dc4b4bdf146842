"""The command line runs the pipeline end to end on a small raw folder."""

import datetime as dt
import os
import tempfile

from test_normalize import _raw_cols, _write

from fareline.cli import run


def test_cli_end_to_end(spark):
    d = tempfile.mkdtemp(prefix="fareline-cli-")
    raw = os.path.join(d, "raw")
    os.makedirs(raw)
    _write(os.path.join(raw, "yellow_tripdata_2024-01.parquet"), _raw_cols(6, dt.datetime(2024, 1, 3)))
    _write(os.path.join(raw, "yellow_tripdata_2024-02.parquet"), _raw_cols(4, dt.datetime(2024, 2, 3), fee_name="Airport_fee"))
    zones = os.path.join(d, "taxi_zones.csv")
    with open(zones, "w") as f:
        f.write('"LocationID","Borough","Zone","service_zone"\n5,"Queens","JFK Airport","Airports"\n7,"Manhattan","Midtown","Yellow Zone"\n')
    b, s, w = (os.path.join(d, x) for x in ("bronze", "silver", "warehouse"))
    assert run(["bronze", "--raw-dir", raw, "--out", b], spark) == {
        "files": 2, "rows_in": 10, "rows_written": 10, "duplicates_removed": 0}
    rep = run(["silver", "--bronze", b, "--out", s], spark)
    assert rep["trips_clean"] == 10 and rep["coverage_ok"]
    out = run(["warehouse", "--silver", s, "--zones", zones, "--out", w, "--check"], spark)
    assert "mart_airport_daily" in out["tables"]
    failing = {(c["check_name"], c["table_name"], c["column_name"]) for c in out["checks"] if not c["passed"]}
    assert failing == set()
    chk = run(["check", "--silver", s, "--warehouse", w], spark)
    assert len(chk["checks"]) == 53 and chk["failed"] == 0
    prof = run(["profile", "--warehouse", w], spark)
    assert {t["table_name"]: t["row_count"] for t in prof["tables"]}["fact_trips"] == 10
    assert all(r["orphan_rows"] == 0 for r in prof["relationships"])
    ans = run(["ask", "--warehouse", w, "--question", "window_kpis", "--days", "30"], spark)
    assert ans["rows"][0]["trips_current"] == 4  # the February file's trips
    ap = run(["ask", "--warehouse", w, "--question", "zone_hotspots", "--days", "90", "--min-trips", "1"], spark)
    assert [r["location_id"] for r in ap["rows"]] == [5]


def test_whole_answers_and_wrong_folders(spark):
    """A long daily series comes back whole; a folder without a warehouse raises."""
    import pytest
    from pyspark.errors import AnalysisException

    from fareline.plans import tpch_trips
    from fareline.plans.warehouse import read_warehouse, write_warehouse
    from fareline.sources import fixture
    from helpers import SF001

    d = tempfile.mkdtemp(prefix="fareline-cli2-")
    wh = tpch_trips.warehouse(spark, SF001, materialize="silver")
    write_warehouse(spark, wh, d, fixture.vendors(spark), fixture.payment_types(spark), fixture.zones(spark, SF001), airport=fixture.FIXTURE_AIRPORTS)
    n = read_warehouse(spark, d)["mart_kpi_daily"].count()
    assert n > 1000
    got = run(["ask", "--warehouse", d, "--question", "kpi_daily_series", "--days", "2000"], spark)["rows"]
    assert len(got) > 1000
    out = run(["ask", "--warehouse", d, "--question", "kpi_daily_series", "--days", "2000", "--out", f"{d}/answer"], spark)
    assert out["rows_written"] == len(got) == spark.read.json(f"{d}/answer").count()
    with pytest.raises(AnalysisException):
        run(["ask", "--warehouse", f"{d}/nothing", "--question", "window_kpis"], spark)
