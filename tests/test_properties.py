"""Property tests: de-duplication and split labels against a plain-Python brute force."""

import datetime as dt
from collections import Counter

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from helpers import T0, frame, trip

from fareline.config import DUP_KEY_COLUMNS
from fareline.plans.bronze import bronze_from_raw
from fareline.plans.silver import silver_from_bronze

KEY = ("source_file", *DUP_KEY_COLUMNS)

rows_strategy = st.lists(
    st.fixed_dictionaries(
        {
            "vendor_id": st.sampled_from([1, 2, None]),
            "minute": st.integers(0, 3),
            "pu": st.sampled_from([0, 1, 2, None]),
            "fare": st.sampled_from([10.0, -1.0, None]),
            "miles": st.sampled_from([0.0, 2.0, 200.0, None]),
            "total": st.sampled_from([None, 14.5, 15.0, 30.0]),
            "payment": st.sampled_from([1, 2, 3, None]),
            "file": st.sampled_from(["trips_2024-01.parquet", "trips_2024-02.parquet"]),
            "dur": st.sampled_from([0, 30, 600, 30000]),
        }
    ),
    min_size=0,
    max_size=12,
)


def to_trips(rs):
    out = []
    for r in rs:
        p = T0 + dt.timedelta(minutes=r["minute"])
        out.append(trip(vendor_id=r["vendor_id"], pickup_at=p, dropoff_at=p + dt.timedelta(seconds=r["dur"]),
                        pu_location_id=r["pu"], fare_amount=r["fare"], trip_distance_mi=r["miles"],
                        total_amount=r["total"], payment_type=r["payment"], source_file=r["file"],
                        extra=0.0, mta_tax=0.0, tip_amount=0.0, improvement_surcharge=0.0,
                        congestion_surcharge=0.0, airport_fee=0.0))
    return out


def brute_label(t):
    """Split of one surviving trip, written directly from the rules."""
    y, m = (2024, 1) if t["source_file"].endswith("01.parquet") else (2024, 2)
    lo = dt.datetime(y, m, 1) - dt.timedelta(days=2)
    hi = dt.datetime(y, m + 1, 1) + dt.timedelta(days=2)
    dur = (t["dropoff_at"] - t["pickup_at"]).total_seconds() / 60.0
    miles, total = t["trip_distance_mi"], t["total_amount"]
    speed = 60.0 * miles / dur if dur > 0 and miles is not None else None
    manual = (t["fare_amount"] or 0.0)
    if t["pickup_at"] is None or t["dropoff_at"] is None or miles is None or total is None \
            or t["pu_location_id"] is None or t["pu_location_id"] <= 0 or t["do_location_id"] <= 0:
        return "rejected"
    adj = total < 0 or (t["fare_amount"] is not None and t["fare_amount"] < 0) or t["payment_type"] in (3, 4, 6)
    if adj:
        return "trips_admin"
    in_win = lo <= t["pickup_at"] <= hi and lo <= t["dropoff_at"] <= hi
    o_dist = not (0 < miles <= 150)
    o_speed = dur < 1 or dur > 360 or (speed is not None and speed > 80)
    mismatch = abs(manual - total) > 0.5
    return "trips_anomalies" if ((not in_win) or o_dist or o_speed) and not mismatch else "trips_clean"


@settings(max_examples=20, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(rows_strategy)
def test_dedup_and_split_match_brute_force(spark, rs):
    trips = to_trips(rs)
    counts = Counter(tuple(t[c] for c in KEY) for t in trips)
    survivors = [t for t in trips if counts[tuple(t[c] for c in KEY)] == 1]
    expected = Counter(brute_label(t) for t in survivors)
    if not trips:
        return
    for strategy in ("key_set", "aggregate"):
        silver = silver_from_bronze(bronze_from_raw(frame(spark, trips), canonical=True, dedup=strategy))
        got = Counter(r["silver_split"] for r in silver.select("silver_split").collect())
        assert got == expected, strategy
