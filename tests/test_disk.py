"""What a build leaves on disk: its layers, not the files it needed on the way."""

import os
import tempfile
import time

from helpers import SF001

from fareline.plans import tpch_trips
from fareline.plans.store import write_table
from fareline.session import CLEANUP, shared_dir
from fareline.sources import fixture


def folders(spark) -> set[str]:
    """Layers in the builds' folders of the shared storage: <build>/<layer>."""
    base, out = shared_dir(spark, "").removeprefix("file:"), set()
    for d, names, _ in os.walk(base):
        if os.path.basename(d).startswith(("fareline-", "build-")):
            out |= {os.path.join(d, n) for n in names if not n.startswith("build-")}
    return out


def shuffle_files(spark) -> int:
    top = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return sum(top.apply(i).getName().startswith("shuffle_") for i in range(top.size()))


def test_a_write_leaves_no_shuffle_files(spark):
    from fareline.session import write_shared

    def gone():
        for _ in range(100):
            if shuffle_files(spark) <= before:
                return True
            time.sleep(0.1)
        return False

    old, before = spark.conf.get(CLEANUP), shuffle_files(spark)
    rows = spark.range(1000).selectExpr("id % 7 as k", "id").groupBy("k").count()
    write_table(rows, os.path.join(tempfile.mkdtemp(prefix="fareline-disk-"), "t"), ["k"])
    write_shared(rows, "counts")
    assert gone() and spark.conf.get(CLEANUP) == old


def test_raw_and_bronze_go_when_silver_has_their_rows(spark, monkeypatch):
    rules = tpch_trips.QaRules(near_eps=0.031)  # layers of its own
    monkeypatch.setattr(tpch_trips, "_FRAMES", {})
    before = folders(spark)
    rows = tpch_trips.silver(spark, SF001, rules, materialize=True).count()
    assert [os.path.basename(p) for p in folders(spark) - before] == ["silver"]
    # raw trips that a query was given stay for it
    given = tpch_trips.raw(spark, SF001)
    tpch_trips.silver(spark, SF001, tpch_trips.QaRules(near_eps=0.032), materialize=True)
    assert given.count() > rows and {os.path.basename(p) for p in folders(spark) - before} == {"silver", "raw"}


def test_a_refresh_lands_files_and_builds_no_second_bronze(spark, monkeypatch):
    for name in ("_FRAMES", "_PATHS", "_BUILDS", "_STORES"):
        monkeypatch.setattr(tpch_trips, name, {})
    monkeypatch.setattr(tpch_trips, "refresh", lambda *a: None)
    before = folders(spark)
    tpch_trips.incremental_build(spark, SF001)
    assert {os.path.basename(p) for p in folders(spark) - before} <= {"files", "short", "short-staged", *(f"files-family{i}" for i in range(5))}


def test_lines_dealt_out_by_file_are_the_same_trips(spark):
    trips, dealt = fixture.raw_trips(spark, SF001), fixture.raw_trips(spark, SF001, by_file=True)
    assert trips.schema == dealt.schema and trips.exceptAll(dealt).count() == dealt.exceptAll(trips).count() == 0
