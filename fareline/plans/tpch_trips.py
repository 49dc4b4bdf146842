"""The full pipeline over trips derived from the driver's TPC-H-like tables.

Used by the registered queries, the bench and the tests. Every layer is written
once per session and folder by the shipped writers and read back, as a user of
the library would run it:

* raw:     the adapter's trips as Parquet, one partition per source file;
* bronze:  ``write_bronze`` (partitioned by year, month and file);
* silver:  ``write_silver`` (partitioned by split, year, month and file);
* gold, marts: ``write_warehouse`` (facts by month), read by ``read_warehouse``,
  which opens a table when it is first asked for.

``warehouse(..., materialize=None)`` and ``silver(..., materialize=False)`` give
the lazy plans from the driver tables instead (plan tests).
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from fareline.config import DEFAULT_QA, SPLIT_ADMIN, SPLIT_ANOMALIES, SPLIT_CLEAN, SPLIT_FARE_MISS, QaRules
from fareline.operators import star
from fareline.plans.bronze import bronze_from_raw, run_bronze, write_bronze
from fareline.plans.incremental import Seeds, refresh
from fareline.plans.silver import read_bronze, read_silver, read_split, run_silver, silver_from_bronze, write_silver
from fareline.plans.warehouse import LazyTables, Warehouse, build_warehouse, read_warehouse, write_warehouse
from fareline.session import drop_shared, session_key, shared_dir, shuffles_dropped
from fareline.sources import fixture
from fareline.sources.raw import list_raw_files, parse_year_month

_PATHS: dict[tuple, str] = {}
_FRAMES: dict[tuple, DataFrame] = {}
_WAREHOUSES: dict[tuple, Warehouse] = {}
_BUILDS: dict[tuple, FileBuild] = {}


def _key(spark: SparkSession, sf_dir: str, *more) -> tuple:
    return (session_key(spark), sf_dir.rstrip("/"), *more)


def _folder(spark: SparkSession, key: tuple) -> str:
    """The layers' own folder in the shared storage."""
    if key not in _PATHS:
        _PATHS[key] = shared_dir(spark, f"fareline-{uuid.uuid4().hex}")
    return _PATHS[key]


def folder(spark: SparkSession, sf_dir: str) -> str:
    """This session's own folder for an input folder."""
    return _folder(spark, _key(spark, sf_dir))


def _attempt(spark: SparkSession, key: tuple) -> str:
    """A new folder beside the layers for one build: what a failed build left behind is in nobody's way."""
    return f"{_folder(spark, key)}/build-{uuid.uuid4().hex}"


def _read(spark: SparkSession, path: str, like: DataFrame) -> DataFrame:
    """A written layer with the types and the column order it was written with."""
    return spark.read.schema(like.schema).parquet(path).select(*like.columns)


def raw(spark: SparkSession, sf_dir: str, materialize: bool = True) -> DataFrame:
    """Raw trips of the adapter; landed once as Parquet, a partition for each source file."""
    trips = fixture.raw_trips(spark, sf_dir)
    if not materialize:
        return trips
    key = _key(spark, sf_dir, "raw")
    if key not in _FRAMES:
        _FRAMES[key] = _land(spark, sf_dir, f"{_attempt(spark, _key(spark, sf_dir))}/raw")
    return _FRAMES[key]


def _land(spark: SparkSession, sf_dir: str, path: str) -> DataFrame:
    # a hot month is split over several tasks and files
    trips = fixture.raw_trips(spark, sf_dir, by_file=True)
    with shuffles_dropped(spark):
        trips.write.option("compression", "zstd").partitionBy("source_file").parquet(path)
    return _read(spark, path, trips)


@contextmanager
def _raw_for_a_build(spark: SparkSession, sf_dir: str) -> Iterator[DataFrame]:
    """Landed raw trips for one build. Where no query was given them they go with the build, as nobody else reads them."""
    if _key(spark, sf_dir, "raw") in _FRAMES:
        yield raw(spark, sf_dir)
        return
    base = _attempt(spark, _key(spark, sf_dir))
    try:
        yield _land(spark, sf_dir, f"{base}/raw")
    finally:
        drop_shared(spark, base)


def bronze(spark: SparkSession, sf_dir: str, rules: QaRules = DEFAULT_QA, materialize_raw: bool = True) -> DataFrame:
    return bronze_from_raw(raw(spark, sf_dir, materialize_raw), rules, canonical=True)


def silver(spark: SparkSession, sf_dir: str, rules: QaRules = DEFAULT_QA, materialize: bool = False) -> DataFrame:
    if not materialize:
        return silver_from_bronze(bronze(spark, sf_dir, rules, materialize_raw=False))
    key = _key(spark, sf_dir, rules)
    if key not in _FRAMES:
        base = _folder(spark, key)
        with _raw_for_a_build(spark, sf_dir) as trips:
            write_bronze(bronze_from_raw(trips, rules, canonical=True), f"{base}/bronze")
        s = silver_from_bronze(read_bronze(spark, f"{base}/bronze"))
        write_silver(s, f"{base}/silver")
        drop_shared(spark, f"{base}/bronze")  # silver has all its rows, and no query reads it
        _FRAMES[key] = read_silver(spark, f"{base}/silver").select(*s.columns)
    return _FRAMES[key]


def _staging(spark: SparkSession, sf_dir: str, rules: QaRules) -> dict:
    """Staged splits of the written silver; each is built when it is first asked for."""
    s = silver(spark, sf_dir, rules, materialize=True)

    def rows(name: str) -> DataFrame:
        return read_split(s, name)

    return {
        "stg_trips": lambda: star.stg_trips(rows(SPLIT_CLEAN)),
        "stg_admin": lambda: star.stg_with_pickup_date(rows(SPLIT_ADMIN)),
        "stg_anomalies": lambda: star.stg_with_pickup_date(rows(SPLIT_ANOMALIES)),
        "stg_fare_miss": lambda: star.stg_with_pickup_date(rows(SPLIT_FARE_MISS)),
    }


def warehouse(spark: SparkSession, sf_dir: str, rules: QaRules = DEFAULT_QA, materialize: str | None = "gold") -> Warehouse:
    """Every table of the star schema and marts.

    ``materialize``: None (lazy from the driver tables), "silver" (lazy from the
    written silver), "gold" or "all" (written tables, staging from silver).
    """
    if materialize in (None, "silver"):
        return build_warehouse(
            silver(spark, sf_dir, rules, materialize is not None),
            vendors=fixture.vendors(spark),
            payment_types=fixture.payment_types(spark),
            zones=fixture.zones(spark, sf_dir),
            airport=fixture.FIXTURE_AIRPORTS,
        )
    key = _key(spark, sf_dir, rules)
    if key not in _WAREHOUSES:
        lazy = warehouse(spark, sf_dir, rules, "silver")
        base = f"{_folder(spark, key)}/warehouse"
        write_warehouse(
            spark, lazy, base, fixture.vendors(spark), fixture.payment_types(spark), fixture.zones(spark, sf_dir),
            airport=fixture.FIXTURE_AIRPORTS,
        )
        _WAREHOUSES[key] = Warehouse(LazyTables(_staging(spark, sf_dir, rules)) | read_warehouse(spark, base).tables)
    return _WAREHOUSES[key]


def warehouse_metadata(spark: SparkSession, sf_dir: str, rules: QaRules = DEFAULT_QA) -> Warehouse:
    """The written warehouse for counts and date ranges from file footers."""
    warehouse(spark, sf_dir, rules, "all")
    return read_warehouse(spark, f"{_folder(spark, _key(spark, sf_dir, rules))}/warehouse", metadata=True)


def raw_files(spark: SparkSession, sf_dir: str) -> str:
    """The folder of the monthly raw files of all schema families; landed once per session and folder."""
    key = _key(spark, sf_dir, "raw files")
    if key not in _PATHS:
        path = f"{_attempt(spark, _key(spark, sf_dir))}/files"
        with _raw_for_a_build(spark, sf_dir) as trips:
            fixture.land_files(spark, sf_dir, path, trips)
        _PATHS[key] = path
    return _PATHS[key]


@dataclass(frozen=True)
class FileBuild:
    """Layers built from raw files: the folder, the build's report, and both tables read back."""

    raw: str
    report: dict
    bronze: DataFrame
    silver: DataFrame


def file_build(spark: SparkSession, sf_dir: str, rules: QaRules = DEFAULT_QA) -> FileBuild:
    """Monthly raw files of three schema families through ``run_bronze`` and ``run_silver``; once per session and folder."""
    key = _key(spark, sf_dir, rules, "files")
    if key not in _BUILDS:
        base, files = _attempt(spark, key), raw_files(spark, sf_dir)
        report = run_bronze(spark, files, f"{base}/bronze", rules)
        run_silver(read_bronze(spark, f"{base}/bronze"), f"{base}/silver")
        _BUILDS[key] = FileBuild(files, report, read_bronze(spark, f"{base}/bronze"), read_silver(spark, f"{base}/silver"))
    return _BUILDS[key]


@dataclass(frozen=True)
class IncrementalBuild:
    """A store brought up to date file by file, and the raw file that landed twice."""

    root: str
    replaced: str


_STORES: dict[tuple, IncrementalBuild] = {}
# the first landing of the replaced file holds only these of its rows
SHORT_FILE = "passenger_count <= 3"


def incremental_build(spark: SparkSession, sf_dir: str, rules: QaRules = DEFAULT_QA) -> IncrementalBuild:
    """All raw files landed in one store, one of them short at first and replaced by the whole file after; once per session and folder."""
    key = _key(spark, sf_dir, rules, "store")
    if key not in _STORES:
        base = _attempt(spark, key)
        files = list_raw_files(spark, raw_files(spark, sf_dir))
        # the last file with Spark's own types, as its short version is written by Spark
        whole = [f for f in files if parse_year_month(f)[1] % fixture.FAMILIES == 2][-1]
        short = fixture.land_one(spark, spark.read.parquet(whole).where(SHORT_FILE), f"{base}/short", whole.rsplit("/", 1)[-1])
        seeds = Seeds(fixture.vendors(spark), fixture.payment_types(spark), fixture.zones(spark, sf_dir), airport=fixture.FIXTURE_AIRPORTS)
        refresh(spark, f"{base}/store", [short, *(f for f in files if f != whole)], seeds, rules)
        refresh(spark, f"{base}/store", [whole], seeds, rules)
        _STORES[key] = IncrementalBuild(f"{base}/store", whole.rsplit("/", 1)[-1])
    return _STORES[key]
