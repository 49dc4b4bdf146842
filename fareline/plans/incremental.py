"""All layers of one store brought up to date for a set of raw files, in one commit.

A raw file owns its partitions of bronze, silver, the facts and the marts' parts
(``mart_parts``: partial sums per month and file). When files land, or land again,
their partitions are replaced, and the marts of the months they touch - before or now -
are merged from the parts of all files. The work grows with the files that landed and
the parts of those months, not with the warehouse:

* bronze, silver, facts: the landed files' rows only;
* parts: the landed files' fact rows, one partial aggregate each;
* marts: parts of the touched months; other months' files stay as they are;
* dimensions: from parts and marts (days, ids), never from the facts.

Readers see the whole refresh or nothing of it (``store``); a refresh that dies is
simply run again. A file whose rows are all gone leaves no partition behind.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fareline.config import DEFAULT_AIRPORT, DEFAULT_ANOMALY, DEFAULT_PAYMENT, DEFAULT_QA, SPLIT_ADMIN, SPLIT_CLEAN, AirportRule, AnomalyMartRules, PaymentCodeRule, QaRules
from fareline.operators import mart_parts as P
from fareline.operators import marts as M
from fareline.operators import star as S
from fareline.plans.bronze import BRONZE_PARTS, bronze_from_raw, normalized_families
from fareline.plans.silver import SILVER_PARTITIONS, read_split, silver_from_bronze
from fareline.plans.store import Commit, Replace, Store, unit_values
from fareline.sources.raw import parse_year_month, read_families

FACT_PARTS = (P.MONTH, P.FILE)


@dataclass(frozen=True)
class Seeds:
    """What the refresh needs beside the raw files."""

    vendors: DataFrame
    payment_types: DataFrame
    zones: DataFrame
    airport: AirportRule = field(default=DEFAULT_AIRPORT)
    anomaly: AnomalyMartRules = field(default=DEFAULT_ANOMALY)
    payment: PaymentCodeRule = field(default=DEFAULT_PAYMENT)


def of_files(files: list[str]) -> Replace:
    """Whether a partition belongs to one of the raw files."""
    names = {f.rsplit("/", 1)[-1] for f in files}
    return lambda values: values.get(P.FILE) in names


def of_months(months: set[str | None]) -> Replace:
    return lambda values: values.get(P.MONTH) in months


def bronze_of_files(spark: SparkSession, files: list[str], rules: QaRules = DEFAULT_QA) -> DataFrame:
    """Bronze rows of exactly these raw files, whatever their schema families."""
    for f in files:  # fail before any job
        parse_year_month(f)
    return bronze_from_raw(normalized_families(read_families(spark, files)), rules, canonical=True)


def _by_month(fact: DataFrame) -> DataFrame:
    return fact.withColumn(P.MONTH, F.date_format("date_day", "yyyy-MM"))


def _part_rows(part: P.MartPart, fact: DataFrame, seeds: Seeds) -> DataFrame:
    if part.name == "mart_airport_daily":
        fact = M.airport_ends(fact, seeds.zones, seeds.airport, keep=(P.MONTH, P.FILE))
    return part.of(fact)


def _write_marts(commit: Commit, parts: dict[str, P.MartPart], months: set[str | None]) -> None:
    """The touched months of every mart, merged from the parts of all files."""
    mine = of_months(months)

    def merged(name: str) -> DataFrame:
        part = parts[name]
        return part.merge(commit.read(f"part_{name}", wanted=mine))

    def put(name: str, df: DataFrame) -> None:
        commit.write(name, df, (P.MONTH,), replace=mine)

    def month_of(df: DataFrame, column: str) -> DataFrame:
        return df.withColumn(P.MONTH, F.col(column) if column == "year_month" else F.date_format(column, "yyyy-MM"))

    kpi = parts["kpi_trips"].finish(merged("kpi_trips"))
    adjustments = parts["kpi_adjustments"].finish(merged("kpi_adjustments"))
    put("mart_kpi_daily", month_of(M.kpi_columns(kpi.join(adjustments, "date_day", "left")), "date_day"))
    for name in M.MART_BUILDERS:
        if name in parts:
            df = parts[name].finish(merged(name))
            put(name, month_of(df, next(c for c in ("date_day", "year_month", "hour") if c in df.columns)))


def _write_dimensions(commit: Commit, seeds: Seeds) -> None:
    """Dimensions from the parts' days and the marts' ids: a few rows per month, whatever the facts' size."""
    days, adjusted = commit.read("part_kpi_trips").select("date_day"), commit.read("part_kpi_adjustments").select("date_day")
    commit.write("dim_date", S.dim_date(days, adjusted))
    commit.write("dim_payment", S.dim_payment(seeds.payment_types))
    commit.write("dim_vendor", S.dim_vendor(commit.read("mart_vendor_scorecard_monthly"), seeds.vendors))
    commit.write("dim_zone", S.dim_zone(commit.read("mart_od_matrix_monthly"), seeds.zones))


def refresh(spark: SparkSession, root: str, files: list[str], seeds: Seeds, rules: QaRules = DEFAULT_QA) -> dict:
    """Land ``files`` in the store at ``root`` and bring every layer up to date; one commit.

    Returns the published version and the months whose marts were merged anew.
    """
    if not files:
        return {"version": Store(spark, root).version(), "months": []}
    parts, mine = P.mart_parts(seeds.anomaly), of_files(files)
    with Store(spark, root).begin() as commit:
        commit.write("bronze", bronze_of_files(spark, files, rules), BRONZE_PARTS, replace=mine)
        commit.write("silver", silver_from_bronze(commit.read("bronze", wanted=mine)), SILVER_PARTITIONS, replace=mine)
        silver = commit.read("silver", wanted=mine)
        trips = _by_month(S.fact_trips(S.stg_trips(read_split(silver, SPLIT_CLEAN), seeds.payment)))
        admin = _by_month(S.fact_revenue_adjustments(read_split(silver, SPLIT_ADMIN), seeds.payment))
        for name, fact in ((P.TRIPS, trips), (P.ADJUSTMENTS, admin)):
            commit.write(name, fact.sortWithinPartitions(*FACT_PARTS, "date_day"), FACT_PARTS, replace=mine)
        for part in parts.values():
            commit.write(f"part_{part.name}", _part_rows(part, commit.read(part.fact, wanted=mine), seeds), FACT_PARTS, replace=mine)
        months = {unit_values(u)[P.MONTH] for name in (P.TRIPS, P.ADJUSTMENTS) for u in commit.changed(name)}
        _write_marts(commit, parts, months)
        _write_dimensions(commit, seeds)
    return {"version": commit.version, "months": sorted(m for m in months if m)}
