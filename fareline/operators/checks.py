"""Data-quality tests as Spark jobs.

A check counts failing rows the way the reference's test runner does:

* not_null          rows where the column is NULL
* unique            values (non-NULL) that occur more than once
* accepted_values   distinct non-NULL values outside the list
* relationships     child rows (non-NULL key) with no parent row
* fare_within_tolerance
                    rows with both sides present and |actual - expected| > tol,
                    ignoring rows already flagged as a mismatch unless
                    ``exclude_flagged=False`` (the stricter variant)

All row-level and relationship checks of one table share ONE pass: the table
is left-joined with the DISTINCT key set of every parent it references (a
dimension: broadcast by size, and distinct keys never multiply rows), and one
aggregate counts NULLs, unaccepted values, tolerance breaches and unmatched
keys together. Each unique check is one grouped aggregate (partial
aggregation, skew-safe). The result is a single DataFrame:
check_name, table_name, column_name, detail, failures, passed.
"""

from __future__ import annotations

from collections import OrderedDict
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Check:
    kind: str
    table: str
    column: str | None = None
    values: tuple = ()
    to_table: str | None = None
    to_column: str | None = None
    expected: str | None = None
    tolerance: float = 0.5
    exclude_flagged: bool = True
    flag_column: str = "qa_is_fare_mismatch"
    hex_digest: bool = False  # the column is a hexadecimal digest: grouped by its bytes, half the size

    @property
    def detail(self) -> str:
        if self.kind == "accepted_values":
            return "values " + ",".join(str(v) for v in self.values)
        if self.kind == "relationships":
            return f"to {self.to_table}.{self.to_column}"
        if self.kind == "fare_within_tolerance":
            mode = "unflagged" if self.exclude_flagged else "all"
            return f"vs {self.expected} tol {self.tolerance:g} {mode}"
        return ""


def not_null(table: str, column: str) -> Check:
    return Check("not_null", table, column)


def unique(table: str, column: str, hex_digest: bool = False) -> Check:
    return Check("unique", table, column, hex_digest=hex_digest)


def accepted_values(table: str, column: str, values: Sequence) -> Check:
    return Check("accepted_values", table, column, values=tuple(values))


def relationships(table: str, column: str, to_table: str, to_column: str) -> Check:
    return Check("relationships", table, column, to_table=to_table, to_column=to_column)


def fare_within_tolerance(
    table: str, actual: str, expected: str, tolerance: float = 0.5, exclude_flagged: bool = True
) -> Check:
    if not actual or not expected:
        raise ValueError("fare_within_tolerance needs both actual and expected columns")
    return Check(
        "fare_within_tolerance", table, actual, expected=expected, tolerance=tolerance, exclude_flagged=exclude_flagged
    )


ROW_LEVEL = ("not_null", "accepted_values", "fare_within_tolerance")


def _failure_expr(c: Check) -> Column:
    x = F.col(c.column)
    if c.kind == "not_null":
        return F.count_if(x.isNull())
    if c.kind == "accepted_values":
        return F.count_distinct(F.when(~x.isin(list(c.values)), x))
    if c.kind == "fare_within_tolerance":
        cond = (
            x.isNotNull()
            & F.col(c.expected).isNotNull()
            & (F.abs(x.cast("double") - F.col(c.expected).cast("double")) > c.tolerance)
        )
        if c.exclude_flagged:
            cond = cond & ~F.coalesce(F.col(c.flag_column), F.lit(False))
        return F.count_if(cond)
    raise ValueError(c.kind)


def _meta(c: Check, failures: Column) -> list[Column]:
    return [
        F.lit(c.kind).alias("check_name"),
        F.lit(c.table).alias("table_name"),
        F.lit(c.column).cast("string").alias("column_name"),
        F.lit(c.detail).alias("detail"),
        failures.cast("long").alias("failures"),
    ]


def _table_checks(df: DataFrame, checks: Sequence[Check], tables: Mapping[str, DataFrame]) -> DataFrame:
    """Row-level and relationship checks of one table from one pass; one output row per check."""
    exprs = []
    for i, c in enumerate(checks):
        if c.kind == "relationships":
            pk = f"_pk{i}"
            keys = tables[c.to_table].select(F.col(c.to_column).alias(pk)).distinct()
            df = df.join(keys, F.col(c.column) == F.col(pk), "left")
            exprs.append(F.count_if(F.col(c.column).isNotNull() & F.col(pk).isNull()).alias(f"_f{i}"))
        else:
            exprs.append(_failure_expr(c).alias(f"_f{i}"))
    agg = df.agg(*exprs)
    rows = F.array(*[F.struct(*_meta(c, F.col(f"_f{i}"))) for i, c in enumerate(checks)])
    return agg.select(F.inline(rows))


def _unique(df: DataFrame, c: Check) -> DataFrame:
    key = F.unhex(c.column) if c.hex_digest else F.col(c.column)
    dupes = df.where(F.col(c.column).isNotNull()).groupBy(key.alias("key")).count().where(F.col("count") > 1)
    return dupes.agg(F.count(F.lit(1)).alias("_n")).select(*_meta(c, F.col("_n")))


def run_checks(tables: Mapping[str, DataFrame], checks: Sequence[Check]) -> DataFrame:
    """Failures per check as one DataFrame (lazy)."""
    parts: list[DataFrame] = []
    by_table: OrderedDict[str, list[Check]] = OrderedDict()
    for c in checks:
        if c.kind in ROW_LEVEL or c.kind == "relationships":
            by_table.setdefault(c.table, []).append(c)
        elif c.kind != "unique":
            raise ValueError(f"unknown check kind {c.kind}")
    for table, cs in by_table.items():
        parts.append(_table_checks(tables[table], cs, tables))
    for c in checks:
        if c.kind == "unique":
            parts.append(_unique(tables[c.table], c))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.withColumn("passed", F.col("failures") == 0)


def _rel(table: str, column: str, dim: str, key: str) -> Check:
    return relationships(table, column, dim, key)


# The original test suite (53 tests), table by table in file order.
DEFAULT_SUITE: tuple[Check, ...] = (
    not_null("stg_trips", "dup_key"),
    unique("stg_trips", "dup_key", hex_digest=True),
    fare_within_tolerance("stg_trips", "manual_total", "total_amount", 0.50),
    not_null("dim_date", "date_day"),
    unique("dim_date", "date_day"),
    not_null("dim_payment", "payment_type"),
    unique("dim_payment", "payment_type"),
    accepted_values("dim_payment", "payment_type", (1, 2, 3, 4, 5, 6)),
    not_null("dim_vendor", "vendor_id"),
    unique("dim_vendor", "vendor_id"),
    not_null("dim_zone", "location_id"),
    unique("dim_zone", "location_id"),
    _rel("fact_trips", "date_day", "dim_date", "date_day"),
    _rel("fact_trips", "vendor_id", "dim_vendor", "vendor_id"),
    _rel("fact_trips", "payment_type", "dim_payment", "payment_type"),
    _rel("fact_trips", "pu_location_id", "dim_zone", "location_id"),
    _rel("fact_trips", "do_location_id", "dim_zone", "location_id"),
    _rel("fact_revenue_adjustments", "date_day", "dim_date", "date_day"),
    _rel("fact_revenue_adjustments", "payment_type", "dim_payment", "payment_type"),
    _rel("fact_revenue_adjustments", "pu_location_id", "dim_zone", "location_id"),
    _rel("fact_revenue_adjustments", "do_location_id", "dim_zone", "location_id"),
    not_null("mart_kpi_daily", "date_day"),
    unique("mart_kpi_daily", "date_day"),
    _rel("mart_kpi_daily", "date_day", "dim_date", "date_day"),
    not_null("mart_revenue_daily_zone", "date_day"),
    not_null("mart_revenue_daily_zone", "location_id"),
    _rel("mart_revenue_daily_zone", "date_day", "dim_date", "date_day"),
    _rel("mart_revenue_daily_zone", "location_id", "dim_zone", "location_id"),
    not_null("mart_trips_hourly_vendor", "hour"),
    not_null("mart_trips_hourly_vendor", "vendor_id"),
    _rel("mart_trips_hourly_vendor", "vendor_id", "dim_vendor", "vendor_id"),
    not_null("mart_payment_mix_daily", "date_day"),
    not_null("mart_payment_mix_daily", "payment_type"),
    _rel("mart_payment_mix_daily", "payment_type", "dim_payment", "payment_type"),
    _rel("mart_payment_mix_daily", "date_day", "dim_date", "date_day"),
    not_null("mart_vendor_scorecard_monthly", "year_month"),
    not_null("mart_vendor_scorecard_monthly", "vendor_id"),
    _rel("mart_vendor_scorecard_monthly", "vendor_id", "dim_vendor", "vendor_id"),
    not_null("mart_od_matrix_monthly", "year_month"),
    _rel("mart_od_matrix_monthly", "pu_location_id", "dim_zone", "location_id"),
    _rel("mart_od_matrix_monthly", "do_location_id", "dim_zone", "location_id"),
    not_null("mart_adjustments_daily_zone", "date_day"),
    not_null("mart_adjustments_daily_zone", "location_id"),
    _rel("mart_adjustments_daily_zone", "date_day", "dim_date", "date_day"),
    _rel("mart_adjustments_daily_zone", "payment_type", "dim_payment", "payment_type"),
    _rel("mart_adjustments_daily_zone", "location_id", "dim_zone", "location_id"),
    not_null("mart_congestion_impact_daily", "date_day"),
    _rel("mart_congestion_impact_daily", "date_day", "dim_date", "date_day"),
    not_null("mart_airport_daily", "date_day"),
    accepted_values("mart_airport_daily", "direction", ("PU", "DO")),
    not_null("mart_anomaly_summary_daily", "date_day"),
    _rel("mart_anomaly_summary_daily", "date_day", "dim_date", "date_day"),
    _rel("mart_anomaly_summary_daily", "location_id", "dim_zone", "location_id"),
)
