"""Gold + marts: the model graph as plain function composition.

``build_warehouse`` returns every table as a lazy DataFrame; ``write_warehouse``
materialises them layer by layer (each written table cuts the lineage of the
next layer) and publishes all of them at once (``store``).

Physical layout of the facts: partitioned by ``date_month`` (yyyy-MM of
``date_day``, an added column) and sorted by ``date_day`` inside each file.
Month partitions keep the file count proportional to data volume (a day
partition per 2,500 days of a small table means thousands of tiny files), and
the day sort lets Parquet row-group statistics skip days inside a month. No
shuffle is added for the layout: silver is already clustered by source month,
so each task writes into one or two month partitions and a hot month is spread
over many input splits; ``rebalance=True`` adds AQE's rebalance for inputs that
are not. Date-window readers add the matching ``date_month`` predicate
(``month_filter``) to prune partitions.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass, field

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fareline.config import (
    DEFAULT_AIRPORT,
    DEFAULT_ANOMALY,
    DEFAULT_PAYMENT,
    SPLIT_ADMIN,
    SPLIT_ANOMALIES,
    SPLIT_CLEAN,
    SPLIT_FARE_MISS,
    AirportRule,
    AnomalyMartRules,
    Layers,
    PaymentCodeRule,
)
from fareline.operators import marts as M
from fareline.operators import star as S
from fareline.operators.quality import split
from fareline.plans.silver import SPLIT_COLUMN
from fareline.plans.store import Store, unit_values

# table -> layer (schema) it belongs to
TABLE_LAYERS = {
    "stg_trips": "staging",
    "stg_admin": "staging",
    "stg_anomalies": "staging",
    "stg_fare_miss": "staging",
    "fact_trips": "gold",
    "fact_revenue_adjustments": "gold",
    "dim_date": "gold",
    "dim_payment": "gold",
    "dim_vendor": "gold",
    "dim_zone": "gold",
    **{m: "marts" for m in M.MART_BUILDERS},
}

# Written tables partitioned by month of ``date_day``.
PARTITION_COLUMN = "date_month"
PARTITIONED = ("fact_trips", "fact_revenue_adjustments")


class LazyTables(Mapping):
    """Tables by name; a value that is a function is called when the table is first asked for."""

    def __init__(self, tables: Mapping[str, DataFrame | Callable[[], DataFrame]] = ()):
        self._tables = dict(tables)

    def __getitem__(self, name: str) -> DataFrame:
        value = self._tables[name]
        if not isinstance(value, DataFrame):
            value = self._tables[name] = value()
        return value

    def __iter__(self):
        return iter(self._tables)

    def __len__(self) -> int:
        return len(self._tables)

    def __or__(self, other: Mapping) -> LazyTables:
        more = other._tables if isinstance(other, LazyTables) else dict(other)
        return LazyTables(self._tables | more)


@dataclass
class Warehouse:
    tables: LazyTables = field(default_factory=LazyTables)

    def __post_init__(self):
        if not isinstance(self.tables, LazyTables):
            self.tables = LazyTables(self.tables)

    def __getitem__(self, name: str) -> DataFrame:
        return self.tables[name]

    def __getattr__(self, name: str) -> DataFrame:
        try:
            return self.__dict__["tables"][name]
        except KeyError as exc:
            raise AttributeError(name) from exc

    def gold_and_marts(self) -> dict[str, DataFrame]:
        return {k: self.tables[k] for k in self.tables if TABLE_LAYERS.get(k) in ("gold", "marts")}


def build_warehouse(
    silver: DataFrame,
    vendors: DataFrame,
    payment_types: DataFrame,
    zones: DataFrame,
    airport: AirportRule = DEFAULT_AIRPORT,
    anomaly: AnomalyMartRules = DEFAULT_ANOMALY,
    payment: PaymentCodeRule = DEFAULT_PAYMENT,
) -> Warehouse:
    """Every model over a split-labelled silver frame (lazy; nothing runs)."""

    def rows(name: str) -> DataFrame:
        return split(silver, name, SPLIT_COLUMN).drop(SPLIT_COLUMN)

    clean, admin = rows(SPLIT_CLEAN), rows(SPLIT_ADMIN)
    t: dict[str, DataFrame] = {}
    t["stg_trips"] = S.stg_trips(clean, payment)
    t["stg_admin"] = S.stg_with_pickup_date(admin)
    t["stg_anomalies"] = S.stg_with_pickup_date(rows(SPLIT_ANOMALIES))
    t["stg_fare_miss"] = S.stg_with_pickup_date(rows(SPLIT_FARE_MISS))
    t["fact_trips"] = S.fact_trips(t["stg_trips"])
    t["fact_revenue_adjustments"] = S.fact_revenue_adjustments(admin, payment)
    t["dim_date"] = S.dim_date(t["fact_trips"], t["fact_revenue_adjustments"])
    t["dim_payment"] = S.dim_payment(payment_types)
    t["dim_vendor"] = S.dim_vendor(t["stg_trips"], vendors)
    t["dim_zone"] = S.dim_zone(t["stg_trips"], zones)
    return Warehouse(t | build_marts(t["fact_trips"], t["fact_revenue_adjustments"], t["dim_zone"], airport, anomaly, payment))


def build_marts(
    fact: DataFrame,
    adjustments: DataFrame,
    dim_zone: DataFrame,
    airport: AirportRule = DEFAULT_AIRPORT,
    anomaly: AnomalyMartRules = DEFAULT_ANOMALY,
    payment: PaymentCodeRule = DEFAULT_PAYMENT,
) -> dict[str, DataFrame]:
    return {
        "mart_kpi_daily": M.mart_kpi_daily(fact, adjustments),
        "mart_revenue_daily_zone": M.mart_revenue_daily_zone(fact),
        "mart_trips_hourly_vendor": M.mart_trips_hourly_vendor(fact),
        "mart_payment_mix_daily": M.mart_payment_mix_daily(fact),
        "mart_vendor_scorecard_monthly": M.mart_vendor_scorecard_monthly(fact),
        "mart_od_matrix_monthly": M.mart_od_matrix_monthly(fact),
        "mart_adjustments_daily_zone": M.mart_adjustments_daily_zone(adjustments, payment),
        "mart_congestion_impact_daily": M.mart_congestion_impact_daily(fact),
        "mart_airport_daily": M.mart_airport_daily(fact, dim_zone, airport),
        "mart_anomaly_summary_daily": M.mart_anomaly_summary_daily(fact, anomaly),
    }


def month_filter(df: DataFrame, start, end, day_col: str = "date_day") -> DataFrame:
    """Rows with ``day_col`` in [start, end]; adds the partition predicate when the table has one."""
    out = df.where(F.col(day_col).between(start, end))
    if PARTITION_COLUMN in df.columns:
        out = out.where(
            F.col(PARTITION_COLUMN).between(F.date_format(start, "yyyy-MM"), F.date_format(end, "yyyy-MM"))
        )
    return out


def _month_layout(df: DataFrame, rebalance: bool = False) -> DataFrame:
    """A fact with its month, sorted for the layout described above."""
    df = df.withColumn(PARTITION_COLUMN, F.date_format("date_day", "yyyy-MM"))
    if rebalance:
        df = df.hint("rebalance", PARTITION_COLUMN)
    return df.sortWithinPartitions(PARTITION_COLUMN, "date_day")


def write_warehouse(
    spark: SparkSession,
    wh: Warehouse,
    out_dir: str,
    vendors: DataFrame,
    payment_types: DataFrame,
    zones: DataFrame,
    airport: AirportRule = DEFAULT_AIRPORT,
    anomaly: AnomalyMartRules = DEFAULT_ANOMALY,
    payment: PaymentCodeRule = DEFAULT_PAYMENT,
    compression: str = "zstd",
    include_staging: bool = False,
    rebalance: bool = False,
) -> Warehouse:
    """Write facts, then dims and marts read back from the written facts; publish all tables at once.

    Staging stays a view (as in the reference) unless ``include_staging``.
    Returns a Warehouse whose tables read the written files.
    """
    store = Store(spark, out_dir)
    with store.begin() as commit:

        def put(name: str, df: DataFrame) -> DataFrame:
            if name in PARTITIONED:
                commit.write(name, _month_layout(df, rebalance), (PARTITION_COLUMN,), compression=compression)
            else:
                commit.write(name, df, compression=compression)
            return commit.read(name)

        if include_staging:
            for n in ("stg_trips", "stg_admin", "stg_anomalies", "stg_fare_miss"):
                put(n, wh[n])
        fact = put("fact_trips", wh["fact_trips"])
        adj = put("fact_revenue_adjustments", wh["fact_revenue_adjustments"])
        put("dim_date", S.dim_date(fact, adj))
        put("dim_payment", S.dim_payment(payment_types))
        # the written fact has every staged trip and its ids: no second pass over silver
        put("dim_vendor", S.dim_vendor(fact, vendors))
        zone = put("dim_zone", S.dim_zone(fact, zones))
        for name, df in build_marts(fact, adj, zone, airport, anomaly, payment).items():
            put(name, df)
    return read_warehouse(spark, out_dir)


def read_warehouse(spark: SparkSession, path: str, version: int | None = None, metadata: bool = False) -> Warehouse:
    """Tables of a published warehouse, all of one version, each opened when it is first asked for.

    ``metadata``: tables for counts and date ranges alone, which come from the files' footers.

    Schemas come from the manifest, so an empty table reads back as one; a folder
    without a published warehouse raises.
    """
    store = Store(spark, path)
    states = {n: s for n, s in store.tables(version).items() if n in TABLE_LAYERS}
    if not states:
        raise AnalysisException(f"no published warehouse in {path}")

    def reader(name: str):
        return lambda: store.metadata_state(name, states[name]) if metadata else store.read_state(name, states[name])

    return Warehouse(LazyTables({n: reader(n) for n in states}))


def register_views(spark: SparkSession, wh: Warehouse, layers: Layers = Layers()) -> list[str]:
    """Temp views named ``<layer>_<table>`` (e.g. ``gold_fact_trips``) plus bare names."""
    names = []
    for name, df in wh.tables.items():
        layer = getattr(layers, TABLE_LAYERS.get(name, "gold"))
        df.createOrReplaceTempView(f"{layer}_{name}")
        df.createOrReplaceTempView(name)
        names.append(name)
    return names


def register_tables(spark: SparkSession, out_dir: str, layers: Layers = Layers(), tables=None) -> list[str]:
    """Catalog tables (``<layer>.<table>``) over the published version of a warehouse.

    External tables on the written locations (no data is copied); every partition of
    the month-partitioned facts is added with its own folder, so partition pruning works
    through the catalog as well. Run it again after a refresh. Returns the qualified names.
    """
    store = Store(spark, out_dir)
    states = store.tables()
    names = tables or [n for n, layer in TABLE_LAYERS.items() if layer in ("gold", "marts")]
    done = []
    for name in names:
        db, state = getattr(layers, TABLE_LAYERS[name]), states[name]
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {db}")
        qualified = f"{db}.{name}"
        spark.sql(f"DROP TABLE IF EXISTS {qualified}")
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in state.struct().fields)
        by = f"PARTITIONED BY ({', '.join(state.partition_by)})" if state.partition_by else ""
        home = f"{store.root}/{name}" if by else store.folder(name, state, "")
        spark.sql(f"CREATE TABLE {qualified} ({columns}) USING parquet {by} LOCATION '{home}'")
        if by and state.units:
            parts = []
            for unit in state.units:
                spec = ", ".join(f"`{k}` = {'null' if v is None else _quoted(v)}" for k, v in unit_values(unit).items())
                parts.append(f"PARTITION ({spec}) LOCATION {_quoted(store.folder(name, state, unit))}")
            spark.sql(f"ALTER TABLE {qualified} ADD " + " ".join(parts))
        done.append(qualified)
    return done


def _quoted(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"
