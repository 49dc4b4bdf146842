"""Trips derived from the driver's TPC-H-like tables.

The driver tables carry no trip files, so registered queries run over a
deterministic adapter: every lineitem row (plus a re-appended slice that
creates exact duplicates) joined to its order becomes one raw trip with
canonical column names. The SQL text runs unchanged on Spark SQL and on
DuckDB, so it is both the Spark source and the oracle's first CTE.

Lookup seeds come from the same tables: zones from nation x region,
vendors and payment types from the fixed seed values.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fareline.config import FILE_YEAR_MONTH_PATTERN, AirportRule
from fareline.session import shuffles_dropped
from fareline.sources.raw import arrow_uri
from fareline.sources.seeds import payment_types_seed, vendors_seed

# Adapter from lineitem/orders to raw trips. ``{lineitem}`` / ``{orders}``
# are table references (DataFrame arguments in Spark, views in DuckDB);
# ``{copies}`` yields one or two rows of a line (exact duplicates).
COPIES_SPARK = "explode(if(l_partkey % 97 = 0, array(1, 2), array(1)))"
COPIES_DUCKDB = "unnest(if(l_partkey % 97 = 0, [1, 2], [1]))"
TRIPS_SQL = """
with k as (
  select l.*, o.o_orderpriority,
         (l_orderkey*31 + l_partkey*7 + l_suppkey*13 + l_linenumber*3) as h
  from (select *, {copies} as copy from {lineitem}) l
  join {orders} o on l_orderkey = o_orderkey
),
p as (
  select k.*,
    case when l_partkey % 211 = 0 then null
         else l_shipdate + interval '1' second * (h * 97 % 86400) end as pickup_at
  from k
)
select
  cast(l_suppkey % 3 + 1 as smallint) as vendor_id,
  pickup_at,
  case when l_partkey % 223 = 0 then null
       when l_partkey % 41 = 0 then pickup_at + interval '1' second * 30
       when l_partkey % 43 = 0 then pickup_at + interval '1' second * (22000 + h % 5000)
       else pickup_at + interval '1' second * (120 + h % 5400) end as dropoff_at,
  cast(l_linenumber as smallint) as passenger_count,
  case when l_partkey % 122 = 0 then -0.5e0
       when l_partkey % 61 = 0 then 0.0e0
       when l_partkey % 67 = 0 then 150.0e0 + l_quantity
       when l_partkey % 227 = 0 then null
       else (h % 200) / 10.0e0 + 0.1e0 end as trip_distance_mi,
  cast(substr(o_orderpriority, 1, 1) as smallint) as rate_code_id,
  case when l_partkey % 2 = 0 then 'Y' else 'N' end as store_and_fwd_flag,
  cast(l_partkey % 26 as int) as pu_location_id,
  cast(l_orderkey % 25 + 1 as int) as do_location_id,
  cast(case when h % 40 < 22 then 1 when h % 40 < 33 then 2
            when h % 40 < 35 then h % 40 - 30 when h % 40 = 35 then null
            when h % 40 = 36 then 6 else h % 40 - 36 + (case when h % 40 > 37 then 5 else -1 end) end as smallint) as payment_type,
  cast(case when l_returnflag = 'R' and l_linenumber = 7 then -1 else 1 end as double)
     * (300 + h % 7000) / 100.0e0 as fare_amount,
  case when l_linestatus = 'O' then 1.0e0 else 0.0e0 end as extra,
  0.5e0 as mta_tax,
  (h % 900) / 100.0e0 as tip_amount,
  case when h % 11 = 0 then 6.94e0 else 0.0e0 end as tolls_amount,
  1.0e0 as improvement_surcharge,
  case when l_linestatus = 'O' then 2.5e0 else 0.0e0 end as congestion_surcharge,
  case when l_partkey % 5 = 0 then 1.75e0 when l_partkey % 5 = 1 then null else 0.0e0 end as airport_fee,
  cast(null as double) as cbd_congestion_fee,
  cast(case when l_returnflag = 'R' and l_linenumber = 7 then -1 else 1 end as double)
     * (300 + h % 7000) / 100.0e0
   + case when l_linestatus = 'O' then 3.5e0 else 0.0e0 end + 1.5e0 + (h % 900) / 100.0e0
   + case when h % 11 = 0 then 6.94e0 else 0.0e0 end
   + case when l_partkey % 5 = 0 then 1.75e0 else 0.0e0 end
   + case when l_partkey % 37 = 0 or l_partkey % 134 = 0 or l_partkey % 244 = 0 then 1.0e0 else 0.0e0 end as total_amount,
  cast(extract(year from l_shipdate) as int) as source_year,
  cast(case when l_partkey % 53 = 0 then extract(month from l_shipdate) % 12 + 1
            else extract(month from l_shipdate) end as int) as source_month
from p
"""

# File name each fixture trip would have come from (carries its year-month).
SOURCE_FILE_SQL = (
    "concat('trips_', cast(source_year as varchar), '-', "
    "lpad(cast(source_month as varchar), 2, '0'), '.parquet')"
)

# Zones: nation n -> location n+1, borough = region name, zone = nation name.
# Nations 3, 8 and 13 are airport zones; nation 24 is left out of the seed
# so that 'Unknown' lookups happen.
AIRPORT_NATIONS = (3, 8, 13)
MISSING_NATION = 24
ZONES_SQL = """
select cast(n_nationkey + 1 as int) as location_id,
       r_name as borough,
       n_name as zone,
       case when n_nationkey in (3, 8, 13) then 'Airports' else 'Boro Zone' end as service_zone
from {nation} join {region} on n_regionkey = r_regionkey
where n_nationkey <> 24
"""

# Airport labelling for the fixture zones ('_' is a one-character wildcard,
# so each pattern still matches only its own nation name; nation 13 has no
# pattern and its NULL label is dropped).
FIXTURE_AIRPORTS = AirportRule(labels=(("N3", ("nation_3",)), ("N8", ("nation_8",))))

# Fixed vendor ids in the fixture seed: 1 and 2 (vendor 3 becomes 'Unknown').


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


# the joined lines of TRIPS_SQL, and what it makes of them
LINES_SQL, REST_SQL = (TRIPS_SQL.split("with k as (")[1].split("\n),\np as (")[0], "with p as (" + TRIPS_SQL.split("\n),\np as (")[1])
# year and month of a line's source file, by which lines are dealt out (where a row lies changes no result)
FILE_OF_LINE = ("extract(year from l_shipdate)", "if(l_partkey % 53 = 0, extract(month from l_shipdate) % 12 + 1, extract(month from l_shipdate))")


def raw_trips(spark: SparkSession, sf_dir: str, by_file: bool = False) -> DataFrame:
    """Raw trips (canonical names) with ``source_file`` lineage.

    ``by_file``: rows of a file gathered in few tasks (a hot month in several). The joined
    lines are dealt out for that, before their trips are worked out: those are twice as wide.
    """
    lines = spark.sql(
        LINES_SQL.replace("{copies}", COPIES_SPARK),
        lineitem=read_table(spark, sf_dir, "lineitem"),
        orders=read_table(spark, sf_dir, "orders"),
    )
    if by_file:
        lines = lines.withColumns({f"_{i}": F.expr(e) for i, e in enumerate(FILE_OF_LINE)}).hint("rebalance", "_0", "_1")
    trips = spark.sql(REST_SQL.replace("from k\n", "from {k} k\n"), k=lines)
    return trips.withColumn("source_file", F.expr(SOURCE_FILE_SQL.replace("varchar", "string"))).drop(
        "source_year", "source_month"
    )


def raw_trips_as_files(spark: SparkSession, sf_dir: str, trips: DataFrame | None = None) -> DataFrame:
    """Fixture rows renamed back to raw file names, timestamps and numbers as text.

    Exercises canonicalisation (P1-P11) the way a drifting raw file would.
    ``trips`` may pass already landed adapter rows.
    """
    t = trips if trips is not None else raw_trips(spark, sf_dir)
    return t.select(
        F.col("vendor_id").cast("string").alias("VendorID"),
        F.col("pickup_at").cast("string").alias("tpep_pickup_datetime"),
        F.col("dropoff_at").cast("string").alias("tpep_dropoff_datetime"),
        F.col("passenger_count").cast("double").alias("passenger_count"),
        F.col("trip_distance_mi").cast("string").alias("trip_distance"),
        F.col("rate_code_id").cast("long").alias("RatecodeID"),
        F.col("store_and_fwd_flag"),
        F.col("pu_location_id").cast("long").alias("PULocationID"),
        F.col("do_location_id").cast("long").alias("DOLocationID"),
        F.col("payment_type").cast("long").alias("payment_type"),
        F.col("fare_amount").cast("string").alias("fare_amount"),
        "extra",
        "mta_tax",
        "tip_amount",
        "tolls_amount",
        "improvement_surcharge",
        "total_amount",
        "congestion_surcharge",
        F.col("airport_fee").alias("Airport_fee"),
        # cbd_congestion_fee absent, as in files before its introduction
        F.lit("unused").alias("some_unknown_column"),
        "source_file",
    )


FAMILIES = 5
# texts that stand for a missing value in the text family: their casts lose them
NO_TIME, NO_FEE, NO_CODE = "unknown", "n/a", 99999


def as_family(named: DataFrame, trips: DataFrame, family: int) -> DataFrame:
    """Trips of one schema family.

    0 text times and numbers, missing values as texts; 1 nanosecond times and another
    spelling of the fee; 2 native types without the later columns; 3 times as plain
    integers (yyyyMMddHHmmss); 4 time texts with words around them.
    """
    if family == 0:
        missing = {"tpep_pickup_datetime": F.lit(NO_TIME), "payment_type": F.lit(NO_CODE).cast("long")}
        texts = {"Airport_fee": F.coalesce(F.col("Airport_fee").cast("string"), F.lit(NO_FEE))}
        return named.withColumns({c: F.coalesce(c, v) for c, v in missing.items()} | texts)
    pickup, dropoff = F.col("pickup_at"), F.col("dropoff_at")
    if family == 3:
        pickup, dropoff = (F.date_format(c, "yyyyMMddHHmmss").cast("long") for c in (pickup, dropoff))
    if family == 4:
        pickup, dropoff = (F.concat(F.lit("at "), c.cast("string"), F.lit(" (local)")) for c in (pickup, dropoff))
    times = {"tpep_pickup_datetime": pickup, "tpep_dropoff_datetime": dropoff}
    fee = {"airport_fee": F.col("airport_fee")} | ({"cbd_congestion_fee": F.col("cbd_congestion_fee")} if family == 1 else {})
    renamed = {
        "VendorID": "vendor_id", "passenger_count": "passenger_count", "trip_distance": "trip_distance_mi", "RatecodeID": "rate_code_id",
        "store_and_fwd_flag": "store_and_fwd_flag", "PULocationID": "pu_location_id", "DOLocationID": "do_location_id",
    }
    same = ("payment_type", "fare_amount", "extra", "mta_tax", "tip_amount", "tolls_amount", "improvement_surcharge", "total_amount", "congestion_surcharge", "source_file")
    return trips.select(
        *[c.alias(k) for k, c in times.items()], *[F.col(v).alias(k) for k, v in renamed.items()], *same, *[c.alias(k) for k, c in fee.items()]
    )


def _nanosecond_file(out_dir: str):
    """Writes one raw file's rows with nanosecond times, which Spark's own writer hasn't."""

    def write(table):
        import pyarrow as pa
        import pyarrow.parquet as pq
        from pyarrow import fs as pafs

        name = table.column("source_file")[0].as_py()
        for c in ("tpep_pickup_datetime", "tpep_dropoff_datetime"):
            table = table.set_column(table.schema.get_field_index(c), c, table.column(c).cast(pa.timestamp("ns")))
        filesystem, folder = pafs.FileSystem.from_uri(arrow_uri(out_dir))
        with filesystem.open_output_stream(f"{folder}/{name}") as out:
            pq.write_table(table.drop_columns(["source_file"]), out, version="2.6", compression="zstd")
        return pa.table({"file": [name]})

    return write


def land_files(spark: SparkSession, sf_dir: str, out_dir: str, trips: DataFrame) -> None:
    """The trips as monthly files ``out_dir/<source_file>``, months alternating between the schema families.

    A file is one month, so its rows meet in one task; the files then get their names by renaming.
    """
    jvm, conf = spark._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    Path = jvm.org.apache.hadoop.fs.Path
    named = raw_trips_as_files(spark, sf_dir, trips)
    fs = Path(out_dir).getFileSystem(conf)
    fs.mkdirs(Path(out_dir))
    for family in range(FAMILIES):
        mine = F.pmod(F.regexp_extract("source_file", FILE_YEAR_MONTH_PATTERN, 2).cast("int"), F.lit(FAMILIES)) == family
        rows = as_family(named.where(mine), trips.where(mine), family)
        staged = f"{out_dir}-family{family}"
        with shuffles_dropped(spark):
            if family == 1:
                rows.groupBy("source_file").applyInArrow(_nanosecond_file(out_dir), "file string").count()
                continue
            rows.repartition("source_file").write.option("compression", "zstd").partitionBy("source_file").parquet(staged)
        for folder in fs.globStatus(Path(f"{staged}/source_file=*")):
            name = folder.getPath().getName().split("=", 1)[1]
            for part in fs.globStatus(Path(f"{folder.getPath().toString()}/part-*")):
                fs.rename(part.getPath(), Path(f"{out_dir}/{name}"))


def land_one(spark: SparkSession, rows: DataFrame, out_dir: str, name: str) -> str:
    """Rows of one raw file as ``out_dir/<name>``; returns the path."""
    Path = spark._jvm.org.apache.hadoop.fs.Path
    staged = f"{out_dir}-staged"
    with shuffles_dropped(spark):
        rows.repartition(1).write.option("compression", "zstd").parquet(staged)
    fs = Path(out_dir).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    fs.mkdirs(Path(out_dir))
    for part in fs.globStatus(Path(f"{staged}/part-*")):
        fs.rename(part.getPath(), Path(f"{out_dir}/{name}"))
    return f"{out_dir}/{name}"


def seed_csvs(spark: SparkSession, sf_dir: str, out_dir: str) -> dict[str, str]:
    """The seeds as CSV folders with the headers that the readers expect."""
    z = zones(spark, sf_dir)
    frames = {
        "taxi_zones": z.select(F.col("location_id").alias("LocationID"), F.col("borough").alias("Borough"), F.col("zone").alias("Zone"), "service_zone"),
        "vendors": vendors(spark),
        "payment_types": payment_types(spark),
    }
    for name, df in frames.items():
        df.write.mode("overwrite").option("header", True).csv(f"{out_dir}/{name}")
    return {name: f"{out_dir}/{name}" for name in frames}


def zones(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(
        ZONES_SQL,
        nation=read_table(spark, sf_dir, "nation"),
        region=read_table(spark, sf_dir, "region"),
    )


def vendors(spark: SparkSession) -> DataFrame:
    return vendors_seed(spark)


def payment_types(spark: SparkSession) -> DataFrame:
    return payment_types_seed(spark)
