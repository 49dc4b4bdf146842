"""Silver: bronze -> four disjoint quality splits (+ the fare-miss subset of clean).

The reference runs five filtered scans and five sinks, then recounts each
output. Here: one scan, one CASE column, one partitioned write; counts and
the coverage check come from one aggregate.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from fareline.config import BRONZE_COLUMNS, SPLIT_FARE_MISS
from fareline.operators.normalize import check_contract, drop_optional, silver_normalize
from fareline.operators.quality import coverage, split, split_counts, with_split
from fareline.plans.store import read_table, write_table
from fareline.session import limit_methods

SPLIT_COLUMN = "silver_split"


def silver_from_bronze(bronze: DataFrame, check: bool = True) -> DataFrame:
    """Bronze rows labelled with their split (``silver_split``)."""
    limit_methods(bronze.sparkSession)
    df = drop_optional(bronze)
    if check:
        check_contract(df, BRONZE_COLUMNS)
    return with_split(silver_normalize(df), SPLIT_COLUMN)


def read_bronze(spark: SparkSession, path: str) -> DataFrame:
    return read_table(spark, path)


def splits(silver: DataFrame) -> dict[str, DataFrame]:
    """The five reference outputs as lazy filters over one labelled frame."""
    from fareline.config import DISJOINT_SPLITS

    out = {name: split(silver, name, SPLIT_COLUMN).drop(SPLIT_COLUMN) for name in DISJOINT_SPLITS}
    out[SPLIT_FARE_MISS] = split(silver, SPLIT_FARE_MISS, SPLIT_COLUMN).drop(SPLIT_COLUMN)
    return out


SILVER_PARTITIONS = (SPLIT_COLUMN, "source_year", "source_month", "source_file")


def write_silver(silver: DataFrame, path: str, compression: str = "zstd") -> None:
    """One job that replaces the whole table: a partition per split, source month and file.

    fare_miss is a filter of clean, not a copy. The lower levels let later
    jobs prune to the months they rebuild and replace single files. No shuffle
    before the write: a task holds rows of the files it read, so it writes at most
    four files for each. Readers see the old table until the new one is complete.
    """
    write_table(silver, path, SILVER_PARTITIONS, compression=compression)


def read_silver(spark: SparkSession, path: str) -> DataFrame:
    return read_table(spark, path)


def read_split(silver: DataFrame, name: str) -> DataFrame:
    """One split of a silver table read back (partition pruning on ``silver_split``)."""
    return split(silver, name, SPLIT_COLUMN).drop(SPLIT_COLUMN)


def register_split_views(spark: SparkSession, silver: DataFrame, prefix: str = "silver") -> list[str]:
    """Temp views ``<prefix>_<split>`` for the five split names, as SQL users know them; returns the names."""
    names = []
    for name, rows in splits(silver).items():
        rows.createOrReplaceTempView(f"{prefix}_{name}")
        names.append(f"{prefix}_{name}")
    return names


def silver_report(silver: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(split counts, coverage row)."""
    return split_counts(silver, SPLIT_COLUMN), coverage(silver, SPLIT_COLUMN)


def run_silver(bronze: DataFrame, path: str, compression: str = "zstd") -> dict:
    """Split and write silver in one job; split sizes and the coverage check come from
    ``observe`` metrics of that write (no re-reading of the outputs)."""
    from pyspark.sql import Observation
    from pyspark.sql import functions as F

    from fareline.config import DISJOINT_SPLITS, SPLIT_CLEAN

    silver = silver_from_bronze(bronze)
    obs = Observation("silver")
    s = F.col(SPLIT_COLUMN)
    metrics = [F.count(F.lit(1)).alias("total_rows")]
    metrics += [F.count_if(s == name).alias(name) for name in DISJOINT_SPLITS]
    metrics.append(
        F.count_if((s == SPLIT_CLEAN) & F.coalesce(F.col("qa_is_fare_mismatch"), F.lit(False))).alias(SPLIT_FARE_MISS)
    )
    write_silver(silver.observe(obs, *metrics), path, compression)
    m = dict(obs.get)
    base_good = m["total_rows"] - m["rejected"] - m["trips_admin"]
    covered = m["trips_clean"] + m["trips_anomalies"]
    m.update({"base_good": base_good, "covered": covered, "coverage_ok": base_good == covered})
    return m
