"""Incremental bronze + silver over newly landed raw files (Structured Streaming).

Raw monthly files arrive in a folder. A ``binaryFile`` stream lists new
files (only the ``path`` column is selected, so file contents are never
read by the stream itself); ``foreachBatch`` then runs the batch bronze and
silver plans over exactly the files of that micro-batch:

* per-file de-duplication is exact, because a file never spans micro-batches;
* each batch is grouped by schema family like the batch build, so files
  whose schema drifted are still canonicalised correctly;
* bronze and silver are published by (source_year, source_month, source_file), silver
  by split as well. A batch replaces the partitions of its files in one step, so a
  replayed or corrected file, or one processed under changed rules, replaces all it
  wrote before (also when no row of it is left) and never touches rows of other files;
  readers see the rows from before or those from after, also when a batch dies half
  way - the stream checkpoint records which files were done;
* with a warehouse folder, every batch refreshes facts, marts and dimensions too
  (``plans.incremental``): only the months that its files touch are merged anew.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from fareline.config import DEFAULT_QA, QaRules
from fareline.plans.bronze import BRONZE_PARTS
from fareline.plans.incremental import Seeds, bronze_of_files, of_files, refresh
from fareline.plans.silver import SILVER_PARTITIONS, silver_from_bronze
from fareline.plans.store import Store, write_table

# Fixed schema of Spark's binaryFile source.
LISTING_SCHEMA = "path string, modificationTime timestamp, length bigint, content binary"


def process_files(
    spark: SparkSession, files: list[str], bronze_path: str, silver_path: str, rules: QaRules = DEFAULT_QA
) -> None:
    """Batch bronze + silver for a set of raw files, replacing all that those files wrote before."""
    if not files:
        return
    bronze = bronze_of_files(spark, files, rules)
    mine = of_files(files)
    write_table(bronze, bronze_path, BRONZE_PARTS, replace=mine)
    written = Store(spark, bronze_path).read(wanted=mine)
    write_table(silver_from_bronze(written, check=True), silver_path, SILVER_PARTITIONS, replace=mine)


def _start(spark: SparkSession, raw_dir: str, checkpoint_location: str, process: Callable, max_files_per_trigger: int | None, available_now: bool) -> StreamingQuery:
    """A stream over the names of new raw files that hands each batch's files to ``process(spark, files)``."""
    reader = spark.readStream.format("binaryFile").schema(LISTING_SCHEMA).option("pathGlobFilter", "*.parquet")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    paths = reader.load(raw_dir).select("path")

    def on_batch(batch: DataFrame, batch_id: int) -> None:
        # one row per new file (paths only, at most max_files_per_trigger)
        process(batch.sparkSession, sorted(r["path"] for r in batch.collect()))

    w = paths.writeStream.foreachBatch(on_batch).option("checkpointLocation", checkpoint_location)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")
    return w.start()


def start_landing_stream(
    spark: SparkSession,
    raw_dir: str,
    bronze_path: str,
    silver_path: str,
    checkpoint_location: str,
    rules: QaRules = DEFAULT_QA,
    max_files_per_trigger: int | None = 64,
    available_now: bool = True,
) -> StreamingQuery:
    """Start the landing stream; ``available_now`` processes what is there and stops."""

    def process(session: SparkSession, files: list[str]) -> None:
        process_files(session, files, bronze_path, silver_path, rules)

    return _start(spark, raw_dir, checkpoint_location, process, max_files_per_trigger, available_now)


def start_warehouse_stream(
    spark: SparkSession,
    raw_dir: str,
    store_path: str,
    checkpoint_location: str,
    seeds: Seeds,
    rules: QaRules = DEFAULT_QA,
    max_files_per_trigger: int | None = 64,
    available_now: bool = True,
) -> StreamingQuery:
    """The landing stream up to the marts: every batch is one commit of all layers in one store."""

    def process(session: SparkSession, files: list[str]) -> None:
        refresh(session, store_path, files, seeds, rules)

    return _start(spark, raw_dir, checkpoint_location, process, max_files_per_trigger, available_now)
