"""Raw monthly trip files: listing, schema families, lineage.

Monthly files drift: columns are renamed (``Airport_fee`` / ``airport_fee``),
retyped (int vs double) or absent. A single ``mergeSchema`` read cannot
reconcile case variants and type changes, so files are grouped by their
own footer schema; each family is read with one ``spark.read.parquet``
(one scan, many files), canonicalised, and the families are unioned by
name after they all have the contract types.
"""

from __future__ import annotations

import re
from collections import OrderedDict
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.utils import AnalysisException

from fareline.config import FILE_YEAR_MONTH_PATTERN
from fareline.operators.normalize import PLAIN_INTEGER, TIME_UNIT


# error conditions of a folder that is missing or holds nothing
NO_FILES = ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA")


def list_raw_files(spark: SparkSession, raw_dir: str, glob: str = "*.parquet") -> list[str]:
    """Sorted Parquet files under ``raw_dir``; raises FileNotFoundError when there are none.

    Only names are listed (no file is opened); any other error is passed on.
    """
    try:
        files = spark.read.format("binaryFile").option("pathGlobFilter", glob).load(raw_dir).inputFiles()
    except AnalysisException as exc:
        if exc.getCondition() not in NO_FILES:
            raise
        files = []
    if not files:
        raise FileNotFoundError(f"no parquet files found in {raw_dir}")
    return sorted(files, key=lambda p: p.rsplit("/", 1)[-1])


def parse_year_month(name: str) -> tuple[int, int]:
    """Year and month carried by a file name (``..._2024-01.parquet``)."""
    m = re.search(FILE_YEAR_MONTH_PATTERN, name.rsplit("/", 1)[-1])
    if not m:
        raise ValueError(f"cannot parse year-month from file name: {name}")
    return int(m.group(1)), int(m.group(2))


def arrow_uri(path: str) -> str:
    """Spark file URI -> a URI Arrow's filesystem layer understands."""
    if path.startswith("file:") and not path.startswith("file://"):
        return "file://" + path[len("file:"):]
    if path.startswith("s3a://") or path.startswith("s3n://"):
        return "s3://" + path.split("://", 1)[1]
    return path


# schemes that Arrow opens by itself; others are read through Hadoop's file systems
ARROW_SCHEMES = ("", "file", "hdfs", "s3", "s3a", "s3n", "gs", "gcs", "abfs", "abfss")
FOOTER_THREADS = 32


def footer_schemas(spark: SparkSession, files: Sequence[str], partitions: int | None = None) -> DataFrame:
    """(path, schema) of Parquet footers.

    Where Arrow knows the storage, Spark tasks read them: the file list is spread over
    ``partitions`` tasks, and each task opens only the footers of its files. Footers on
    any other storage that Spark itself can read (``viewfs`` and the like) come through
    Hadoop's file systems, ``FOOTER_THREADS`` at a time. Storage that can't be read
    fails the job.
    """
    import pandas as pd

    if any((p.split(":", 1)[0] if ":" in p else "") not in ARROW_SCHEMES for p in files):
        from concurrent.futures import ThreadPoolExecutor

        with ThreadPoolExecutor(FOOTER_THREADS) as pool:
            rows = list(zip(files, pool.map(lambda p: _hadoop_footer(spark, p), files)))
        return spark.createDataFrame(rows, "path string, schema string")

    n = partitions or max(1, min(len(files) // 200 + 1, spark.sparkContext.defaultParallelism * 4))
    paths = spark.createDataFrame([(f,) for f in files], "path string").repartition(n)

    def read(batches):
        import pyarrow.parquet as pq
        from pyarrow import fs as pafs

        for pdf in batches:
            out = []
            for p in pdf["path"]:
                filesystem, inner = pafs.FileSystem.from_uri(arrow_uri(p))
                schema = pq.read_schema(inner, filesystem=filesystem)
                out.append(schema.to_string(show_field_metadata=False, show_schema_metadata=False))
            yield pd.DataFrame({"path": pdf["path"], "schema": out})

    return paths.mapInPandas(read, "path string, schema string")


def _hadoop_footer(spark: SparkSession, path: str) -> str:
    """A file's Parquet schema as text, read with Spark's own Parquet library."""
    jvm, conf = spark._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    source = jvm.org.apache.parquet.hadoop.util.HadoopInputFile.fromPath(jvm.org.apache.hadoop.fs.Path(path), conf)
    reader = jvm.org.apache.parquet.hadoop.ParquetFileReader.open(source)
    try:
        return reader.getFooter().getFileMetaData().getSchema().toString()
    finally:
        reader.close()


_ARROW_TIME = re.compile(r"^(.+): timestamp\[(s|ms|us|ns)[,\]]", re.M)
_PARQUET_TIME = re.compile(r"^\s*(?:optional|required) \w+ (\S+) \(TIMESTAMP\((MILLIS|MICROS|NANOS),", re.M)
_UNITS = {"MILLIS": "ms", "MICROS": "us", "NANOS": "ns"}


def time_units(schema: str) -> dict[str, str]:
    """Unit of every time column of a footer's schema text."""
    return dict(_ARROW_TIME.findall(schema)) | {name: _UNITS[u] for name, u in _PARQUET_TIME.findall(schema)}


def mark_time_units(df: DataFrame, schema: str) -> DataFrame:
    """``df`` whose integer columns say what the file's footer says of them: a time's unit, or plain integers.

    Spark reads nanosecond times as integers, so only the footer tells them from counts.
    """
    units = time_units(schema)
    marks = {f.name: {TIME_UNIT: units.get(f.name, PLAIN_INTEGER)} for f in df.schema.fields if isinstance(f.dataType, T.IntegralType)}
    return df.select(*[F.col(f"`{c}`").alias(c, metadata=marks[c]) if c in marks else F.col(f"`{c}`") for c in df.columns])


def schema_families(spark: SparkSession, files: Sequence[str]) -> "OrderedDict[str, list[str]]":
    """Files grouped by footer schema, families in the order of their first file.

    Grouping runs in Spark; one row per family comes back (its schema once, and
    the paths that its reader is given).
    """
    name = F.element_at(F.split("path", "/"), -1)
    found = footer_schemas(spark, files).groupBy("schema").agg(F.sort_array(F.collect_list(F.struct(name.alias("name"), "path"))).alias("files"))
    rows = sorted(found.collect(), key=lambda r: r["files"][0]["name"])
    return OrderedDict((r["schema"], [f["path"] for f in r["files"]]) for r in rows)


def with_lineage(df: DataFrame, file_col: str = "source_file") -> DataFrame:
    """Adds the file name of every row (hidden ``_metadata`` column, no extra scan)."""
    return df.withColumn(file_col, F.col("_metadata.file_name"))


def year_month_from_file(file_col: str = "source_file") -> dict:
    """source_year / source_month parsed from the file name; a name without them fails the job."""
    c = F.col(file_col)
    year = F.regexp_extract(c, FILE_YEAR_MONTH_PATTERN, 1)
    month = F.regexp_extract(c, FILE_YEAR_MONTH_PATTERN, 2)
    bad = F.raise_error(F.concat(F.lit("cannot parse year-month from file name: "), c))
    # no match is an empty text, which is no number
    return {name: F.coalesce(text.try_cast("int"), bad.cast("int")) for name, text in (("source_year", year), ("source_month", month))}


def read_raw_families(
    spark: SparkSession, raw_dir: str, uniform: bool = False
) -> list[DataFrame]:
    """One DataFrame per schema family, each with ``source_file`` lineage.

    ``uniform=True`` skips the per-file footer reads when every file is
    known to share one schema (a single scan of the folder).
    """
    files = list_raw_files(spark, raw_dir)
    for f in files:  # fail fast, before any job
        parse_year_month(f)
    if uniform:
        allow_nanoseconds(spark)  # no footer is read here that would tell
        return [with_lineage(spark.read.parquet(*files))]
    return read_families(spark, files)


# Spark refuses nanosecond times unless it may read them as integers
NANOS_AS_LONG = "spark.sql.legacy.parquet.nanosAsLong"


def allow_nanoseconds(spark: SparkSession) -> None:
    """Have this session read nanosecond times as integers (see ``operators.normalize.to_timestamp_ntz``).

    The setting counts when a file's schema is read and again when its rows are, so it stays on.
    """
    if spark.conf.get(NANOS_AS_LONG, "false") != "true":
        spark.conf.set(NANOS_AS_LONG, "true")


def read_families(spark: SparkSession, files: Sequence[str]) -> list[DataFrame]:
    """One DataFrame with lineage per schema family of the files."""
    families = schema_families(spark, files)
    if any("ns" in time_units(schema).values() for schema in families):
        allow_nanoseconds(spark)
    return [mark_time_units(with_lineage(spark.read.parquet(*paths)), schema) for schema, paths in families.items()]
