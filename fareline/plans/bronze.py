"""Bronze: raw trips -> 33-column contract with QA flags, de-duplicated per file.

Two jobs over all files. First, a narrow aggregate over the key columns finds the
repeated (file, key) set (a key-only shuffle), which is written and read back.
Then one plan does a scan per schema family, projections, the anti join against
that set (broadcast when its written size allows, so the rows are not shuffled),
projections and one write. ``dedup="aggregate"`` folds everything into a single
lazy plan whose only shuffle is the de-duplication aggregate.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from fareline.config import BASE_COLUMNS, DEFAULT_QA, DUP_KEY_COLUMNS, QaRules
from fareline.operators.dedup import add_dup_key, dedup_in_file, drop_duplicate_keys, duplicate_keys, key_filter, may_hold
from fareline.session import limit_methods, write_shared
from fareline.operators.normalize import RESCUED, canonicalize, canonicalize_names, narrow_base_types, rescued_values, select_contract, with_raw_texts
from fareline.operators.quality import derive_measures, qa_flags
from fareline.plans.store import ONLY, Store, write_table
from fareline.sources.raw import read_raw_families, year_month_from_file


def normalize_raw(df: DataFrame, rescue: bool = False) -> DataFrame:
    """Canonical names and types of one schema family (keeps ``source_file``).

    ``rescue`` adds ``_rescued``, a map from column to the raw text of a value that its
    lenient cast turned into NULL.
    """
    if not rescue:
        return narrow_base_types(canonicalize(df)).select(*BASE_COLUMNS, "source_file")
    out = narrow_base_types(canonicalize(with_raw_texts(canonicalize_names(df))))
    return out.select(*BASE_COLUMNS, "source_file", rescued_values(out).alias(RESCUED))


def normalized_families(families: list[DataFrame], rescue: bool = False) -> DataFrame:
    """The rows of all schema families under the contract's names and types."""
    raw = None
    for f in families:
        rows = normalize_raw(f, rescue)
        raw = rows if raw is None else raw.unionByName(rows)
    return raw


def dedup_with_key_set(base: DataFrame, keep: str = "none") -> DataFrame:
    """Per-file de-duplication without shuffling the rows.

    1. the repeated (file, key) set is computed by a narrow hash aggregate over
       the key columns and written as Parquet to the shared folder;
    2. rows meet it in a NULL-safe anti join. The written files' bytes are what
       the planner compares with its broadcast threshold: a small set is met
       map-side (no row shuffle, no sort);
    3. of a larger set every task gets a filter of at most 16 MB (``key_filter``).
       Rows that don't pass it have no repeated key and stay in their scan's task,
       so that a task writes to few files' partitions; the few others meet the
       set itself in a shuffled join and are gathered by file again.
    """
    dups = write_shared(duplicate_keys(base, DUP_KEY_COLUMNS, "source_file"), "repeated-keys")
    if is_broadcast(dups):
        return drop_duplicate_keys(base, dups, DUP_KEY_COLUMNS, "source_file", keep=keep)
    cols = [*DUP_KEY_COLUMNS, "source_file"]
    bits, cells = key_filter(dups, cols)
    met = may_hold(write_shared(bits, "repeated-bits").scalar(), cells, base, cols)
    # a filter isn't moved below a column like this one: the casts before it would run once more, for the filter
    held, at = base.withColumn(TASK, F.spark_partition_id()), F.col(TASK) >= 0
    rest = drop_duplicate_keys(held.where(met & at).drop(TASK), dups, DUP_KEY_COLUMNS, "source_file", keep=keep)
    alone = held.where(~met & at).drop(TASK).withColumn(FLAG, F.lit(False))
    return alone.select(*rest.columns).unionByName(rest.hint("rebalance", "source_file"))


FLAG, TASK = "qa_is_duplicate_in_file", "_task"


def is_broadcast(df: DataFrame) -> bool:
    """Whether the planner takes a written table for small enough to broadcast."""
    query = df._jdf.queryExecution()
    return query.optimizedPlan().stats().sizeInBytes() <= query.sparkSession().sessionState().conf().autoBroadcastJoinThreshold()


def bronze_from_raw(
    raw: DataFrame,
    rules: QaRules = DEFAULT_QA,
    keep: str = "none",
    canonical: bool = False,
    dedup: str = "key_set",
    losses: Observation | None = None,
) -> DataFrame:
    """Bronze contract from raw rows that carry ``source_file``.

    ``dedup="key_set"`` (default) removes repeated keys with an anti join
    against the written key set (one small job runs here to build it); ``dedup="aggregate"`` keeps everything in one lazy plan (one
    partial + final aggregate that shuffles the rows). Either way the
    derivations, flags and key text are computed after de-duplication.
    ``losses`` observes, in the write itself, how many values of each column the kept
    rows lost to lenient casts (``raw`` then carries ``_rescued``).
    """
    limit_methods(raw.sparkSession)
    if canonical:
        base = raw.select(*BASE_COLUMNS, "source_file", *([RESCUED] if losses else []))
    else:
        base = normalize_raw(raw, rescue=losses is not None)
    if dedup == "key_set":
        kept = dedup_with_key_set(base, keep=keep)
    elif dedup == "aggregate":
        kept = dedup_in_file(base, DUP_KEY_COLUMNS, "source_file", keep=keep)
    else:
        raise ValueError("dedup must be 'key_set' or 'aggregate'")
    if losses is not None:
        kept = kept.observe(losses, *[F.count(F.col(RESCUED)[c]).alias(c) for c in BASE_COLUMNS])
    out = kept.withColumns(year_month_from_file("source_file"))
    out = qa_flags(derive_measures(out), rules)
    out = add_dup_key(out)
    return select_contract(out)


def build_bronze(spark: SparkSession, raw_dir: str, rules: QaRules = DEFAULT_QA, uniform: bool = False) -> DataFrame:
    """Bronze over every ``*.parquet`` in ``raw_dir`` (schema families unioned).

    Lazy except for the small repeated-key job of the default de-duplication.
    """
    return bronze_from_raw(normalized_families(read_raw_families(spark, raw_dir, uniform=uniform)), rules, canonical=True)


BRONZE_PARTS = ("source_year", "source_month", "source_file")


def write_bronze(df: DataFrame, path: str, compression: str = "zstd") -> dict:
    """Publish bronze (all of it) as zstd Parquet partitioned by year, month and file; returns run counters.

    No shuffle before the write: bronze rows keep their scan split, and a raw
    file carries one year-month, so each task writes into the partitions of the
    files it read (file sizes follow ``spark.sql.files.maxPartitionBytes``).
    Readers see the old table until the new one is complete (``store``).
    Counters come from ``observe`` during the write itself (no second pass).
    """
    obs = Observation("bronze")
    write_table(df.observe(obs, F.count(F.lit(1)).alias("rows_written")), path, BRONZE_PARTS, compression=compression)
    return dict(obs.get)


RESCUED_TABLE = "rescued"


def rescued_rows(raw: DataFrame) -> DataFrame:
    """Lost raw values (file, column, text) with the rows that held them, for rows with ``_rescued``."""
    each = raw.select("source_file", F.explode(RESCUED).alias("column_name", "raw_value"))
    return each.groupBy("source_file", "column_name", "raw_value").agg(F.count(F.lit(1)).alias("rows"))


def run_bronze(
    spark: SparkSession, raw_dir: str, out_path: str, rules: QaRules = DEFAULT_QA, compression: str = "zstd"
) -> dict:
    """Build and publish bronze in one job; report rows in, written and duplicates removed.

    All counters are ``observe`` metrics of the write job itself (input rows are
    counted before de-duplication), so the report needs no extra pass. Where lenient
    casts lost values (``cast_losses``: column -> values, left out when there are none),
    their texts are published with the rows, as the table ``rescued`` of the same commit.
    """
    families = read_raw_families(spark, raw_dir)
    raw = normalized_families(families, rescue=True)
    seen, lost, written = Observation("bronze_in"), Observation("bronze_losses"), Observation("bronze")
    bronze = bronze_from_raw(raw.observe(seen, F.count(F.lit(1)).alias("rows_in")), rules, canonical=True, losses=lost)
    with Store(spark, out_path).begin() as commit:
        commit.write(ONLY, bronze.observe(written, F.count(F.lit(1)).alias("rows_written")), BRONZE_PARTS, compression=compression)
        losses = {c: n for c, n in lost.get.items() if n}
        if losses:
            commit.write(RESCUED_TABLE, rescued_rows(raw), compression=compression)
        elif RESCUED_TABLE in commit.tables:
            commit.drop(RESCUED_TABLE)
    rows_in, rows_written = seen.get["rows_in"], written.get["rows_written"]
    report = {
        "files": sum(len(x.inputFiles()) for x in families),
        "rows_in": rows_in,
        "rows_written": rows_written,
        "duplicates_removed": rows_in - rows_written,
    }
    return report | ({"cast_losses": losses} if losses else {})
