"""Duplicate keys and per-file de-duplication.

The reference sorts each file by a hash of seven columns and drops EVERY
member of a repeated key. Here the same rule is one grouped aggregate over
the real key columns (NULLs group together, no hash collisions):

* ``groupBy(source_file, *key)`` with ``count`` and ``any_value`` of the
  remaining columns, then keep groups of size 1. A group of size 1 *is*
  the row, so nothing is joined back.
* Spark plans it as partial + final aggregation, so a key that holds a
  third of all rows collapses to one row per map task before the shuffle;
  a window (``count over partitionBy``) would instead send the whole hot
  group to one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fareline.config import ALT_DUP_KEY_COLUMNS, DUP_KEY_COLUMNS
from fareline.functions.expressions import row_key
from fareline.session import write_shared

COPIES = "_copies"
_HASH = "_key_hash"

# Grouping order does not change the result, but Spark sorts on the first
# key's 8-byte prefix: a selective fixed-width key first (timestamps, then
# doubles) resolves most comparisons there; a low-cardinality string first
# (the file name) makes every comparison fall through to the full row.
_TYPE_RANK = {"timestamp_ntz": 0, "timestamp": 0, "double": 1, "bigint": 2, "int": 2, "smallint": 2, "date": 2}


def _sort_friendly(df: DataFrame, cols: Sequence[str]) -> list[str]:
    types = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    return sorted(cols, key=lambda c: (_TYPE_RANK.get(types.get(c, ""), 3), list(cols).index(c)))


def add_dup_key(df: DataFrame, columns: Sequence[str] = DUP_KEY_COLUMNS, name: str = "dup_key") -> DataFrame:
    """dup_key = 128-bit digest (MD5) of an injective text of the key columns (absent columns read as NULL)."""
    present = set(df.columns)
    cols = [F.col(c) if c in present else F.lit(None) for c in columns]
    return df.withColumn(name, row_key(cols))


def add_alt_dup_key(df: DataFrame, name: str = "dup_key") -> DataFrame:
    """The alternative eight-column key (passenger count, total and payment included)."""
    cols = ALT_DUP_KEY_COLUMNS
    if "trip_distance_mi" not in df.columns and "trip_distance" in df.columns:
        cols = tuple("trip_distance" if c == "trip_distance_mi" else c for c in cols)
    return add_dup_key(df, cols, name)


def dedup_in_file(
    df: DataFrame,
    key: Sequence[str] = DUP_KEY_COLUMNS,
    file_col: str = "source_file",
    keep: str = "none",
    flag_col: str | None = "qa_is_duplicate_in_file",
) -> DataFrame:
    """Remove repeated keys inside each file.

    keep="none"  (reference): every member of a repeated key is dropped.
    keep="first": one deterministic representative (smallest row) is kept.
    Equal keys in two different files are both kept.
    """
    group = _sort_friendly(df, [*key, file_col])
    others = [c for c in df.columns if c not in group]
    if keep == "none":
        agg = df.groupBy(*group).agg(
            F.count(F.lit(1)).alias(COPIES), *[F.any_value(c).alias(c) for c in others]
        )
        out = agg.where(F.col(COPIES) == 1)
    elif keep == "first":
        agg = df.groupBy(*group).agg(F.count(F.lit(1)).alias(COPIES), F.min(F.struct(*others)).alias("_row"))
        out = agg.select(*group, COPIES, *[F.col("_row")[c].alias(c) for c in others])
    else:
        raise ValueError("keep must be 'none' or 'first'")
    if flag_col:
        out = out.withColumn(flag_col, F.col(COPIES) > 1)
    cols = list(df.columns) + ([flag_col] if flag_col and flag_col not in df.columns else [])
    return out.select(*cols)


def dedup_report(
    df: DataFrame, key: Sequence[str] = DUP_KEY_COLUMNS, file_col: str = "source_file"
) -> DataFrame:
    """Per file: rows_in, duplicates_removed (all members of repeated keys), rows_written.

    Hardly any key repeats, so an aggregate over the key columns would hold and shuffle
    nearly every row. A 64-bit hash stands for file and key first: the hashes that occur
    more than once are written to the shared folder (a small job runs here), and only rows
    with one of those are grouped by their real columns, so that a collision changes nothing.
    """
    group = _sort_friendly(df, [*key, file_col])
    rows = df.select(*group, _key_hash(df, group).alias(_HASH))
    repeated = write_shared(rows.groupBy(_HASH).agg(F.count(F.lit(1)).alias(COPIES)).where(F.col(COPIES) > 1).select(_HASH), "repeated-hashes")
    groups = rows.join(repeated, _HASH, "left_semi").groupBy(*group).agg(F.count(F.lit(1)).alias(COPIES)).where(F.col(COPIES) > 1)
    seen = df.groupBy(file_col).agg(F.count(F.lit(1)).alias("seen")).withColumn("gone", F.lit(0).cast("long"))
    removed = groups.groupBy(file_col).agg(F.sum(COPIES).alias("gone")).select(file_col, F.lit(0).cast("long").alias("seen"), "gone")
    return seen.unionByName(removed).groupBy(file_col).agg(
        F.sum("seen").alias("rows_in"),
        F.sum("gone").alias("duplicates_removed"),
        (F.sum("seen") - F.sum("gone")).alias("rows_written"),
    )


def _key_hash(df: DataFrame, cols: Sequence[str]) -> Column:
    """64-bit hash that columns equal in grouping share (grouping takes -0.0 for 0.0)."""
    types = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    return F.xxhash64(*[F.col(c) + F.lit(0.0).cast(types[c]) if types[c] in ("double", "float") else F.col(c) for c in cols])


# cells of a key filter: CHUNK words of 64, and 2^18 to 2^27 (16 MB) in all
CHUNK, LEAST_CHUNKS, MOST_CHUNKS = 4096, 1, 512
# cells for each key, as far as the bounds allow
CELLS = 32


def key_filter(keys: DataFrame, cols: Sequence[str]) -> tuple[DataFrame, int]:
    """Bits of the hashes of ``keys`` as one row, an array of arrays of longs, and the number of its cells.

    At most 16 MB whatever the number of keys; with more keys more rows of others pass it.
    """
    n, chunks = keys.count(), LEAST_CHUNKS
    while chunks < MOST_CHUNKS and chunks * CHUNK * 64 < CELLS * n:
        chunks *= 2
    cells = chunks * CHUNK * 64
    cell = F.pmod(_key_hash(keys, cols), F.lit(cells))
    words = keys.select(cell.alias("c")).groupBy(F.floor(F.col("c") / 64).alias("w")).agg(F.bit_or(_bit(F.col("c"))).alias("bits"))
    every = keys.sparkSession.range(chunks * CHUNK).join(words, F.col("id") == F.col("w"), "left").select("id", F.coalesce("bits", F.lit(0)).alias("bits"))

    def in_order(column: str) -> Column:
        return F.transform(F.array_sort(F.collect_list(F.struct("id", column))), lambda e: e[column])

    parts = every.groupBy(F.floor(F.col("id") / CHUNK).alias("part")).agg(in_order("bits").alias("bits"))
    return parts.select(F.col("part").alias("id"), "bits").agg(in_order("bits").alias("bits")), cells


def _bit(cell: Column) -> Column:
    return F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod(cell, F.lit(64)).cast("int"))


def may_hold(bits: Column, cells: int, df: DataFrame, cols: Sequence[str]) -> Column:
    """Whether a row's key may be one of a ``key_filter``: always true for those, and seldom for others."""
    cell = F.pmod(_key_hash(df, cols), F.lit(cells))
    word = F.floor(cell / 64).cast("int")
    return F.get(F.get(bits, F.floor(word / CHUNK).cast("int")), F.pmod(word, F.lit(CHUNK))).bitwiseAND(_bit(cell)) != 0


def key_class_sizes(df: DataFrame, key_col: str = "dup_key") -> DataFrame:
    """Histogram of key equality classes: copies -> number of keys."""
    return (
        df.groupBy(key_col)
        .agg(F.count(F.lit(1)).alias("copies"))
        .groupBy("copies")
        .agg(F.count(F.lit(1)).alias("keys"))
    )


def duplicate_keys(df: DataFrame, key: Sequence[str] = DUP_KEY_COLUMNS, file_col: str = "source_file") -> DataFrame:
    """Keys (with their file) that occur more than once, and how often.

    A narrow aggregate over the key columns only: fixed-width buffers, so Spark
    plans a hash aggregate, and partial aggregation collapses a hot group of
    copies to one row per map task before the shuffle.
    """
    group = _sort_friendly(df, [*key, file_col])
    return df.groupBy(*group).agg(F.count(F.lit(1)).alias(COPIES)).where(F.col(COPIES) > 1)


def drop_duplicate_keys(
    df: DataFrame,
    dup_keys: DataFrame,
    key: Sequence[str] = DUP_KEY_COLUMNS,
    file_col: str = "source_file",
    keep: str = "none",
    flag_col: str | None = "qa_is_duplicate_in_file",
) -> DataFrame:
    """Rows whose (file, key) is not in ``dup_keys`` (NULL-safe equality).

    No join hint: the planner broadcasts a key set whose size it knows to be
    small (see ``plans.bronze.dedup_with_key_set``). keep="first" adds one
    deterministic representative per repeated key (only repeated rows shuffle).
    """
    group = [*key, file_col]
    k = dup_keys.select(*[F.col(c).alias(f"_k_{c}") for c in group])
    cond = None
    for c in group:
        e = df[c].eqNullSafe(k[f"_k_{c}"])
        cond = e if cond is None else cond & e
    out = df.join(k, cond, "left_anti")
    if flag_col:
        out = out.withColumn(flag_col, F.lit(False))
    if keep == "first":
        others = [c for c in df.columns if c not in group]
        reps = (
            df.join(k, cond, "left_semi")
            .groupBy(*_sort_friendly(df, group))
            .agg(F.min(F.struct(*others)).alias("_row"))
            .select(*group, *[F.col("_row")[c].alias(c) for c in others])
        )
        if flag_col:
            reps = reps.withColumn(flag_col, F.lit(True))
        out = out.unionByName(reps)
    elif keep != "none":
        raise ValueError("keep must be 'none' or 'first'")
    cols = list(df.columns) + ([flag_col] if flag_col and flag_col not in df.columns else [])
    return out.select(*cols)
