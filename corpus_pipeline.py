"""Corpus pipeline: quality, near duplicates, decontamination, personal data, mixture.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame; its result is written
as Parquet and read again as the next stage's ``docs``. Stages 1 to 4 return the columns
of ``documents`` (with whatever others there are), stage 5 the schedule of the mixture.

Rows are told apart by a hash of (doc_id, text), so null and repeated ids are safe: rows
that repeat in both are copies, of which one stays. Empty documents link with nothing.
The near-duplicate stage keeps the row with the smallest doc_id of a component (null
ids last). Empty tables pass through as empty tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fareline.llm.common import materialize
from fareline.llm.decontaminate import decontaminate, is_contaminated
from fareline.llm.jaccard_join import jaccard_components
from fareline.llm.mixing import mix
from fareline.llm.pii import redact
from fareline.llm.quality_classifier import keep_accepted
from fareline.llm.queries import with_package

KEY = "_row_key"
# near duplicates: five words and a similarity of 0.8
SHINGLE, THRESHOLD = 5, 80


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _keyed(docs: DataFrame) -> DataFrame:
    return docs.withColumn(KEY, F.xxhash64("doc_id", "text"))


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the co-trained classifier accepts."""
    return keep_accepted(docs, _table(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component."""
    keyed = _keyed(docs)
    found = jaccard_components(keyed, id_col=KEY, size=SHINGLE, threshold=THRESHOLD)
    ids = keyed.select(KEY, F.coalesce("doc_id", F.lit((1 << 63) - 1)).alias("rank_id"))
    best = found.distinct().join(ids.distinct(), KEY).groupBy("component_id").agg(F.min(F.struct("rank_id", KEY)).alias("best"))
    kept = materialize(best.select(F.col(f"best.{KEY}").alias(KEY)), "kept")
    return keyed.join(kept.hint("shuffle_hash"), KEY).dropDuplicates([KEY]).select(docs.columns)


def benchmark_free(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that aren't contaminated by benchmark items."""
    keyed = _keyed(docs)
    found = decontaminate(keyed, _table(spark, sf_dir, "benchmark"), id_col=KEY)
    hit = materialize(found.where(is_contaminated()).select(KEY).distinct(), "contaminated")
    return keyed.join(hit, KEY, "left_anti").select(docs.columns)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with personal data replaced by its kind."""
    return redact(docs)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The schedule of the mixture: (doc_id, source, tokens, epoch, block, slot)."""
    return mix(docs)


STAGES = [
    ("quality_classifier", quality),
    ("jaccard_join", near_duplicates),
    ("decontaminate", benchmark_free),
    ("pii", personal_data),
    ("mixing", mixture),
]

# the classifier and the random field have no SQL; tests/llm/test_pipeline.py has a brute-force version
ORACLE_SQL = None


@with_package
def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = _table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
