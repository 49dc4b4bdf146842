"""Near-duplicate components by min-max hashing.

1. Signatures. A document is the set of its distinct word n-grams. Every permutation of
   the hash space gives two values, the set's minimum and its maximum, so half as many
   hash evaluations as for minima alone fill a signature; each value of two sets agrees
   with the probability of their Jaccard similarity, and as a minimum and a maximum
   differ slightly negatively, the estimate varies a little less. Equal sets are one set
   from the start on.
2. Bands. A band's key joins the values of a few permutations. Their number follows from
   the threshold, so that a pair at it shares no band with a probability below ``MISS``.
   Sets with a key in common are a tile; tiles with the same members are one.
3. Candidates. Within a tile, pairs are held against the threshold by 128 values of
   their signatures, 8 bits each, cut so low that a pair at the threshold fails with a
   probability below ``MISS`` (``linking.tile_links``: no tile is listed pair by pair).
4. Exact step. Candidate components meet as sorted shingle arrays; links are confirmed on
   the full sets (``linking.exact_components``).

Defined results: a null or empty text, or one without words, has no shingles and links
with nothing; a text of fewer words than a shingle is one shingle; repeated rows are
copies; null ids keep a row, and don't name a component (their ``kept`` is null); ties
don't occur (a component is named by its smallest id); very long texts are whole sets;
an empty table gives an empty result; other columns are ignored. Sets are told apart by
64-bit digests.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fareline.llm.common import SPACE_SPLIT, document_words, materialize, mix64, sized
from fareline.llm.linking import exact_components, tile_links
from fareline.llm.shingles import set_id, shingle_sets

MISS = 1e-9
BAND_PERMUTATIONS = 3
SKETCH = 128
TILE_ROWS, BLOCK_SETS, BLOCK_BYTES = 512, 2048, 64 << 20
SIGNED_PER_TASK = 50_000

_GOLDEN = np.uint64(0x9E3779B97F4A7C15)
_LAST = np.uint64(0xD6E8FEB86659FD93)


def band_count(t: int, permutations: int = BAND_PERMUTATIONS, miss: float = MISS) -> int:
    """Bands of 2 * ``permutations`` values that a pair at ``t`` per cent misses altogether with at most ``miss``."""
    return max(1, math.ceil(math.log(miss) / math.log1p(-((t / 100) ** (2 * permutations)))))


def least_agreements(t: int, n: int = SKETCH, miss: float = MISS) -> int:
    """The largest number of agreeing values that a pair at ``t`` per cent falls short of with at most ``miss``."""
    p, total = t / 100, 0.0
    for m in range(n + 1):
        total += math.comb(n, m) * p**m * (1 - p) ** (n - m)
        if total > miss:
            return m
    return n


def min_max(sets: list[np.ndarray], permutations: int) -> np.ndarray:
    """(sets, 2 * permutations) signature values: minimum and maximum under each permutation."""
    out = np.zeros((len(sets), 2 * permutations), np.uint64)
    if not sets:
        return out
    starts = np.cumsum([0, *(len(s) for s in sets)])[:-1]
    x = np.concatenate(sets)
    seeds = mix64((np.arange(2 * permutations, dtype=np.uint64) + np.uint64(1)) * _GOLDEN)
    for i in range(permutations):
        # a bijection of 64 bits
        y = x + seeds[2 * i]
        y *= seeds[2 * i + 1] | np.uint64(1)
        y ^= y >> np.uint64(32)
        y *= _LAST
        out[:, 2 * i] = np.minimum.reduceat(y, starts)
        out[:, 2 * i + 1] = np.maximum.reduceat(y, starts)
    return out


def band_keys(values: np.ndarray, bands: int) -> np.ndarray:
    """(sets, bands) 64-bit keys of the bands' values."""
    width = values.shape[1] // bands
    keys = np.broadcast_to(mix64((np.arange(bands, dtype=np.uint64) + np.uint64(1)) * _LAST), (len(values), bands)).copy()
    for k in range(width):
        keys = mix64(keys * _GOLDEN + values[:, k : bands * width : width])
    return keys


ROW_SCHEMA = "id long, n long, sid long, key long, bands array<long>, sketch binary"


def _signatures(size: int, bands: int):
    permutations = bands * BAND_PERMUTATIONS

    def run(batches):
        seen = set()  # of the task's sets: a copy gives a row without a signature
        for b in batches:
            for first, last, w in document_words(b.column(1), SPACE_SPLIT):
                found = list(shingle_sets(w, size))
                sid = [set_id(s) if len(s) else None for s in found]
                new = []
                for d, k in enumerate(sid):
                    if k is not None and k not in seen:
                        seen.add(k)
                        new.append(d)
                values = min_max([found[d] for d in new], permutations)
                keys = band_keys(values, bands).view(np.int64)
                low = values[:, :SKETCH].astype(np.uint8)
                at = np.full(len(found), -1)
                at[new] = np.arange(len(new))
                take = pa.array(np.where(at < 0, 0, at), mask=at < 0)
                lists = pa.ListArray.from_arrays(pa.array(np.arange(len(new) + 1, dtype=np.int32) * bands), pa.array(keys.ravel()))
                sketches = pa.array([x.tobytes() for x in low], pa.binary())
                yield pa.record_batch(
                    [b.column(0)[first:last], pa.array([len(s) for s in found], pa.int64()), pa.array(sid, pa.int64()), b.column(2)[first:last], lists.take(take), sketches.take(take)],
                    names=["id", "n", "sid", "key", "bands", "sketch"],
                )

    return run


def _near(t: int):
    least = least_agreements(t)

    def prepare(table: pa.Table):
        n = table.column("n").to_numpy()
        sketch = np.frombuffer(b"".join(table.column("sketch").to_pylist()), np.uint8).reshape(len(n), -1)

        def near(x, y):
            ok = 100 * np.minimum(n[x], n[y]) >= t * np.maximum(n[x], n[y])
            at = np.flatnonzero(ok)
            ok[at] = (sketch[x[at]] == sketch[y[at]]).sum(axis=1) >= least
            return ok

        return near

    return prepare


def near_duplicates(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    size: int = 5,
    threshold: int = 80,
    tile_rows: int = TILE_ROWS,
    block_sets: int = BLOCK_SETS,
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """(id, n_shingles, component_id, kept) per row of ``docs``; ``threshold`` in per cent."""
    bands = max(band_count(threshold), -(-SKETCH // (2 * BAND_PERMUTATIONS)))
    texts = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text")).withColumn("key", F.coalesce("id", F.xxhash64("text")))
    rows = materialize(texts.mapInArrow(_signatures(size, bands), ROW_SCHEMA), "signatures")
    n_docs = rows.count()
    sets = materialize(sized(rows.where("n > 0").groupBy("sid").agg(F.min("id").alias("rep"), F.min("key").alias("key"), F.min("n").alias("n")), n_docs), "sets")
    signed = materialize(sized(rows.where("bands is not null").groupBy("sid").agg(F.min("n").alias("n"), F.min("bands").alias("bands"), F.min("sketch").alias("sketch")), n_docs, SIGNED_PER_TASK), "signed")

    buckets = signed.select("sid", F.explode("bands").alias("tile"))
    tiles = (
        buckets.groupBy("tile")
        .agg(F.count(F.lit(1)).alias("n_rows"), F.bit_xor(F.xxhash64("sid")).alias("x"), F.sum(F.xxhash64("sid", F.lit(1)).cast("decimal(38,0)")).alias("s"))
        .where("n_rows > 1")
        .groupBy("n_rows", "x", "s")
        .agg(F.min("tile").alias("tile"))
    )
    tiles = materialize(sized(tiles.select("tile", "n_rows"), bands * n_docs), "tiles")
    members = buckets.join(tiles, "tile").join(signed.select("sid", "n", "sketch"), "sid").withColumn("lead", F.lit(True))
    members = materialize(sized(members, bands * n_docs), "members")
    candidates = tile_links(members, ["n", "sketch"], _near(threshold), tile_rows)
    linked = exact_components(candidates, sets.select("sid", "key", "n"), texts.select("text", "key"), size, threshold, block_sets, block_bytes, n_docs)
    names = sets.join(linked.select(F.col("node").alias("sid"), "component"), "sid", "left").withColumn("component", F.coalesce("component", "sid"))
    lowest = names.groupBy("component").agg(F.min("rep").alias("component_id"))
    named = rows.select("id", "n", "sid").join(names.join(lowest, "component").select("sid", "component_id"), "sid", "left")
    component = F.when(F.col("n") == 0, F.col("id")).otherwise(F.col("component_id"))
    return named.select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"), component.alias("component_id"), (F.col("id") == component).alias("kept"))


def op12_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of all documents at a similarity of 0.85 over 3-word shingles."""
    return near_duplicates(spark.read.parquet(f"{sf_dir}/documents.parquet"), size=3, threshold=85)


OP12_SQL = r"""
WITH RECURSIVE d AS (
    SELECT row_number() OVER () AS r, doc_id,
        regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
    FROM documents
), s AS (
    SELECT DISTINCT r, CASE WHEN len(w) < 3 THEN array_to_string(w, ' ') ELSE array_to_string(w[a : a + 2], ' ') END AS g
    FROM (SELECT r, w, unnest(range(1, greatest(len(w) - 2, 1) + 1)) AS a FROM d WHERE len(w) > 0)
), n AS (
    SELECT r, count(*) AS n FROM s GROUP BY r
), c AS (
    SELECT x.r AS a, y.r AS b, count(*) AS c FROM s x JOIN s y ON x.g = y.g AND x.r < y.r GROUP BY x.r, y.r
), e AS (
    SELECT a, b FROM c JOIN n p ON p.r = a JOIN n q ON q.r = b WHERE 100 * c >= 85 * (p.n + q.n - c)
), links AS (
    SELECT a, b FROM e UNION ALL SELECT b, a FROM e
), reach AS (
    SELECT r AS a, r AS b FROM n
    UNION
    SELECT reach.a, links.b FROM reach JOIN links ON links.a = reach.b
)
SELECT doc_id, coalesce(n.n, 0) AS n_shingles, coalesce(low, doc_id) AS component_id, doc_id = coalesce(low, doc_id) AS kept
FROM d LEFT JOIN n USING (r) LEFT JOIN (SELECT a AS r, min(doc_id) AS low FROM reach JOIN d ON d.r = reach.b GROUP BY a) USING (r)
"""
