"""Near-duplicate join on word shingles: tiles by size band, bitmap bounds, exact intersections.

A document is the set of its distinct word n-grams (64-bit hashes). Equal sets are
one set from the start on. Two sets link when their Jaccard similarity reaches the
threshold; the result is every document's component.

1. Prefixes. With shingles in one fixed order, linked sets share one of their first
   ``n - ceil(t * n) + 1`` shingles. The order is by estimated frequency (a bounded
   sketch over all documents), so common passages hardly enter a prefix. Only
   shingles in the prefixes of two sets or more go on.
2. Tiles. A tile holds the sets with one such shingle and one band of sizes (linked
   sizes lie in the same or in adjacent bands, a set visits the next band as guest).
   Tiles with the same members are one tile. Within a tile, hashed parity bitmaps bound
   overlaps from above: each differing bit stands for a shingle in one set alone. Pairs
   that pass are candidates (``linking.tile_links``: large tiles in blocks with pivots).
3. Exact step. Components of the candidates meet as sorted shingle arrays. A pair is
   intersected unless earlier links already connect it (``linking.exact_components``:
   large components in blocks of bounded sets and bytes). No link is lost; sets are told
   apart by 64-bit digests.

Defined results: a null or empty text, or one without words, has no shingles and
links with nothing; a very long text is one whole set; repeated rows are copies; null ids keep a row, and don't name a
component; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fareline.llm.common import SPACE_SPLIT, document_words, materialize, sized
from fareline.llm.linking import exact_components, tile_links
from fareline.llm.shingles import set_id, shingle_sets

SKETCH_CELLS = 1 << 18
SKETCH_TASKS = 32
TILE_ROWS = 512
# wider bitmaps bound no better; the links are the same at any width
MIN_BITS, MAX_BITS = 64, 1 << 14
# sets, and bytes of their arrays, of a component that one task holds
BLOCK_SETS, BLOCK_BYTES = 2048, 64 << 20
# bands are wider than the threshold, so that rounding can't put linked sizes two bands apart
BAND_MARGIN = 0.98


def band(n: int, t: int) -> int:
    return int(math.log(n) / -math.log(t / 100 * BAND_MARGIN))


def band_bits(b: int, t: int) -> int:
    largest = (t / 100 * BAND_MARGIN) ** -(b + 1)
    return int(min(MAX_BITS, max(MIN_BITS, 1 << math.ceil(math.log2(2 * largest)))))


def _sets(size: int, t: int):
    """Rows of documents with a bitmap, and one frequency sketch of the task's shingles."""

    def run(batches):
        sketch = np.zeros(SKETCH_CELLS, np.int64)
        for b in batches:
            for first, last, w in document_words(b.column(1), SPACE_SPLIT):
                found = list(shingle_sets(w, size))
                n = [len(s) for s in found]
                sid = [set_id(s) if len(s) else None for s in found]
                bands = [band(len(s), t) if len(s) else None for s in found]
                bits = [parity_bitmap(s, band_bits(band(len(s), t) + 1, t)) if len(s) else None for s in found]
                sketch += np.bincount((np.concatenate(found) & np.uint64(SKETCH_CELLS - 1)).astype(np.int64), minlength=SKETCH_CELLS)
                yield pa.record_batch(
                    [b.column(0)[first:last], pa.array(n, pa.int64()), pa.array(sid, pa.int64()), b.column(2)[first:last], pa.array(bands, pa.int32()), pa.array(bits, pa.binary()), pa.nulls(len(n), pa.binary())],
                    names=["id", "n", "sid", "key", "band", "bits", "sketch"],
                )
        if sketch.any():
            yield pa.record_batch([*[pa.nulls(1, pa.int64())] * 4, pa.nulls(1, pa.int32()), pa.nulls(1, pa.binary()), pa.array([sketch.astype(np.uint64).tobytes()], pa.binary())], names=["id", "n", "sid", "key", "band", "bits", "sketch"])

    return run


def _sum_sketch(batches):
    total = None
    for b in batches:
        for x in b.column(0):
            part = np.frombuffer(x.as_buffer(), np.uint64)
            total = part.copy() if total is None else total + part
    if total is not None:
        yield pa.record_batch([pa.array([total.tobytes()], pa.binary())], names=["sketch"])


def _prefixes(sketch_b, size: int, t: int):
    def run(batches):
        sketch = sketch_b.value
        seen = set()  # of the task's sets: copies give the same rows
        for b in batches:
            for _, _, w in document_words(b.column(0), SPACE_SPLIT):
                tokens, sids = [], []
                for s in shingle_sets(w, size):
                    n = len(s)
                    if n == 0 or (sid := set_id(s)) in seen:
                        continue
                    seen.add(sid)
                    k = n - (t * n + 99) // 100 + 1
                    common = sketch[(s & np.uint64(SKETCH_CELLS - 1)).astype(np.int64)]
                    tokens.append(s[np.lexsort((s, common))[:k]])
                    sids.append(sid)
                if sids:
                    counts = [len(x) for x in tokens]
                    yield pa.record_batch([pa.array(np.concatenate(tokens).view(np.int64)), pa.array(np.repeat(np.array(sids), counts))], names=["token", "sid"])

    return run


def parity_bitmap(s: np.ndarray, bits: int) -> bytes:
    at = ((s >> np.uint64(24)) & np.uint64(bits - 1)).astype(np.int64)
    return np.packbits((np.bincount(at, minlength=bits) & 1).astype(np.uint8), bitorder="little").tobytes()


def fold(bits: np.ndarray, width: int) -> np.ndarray:
    """A parity bitmap (rows of 64-bit words) at a smaller width in words: the halves' differences."""
    while bits.shape[1] > width:
        half = bits.shape[1] // 2
        bits = bits[:, :half] ^ bits[:, half:]
    return bits


def passes(na, nb, differing, t: int):
    """Whether sizes and differing bits allow the threshold: |A sym. diff. B| >= differing bits."""
    least = -(-t * (na + nb) // (100 + t))
    return (100 * np.minimum(na, nb) >= t * np.maximum(na, nb)) & (differing <= na + nb - 2 * least)


def _near(t: int):
    """The bitmap test of a table of tile rows (band, n, home, bits); guests aren't held against guests."""

    def prepare(table: pa.Table):
        n, home = table.column("n").to_numpy().astype(np.int64), table.column("home").to_numpy(zero_copy_only=False)
        bands, of_band = np.unique(table.column("band").to_numpy(), return_inverse=True)
        width = np.array([band_bits(int(b), t) // 64 for b in bands])[of_band]
        slot, words = np.zeros(len(n), np.int64), {}
        raw = table.column("bits").to_pylist()
        for size in np.unique(width):
            rows = np.flatnonzero(width == size)
            slot[rows] = np.arange(len(rows))
            # a set's bitmap is as wide as its guest band asks for: twice this band's width at most
            words[size] = np.concatenate([fold(np.frombuffer(raw[r], np.uint64)[None], size) for r in rows])

        def near(x, y):
            ok = home[x] | home[y]
            for size in words if len(words) > 1 else ():
                at = np.flatnonzero(ok & (width[x] == size))
                ok[at] = test(x[at], y[at], words[size])
            return ok if len(words) > 1 else ok & test(x, y, next(iter(words.values())))

        def test(x, y, table):
            out = np.zeros(len(x), bool)
            step = max(1, (1 << 20) // table.shape[1])
            for a in range(0, len(x), step):
                i, j = x[a : a + step], y[a : a + step]
                differing = np.bitwise_count(table[slot[i]] ^ table[slot[j]]).sum(axis=-1, dtype=np.int64)
                out[a : a + step] = passes(n[i], n[j], differing, t)
            return out

        return near

    return prepare


def jaccard_components(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    size: int = 5,
    threshold: int = 80,
    tile_rows: int = TILE_ROWS,
    block_sets: int = BLOCK_SETS,
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """(id, n_shingles, component_id) per row of ``docs``; ``threshold`` in per cent."""
    spark = docs.sparkSession
    texts = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text")).withColumn("key", F.coalesce("id", F.xxhash64("text")))
    rows = materialize(texts.mapInArrow(_sets(size, threshold), "id long, n long, sid long, key long, band int, bits binary, sketch binary"), "sets")
    # the tasks' sketches are added up by a fixed number of tasks
    sums = rows.where("sketch is not null").select("sketch").repartition(SKETCH_TASKS).mapInArrow(_sum_sketch, "sketch binary")
    sketch = np.zeros(SKETCH_CELLS, np.int64)
    for r in sums.toLocalIterator():
        sketch += np.frombuffer(r.sketch, np.uint64).astype(np.int64)
    sets = rows.where("sketch is null").select("id", "n", "sid", "key", "band", "bits")
    n_docs = sets.count()
    reps = materialize(sized(sets.where("n > 0").groupBy("sid").agg(F.min("id").alias("rep"), F.min("key").alias("key"), F.min("n").alias("n"), F.min("band").alias("band")), n_docs), "reps")

    prefixes = texts.select("text").mapInArrow(_prefixes(spark.sparkContext.broadcast(sketch), size, threshold), "token long, sid long")
    prefixes = materialize(prefixes, "prefixes")
    # written before the join, so that a hot token's side of it can be split
    n_prefix = prefixes.count()
    shared = materialize(sized(prefixes.groupBy("token").agg(F.min("sid").alias("low"), F.max("sid").alias("high")).where("low < high").select("token"), n_prefix), "shared")
    # copies of a set in several tasks gave the same rows; dealt by set, as a token may be hot
    postings = prefixes.join(shared, "token").repartition("sid").distinct()
    postings = materialize(sized(postings.join(reps.select("sid", "n", "band"), "sid"), n_prefix), "postings")
    visit = F.explode(F.array(F.struct("band", F.lit(True).alias("home")), F.struct((F.col("band") + 1).alias("band"), F.lit(False).alias("home"))))
    visits = postings.select("token", "sid", "n", visit.alias("v")).select(F.xxhash64("token", "v.band").alias("tile"), "sid", "n", "v.*")
    tiles = (
        visits.groupBy("tile", "band")
        .agg(F.count(F.lit(1)).alias("n_rows"), F.max("home").alias("homes"), F.bit_xor(F.xxhash64("sid", "home")).alias("x"), F.sum(F.xxhash64("home", "sid").cast("decimal(38,0)")).alias("s"))
        .where("n_rows > 1 and homes")
        .groupBy("band", "n_rows", "x", "s")
        .agg(F.min("tile").alias("tile"))
    )
    n_visits = 2 * postings.count()
    tiles = materialize(sized(tiles.select("tile", "n_rows"), n_visits), "tiles")
    members = materialize(sized(visits.join(tiles, "tile"), n_visits), "visits")
    wanted = members.select("sid").distinct().join(reps.select("sid", "key"), "sid")
    maps = sets.select("sid", "key", "bits").join(wanted, ["sid", "key"]).groupBy("sid").agg(F.first("bits").alias("bits"))
    members = materialize(sized(members.join(maps, "sid").withColumn("lead", F.col("home")), n_visits), "members")

    candidates = tile_links(members, ["n", "band", "home", "bits"], _near(threshold), tile_rows)
    linked = exact_components(candidates, reps.select("sid", "key", "n"), texts.select("text", "key"), size, threshold, block_sets, block_bytes, n_docs)
    names = reps.join(linked.select(F.col("node").alias("sid"), "component"), "sid", "left").withColumn("component", F.coalesce("component", "sid"))
    names = names.join(names.groupBy("component").agg(F.min("rep").alias("component_id")), "component").select("sid", "component_id")
    return sets.select("id", "n", "sid").join(names, "sid", "left").select(
        F.col("id").alias(id_col), F.col("n").alias("n_shingles"), F.when(F.col("n") == 0, F.col("id")).otherwise(F.col("component_id")).alias("component_id")
    )


def op8_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of all documents at a similarity of 0.9 over 3-word shingles."""
    return jaccard_components(spark.read.parquet(f"{sf_dir}/documents.parquet"), size=3, threshold=90)


OP8_SQL = r"""
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
    SELECT a, b FROM c JOIN n p ON p.r = a JOIN n q ON q.r = b WHERE 100 * c >= 90 * (p.n + q.n - c)
), links AS (
    SELECT a, b FROM e UNION ALL SELECT b, a FROM e
), reach AS (
    SELECT r AS a, r AS b FROM n
    UNION
    SELECT reach.a, links.b FROM reach JOIN links ON links.a = reach.b
)
SELECT doc_id, coalesce(n.n, 0) AS n_shingles, coalesce(low, doc_id) AS component_id
FROM d LEFT JOIN n USING (r) LEFT JOIN (SELECT a AS r, min(doc_id) AS low FROM reach JOIN d ON d.r = reach.b GROUP BY a) USING (r)
"""
