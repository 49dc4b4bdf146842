"""Benchmark decontamination over a distributed positional inverted index.

Training documents are cut into blocks of about ``block_bytes``. A block's index
segment is one row of a written table: its test terms in order, and for each the
ascending positions at which it stands (a gap parts neighbouring documents).
Windows of the benchmark items are looked up segment by segment: their terms are
ordered from the rarest in the whole corpus on, the rarest term's positions are
shifted by its offset, and every further list only keeps starts that it confirms.

The benchmark is the stated query set. It is taken in slices of bounded words, so
what is broadcast (a slice's windows and vocabulary) is bounded whatever its size.

Defined results: a null or empty text has no words and isn't contaminated; items
without words or without an id take no part; repeated items count once by id;
repeated and null document ids keep one row per input row; an empty benchmark
hits nothing; other columns of either input are ignored, whatever their names.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fareline.llm.common import ALNUM_WORD, document_words, materialize

WINDOW = 13
SLICE_WORDS = 200_000
# positions between the last word of a document and the first of the next one
DOC_GAP = 64
# proximity: so many of a window's rarest terms within so many words of each other
NEAR_TERMS, NEAR_SPAN = 3, 20

SEGMENT_SCHEMA = "block long, ids array<long>, n_words binary, terms binary, ends binary, steps binary"


def _item_words(batches):
    for b in batches:
        ids = b.column(0).to_pylist()
        for first, _, w in document_words(b.column(1), ALNUM_WORD):
            rows = [(ids[first + d], w.hash[w.first[d] : w.first[d + 1]]) for d in range(w.n_docs)]
            yield pa.record_batch(
                [pa.array([r[0] for r in rows], pa.string()), pa.array([len(r[1]) for r in rows], pa.int64()), pa.array([r[1].tobytes() for r in rows], pa.binary())],
                ["item", "n", "words"],
            )


def item_slices(benchmark: DataFrame, id_col: str, text_col: str, slice_words: int) -> list[list[tuple[str, np.ndarray]]]:
    """Items as (id, word hashes), in slices of about ``slice_words`` words; one slice at a time is held."""
    items = benchmark.where(F.col(id_col).isNotNull()).select(F.col(id_col).cast("string").alias("item"), F.col(text_col).alias("t"))
    words = materialize(items.mapInArrow(_item_words, "item string, n long, words binary").where("n > 0"), "items")
    total = words.agg(F.sum("n")).first()[0] or 0
    parts = -(-total // slice_words)
    for i in range(parts):
        rows = words.where(F.pmod(F.xxhash64("item", "words"), F.lit(parts)) == i).collect()
        yield [(r.item, np.frombuffer(r.words, np.uint64)) for r in rows]


def window_table(items: list[tuple[str, np.ndarray]], window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(vocabulary, terms[w, window], length[w], item[w]); absent terms of short windows are numbered len(vocabulary)."""
    vocab = np.unique(np.concatenate([h for _, h in items])) if items else np.zeros(0, np.uint64)
    terms, lengths, owner = [], [], []
    for i, (_, h) in enumerate(items):
        t = np.searchsorted(vocab, h).astype(np.int64)
        if len(t) < window:
            t = np.concatenate([t, np.full(window - len(t), len(vocab))])
            lengths.append(np.array([len(h)]))
        else:
            lengths.append(np.full(len(h) - window + 1, window))
        view = np.lib.stride_tricks.sliding_window_view(t, window)
        terms.append(view)
        owner.append(np.full(len(view), i))
    if not items:
        return vocab, np.zeros((0, window), np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    return vocab, np.concatenate(terms), np.concatenate(lengths), np.concatenate(owner)


def _segments(vocab_b, block_bytes: int):
    """Index segments of the documents (id, text) of a task."""

    def run(batches):
        vocab = vocab_b.value
        seen = np.zeros(1 << 20, bool)
        seen[(vocab & np.uint64((1 << 20) - 1)).astype(np.int64)] = True
        part, n = TaskContext.get().partitionId(), 0
        for b in batches:
            ids = b.column(0)
            for first, last, w in document_words(b.column(1), ALNUM_WORD, block_bytes):
                at = np.flatnonzero(seen[(w.hash & np.uint64((1 << 20) - 1)).astype(np.int64)])
                term = np.minimum(np.searchsorted(vocab, w.hash[at]), max(len(vocab) - 1, 0))
                if len(vocab):
                    keep = vocab[term] == w.hash[at]
                    at, term = at[keep], term[keep]
                pos = at + DOC_GAP * w.doc[at]
                order = np.argsort(term, kind="stable")
                term, pos = term[order], pos[order]
                starts = np.flatnonzero(np.diff(term, prepend=-1))
                steps = np.diff(pos, prepend=0)
                steps[starts] = pos[starts]
                yield pa.record_batch(
                    [
                        pa.array([(part << 32) | n]),
                        pa.array([ids[first:last].to_pylist()], pa.list_(pa.int64())),
                        pa.array([np.diff(w.first).astype(np.int64).tobytes()], pa.binary()),
                        pa.array([term[starts].astype(np.int32).tobytes()], pa.binary()),
                        pa.array([np.append(starts, len(term))[1:].astype(np.int64).tobytes()], pa.binary()),
                        pa.array([steps.astype(np.int64 if len(pos) and pos.max() >= 1 << 31 else np.int32).tobytes()], pa.binary()),
                    ],
                    names=["block", "ids", "n_words", "terms", "ends", "steps"],
                )
                n += 1

    return run


def _frequencies(n_terms: int):
    """How often each term stands in a task's segments."""

    def run(batches):
        total = np.zeros(n_terms, np.int64)
        for b in batches:
            for terms, ends in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                total[np.frombuffer(terms, np.int32)] += np.diff(np.frombuffer(ends, np.int64), prepend=0)
        at = np.flatnonzero(total)
        yield pa.record_batch([pa.array(at), pa.array(total[at])], names=["term", "n"])

    return run


def _ragged(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """starts[i], starts[i] + 1, ... (counts[i] of them) for all i."""
    ends = np.cumsum(counts)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts - (ends - counts), counts)


def segment_matches(terms, ends, pos, windows, rarest, lengths, n_vocab):
    """Exact matches (window, start) and proximity matches (window, position) in one segment.

    ``terms``/``ends``/``pos`` are its sorted terms, list ends and positions; ``rarest[w]``
    has the offsets of window ``w`` from its rarest term on, padding last.
    """
    counts = np.diff(ends, prepend=0)
    first = np.full(n_vocab + 1, -1, np.int64)
    first[terms] = ends - counts
    size = np.zeros(n_vocab + 1, np.int64)
    size[terms] = counts
    keys = (np.repeat(terms.astype(np.int64), counts) << 32) | pos
    present = first >= 0
    present[n_vocab] = True
    rows = np.arange(len(windows))

    def start(alive):
        term = windows[alive, rarest[alive, 0]]
        return np.repeat(alive, size[term]), pos[_ragged(first[term], size[term])]

    alive = rows[present[windows].all(axis=1)]
    w, p = start(alive)
    s = p - rarest[w, 0]
    for k in range(1, windows.shape[1]):
        off = rarest[w, k]
        term = windows[w, off]
        key = (term << 32) | (s + off)
        i = np.minimum(np.searchsorted(keys, key), max(len(keys) - 1, 0))
        ok = (term == n_vocab) | ((s + off >= 0) & (keys[i] == key)) if len(keys) else term == n_vocab
        w, s = w[ok], s[ok]

    top = windows[rows[:, None], rarest[:, :NEAR_TERMS]]
    nw, np_ = start(rows[present[top].all(axis=1)])
    for k in range(1, min(NEAR_TERMS, windows.shape[1])):
        term = windows[nw, rarest[nw, k]]
        i = np.searchsorted(keys, (term << 32) | np.maximum(np_ - NEAR_SPAN, 0))
        i_ok = np.minimum(i, max(len(keys) - 1, 0))
        ok = (term == n_vocab) | ((i < len(keys)) & (keys[i_ok] <= ((term << 32) | (np_ + NEAR_SPAN)))) if len(keys) else term == n_vocab
        nw, np_ = nw[ok], np_[ok]
    return (w, s), (nw, np_)


MATCH_SCHEMA = "block long, doc int, starts array<long>, ends array<long>, items array<string>, near array<string>"


def _matches(table_b):
    """Per document with a match: merged word ranges (within the document) and the items."""

    def run(batches):
        vocab_size, windows, rarest, lengths, owner, names = table_b.value
        for b in batches:
            for block, nw, terms, ends, steps in zip(*(b.column(c).to_pylist() for c in ("block", "n_words", "terms", "ends", "steps"))):
                n_words = np.frombuffer(nw, np.int64)
                terms, ends = np.frombuffer(terms, np.int32), np.frombuffer(ends, np.int64)
                total = int(ends[-1]) if len(ends) else 0
                if total == 0:
                    continue
                steps = np.frombuffer(steps, np.int32 if len(steps) == 4 * total else np.int64).astype(np.int64)
                counts = np.diff(ends, prepend=0)
                pos = np.cumsum(steps)
                pos -= np.repeat(pos[ends - counts] - steps[ends - counts], counts)
                (w, s), (nw_, np_) = segment_matches(terms, ends, pos, windows, rarest, lengths, vocab_size)
                origin = np.cumsum(n_words + DOC_GAP) - (n_words + DOC_GAP)
                out: dict[int, list] = {}
                doc = np.searchsorted(origin, s, side="right") - 1
                order = np.lexsort((s, doc))
                for i in order:
                    d = out.setdefault(int(doc[i]), [[], [], set(), set()])
                    a = int(s[i] - origin[doc[i]])
                    z = a + int(lengths[w[i]])
                    if d[1] and a <= d[1][-1]:
                        d[1][-1] = max(z, d[1][-1])
                    else:
                        d[0].append(a)
                        d[1].append(z)
                    d[2].add(names[owner[w[i]]])
                near_doc = np.searchsorted(origin, np_, side="right") - 1
                for d, i in set(zip(near_doc.tolist(), owner[nw_].tolist())):
                    out.setdefault(d, [[], [], set(), set()])[3].add(names[i])
                if out:
                    yield pa.record_batch(
                        [
                            pa.array([block] * len(out)),
                            pa.array(list(out), pa.int32()),
                            *(pa.array([v[k] for v in out.values()], pa.list_(pa.int64())) for k in (0, 1)),
                            *(pa.array([sorted(v[k]) for v in out.values()], pa.list_(pa.string())) for k in (2, 3)),
                        ],
                        names=["block", "doc", "starts", "ends", "items", "near"],
                    )

    return run


def _union_length(ranges):
    """Words covered by an array of (start, end) structs in order."""
    step = lambda acc, r: F.struct(
        (acc["n"] + F.greatest(F.lit(0).cast("long"), r["e"] - F.greatest(r["s"], acc["to"]))).alias("n"),
        F.greatest(acc["to"], r["e"]).alias("to"),
    )
    zero = F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).cast("long").alias("to"))
    return F.aggregate(ranges, zero, step, lambda acc: acc["n"])


def _document_rows(batches):
    for b in batches:
        for block, ids, nw in zip(*(b.column(c).to_pylist() for c in ("block", "ids", "n_words"))):
            n = np.frombuffer(nw, np.int64)
            yield pa.record_batch(
                [pa.array(np.full(len(n), block)), pa.array(np.arange(len(n), dtype=np.int32)), pa.array(ids, pa.int64()), pa.array(n)],
                names=["block", "doc", "id", "n_words"],
            )


def build_index(docs: DataFrame, vocab: np.ndarray, id_col: str, text_col: str, block_bytes: int = 2 << 20) -> DataFrame:
    """The written index table of ``docs`` for the terms of ``vocab`` (sorted word hashes)."""
    shared = docs.sparkSession.sparkContext.broadcast(vocab)
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    return materialize(rows.mapInArrow(_segments(shared, block_bytes), SEGMENT_SCHEMA), "index")


def decontaminate(
    docs: DataFrame,
    benchmark: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    window: int = WINDOW,
    slice_words: int = SLICE_WORDS,
    block_bytes: int = 2 << 20,
) -> DataFrame:
    """Per document: id, n_words, n_hit, ``items`` (array) with an exact window match and ``near_items``."""
    spark = docs.sparkSession
    base, found = None, None
    for items in item_slices(benchmark, item_col, item_text_col, slice_words):
        vocab, windows, lengths, owner = window_table(items, window)
        index = build_index(docs, vocab, id_col, text_col, block_bytes)
        base = index if base is None else base
        # the table is as long as the slice's vocabulary
        counted = index.select("terms", "ends").mapInArrow(_frequencies(len(vocab)), "term long, n long").groupBy("term").agg(F.sum("n").alias("n"))
        frequency = np.zeros(len(vocab) + 1, np.int64)
        frequency[-1] = np.iinfo(np.int64).max
        for r in counted.collect():
            frequency[r.term] = r.n
        rarest = np.argsort(frequency[windows], axis=1, kind="stable")
        table = spark.sparkContext.broadcast((len(vocab), windows, rarest, lengths, owner, [i for i, _ in items]))
        part = index.mapInArrow(_matches(table), MATCH_SCHEMA)
        found = part if found is None else found.union(part)
    if base is None:
        base = build_index(docs, np.zeros(0, np.uint64), id_col, text_col, block_bytes)
        found = spark.createDataFrame([], MATCH_SCHEMA)
    ranges = F.array_sort(F.flatten(F.collect_list(F.transform(F.arrays_zip("starts", "ends"), lambda r: F.struct(r["starts"].alias("s"), r["ends"].alias("e"))))))
    hits = found.groupBy("block", "doc").agg(
        _union_length(ranges).alias("n_hit"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("near")))).alias("near"),
    )
    none = F.array().cast("array<string>")
    return (
        base.select("block", "ids", "n_words")
        .mapInArrow(_document_rows, "block long, doc int, id long, n_words long")
        .join(hits, ["block", "doc"], "left")
        .select(
            F.col("id").alias(id_col),
            "n_words",
            F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
            F.coalesce("items", none).alias("items"),
            F.coalesce("near", none).alias("near_items"),
        )
    )


def is_contaminated(n_hit="n_hit", n_words="n_words"):
    """The rule: a twentieth of a document's words or more are hit."""
    return (F.col(n_hit) > 0) & (20 * F.col(n_hit) >= F.col(n_words))


def op3_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark windows in every document."""
    out = decontaminate(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return out.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        is_contaminated().alias("contaminated"),
        F.size("near_items").cast("long").alias("n_near_items"),
    )


OP3_SQL = rf"""
WITH d AS (
    SELECT row_number() OVER () AS r, doc_id,
        regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
    FROM documents
), i AS (
    SELECT item_id::VARCHAR AS item,
        regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
    FROM benchmark WHERE item_id IS NOT NULL
), s AS (
    SELECT item, w, least(len(w), {WINDOW}) AS k, unnest(range(1, len(w) - least(len(w), {WINDOW}) + 2)) AS a FROM i WHERE len(w) > 0
), wins AS (
    SELECT row_number() OVER () AS id, item, k, w[a : a + k - 1] AS t FROM s
), runs AS (
    SELECT r, k, unnest(range(1, len(w) - k + 2)) AS a, w FROM d, (SELECT DISTINCT k FROM wins) WHERE len(w) >= k
), hits AS (
    SELECT r, a, runs.k, item FROM runs JOIN wins ON wins.k = runs.k AND w[a : a + runs.k - 1] = t
), covered AS (
    SELECT r, count(DISTINCT p) AS n_hit FROM (SELECT r, unnest(range(a, a + k)) AS p FROM hits) GROUP BY r
), found AS (
    SELECT r, count(DISTINCT item) AS n_items, string_agg(DISTINCT item, ',' ORDER BY item) AS items FROM hits GROUP BY r
), terms AS (
    SELECT id, item, unnest(range(1, k + 1)) AS o, t FROM wins
), tp AS (
    SELECT r, unnest(range(1, len(w) + 1)) AS p, unnest(w) AS term FROM d
), cf AS (
    SELECT term, count(*) AS n FROM tp GROUP BY term
), ranked AS (
    SELECT id, item, t[o] AS term, row_number() OVER (PARTITION BY id ORDER BY coalesce(n, 0), o) AS rank FROM terms LEFT JOIN cf ON cf.term = t[o]
), near1 AS (
    SELECT id, item, r, p FROM ranked JOIN tp USING (term) WHERE rank = 1
), near2 AS (
    SELECT * FROM near1 WHERE NOT EXISTS (SELECT 1 FROM ranked x WHERE x.id = near1.id AND x.rank = 2) OR EXISTS (
        SELECT 1 FROM ranked x JOIN tp USING (term) WHERE x.id = near1.id AND x.rank = 2 AND tp.r = near1.r AND tp.p BETWEEN near1.p - {NEAR_SPAN} AND near1.p + {NEAR_SPAN})
), near3 AS (
    SELECT * FROM near2 WHERE NOT EXISTS (SELECT 1 FROM ranked x WHERE x.id = near2.id AND x.rank = 3) OR EXISTS (
        SELECT 1 FROM ranked x JOIN tp USING (term) WHERE x.id = near2.id AND x.rank = 3 AND tp.r = near2.r AND tp.p BETWEEN near2.p - {NEAR_SPAN} AND near2.p + {NEAR_SPAN})
), near AS (
    SELECT r, count(DISTINCT item) AS n_near FROM near3 GROUP BY r
)
SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(items, '')) AS items_sha256,
    coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated, coalesce(n_near, 0) AS n_near_items
FROM d LEFT JOIN covered USING (r) LEFT JOIN found USING (r) LEFT JOIN near USING (r)
"""
