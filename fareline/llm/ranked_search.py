"""Ranked lexical search of many queries at once, sharing what they have in common.

1. Index. Documents are tokenised once into blocks of inverted lists (term hash ->
   document of the block, occurrences), written to the shared folder. Searches read the
   index, never the texts again.
2. Sharing. Queries are cut into slices of a bounded number of terms. Within a slice,
   shared term sets are mined: neighbouring nodes of two queries' term lists (most
   shared terms first) that occur in two queries or more become a node of their own,
   round by round, until no pair is shared. The result is a directed graph: terms, sets
   of terms as sums of two nodes, and queries as sums of nodes.
3. Evaluation. A task goes through its blocks of documents. Every term's scores and
   every set's partial accumulator are materialised once per block, level by level, and
   the queries add up the accumulators they share. A task keeps each query's best
   documents so far; their worst score is the bar for the next block.
4. The tasks' bests are ranked per query in two steps, so that no task gets the
   candidates of all tasks for one query.

The score of a document sums, over the query's terms with repeats, w * ((10^9 * tf) div
(1000 * tf + 12 * m)) in 64-bit integers; w falls with the documents that hold the term,
m grows with the document's length (see ``term_weights`` and ``length_norms``).

Defined results: a null or empty text, or one without terms, has no terms: as a document
it isn't found, as a query it finds nothing. Very long texts are scanned in pieces and
form a block of their own. Repeated documents rank one after the other (equal scores by
ascending id, null ids last); repeated queries are ranked each by itself, null query ids
too. Empty tables give no rows; other columns are ignored.
"""

from __future__ import annotations

import math
import pickle
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from fareline.llm.common import ALNUM_WORD, document_words, materialize

TOP = 20
# (query, term) pairs of a slice: bounds the broadcast graph, and a task's accumulators
SLICE_TERMS = 50_000
# accumulator cells that a task holds at once
CELLS = 8 << 20
RANK_SALT = 32
INDEX_SCHEMA = "ids array<long>, sizes binary, terms binary, ends binary, docs binary, tfs binary"


def _blocks(block_bytes: int):
    def run(batches):
        for b in batches:
            for first, last, w in document_words(b.column(1), ALNUM_WORD, block_bytes):
                order = np.lexsort((w.doc, w.hash))
                term, doc = w.hash[order], w.doc[order].astype(np.uint32)
                new = np.append(True, (term[1:] != term[:-1]) | (doc[1:] != doc[:-1])) if len(term) else np.zeros(0, bool)
                at = np.flatnonzero(new)
                tf = np.diff(np.append(at, len(term))).astype(np.uint32)
                posting, doc = term[at], doc[at]
                terms, starts = np.unique(posting, return_index=True)
                ends = np.append(starts[1:], len(posting)).astype(np.uint32)
                packed = [np.diff(w.first).astype(np.int64), terms, ends, doc, tf]
                yield pa.record_batch(
                    [pa.array([b.column(0)[first:last].to_pylist()], pa.list_(pa.int64())), *(pa.array([x.tobytes()], pa.binary()) for x in packed)],
                    names=["ids", "sizes", "terms", "ends", "docs", "tfs"],
                )

    return run


def build_index(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", block_bytes: int = 2 << 20) -> DataFrame:
    """The written index of ``docs``: one row per block of documents."""
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    return materialize(rows.mapInArrow(_blocks(block_bytes), INDEX_SCHEMA), "ranked-index")


def _query_terms(batches):
    """Distinct terms of each query with their occurrences."""
    for b in batches:
        rows = []
        for _, _, w in document_words(b.column(1), ALNUM_WORD):
            rows += [np.unique(w.hash[w.first[d] : w.first[d + 1]], return_counts=True) for d in range(w.n_docs)]
        yield pa.record_batch(
            [b.column(0), pa.array([len(t) for t, _ in rows], pa.int64()), pa.array([t.tobytes() for t, _ in rows], pa.binary()), pa.array([c.astype(np.int64).tobytes() for _, c in rows], pa.binary())],
            names=["row", "n", "terms", "counts"],
        )


def share(lists: list[list[int]], n_leaves: int) -> tuple[list[tuple[int, int]], list[list[int]]]:
    """Mines shared sets: (children of each new node, the lists with sets in place of their terms).

    Node ``n_leaves + i`` is the sum of the i-th pair of children. A list's nodes stand
    with the most shared ones first, so that neighbours are likely to be shared too.
    """
    uses = Counter(x for one in lists for x in one)
    lists = [sorted(one, key=lambda x: (-uses[x], x)) for one in lists]
    nodes: list[tuple[int, int]] = []
    while True:
        pairs = Counter(p for one in lists for p in set(zip(one, one[1:])))
        # each list takes its most shared pairs that don't overlap
        plans, chosen = [], Counter()
        for one in lists:
            taken, at = set(), []
            for _, i in sorted((-pairs[p], i) for i, p in enumerate(zip(one, one[1:])) if pairs[p] > 1):
                if i not in taken and i + 1 not in taken:
                    taken |= {i, i + 1}
                    at.append(i)
            plans.append(at)
            chosen.update({(one[i], one[i + 1]) for i in at})
        # a pair that only one list takes stays as it is
        ids = {p: n_leaves + len(nodes) + k for k, p in enumerate(sorted(p for p, c in chosen.items() if c > 1))}
        if not ids:
            break
        nodes += sorted(ids, key=ids.get)
        for q, (one, at) in enumerate(zip(lists, plans)):
            starts = {i for i in at if (one[i], one[i + 1]) in ids}
            out, i = [], 0
            while i < len(one):
                out.append(ids[one[i], one[i + 1]] if i in starts else one[i])
                i += 2 if i in starts else 1
            lists[q] = out
        weight = Counter(x for one in lists for x in one)
        lists = [sorted(one, key=lambda x: (-weight[x], x)) for one in lists]
    return nodes, lists


class Graph:
    """A slice's sharing graph: ``vocab`` (sorted hashes), node levels, and the queries' node lists."""

    def __init__(self, rows, queries: list[tuple[np.ndarray, np.ndarray]]):
        self.rows = list(rows)
        self.vocab = np.unique(np.concatenate([t for t, _ in queries])) if queries else np.zeros(0, np.uint64)
        n = len(self.vocab)
        # a term that occurs k times stands k times in the list
        lists = [np.repeat(np.searchsorted(self.vocab, t), c).tolist() for t, c in queries]
        nodes, lists = share(lists, n)
        self.n_nodes = n + len(nodes)
        self.additions = len(nodes) + sum(max(len(x) - 1, 0) for x in lists)
        self.plain_additions = sum(max(int(c.sum()) - 1, 0) for _, c in queries)
        level = np.zeros(self.n_nodes, np.int64)
        for i, (a, b) in enumerate(nodes):
            level[n + i] = 1 + max(level[a], level[b])
        pair = np.array(nodes, np.int64).reshape(-1, 2)
        self.levels = []
        for k in range(1, int(level.max(initial=0)) + 1):
            at = np.flatnonzero(level == k)
            self.levels.append((at, pair[at - n, 0], pair[at - n, 1]))
        self.flat = np.array([x for one in lists for x in one], np.int64)
        self.starts = np.cumsum([0, *(len(x) for x in lists)])[:-1]
        self.filled = np.array([len(x) > 0 for x in lists], bool)

    def totals(self, acc: np.ndarray) -> np.ndarray:
        """Scores (queries x documents) from the terms' scores in the first rows of ``acc`` (nodes x documents)."""
        for at, a, b in self.levels:
            acc[at] = acc[a] + acc[b]
        out = np.zeros((len(self.rows), acc.shape[1]), np.int64)
        some = np.flatnonzero(self.filled)
        step = max(1, CELLS // max(1, acc.shape[1]))
        first = 0
        while first < len(some):
            # queries whose lists together fill a bounded gather
            stops = np.append(self.starts[some[1:]], len(self.flat))
            last = max(first + 1, int(np.searchsorted(stops, self.starts[some[first]] + step, side="right")))
            part = some[first:last]
            lo, hi = self.starts[part[0]], stops[last - 1]
            if last == first + 1:
                for at in range(lo, hi, step):
                    out[part[0]] += acc[self.flat[at : min(hi, at + step)]].sum(axis=0)
            else:
                out[part] = np.add.reduceat(acc[self.flat[lo:hi]], self.starts[part] - lo, axis=0)
            first = last
        return out


def slice_graph(table: pa.Table) -> Graph:
    rows = sorted(zip(table.column("row").to_pylist(), table.column("terms").to_pylist(), table.column("counts").to_pylist()))
    return Graph([r for r, _, _ in rows], [(np.frombuffer(t, np.uint64), np.frombuffer(c, np.int64)) for _, t, c in rows])


def _compile(table: pa.Table) -> pa.Table:
    return pa.table({"slice": table.column("slice")[:1], "graph": pa.array([pickle.dumps(slice_graph(table))], pa.binary())})


def find_terms(terms: np.ndarray, vocab: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(position in ``vocab``, position in ``terms``) of the common values of two sorted arrays."""
    at = np.searchsorted(terms, vocab)
    hit = np.flatnonzero(at < len(terms))
    hit = hit[terms[at[hit]] == vocab[hit]]
    return hit, at[hit]


def _document_counts(vocab_b):
    def run(batches):
        vocab = vocab_b.value
        count = np.zeros(len(vocab), np.int64)
        for b in batches:
            for t, e in zip(b.column(0), b.column(1)):
                ends = np.frombuffer(e.as_buffer(), np.uint32).astype(np.int64)
                mine, at = find_terms(np.frombuffer(t.as_buffer(), np.uint64), vocab)
                count[mine] += np.diff(ends, prepend=0)[at]
        on = np.flatnonzero(count)
        yield pa.record_batch([pa.array(on), pa.array(count[on])], names=["term", "df"])

    return run


def term_weights(df: np.ndarray, n_docs: int) -> np.ndarray:
    """floor(1000 * ln((2N + 2) / (2 df + 1)))"""
    return np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * int(x) + 1))) for x in df], np.int64)


def length_norms(sizes: np.ndarray, n_docs: int, n_terms: int) -> np.ndarray:
    return 75 + (25 * sizes * n_docs) // max(n_terms, 1)


class Best:
    """The best ``k`` documents of each query so far: score falling, id rising, null ids last."""

    def __init__(self, n: int, k: int):
        self.k, self.bar = k, np.zeros(n, np.int64)
        self.held = [np.zeros((4, 0), np.int64)]
        self.size = 0

    def add(self, totals: np.ndarray, ids: np.ndarray, null: np.ndarray) -> None:
        # equal to the bar may still win by its id
        q, d = np.nonzero((totals > 0) & (totals >= self.bar[:, None]))
        self.held.append(np.stack([q, -totals[q, d], null[d], ids[d]]))
        self.size += len(q)
        if self.size > 4 * self.k * max(len(self.bar), 256):
            self.shrink()

    def shrink(self) -> np.ndarray:
        rows = np.concatenate(self.held, axis=1)
        rows = rows[:, np.lexsort(rows[::-1])]
        first = np.searchsorted(rows[0], np.arange(len(self.bar)))
        rank = np.arange(rows.shape[1]) - first[rows[0]]
        last = rows[:, rank == self.k - 1]
        self.bar[last[0]] = -last[1]
        rows = rows[:, rank < self.k]
        self.held, self.size = [rows], rows.shape[1]
        return rows


def _search(shared, k: int):
    def run(batches):
        graph, weight, n_docs, n_terms = shared.value
        best = Best(len(graph.rows), k)
        for b in batches:
            for i in range(b.num_rows):
                raw = [np.frombuffer(b.column(c)[i].as_buffer(), t) for c, t in zip(("sizes", "terms", "ends", "docs", "tfs"), (np.int64, np.uint64, np.uint32, np.uint32, np.uint32))]
                sizes, terms, ends, docs, tfs = raw
                ids = b.column("ids")[i].values
                null, ids = ids.is_null().to_numpy(zero_copy_only=False).astype(np.int64), ids.fill_null(0).to_numpy()
                mine, at = find_terms(terms, graph.vocab)
                stop = ends.astype(np.int64)[at]
                size = np.diff(ends.astype(np.int64), prepend=0)[at]
                posting = np.arange(size.sum()) + np.repeat(stop - np.cumsum(size), size)
                term, doc, tf = np.repeat(mine, size), docs[posting].astype(np.int64), tfs[posting].astype(np.int64)
                m = length_norms(sizes, n_docs, n_terms)
                score = weight[term] * ((1_000_000_000 * tf) // (1000 * tf + 12 * m[doc]))
                width = max(1, CELLS // max(1, graph.n_nodes))
                for lo in range(0, len(sizes), width):
                    on = (doc >= lo) & (doc < lo + width)
                    acc = np.zeros((graph.n_nodes, min(width, len(sizes) - lo)), np.int64)
                    acc[term[on], doc[on] - lo] = score[on]
                    best.add(graph.totals(acc), ids[lo : lo + width], null[lo : lo + width])
        q, negative, null, ids = best.shrink()
        rows = np.array(graph.rows, np.int64)
        yield pa.record_batch([pa.array(rows[q]), pa.array(ids, mask=null.astype(bool)), pa.array(-negative)], names=["row", "id", "score"])

    return run


def search(
    index: DataFrame,
    queries: DataFrame,
    item_col: str = "item_id",
    text_col: str = "text",
    id_col: str = "doc_id",
    k: int = TOP,
    slice_terms: int = SLICE_TERMS,
) -> DataFrame:
    """(item, rank, id, score) of each query's ``k`` best documents of a built index."""
    spark = index.sparkSession
    items = materialize(queries.select(F.monotonically_increasing_id().alias("row"), F.col(item_col).alias("item"), F.col(text_col).cast("string").alias("text")), "queries")
    terms = materialize(items.select("row", "text").mapInArrow(_query_terms, "row long, n long, terms binary, counts binary"), "query-terms").where("n > 0")
    pairs = terms.agg(F.sum("n")).first()[0] or 0
    slices = -(-pairs // slice_terms)
    found = None
    if slices:
        dealt = terms.withColumn("slice", F.pmod(F.xxhash64("row"), F.lit(slices)).cast("int"))
        graphs = materialize(dealt.groupBy("slice").applyInArrow(_compile, "slice int, graph binary"), "graphs")
        total = index.select("sizes").mapInArrow(_collection, "docs long, terms long").agg(F.sum("docs"), F.sum("terms")).first()
        n_docs, n_terms = total[0] or 0, total[1] or 0
        for s in range(slices):
            row = graphs.where(F.col("slice") == s).first()  # a slice is bounded by its terms
            if row is None:
                continue
            graph = pickle.loads(row.graph)
            vocab = spark.sparkContext.broadcast(graph.vocab)
            df = np.zeros(len(graph.vocab), np.int64)
            for r in index.select("terms", "ends").mapInArrow(_document_counts(vocab), "term long, df long").groupBy("term").agg(F.sum("df").alias("df")).collect():
                df[r.term] = r.df
            shared = spark.sparkContext.broadcast((graph, term_weights(df, n_docs), n_docs, n_terms))
            part = index.mapInArrow(_search(shared, k), "row long, id long, score long")
            found = part if found is None else found.union(part)
    if found is None:
        found = spark.createDataFrame([], "row long, id long, score long")
    order = [F.desc("score"), F.asc_nulls_last("id")]
    found = found.withColumn("salt", F.pmod(F.xxhash64("id"), F.lit(RANK_SALT)))
    found = found.withColumn("rank", F.row_number().over(Window.partitionBy("row", "salt").orderBy(*order))).where(F.col("rank") <= k)
    found = found.withColumn("rank", F.row_number().over(Window.partitionBy("row").orderBy(*order))).where(F.col("rank") <= k)
    return found.join(items.select("row", "item"), "row").select(F.col("item").alias(item_col), "rank", F.col("id").alias(id_col), "score")


def _collection(batches):
    """Documents with terms and all terms of a task's blocks."""
    docs = terms = 0
    for b in batches:
        for x in b.column(0):
            sizes = np.frombuffer(x.as_buffer(), np.int64)
            docs, terms = docs + int((sizes > 0).sum()), terms + int(sizes.sum())
    yield pa.record_batch([pa.array([docs]), pa.array([terms])], names=["docs", "terms"])


def op11_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 best documents of every benchmark item."""
    return search(build_index(spark.read.parquet(f"{sf_dir}/documents.parquet")), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


OP11_SQL = r"""
WITH d AS (
    SELECT row_number() OVER () AS r, doc_id,
        regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS w
    FROM documents
), size AS (
    SELECT count(*) FILTER (len(w) > 0) AS n_docs, sum(len(w))::BIGINT AS n_terms FROM d
), i AS (
    SELECT row_number() OVER () AS q, item_id,
        regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS w
    FROM benchmark
), qt AS (
    SELECT q, t, count(*) AS c FROM (SELECT q, unnest(w) AS t FROM i) GROUP BY q, t
), tf AS (
    SELECT r, t, count(*) AS tf FROM (SELECT r, unnest(w) AS t FROM d) WHERE t IN (SELECT t FROM qt) GROUP BY r, t
), weight AS (
    SELECT t, floor(1000 * ln((2 * n_docs + 2)::DOUBLE / (2 * count(*) + 1)))::BIGINT AS w FROM tf, size GROUP BY t, n_docs
), per AS (
    SELECT r, t, tf, 100 - 25 + ((25 * len(w) * n_docs) // n_terms) AS m FROM tf JOIN d USING (r), size
), score AS (
    SELECT q, r, sum(c * weight.w * ((1000000000 * tf) // (1000 * tf + 12 * m)))::BIGINT AS score FROM qt JOIN per USING (t) JOIN weight USING (t) GROUP BY q, r
), ranked AS (
    SELECT q, doc_id, score, row_number() OVER (PARTITION BY q ORDER BY score DESC, doc_id NULLS LAST)::INTEGER AS rank
    FROM score JOIN d USING (r) WHERE score > 0
)
SELECT item_id, rank, doc_id, score FROM ranked JOIN i USING (q) WHERE rank <= 20
"""
