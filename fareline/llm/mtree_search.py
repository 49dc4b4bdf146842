"""Exact top-k inner-product search with M-trees.

Components become integers floor(256 x). Vectors get one more component that gives all of
them the same norm M, and queries get a 0 there: the inner product is then
(|q|^2 + M^2 - d^2) / 2 of the Euclidean distance d, so the largest products are the
nearest neighbours of a metric space.

1. Vectors are dealt to the nearest of a bounded number of pivots (clustered from a
   bounded sample), so a tree covers a part of the space; a pivot's trees are of bounded
   size. A tree is bulk-loaded in pages: inner pages hold routing vectors with covering
   radii and distances to the parent, leaf pages hold vectors with distances to the
   leaf's routing vector.
2. The directory, broadcast, has each pivot with the radius that covers its trees.
   Queries go to trees in waves: first to their nearest pivot's, then to the next ones,
   then to all others. After a wave, a query's k-th best score so far is known, and it
   visits only trees whose covering ball can still hold a better one. Trees stay where
   they are but for one copy per block of queries.
3. A search takes pages from a queue by their least possible distance, from the bound
   that earlier waves left; before a distance is computed, the triangle inequality on the
   stored parent distance is tried. Scores that count are exact integers.

Defined results: vectors that are null or hold a null or non-finite component, and
vectors without an id, take no part; shorter vectors count as padded with zeros; a
query's candidates are all rows but its own, also others with its id; repeated query rows
each get a result; ties go to the smaller id; an empty table gives an empty result; other
columns are ignored. Texts don't occur.
"""

from __future__ import annotations

import heapq
import pickle

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from fareline.llm.common import materialize

# a page costs about as much as the products of a hundred vectors
PAGE = 256
FANOUT = 8
# components in a tree; pivots of the directory at most; vectors that the pivots are clustered from
TREE_VALUES = 1 << 18
MAX_PIVOTS, SAMPLE = 4096, 20_000
QUERY_BLOCK = 2048
# pivots that a query's trees of each wave belong to; the last wave takes all others
WAVES = (1, 4)
# distances are compared with this much relative slack; exact scores decide
SLACK = 1e-9


class MTree:
    """Pages of one tree: (True, rows, ids, vectors, distances to the routing vector) for leaves, (False, child
    pages, routing vectors, covering radii, distances to the parent's routing vector) for others.

    ``top2`` is the common squared norm of all points, ``centre`` what the root's distances are to.
    """

    def __init__(self, rows: np.ndarray, ids: np.ndarray, vectors: np.ndarray, top2: float | None = None, centre: np.ndarray | None = None):
        self.rows, self.ids, self.vectors = rows, ids, vectors
        norm2 = (vectors.astype(np.float64) ** 2).sum(axis=1)
        self.top2 = float(norm2.max(initial=0.0)) if top2 is None else top2
        self.points = np.concatenate([vectors.astype(np.float64), np.sqrt(np.maximum(self.top2 - norm2, 0.0))[:, None]], axis=1)
        self.pages: list[tuple] = []
        self.centre = (self.points.mean(axis=0) if len(ids) else np.zeros(vectors.shape[1] + 1)) if centre is None else centre
        self.root = self._load(np.arange(len(ids)), self.centre, 0) if len(ids) else -1
        self.radius = float(np.sqrt(((self.points - self.centre) ** 2).sum(axis=1)).max(initial=0.0))
        del self.points

    def _load(self, rows: np.ndarray, centre: np.ndarray, depth: int) -> int:
        """Write the page of ``rows`` around ``centre`` (its parent's routing vector) and return its number."""
        distance = np.sqrt(((self.points[rows] - centre) ** 2).sum(axis=1))
        if len(rows) <= PAGE or depth > 24 or distance.max() - distance.min() == 0 and (self.points[rows] == self.points[rows[0]]).all():
            order = np.lexsort((self.ids[rows], distance))
            at = rows[order]
            self.pages.append((True, self.rows[at], self.ids[at], self.vectors[at].astype(np.float64), distance[order]))
            return len(self.pages) - 1
        # a few rounds of moving centres make parts of like size; farthest-first starts peel off single outliers
        points = self.points[rows]
        centres = points[np.random.default_rng(len(rows)).choice(len(rows), FANOUT, replace=False)]
        for _ in range(4):
            near = ((centres**2).sum(axis=1) - 2 * points @ centres.T).argmin(axis=1)
            for k in np.unique(near):
                centres[k] = points[near == k].mean(axis=0)
        children, routing, radius, to_parent = [], [], [], []
        for k in range(FANOUT):
            mine = rows[near == k]
            if not len(mine):
                continue
            # the middle of the page's vectors covers them with a smaller radius than one of them
            own = self.points[mine].mean(axis=0)
            children.append(self._load(mine, own, depth + 1))
            routing.append(own)
            radius.append(float(np.sqrt(((self.points[mine] - own) ** 2).sum(axis=1)).max()))
            to_parent.append(float(np.sqrt(((own - centre) ** 2).sum())))
        self.pages.append((False, np.array(children), np.array(routing), np.array(radius), np.array(to_parent)))
        return len(self.pages) - 1

    def search(self, own: int, query: np.ndarray, k: int, floor: int | None = None) -> tuple[list[tuple[int, int]], int]:
        """(the k best (score, id) of at least ``floor``, distances and products computed); ``own``: the row left out."""
        if not len(self.ids):
            return [], 0
        point = np.append(query.astype(np.float64), 0.0)
        far2 = float((point**2).sum()) + self.top2
        slack = SLACK * (far2 + 1)
        # doubles hold every sum of products exactly below 2**52
        exact = float((point**2).sum()) * self.top2 < 2.0**104
        exact_query = point[:-1]
        best: list[tuple[int, int]] = []  # a heap of (score, -id)
        computed = 1

        def limit() -> float:
            """Largest distance that can still matter."""
            least = best[0][0] if len(best) == k else floor
            least = least if floor is None or least is None else max(least, floor)
            return np.inf if least is None else np.sqrt(max(0.0, far2 - 2 * least) + slack)

        queue = [(0.0, self.root, float(np.sqrt(((point - self.centre) ** 2).sum())))]
        while queue:
            least, page, to_centre = heapq.heappop(queue)
            reach = limit()
            if least > reach * (1 + SLACK) + SLACK:
                break
            node = self.pages[page]
            if node[0]:
                _, rows, ids, vectors, distance = node
                near = np.abs(to_centre - distance) <= reach * (1 + SLACK) + SLACK
                if not near.all():
                    rows, ids, vectors = rows[near], ids[near], vectors[near]
                computed += len(ids)
                score = vectors @ exact_query if exact else (vectors.astype(np.int64) @ query)
                keep = rows != own
                bar = best[0][0] if len(best) == k else floor
                if bar is not None:
                    keep &= score >= (bar if floor is None else max(bar, floor))
                ids, score = ids[keep], score[keep]
                if len(score) > k:
                    order = np.lexsort((ids, -score))[:k]
                    ids, score = ids[order], score[order]
                for s, i in zip(score.astype(np.int64).tolist(), ids.tolist()):
                    if len(best) < k:
                        heapq.heappush(best, (s, -i))
                    elif (s, -i) > best[0]:
                        heapq.heapreplace(best, (s, -i))
                continue
            _, children, routing, radius, to_parent = node
            maybe = np.flatnonzero(np.abs(to_centre - to_parent) - radius <= reach * (1 + SLACK) + SLACK)
            computed += len(maybe)
            d = np.sqrt(((routing[maybe] - point) ** 2).sum(axis=1))
            low = np.maximum(0.0, d - radius[maybe])
            for c, lo, dd in zip(children[maybe].tolist(), low.tolist(), d.tolist()):
                if lo <= reach * (1 + SLACK) + SLACK:
                    heapq.heappush(queue, (lo, c, dd))
        return sorted(((s, -i) for s, i in best), key=lambda x: (-x[0], x[1])), computed


def _matrix(column, width: int) -> np.ndarray:
    """Rows of an integer list column, padded with zeros."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    n = np.array([len(x) for x in column], np.int64)
    out = np.zeros((len(n), width), np.int64)
    out[np.arange(width) < n[:, None]] = flat
    return out


def _lifted(vectors: np.ndarray, top2: float) -> np.ndarray:
    """Points of the metric space: one more component up to the common norm."""
    v = vectors.astype(np.float64)
    return np.concatenate([v, np.sqrt(np.maximum(top2 - (v**2).sum(axis=1), 0.0))[:, None]], axis=1)


def choose_pivots(points: np.ndarray, n: int, rounds: int = 4) -> np.ndarray:
    """At most ``n`` pivots: farthest-first starts, then a few rounds of moving each to the middle of its points."""
    if not len(points):
        return np.zeros((1, points.shape[1]))
    pick, apart = [0], ((points - points[0]) ** 2).sum(axis=1)
    while len(pick) < n and apart.max() > 0:
        pick.append(int(apart.argmax()))
        apart = np.minimum(apart, ((points - points[pick[-1]]) ** 2).sum(axis=1))
    pivots = points[pick]
    for _ in range(rounds):
        near = nearest(points, pivots)[0]
        for k in np.unique(near):
            pivots[k] = points[near == k].mean(axis=0)
    return pivots


def nearest(points: np.ndarray, pivots: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(the nearest pivot, the distance to it) of each point."""
    d2 = (points**2).sum(axis=1)[:, None] - 2 * points @ pivots.T + (pivots**2).sum(axis=1)
    at = d2.argmin(axis=1)
    return at, np.sqrt(((points - pivots[at]) ** 2).sum(axis=1))


def _deal(shared):
    def run(batches):
        pivots, top2, width = shared.value
        for b in batches:
            if b.num_rows:
                at, _ = nearest(_lifted(_matrix(b.column(2), width), top2), pivots)
                yield pa.record_batch([*b.columns, pa.array(at.astype(np.int32))], names=["row", "id", "v", "is_query", "pivot"])

    return run


def _load_tree(shared):
    def run(table: pa.Table) -> pa.Table:
        pivots, top2, width = shared.value
        order = np.lexsort((table.column("row").to_numpy(), table.column("id").to_numpy()))
        rows, ids = table.column("row").to_numpy()[order], table.column("id").to_numpy()[order]
        pivot = table.column("pivot")[0].as_py()
        tree = MTree(rows, ids, _matrix(table.column("v"), width)[order], top2, pivots[pivot])
        return pa.table({"pivot": pa.array([pivot], pa.int32()), "part": table.column("part").slice(0, 1), "radius": [tree.radius], "pages": pa.array([pickle.dumps(tree)], pa.binary())})

    return run


def _visits(shared, wave: int):
    """The pivots that a query's trees of this wave belong to, where those can hold what it still needs."""

    def run(batches):
        pivots, top2, width, radius = shared.value
        first, last = sum(WAVES[:wave]), sum(WAVES[: wave + 1]) if wave < len(WAVES) else len(pivots)
        for b in batches:
            if not b.num_rows:
                continue
            v = _matrix(b.column(2), width).astype(np.float64)
            points = np.concatenate([v, np.zeros((len(v), 1))], axis=1)
            d = np.sqrt(np.maximum((points**2).sum(axis=1)[:, None] - 2 * points @ pivots.T + (pivots**2).sum(axis=1), 0.0))
            order = np.argsort(d, axis=1, kind="stable")[:, first:last]
            floor = b.column(3).to_numpy(zero_copy_only=False).astype(np.float64)  # null: none yet
            far2 = (v**2).sum(axis=1) + top2
            reach = np.where(np.isnan(floor), np.inf, np.sqrt(np.maximum(far2 - 2 * np.nan_to_num(floor), 0.0) + SLACK * (far2 + 1)))
            # the expanded square loses some digits: a margin that covers them
            margin = 1e-6 * np.sqrt(far2 + 1)
            go = (np.take_along_axis(d, order, axis=1) - radius[order] <= (reach * (1 + SLACK) + SLACK + margin)[:, None]) & (radius[order] >= 0)
            q, at = np.nonzero(go)
            take = pa.array(q)
            yield pa.record_batch([*(b.column(c).take(take) for c in range(4)), pa.array(order[q, at].astype(np.int32))], names=["row", "id", "v", "floor", "pivot"])

    return run


FOUND = "row long, query_id long, vec_id long, score long, computed long"


def _search(k: int, width: int):
    """Queries of one block against one tree; a last row per query says what was computed."""

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        rows = []
        if right.num_rows:
            tree = pickle.loads(right.column("pages")[0].as_buffer())
            floors = left.column("floor").to_pylist()
            vectors = _matrix(left.column("v"), width)
            for i, (row, own) in enumerate(zip(left.column("row").to_pylist(), left.column("id").to_pylist())):
                found, computed = tree.search(row, vectors[i], k, floors[i])
                rows += [(row, own, v, s, None) for s, v in found]
                rows.append((row, own, None, None, computed))
        return pa.table({name: pa.array([r[j] for r in rows], pa.int64()) for j, name in enumerate(("row", "query_id", "vec_id", "score", "computed"))})

    return run


def top_k(vectors: DataFrame, is_query, k: int = 5, id_col: str = "vec_id", vector_col: str = "embedding", query_block: int = QUERY_BLOCK, tree_values: int = TREE_VALUES, max_pivots: int = MAX_PIVOTS) -> DataFrame:
    """(query_id, rank, vec_id, score, computed, candidates) for the rows where ``is_query`` holds.

    ``computed``: distances and products that the query's searches worked out in all trees
    they visited; ``candidates``: the vectors it was up against.
    """
    spark = vectors.sparkSession
    sound = F.forall(vector_col, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = vectors.where(F.col(id_col).isNotNull() & F.col(vector_col).isNotNull()).where(sound).select(
        F.monotonically_increasing_id().alias("row"), F.col(id_col).cast("long").alias("id"),
        F.transform(vector_col, lambda x: F.floor(256 * x.cast("double"))).alias("v"), F.coalesce(is_query, F.lit(False)).alias("is_query"),
    )
    rows = materialize(rows, "vectors")
    norm2 = F.aggregate("v", F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double"))
    n, width, top2 = rows.agg(F.count(F.lit(1)), F.coalesce(F.max(F.size("v")), F.lit(0)), F.coalesce(F.max(norm2), F.lit(0.0))).first()
    cap = max(1, tree_values // max(1, width))
    wanted = min(max_pivots, max(1, -(-n // cap)))
    some = rows.where(F.pmod(F.xxhash64("row"), F.lit(1 << 40)) < int((1 << 40) * min(1.0, SAMPLE / max(n, 1)))).select("v").limit(2 * SAMPLE).toArrow()
    pivots = choose_pivots(_lifted(_matrix(some.column(0), width), top2), wanted)
    space = spark.sparkContext.broadcast((pivots, top2, width))

    dealt = materialize(rows.mapInArrow(_deal(space), "row long, id long, v array<long>, is_query boolean, pivot int"), "dealt")
    sizes = dealt.groupBy("pivot").agg(F.ceil(F.count(F.lit(1)) / cap).cast("int").alias("parts"))
    parted = dealt.join(F.broadcast(sizes), "pivot").withColumn("part", F.pmod(F.xxhash64("row"), F.col("parts")).cast("int"))  # a row per pivot at most
    forest = parted.select("pivot", "part", "row", "id", "v").groupBy("pivot", "part").applyInArrow(_load_tree(space), "pivot int, part int, radius double, pages binary")
    forest = materialize(forest, "mtrees")
    radius = np.full(len(pivots), -1.0)
    for r in forest.groupBy("pivot").agg(F.max("radius").alias("radius")).collect():
        radius[r.pivot] = r.radius
    directory = spark.sparkContext.broadcast((pivots, top2, width, radius))

    queries = dealt.where("is_query").select("row", "id", "v")
    parts = forest.select("pivot", "part")
    best = Window.partitionBy("row").orderBy(F.desc("score"), "vec_id")
    found = None
    for wave in range(len(WAVES) + 1 if len(pivots) > sum(WAVES) else 2 if len(pivots) > 1 else 1):
        asked = queries.withColumn("floor", F.lit(None).cast("long"))
        if found is not None:
            kept = found.where("vec_id is not null").withColumn("rank", F.row_number().over(best)).where(F.col("rank") == k)
            asked = queries.join(kept.select("row", F.col("score").alias("floor")), "row", "left").select("row", "id", "v", "floor")
        visits = asked.mapInArrow(_visits(directory, wave), "row long, id long, v array<long>, floor long, pivot int").join(parts, "pivot")
        visits = materialize(visits, "visits")
        # a hot tree's queries come in blocks of bounded size
        load = materialize(visits.groupBy("pivot", "part").agg(F.ceil(F.count(F.lit(1)) / query_block).alias("blocks")), "load")
        visits = visits.join(load, ["pivot", "part"]).withColumn("block", F.pmod(F.xxhash64("row"), "blocks"))
        trees = forest.join(load, ["pivot", "part"]).withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
        keys = ("pivot", "part", "block")
        # the trees' keys under names of their own: both sides come from ``load``
        mine = [F.col(c).alias(f"t_{c}") for c in keys]
        sides = visits.select(*keys, "row", "id", "v", "floor").groupBy(*keys), trees.select(*mine, "pages").groupBy(*(f"t_{c}" for c in keys))
        hits = sides[0].cogroup(sides[1]).applyInArrow(_search(k, width), FOUND)
        hits = materialize(hits, "found")
        found = hits if found is None else found.union(hits)
    # enough for the next step: each query's k best, and what all its visits computed
    ranked = found.where("vec_id is not null").withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    work = found.groupBy("row").agg(F.sum("computed").alias("computed"))
    return ranked.drop("computed").join(work, "row").select("query_id", "rank", "vec_id", "score", "computed", F.lit(max(n - 1, 0)).cast("long").alias("candidates"))


QUERY_EVERY = 50


def op4_mtree_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five best partners of every fiftieth vector, among all vectors."""
    found = top_k(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), F.col("vec_id") % QUERY_EVERY == 0)
    return found.select("query_id", "rank", "vec_id", "score")


OP4_SQL = """
WITH v AS (
    SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS e
    FROM embeddings
    WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
    SELECT q.r, q.vec_id AS query_id, c.vec_id, list_sum(list_transform(list_zip(q.e, c.e), lambda p: p[1] * p[2]))::BIGINT AS score
    FROM v q JOIN v c ON c.r <> q.r
    WHERE q.vec_id % 50 = 0
), ranked AS (
    SELECT *, row_number() OVER (PARTITION BY r ORDER BY score DESC, vec_id)::INTEGER AS rank FROM s
)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 5
"""
