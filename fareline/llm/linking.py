"""Links between sets: tiles of rows held against each other, and exact links within components.

``tile_links`` finds candidate links inside tiles (rows that share something) without
listing all pairs: a row that is reached is only held against rows that aren't yet. A
large tile is cut into blocks that share a few pivots. What a block connects to the
first pivot is one cluster over all blocks; only rows outside it are held against the
other blocks. So near copies that make up a third of a table cost one comparison each,
and no candidate is lost.

``exact_components`` meets the sets of each candidate component as sorted arrays and
keeps the exact links. Components above a block's sets or bytes are taken in blocks with
pivots in the same way.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fareline.llm.common import materialize, sized
from fareline.llm.components import connected_components
from fareline.llm.shingles import set_arrays, sets_of_texts

SMALL_TILE = 12
PIVOTS = 4
HELD_ROWS, HELD_BYTES = 20_000, 64 << 20

# near(x, y): whether the rows x[k] and y[k] of a table may be linked
Near = Callable[[np.ndarray, np.ndarray], np.ndarray]


def whole_groups(batches, keys: list[str]) -> Iterator[pa.Table]:
    """Tables of whole groups from a partition sorted by ``keys``; a group of any size is one table's."""
    held: list[pa.RecordBatch] = []
    rows = size = 0
    for b in batches:
        held.append(b)
        rows, size = rows + b.num_rows, size + b.nbytes
        if rows < HELD_ROWS and size < HELD_BYTES:
            continue
        table = pa.Table.from_batches(held)
        same = np.logical_and.reduce([table.column(k).to_numpy() == table.column(k)[-1].as_py() for k in keys])
        cut = int(np.flatnonzero(~same)[-1]) + 1 if not same.all() else 0
        if cut:
            yield table.slice(0, cut)
            held = table.slice(cut).combine_chunks().to_batches()
        rows, size = sum(x.num_rows for x in held), sum(x.nbytes for x in held)
    if rows:
        yield pa.Table.from_batches(held)


def group_ids(table: pa.Table, keys: list[str]) -> np.ndarray:
    """A group number per row of a table sorted by ``keys``."""
    columns = [table.column(k).to_numpy() for k in keys]
    new = np.logical_or.reduce([c[1:] != c[:-1] for c in columns]) if table.num_rows else np.zeros(0, bool)
    return np.cumsum(np.append(0, new))[: table.num_rows]


def spanning(rows: np.ndarray, near: Near, first: np.ndarray | None = None) -> tuple[list, list, np.ndarray]:
    """(x, y, reached): edges that span the near pairs of ``rows``, breadth first from ``first``.

    ``reached`` marks the rows connected to the first start; ``first`` are positions in ``rows``.
    """
    x, y, rest = [], [], np.arange(len(rows))
    starts = list(first) if first is not None else []
    reached = np.zeros(len(rows), bool)
    main = True
    while len(rest):
        start = starts.pop(0) if starts else rest[0]
        if start not in rest:
            continue
        queue, rest = [start], rest[rest != start]
        reached[start] |= main
        while queue and len(rest):
            i = queue.pop()
            ok = near(np.full(len(rest), rows[i]), rows[rest])
            found = rest[ok]
            if len(found):
                x += [rows[i]] * len(found)
                y += rows[found].tolist()
                queue += found.tolist()
                reached[found] |= main
                rest = rest[~ok]
        main = False
    return x, y, reached


def small_pairs(group: np.ndarray, on: np.ndarray, near: Near) -> tuple[np.ndarray, np.ndarray]:
    """All near pairs within groups of at most SMALL_TILE rows, those with ``on``."""
    xs, ys = [], []
    for lag in range(1, SMALL_TILE):
        at = np.flatnonzero(on[:-lag] & (group[:-lag] == group[lag:]))
        if not len(at):
            break
        for a in range(0, len(at), 1 << 16):
            x = at[a : a + (1 << 16)]
            ok = near(x, x + lag)
            xs.append(x[ok])
            ys.append(x[ok] + lag)
    return np.concatenate([*xs, np.zeros(0, np.int64)]), np.concatenate([*ys, np.zeros(0, np.int64)])


TILE_KEYS = ["tile", "block"]
TILE_OUT = "a long, b long, tile long"


def _out(sid, x, y, tile=None, left=None):
    pairs = np.stack([sid[np.asarray(x, np.int64)], sid[np.asarray(y, np.int64)]])
    pairs = np.unique(np.stack([pairs.min(axis=0), pairs.max(axis=0)]), axis=1)
    k = 0 if left is None else len(left)
    return pa.record_batch(
        [
            pa.array(np.concatenate([pairs[0], sid[left]] if k else [pairs[0]])),
            pa.array([*pairs[1].tolist(), *[None] * k], pa.int64()),
            pa.array([None] * pairs.shape[1] + (tile[left].tolist() if k else []), pa.int64()),
        ],
        names=["a", "b", "tile"],
    )


def _without_repeats(table: pa.Table, keys: list[str], active: str) -> pa.Table:
    """One row per group and sid (the active one, where there are two), sorted by group."""
    group = group_ids(table, keys)
    sid, on = table.column("sid").to_numpy(), table.column(active).to_numpy(zero_copy_only=False)
    order = np.lexsort((~on, sid, group))
    same = np.append(False, (group[order][1:] == group[order][:-1]) & (sid[order][1:] == sid[order][:-1]))
    return table.take(pa.array(order[~same]))


def _first_pass(prepare):
    def run(batches):
        for table in whole_groups(batches, TILE_KEYS):
            table = _without_repeats(table, TILE_KEYS, "pivot")
            near = prepare(table)
            group, sid, tile = group_ids(table, TILE_KEYS), table.column("sid").to_numpy(), table.column("tile").to_numpy()
            pivot, cut = table.column("pivot").to_numpy(zero_copy_only=False), table.column("blocks").to_numpy() > 1
            starts = np.flatnonzero(np.append(True, group[1:] != group[:-1]))
            count = np.diff(np.append(starts, len(group)))
            large = (count > SMALL_TILE) | cut[starts]
            x, y = small_pairs(group, ~large[group], near)
            xs, ys, left = [x.tolist()], [y.tolist()], []
            for k in np.flatnonzero(large):
                rows = np.arange(starts[k], starts[k] + count[k])
                a, b, reached = spanning(rows, near, np.flatnonzero(pivot[rows]))
                xs.append(a)
                ys.append(b)
                if cut[starts[k]]:
                    left += rows[~reached].tolist()
            yield _out(sid, sum(xs, []), sum(ys, []), tile, np.array(left, np.int64))

    return run


def _second_pass(prepare):
    """Rows outside the main cluster (active) against all rows of a block."""
    keys = [*TILE_KEYS, "chunk"]

    def run(batches):
        for table in whole_groups(batches, keys):
            table = _without_repeats(table, keys, "active")
            near = prepare(table)
            group, sid, active = group_ids(table, keys), table.column("sid").to_numpy(), table.column("active").to_numpy(zero_copy_only=False)
            starts = np.append(np.flatnonzero(np.append(True, group[1:] != group[:-1])), len(group))
            xs, ys = [], []
            for lo, hi in zip(starts[:-1], starts[1:]):
                label = np.arange(lo, hi)
                for i in np.flatnonzero(active[lo:hi]) + lo:
                    rest = np.flatnonzero(label != label[i - lo]) + lo
                    found = rest[near(np.full(len(rest), i), rest)]
                    for k in np.unique(label[found - lo], return_index=True)[1]:
                        xs.append(int(i))
                        ys.append(int(found[k]))
                    if len(found):
                        label[np.isin(label, label[found - lo])] = label[i - lo]
            if xs:
                yield _out(sid, xs, ys)

    return run


def tile_links(members: DataFrame, payload: list[str], prepare: Callable[[pa.Table], Near], block_rows: int, pivots: int = PIVOTS) -> DataFrame:
    """Written (a, b) edges that span the near pairs of each tile.

    ``members``: (tile, n_rows, sid, lead, payload...); ``n_rows`` is the tile's size,
    ``lead`` marks rows that may be pivots. ``prepare`` gives the near-test of a table.
    """
    columns = ["tile", "block", "blocks", "sid", *payload]
    n, largest = members.agg(F.count(F.lit(1)), F.coalesce(F.max("n_rows"), F.lit(0))).first()
    rows = members.withColumn("blocks", F.ceil(F.col("n_rows") / block_rows).cast("int")).withColumn("block", F.pmod(F.xxhash64("sid"), F.col("blocks")).cast("int"))
    cut = rows.where("blocks > 1")
    first = rows.select(*columns, F.lit(False).alias("pivot"))
    every = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    if largest > block_rows:
        mark = F.pmod(F.xxhash64("sid", F.lit(7)), F.lit(64) * F.col("blocks")) == 0
        chosen = cut.where("lead").groupBy("tile").agg(F.array_union(F.array(F.min("sid")), F.slice(F.array_sort(F.collect_set(F.when(mark, F.col("sid")))), 1, pivots)).alias("p"))
        chosen = materialize(sized(chosen.select("tile", F.explode("p").alias("sid")), n), "pivots")
        shared = cut.join(chosen, ["tile", "sid"]).withColumn("block", every)
        first = first.unionByName(shared.select(*columns, F.lit(True).alias("pivot")))
    dealt = sized(first.repartition(*TILE_KEYS), n).sortWithinPartitions(*TILE_KEYS)
    found = materialize(dealt.mapInArrow(_first_pass(prepare), TILE_OUT), "tile-links")
    edges = found.where("b is not null").select("a", "b")
    if largest <= block_rows:
        return edges
    left = found.where("b is null").select("tile", F.col("a").alias("sid")).distinct()
    chunks = left.groupBy("tile").agg(F.count(F.lit(1)).alias("n_left"))
    chunks = materialize(sized(chunks, n).select("tile", "n_left", F.ceil(F.col("n_left") / block_rows).cast("int").alias("chunks")), "chunks")
    n_left = chunks.agg(F.sum("n_left")).first()[0]
    if not n_left:
        return edges
    cut = cut.join(chunks.select("tile", "chunks"), "tile")
    columns += ["chunk"]
    outside = cut.join(left, ["tile", "sid"]).withColumn("block", every).withColumn("chunk", F.pmod(F.xxhash64("sid", F.lit(1)), F.col("chunks")).cast("int"))
    inside = cut.withColumn("chunk", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
    second = outside.select(*columns, F.lit(True).alias("active")).unionByName(inside.select(*columns, F.lit(False).alias("active")))
    blocks = -(-largest // block_rows)
    dealt = sized(second.repartition(*TILE_KEYS, "chunk"), n + n_left * blocks).sortWithinPartitions(*TILE_KEYS, "chunk")
    more = materialize(dealt.mapInArrow(_second_pass(prepare), TILE_OUT), "tile-links").select("a", "b")
    return edges.union(more)


def exact_links(arrays: list[np.ndarray], label: np.ndarray, active: np.ndarray, t: int) -> list[tuple[int, int]]:
    """Links that connect sets of different labels, each tested by exact intersection.

    ``active`` marks the sets whose pairs with all others are due; a pair that labels
    or earlier links connect already isn't tested.
    """
    n = np.array([len(a) for a in arrays], np.int64)
    ends = np.cumsum(n)
    _, dense = np.unique(np.concatenate(arrays), return_inverse=True)
    mark = np.zeros(int(dense.max()) + 1, bool)
    label, links = label.copy(), []
    done = np.zeros(len(arrays), bool)
    for i in np.flatnonzero(active):
        done[i] = True
        other = np.flatnonzero((label != label[i]) & ~(done & active) & (100 * np.minimum(n, n[i]) >= t * np.maximum(n, n[i])))
        if not len(other):
            continue
        mine = dense[ends[i] - n[i] : ends[i]]
        mark[mine] = True
        size = n[other]
        stop = np.cumsum(size)
        at = np.arange(stop[-1]) + np.repeat(ends[other] - size - (stop - size), size)
        common = np.add.reduceat(mark[dense[at]].astype(np.int64), stop - size)
        mark[mine] = False
        for j in other[100 * common >= t * (size + n[i] - common)]:
            if label[j] != label[i]:
                links.append((i, j))
                label[label == label[j]] = label[i]
    return links


def pair_links(a: np.ndarray, b: np.ndarray, t: int) -> bool:
    """Whether two sorted sets of distinct values reach the threshold."""
    if 100 * min(len(a), len(b)) < t * max(len(a), len(b)):
        return False
    at = np.searchsorted(a, b)
    common = int((a[np.minimum(at, len(a) - 1)] == b).sum())
    return 100 * common >= t * (len(a) + len(b) - common)


def _clusters(t: int, size: int):
    """(node, component) of the sets of whole components, one after the other, from their texts."""

    def run(batches):
        for table in whole_groups(batches, ["component"]):
            group, wanted = group_ids(table, ["component"]), table.column("sid").to_numpy()
            starts = np.append(np.flatnonzero(np.append(True, group[1:] != group[:-1])), len(group))
            found = list(sets_of_texts(table.column("text").combine_chunks(), wanted, size))
            nodes, labels = [], []
            for lo, hi in zip(starts[:-1], starts[1:]):
                # a key may stand for several texts, and a set for several rows: each set once
                one = {int(wanted[k]): found[k] for k in range(lo, hi) if found[k] is not None}
                mine = np.array(sorted(one), np.int64)
                arrays = [one[k] for k in mine.tolist()]
                label = mine.copy()
                if len(mine) == 2:
                    if pair_links(*arrays, t):
                        label[1] = label[0]
                elif len(mine) > 2:
                    for i, j in exact_links(arrays, mine, np.ones(len(mine), bool), t):
                        low, high = sorted((label[i], label[j]))
                        label[label == high] = low
                nodes.append(mine)
                labels.append(label)
            yield pa.record_batch([pa.array(np.concatenate(nodes)), pa.array(np.concatenate(labels))], names=["node", "component"])

    return run


BLOCK_KEYS = ["component", "part", "chunk"]


def _block_links(t: int):
    """Exact links within groups of (sid, shingles, label, active) rows, of a partition sorted by group."""

    def solve(table: pa.Table) -> list[np.ndarray]:
        sid, on = table.column("sid").to_numpy(), table.column("active").to_numpy(zero_copy_only=False)
        order = np.lexsort((~on, sid))
        at = order[np.append(True, sid[order][1:] != sid[order][:-1])]
        arrays = [np.frombuffer(x, np.uint64) for x in table.column("shingles").take(pa.array(at)).to_pylist()]
        i, j = np.array(exact_links(arrays, table.column("label").to_numpy()[at], on[at], t), np.int64).reshape(-1, 2).T
        return [sid[at][i], sid[at][j]]

    def run(batches):
        for table in whole_groups(batches, BLOCK_KEYS):
            group = group_ids(table, BLOCK_KEYS)
            starts = np.append(np.flatnonzero(np.append(True, group[1:] != group[:-1])), len(group))
            for lo, hi in zip(starts[:-1], starts[1:]):
                a, b = solve(table.slice(lo, hi - lo))
                if len(a):
                    yield pa.record_batch([pa.array(a), pa.array(b)], names=["a", "b"])

    return run


# rows with whole sets or texts in one task
SETS_PER_TASK = 20_000


def _large_components(members: DataFrame, t: int, block_sets: int, pivots: int) -> DataFrame:
    """(node, component) of the written members (component, parts, sid, shingles) of components above a block."""
    zero = F.lit(0).cast("long")
    every = F.explode(F.sequence(zero, F.col("parts") - 1))
    home = members.withColumn("part", F.pmod(F.xxhash64("sid"), "parts"))
    n, most = members.agg(F.count(F.lit(1)), F.max("parts")).first()
    mark = F.pmod(F.xxhash64("sid", F.lit(7)), F.lit(64) * F.col("parts")) == 0
    chosen = members.groupBy("component").agg(F.array_union(F.array(F.min("sid")), F.slice(F.array_sort(F.collect_set(F.when(mark, F.col("sid")))), 1, pivots)).alias("p"))
    chosen = materialize(sized(chosen.select("component", F.explode("p").alias("sid")), n), "pivots")
    columns = [*BLOCK_KEYS, "sid", "shingles", "label", "active"]

    def links(rows, n_rows):
        dealt = sized(rows.select(*columns).repartition(*BLOCK_KEYS), n_rows, SETS_PER_TASK).sortWithinPartitions(*BLOCK_KEYS)
        return materialize(dealt.mapInArrow(_block_links(t), "a long, b long"), "links")

    shared = members.join(chosen, ["component", "sid"]).withColumn("part", every)
    first = links(home.unionByName(shared, allowMissingColumns=True).withColumns({"chunk": zero, "label": F.col("sid"), "active": F.lit(True)}), n)
    # sets outside their component's largest cluster, against all blocks
    labels = connected_components(first).select(F.col("node").alias("sid"), F.col("component").alias("label"))
    named = materialize(sized(home.join(labels, "sid", "left").withColumn("label", F.coalesce("label", "sid")), n, SETS_PER_TASK), "named")
    main = named.groupBy("component", "label").agg(F.count(F.lit(1)).alias("c")).groupBy("component").agg(F.max_by("label", F.struct("c", "label")).alias("main"))
    outside = named.join(materialize(sized(main, n), "main"), "component").where("label <> main")
    chunks = outside.groupBy("component").agg(F.count(F.lit(1)).alias("n_out"))
    chunks = materialize(sized(chunks, n).select("component", "n_out", F.ceil(F.col("n_out") / block_sets).cast("long").alias("chunks")), "chunks")
    n_out = chunks.agg(F.sum("n_out")).first()[0]
    if not n_out:
        return named.select(F.col("sid").alias("node"), F.col("label").alias("component"))
    chunks = chunks.select("component", "chunks")
    outside = outside.join(chunks, "component").withColumns({"chunk": F.pmod(F.xxhash64("sid", F.lit(1)), "chunks"), "active": F.lit(True)}).withColumn("part", every)
    inside = named.join(chunks, "component").withColumns({"chunk": F.explode(F.sequence(zero, F.col("chunks") - 1)), "active": F.lit(False)})
    more = links(outside.select(*columns).unionByName(inside.select(*columns)), n + n_out * most)
    joined = connected_components(first.union(more)).select(F.col("node").alias("sid"), F.col("component").alias("label"))
    return named.drop("label").join(joined, "sid", "left").select(F.col("sid").alias("node"), F.coalesce("label", "sid").alias("component"))


def exact_components(candidates: DataFrame, sets: DataFrame, texts: DataFrame, size: int, t: int, block_sets: int, block_bytes: int, n_texts: int, pivots: int = PIVOTS) -> DataFrame:
    """(node, component) of the exact links within the components of the candidate pairs.

    ``sets``: (sid, key, n), one row per set; ``texts``: (text, key), where a set's text
    can be had, ``n_texts`` of them; ``size``: words of a shingle. Texts travel, as they are
    smaller than arrays.
    """
    n = candidates.count()  # edges of a forest per task: about as many as nodes
    placed = materialize(sized(connected_components(candidates).withColumnRenamed("node", "sid").join(sets, "sid"), n), "coarse")
    parts = F.greatest(F.ceil(F.count(F.lit(1)) / block_sets), F.ceil(8 * F.sum("n") / block_bytes)).cast("long")
    large = materialize(sized(placed.groupBy("component").agg(parts.alias("parts")).where("parts > 1"), n), "large")
    some = not large.isEmpty()
    placed = placed.join(large, "component", "left").withColumn("parts", F.coalesce("parts", F.lit(1).cast("long"))) if some else placed.withColumn("parts", F.lit(1).cast("long"))
    chosen = texts.join(placed.select("key", "sid", "component", "parts").hint("shuffle_hash"), "key").select("text", "sid", "component", "parts")
    chosen = materialize(sized(chosen, n_texts, SETS_PER_TASK), "chosen") if some else chosen
    small = sized(chosen.where("parts = 1").repartition("component"), n, SETS_PER_TASK).sortWithinPartitions("component").select("component", "sid", "text")
    out = small.mapInArrow(_clusters(t, size), "node long, component long")
    if some:
        met = chosen.where("parts > 1").mapInArrow(set_arrays(size), "sid long, component long, parts long, shingles binary")
        # a set may come from two texts with its key; one row of each goes on
        members = sized(met.groupBy("component", "parts", "sid").agg(F.min("shingles").alias("shingles")), n, SETS_PER_TASK)
        out = out.union(_large_components(materialize(members, "members"), t, block_sets, pivots))
    return out
