"""Connected components of an edge table by local contraction and pointer jumping.

Edges are dealt by their larger node. Each task contracts what it sees to stars (every
node points at the smallest node of its local component); a table of parents, one per
node, then jumps to the parents' parents, and what a task merged beyond its own nodes
goes into the next round. A round is one written table with one shuffle by node and one
join on parents; the join reads written tables, so a star's hot centre can be split.
Nothing is gathered on the driver but one flag a round. Nodes and labels are 64-bit
integers; a node's label is the smallest node of its component.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fareline.llm.common import materialize, sized

# edges that a task contracts at once; a forest above half of it is handed on
HELD_EDGES = 1 << 20


def roots(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(nodes, smallest node of each one's component) of an edge list."""
    nodes, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    x, y = at[: len(a)], at[len(a) :]
    label = np.arange(len(nodes))
    while len(x):
        low = np.minimum(label[x], label[y])
        # both ends' roots take the smaller label, then every node its root's
        np.minimum.at(label, label[x], low)
        np.minimum.at(label, label[y], low)
        while (label != label[label]).any():
            label = label[label]
        on = label[x] != label[y]
        x, y = x[on], y[on]
    return nodes, nodes[label]


def _contract(own: bool):
    """Edges (a, b) as stars (a, b, kind): "p" for the parents of nodes seen as ``a``, "x" for other nodes.

    With ``own``, the task holds all edges of its ``a``, and each gets one parent.
    """

    def stars(held):
        a, b = (np.concatenate([h[k] for h in held]) for k in (0, 1))
        nodes, root = roots(a, b)
        on = nodes != root
        return nodes[on], root[on], np.isin(nodes[on], a)

    def run(batches):
        held, count = [], 0
        for r in batches:
            held.append((r.column(0).to_numpy(), r.column(1).to_numpy()))
            count += r.num_rows
            if count > HELD_EDGES and not own:
                a, b, _ = stars(held)
                held, count = [(a, b)], len(a)
                if 2 * count > HELD_EDGES:
                    yield pa.record_batch([pa.array(a), pa.array(b), pa.array(["p"] * len(a))], names=["a", "b", "kind"])
                    held, count = [], 0
        if count:
            a, b, mine = stars(held)
            yield pa.record_batch([pa.array(a), pa.array(b), pa.array(np.where(mine, "p", "x"))], names=["a", "b", "kind"])

    return run


STARS = "a long, b long, kind string"


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of ``edges`` (a, b); self-loops and repeats don't matter."""
    n = edges.count()
    # first each task by itself, so that copies and hot stars go no further
    e = edges.select("a", "b").where("a <> b").mapInArrow(_contract(False), STARS).select("a", "b")
    while True:
        # a node's edges all come to its task; the larger end is the node
        now = materialize(sized(e.repartition("a"), n).mapInArrow(_contract(True), STARS), "stars")
        parents, rest = now.where("kind = 'p'").select("a", "b"), now.where("kind = 'x'").select("a", "b")
        tops = parents.select(F.col("a").alias("b"), F.col("b").alias("top"))
        if rest.isEmpty() and parents.join(tops, "b", "left_semi").isEmpty():
            break
        e = parents.join(tops, "b", "left").select("a", F.coalesce("top", "b").alias("b")).union(rest)
    nodes = parents.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return nodes.union(parents.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())
