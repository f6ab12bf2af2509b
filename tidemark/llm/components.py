"""Connected components of an edge table, by contraction in rounds of one shuffle each."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.groups import forest_labels
from tidemark.llm.skew import attach
from tidemark.llm.workspace import drop_table, materialize

#: Edges a task looks at together.
EDGES = 500_000
#: Tables of at most so many nodes are joined by broadcast, larger ones by shuffles.
LISTED = 100_000
#: Rounds that keep one order of the nodes.
ORDERED = 4
_ROWS = "node bigint, root bigint, settled int"
Edges = Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]


def _order(nodes: np.ndarray, seed: int) -> np.ndarray:
    """Places that sort the nodes at random, the same for a node wherever it is met in a round."""
    x = nodes.astype(np.uint64) + np.uint64(0x9E3779B97F4A7C15 * (seed + 1) % 2**64)
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x = (x ^ (x >> np.uint64(shift))) * np.uint64(factor)
    return np.argsort(x ^ (x >> np.uint64(31)), kind="stable")


def _rows(nodes: np.ndarray, roots: np.ndarray, settled: int) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(nodes), pa.array(roots), pa.array(np.full(len(nodes), settled, dtype=np.int32))], ["node", "root", "settled"])


def _stars(held: list[tuple[np.ndarray, np.ndarray]], seed: int) -> pa.RecordBatch:
    """Every node of the edges with the root that all nodes of its piece share."""
    u, v = (np.concatenate(side) for side in zip(*held))
    nodes, place = np.unique(np.concatenate([u, v]), return_inverse=True)
    order = _order(nodes, seed)
    rank = np.empty(len(nodes), dtype=np.int64)
    rank[order] = np.arange(len(nodes))
    labels = forest_labels(len(nodes), rank[place[: len(u)]], rank[place[len(u) :]])
    return _rows(nodes, nodes[order[labels[rank]]], 0)


def _begin(batches: Iterator[pa.RecordBatch], edges: Edges | None = None) -> Iterator[pa.RecordBatch]:
    """The stars of a task's edges (u, v), which ``edges`` makes of its rows where they are no edges yet."""
    held, count = [], 0
    for batch in batches if edges is None else edges(batches):
        u, v = batch.column(0).to_numpy(), batch.column(1).to_numpy()
        apart = u != v
        held.append((u[apart], v[apart]))
        count += int(apart.sum())
        if count >= EDGES:
            yield _stars(held, 0)
            held, count = [], 0
    if count:
        yield _stars(held, 0)


def _contract(batches: Iterator[pa.RecordBatch], seed: int) -> Iterator[pa.RecordBatch]:
    """One root of every node, settled, and the stars of the edges between a node's roots. Rows come sorted by node."""
    held, count, last = [], 0, None
    for batch in batches:
        if not batch.num_rows:
            continue
        nodes, roots = batch.column(0).to_numpy(), batch.column(1).to_numpy()
        new = np.concatenate([[last is None or nodes[0] != last[0]], nodes[1:] != nodes[:-1]])
        starts = np.flatnonzero(new)
        yield _rows(nodes[starts], roots[starts], 1)
        # Rows before the first start belong to the node at the end of the batch before.
        heads = np.concatenate([[0 if last is None else last[1]], roots[starts]])[np.cumsum(new)]
        last = nodes[-1], heads[-1]
        more = heads != roots
        held.append((roots[more], heads[more]))
        count += int(more.sum())
        if count >= EDGES:
            yield _stars(held, seed)
            held, count = [], 0
    if count:
        yield _stars(held, seed)


def _renamed(pointers: DataFrame, names: DataFrame, listed: int, count: int) -> DataFrame:
    """The ``count`` rows (node, root) with the columns ``names`` has for those roots that are among its ``listed`` ones."""
    if listed <= LISTED:
        return pointers.join(F.broadcast(names), "root", "left")
    roots = pointers.groupBy("root").agg(F.count(F.lit(1)).alias("pointers")).join(names, "root", "left")
    return attach(pointers, roots, ["root"], "pointers", count).drop("pointers")


def connected_components(rows: DataFrame, label: str, edges: Edges | None = None) -> DataFrame:
    """(node, component, size) of every node on an edge (u, v); the component is its least node, size its number of nodes.

    The rows are the edges, or ``edges`` makes edges without nulls of a partition's rows. It
    runs in the Python worker that merges them: a step of its own in the same stage would
    take a second worker for every core, which Spark then keeps for all later stages.

    A task merges the edges it holds and names one root for every node. The rows of a node
    then meet, one from each task at most: the node keeps one of its roots, and edges
    between its roots are what the next round begins with, until no node has two. Roots
    are the first nodes in a random order: a clique ends in two rounds by one order, and
    as others are drawn after some rounds, the nodes left shrink by a share whatever their
    numbers. Every round is one shuffle, written to the shared folder. The roots are
    followed back from the last round to the first.
    """
    if edges is None:
        rows = rows.filter("u <> v").select("u", "v")
    rounds, counts = [materialize(rows.mapInArrow(lambda b: _begin(b, edges), _ROWS), f"{label}-edges")], []
    while True:
        met = rounds[-1].filter("settled = 0").repartition("node").sortWithinPartitions("node")
        rounds.append(materialize(met.mapInArrow(lambda b, seed=len(rounds) // ORDERED: _contract(b, seed), _ROWS), f"{label}-round"))
        found = rounds[-1].agg(F.sum("settled"), F.count(F.lit(1))).first()
        counts.append(found[0] or 0)
        if found[1] == counts[-1]:
            break
    pointers = [table.filter("settled = 1").select("node", "root") for table in rounds[1:]]
    final = pointers[-1]
    for at in range(len(pointers) - 2, -1, -1):
        ends = final.select(F.col("node").alias("root"), F.col("root").alias("end"))
        final = _renamed(pointers[at], ends, counts[at + 1], counts[at]).select("node", F.coalesce("end", "root").alias("root"))
        if at and counts[at] > LISTED:
            rounds.append(final := materialize(final, f"{label}-ends"))
    final = materialize(final, f"{label}-roots")
    for table in rounds:
        drop_table(table)
    classes = materialize(final.groupBy("root").agg(F.min("node").alias("component"), F.count(F.lit(1)).alias("size")), f"{label}-least")
    return _renamed(final, classes, classes.count(), counts[0]).select("node", "component", "size")
