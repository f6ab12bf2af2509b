"""Connected components by contraction: against union-find, in few stages, in small pieces."""

import random

import pyarrow as pa
import pytest

from tidemark.llm import components


def least(edges):
    root = {}

    def find(n):
        root.setdefault(n, n)
        while root[n] != n:
            n = root[n]
        return n

    for u, v in edges:
        low, high = sorted((find(u), find(v)))
        root[high] = low
    return {n: find(n) for n in root}


def graph(seed):
    """A path in the order of its numbers, a clique, a star whose centre is its largest node, a sparse rest."""
    rnd = random.Random(seed)
    edges = [(n, n + 1) for n in range(1000, 1150)] + [(u, v) for u in range(2000, 2025) for v in range(2000, u)]
    edges += [(4000, n) for n in range(3000, 3200)] + [(u, v) for u, v in ((rnd.randrange(900), rnd.randrange(900)) for _ in range(500)) if u != v]
    rnd.shuffle(edges)
    return [(v, u) if rnd.random() < 0.5 else (u, v) for u, v in edges]


@pytest.mark.parametrize("listed", [components.LISTED, 0, 40])
def test_equal_union_find_with_and_without_broadcasts(spark, monkeypatch, listed):
    monkeypatch.setattr(components, "LISTED", listed)
    edges = graph(listed)
    frame = spark.createDataFrame(edges, "u bigint, v bigint").repartition(7)
    got = components.connected_components(frame, "test").collect()
    want = least(edges)
    sizes = list(want.values())
    assert len(got) == len(want)
    assert {r.node: (r.component, r.size) for r in got} == {n: (c, sizes.count(c)) for n, c in want.items()}


def test_a_round_is_one_shuffle(spark):
    edges = graph(5)
    frame = spark.createDataFrame(edges, "u bigint, v bigint").repartition(7)
    context = spark.sparkContext
    context.setJobGroup("components", "")
    try:
        components.connected_components(frame, "test").collect()
    finally:
        context.setLocalProperty("spark.jobGroup.id", None)
    tracker = context.statusTracker()
    stages = {s for j in tracker.getJobIdsForGroup("components") for s in tracker.getJobInfo(j).stageIds}
    assert sum(tracker.getStageInfo(s).numCompletedTasks > 0 for s in stages) < 60


def test_contraction_in_small_pieces(monkeypatch):
    monkeypatch.setattr(components, "EDGES", 5)
    edges = graph(2)

    def batches(rows, size):
        rows = list(rows)
        return [pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows[at : at + size]], pa.int64()) for i in range(2)], ["node", "root"]) for at in range(0, len(rows), size)]

    def rows(made):
        return [tuple(r.values()) for batch in made for r in batch.to_pylist()]

    stars = [r[:2] for r in rows(components._begin(batches(edges, 3)))]
    label: dict[int, int] = {}
    before = []
    for seed in range(40):
        made = rows(components._contract(batches(sorted(stars), 4), seed))
        settled = {n: r for n, r, done in made if done}
        assert len(settled) == sum(done for *_, done in made) == len({n for n, _ in stars})
        before.append(settled)
        stars = [(n, r) for n, r, done in made if not done]
        if not stars:
            break
    assert not stars
    for n in before[0]:
        at = n
        for settled in before:
            at = settled.get(at, at)
        label[n] = at
    want = least(edges)
    assert label.keys() == want.keys()
    assert len({(label[n], want[n]) for n in want}) == len(set(label.values())) == len(set(want.values()))
