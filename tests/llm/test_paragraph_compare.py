"""Comparing paragraphs that share a bucket, on sets of invented n-grams."""

import random

import numpy as np
import pyarrow as pa

from tidemark.llm import paragraph_dedup

KINDS = [("bucket", pa.int64()), ("left", pa.int32()), ("right", pa.int32()), ("own", pa.int32()), ("unit", pa.int64()), ("grams", pa.binary())]


def links(sets, rows=10000):
    """Links of sets given as (bucket, left, right, own, unit, grams), fed in batches of ``rows``."""
    packed = [(*row[:-1], np.array(row[-1], dtype=np.int64).tobytes()) for row in sets]
    columns = [pa.array([row[i] for row in packed], kind) for i, (_, kind) in enumerate(KINDS)]
    table = pa.table(columns, names=[name for name, _ in KINDS])
    found = paragraph_dedup._compare(iter(table.to_batches(max_chunksize=rows)), paragraph_dedup.ParagraphSettings())
    return [pair for batch in found for pair in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())]


def components(pairs):
    least = {}

    def root(node):
        while least.get(node, node) != node:
            node = least[node]
        return node

    for u, v in pairs:
        a, b = sorted((root(u), root(v)))
        least[b] = a
    return {node: root(node) for node in list(least) if root(node) != node}


def test_pairs_that_links_join_are_not_compared_again(monkeypatch):
    calls = []
    plain = np.intersect1d
    monkeypatch.setattr(np, "intersect1d", lambda *a, **k: calls.append(1) or plain(*a, **k))
    grams = list(range(100))
    found = links([(1, 0, 0, 0, unit, grams) for unit in range(100)])
    assert components(found) == {unit: 0 for unit in range(1, 100)}
    assert len(calls) == 99


def test_components_are_those_of_all_pairs():
    rnd = random.Random(5)
    rows, pairs = [], []
    for bucket in range(60):
        base = sorted(rnd.sample(range(10**9), 40))
        # Blocks 0 and 1 of a bucket, met with each other: only pairs across are compared.
        across = bucket % 3 == 0
        sets = []
        for _ in range(rnd.randint(1, 12)):
            base = sorted({*rnd.sample(base, len(base) - rnd.choice([0, 2, 6])), *rnd.sample(range(10**9), rnd.choice([0, 2, 6]))})
            sets.append((bucket, 0, int(across), rnd.randint(0, 1) if across else 0, len(rows) + len(sets), base))
        for i, a in enumerate(sets):
            for b in sets[:i]:
                shared = len({*a[5]} & {*b[5]})
                if (not across or a[3] != b[3]) and shared >= 0.8 * (len(a[5]) + len(b[5]) - shared):
                    pairs.append((a[4], b[4]))
        rows += sets
    want = components(pairs)
    assert want and all(components(links(rows, size)) == want for size in (7, 10000))


def test_equal_words_around(spark):
    rnd = random.Random(6)
    rows = []
    for _ in range(400):
        a = [rnd.randint(0, 9) for _ in range(rnd.choice([0, 1, 5, 16, 30, 31]))]
        b = a[: rnd.randint(0, len(a))] + [rnd.randint(0, 9) for _ in range(rnd.randint(0, 31))]
        b = b[:31]
        want = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))
        rows.append((np.array(a, dtype=np.int32).tobytes(), np.array(b, dtype=np.int32).tobytes(), want))
    frame = spark.createDataFrame(rows, "a binary, b binary, want int")
    assert paragraph_dedup._with_equal(frame, "got", "a", "b", 31).filter("got <> want or got is null").collect() == []
