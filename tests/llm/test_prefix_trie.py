import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from tidemark.llm.prefix_trie import TrieSettings, prefix_trie
from tidemark.llm.scans import in_order, running

SCHEMA = "conv_id bigint, turn bigint, role string, text string, conv string, depth string, hi string, pos string, first string"


@pytest.fixture(autouse=True)
def many_partitions(spark):
    """Small tables too are dealt over all partitions."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def brute(rows):
    convs = {}
    for c, t, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            said = f"{len(role.encode())}:{role}{text}"
            convs.setdefault(c, []).append(((t is not None, t or 0), hashlib.sha256(said.encode()).hexdigest(), (role, text)))
    convs = {c: [x[2] for x in sorted(v)] for c, v in convs.items()}
    rebuilt = {}
    for c, own in convs.items():
        h = zlib.crc32(str(c).encode()) % 9
        base = c - (c % 5 if c >= 0 else -(-c % 5))
        rebuilt[c] = tuple(convs.get(base, [])[:h] + own[h:])
    members = {}
    for c, turns in rebuilt.items():
        for d in range(len(turns) + 1):
            members.setdefault(turns[:d], []).append(c)
    children = {}
    for node in members:
        if node:
            children.setdefault(node[:-1], []).append(node)
    out = []
    for node, convs_ in members.items():
        stack, leaves, saved = [node], 0, 0
        while stack:
            x = stack.pop()
            leaves += x not in children
            saved += (len(members[x]) - 1) * len(x[-1][1].encode()) if x else 0
            stack += children.get(x, [])
        ends = ",".join(map(str, sorted(c for c in convs_ if len(rebuilt[c]) == len(node))))
        parent = min(members[node[:-1]]) if node else None
        out.append((min(convs_), len(node), parent, len(convs_), len(children.get(node, [])), leaves, saved, hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=repr)


def cases():
    rnd = random.Random(8)
    rows = []
    for c in [*range(60), 99, 101, 1003, -3, -5, -7]:
        for t in range(rnd.choice([1, 2, 3, 8, 12, 30]) if c % 7 else 4):
            rows.append((c, t, rnd.choice(["user", "assistant", "", None]), rnd.choice(["a", "b", "é" * 3, "", None, "long " * 50])))
    rows += [(c, t, "user", f"same {t}") for c in range(200, 300) for t in range(5)]
    rows += [(300, None, "user", "z"), (300, None, "user", "y"), (300, None, "user", "y"), (300, 1, "user", "y"), (None, 1, "user", "q")]
    rows += [(305, t // 2, "user" if t % 3 else "assistant", f"{t % 5}") for t in range(160)]
    rows += [(c, t, "user" if t % 3 else "assistant", f"{t % 5}") for c in (306, 307) for t in range(9)]
    rnd.shuffle(rows)
    return rows


def frame(spark, rows):
    return spark.createDataFrame([(*r, "x", "x", "x", "x", "x") for r in rows], SCHEMA).repartition(6)


def found(spark, rows, settings=TrieSettings()):
    return sorted(map(tuple, prefix_trie(frame(spark, rows), settings).collect()), key=repr)


def test_trie_equals_brute_force(spark):
    rows = cases()
    assert found(spark, rows) == brute(rows)


def test_weak_points_are_noticed_and_others_tried(spark):
    rows = [r for r in cases() if r[0] is not None and r[0] < 100]
    weak = TrieSettings(modulus=3, points=((1, 1, 1, 1),))
    with pytest.raises(ValueError):
        prefix_trie(frame(spark, rows), weak)


def test_empty_table(spark):
    assert found(spark, []) == []


def test_running_totals_over_stretches(spark):
    rnd = random.Random(4)
    rows = [(g, i, rnd.randrange(1000)) for g, n in ((1, 3), (2, 5000), (3, 1), (4, 900), (9, 4000)) for i in range(n)]
    shuffled = rnd.sample(rows, len(rows))
    table = in_order(spark.createDataFrame(shuffled, "g bigint, i bigint, x bigint").repartition(7), [F.col("g"), F.col("i")], "test")
    p, point = 65521, 17
    got = sorted(map(tuple, running(table, "g", "test", plain=["i"], points={"x": point}, modulus=p).select("g", "i", "rank", "i_upto", "x_upto", "x_before").collect()))
    want, sums = [], {}
    for g, i, x in rows:
        before = sums.get(g, 0)
        sums[g] = (before + x * pow(point, i, p)) % p
        want.append((g, i, i + 1, i * (i + 1) // 2, sums[g], before))
    assert got == sorted(want)
    assert table.selectExpr("shiftright(pos, 33)").distinct().count() > 1
