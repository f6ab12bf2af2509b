"""Prefix trie of rebuilt conversations, from fingerprints that compose like their texts.

Every conversation is rebuilt from the head of another one (its base) and its own later
turns. A sequence of turns has a fingerprint in a monoid: the polynomial of its turns'
hashes at four points modulo a 31-bit prime, 124 bits, with its length. That of the
rebuilt prefix is composed from the stored prefix values of the two conversations, head
by head and tail by tail, so no rebuilt text is ever made. Each rebuilt turn is a
reference to a stored one.

Prefixes of equal depth and value are one node. Turns of equal text share one reference
(found by fingerprint, compared in full); a node is right if all its members refer to
the same turn there, by induction over the depth. If one does not, all is done again
with other points.

Every node belongs to its member of least id, which has a chain of nodes at the end of
its own path. What a node adds to its ancestors is therefore counted once: totals along
each path from the end, summed over the members of each node, are those of subtrees.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.exact_dedup import equal_classes
from tidemark.llm.scans import in_order, running
from tidemark.llm.skew import attach
from tidemark.llm.workspace import drop_table, materialize

LANES = ("a", "b", "c", "d")
NODE = ["depth", "hi", "lo"]
#: The head of a base has fewer turns than this.
HEAD_TURNS = 9
#: Conversations rebuilt from one base.
FAMILY = 5


@dataclass(frozen=True)
class TrieSettings:
    """``points`` are tried in turn until all nodes hold."""

    modulus: int = (1 << 31) - 1
    points: tuple[tuple[int, int, int, int], ...] = ((48271, 1583458089, 784588716, 1226874159), (630360016, 397204094, 16807, 1078318381), (69621, 742938285, 950706376, 62089911))


def head_turns(conv: Column) -> Column:
    """How many turns of its base a conversation begins with."""
    return (F.crc32(conv.cast("string").cast("binary")) % HEAD_TURNS).cast("int")


def base_of(conv: Column) -> Column:
    return conv - conv % FAMILY


def stored_turns(conversations: DataFrame) -> DataFrame:
    """(pos, conv, body, n_bytes, text_bytes, a..d) in the order of conversations and turns.

    ``body`` holds role and text so that no two different turns have equal bodies.
    """
    role, text = (F.coalesce(F.col(c), F.lit("")) for c in ("role", "text"))
    body = F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text)
    rows = conversations.filter("conv_id is not null").select(F.col("conv_id").alias("conv"), "turn", body.alias("said"), F.octet_length(text).cast("bigint").alias("text_bytes"))
    rows = rows.withColumn("digest", F.sha2("said", 256))
    ordered = in_order(rows, [F.col("conv"), F.col("turn").asc_nulls_first(), F.col("digest")], "trie-turns")
    lanes = [F.conv(F.substring("digest", 1 + 8 * i, 8), 16, 10).cast("bigint").alias(name) for i, name in enumerate(LANES)]
    return ordered.select("pos", "conv", F.col("said").cast("binary").alias("body"), F.octet_length("said").cast("bigint").alias("n_bytes"), "text_bytes", *lanes)


def _packed(lane: dict[str, Column], prefix: str = "") -> list[Column]:
    return [(F.shiftleft(lane["a"], 31) + lane["b"]).alias(f"{prefix}hi"), (F.shiftleft(lane["c"], 31) + lane["d"]).alias(f"{prefix}lo")]


def _paths(turns: DataFrame, settings: TrieSettings, points: tuple[int, ...]) -> DataFrame:
    """One row per conversation and depth, 0 too: the node, its parent, the turn referred to and whether it ends there."""
    p = settings.modulus
    summed = running(turns, "conv", "trie-prefixes", points=dict(zip(LANES, points)), modulus=p)
    upto = {n: F.col(f"{n}_upto") for n in LANES}
    before = {n: F.col(f"{n}_before") for n in LANES}
    at = F.when(F.col("rank") < HEAD_TURNS, F.struct("rank", *(upto[n].alias(n) for n in LANES)))
    # At most HEAD_TURNS values of a conversation are collected.
    convs = materialize(summed.groupBy("conv").agg(F.count(F.lit(1)).alias("n"), F.sort_array(F.collect_list(at)).alias("heads")), "trie-conversations")
    nothing = F.struct(F.lit(0).cast("bigint").alias("rank"), *(F.lit(0).cast("bigint").alias(n) for n in LANES))

    def value(heads: str, count: Column) -> Column:
        return F.when(count == 0, nothing).otherwise(F.get(F.col(heads), (count - 1).cast("int")))

    base = convs.select(F.col("conv").alias("base"), F.col("n").alias("base_n"), F.col("heads").alias("base_heads"))
    known = convs.withColumn("base", base_of(F.col("conv"))).withColumn("h", head_turns(F.col("conv"))).join(base, "base", "left")
    known = known.withColumn("taken", F.least("h", F.coalesce("base_n", F.lit(0)))).withColumn("skipped", F.least("h", "n"))
    known = known.select("conv", "n", "h", "taken", (F.col("taken") + F.col("n") - F.col("skipped")).alias("length"), value("base_heads", F.col("taken")).alias("head"), value("heads", F.col("skipped")).alias("own"))
    known = materialize(known, "trie-heads")

    root = known.select("conv", F.lit(0).cast("bigint").alias("depth"), *(F.lit(0).cast("bigint").alias(c) for c in ("hi", "lo", "parent_hi", "parent_lo")), F.lit(-1).cast("bigint").alias("first"), F.lit(0).cast("bigint").alias("text_bytes"), (F.col("length") == 0).alias("ends"))
    follower = F.explode(F.sequence(F.col("conv") - FAMILY + 1, F.col("conv") + FAMILY - 1)).alias("follower")
    heads = summed.filter((F.col("rank") < HEAD_TURNS) & (F.col("conv") % FAMILY == 0)).select("*", follower)
    heads = heads.filter((base_of(F.col("follower")) == F.col("conv")) & (F.col("rank") <= head_turns(F.col("follower"))))
    heads = heads.drop("conv").withColumnRenamed("follower", "conv").join(known.select("conv", "length"), "conv")
    heads = heads.select("conv", F.col("rank").alias("depth"), *_packed(upto), *_packed(before, "parent_"), "first", "text_bytes", (F.col("rank") == F.col("length")).alias("ends"))

    # The tail is moved to follow the head: (own prefix up to here - own head) * x ** (taken - h).
    tails = attach(summed.filter(F.col("rank") > head_turns(F.col("conv"))), known, ["conv"], "n", turns.count())
    back = {n: F.array(*(F.lit(pow(x, -k, p)).cast("bigint") for k in range(HEAD_TURNS))) for n, x in zip(LANES, points)}

    def moved(end: dict[str, Column]) -> dict[str, Column]:
        shift = (F.col("h") - F.col("taken")).cast("int")
        return {n: (F.col(f"head.{n}") + (end[n] + p - F.col(f"own.{n}")) % p * F.get(back[n], shift)) % p for n in LANES}

    depth = F.col("rank") - F.col("h") + F.col("taken")
    tails = tails.select("conv", depth.alias("depth"), *_packed(moved(upto)), *_packed(moved(before), "parent_"), "first", "text_bytes", (depth == F.col("length")).alias("ends"))
    return materialize(root.unionByName(heads).unionByName(tails), "trie-paths")


def _joined_ids(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Runs of ids of one node in a batch as one text each."""
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = list(zip(*(batch.column(n).to_pylist() for n in NODE)))
        ids = batch.column("conv").to_pylist()
        cuts = [i for i in range(len(keys)) if i == 0 or keys[i] != keys[i - 1]] + [len(keys)]
        rows = [(*keys[a], ids[a], ",".join(map(str, ids[a:b]))) for a, b in zip(cuts, cuts[1:])]
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows)], [*NODE, "conv", "ids"])


def _hashed_ids(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 of the comma-joined texts of each node, which come in order."""
    at, digest = None, None
    for batch in batches:
        out = []
        for *node, ids in zip(*(batch.column(n).to_pylist() for n in (*NODE, "ids"))):
            if node != at:
                if at:
                    out.append((*at, digest.hexdigest()))
                at, digest = node, hashlib.sha256()
            else:
                digest.update(b",")
            digest.update(ids.encode())
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*out)], [*NODE, "ends_sha256"])
    if at:
        yield pa.RecordBatch.from_arrays([pa.array([v]) for v in (*at, digest.hexdigest())], [*NODE, "ends_sha256"])


def _ends(paths: DataFrame) -> DataFrame:
    """Digest of the conversations that end at each node, in ranges of ids, then range after range."""
    key = "depth bigint, hi bigint, lo bigint"
    ids = paths.filter("ends").select(*NODE, "conv")
    pieces = ids.repartitionByRange(*NODE, "conv").sortWithinPartitions(*NODE, "conv").mapInArrow(_joined_ids, f"{key}, conv bigint, ids string")
    return pieces.repartition(*NODE).sortWithinPartitions(*NODE, "conv").select(*NODE, "ids").mapInArrow(_hashed_ids, f"{key}, ends_sha256 string")


def prefix_trie(conversations: DataFrame, settings: TrieSettings = TrieSettings()) -> DataFrame:
    """One row per node of the trie of rebuilt conversations.

    Columns: conv_id (least member), depth, parent_conv_id, n_convs, n_children,
    n_leaves, saved_tokens, ends_sha256, as the query states them. ``conversations`` has
    conv_id, turn, role and text; other columns, whatever their names, are not looked at.

    Turns are taken by turn, null first, equal ones by a digest of role and text; repeated
    rows are turns like any other. A null role or text is empty. Rows without conv_id are
    in no conversation. An empty table gives no node, not even a root. Very long texts go
    through two shuffles, in order and where equal ones are compared chunk by chunk.
    """
    conversations = conversations.withColumn("conv_id", F.col("conv_id").cast("bigint"))
    turns = materialize(stored_turns(conversations), "trie-stored")
    classes = equal_classes(turns.select(F.col("pos").alias("row"), "body", "n_bytes"), [])
    refers = materialize(turns.drop("body", "n_bytes").join(classes.select(F.col("row").alias("pos"), "first"), "pos").repartitionByRange("pos").sortWithinPartitions("pos"), "trie-references")
    drop_table(turns)
    for points in settings.points:
        paths = _paths(refers, settings, points)
        nodes = paths.groupBy(*NODE).agg(
            F.min("conv").alias("conv_id"), F.count(F.lit(1)).alias("n_convs"), F.max("text_bytes").alias("text_bytes"),
            F.max("parent_hi").alias("parent_hi"), F.max("parent_lo").alias("parent_lo"), (F.min("first") != F.max("first")).alias("mixed"),
        )
        nodes = materialize(nodes, "trie-nodes")
        if nodes.filter("mixed").isEmpty():
            return _described(paths, nodes)
        drop_table(paths)
        drop_table(nodes)
    raise ValueError("no points tell all turns apart")


def _described(paths: DataFrame, nodes: DataFrame) -> DataFrame:
    parent = [(F.col("depth") - 1).alias("depth"), F.col("parent_hi").alias("hi"), F.col("parent_lo").alias("lo")]
    born = nodes.filter("depth > 0")
    children = born.select(*parent).groupBy(*NODE).agg(F.count(F.lit(1)).alias("n_children"))
    nodes = materialize(nodes.join(children, NODE, "left").withColumn("n_children", F.coalesce("n_children", F.lit(0).cast("bigint"))), "trie-children")

    # A node's own share, at the one row of its least member; the root's text is empty.
    own = nodes.select(F.col("conv_id").alias("conv"), "depth", ((F.col("n_convs") - 1) * F.col("text_bytes")).alias("saved"), (F.col("n_children") == 0).cast("bigint").alias("leaf"))
    shares = paths.select("conv", *NODE).join(own, ["conv", "depth"], "left").fillna(0, ["saved", "leaf"])
    below = running(in_order(shares, [F.col("conv"), F.col("depth").desc()], "trie-shares"), "conv", "trie-totals", plain=["saved", "leaf"])
    totals = below.groupBy(*NODE).agg(F.sum("saved_upto").alias("saved_tokens"), F.sum("leaf_upto").alias("n_leaves"))

    above = nodes.filter("n_children > 0").select(*NODE, F.col("conv_id").alias("parent_conv_id"), "n_children")
    named = attach(born.select(*parent, F.struct(*NODE).alias("own")), above, NODE, "n_children", born.count()).select("own.*", "parent_conv_id")
    out = nodes.join(totals, NODE).join(named, NODE, "left").join(_ends(paths), NODE, "left")
    nobody = hashlib.sha256(b"").hexdigest()
    return out.select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", F.coalesce("ends_sha256", F.lit(nobody)).alias("ends_sha256"))
