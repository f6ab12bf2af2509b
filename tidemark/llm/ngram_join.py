"""Jaccard join of texts on word n-grams, with Bayesian pruning of candidate pairs.

Texts with the same words are copies: one of them stands for all. MinHash values in bands
name candidate pairs. A pair's values are compared a few at a time; given the matches so
far and a uniform prior, the pair is dropped as soon as the posterior probability that its
similarity reaches the threshold is below a tolerance. What remains links texts to
candidate groups, inside of which all pairs are verified exactly on their n-gram sets.

Pairs are compared and counted where rows of a group meet, and are never emitted. Texts
are compared by runs of characters other than white space, A-Z as a-z; n-grams are taken as
64-bit hashes. A text of fewer words than n has one n-gram of all its words. Texts without
words, null ones included, are never linked, not even to each other.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.components import connected_components
from tidemark.llm.groups import forest_labels, meet, pairs_at, whole_groups
from tidemark.llm.skew import attach
from tidemark.llm.words import MinHasher, blocks, doc_shingles, raw_shingles
from tidemark.llm.workspace import materialize


@dataclass(frozen=True)
class JoinSettings:
    """``bands`` of ``band_rows`` values: a pair of similarity s is a candidate with
    probability 1 - (1 - s**band_rows)**bands, 0.99995 at 0.8 as set here.
    ``tolerance``: least posterior probability that keeps a pair. ``step_bands``: bands
    compared before each look at it.
    """

    words: int = 5
    threshold: float = 0.8
    bands: int = 25
    band_rows: int = 5
    step_bands: int = 5
    tolerance: float = 1e-5
    seed: int = 3

    @property
    def hashes(self) -> int:
        return self.bands * self.band_rows


def least_matches(n: int, threshold: float, tolerance: float) -> int:
    """Fewest matches of n values with which the similarity still may reach the threshold.

    The posterior of the similarity after m matches is Beta(m + 1, n - m + 1).
    """
    x = (np.arange(20000) + 0.5) / 20000
    for m in range(n + 1):
        log = m * np.log(x) + (n - m) * np.log1p(-x)
        mass = np.exp(log - log.max())
        if mass[x >= threshold].sum() >= tolerance * mass.sum():
            return m
    return n


def _sketches(texts: list[bytes], settings: JoinSettings) -> tuple[list[bytes | None], list[bytes | None]]:
    """A 128-bit key of the word sequence and the MinHash values of each text."""
    keys, first, words, begin = raw_shingles(texts, settings.words)
    values = MinHasher(settings.hashes, settings.seed).signatures(keys, first)
    same: list[bytes | None] = []
    for i in range(len(texts)):
        own = words[begin[i] : begin[i + 1]]
        same.append(hashlib.blake2b(own.tobytes(), digest_size=16).digest() if len(own) else None)
    return same, [row.tobytes() if key else None for row, key in zip(values, same)]


def sketch(docs: DataFrame, settings: JoinSettings, key: str, text: str) -> DataFrame:
    """(row_id, key, text_key, same_high, same_low, values) of every row, written once."""

    @F.arrow_udf("struct<same:binary,values:binary>")
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            texts = [value or b"" for value in batch.to_pylist()]
            same: list[bytes | None] = []
            values: list[bytes | None] = []
            for first, end in blocks(texts):
                a, b = _sketches(texts[first:end], settings)
                same, values = same + a, values + b
            yield pa.StructArray.from_arrays([pa.array(same, pa.binary()), pa.array(values, pa.binary())], ["same", "values"])

    half = lambda at: F.conv(F.hex(F.substring("s.same", at, 8)), 16, -10).cast("bigint")
    rows = docs.select(
        F.monotonically_increasing_id().alias("row_id"),
        F.col(key).alias("key"),
        F.xxhash64(text).alias("text_key"),
        run.asNondeterministic()(F.col(text).cast("binary")).alias("s"),
    )
    table = rows.select("row_id", "key", "text_key", half(1).alias("same_high"), half(9).alias("same_low"), "s.values")
    return materialize(table, "join-sketch")


def _prune(batches: Iterator[pa.RecordBatch], settings: JoinSettings) -> Iterator[pa.RecordBatch]:
    """Links of a spanning forest over the pairs that the posterior keeps."""
    step = settings.step_bands * settings.band_rows
    least = {n: least_matches(n, settings.threshold, settings.tolerance) for n in range(step, settings.hashes + 1, step)}
    for table, sets in whole_groups(batches, "bucket"):
        count = table.num_rows
        values = np.frombuffer(b"".join(table.column("values").to_pylist()), dtype=np.uint16).reshape(count, -1)
        member = table.column("rep").to_numpy()
        band, own = table.column("band").to_numpy(), table.column("own").to_numpy()
        across = table.column("left").to_numpy() != table.column("right").to_numpy()
        lefts, rights = [], []
        for distance in range(1, int(np.bincount(sets).max())):
            left = pairs_at(distance, sets, across, own)
            if not len(left):
                continue
            matches = np.zeros(len(left), dtype=np.int64)
            for at in range(0, settings.hashes, step):
                equal = values[left, at : at + step] == values[left + distance, at : at + step]
                matches += equal.sum(axis=1)
                # A pair is compared only in the first band in which it collides.
                first = at // settings.band_rows
                hit = equal.reshape(len(left), -1, settings.band_rows).all(axis=2)
                earlier = (hit & (np.arange(first, first + hit.shape[1]) < band[left][:, None])).any(axis=1)
                keep = ~earlier & (matches >= least[at + equal.shape[1]])
                left, matches = left[keep], matches[keep]
                if not len(left):
                    break
            lefts.append(left)
            rights.append(left + distance)
        if lefts:
            labels = forest_labels(count, np.concatenate(lefts), np.concatenate(rights))
            moved = np.flatnonzero(labels != np.arange(count))
            yield pa.RecordBatch.from_arrays([pa.array(member[moved]), pa.array(member[labels[moved]])], ["u", "v"])


def _overlaps(texts: list[bytes], width: int) -> tuple[np.ndarray, np.ndarray]:
    """Numbers of shared n-grams of every two texts, and of n-grams of each."""
    keys, first = doc_shingles(texts, width)
    owner = np.repeat(np.arange(len(texts)), np.diff(first))
    _, column = np.unique(keys, return_inverse=True)
    order = np.argsort(column, kind="stable")
    owner, column = owner[order], column[order]
    shared = np.zeros((len(texts), len(texts)), dtype=np.float32)
    # Whole numbers below 2**24 are exact in single precision, as long as sums stay there.
    total = np.zeros((len(texts), len(texts)), dtype=np.int64)
    for low in range(0, int(column[-1]) + 1 if len(column) else 0, 2048):
        a, b = np.searchsorted(column, [low, low + 2048])
        held = np.zeros((len(texts), 2048), dtype=np.float32)
        held[owner[a:b], column[a:b] - low] = 1
        np.matmul(held, held.T, out=shared)
        total += shared.astype(np.int64)
    return total, np.diff(first)


def _verify(batches: Iterator[pa.RecordBatch], settings: JoinSettings) -> Iterator[pa.RecordBatch]:
    """(rep, links, root) of every text: links verified here, and a forest over them."""
    for table, sets in whole_groups(batches, "component"):
        member, own = table.column("rep").to_numpy(), table.column("own").to_numpy()
        across = table.column("left").to_numpy() != table.column("right").to_numpy()
        texts = table.column("body").to_pylist()
        same = table.column("same").to_pylist()
        reps, links, roots = [], [], []
        for first, end in zip(np.searchsorted(sets, np.arange(sets[-1] + 1)), np.searchsorted(sets, np.arange(sets[-1] + 1), "right")):
            # Repeated rows can bring a text twice, and equal keys another text: one of each stays.
            rows = {member[i]: i for i in range(first, end) if _word_key(texts[i]) == same[i]}
            pick = np.array(sorted(rows.values()), dtype=np.int64)
            if len(pick) < 2:
                continue
            shared, sizes = _overlaps([texts[i] for i in pick], settings.words)
            linked = shared / (sizes[:, None] + sizes[None, :] - shared) >= settings.threshold
            np.fill_diagonal(linked, False)
            if across[first]:
                linked &= own[pick][:, None] != own[pick][None, :]
            labels = forest_labels(len(pick), *np.nonzero(linked))
            reps.append(member[pick])
            links.append(linked.sum(axis=1))
            roots.append(member[pick][labels])
        if reps:
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate(reps)), pa.array(np.concatenate(links).astype(np.int64)), pa.array(np.concatenate(roots))],
                ["rep", "links", "root"],
            )


def _word_key(text: bytes) -> bytes | None:
    _, _, words, _ = raw_shingles([text], 1)
    return hashlib.blake2b(words.tobytes(), digest_size=16).digest() if len(words) else None


def near_duplicates(docs: DataFrame, settings: JoinSettings = JoinSettings(), key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of ``docs``: key, text_key, row_id, class_node, class_id, n_links, n_copies.

    class_id is the least key of all texts that links connect; n_links the number of
    different texts linked to this one, n_copies the number of rows with its very words.
    A text without words is a class of its own. ``text_key`` is Spark's xxhash64 of the
    text: with the key it finds the row again. Repeated rows are rows like others.
    """
    rows = sketch(docs, settings, key, text)
    copies = rows.filter("values is not null").groupBy("same_high", "same_low")
    reps = materialize(
        copies.agg(
            F.min(F.struct("row_id", "key", "text_key")).alias("r"),
            F.min("key").alias("least_key"),
            F.count(F.lit(1)).alias("n_copies"),
            F.first("values").alias("values"),
        ).select(F.col("r.row_id").alias("rep"), "r.key", "r.text_key", "same_high", "same_low", "least_key", "n_copies", "values"),
        "join-reps",
    )
    width = 2 * settings.band_rows
    bands = reps.select("rep", F.explode(F.sequence(F.lit(0), F.lit(settings.bands - 1))).alias("band"), "values")
    bands = bands.select("rep", "band", F.xxhash64("band", F.expr(f"substring(values, band * {width} + 1, {width})")).alias("bucket"))
    sizes = bands.groupBy("bucket").agg(F.count(F.lit(1)).alias("size")).filter("size > 1")
    live = bands.join(sizes, "bucket").join(reps.select("rep", "values"), "rep")
    groups = connected_components(meet(live, "bucket", "size", "rep"), "join-groups", lambda b: _prune(b, settings))
    groups = materialize(groups, "join-groups")

    same = F.unhex(F.concat(*(F.lpad(F.hex(name), 16, "0") for name in ("same_high", "same_low"))))
    members = groups.withColumnRenamed("node", "rep").join(reps.select("rep", "key", "text_key", same.alias("same")), "rep")
    bodies = docs.select(F.col(key).alias("key_"), F.xxhash64(text).alias("text_key_"), F.col(text).cast("binary").alias("body"))
    found = bodies.join(members, (F.col("text_key") == F.col("text_key_")) & F.col("key").eqNullSafe(F.col("key_")))
    found = found.select("component", "size", "rep", "same", "body")
    verified = materialize(
        meet(found, "component", "size", "rep").mapInArrow(lambda b: _verify(b, settings), "rep bigint, links bigint, root bigint"),
        "join-verified",
    )
    linked = connected_components(verified.select(F.col("rep").alias("u"), F.col("root").alias("v")), "join-classes")
    counts = verified.groupBy("rep").agg(F.sum("links").alias("n_links"))

    nodes = reps.select("rep", "same_high", "same_low", "least_key", "n_copies").join(linked.withColumnRenamed("node", "rep"), "rep", "left")
    nodes = nodes.join(counts, "rep", "left").withColumn("class_node", F.coalesce("component", "rep"))
    nodes = materialize(nodes, "join-nodes")
    classes = nodes.groupBy("class_node").agg(F.min("least_key").alias("class_id"), F.count(F.lit(1)).alias("members"))
    nodes = attach(nodes, classes, ["class_node"], "members", nodes.count()).select("same_high", "same_low", "class_node", "class_id", F.coalesce("n_links", F.lit(0)).alias("n_links"), "n_copies")
    same_words = attach(rows.filter("values is not null").drop("values"), nodes, ["same_high", "same_low"], "n_copies", rows.count())
    wordless = rows.filter("values is null").drop("values")
    return same_words.unionByName(wordless, allowMissingColumns=True).select(
        F.col("key").alias(key),
        "text_key",
        "row_id",
        F.coalesce("class_node", "row_id").alias("class_node"),
        F.coalesce("class_id", F.col("key")).alias("class_id"),
        F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"),
        F.coalesce("n_copies", F.lit(1)).cast("bigint").alias("n_copies"),
    )


def one_of_each(docs: DataFrame, settings: JoinSettings = JoinSettings(), key: str = "doc_id", text: str = "text") -> DataFrame:
    """Rows of ``docs`` without near duplicates: the row of the least key of each class stays.

    Ties between equal keys go to the row read first. Null keys come last. Columns and
    types stay as they are.
    """
    found = near_duplicates(docs, settings, key, text)
    order = F.struct(F.col(key).isNull().alias("last"), F.col(key).alias("key"), "row_id", "text_key")
    chosen = materialize(found.groupBy("class_node").agg(F.min(order).alias("o")).select(F.col("o.key").alias("__key"), F.col("o.text_key").alias("__text_key")), "join-kept")
    rows = docs.withColumn("__own_key", F.xxhash64(text))
    kept = rows.join(chosen, (F.col("__own_key") == F.col("__text_key")) & F.col(key).eqNullSafe(F.col("__key")), "left_semi")
    return kept.dropDuplicates(["__own_key", key]).drop("__own_key")
