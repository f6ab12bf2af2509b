"""Exact duplicates by composable polynomial fingerprints, each match compared chunk by chunk.

A text's fingerprint is the polynomial of its bytes at four fixed points modulo a 31-bit
prime (124 bits), with its length. It is composed of the fingerprints of chunks: that of
AB is f(A) + point ** len(A) * f(B). Texts up to ``huge_bytes`` are hashed where they are
read; the chunks of longer ones are dealt over all tasks and their shifted terms summed.

Texts of equal fingerprint are compared in full with the first of their group, one chunk
at a time: chunks of the same place meet, sorted so that the first text's comes before
those of the others, and no task holds more than a batch of chunks. A large group is cut
into parts that each get the first text's chunk, so no task reads a whole group. Texts
that differ in spite of their fingerprint form groups of their own in a further round.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.skew import attach
from tidemark.llm.workspace import drop_table, materialize

_SLAB = 1 << 20


@dataclass(frozen=True)
class FingerprintSettings:
    """``modulus`` has at most 31 bits, so that products fit in 64."""

    modulus: int = (1 << 31) - 1
    points: tuple[int, int, int, int] = (1103515245, 1664525, 742938285, 950706376)
    chunk_bytes: int = 1 << 16
    huge_bytes: int = 1 << 24
    part_rows: int = 64


class Polynomial:
    """Fingerprints of byte strings and of their chunks."""

    def __init__(self, settings: FingerprintSettings):
        self.s = settings
        longest = _SLAB + settings.chunk_bytes
        self.up = [self._powers(x % settings.modulus, longest) for x in settings.points]
        self.down = [self._powers(pow(x, -1, settings.modulus), longest) for x in settings.points]

    def _powers(self, base: int, count: int) -> np.ndarray:
        """base ** 0 ... base ** count, by doubling."""
        out = np.ones(1, dtype=np.uint64)
        while len(out) <= count:
            out = np.concatenate([out, out * np.uint64(pow(base, len(out), self.s.modulus)) % np.uint64(self.s.modulus)])
        return out

    def chunks(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """One row of four values per chunk [start, end) of at most ``chunk_bytes`` bytes, in order."""
        out = np.zeros((len(starts), len(self.up)), dtype=np.uint64)
        p, at = np.uint64(self.s.modulus), 0
        while at < len(starts):
            stop = max(at + 1, int(np.searchsorted(ends, starts[at] + _SLAB, "right")))
            first, a, b = starts[at], starts[at:stop] - starts[at], ends[at:stop] - starts[at]
            bytes_ = data[first : first + b[-1]].astype(np.uint64) + np.uint64(1)
            for lane, (up, down) in enumerate(zip(self.up, self.down)):
                sums = np.zeros(len(bytes_) + 1, dtype=np.uint64)
                np.cumsum(bytes_ * up[: len(bytes_)], out=sums[1:])
                out[at:stop, lane] = (sums[b] - sums[a]) % p * down[a] % p
            at = stop
        return out

    def shifted(self, hashes: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """The terms by which chunks at these offsets add to the fingerprint of the whole."""
        p, out = self.s.modulus, hashes.copy()
        some, inverse = np.unique(offsets, return_inverse=True)
        for lane, point in enumerate(self.s.points):
            powers = np.array([pow(point, int(n), p) for n in some], dtype=np.uint64)
            out[:, lane] = out[:, lane] * powers[inverse] % np.uint64(p)
        return out

    def texts(self, texts: list[bytes]) -> np.ndarray:
        """Packed fingerprints (two 62-bit numbers) of whole texts."""
        step = self.s.chunk_bytes
        sizes = np.array([len(t) for t in texts], dtype=np.int64)
        begin = np.cumsum(sizes) - sizes
        counts = -(-sizes // step)
        owner = np.repeat(np.arange(len(texts)), counts)
        offset = (np.arange(len(owner)) - (np.cumsum(counts) - counts)[owner]) * step
        starts = begin[owner] + offset
        ends = np.minimum(starts + step, begin[owner] + sizes[owner])
        terms = self.shifted(self.chunks(np.frombuffer(b"".join(texts), dtype=np.uint8), starts, ends), offset)
        whole = np.zeros((len(texts), len(self.up)), dtype=np.uint64)
        some = np.flatnonzero(counts)
        if len(some):
            whole[some] = np.add.reduceat(terms, np.searchsorted(owner, some), axis=0) % np.uint64(self.s.modulus)
        return np.stack([whole[:, 0] << np.uint64(31) | whole[:, 1], whole[:, 2] << np.uint64(31) | whole[:, 3]], axis=1).astype(np.int64)


def fingerprint(text: Column, settings: FingerprintSettings = FingerprintSettings()) -> Column:
    """Struct (hi, lo) of the bytes; a null counts as empty."""

    @F.arrow_udf("struct<hi:bigint,lo:bigint>")
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        maker = Polynomial(settings)
        for batch in batches:
            out = maker.texts([value or b"" for value in batch.to_pylist()])
            yield pa.StructArray.from_arrays([pa.array(out[:, 0]), pa.array(out[:, 1])], ["hi", "lo"])

    return run(text.cast("binary"))


def _chunk_terms(chunk: Column, offset: Column, settings: FingerprintSettings) -> Column:
    names = ["a", "b", "c", "d"]

    @F.arrow_udf("struct<a:bigint,b:bigint,c:bigint,d:bigint>")
    def run(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        maker = Polynomial(settings)
        for body, place in batches:
            texts = body.to_pylist()
            ends = np.cumsum([len(t) for t in texts])
            starts = np.append(0, ends[:-1])
            hashes = maker.chunks(np.frombuffer(b"".join(texts), dtype=np.uint8), starts, ends)
            terms = maker.shifted(hashes, place.to_numpy(zero_copy_only=False)).astype(np.int64)
            yield pa.StructArray.from_arrays([pa.array(terms[:, i]) for i in range(4)], names)

    return run(chunk, offset)


def _cut(text: str, size: str, step: int) -> Column:
    """The text's chunks in order; one empty chunk of an empty text."""
    last = F.floor((F.greatest(F.col(size), F.lit(1)) - 1) / step).cast("int")
    return F.transform(F.sequence(F.lit(0), last), lambda i: F.substring(F.col(text), i * step + 1, F.lit(step)))


def _fingerprints(base: DataFrame, carried: list[str], settings: FingerprintSettings) -> DataFrame:
    """The columns ``carried`` (``row`` first), n_bytes, hi and lo of every row."""
    usual = base.filter(F.col("n_bytes") <= settings.huge_bytes).select(*carried, "n_bytes", fingerprint(F.col("body"), settings).alias("f")).select(*carried, "n_bytes", "f.hi", "f.lo")
    huge = base.filter(F.col("n_bytes") > settings.huge_bytes)
    chunks = huge.select(*carried, "n_bytes", F.posexplode(_cut("body", "n_bytes", settings.chunk_bytes)).alias("seq", "chunk")).repartition("row", "seq")
    terms = chunks.select(*carried, "n_bytes", _chunk_terms(F.col("chunk"), F.col("seq").cast("bigint") * settings.chunk_bytes, settings).alias("t"))
    whole = [F.first(c).alias(c) for c in (*carried[1:], "n_bytes")]
    summed = terms.groupBy("row").agg(*whole, *((F.sum(f"t.{x}") % settings.modulus).alias(x) for x in "abcd"))
    return usual.unionAll(summed.select(*carried, "n_bytes", (F.shiftleft("a", 31) + F.col("b")).alias("hi"), (F.shiftleft("c", 31) + F.col("d")).alias("lo")))


def _unequal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows with a chunk that differs from the first text's, which comes before theirs."""
    at, body = None, b""
    for batch in batches:
        out = []
        for row, first, seq, part, other, chunk in zip(*(batch.column(n).to_pylist() for n in ("row", "first", "seq", "part", "other", "chunk"))):
            if not other:
                at, body = (first, seq, part), chunk
            elif at != (first, seq, part):
                raise ValueError("a chunk came without the one it is compared with")
            elif chunk != body:
                out.append(row)
        yield pa.RecordBatch.from_arrays([pa.array(out, pa.int64())], ["row"])


def _compare(base: DataFrame, groups: DataFrame, settings: FingerprintSettings) -> DataFrame:
    """(row) of the members of groups of several whose text is not that of the group's first."""
    parts = F.ceil(F.col("size") / settings.part_rows).cast("int")
    bodies = base.select("row", "body", "n_bytes").join(groups.filter("size > 1").select("row", "first", "size"), "row")
    chunks = bodies.select("row", "first", "size", F.posexplode(_cut("body", "n_bytes", settings.chunk_bytes)).alias("seq", "chunk"))
    other = F.col("row") != F.col("first")
    own = F.pmod(F.xxhash64("row"), parts).cast("int")
    sent = chunks.select("row", "first", "seq", other.alias("other"), "chunk", F.explode(F.when(other, F.array(own)).otherwise(F.sequence(F.lit(0), parts - 1))).alias("part"))
    met = sent.repartition("first", "seq", "part").sortWithinPartitions("first", "seq", "part", "other")
    return met.mapInArrow(_unequal, "row bigint").distinct()


def equal_classes(base: DataFrame, order: list[str], settings: FingerprintSettings = FingerprintSettings()) -> DataFrame:
    """Adds ``first`` (row of the class's first member), ``leader`` (its order columns) and ``size`` to every row but its body.

    ``base`` is a written table with ``row`` (unique), ``body`` (binary, not null) and
    ``n_bytes``; the first member is the least by the columns ``order``, then by row.
    """
    carried = ["row", *(c for c in base.columns if c not in ("row", "body", "n_bytes"))]
    prints = materialize(_fingerprints(base, carried, settings).withColumn("round", F.lit(0)), "exact-prints")
    total, keys, turn = prints.count(), ["hi", "lo", "n_bytes", "round"], 0
    while True:
        least = prints.groupBy(*keys).agg(F.min(F.struct(*order, "row")).alias("leader"), F.count(F.lit(1)).alias("size"))
        groups = materialize(attach(prints, least.withColumn("first", F.col("leader.row")), keys, "size", total), "exact-groups")
        differ = materialize(_compare(base, groups.filter(F.col("round") == turn), settings), "exact-differ")
        if differ.isEmpty():
            drop_table(prints)
            drop_table(differ)
            return groups.drop(*keys)
        later = materialize(prints.join(differ.withColumn("late", F.lit(1)), "row", "left").withColumn("round", F.col("round") + F.coalesce("late", F.lit(0))).drop("late"), "exact-prints")
        for done in (prints, groups, differ):
            drop_table(done)
        prints, turn = later, turn + 1


def normalised(text: Column) -> Column:
    """Each run of white space as one space; null as the empty text."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+", " ")


def exact_duplicates(docs: DataFrame, settings: FingerprintSettings = FingerprintSettings(), key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of ``docs``: key, keep_id, group_size, kept, text_sha256.

    Of rows with equal normalised text the one of the least key stays; a null key comes
    after all others, and of rows with the same key one stays. Null texts equal empty
    ones. Very long texts are hashed and compared in chunks. Repeated rows are members
    like any other. An empty table gives no rows; other columns, whatever their names,
    are not looked at.
    """
    plain = normalised(F.col(text))
    base = docs.select(F.col(key).alias("key"), plain.alias("plain")).select(
        F.monotonically_increasing_id().alias("row"), "key", F.col("key").isNull().alias("keyless"), F.sha2("plain", 256).alias("sha"), F.col("plain").cast("binary").alias("body"), F.octet_length("plain").cast("bigint").alias("n_bytes")
    )
    base = materialize(base, "exact-texts")
    classes = equal_classes(base, ["keyless", "key"], settings)
    drop_table(base)
    return classes.select(
        F.col("key").alias(key), F.col("leader.key").alias("keep_id"), F.col("size").alias("group_size"), (F.col("row") == F.col("first")).alias("kept"), F.col("sha").alias("text_sha256")
    )


def oracle_sql() -> str:
    return r"""
        SELECT doc_id, min(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
               row_number() OVER (PARTITION BY plain ORDER BY doc_id NULLS LAST) = 1 AS kept, sha256(plain) AS text_sha256
        FROM (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS plain FROM documents)
        WINDOW same AS (PARTITION BY plain)
    """
