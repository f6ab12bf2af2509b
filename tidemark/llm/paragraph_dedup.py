"""Repeated paragraphs and passages, by MinHash banding and connected components.

Two kinds of units are looked at. A paragraph is a line, or the lines between two blank
ones; its MinHash values go into bands tuned for high recall, and paragraphs that collide
are compared by the exact Jaccard coefficient of their word n-grams. Those of fewer than
``min_words`` words are found by a key of all their words. A passage is a run of
``passage_words`` words anywhere in a text, at places that the words themselves choose:
where the hash of three words is least among ``spacing`` neighbours. Any text shared word
for word over passage_words + spacing - 1 words (51 as set) holds at least one common
passage, wherever it stands; equal passages are found by a hash and told apart by 128 bits of their words.
A repeated passage is reported with the words around it that equal those around the kept one.

Verified links make components; of each, the first unit stays and the others are removed.
A paragraph that shares words with the kept one (a line of it, or it a line of this one)
stays too. Texts that are wholly equal are treated as one, and the later ones removed whole. Units
of a group are compared where they meet and pairs are never emitted.

Words are runs of characters other than white space, A-Z as a-z. Null and empty texts have
no units. Very long texts are cut into units like any other; a repeated row is a copy of
its text, and a null key comes after all others.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.components import connected_components
from tidemark.llm.groups import forest_labels, meet, pairs_at, whole_groups
from tidemark.llm.words import MinHasher, blocks, join_texts, mix64, shingle_hashes, span_hashes, word_spans
from tidemark.llm.skew import attach
from tidemark.llm.workspace import drop_table, materialize


@dataclass(frozen=True)
class ParagraphSettings:
    """``bands`` of ``band_rows`` MinHash values: two paragraphs of similarity s collide with
    probability 1 - (1 - s**band_rows)**bands, 0.998 at 0.8 as set here. Paragraphs of
    fewer than ``min_words`` (not under ``shingle_words``) words must be equal.
    """

    min_words: int = 5
    shingle_words: int = 5
    threshold: float = 0.8
    bands: int = 9
    band_rows: int = 3
    passage_words: int = 20
    anchor_words: int = 3
    spacing: int = 32
    seed: int = 5


#: ``passage_first`` holds the places of each distinct key side by side: ``passage_n`` of them from ``passage_at``.
#: Key and check of a passage, and high and low of a paragraph, are 128 bits of all its words.
UNITS = "struct<passage_first:array<int>,passage_key:array<bigint>,passage_check:array<bigint>,passage_at:array<int>,passage_n:array<int>,par_first:array<int>,par_end:array<int>,par_bands:array<array<bigint>>,par_high:array<bigint>,par_low:array<bigint>,n_words:int>"
_INTS, _LONGS = pa.list_(pa.int32()), pa.list_(pa.int64())
_UNIT_KIND = pa.struct(
    [
        ("passage_first", _INTS), ("passage_key", _LONGS), ("passage_check", _LONGS), ("passage_at", _INTS), ("passage_n", _INTS),
        ("par_first", _INTS), ("par_end", _INTS), ("par_bands", pa.list_(_LONGS)), ("par_high", _LONGS), ("par_low", _LONGS), ("n_words", pa.int32()),
    ]
)


def _sliding(values: np.ndarray, width: int, least) -> np.ndarray:
    """Least (or largest) of every ``width`` neighbours, a power of two."""
    step = 1
    while step < width:
        values = least(values[:-step], values[step:])
        step *= 2
    return values


def _anchors(words: np.ndarray, doc: np.ndarray, settings: ParagraphSettings) -> np.ndarray:
    """Places whose hash is the least of some ``spacing`` places of their text."""
    width = settings.spacing
    hashes = shingle_hashes(words, settings.anchor_words)
    if len(hashes) < width:
        return np.zeros(0, dtype=np.int64)
    low = _sliding(hashes, width, np.minimum)
    last = np.arange(len(low)) + width - 1 + settings.anchor_words - 1
    low[doc[: len(low)] != doc[last]] = 0
    edge = np.zeros(width - 1, dtype=np.uint64)
    high = _sliding(np.concatenate([edge, low, edge]), width, np.maximum)
    return np.flatnonzero((high == hashes) & (hashes > 0))


def _layout(texts: list[bytes]):
    data, at = join_texts(texts)
    starts, ends = word_spans(data)
    words = span_hashes(data, starts, ends)
    first = np.searchsorted(starts, at)
    doc = np.repeat(np.arange(len(texts)), np.diff(first))
    return data, starts, words, first, doc


def _units(texts: list[bytes], settings: ParagraphSettings) -> pa.StructArray:
    data, starts, words, first, doc = _layout(texts)
    # Passages.
    place = _anchors(words, doc, settings)
    place = place[place + settings.passage_words <= first[1:][doc[place]]] if len(place) else place
    key = shingle_hashes(words, settings.passage_words)[place].astype(np.int64) if len(place) else np.zeros(0, dtype=np.int64)
    # A second hash of the same words, from other bits of theirs.
    check = shingle_hashes(mix64(words ^ _OTHER_BITS), settings.passage_words)[place].astype(np.int64) if len(place) else key
    # Equal ones of a text side by side: only their number goes through the shuffles.
    owner = doc[place]
    order = np.lexsort((place, key, owner))
    place, key, check, owner = place[order], key[order], check[order], owner[order]
    head_at = np.flatnonzero(np.append(True, (key[1:] != key[:-1]) | (owner[1:] != owner[:-1]))) if len(place) else place
    size = np.diff(np.append(head_at, len(place)))
    every, some = np.arange(len(texts) + 1), owner[head_at]
    cut, key_cut = np.searchsorted(owner, every), np.searchsorted(some, every)
    # Paragraphs: the line of each word, counted over all texts.
    line = np.cumsum(data == 10)[starts] if len(starts) else np.zeros(0, dtype=np.int64)
    head, tail = _paragraphs(line, doc)
    buckets, sizes = _keys(words, head, tail, settings)
    high, low = _digests(words, head, tail)
    par_cut = np.searchsorted(head, first)
    par_base = np.repeat(first[:-1], np.diff(par_cut))

    def lists(values, at: np.ndarray, kind: pa.DataType = pa.int64()) -> pa.Array:
        return pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array(values, kind))

    columns = [
        lists(place - first[owner], cut, pa.int32()),
        lists(key[head_at], key_cut),
        lists(check[head_at], key_cut),
        lists(head_at - cut[some], key_cut, pa.int32()),
        lists(size, key_cut, pa.int32()),
        lists(head - par_base, par_cut, pa.int32()),
        lists(tail - par_base, par_cut, pa.int32()),
        lists(lists(buckets, np.append(0, np.cumsum(sizes))), par_cut, pa.list_(pa.int64())),
        lists(high, par_cut),
        lists(low, par_cut),
        pa.array(np.diff(first), pa.int32()),
    ]
    return pa.StructArray.from_arrays(columns, fields=list(_UNIT_KIND))


_OTHER_BITS = np.uint64(0x6A09E667F3BCC909)


def _digests(words: np.ndarray, head: np.ndarray, tail: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """128 bits of the words of each paragraph [head, tail), as two numbers."""
    body = memoryview(words.tobytes())
    packed = b"".join(hashlib.blake2b(body[8 * a : 8 * b], digest_size=16).digest() for a, b in zip(head.tolist(), tail.tolist()))
    numbers = np.frombuffer(packed, dtype="<i8").reshape(-1, 2)
    return numbers[:, 0], numbers[:, 1]


def _paragraphs(line: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ends of the lines that have words and of the groups of several of them without a blank line between."""
    if not len(line):
        return line, line
    step = np.diff(line)
    head = np.append(0, np.flatnonzero(step > 0) + 1)
    tail = np.append(head[1:], len(line))
    begin = np.append(0, np.flatnonzero((step > 1) | (doc[1:] != doc[:-1])) + 1)
    end = np.append(begin[1:], len(line))
    several = line[begin] != line[end - 1]
    head, tail = np.append(head, begin[several]), np.append(tail, end[several])
    order = np.lexsort((tail, head))
    return head[order], tail[order]


def _keys(words: np.ndarray, head: np.ndarray, tail: np.ndarray, settings: ParagraphSettings) -> tuple[np.ndarray, np.ndarray]:
    """Bucket keys of the paragraphs [head, tail), one after the other, and how many each has: the bands, or one of all words if there are few."""
    size = tail - head
    least = max(settings.min_words, settings.shingle_words)
    count = np.where(size >= least, settings.bands, 1)
    begin = np.cumsum(count) - count
    out = np.empty(int(count.sum()), dtype=np.int64)
    long = np.flatnonzero(size >= least)
    out[begin[long][:, None] + np.arange(settings.bands)] = _bands(words, head[long], tail[long], settings)
    for width in range(1, least):
        short = np.flatnonzero(size == width)
        if len(short):
            out[begin[short]] = mix64(shingle_hashes(words, width)[head[short]] + np.uint64(width)).astype(np.int64)
    return out, count


def _bands(words: np.ndarray, head: np.ndarray, tail: np.ndarray, settings: ParagraphSettings) -> np.ndarray:
    """Band keys of the paragraphs [head, tail), one row each."""
    if not len(head):
        return np.zeros((0, settings.bands), dtype=np.int64)
    counts = tail - head - settings.shingle_words + 1
    begin = np.cumsum(counts) - counts
    index = np.repeat(head - begin, counts) + np.arange(int(counts.sum()))
    keys = shingle_hashes(words, settings.shingle_words)[index]
    values = MinHasher(settings.bands * settings.band_rows, settings.seed).signatures(keys, np.append(begin, len(keys)))
    grouped = values.reshape(len(head), settings.bands, settings.band_rows).astype(np.uint64)
    packed = np.tile(np.arange(settings.bands, dtype=np.uint64), (len(head), 1))
    for row in range(settings.band_rows):
        packed = mix64(packed * np.uint64(1 << 16 | 1) + grouped[:, :, row] + np.uint64(row + 1))
    return packed.astype(np.int64)


#: Bytes of a word around a passage.
WORD_BYTES = 4


def _details(texts: list[bytes], owner: np.ndarray, passage: np.ndarray, first: np.ndarray, end: np.ndarray, settings: ParagraphSettings) -> list[tuple[np.ndarray, np.ndarray]]:
    """For paragraphs their distinct n-grams; for passages the words before and after.

    Each of the three as one array for all units, and the length of each unit's part. Words
    around come nearest first, as 32 bits of their hashes (``WORD_BYTES``): a shared run goes on for less
    than ``spacing`` words beyond its outermost anchors.
    """
    _, _, words, begin, _ = _layout(texts)
    shingles = shingle_hashes(words, settings.shingle_words)
    short = (words >> np.uint64(32)).astype(np.uint32).view(np.int32)
    around = settings.spacing - 1
    low, high = begin[owner] + first, begin[owner] + end
    grams = [np.unique(shingles[a : b - settings.shingle_words + 1]).astype(np.int64) for a, b in zip(low[~passage].tolist(), high[~passage].tolist())]
    sizes = np.zeros(len(owner), dtype=np.int64)
    sizes[~passage] = [len(g) for g in grams]
    before = np.where(passage, np.minimum(low - begin[owner], around), 0)
    after = np.where(passage, np.minimum(begin[owner + 1] - high, around), 0)

    def places(start: np.ndarray, count: np.ndarray, step: int) -> np.ndarray:
        along = np.arange(int(count.sum())) - np.repeat(np.cumsum(count) - count, count)
        return np.repeat(start, count) + step * along

    return [
        (np.concatenate(grams) if grams else np.zeros(0, dtype=np.int64), sizes),
        (short[places(low - 1, before, -1)], before),
        (short[places(high, after, 1)], after),
    ]


def _unit_columns(text, settings: ParagraphSettings):
    @F.arrow_udf(UNITS)
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            texts = [value or b"" for value in batch.to_pylist()]
            made = [_units(texts[first:end], settings) for first, end in blocks(texts)]
            yield pa.concat_arrays(made) if made else pa.array([], _UNIT_KIND)

    return run.asNondeterministic()(text.cast("binary"))


def _detail_columns(text, units, settings: ParagraphSettings):
    asked = F.transform(units, lambda u: F.struct(u["kind"].alias("kind"), u["first"].alias("first"), u["end"].alias("end")))

    def packed(parts: list[tuple[np.ndarray, np.ndarray]]) -> pa.Array:
        """One binary value a unit: tables and shuffles copy it whole, where a list goes number by number."""
        flat = np.concatenate([flat for flat, _ in parts])
        ends = np.cumsum(np.concatenate([[0], *(sizes for _, sizes in parts)])) * flat.itemsize
        return pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(ends) - 1, [None, pa.py_buffer(ends.astype(np.int64)), pa.py_buffer(flat)]).cast(pa.binary())

    @F.arrow_udf("array<struct<grams:binary,before:binary,after:binary>>")
    def run(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for body, unit in batches:
            texts, flat = body.to_pylist(), unit.flatten()
            counts = unit.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
            bounds = np.append(0, np.cumsum(counts))
            passage = np.array(flat.field("kind").to_pylist(), dtype=object) == "passage"
            first, end = (flat.field(n).to_numpy(zero_copy_only=False).astype(np.int64) for n in ("first", "end"))
            made = [[], [], []]
            for a, b in blocks(texts):
                own = slice(bounds[a], bounds[b])
                found = _details(texts[a:b], np.repeat(np.arange(b - a), counts[a:b]), passage[own], first[own], end[own], settings)
                for held, part in zip(made, found):
                    held.append(part)
            details = pa.StructArray.from_arrays([packed(parts) for parts in made], ["grams", "before", "after"])
            yield pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), details)

    return run.asNondeterministic()(text.cast("binary"), asked)


def _compare(batches: Iterator[pa.RecordBatch], settings: ParagraphSettings) -> Iterator[pa.RecordBatch]:
    """Links of a spanning forest over the paragraphs whose n-gram sets are similar enough.

    Pairs that links found before already join are not compared: they cannot change the forest.
    """
    for table, sets in whole_groups(batches, "bucket"):
        member, own = table.column("unit").to_numpy(), table.column("own").to_numpy()
        across = table.column("left").to_numpy() != table.column("right").to_numpy()
        grams = [np.frombuffer(g, dtype="<i8") for g in table.column("grams").to_pylist()]
        size, labels = np.array([len(g) for g in grams]), np.arange(len(grams))
        for distance in range(1, int(np.bincount(sets).max())):
            first = pairs_at(distance, sets, across, own)
            small, large = np.minimum(size[first], size[first + distance]), np.maximum(size[first], size[first + distance])
            first = first[(small >= settings.threshold * large) & (labels[first] != labels[first + distance])]
            linked = [i for i in first.tolist() if _similar(grams[i], grams[i + distance], settings.threshold)]
            if linked:
                found = np.array(linked)
                labels = forest_labels(len(labels), labels[found], labels[found + distance])[labels]
        moved = np.flatnonzero(labels != np.arange(len(labels)))
        if len(moved):
            yield pa.RecordBatch.from_arrays([pa.array(member[moved]), pa.array(member[labels[moved]])], ["u", "v"])


def _similar(a: np.ndarray, b: np.ndarray, threshold: float) -> bool:
    shared = len(np.intersect1d(a, b, assume_unique=True))
    return shared >= threshold * (len(a) + len(b) - shared)


SAME = ["row", "kept_row", "shift"]
#: What is known of the first or last passage of a run.
RUN = ["kept_unit", "kept_row", "kept_key", "shift", "run", "opens", "closes"]


def _along():
    """The passages of a text that equal one kept text at one distance, in order."""
    return Window.partitionBy(*SAME).orderBy("first", "end")


def _run_ends(again: DataFrame) -> DataFrame:
    """First and last passages of the runs that equal the kept row ``shift`` words earlier.

    Passages that overlap at the same shift are one run; inside it the words around are
    those of the neighbours.
    """
    ends = again.withColumn("opens", F.coalesce(F.lag("end").over(_along()) < F.col("first"), F.lit(True))).withColumn("closes", F.coalesce(F.lead("first").over(_along()) > F.col("end"), F.lit(True)))
    return ends.withColumn("run", F.sum(F.col("opens").cast("int")).over(_along())).filter("opens or closes")


def _with_equal(rows: DataFrame, name: str, left: str, right: str, most: int) -> DataFrame:
    """Add how many of the first words of ``left`` and ``right``, at most ``most`` each, are equal.

    Halves are compared, then halves of what is left, as slices of the packed words.
    """
    step = 1 << most.bit_length() >> 1
    rows = rows.withColumn(name, F.lit(0))
    while step:
        at, size = F.col(name) * WORD_BYTES + 1, F.lit(step * WORD_BYTES)
        same = F.substring(left, at, size) == F.substring(right, at, size)
        rows = rows.withColumn(name, F.col(name) + F.when(same, step).otherwise(0))
        step >>= 1
    # Two that end together are equal beyond their ends.
    return rows.withColumn(name, F.least(name, *((F.octet_length(side) / WORD_BYTES).cast("int") for side in (left, right))))


def _runs(own: DataFrame, kept: DataFrame, n_ends: int, around: int) -> DataFrame:
    """Repeated passages as runs, as long as they go.

    The first and last passage of a run (``own``, with the at most ``around`` words around) are prolonged by
    the words around the kept one that equal them, and runs that then meet are one.
    """
    asked = own.groupBy("kept_unit").agg(F.count(F.lit(1)).alias("asked"))
    other = kept.select(F.col("unit").alias("kept_unit"), F.col("before").alias("kept_before"), F.col("after").alias("kept_after")).join(asked, "kept_unit")
    both = attach(own, other, ["kept_unit"], "asked", n_ends)
    longer = _with_equal(_with_equal(both, "equal_before", "before", "kept_before", around), "equal_after", "after", "kept_after", around).select(
        *SAME, "run", "key", "kept_key", (F.col("first") - F.when(F.col("opens"), F.col("equal_before")).otherwise(0)).alias("first"),
        (F.col("end") + F.when(F.col("closes"), F.col("equal_after")).otherwise(0)).alias("end"),
    )

    def joined(rows: DataFrame) -> DataFrame:
        return rows.groupBy(*SAME, "run").agg(F.first("key").alias("key"), F.first("kept_key").alias("kept_key"), F.min("first").alias("first"), F.max("end").alias("end"))

    reached = F.max("end").over(_along().rowsBetween(Window.unboundedPreceding, -1))
    numbered = joined(longer).withColumn("fresh", F.coalesce(reached < F.col("first"), F.lit(True))).withColumn("run", F.sum(F.col("fresh").cast("int")).over(_along()))
    return joined(numbered).drop("run")


def repeated_units(docs: DataFrame, settings: ParagraphSettings = ParagraphSettings(), key: str = "doc_id", text: str = "text") -> DataFrame:
    """Every unit that occurs more than once, in its text: where it stands and what becomes of it.

    Columns: key, kind (text, paragraph or passage), first_word, end_word, kept_key,
    kept_first_word, removed. The kept unit of a cluster is the one of least key, then
    of least place; it has a row too, not removed. A passage is as long as it equals the
    kept text at the same distance, and has a row for each kept text; the kept side has
    a row for each different extent. Copies of a whole text have one row of
    kind text each. A text without repeats has no row.
    """
    same = F.unhex(F.md5(F.col(text).cast("binary")))
    rows = materialize(
        docs.filter(F.col(text).isNotNull()).select(
            F.monotonically_increasing_id().alias("row"), F.col(key).alias("key"), same.alias("same"), _unit_columns(F.col(text), settings).alias("u")
        ).filter("u.n_words > 0"),
        "paragraph-units",
    )
    made = [rows]

    def kept_table(frame: DataFrame, label: str) -> DataFrame:
        made.append(materialize(frame, label))
        return made[-1]

    def dropped(*tables: DataFrame) -> None:
        for table in tables:
            made[:] = [m for m in made if m is not table]
            drop_table(table)

    order = F.struct(F.col("key").isNull().alias("none"), "key", "row")
    chosen = rows.groupBy("same").agg(F.min(order).alias("o"), F.count(F.lit(1)).alias("copies")).filter("copies > 1")
    chosen = kept_table(chosen.select("same", F.col("o.row").alias("kept_row"), F.col("o.key").alias("kept_key"), "copies"), "paragraph-texts")
    n_copies = chosen.agg(F.coalesce(F.sum("copies"), F.lit(0))).first()[0]
    copies = kept_table(attach(rows.select("row", "key", "same", "u.n_words"), chosen, ["same"], "copies", n_copies).drop("same", "copies"), "paragraph-copies")
    single = rows.join(copies.filter("row <> kept_row").select("row"), "row", "left_anti")

    # A unit is its text's row and a slot: the number of a passage key, or -1 less the
    # number of a paragraph. Rows this narrow are what the two large shuffles carry.
    passage = single.select("row", F.posexplode(F.arrays_zip("u.passage_key", "u.passage_n")).alias("at", "p")).select(
        "row", F.col("at").cast("bigint").alias("slot"), F.xxhash64("p.passage_key", F.lit("passage")).alias("bucket"), F.col("p.passage_n").alias("n")
    )
    band = single.select("row", F.posexplode("u.par_bands").alias("at", "buckets"))
    paragraph = band.select("row", (-1 - F.col("at")).cast("bigint").alias("slot"), F.explode("buckets").alias("bucket"), F.lit(1).alias("n"))
    units = passage.unionAll(paragraph)
    shared = kept_table(units.groupBy("bucket").agg(F.sum("n").alias("size")).filter("size > 1"), "paragraph-shared")
    n_shared = shared.agg(F.coalesce(F.sum("size"), F.lit(0))).first()[0]
    live = kept_table(attach(units.drop("n"), shared, ["bucket"], "size", n_shared).groupBy("row", "slot").agg(F.collect_list("bucket").alias("buckets")), "paragraph-live")

    def placed(unit):
        number = (-1 - unit["slot"]).cast("int")
        one = F.array(
            F.struct(
                F.lit("paragraph").alias("kind"), F.get("par_first", number).alias("first"), F.get("par_end", number).alias("end"), unit["buckets"].alias("buckets"),
                F.get("par_high", number).alias("high"), F.get("par_low", number).alias("low"),
            )
        )
        key = unit["slot"].cast("int")
        places = F.transform(
            F.slice("passage_first", F.get("passage_at", key) + 1, F.get("passage_n", key)),
            lambda p: F.struct(
                F.lit("passage").alias("kind"), p.alias("first"), (p + settings.passage_words).alias("end"), F.lit(None).cast("array<bigint>").alias("buckets"),
                F.get("passage_key", key).alias("high"), F.get("passage_check", key).alias("low"),
            ),
        )
        return F.when(unit["slot"] < 0, one).otherwise(places)

    asked = live.groupBy("row").agg(F.collect_list(F.struct("slot", "buckets")).alias("slots")).join(rows.select("row", "key", "u.*"), "row")
    verified = asked.select("row", "key", F.explode(F.flatten(F.transform("slots", placed))).alias("x")).select(F.monotonically_increasing_id().alias("unit"), "row", "key", "x.*")
    verified = kept_table(verified, "paragraph-units-placed")
    keys = kept_table(rows.select("row", F.col("key").alias("key_"), F.col("same").alias("same_")), "paragraph-keys")
    dropped(live, shared, rows)

    place = F.struct(F.col("key").isNull().alias("none"), "key", "row", "first", "end", "unit")
    contents = kept_table(verified.groupBy("kind", "high", "low").agg(F.min("unit").alias("unit"), F.count(F.lit(1)).alias("n"), F.min(place).alias("kept")), "paragraph-contents")
    total = verified.count()

    # Passages: equal ones are repeats.
    repeated = contents.filter("kind = 'passage' and n > 1").select("high", "low", "n", "kept")
    again = attach(verified.filter("kind = 'passage'").drop("buckets"), repeated, ["high", "low"], "n", total).filter(F.col("unit") != F.col("kept.unit")).select(
        "row", "key", "unit", "first", "end", F.col("kept.row").alias("kept_row"), F.col("kept.key").alias("kept_key"), F.col("kept.unit").alias("kept_unit"), (F.col("first") - F.col("kept.first")).alias("shift")
    )
    ends = kept_table(_run_ends(again), "paragraph-run-ends")

    # Paragraphs: one of each content, in the buckets that several contents share.
    least = max(settings.min_words, settings.shingle_words)
    banded = verified.filter((F.col("kind") == "paragraph") & (F.col("end") - F.col("first") >= least)).select("unit", "buckets").join(contents.filter("kind = 'paragraph'").select("unit"), "unit", "left_semi")
    banded = kept_table(banded, "paragraph-banded")
    # Buckets of the same members are one: the n-grams are sent there once.
    members = banded.select("unit", F.explode("buckets").alias("bucket")).groupBy("bucket").agg(
        F.count(F.lit(1)).alias("size"), F.bit_xor(F.xxhash64("unit")).alias("a"), F.bit_xor(F.xxhash64("unit", F.lit("again"))).alias("b")
    )
    sizes = kept_table(members.filter("size > 1").groupBy("size", "a", "b").agg(F.min("bucket").alias("bucket")).select("bucket", "size"), "paragraph-buckets")
    n_sizes = sizes.agg(F.coalesce(F.sum("size"), F.lit(0))).first()[0]
    asked_units = kept_table(attach(banded.select("unit", F.explode("buckets").alias("bucket")), sizes, ["bucket"], "size", n_sizes), "paragraph-candidates")
    dropped(banded)

    # The texts are read once more, for the n-grams of candidates and the words around the ends
    # of runs and the passages that they equal.
    nothing = F.lit(None).cast(ends.select(*RUN).schema).alias("run_end")
    candidates = verified.select("unit", "row", "kind", "first", "end").join(asked_units.select("unit").distinct(), "unit").select("row", "unit", "kind", "first", "end", nothing)
    passage_kind, kept_first = F.lit("passage").alias("kind"), F.col("first") - F.col("shift")
    equal_to = ends.select(F.col("kept_row").alias("row"), F.col("kept_unit").alias("unit"), passage_kind, kept_first.alias("first"), (kept_first + settings.passage_words).alias("end")).distinct()
    own_ends = ends.select("row", "unit", passage_kind, "first", "end", F.struct(*RUN).alias("run_end"))
    wanted = candidates.unionAll(equal_to.select("row", "unit", "kind", "first", "end", nothing)).unionAll(own_ends)
    requests = wanted.groupBy("row").agg(F.collect_list(F.struct("unit", "kind", "first", "end", "run_end")).alias("units")).join(keys, "row")
    requests = kept_table(requests, "paragraph-requests")
    paragraphs = kept_table(verified.filter("kind = 'paragraph'").drop("buckets"), "paragraph-members")
    n_ends = ends.count()
    dropped(ends, verified)
    bodies = docs.select(F.col(key).alias("key"), same.alias("same"), F.col(text).alias("body"))
    found = bodies.join(requests, (F.col("same") == F.col("same_")) & F.col("key").eqNullSafe(F.col("key_"))).dropDuplicates(["same", "key"])
    details = found.select("row", "key", "units", _detail_columns(F.col("body"), F.col("units"), settings).alias("details")).select("row", "key", F.explode(F.arrays_zip("units", "details")).alias("x"))
    details = kept_table(details.select("row", "key", "x.units.*", "x.details.grams", "x.details.before", "x.details.after"), "paragraph-details")
    dropped(requests)
    own_ends = details.filter("run_end is not null").select("row", "key", "first", "end", "run_end.*", "before", "after")
    runs = kept_table(_runs(own_ends, details.filter("kind = 'passage' and run_end is null").select("unit", "before", "after"), n_ends, settings.spacing - 1), "paragraph-runs")
    grams = kept_table(details.filter("kind = 'paragraph'").select("unit", "grams"), "paragraph-grams")
    dropped(details)

    met = meet(grams.join(asked_units, "unit"), "bucket", "size", "unit")
    linked = connected_components(met, "paragraph-clusters", lambda b: _compare(b, settings))
    linked = kept_table(linked.select(F.col("node").alias("unit"), "component"), "paragraph-linked")
    by_cluster = contents.filter("kind = 'paragraph'").join(linked, "unit", "left").select("high", "low", "n", "kept", F.coalesce("component", "unit").alias("cluster"))
    clusters = by_cluster.groupBy("cluster").agg(F.sum("n").alias("copies"), F.count(F.lit(1)).alias("members"), F.min("kept").alias("kept")).filter("copies > 1")
    clusters = kept_table(attach(by_cluster.drop("kept"), clusters, ["cluster"], "members", total).select("high", "low", "n", "kept"), "paragraph-repeats")

    # A line and the paragraph around it can be similar: neither is a repeat of the other.
    nested = (F.col("first") < F.col("kept.end")) & (F.col("end") > F.col("kept.first"))
    spans = attach(paragraphs, clusters, ["high", "low"], "n", total).select(
        F.col("key").alias(key), "kind", F.col("first").alias("first_word"), F.col("end").alias("end_word"), F.col("kept.key").alias("kept_key"), F.col("kept.first").alias("kept_first_word"),
        ((F.col("row") != F.col("kept.row")) | ((F.col("first") != F.col("kept.first")) & ~nested)).alias("removed"),
    )
    passages = runs.select(
        F.col("key").alias(key), F.lit("passage").alias("kind"), F.col("first").alias("first_word"), F.col("end").alias("end_word"), "kept_key", (F.col("first") - F.col("shift")).alias("kept_first_word"), F.lit(True).alias("removed"),
    )
    kept = runs.select("kept_row", "kept_key", (F.col("first") - F.col("shift")).alias("first"), (F.col("end") - F.col("shift")).alias("end")).distinct().select(
        F.col("kept_key").alias(key), F.lit("passage").alias("kind"), F.col("first").alias("first_word"), F.col("end").alias("end_word"), "kept_key", F.col("first").alias("kept_first_word"), F.lit(False).alias("removed"),
    )
    texts = copies.select(
        F.col("key").alias(key), F.lit("text").alias("kind"), F.lit(0).alias("first_word"), F.col("n_words").alias("end_word"), "kept_key", F.lit(0).alias("kept_first_word"), (F.col("row") != F.col("kept_row")).alias("removed"),
    )
    result = materialize(spans.unionByName(passages).unionByName(kept).unionByName(texts), "paragraph-result")
    dropped(*made)
    return result
