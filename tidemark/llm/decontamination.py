"""Benchmark passages found in training texts by binary search in suffix arrays.

Each task cuts its training texts into shards and sorts the suffixes of a shard. Every
test suffix (13 words, or the whole of a shorter item) is then looked up by binary
search, which gives all its verbatim occurrences and their places. Suffixes that begin
with a word pair that no test item has, or are cut short by one, cannot match and are
left out of the sort; this drops no match.

Words are runs of ASCII letters, ASCII digits and non-ASCII characters, A-Z as a-z. Null
texts have no words; test items without words are left out, those with a null id count
like the others but have no name to be listed by. Test items are sent to the tasks in blocks of a bounded size, each block looked up in all texts and its
result written before the next block is collected.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.words import blocks
from tidemark.llm.workspace import drop_table, materialize

WINDOW = 13
#: Bytes of test text that a task holds at once.
ITEM_BLOCK_BYTES = 16 << 20
SHARD_BYTES = 4 << 20
_PAIR_BITS = 22
FOUND = "struct<n_words:bigint,spans:array<struct<first:int,end:int>>,items:array<string>,longest_words:int,longest_first:int,longest_item:string>"

_FOLD = bytearray(b" " * 128) + bytearray(range(128, 256))
for _low in b"0123456789abcdefghijklmnopqrstuvwxyz":
    _FOLD[_low] = _low
for _high in range(65, 91):
    _FOLD[_high] = _high + 32
_FOLD = bytes(_FOLD)


def words_of(text: bytes) -> list[bytes]:
    return text.translate(_FOLD).split()


@dataclass
class TestSuffixes:
    """Distinct test suffixes by length, and the items and places each comes from."""

    vocabulary: dict[bytes, int]
    pairs: np.ndarray
    keys: dict[int, np.ndarray] = field(default_factory=dict)
    offsets: dict[int, np.ndarray] = field(default_factory=dict)
    item: dict[int, np.ndarray] = field(default_factory=dict)
    place: dict[int, np.ndarray] = field(default_factory=dict)
    first_words: dict[int, np.ndarray] = field(default_factory=dict)
    names: list[str | None] = field(default_factory=list)


def _pair_slot(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    mixed = (left.astype(np.uint64) << np.uint64(32) | right.astype(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
    return mixed >> np.uint64(64 - _PAIR_BITS)


def _keys(ids: np.ndarray, starts: np.ndarray, length: int) -> np.ndarray:
    """Suffixes cut to ``length`` words as byte strings that compare as the words' numbers do."""
    rows = ids[starts[:, None] + np.arange(length)].astype(">u4")
    return np.ascontiguousarray(rows).view(f"S{4 * length}").ravel()


def index_items(items: list[tuple[str | None, bytes]], window: int = WINDOW) -> TestSuffixes:
    vocabulary: dict[bytes, int] = {}
    texts = [(name, [vocabulary.setdefault(w, len(vocabulary) + 1) for w in words_of(text)]) for name, text in items]
    texts = [(name, np.array(ids, dtype=np.int64)) for name, ids in texts if ids]
    index = TestSuffixes(vocabulary, np.zeros(1 << _PAIR_BITS, dtype=bool), names=[name for name, _ in texts])
    for _, ids in texts:
        index.pairs[_pair_slot(ids[:-1], ids[1:])] = True
    for length in sorted({min(window, len(ids)) for _, ids in texts}):
        keys, item, place = [], [], []
        for number, (_, ids) in enumerate(texts):
            if min(window, len(ids)) == length:
                starts = np.arange(len(ids) - length + 1)
                keys.append(_keys(ids, starts, length))
                item.append(np.full(len(starts), number))
                place.append(starts)
        flat, order = np.unique(np.concatenate(keys), return_inverse=True)
        by_key = np.argsort(order, kind="stable")
        index.keys[length] = flat
        index.offsets[length] = np.searchsorted(order[by_key], np.arange(len(flat) + 1))
        index.item[length] = np.concatenate(item)[by_key]
        index.place[length] = np.concatenate(place)[by_key]
        index.first_words[length] = np.unique(np.array([ids[0] for _, ids in texts if min(window, len(ids)) == length]))
    return index


def _search(shard: list[bytes], index: TestSuffixes) -> list[dict]:
    split = [words_of(text) for text in shard]
    lengths = np.array([len(words) for words in split], dtype=np.int64)
    known = index.vocabulary.get
    ids = np.fromiter((known(word, 0) for words in split for word in words), np.int64, int(lengths.sum()))
    ends = np.cumsum(lengths)
    n = len(ids)
    doc = np.repeat(np.arange(len(shard)), lengths)
    # How many words from here on lie in one text and form word pairs that test items have.
    linked = np.zeros(n, dtype=bool)
    if n > 1:
        linked[:-1] = (ids[:-1] > 0) & (ids[1:] > 0) & (doc[:-1] == doc[1:])
        at = np.flatnonzero(linked)
        linked[at] = index.pairs[_pair_slot(ids[at], ids[at + 1])]
    breaks = np.flatnonzero(~linked)
    reach = breaks[np.searchsorted(breaks, np.arange(n))] - np.arange(n) + 1 if n else np.zeros(0, dtype=np.int64)
    change = np.zeros(n + 1, dtype=np.int64)
    found: list[tuple[np.ndarray, np.ndarray, np.ndarray, int]] = []
    for length, tests in index.keys.items():
        starts = np.flatnonzero((reach >= length) & (ids > 0))
        if length < WINDOW:
            starts = starts[np.isin(ids[starts], index.first_words[length])]
        if not len(starts):
            continue
        suffixes = _keys(ids, starts, length)
        order = np.argsort(suffixes)
        array = suffixes[order]
        low, high = np.searchsorted(array, tests, "left"), np.searchsorted(array, tests, "right")
        for test in np.flatnonzero(high > low).tolist():
            places = starts[order[low[test] : high[test]]]
            np.add.at(change, places, 1)
            np.add.at(change, places + length, -1)
            own = slice(index.offsets[length][test], index.offsets[length][test + 1])
            items, begins = index.item[length][own], index.place[length][own]
            found.append((np.repeat(places, len(items)), np.tile(items, len(places)), np.tile(begins, len(places)), length))
    return _by_text(found, np.cumsum(change[:-1]) > 0, doc, ends, lengths, index.names)


def _by_text(found, hit, doc, ends, lengths, names) -> list[dict]:
    begin = ends - lengths
    out = [
        {"n_words": n, "spans": [], "items": [], "longest_words": 0, "longest_first": None, "longest_item": None}
        for n in lengths.tolist()
    ]
    if not found:
        return out
    edge = np.diff(np.concatenate([[0], hit.view(np.int8), [0]]))
    # Spans end at each text's end: neighbours may both be hit at the border.
    border = np.unique(np.concatenate([np.flatnonzero(edge == 1), begin[(lengths > 0)][hit[begin[lengths > 0]]]]))
    stop = np.unique(np.concatenate([np.flatnonzero(edge == -1), ends[lengths > 0][hit[ends[lengths > 0] - 1]]]))
    for a, b in zip(border.tolist(), stop.tolist()):
        own = int(doc[a])
        out[own]["spans"].append({"first": a - int(begin[own]), "end": b - int(begin[own])})
    place = np.concatenate([f[0] for f in found])
    item = np.concatenate([f[1] for f in found])
    shift = place - np.concatenate([f[2] for f in found])
    size = np.concatenate([np.full(len(f[0]), f[3]) for f in found])
    # Occurrences that go on word by word in text and item are one longer match.
    order = np.lexsort((place, shift, item))
    place, item, shift, size = place[order], item[order], shift[order], size[order]
    fresh = np.ones(len(place), dtype=bool)
    fresh[1:] = (item[1:] != item[:-1]) | (shift[1:] != shift[:-1]) | (place[1:] != place[:-1] + 1) | (doc[place[1:]] != doc[place[:-1]])
    heads = np.flatnonzero(fresh)
    long = np.diff(np.append(heads, len(place))) - 1 + size[heads]
    for head, words in zip(heads.tolist(), long.tolist()):
        own = out[int(doc[place[head]])]
        name, first = names[item[head]], int(place[head] - begin[doc[place[head]]])
        if name is not None:
            own["items"].append(name)
        if (-words, first, name or "") < (-own["longest_words"], own["longest_first"] or 0, own["longest_item"] or ""):
            own |= {"longest_words": words, "longest_first": first, "longest_item": name}
    for row in out:
        row["items"] = sorted(set(row["items"]))
    return out


def _lookup(text: Column, index) -> Column:
    span = pa.struct([("first", pa.int32()), ("end", pa.int32())])
    kind = pa.struct(
        [
            ("n_words", pa.int64()),
            ("spans", pa.list_(span)),
            ("items", pa.list_(pa.string())),
            ("longest_words", pa.int32()),
            ("longest_first", pa.int32()),
            ("longest_item", pa.string()),
        ]
    )

    @F.arrow_udf(FOUND)
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            texts = [value or b"" for value in batch.to_pylist()]
            rows: list[dict] = []
            for first, end in blocks(texts, SHARD_BYTES):
                rows += _search(texts[first:end], index.value)
            yield pa.array(rows, kind)

    return run.asNondeterministic()(text.cast("binary"))


def _merged(results: list[Column]) -> Column:
    """Results of several blocks of items on one text as one."""
    spans = F.array_sort(F.flatten(F.array(*[r["spans"] for r in results])))
    step = lambda done, s: F.when(
        (F.size(done) > 0) & (F.element_at(done, -1)["end"] >= s["first"]),
        F.concat(
            F.slice(done, 1, F.size(done) - 1),
            F.array(F.struct(F.element_at(done, -1)["first"].alias("first"), F.greatest(F.element_at(done, -1)["end"], s["end"]).alias("end"))),
        ),
    ).otherwise(F.concat(done, F.array(s)))
    best = F.element_at(
        F.array_sort(F.array(*[F.struct(-r["longest_words"], r["longest_first"], r["longest_item"], r["longest_words"]) for r in results])), 1
    )
    return F.struct(
        results[0]["n_words"].alias("n_words"),
        F.aggregate(spans, F.array().cast("array<struct<first:int,end:int>>"), step).alias("spans"),
        F.array_sort(F.array_distinct(F.flatten(F.array(*[r["items"] for r in results])))).alias("items"),
        best["longest_words"].alias("longest_words"),
        best["longest_first"].alias("longest_first"),
        best["longest_item"].alias("longest_item"),
    )


def with_matches(
    docs: DataFrame,
    benchmark: DataFrame,
    result: str,
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    block_bytes: int = ITEM_BLOCK_BYTES,
) -> DataFrame:
    """``docs`` with a struct column ``result``: word count, hit word spans, items, longest match.

    An input column of that name is replaced. Rows stay where they are: no shuffle. The
    benchmark is measured first and cut into blocks by a hash of the item's id and text, so
    that the part sent to the tasks stays near ``block_bytes``. With several blocks the
    rows and the result so far are written to the shared folder after each but the last,
    and the block's index is released: one is held at a time.
    """
    spark = docs.sparkSession
    items = benchmark.select(F.col(item_id).cast("string").alias("name"), F.col(item_text).cast("binary").alias("body"))
    items = items.filter("body is not null")
    total = items.agg(F.coalesce(F.sum(F.length("body")), F.lit(0))).first()[0]
    count = max(1, -(-total // block_bytes))
    if count > 1:
        items = items.dropDuplicates(["name", "body"])
    out, block, written = docs.drop(result), f"__block_{result}", None
    for number in range(count):
        own = items.filter(F.pmod(F.xxhash64("name", "body"), F.lit(count)) == number) if count > 1 else items
        index = spark.sparkContext.broadcast(index_items([(r.name, bytes(r.body)) for r in own.collect()]))
        out = out.withColumn(block if number else result, _lookup(F.col(text), index))
        if number:
            out = out.withColumn(result, _merged([F.col(result), F.col(block)])).drop(block)
        if number < count - 1:
            before, out = written, materialize(out, "decontamination-block")
            written = out
            index.destroy()
            if before is not None:
                drop_table(before)
    return out


def hit_words(found: Column) -> Column:
    """Number of words inside any occurrence of a test suffix."""
    return F.aggregate(found["spans"], F.lit(0).cast("bigint"), lambda total, s: total + s["end"] - s["first"])


def contaminated(found: Column, one_in: int = 20) -> Column:
    """Whether at least one word in ``one_in`` is hit."""
    hit = hit_words(found)
    return (hit > 0) & (hit * one_in >= found["n_words"])
