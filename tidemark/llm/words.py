"""Words of many texts at once, as positions and 64-bit hashes in numpy arrays."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

_MASK = 0xFFFFFFFFFFFFFFFF
_BASE = 0x9E3779B97F4A7C15 | 1
#: Any odd multipliers do; they only have to stay the same on all executors.
_MIX = (np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB))
WHITESPACE = b" \t\n\x0b\x0c\r"
BLOCK_BYTES = 1 << 20


def mix64(values: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit over all others."""
    x = values.copy()
    x ^= x >> np.uint64(30)
    x *= _MIX[0]
    x ^= x >> np.uint64(27)
    x *= _MIX[1]
    x ^= x >> np.uint64(31)
    return x


def _powers(base: int, count: int) -> np.ndarray:
    out = np.full(count, np.uint64(base & _MASK))
    out[0] = 1
    return np.multiply.accumulate(out)


_BYTE_CODE = mix64(np.arange(1, 257, dtype=np.uint64))
_tables: dict[str, np.ndarray] = {}


def _power_tables(count: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_tables.get("up", ())) < count:
        size = max(count, BLOCK_BYTES + 1)
        _tables["up"] = _powers(_BASE, size)
        _tables["down"] = _powers(pow(_BASE, -1, 1 << 64), size)
    return _tables["up"], _tables["down"]


def blocks(texts: list[bytes], limit: int = BLOCK_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of consecutive texts of about ``limit`` bytes together, none split."""
    first, held = 0, 0
    for i, text in enumerate(texts):
        if held and held + len(text) > limit:
            yield first, i
            first, held = i, 0
        held += len(text) + 1
    if first < len(texts):
        yield first, len(texts)


def join_texts(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """All bytes with a line feed after each text, and where each text starts."""
    data = np.frombuffer(b"\n".join([*texts, b""]), dtype=np.uint8)
    starts = np.zeros(len(texts) + 1, dtype=np.int64)
    np.cumsum([len(t) + 1 for t in texts], out=starts[1:])
    return data, starts


_IS_WORD = np.ones(256, dtype=bool)
_IS_WORD[list(WHITESPACE)] = False
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def word_spans(data: np.ndarray, is_word: np.ndarray = _IS_WORD) -> tuple[np.ndarray, np.ndarray]:
    """Byte ranges of the maximal runs of word bytes."""
    inside = np.zeros(len(data) + 2, dtype=np.int8)
    inside[1:-1] = is_word[data]
    edges = np.diff(inside)
    return np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, lower: bool = True) -> np.ndarray:
    """A 64-bit hash of the bytes of each range; A-Z count as a-z if ``lower``."""
    up, down = _power_tables(len(data) + 1)
    codes = _BYTE_CODE[_LOWER] if lower else _BYTE_CODE
    sums = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum(codes[data] * up[: len(data)], out=sums[1:])
    return mix64((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64))


def shingle_hashes(words: np.ndarray, width: int) -> np.ndarray:
    """Hashes of all runs of ``width`` words; those that cross two texts are the caller's to skip."""
    total = np.zeros(max(len(words) - width + 1, 0), dtype=np.uint64)
    for power, offset in zip(_powers(_BASE ^ 0x5BD1E995A5A5A5A4, width), range(width)):
        total += words[offset : offset + len(total)] * power
    return mix64(total)


def raw_shingles(texts: list[bytes], width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Shingle hashes of each text, repeats included, text by text.

    Returns hashes and where each text's begin, then word hashes and where each text's
    begin (one more entry than texts). A text of fewer words than ``width`` but not none
    has one shingle of all its words; one without words has none. A-Z count as a-z.
    """
    data, at = join_texts(texts)
    starts, ends = word_spans(data)
    words = span_hashes(data, starts, ends)
    first = np.searchsorted(starts, at)
    counts = np.diff(first)
    shingles = shingle_hashes(words, width)
    owner = np.repeat(np.arange(len(texts)), counts)
    begin = owner[: len(shingles)]
    whole = begin == owner[width - 1 :] if len(shingles) else np.zeros(0, dtype=bool)
    keys, docs = shingles[whole], begin[whole]
    short = np.flatnonzero((counts > 0) & (counts < width))
    if len(short):
        own = [_short_key(words[first[i] : first[i + 1]]) for i in short]
        place = np.searchsorted(docs, short)
        keys, docs = np.insert(keys, place, np.array(own, dtype=np.uint64)), np.insert(docs, place, short)
    return keys, np.searchsorted(docs, np.arange(len(texts) + 1)), words, first


def doc_shingles(texts: list[bytes], width: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of each text, text by text, and where each text's begin."""
    keys, first, _, _ = raw_shingles(texts, width)
    docs = np.repeat(np.arange(len(texts)), np.diff(first))
    order = np.lexsort((keys, docs))
    keys, docs = keys[order], docs[order]
    fresh = np.ones(len(keys), dtype=bool)
    fresh[1:] = (keys[1:] != keys[:-1]) | (docs[1:] != docs[:-1])
    keys, docs = keys[fresh], docs[fresh]
    return keys, np.searchsorted(docs, np.arange(len(texts) + 1))


class MinHasher:
    """16 bits of each of ``size`` MinHash values per set of 64-bit hashes."""

    def __init__(self, size: int, seed: int):
        draw = np.random.default_rng(seed)
        self.flips = draw.integers(0, 1 << 32, size, dtype=np.uint32)
        self.factors = draw.integers(0, 1 << 31, size, dtype=np.uint32) * np.uint32(2) + np.uint32(1)

    def signatures(self, keys: np.ndarray, first: np.ndarray) -> np.ndarray:
        """One row per set; rows of empty sets are zero."""
        out = np.zeros((len(first) - 1, len(self.flips)), dtype=np.uint16)
        some = np.flatnonzero(np.diff(first) > 0)
        if len(some):
            base, starts = (keys >> np.uint64(32)).astype(np.uint32), first[some]
            for k, (flip, factor) in enumerate(zip(self.flips, self.factors)):
                out[some, k] = np.minimum.reduceat((base ^ flip) * factor, starts).astype(np.uint16)
        return out


def _short_key(words: np.ndarray) -> int:
    key = len(words)
    for word in words.tolist():
        key = (key * _BASE + word) & _MASK
    return int(mix64(np.array([key], dtype=np.uint64))[0])
