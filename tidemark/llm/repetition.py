"""Quality rules from repeats inside a text, found with suffix arrays over its words.

The suffixes of a text are ranked by prefix doubling, many texts at once. Neighbours in
rank order share the longest prefixes, so the longest common prefix with either
neighbour is the longest repeat that starts at a word. All occurrences of maximal
repeats of at least ``min_repeat_words`` words are united; a text is rejected if they
cover too large a part of it, or if one repeat is too long.

Words are maximal runs of characters other than space and U+0009 to U+000D. A null
text counts as empty. An empty text has no words and fails the base rules.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark.llm.words import WHITESPACE, blocks

_BITS = 20
_LOW = np.int64((1 << _BITS) - 1)
#: The characters that count as symbols.
SYMBOLS = b"#*$%&|<>"


@dataclass(frozen=True)
class RepetitionLimits:
    """What a text may hold at most, and at least.

    min_words: fewer words fail the base rules.
    max_repeat_word_pct: percentage of words in repeated windows of ``window_words``.
    min_repeat_words: shorter repeats do not count towards coverage.
    max_covered_pct: percentage of words inside counted repeats.
    max_longest_words: words of the longest repeat.
    """

    min_words: int = 50
    window_words: int = 3
    max_repeat_word_pct: int = 50
    min_repeat_words: int = 6
    max_covered_pct: int = 40
    max_longest_words: int = 100


VERDICT = (
    "struct<n_words:bigint,word_chars:bigint,n_symbols:bigint,n_dup_lines:bigint,n_repeat_words:bigint,"
    "base_failed:boolean,covered_words:bigint,longest_repeat_words:bigint,"
    "repeat_spans:array<struct<first:int,end:int>>,kept:boolean>"
)


def _relabel(group: np.ndarray, following: np.ndarray, where: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Order positions by (group, following) and split groups: positions, new ranks, whether still tied."""
    if len(where) and max(int(group.max()), int(following.max()), int(where.max())) > _LOW:
        order = np.lexsort((following, group))
        where, group, following = where[order], group[order], following[order]
    else:
        packed = np.sort((group << (2 * _BITS)) | (following << _BITS) | where)
        where, following, group = packed & _LOW, (packed >> _BITS) & _LOW, packed >> (2 * _BITS)
    n = len(where)
    new_group, new_part = np.ones(n, dtype=bool), np.ones(n + 1, dtype=bool)
    new_group[1:] = group[1:] != group[:-1]
    new_part[1:n] = new_group[1:] | (following[1:] != following[:-1])
    place = np.arange(n)
    part_start = np.maximum.accumulate(np.where(new_part[:n], place, 0))
    group_start = np.maximum.accumulate(np.where(new_group, place, 0))
    return where, group + part_start - group_start, ~(new_part[:n] & new_part[1:])


def longest_repeats(words: np.ndarray, text_end: np.ndarray) -> np.ndarray:
    """For each word, the length in words of the longest repeat within its text that starts there.

    words: word numbers of all texts in a row. text_end: where the text of each word ends.
    """
    n = len(words)
    best = np.zeros(n, dtype=np.int64)
    if not n:
        return best
    here = np.arange(n, dtype=np.int64)
    # Texts are kept apart by their end, numbered from 0, as the first part of the rank.
    text = np.zeros(n, dtype=np.int64)
    text[1:] = np.cumsum(text_end[1:] != text_end[:-1])
    where, ranked, tied = _relabel(text, words.astype(np.int64), here)
    base = np.empty(n, dtype=np.int64)
    # Ranks count within a text so far; its first word's place makes them unique.
    text_start = np.searchsorted(text, np.arange(text[-1] + 1))
    base[where] = ranked - text[where] + text_start[text[where]] + 1
    levels, step, open_ = [base], 1, where[tied]
    while len(open_):
        rank = levels[-1]
        after = open_ + step
        following = np.where(after < text_end[open_], rank[np.minimum(after, n - 1)], 0)
        where, ranked, tied = _relabel(rank[open_], following, open_)
        rank = rank.copy()
        rank[where] = ranked
        levels.append(rank)
        open_ = where[tied]
        step *= 2
    final = levels[-1]
    repeated = where_tied(levels[0])
    order = repeated[np.argsort(final[repeated])]
    left, right = order[:-1], order[1:]
    pair = levels[0][left] == levels[0][right]
    left, right = left[pair], right[pair]
    shared = np.zeros(len(left), dtype=np.int64)
    for k in range(len(levels) - 1, -1, -1):
        a, b = left + shared, right + shared
        inside = (a < text_end[left]) & (b < text_end[right])
        same = inside & (levels[k][np.minimum(a, n - 1)] == levels[k][np.minimum(b, n - 1)])
        shared[same] += 1 << k
    np.maximum.at(best, left, shared)
    np.maximum.at(best, right, shared)
    return best


def where_tied(ranks: np.ndarray) -> np.ndarray:
    """Positions whose rank occurs more than once."""
    return np.flatnonzero(np.bincount(ranks)[ranks] > 1)


def covered(repeats: np.ndarray, at_least: int) -> np.ndarray:
    """Which words lie inside a repeat of at least so many words."""
    starts = np.flatnonzero(repeats >= at_least)
    change = np.zeros(len(repeats) + 1, dtype=np.int64)
    np.add.at(change, starts, 1)
    np.add.at(change, starts + repeats[starts], -1)
    return np.cumsum(change[:-1]) > 0


def _spans(flags: np.ndarray) -> list[dict]:
    edges = np.diff(np.concatenate([[0], flags.view(np.int8), [0]]))
    ends = np.flatnonzero(edges == -1).tolist()
    return [{"first": a, "end": b} for a, b in zip(np.flatnonzero(edges == 1).tolist(), ends)]


def _repeated_lines(text: bytes) -> int:
    seen: set[bytes] = set()
    again = 0
    for line in text.split(b"\n"):
        if line in seen:
            again += 1
        elif line.strip(WHITESPACE):
            seen.add(line)
    return again


def _inspect(texts: list[bytes], limits: RepetitionLimits) -> list[dict]:
    numbers: dict[bytes, int] = {}
    split = [text.split() for text in texts]
    lengths = np.array([len(words) for words in split], dtype=np.int64)
    flat = np.fromiter(
        (numbers.setdefault(word, len(numbers)) for words in split for word in words), np.int64, int(lengths.sum())
    )
    ends = np.cumsum(lengths)
    repeats = longest_repeats(flat, np.repeat(ends, lengths))
    in_window = covered(repeats, limits.window_words)
    in_repeat = covered(repeats, limits.min_repeat_words)
    out = []
    for text, words, end in zip(texts, split, ends.tolist()):
        n = len(words)
        own = slice(end - n, end)
        n_repeat_words, n_covered = int(in_window[own].sum()), int(in_repeat[own].sum())
        longest = int(repeats[own].max()) if n else 0
        failed = n < limits.min_words or 100 * n_repeat_words > limits.max_repeat_word_pct * n
        out.append(
            {
                "n_words": n,
                "word_chars": len(b"".join(words).decode()),
                "n_symbols": len(text) - len(text.translate(None, SYMBOLS)),
                "n_dup_lines": _repeated_lines(text),
                "n_repeat_words": n_repeat_words,
                "base_failed": failed,
                "covered_words": n_covered,
                "longest_repeat_words": longest,
                "repeat_spans": _spans(in_repeat[own]) if n_covered else [],
                "kept": not failed
                and 100 * n_covered <= limits.max_covered_pct * n
                and longest <= limits.max_longest_words,
            }
        )
    return out


def repetition_verdict(text: Column, limits: RepetitionLimits = RepetitionLimits()) -> Column:
    """The verdict on each text as a struct; ``repeat_spans`` are word ranges, end exclusive.

    Works row by row, without a shuffle. Memory is bound by one block of texts, or by
    the longest text.
    """
    kind = _arrow_type()

    @F.arrow_udf(VERDICT)
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            texts = [value or b"" for value in batch.to_pylist()]
            rows: list[dict] = []
            for first, end in blocks(texts):
                rows += _inspect(texts[first:end], limits)
            yield pa.array(rows, kind)

    return run.asNondeterministic()(text.cast("binary"))


def _arrow_type() -> pa.DataType:
    counts = [(name, pa.int64()) for name in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")]
    span = pa.struct([("first", pa.int32()), ("end", pa.int32())])
    return pa.struct(
        [
            *counts,
            ("base_failed", pa.bool_()),
            ("covered_words", pa.int64()),
            ("longest_repeat_words", pa.int64()),
            ("repeat_spans", pa.list_(span)),
            ("kept", pa.bool_()),
        ]
    )
