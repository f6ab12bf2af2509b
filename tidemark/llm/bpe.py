"""Byte-level BPE by dynamic programming over prefixes, and its way back.

Every prefix of a piece of text has exactly one encoding, so exactly one last token.
A token that ends at a position is that last token if it may follow the last token of
the shorter prefix before it. An automaton over the vocabulary names the tokens that
end at each position; whether two tokens may stand side by side depends on the two
alone, and is found from the merges along their touching edges. Following the last
tokens back from the end gives the ids.

Pieces of text come from the pre-tokenizer's pattern. Executors read the vocabulary
from ``path``, which must exist on each of them.
"""

from __future__ import annotations

import json
import struct
from collections.abc import Callable, Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column
from pyspark.sql import functions as F

#: The pattern that byte-level BPE vocabularies of this kind split text by.
PIECES = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Words that each of the two halves of a worker's memo holds.
MEMO = 120_000
ENCODED = "struct<ids:binary,decoded:string>"


def byte_letters() -> list[str]:
    """The printable character that vocabularies write for each byte."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    letters = {b: chr(b) for b in shown}
    letters |= {b: chr(256 + i) for i, b in enumerate(b for b in range(256) if b not in letters)}
    return [letters[b] for b in range(256)]


class Memo(dict):
    """Results by word, in two halves: a full one replaces the other, so frequent words stay."""

    def __init__(self, compute: Callable[[str], bytes]):
        super().__init__()
        self._compute = compute
        self._older: dict[str, bytes] = {}

    def __missing__(self, word: str) -> bytes:
        found = self._older.get(word)
        if found is None:
            found = self._compute(word)
        if len(word) <= 64:
            if len(self) >= MEMO:
                self._older = dict(self)
                self.clear()
            self[word] = found
        return found


class Fits(dict):
    """Whether two tokens may stand side by side, by both ids in one number; emptied when full."""

    def __init__(self, compute: Callable[[int, int], bool]):
        super().__init__()
        self._compute = compute

    def __missing__(self, pair: int) -> bool:
        if len(self) >= 3 * MEMO:
            self.clear()
        fit = self[pair] = self._compute(pair >> 20, pair & 0xFFFFF)
        return fit


class Codec:
    """Encoder and decoder of one vocabulary file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as source:
            spec = json.load(source)
        model = spec["model"]
        to_byte = {letter: chr(b) for b, letter in enumerate(byte_letters())}

        def plain(token: str) -> str:
            return "".join(to_byte[c] for c in token)

        self.ids = {plain(token): i for token, i in model["vocab"].items()}
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.bytes = [b""] * (1 + max([*self.ids.values(), *self.special.values()]))
        for token, i in self.ids.items():
            self.bytes[i] = token.encode("latin-1")
        for text, i in self.special.items():
            self.bytes[i] = text.encode()
        self._rank: dict[tuple[int, int], int] = {}
        self._parts: dict[int, tuple[int, int, int]] = {}
        for rank, merge in enumerate(model["merges"]):
            left, right = (plain(p) for p in (merge if isinstance(merge, list) else merge.split(" ")))
            pair = self.ids[left], self.ids[right]
            self._rank.setdefault(pair, rank)
            self._parts.setdefault(self.ids[left + right], (*pair, rank))
        self._sizes = list(map(len, self.bytes))
        self._fits = Fits(self.may_follow)
        self._automaton = ahocorasick.Automaton()
        for token, i in self.ids.items():
            if self._own_encoding(i):
                self._automaton.add_word(token, (i, len(token)))
        self._automaton.make_automaton()
        self._pattern = regex.compile(PIECES)
        self._special_pattern = regex.compile("(" + "|".join(map(regex.escape, self.special)) + ")")
        self._loose_space = regex.compile(r" \s| $")
        self._pieces = Memo(self._pack_piece)
        self._after_space = Memo(lambda word: self._encode_chunk(" " + word))

    def _edge(self, token: int, side: int) -> list[tuple[int, float]]:
        """Symbols that stand at one edge while a token is built: each with the rank that ends it."""
        out, until = [], float("inf")
        while True:
            out.append((token, until))
            if token not in self._parts:
                return out
            until = self._parts[token][2]
            token = self._parts[token][side]

    def may_follow(self, left: int, right: int) -> bool:
        """Whether BPE keeps the two tokens apart: no merge joins symbols across their border.

        A merge across the border wins over a merge of the right token of equal rank,
        which starts later in the text, but not over one of the left token.
        """
        for a, a_until in self._edge(left, 1):
            for b, b_until in self._edge(right, 0):
                rank = self._rank.get((a, b))
                if rank is not None and rank < a_until and rank <= b_until:
                    return False
        return True

    def _own_encoding(self, token: int) -> bool:
        """Whether a token's bytes encode to that token; some vocabularies hold unreachable ones."""
        if token not in self._parts:
            return True
        left, right, rank = self._parts[token]
        if not (self._own_encoding(left) and self._own_encoding(right)):
            return False
        for a, a_until in self._edge(left, 1):
            for b, b_until in self._edge(right, 0):
                across = self._rank.get((a, b))
                if across is not None and across < rank and across < a_until and across <= b_until:
                    return False
        return True

    def encode_piece(self, piece: str) -> list[int]:
        """Ids of one piece, given as one character per byte."""
        last = [-1] * len(piece)
        fits, sizes = self._fits, self._sizes
        for end, (token, size) in self._automaton.iter(piece):
            if last[end] < 0 and (size > end or fits[last[end - size] << 20 | token]):
                last[end] = token
        end = len(piece) - 1
        out = []
        while end >= 0:
            out.append(last[end])
            end -= sizes[last[end]]
        out.reverse()
        return out

    def _pack_piece(self, piece: str) -> bytes:
        ids = self.encode_piece(piece if piece.isascii() else piece.encode().decode("latin-1"))
        return struct.pack(f"<{len(ids)}I", *ids)

    def _encode_chunk(self, chunk: str) -> bytes:
        pieces = self._pattern.findall(chunk)
        if len(pieces) == 1:
            return self._pack_piece(chunk)
        # A word is the same piece whatever follows it, so it is looked up without its punctuation.
        return b"".join(self._after_space[p[1:]] if p[0] == " " and len(p) > 1 else self._pieces[p] for p in pieces)

    def _encode_plain(self, text: str) -> bytes:
        if self._loose_space.search(text):
            return b"".join(map(self._pieces.__getitem__, self._pattern.findall(text)))
        # A space between other characters always opens a piece, so words are independent.
        head, *rest = text.split(" ")
        return self._encode_chunk(head) + b"".join(map(self._after_space.__getitem__, rest))

    def encode(self, text: str) -> bytes:
        """Ids as little-endian unsigned 32-bit integers; special tokens in the text count as such."""
        out = []
        for i, part in enumerate(self._special_pattern.split(text) if self.special else [text]):
            out.append(np.array([self.special[part]], dtype="<u4").tobytes() if i % 2 else self._encode_plain(part))
        return b"".join(out)

    def decode(self, ids: bytes) -> str:
        """Text of the ids, special tokens included; bytes that are no UTF-8 become U+FFFD."""
        parts = map(self.bytes.__getitem__, np.frombuffer(ids, dtype="<u4").tolist())
        return b"".join(parts).decode("utf-8", errors="replace")


_codecs: dict[str, Codec] = {}


def codec(path: str) -> Codec:
    """The codec of a file, built once in each Python worker."""
    if path not in _codecs:
        _codecs[path] = Codec(path)
    return _codecs[path]


def encode_and_decode(text: Column, path: str) -> Column:
    """``struct<ids: binary, decoded: string>`` of a text column.

    ``ids`` holds little-endian unsigned 32-bit integers. A null text counts as empty:
    no ids, empty decoded text. Memory is bound by one text and the memo.
    """

    @F.arrow_udf(ENCODED)
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        tool = codec(path)
        for batch in batches:
            ids = [tool.encode(value.as_py() or "") for value in batch]
            decoded = [tool.decode(i) for i in ids]
            yield pa.StructArray.from_arrays([pa.array(ids, pa.binary()), pa.array(decoded, pa.string())], ["ids", "decoded"])

    return run.asNondeterministic()(text)
