"""Fixed-length byte windows of texts, and small optimiser steps, for the trained models."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F


def cut(texts: list[bytes], size: int, stride: int) -> tuple[np.ndarray, np.ndarray]:
    """Windows of all texts as rows, zero-padded at the end, and the text each comes from.

    Every text gets at least one window; the last one starts before the text's end.
    """
    lengths = np.array([len(t) for t in texts], dtype=np.int64)
    counts = np.maximum(1, -(-(lengths - (size - stride)) // stride))
    owner = np.repeat(np.arange(len(texts)), counts)
    number = np.arange(len(owner)) - np.repeat(np.cumsum(counts) - counts, counts)
    begin = np.cumsum(lengths) - lengths
    data = np.frombuffer(b"".join([*texts, b"\0" * size]), dtype=np.uint8)
    inner = number[:, None] * stride + np.arange(size)
    at = np.minimum(begin[owner][:, None] + inner, len(data) - 1)
    return np.where(inner < lengths[owner][:, None], data[at], 0).astype(np.uint8), owner


def sampled(text: Column, size: int, stride: int, at_most: int) -> Column:
    """Up to ``at_most`` evenly spaced windows of each text, as ``array<binary>``."""

    @F.arrow_udf("array<binary>")
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            out = []
            for value in batch.to_pylist():
                rows, _ = cut([value or b""], size, stride)
                keep = np.unique(np.linspace(0, len(rows) - 1, at_most).astype(int))
                out.append([rows[i].tobytes() for i in keep])
            yield pa.array(out, pa.list_(pa.binary()))

    return run.asNondeterministic()(text.cast("binary"))


class Adam:
    """Adam over a dictionary of arrays, changed in place."""

    def __init__(self, weights: dict[str, np.ndarray], rate: float):
        self.weights, self.rate, self.steps = weights, rate, 0
        self.mean = {k: np.zeros_like(v) for k, v in weights.items()}
        self.square = {k: np.zeros_like(v) for k, v in weights.items()}

    def step(self, slopes: dict[str, np.ndarray]) -> None:
        self.steps += 1
        for k, slope in slopes.items():
            self.mean[k] += 0.1 * (slope - self.mean[k])
            self.square[k] += 0.001 * (slope * slope - self.square[k])
            mean = self.mean[k] / (1 - 0.9**self.steps)
            square = self.square[k] / (1 - 0.999**self.steps)
            self.weights[k] -= self.rate * mean / (np.sqrt(square) + 1e-8)
