"""Quality of a text by attention over its passages (multiple-instance learning).

A text is a bag of passages of fixed byte length. Each passage is encoded from counts of
neighbouring character classes and from how often its words repeat. Gated attention
weighs the passages; the weighted sum of encodings gives the text's score. Encoder,
attention and output are trained together, from document labels alone, in numpy on a
bounded sample: ``train_texts`` labelled texts taken by a hash of the id, and up to
``train_passages`` evenly spaced passages of each. Scoring reads every passage.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.windows import Adam, cut, sampled
from tidemark.llm.words import blocks, span_hashes, word_spans

_CLASSES = 20
_EXTRA = 6
N_FEATURES = _CLASSES * _CLASSES + _CLASSES + _EXTRA


def _byte_classes() -> np.ndarray:
    """Character classes: padding, letters by kind, digits, spaces, single marks, other bytes."""
    kind = np.full(256, 19, dtype=np.int64)
    kind[0] = 0
    kind[97:123], kind[65:91], kind[48:58] = 1, 2, 3
    kind[[ord(c) for c in "aeiou"]] = 4
    kind[[ord(c) for c in "AEIOU"]] = 5
    kind[128:192], kind[192:256] = 6, 7
    for number, marks in enumerate([" ", "\n", ".", ",", "#$%&*", "|", "<>", "!?", ":;", "/=@", "()[]{}"], 8):
        kind[[ord(c) for c in marks]] = number
    return kind


_CLASS = _byte_classes()


@dataclass(frozen=True)
class MilSettings:
    passage: int = 512
    hidden: int = 24
    gate: int = 12
    train_texts: int = 5000
    train_passages: int = 12
    epochs: int = 12
    batch: int = 64
    rate: float = 0.004
    decay: float = 1e-4
    seed: int = 11


def features(rows: np.ndarray) -> np.ndarray:
    """One row per passage: class and class-pair frequencies (square roots) and word statistics."""
    n, size = rows.shape
    kind = _CLASS[rows]
    used = np.maximum((rows != 0).sum(axis=1), 1)
    base = np.arange(n)[:, None]
    pair = np.bincount((base * _CLASSES**2 + kind[:, :-1] * _CLASSES + kind[:, 1:]).ravel(), minlength=n * _CLASSES**2)
    single = np.bincount((base * _CLASSES + kind).ravel(), minlength=n * _CLASSES).reshape(n, _CLASSES)
    out = np.zeros((n, N_FEATURES), dtype=np.float32)
    out[:, : _CLASSES**2] = np.sqrt(pair.reshape(n, -1) / used[:, None])
    out[:, _CLASSES**2 : _CLASSES**2 + _CLASSES] = np.sqrt(single / used[:, None])
    # Zero bytes pad a passage and part neighbouring ones: words never cross.
    apart = np.zeros((n, size + 1), dtype=np.uint8)
    apart[:, :-1] = rows
    data = apart.ravel()
    starts, ends = word_spans(data, _IN_WORD)
    words = span_hashes(data, starts, ends)
    owner = starts // (size + 1)
    count = np.bincount(owner, minlength=n)
    some = np.maximum(count, 1)
    order = np.lexsort((words, owner))
    w, o = words[order], owner[order]
    again = np.zeros(n)
    np.add.at(again, o[1:][(w[1:] == w[:-1]) & (o[1:] == o[:-1])], 1)
    beside = np.zeros(n)
    np.add.at(beside, owner[1:][(words[1:] == words[:-1]) & (owner[1:] == owner[:-1])], 1)
    extra = out[:, -_EXTRA:]
    extra[:, 0] = again / some
    extra[:, 1] = beside / some
    extra[:, 2] = np.bincount(owner, weights=ends - starts, minlength=n) / some / 16
    extra[:, 3] = np.log1p(count) / 5
    extra[:, 4] = used / size
    extra[:, 5] = count == 0
    return out


_IN_WORD = np.ones(256, dtype=bool)
_IN_WORD[[0, 9, 10, 11, 12, 13, 32]] = False


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


class AttentionMil:
    """Encoder, gated attention and output; bags are runs of rows given by their starts."""

    def __init__(self, settings: MilSettings):
        self.settings = settings
        draw = np.random.default_rng(settings.seed)
        shapes = {"enc": (N_FEATURES, settings.hidden), "v": (settings.hidden, settings.gate), "u": (settings.hidden, settings.gate), "a": (settings.gate,), "out": (settings.hidden,)}
        self.weights = {k: (draw.standard_normal(s) / np.sqrt(s[0])).astype(np.float32) for k, s in shapes.items()}
        self.weights |= {"enc_b": np.zeros(settings.hidden, dtype=np.float32), "out_b": np.zeros(1, dtype=np.float32)}
        self.mean = np.zeros(N_FEATURES, dtype=np.float32)
        self.scale = np.ones(N_FEATURES, dtype=np.float32)

    def encode(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Encodings, both gates and unnormalised attention of each passage."""
        w = self.weights
        h = np.tanh((x - self.mean) * self.scale @ w["enc"] + w["enc_b"])
        left, right = np.tanh(h @ w["v"]), _sigmoid(h @ w["u"])
        return h, left, right, (left * right) @ w["a"]

    def scores(self, x: np.ndarray, starts: np.ndarray) -> np.ndarray:
        h, _, _, raw = self.encode(x)
        bag = np.repeat(np.arange(len(starts)), np.diff(np.append(starts, len(x))))
        attention = np.exp(raw - np.maximum.reduceat(raw, starts)[bag])
        total = np.add.reduceat(attention, starts)
        pooled = np.add.reduceat(attention[:, None] * h, starts, axis=0) / total[:, None]
        return _sigmoid(pooled @ self.weights["out"] + self.weights["out_b"])

    def train(self, x: np.ndarray, sizes: np.ndarray, labels: np.ndarray) -> None:
        s, draw = self.settings, np.random.default_rng(self.settings.seed + 1)
        self.mean = x.mean(axis=0)
        self.scale = (1 / (x.std(axis=0) + 0.02)).astype(np.float32)
        share = np.clip(labels.mean(), 0.01, 0.99)
        self.weights["out_b"][:] = np.log(share / (1 - share))
        begin = np.cumsum(sizes) - sizes
        adam = Adam(self.weights, s.rate)
        for epoch in range(s.epochs):
            adam.rate = s.rate * (1 - epoch / s.epochs)
            order = draw.permutation(len(sizes))
            for at in range(0, len(order), s.batch):
                pick = order[at : at + s.batch]
                rows = np.concatenate([np.arange(begin[i], begin[i] + sizes[i]) for i in pick])
                adam.step(self._slopes(x[rows], np.cumsum(sizes[pick]) - sizes[pick], labels[pick]))

    def _slopes(self, x: np.ndarray, starts: np.ndarray, labels: np.ndarray) -> dict[str, np.ndarray]:
        w = self.weights
        h, left, right, raw = self.encode(x)
        bag = np.repeat(np.arange(len(starts)), np.diff(np.append(starts, len(x))))
        attention = np.exp(raw - np.maximum.reduceat(raw, starts)[bag])
        attention = (attention / np.add.reduceat(attention, starts)[bag])[:, None]
        pooled = np.add.reduceat(attention * h, starts, axis=0)
        error = ((_sigmoid(pooled @ w["out"] + w["out_b"]) - labels) / len(starts)).astype(np.float32)
        to_pooled = (error[:, None] * w["out"])[bag]
        to_attention = ((h - pooled[bag]) * to_pooled).sum(axis=1, keepdims=True) * attention
        to_left = to_attention * w["a"] * right * (1 - left**2)
        to_right = to_attention * w["a"] * left * right * (1 - right)
        to_h = attention * to_pooled + to_left @ w["v"].T + to_right @ w["u"].T
        to_encoder = to_h * (1 - h**2)
        slopes = {
            "out": pooled.T @ error,
            "out_b": np.array([error.sum()]),
            "a": (to_attention * left * right).sum(axis=0),
            "v": h.T @ to_left,
            "u": h.T @ to_right,
            "enc": ((x - self.mean) * self.scale).T @ to_encoder,
            "enc_b": to_encoder.sum(axis=0),
        }
        return {k: v + self.settings.decay * w[k] for k, v in slopes.items()}


def train_quality_model(
    labelled: DataFrame,
    docs: DataFrame,
    settings: MilSettings = MilSettings(),
    key: str = "doc_id",
    label: str = "quality",
    text: str = "text",
) -> AttentionMil | None:
    """Train on a bounded sample of ``labelled`` (key, label 0 or 1), whose texts are in ``docs``.

    Rows with a null key or label teach nothing; a null text counts as empty. None if no
    row is left.
    """
    picked = (
        labelled.filter(F.col(key).isNotNull() & F.col(label).isin(0, 1))
        .select(F.col(key).alias("picked_key"), F.col(label).cast("int").alias("picked_label"))
        .orderBy(F.xxhash64("picked_key"), "picked_key", "picked_label")
        .limit(settings.train_texts)
        .distinct()
    )
    rows = (
        docs.select(F.col(key).alias("picked_key"), F.col(text).alias("picked_text"))
        .join(F.broadcast(picked), "picked_key")
        .select("picked_key", "picked_label", sampled(F.col("picked_text"), settings.passage, settings.passage, settings.train_passages).alias("passages"))
        .collect()
    )
    if not rows:
        return None
    rows.sort(key=lambda r: (r.picked_key, r.picked_label))
    data = np.frombuffer(b"".join(p for r in rows for p in r.passages), dtype=np.uint8).reshape(-1, settings.passage)
    x = np.vstack([features(data[i : i + 2048]) for i in range(0, len(data), 2048)])
    model = AttentionMil(settings)
    model.train(x, np.array([len(r.passages) for r in rows]), np.array([r.picked_label for r in rows], dtype=np.float32))
    return model


def quality_score(text: Column, model: AttentionMil | None) -> Column:
    """Probability of label 1 for every whole text, empty and null ones included.

    Without a model (nothing to learn from) every score is 0.5.
    """

    @F.arrow_udf("double")
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            texts = [value or b"" for value in batch.to_pylist()]
            out: list[float] = []
            for first, end in blocks(texts, 1 << 19):
                if model is None:
                    out += [0.5] * (end - first)
                    continue
                rows, owner = cut(texts[first:end], model.settings.passage, model.settings.passage)
                starts = np.searchsorted(owner, np.arange(end - first))
                x = np.vstack([features(rows[i : i + 1024]) for i in range(0, len(rows), 1024)])
                out += model.scores(x, starts).astype(float).tolist()
            yield pa.array(out, pa.float64())

    return run.asNondeterministic()(text.cast("binary"))
