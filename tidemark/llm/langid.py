"""Language of a text by a convolutional network over its bytes.

Filters of several widths slide over fixed-length byte windows; the largest response of
each filter in a window goes through a softmax over the languages. A text's windows
vote with their log-probabilities, weighted by their bytes. Trained in numpy on a
bounded sample of labelled texts: at most ``texts_per_language`` of each language, taken
by a hash of the id, and ``windows_per_text`` windows of each.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.windows import Adam, cut, sampled
from tidemark.llm.words import blocks

UNDETERMINED = "und"
_LETTER = re.compile(rb"[A-Za-z]")


@dataclass(frozen=True)
class ByteCnnSettings:
    window: int = 256
    widths: tuple[int, ...] = (2, 3, 4)
    filters: int = 16
    texts_per_language: int = 800
    windows_per_text: int = 5
    epochs: int = 5
    batch: int = 128
    rate: float = 0.02
    seed: int = 7

    @property
    def stride(self) -> int:
        """Windows overlap so that no filter position is lost at their borders."""
        return self.window - max(self.widths) + 1


class ByteCnn:
    """One table per filter position holds a response for each byte: a filter on one-hot bytes."""

    def __init__(self, languages: list[str], settings: ByteCnnSettings):
        self.languages, self.settings = languages, settings
        draw = np.random.default_rng(settings.seed)
        self.weights = {
            f"{w}.{j}": (draw.standard_normal((256, settings.filters)) * 0.3).astype(np.float32)
            for w in settings.widths
            for j in range(w)
        }
        size = settings.filters * len(settings.widths)
        self.weights["out"] = (draw.standard_normal((size, len(languages))) * 0.1).astype(np.float32)
        self.weights["bias"] = np.zeros(len(languages), dtype=np.float32)
        self._pairs: dict[str, np.ndarray] = {}

    def _responses(self, rows: np.ndarray, width: int) -> np.ndarray:
        span = rows.shape[1] - width + 1
        return sum(self.weights[f"{width}.{j}"][rows[:, j : j + span]] for j in range(width))

    def _pooled_fast(self, rows: np.ndarray) -> np.ndarray:
        """Pooled responses by tables of byte pairs, which halve the lookups."""
        pairs = rows[:, :-1].astype(np.int32) * 256 + rows[:, 1:]
        parts = []
        for width in self.settings.widths:
            span, out = rows.shape[1] - width + 1, None
            for j in range(0, width, 2):
                if j + 1 < width:
                    key = f"{width}.{j}"
                    if key not in self._pairs:
                        left, right = self.weights[key], self.weights[f"{width}.{j + 1}"]
                        self._pairs[key] = (left[:, None, :] + right[None, :, :]).reshape(65536, -1)
                    part = self._pairs[key].take(pairs[:, j : j + span], axis=0)
                else:
                    part = self.weights[f"{width}.{j}"].take(rows[:, j : j + span], axis=0)
                out = part if out is None else np.add(out, part, out=out)
            parts.append(np.maximum(out.max(axis=1), 0))
        return np.hstack(parts)

    def log_probabilities(self, rows: np.ndarray) -> np.ndarray:
        parts = [
            _log_softmax(self._pooled_fast(rows[i : i + 64]) @ self.weights["out"] + self.weights["bias"])
            for i in range(0, len(rows), 64)
        ]
        return np.vstack(parts)

    def train(self, rows: np.ndarray, targets: np.ndarray) -> None:
        s, draw = self.settings, np.random.default_rng(self.settings.seed + 1)
        adam = Adam(self.weights, s.rate)
        for epoch in range(s.epochs):
            adam.rate = s.rate * (1 - epoch / s.epochs)
            order = draw.permutation(len(rows))
            for at in range(0, len(order), s.batch):
                pick = order[at : at + s.batch]
                adam.step(self._slopes(rows[pick], targets[pick]))
        self._pairs.clear()

    def _slopes(self, rows: np.ndarray, targets: np.ndarray) -> dict[str, np.ndarray]:
        s, each = self.settings, np.arange(len(rows))
        peaks, tops = [], []
        for width in s.widths:
            out = self._responses(rows, width)
            peak = out.argmax(axis=1)
            peaks.append(peak)
            tops.append(np.take_along_axis(out, peak[:, None, :], axis=1)[:, 0])
        pooled = np.hstack(tops)
        active = np.maximum(pooled, 0)
        error = np.exp(_log_softmax(active @ self.weights["out"] + self.weights["bias"]))
        error[each, targets] -= 1
        error /= len(rows)
        slopes = {"out": active.T @ error, "bias": error.sum(axis=0)}
        back = (error @ self.weights["out"].T) * (pooled > 0)
        columns = np.arange(s.filters)
        for k, width in enumerate(s.widths):
            own = back[:, k * s.filters : (k + 1) * s.filters]
            for j in range(width):
                slope = np.zeros_like(self.weights[f"{width}.{j}"])
                np.add.at(slope, (rows[each[:, None], peaks[k] + j], columns[None, :]), own)
                slopes[f"{width}.{j}"] = slope
        return slopes


def _log_softmax(scores: np.ndarray) -> np.ndarray:
    scores = scores - scores.max(axis=1, keepdims=True)
    return scores - np.log(np.exp(scores).sum(axis=1, keepdims=True))


def train_language_model(
    labelled: DataFrame,
    docs: DataFrame,
    settings: ByteCnnSettings = ByteCnnSettings(),
    key: str = "doc_id",
    lang: str = "lang",
    text: str = "text",
) -> ByteCnn | None:
    """Train on a bounded sample of ``labelled`` (key, lang), whose texts are in ``docs``.

    Rows with a null key or language teach nothing. None if no row is left.
    """
    known = labelled.filter(F.col(key).isNotNull() & F.col(lang).isNotNull()).select(key, lang, F.xxhash64(key).alias("order"))
    # Only the least hashes are ranked, twice as many as needed: a language may have most of
    # the rows. One row a language is broadcast.
    sizes = known.groupBy(F.col(lang).alias("sized")).agg(F.count(F.lit(1)).alias("size"))
    place = F.col("order") / 2.0**64 + 0.5
    rank = F.row_number().over(Window.partitionBy(lang).orderBy("order", key))
    picked = (
        known.join(F.broadcast(sizes), F.col(lang) == F.col("sized"))
        .filter(place * F.col("size") <= 2 * settings.texts_per_language)
        .withColumn("rank", rank)
        .filter(F.col("rank") <= settings.texts_per_language)
        .select(F.col(key).alias("picked_key"), F.col(lang).alias("picked_lang"))
        .distinct()
    )
    # Bound by texts_per_language times the number of languages.
    rows = (
        docs.select(F.col(key).alias("picked_key"), F.col(text).alias("picked_text"))
        .join(F.broadcast(picked), "picked_key")
        .filter("picked_text is not null")
        .select("picked_key", "picked_lang", sampled(F.col("picked_text"), settings.window, settings.stride, settings.windows_per_text).alias("windows"))
        .collect()
    )
    if not rows:
        return None
    rows.sort(key=lambda r: (r.picked_key, r.picked_lang))
    model = ByteCnn(sorted({r.picked_lang for r in rows}), settings)
    number = {name: i for i, name in enumerate(model.languages)}
    data = np.frombuffer(b"".join(w for r in rows for w in r.windows), dtype=np.uint8).reshape(-1, settings.window)
    model.train(data, np.array([number[r.picked_lang] for r in rows for _ in r.windows]))
    return model


def _predict(texts: list[bytes], model: ByteCnn) -> list[dict]:
    rows, owner = cut(texts, model.settings.window, model.settings.stride)
    votes = model.log_probabilities(rows) * (rows != 0).sum(axis=1, keepdims=True)
    starts = np.searchsorted(owner, np.arange(len(texts)))
    lengths = np.maximum(np.array([len(t) for t in texts]), 1)
    mean = np.add.reduceat(votes, starts, axis=0) / lengths[:, None]
    chance = np.exp(_log_softmax(mean))
    best = chance.argmax(axis=1)
    return [
        {"lang_pred": model.languages[k], "score": float(min(1.0, chance[i, k]))} if _has_letter(texts[i]) else {"lang_pred": UNDETERMINED, "score": 0.0}
        for i, k in enumerate(best.tolist())
    ]


def _has_letter(text: bytes) -> bool:
    return bool(_LETTER.search(text)) or any(map(str.isalpha, text.decode("utf-8", errors="ignore")))


def predicted_language(text: Column, model: ByteCnn | None) -> Column:
    """``struct<lang_pred, score>``; ``und`` with score 0 for null texts and texts without a letter.

    Without a model (nothing to learn from) every text is ``und``.
    """
    kind = pa.struct([("lang_pred", pa.string()), ("score", pa.float64())])

    @F.arrow_udf("struct<lang_pred:string,score:double>")
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            texts = [value or b"" for value in batch.to_pylist()]
            rows: list[dict] = []
            for first, end in blocks(texts):
                if model is None:
                    rows += [{"lang_pred": UNDETERMINED, "score": 0.0}] * (end - first)
                else:
                    rows += _predict(texts[first:end], model)
            yield pa.array(rows, kind)

    return run.asNondeterministic()(text.cast("binary"))
