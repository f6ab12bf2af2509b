"""Secrets by fixed patterns and by character Markov models, with DataFrame functions only.

Patterns find assignments to telling names, access keys and long hexadecimal runs. Other
long strings are judged by two first-order Markov models of characters, one of random
strings and one of ordinary identifiers: a string is a secret if the log-likelihood ratio
of the two exceeds a threshold. So are its parts between / = _ and -: a secret reaches from
the first of them that is one to the last, or is each such part where the string as a
whole is none. What a base span takes of a string is left out and the rest judged.

The models learn from labelled samples of bounded size: random strings are made from
hashes of row numbers (hexadecimal, base 64, and letters with digits); ordinary
identifiers are the words and names of ``train_texts`` texts, taken by a hash of the id.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.spans import NONE, in_order, matches, moved, overlaps

KINDS = ["assign", "access", "hex", "random"]
ALPHABET = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789+/_=-"

#: Patterns of the base kinds.
ASSIGN = r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ASSIGN_NAME = r"(?i:password|passwd|secret|token|api_?key)"
ACCESS = r"AKIA[A-Z0-9]{12,}"
HEX = r"[0-9a-f]{32,}"


@dataclass(frozen=True)
class MarkovSettings:
    """``min_length``: shorter strings are not judged. ``threshold``: in natural logarithms.

    Digits alone are judged from ``number_length`` on: shorter ones are card numbers and ids.
    """

    min_length: int = 12
    number_length: int = 20
    threshold: float = 12.0
    train_texts: int = 2000
    random_strings: int = 4000
    smoothing: float = 0.5


def base_secrets(text: Column) -> Column:
    """Spans of the fixed patterns. Matches that fail a length rule are dropped without a retry.

    Runs that are too short cannot hold a long enough match, so the lengths of access keys
    and hexadecimal runs stand in their patterns.
    """
    assigned = matches(text, ASSIGN, "assign", text.rlike(ASSIGN_NAME), group=2)
    return F.concat(
        F.filter(assigned, lambda s: F.char_length(s["value"]) >= 8),
        matches(text, ACCESS, "access", text.contains("AKIA")),
        matches(text, HEX, "hex"),
    )


def _pairs(tokens: DataFrame, token: str) -> DataFrame:
    """Counts of neighbouring characters over all tokens: at most the alphabet's square of rows."""
    chars = F.split(F.col(token), "")
    pairs = F.zip_with(F.slice(chars, 1, F.size(chars) - 1), F.slice(chars, 2, F.size(chars) - 1), lambda a, b: F.concat(a, b))
    return tokens.filter(F.char_length(token) > 1).select(F.explode(pairs).alias("pair")).groupBy("pair").count()


def _log_odds(random: dict[str, int], ordinary: dict[str, int], smoothing: float) -> list[float]:
    def conditional(counts: dict[str, int]) -> list[float]:
        out = []
        for a in ALPHABET:
            row = [counts.get(a + b, 0) + smoothing for b in ALPHABET]
            out += [math.log(x / sum(row)) for x in row]
        return out

    return [a - b for a, b in zip(conditional(random), conditional(ordinary))]


def train_log_odds(docs: DataFrame, settings: MarkovSettings = MarkovSettings(), key: str = "doc_id", text: str = "text") -> list[float]:
    """Log-likelihood ratio of every character pair, row by row of the alphabet's square."""
    spark = docs.sparkSession
    picked = docs.select(F.col(key).alias("picked_key")).filter("picked_key is not null").orderBy(F.xxhash64("picked_key"), "picked_key")
    # Bound by train_texts rows.
    picked = F.broadcast(picked.limit(settings.train_texts).distinct())
    words = (
        docs.select(F.col(key).alias("picked_key"), F.col(text).alias("body"))
        .join(picked, "picked_key")
        .select(F.explode(F.regexp_extract_all("body", F.lit("[A-Za-z][A-Za-z0-9_-]+"), F.lit(0))).alias("token"))
        .filter((F.char_length("token") >= 4) & ~F.col("token").rlike(f"{HEX}|{ACCESS}|[0-9].*[A-Za-z].*[0-9]"))
    )
    digest = F.sha2(F.col("id").cast("string"), 256)
    mixed = F.base64(F.unhex(F.concat(digest, F.sha2(F.concat(F.lit("b"), F.col("id").cast("string")), 256))))
    made = spark.range(settings.random_strings).select(
        F.explode(F.array(digest, mixed, F.upper(F.regexp_replace(mixed, "[^A-Za-z0-9]", "")), F.translate(mixed, "+/=", "-_"))).alias("token")
    )
    ordinary = {r["pair"]: r["count"] for r in _pairs(words, "token").collect()}
    random = {r["pair"]: r["count"] for r in _pairs(made, "token").collect()}
    return _log_odds(random, ordinary, settings.smoothing)


def log_likelihood_ratio(token: Column, log_odds: list[float]) -> Column:
    """Sum over the neighbouring characters of a token of the alphabet."""
    table = F.split(F.lit(",".join(f"{x:.6f}" for x in log_odds)), ",").cast("array<double>")
    chars = F.split(token, "")
    places = F.transform(chars, lambda c: F.instr(F.lit(ALPHABET), c) - 1)
    pair = F.zip_with(F.slice(places, 1, F.size(places) - 1), F.slice(places, 2, F.size(places) - 1), lambda a, b: F.get(table, a * len(ALPHABET) + b))
    return F.aggregate(pair, F.lit(0.0), lambda total, x: total + x)


def secrets(text: Column, log_odds: list[float], settings: MarkovSettings = MarkovSettings()) -> Column:
    """Base spans and random strings outside of them, in order.

    ``array<struct<kind, start, end, value>>``; code points, end exclusive. A null text
    counts as empty.
    """
    return _with_random(base_secrets(F.coalesce(text, F.lit(""))), candidates(text, settings), log_odds, settings)


def candidates(text: Column, settings: MarkovSettings = MarkovSettings()) -> Column:
    """Maximal runs of the alphabet that are long enough to be judged."""
    return matches(F.coalesce(text, F.lit("")), _run_pattern(settings), "random")


def _run_pattern(settings: MarkovSettings) -> str:
    return rf"[A-Za-z0-9+/_=-]{{{settings.min_length},}}"


def _blanked(value: Column, start: Column, end: Column) -> Column:
    """The value with spaces from ``start`` to ``end``."""
    return F.concat(F.substring(value, F.lit(1), start), F.repeat(F.lit(" "), end - start), F.substring(value, end + 1, F.char_length(value)))


def _with_random(base: Column, long_runs: Column, log_odds: list[float], settings: MarkovSettings) -> Column:
    def without_base(run: Column) -> Column:
        """What is left of a run outside of the base spans."""
        blanked = F.aggregate(
            F.filter(base, lambda b: (b["start"] < run["end"]) & (run["start"] < b["end"])),
            run["value"],
            lambda value, b: _blanked(value, F.greatest(b["start"] - run["start"], F.lit(0)), F.least(b["end"], run["end"]) - run["start"]),
        )
        left = matches(blanked, _run_pattern(settings), "random")
        return F.when(overlaps(run, base), F.transform(left, lambda s: moved(s, run["start"]))).otherwise(F.array(run))

    free = F.flatten(F.transform(long_runs, without_base))
    part = rf"[A-Za-z0-9+]{{{settings.min_length},}}"

    def is_random(span: Column) -> Column:
        judgeable = (F.char_length(span["value"]) >= settings.number_length) | span["value"].rlike("[A-Za-z]")
        return judgeable & (log_likelihood_ratio(span["value"], log_odds) > settings.threshold)

    def judged(run: Column) -> Column:
        parts = F.filter(matches(run["value"], part, "random", run["value"].rlike("[/=_-]")), is_random)
        # The array of one element gives the parts a name: they are worked out once.
        return F.element_at(F.transform(F.array(parts), lambda found: reported(run, found)), 1)

    def reported(run: Column, parts: Column) -> Column:
        begin, end = F.element_at(parts, 1)["start"], F.element_at(parts, -1)["end"]
        inner = F.struct(run["kind"].alias("kind"), (run["start"] + begin).alias("start"), (run["start"] + end).alias("end"), F.substring(run["value"], begin + 1, end - begin).alias("value"))
        whole = F.when(F.size(parts) > 0, F.array(inner)).otherwise(F.array(run))
        return F.when(is_random(run), whole).otherwise(F.transform(parts, lambda p: moved(p, run["start"])))

    random = F.flatten(F.transform(free, judged))
    return in_order(F.concat(base, random), KINDS)


def find_secrets(docs: DataFrame, settings: MarkovSettings = MarkovSettings(), key: str = "doc_id", text: str = "text") -> DataFrame:
    """Key, ``base`` spans and all ``spans`` of every row."""
    log_odds = train_log_odds(docs, settings, key, text)
    body = F.coalesce(F.col(text), F.lit(""))
    # A generator keeps the matches in one place: each is found once, then used twice.
    found = docs.select(F.col(key), F.explode(F.array(F.struct(base_secrets(body).alias("base"), candidates(body, settings).alias("runs")))).alias("f"))
    base = F.coalesce(F.col("f.base"), F.array().cast(NONE))
    return found.select(
        key,
        in_order(base, KINDS).alias("base"),
        F.when(F.size("f.runs") == 0, in_order(base, KINDS)).otherwise(_with_random(base, F.col("f.runs"), log_odds, settings)).alias("spans"),
    )
