"""Personal data by weak supervision, with DataFrame functions only.

Fixed patterns give the base spans. Looser patterns add candidates: numbers written like
phone numbers or ids, spelled-out e-mail addresses, names after a form of address in four
languages, and
what failed a base rule. Four labelers vote on every candidate: the pattern and its check, a
gazetteer, the words before it, and its shape; each may abstain. Expectation-maximisation
over the counts of vote patterns in all texts estimates how reliable each labeler is, and
how likely each vote pattern is personal data. A logistic classifier of the spans'
features is trained on these likelihoods; candidates above ``keep`` join the base spans.

Votes and features are small categories, so the counts that reach the driver are bounded
by the product of their sizes, whatever the number of texts.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.spans import NONE, in_order, matches, overlaps

KINDS = ["email", "ip", "card", "phone", "id", "name"]

#: Patterns of the base kinds. Runs are taken whole and never given back,
#: and a match starts where its first run does: the matches stay the same, in linear time.
EMAIL = r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
CARD = r"[0-9](?:[\x20-]?[0-9])++"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"

LOOSE_PHONE = r"(?<![A-Za-z0-9.+-])\(?[0-9]{2,4}\)?(?:[\x20.-][0-9]{2,4}){2,4}(?![A-Za-z0-9])"
LOOSE_ID = r"(?<![A-Za-z0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![A-Za-z0-9-])"
LOOSE_EMAIL = r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++\x20?[\[(](?:at|AT)[\])]\x20?[A-Za-z0-9-]++(?:\x20?(?:\.|[\[(](?:dot|DOT)[\])])\x20?[A-Za-z0-9-]++)+"
LOOSE_NAME = r"(?<!\p{L})(?:Mrs?|Ms|Miss|Dr|Prof|Mme|Mlle|M|Herrn?|Frau|Sra?|Srta|Doña|Don)\.?\x20(?:(?:de|del|la|von|van|der|du|le)\x20)*\p{Lu}[\p{L}’'-]++(?:\x20(?:(?:de|del|la|von|van|der|du|le)\x20)*\p{Lu}[\p{L}’'-]++)*"

#: Words of the labelers.
DOMAIN_ENDS = ["com", "org", "net", "edu", "gov", "info", "io", "de", "fr", "es", "uk", "eu", "example"]
FIRST_NAMES = [
    "Alice", "Amy", "Andrew", "Anna", "Barbara", "Brian", "Charles", "Christopher", "Daniel", "David", "Edward", "Elizabeth", "Emily", "Emma", "George", "Grace",
    "Helen", "Henry", "Jack", "James", "Jane", "Jennifer", "John", "Joseph", "Karen", "Kevin", "Linda", "Lisa", "Margaret", "Mark", "Mary", "Michael",
    "Nancy", "Olivia", "Patricia", "Paul", "Richard", "Robert", "Ruth", "Sarah", "Steven", "Susan", "Thomas", "William",
    "Andreas", "Birgit", "Brigitte", "Christian", "Claudia", "Dieter", "Elke", "Frank", "Friedrich", "Gisela", "Hans", "Heike", "Heinz", "Ingrid", "Jürgen", "Julia", "Karl",
    "Klaus", "Lena", "Lukas", "Markus", "Monika", "Peter", "Petra", "Renate", "Sabine", "Stefan", "Thorsten", "Uwe", "Wolfgang",
    "Alain", "Amélie", "Antoine", "Camille", "Catherine", "Céline", "Chloé", "Claire", "Élodie", "François", "Geneviève", "Gérard", "Guillaume", "Hélène", "Isabelle", "Jacques", "Jean",
    "Julien", "Laurent", "Louis", "Marie", "Mathieu", "Nathalie", "Nicolas", "Olivier", "Philippe", "Pierre", "Sophie", "Sylvie", "Théo",
    "Alejandro", "Ana", "Antonio", "Beatriz", "Carlos", "Carmen", "Diego", "Dolores", "Elena", "Fernando", "Francisco", "Isabel", "Javier", "José", "Juan", "Laura",
    "Lucía", "Luis", "Manuel", "María", "Maria", "Miguel", "Pablo", "Pedro", "Pilar", "Rafael", "Raúl", "Rosa", "Sofía", "Teresa",
]
TELLING = r"(?i)(?:e-?mail|contact|write|phone|tel|call|mobile|fax|card|visa|ip|host|address|ssn|social|dear|signed)[^\n]{0,12}$"
MISLEADING = r"(?i)(?:version|isbn|total|price|page|chapter|section|figure|order|serial)[^\n]{0,12}$"

VOTES = ["pattern", "gazetteer", "context", "shape"]
FEATURES = ["kind", "size", "digits", "marks", "before"]
CANDIDATE = "struct<kind:string,start:int,end:int,value:string,base:boolean,pattern:int,gazetteer:int,context:int,shape:int,size:int,digits:int,marks:int,before:int>"


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """Whether a string of digits passes the Luhn check."""
    numbers = F.transform(F.split(F.reverse(digits), ""), lambda c: F.try_to_number(c, F.lit("9")).cast("int"))
    doubled = F.transform(numbers, lambda x, i: F.when(i % 2 == 0, x).when(x > 4, 2 * x - 9).otherwise(2 * x))
    return F.aggregate(doubled, F.lit(0), lambda total, x: total + x) % 10 == 0


def _valid_ip(value: Column) -> Column:
    parts = F.transform(F.split(value, r"\."), lambda p: F.regexp_replace(p, "^0+(?=.)", ""))
    return F.forall(parts, lambda p: (F.char_length(p) < 3) | ((F.char_length(p) == 3) & (p <= "255")))


def _valid_card(value: Column) -> Column:
    digits = _digits(value)
    return F.char_length(digits).between(14, 19) & luhn(digits)


def pattern_matches(text: Column) -> Column:
    """Matches of the base patterns, checked or not."""
    return F.concat(
        matches(text, EMAIL, "email", text.contains("@")),
        matches(text, IP, "ip"),
        F.when(text.rlike(r"(?:[0-9][\x20-]?){13}"), matches(text, CARD, "card")).otherwise(F.array().cast(NONE)),
        matches(text, PHONE, "phone", text.contains("+")),
    )


def passes(span: Column) -> Column:
    """Whether a match of a base pattern passes its kind's rule."""
    value = span["value"]
    return (
        F.when(span["kind"] == "ip", _valid_ip(value))
        .when(span["kind"] == "card", _valid_card(value))
        .when(span["kind"] == "phone", F.char_length(_digits(value)).between(10, 15))
        .otherwise(F.lit(True))
    )


def _loose_matches(text: Column) -> Column:
    return F.concat(
        matches(text, LOOSE_ID, "id"),
        matches(text, LOOSE_PHONE, "phone"),
        matches(text, LOOSE_EMAIL, "email", text.rlike(r"[\[(](?:at|AT)[\])]")),
        matches(text, LOOSE_NAME, "name"),
    )


def _vote(yes: Column, no: Column) -> Column:
    return F.when(yes, 1).when(no, 0).otherwise(-1)


def _described(text: Column, span: Column, base: Column, strict: Column) -> Column:
    """A span with its votes (1, 0, or -1 to abstain) and features."""
    kind, value = span["kind"], span["value"]
    before = F.substring(text, F.greatest(span["start"] - 29, F.lit(1)), F.least(span["start"], F.lit(30)))
    digits, size = F.char_length(_digits(value)), F.char_length(value)
    known_end = F.lower(F.substring_index(F.regexp_replace(value, r"[\])\x20]+$", ""), ".", -1)).isin(DOMAIN_ENDS)
    reserved = value.rlike(r"^(?:0|127|255)\.")
    issuer = _digits(value).rlike("^(?:4|5[1-5]|2[2-7]|3[47]|6011|65|35)")
    named = F.arrays_overlap(F.split(value, " "), F.lit(FIRST_NAMES))
    gazetteer = (
        F.when(kind == "email", _vote(known_end, F.lit(False)))
        .when(kind == "ip", _vote(F.lit(False), reserved))
        .when(kind == "card", _vote(issuer, ~issuer))
        .when(kind == "name", _vote(named, F.lit(False)))
        .otherwise(F.lit(-1))
    )
    grouped = value.rlike(r"^\+|^\(?[0-9]{3}\)?[\x20.-][0-9]{3}[\x20.-][0-9]{4}$|^(?:[0-9]{4}[\x20-]){3}[0-9]{2,4}$")
    shape = (
        F.when(kind.isin("phone", "card"), _vote(grouped, F.lit(False)))
        .when(kind == "id", _vote(~value.rlike("^(?:000|666|9)"), value.rlike("^(?:000|666|9)")))
        .otherwise(F.lit(-1))
    )
    fields = {
        "kind": kind,
        "start": span["start"],
        "end": span["end"],
        "value": value,
        "base": base,
        "pattern": _vote(base, strict & ~base),
        "gazetteer": gazetteer,
        "context": _vote(before.rlike(TELLING), before.rlike(MISLEADING)),
        "shape": shape,
        "size": F.when(size < 10, 0).when(size < 15, 1).when(size < 25, 2).otherwise(3),
        "digits": F.least(F.floor(digits * 3 / F.greatest(size, F.lit(1))), F.lit(2)).cast("int"),
        "marks": F.least(F.char_length(F.regexp_replace(value, "[A-Za-z0-9]", "")), F.lit(4)),
        "before": F.when(before.rlike(r"[:=]\x20?$"), 2).when(before.rlike(r"[,;(]\x20?$"), 1).otherwise(0),
    }
    return F.struct(*(column.alias(name) for name, column in fields.items()))


def with_candidates(docs: DataFrame, result: str, text: str = "text") -> DataFrame:
    """``docs`` with an array column of described candidates; an input column of that name is replaced.

    Base spans come first. A null text counts as empty. Other candidates overlap neither
    base spans nor one of a kind listed before them.
    """
    body = F.coalesce(F.col(text), F.lit(""))
    names = [name for name in docs.columns if name != result]
    # Each generator of one row keeps a step's result in one place, to be used more than once.
    step = docs.select(*names, F.explode(F.array(F.struct(body.alias("body"), pattern_matches(body).alias("strict"), _loose_matches(body).alias("loose")))).alias("__s"))
    strict = F.transform(F.col("__s.strict"), lambda s: F.struct(s.alias("span"), passes(s).alias("ok")))
    step = step.select(*names, F.explode(F.array(F.struct("__s.body", "__s.loose", strict.alias("strict")))).alias("__s"))
    base = F.transform(F.filter("__s.strict", lambda s: s["ok"]), lambda s: s["span"])
    failed = F.transform(F.filter("__s.strict", lambda s: ~s["ok"]), lambda s: s["span"])
    step = step.select(*names, F.explode(F.array(F.struct("__s.body", "__s.loose", base.alias("base"), failed.alias("failed")))).alias("__s"))
    base, failed, loose, whole = (F.col(f"__s.{n}") for n in ("base", "failed", "loose", "body"))
    free = F.filter(loose, lambda s: ~overlaps(s, base))
    first = F.filter(free, lambda s: (s["kind"] != "phone") | ~overlaps(s, F.filter(free, lambda o: o["kind"] == "id")))
    described = F.concat(
        F.transform(base, lambda s: _described(whole, s, F.lit(True), F.lit(True))),
        F.transform(F.filter(failed, lambda s: ~overlaps(s, F.concat(base, first))), lambda s: _described(whole, s, F.lit(False), F.lit(True))),
        F.transform(first, lambda s: _described(whole, s, F.lit(False), F.lit(False))),
    )
    some = F.size(base) + F.size(failed) + F.size(loose) > 0
    return step.select(*names, F.when(some, described).otherwise(F.array().cast(f"array<{CANDIDATE}>")).alias(result))


@dataclass(frozen=True)
class SpanClassifier:
    """``weights`` by (feature or vote, value); candidates with at least ``keep`` are personal data."""

    weights: dict[tuple[str, object], float]
    bias: float
    reliability: dict[str, dict[int, dict[int, float]]]
    keep: float = 0.5

    def probability(self, span: Column) -> Column:
        total = F.lit(self.bias)
        for (name, value), weight in sorted(self.weights.items(), key=str):
            total = total + F.when(span[name] == value, weight).otherwise(0.0)
        return 1 / (1 + F.exp(-total))


def train_classifier(candidates: DataFrame, column: str, rounds: int = 40, keep: float = 0.5) -> SpanClassifier:
    """Learn from the candidates of all rows, by their counts per vote and feature pattern."""
    names = list(dict.fromkeys(VOTES + FEATURES))
    counted = candidates.select(F.explode(column).alias("c")).groupBy(*(F.col(f"c.{n}").alias(n) for n in names)).agg(F.count(F.lit(1)).alias("n"))
    rows = sorted((r.asDict() for r in counted.collect()), key=str)
    likely, reliability = _reliabilities(rows, rounds)
    weights, bias = _logistic(rows, likely)
    return SpanClassifier(weights, bias, reliability, keep)


def _reliabilities(rows: list[dict], rounds: int) -> tuple[list[float], dict]:
    """Expectation-maximisation: how likely each row is personal data, and each labeler's votes by truth."""
    likely = []
    for row in rows:
        cast = [row[v] for v in VOTES if row[v] >= 0]
        likely.append((1 + sum(cast)) / (2 + len(cast)))
    votes: dict[str, dict[int, dict[int, float]]] = {}
    for _ in range(rounds):
        total = sum(r["n"] for r in rows)
        prior = (1 + sum(r["n"] * p for r, p in zip(rows, likely))) / (2 + total)
        for labeler in VOTES:
            votes[labeler] = {}
            for truth in (0, 1):
                # Labelers are taken to be right more often than not: the start of their counts.
                seen = {v: (2.0 if v == truth else 1.0) for v in (-1, 0, 1)}
                for row, p in zip(rows, likely):
                    seen[row[labeler]] += row["n"] * (p if truth else 1 - p)
                votes[labeler][truth] = {v: x / sum(seen.values()) for v, x in seen.items()}
        likely = []
        for row in rows:
            odds = math.log(prior / (1 - prior)) + sum(math.log(votes[v][1][row[v]] / votes[v][0][row[v]]) for v in VOTES if row[v] >= 0)
            likely.append(1 / (1 + math.exp(-max(-30.0, min(30.0, odds)))))
    return likely, votes


def _logistic(rows: list[dict], likely: list[float], steps: int = 400, rate: float = 1.0, decay: float = 0.01) -> tuple[dict, float]:
    """Weighted logistic regression on the categories of votes and features, by gradient steps."""
    names = VOTES + FEATURES
    weights = {(n, r[n]): 0.0 for r in rows for n in names}
    bias, total = 0.0, sum(r["n"] for r in rows) or 1
    keys = [[(n, r[n]) for n in names] for r in rows]
    for _ in range(steps):
        slopes, lean = dict.fromkeys(weights, 0.0), 0.0
        for row, own, p in zip(rows, keys, likely):
            score = bias + sum(weights[k] for k in own)
            error = row["n"] / total * (1 / (1 + math.exp(-max(-30.0, min(30.0, score)))) - p)
            lean += error
            for k in own:
                slopes[k] += error
        bias -= rate * lean
        for k, slope in slopes.items():
            weights[k] -= rate * (slope + decay / len(keys or [1]) * weights[k])
    return weights, bias


def base_spans(candidates: Column) -> Column:
    return in_order(_plain(F.filter(candidates, lambda c: c["base"])), KINDS)


def all_spans(candidates: Column, classifier: SpanClassifier) -> Column:
    """Base spans and the candidates that the classifier keeps, in order."""
    kept = F.filter(candidates, lambda c: c["base"] | (classifier.probability(c) >= classifier.keep))
    return in_order(_plain(kept), KINDS)


def _plain(spans: Column) -> Column:
    return F.transform(spans, lambda s: F.struct(s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end"), s["value"].alias("value")))


def redacted(text: Column, spans: Column) -> Column:
    """The text with each span, or run of overlapping spans, replaced by ``[KIND]`` of its first."""
    begin = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))

    def step(done: Column, span: Column) -> Column:
        gap = F.substring(text, done["at"] + 1, F.greatest(span["start"] - done["at"], F.lit(0)))
        more = F.concat(done["out"], gap, F.lit("["), F.upper(span["kind"]), F.lit("]"))
        return F.struct(
            F.greatest(done["at"], span["end"]).alias("at"),
            F.when(span["start"] >= done["at"], more).otherwise(done["out"]).alias("out"),
        )

    rest = lambda done: F.concat(done["out"], F.substring(text, done["at"] + 1, F.char_length(text)))
    return F.when(F.size(spans) == 0, text).otherwise(F.aggregate(spans, begin, step, rest))
