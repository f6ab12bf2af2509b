"""Nulls, empty and very long texts, repeated rows, empty tables and clashing columns."""

import random
import sys
from collections import defaultdict
from itertools import combinations
from pathlib import Path

import public_tokenizers
import pytest
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).parent))
import brute  # noqa: E402

import corpus_pipeline  # noqa: E402
from tidemark.llm import bpe, decontamination, langid, mil_quality, paragraph_dedup, pii, repetition, secrets  # noqa: E402

SF = "/root/testdata/sf0.01"
SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, row string, key string, same string, u string, unit string, size string, units string, spans string, found string, kind string"
WORDS = "the quick station mentions another interesting house near every river and mountain while people walk slowly home".split()


def prose(rnd, count):
    return " ".join(rnd.choice(WORDS) + rnd.choice(["", "s", "ed"]) for _ in range(count))


@pytest.fixture(scope="module")
def rows():
    rnd = random.Random(21)
    body = prose(rnd, 120)
    texts = [(1, None), (2, ""), (3, " \n\t"), (4, "1234 !!"), (5, body), (5, body), (None, body), (None, None), (6, prose(rnd, 20000)), (7, "a" * 100000), (8, "É" * 300 + "\n" + prose(rnd, 60)), (9, body + "\nmail a.b@c.org now")]
    return texts


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame([(i, t, "en", "s", None if t is None else len(t), *["x"] * 10) for i, t in rows], SCHEMA).repartition(4)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="module")
def trained(spark):
    documents = spark.read.parquet(f"{SF}/documents.parquet")
    return mil_quality.train_quality_model(spark.read.parquet(f"{SF}/labels.parquet"), documents), langid.train_language_model(documents, documents)


def test_scores_and_languages(docs, empty, rows, trained):
    quality, language = trained
    found = docs.select("doc_id", "text", mil_quality.quality_score(F.col("text"), quality).alias("score"), langid.predicted_language(F.col("text"), language).alias("p")).collect()
    assert len(found) == len(rows)
    by_text = defaultdict(set)
    for r in found:
        assert 0 <= r.score <= 1 and 0 <= r.p.score <= 1
        assert (r.p.lang_pred == "und") == (r.text is None or not any(c.isalpha() for c in r.text))
        by_text[r.text].add((r.score, r.p.lang_pred, r.p.score))
    assert all(len(v) == 1 for v in by_text.values())
    assert empty.select(mil_quality.quality_score(F.col("text"), quality).alias("s"), langid.predicted_language(F.col("text"), language).alias("p")).collect() == []


def test_empty_tables_of_row_operators(spark, empty):
    path = public_tokenizers.path("byte_bpe_50k.json")
    assert empty.select(bpe.encode_and_decode(F.col("text"), path).alias("c"), repetition.repetition_verdict(F.col("text")).alias("v")).collect() == []
    benchmark = spark.read.parquet(f"{SF}/benchmark.parquet")
    assert decontamination.with_matches(empty, benchmark, "found").columns[-1] == "found"
    assert decontamination.with_matches(empty, benchmark, "found").collect() == []
    none = spark.createDataFrame([], "item_id bigint, text string")
    found = decontamination.with_matches(spark.createDataFrame([(1, "a b"), (2, None)], "doc_id bigint, text string"), none, "found").select("doc_id", "found.*").collect()
    assert sorted((r.doc_id, r.n_words, r["items"]) for r in found) == [(1, 2, []), (2, 0, [])]
    candidates = pii.with_candidates(empty, "spans")
    assert candidates.columns == [*(c for c in empty.columns if c != "spans"), "spans"] and candidates.collect() == []
    assert secrets.find_secrets(empty).columns == ["doc_id", "base", "spans"]


def test_repeated_units_of_odd_rows(docs, empty):
    found = paragraph_dedup.repeated_units(docs).collect()
    copies = [r for r in found if r.kind == "text" and r.end_word == 120]
    assert sorted((r.doc_id is None, r.doc_id, r.kept_key, r.removed) for r in copies if r.doc_id) == [(False, 5, 5, False), (False, 5, 5, True)]
    assert [(r.kept_key, r.removed) for r in copies if r.doc_id is None] == [(5, True)]
    # The line, and the two lines together, which are nearly equal to it.
    lines = [r for r in found if r.kind == "paragraph" and r.doc_id == 9]
    assert sorted((r.first_word, r.end_word, r.kept_key, r.removed) for r in lines) == [(0, 120, 5, True), (0, 123, 5, True)]
    assert not any(r.doc_id in (1, 2, 3) for r in found) and paragraph_dedup.repeated_units(empty).collect() == []


def brute_paragraphs(texts):
    """Lines and groups of lines, linked if equal or if n-grams overlap enough: (key, first, end, kept key, kept first)."""
    units, seen = [], set()
    for key in sorted(texts):
        words = brute.words((texts[key] or "").translate(brute.LOWER))
        if tuple(words) in seen or not words:
            continue
        seen.add(tuple(words))
        at, group = 0, []
        for line in [*(texts[key]).split("\n"), ""]:
            n = len(brute.words(line))
            if n:
                group.append((at, at + n))
                at += n
            elif group:
                units += [(key, a, b, tuple(words[a:b])) for a, b in {*group, (group[0][0], group[-1][1])}]
                group = []
    units.sort()
    grams = [{u[3][i : i + 5] for i in range(len(u[3]) - 4)} for u in units]
    least = list(range(len(units)))

    def root(i):
        while least[i] != i:
            i = least[i]
        return i

    equal = defaultdict(list)
    for i, u in enumerate(units):
        equal[u[3]].append(i)
    links = [(v[0], j) for v in equal.values() for j in v[1:]]
    heads = [v[0] for v in equal.values() if grams[v[0]]]
    index = defaultdict(set)
    for i in heads:
        for g in grams[i]:
            index[g].add(i)
    for i in heads:
        for j in set().union(*(index[g] for g in grams[i])):
            if j > i and 5 * len(grams[i] & grams[j]) >= 4 * len(grams[i] | grams[j]):
                links.append((i, j))
    for i, j in links:
        a, b = sorted((root(i), root(j)))
        least[b] = a
    clusters = defaultdict(list)
    for i in range(len(units)):
        clusters[root(i)].append(units[i])
    return {(*u[:3], min(c)[0], min(c)[1]) for c in clusters.values() if len(c) > 1 for u in c}


def test_paragraphs_equal_brute_force(spark):
    documents = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    want = brute_paragraphs({r.doc_id: r.text for r in documents.collect()})
    found = paragraph_dedup.repeated_units(documents).filter("kind = 'paragraph'").collect()
    got = {(r.doc_id, r.first_word, r.end_word, r.kept_key, r.kept_first_word) for r in found}
    assert len(got) == len(found) and len(got & want) >= 0.99 * len(want) and len(got - want) <= 0.01 * len(got)


def test_long_runs_leave_no_shared_words(spark):
    """Of any run of 51 words that two texts share, one of them loses at least the passage in it."""
    documents = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    texts = {r.doc_id: brute.words((r.text or "").translate(brute.LOWER)) for r in documents.collect()}
    gone = defaultdict(set)
    for r in paragraph_dedup.repeated_units(documents).collect():
        if r.removed:
            gone[r.doc_id].update(range(r.first_word, r.end_word))
    first, lost = {}, 0
    for key in sorted(texts):
        words = texts[key]
        for i in range(len(words) - 50):
            run = tuple(words[i : i + 51])
            if run in first:
                other = first[run]
                lost += not (gone[key] & set(range(i, i + 51)) or gone[other[0]] & set(range(other[1], other[1] + 51)))
            else:
                first[run] = (key, i)
    assert lost == 0


@pytest.mark.parametrize("number", range(len(corpus_pipeline.STAGES)))
def test_pipeline_stages(spark, docs, empty, rows, number):
    name, stage = corpus_pipeline.STAGES[number]
    last = number == len(corpus_pipeline.STAGES) - 1
    out = stage(spark, docs, SF)
    assert out.columns[: len(docs.columns)] == docs.columns if last else out.columns == docs.columns
    kept = sorted(((r.doc_id, r.text) for r in out.select("doc_id", "text").collect()), key=str)
    given = sorted(rows, key=str)
    if name == "quality_rules":
        assert {i for i, _ in kept} <= {5, None, 6, 9, 8} and not any(t is None for _, t in kept)
    elif name == "near_duplicates":
        # Texts without words are classes of their own; of the copies and the near copy one stays.
        assert [t for _, t in kept if t and t.startswith(rows[4][1])] == [rows[4][1]]
        assert len(kept) == len(given) - 3
    elif name == "redact_pii":
        assert [t for i, t in kept if i == 9] == [rows[-1][1].replace("a.b@c.org", "[EMAIL]")] and len(kept) == len(given)
    else:
        assert kept == given
    none = stage(spark, empty, SF)
    assert none.collect() == [] and none.columns == out.columns


def test_close_pairs_have_a_brute_force():
    texts = {1: "a b c d e f", 2: "x\n\na B c d e f", 3: "a b c d e g"}
    assert brute_paragraphs(texts) == {(1, 0, 6, 1, 0), (2, 1, 7, 1, 0)}
    assert len(list(combinations(texts, 2))) == 3
