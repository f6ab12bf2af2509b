import hashlib
import random
import sys
from pathlib import Path

import duckdb
import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

sys.path.insert(0, str(Path(__file__).parent))
import brute  # noqa: E402

from tidemark.llm import bpe, decontamination, licenses, ngram_join, paragraph_dedup, pii, queries, repetition, secrets  # noqa: E402
from tidemark.llm.components import connected_components  # noqa: E402
from tidemark.llm.groups import BLOCK  # noqa: E402

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, kept string, rep string, body string, key string, spans string"


def prose(rnd, count, spread=400):
    return " ".join("".join(rnd.choice("bcdfg") + rnd.choice("aeiou") for _ in range(1 + rnd.randint(0, spread) % 4)) for _ in range(count))


@pytest.fixture(scope="module")
def texts():
    rnd = random.Random(1)
    base = [prose(rnd, n) for n in (60, 80, 120, 300, 70, 55)]
    near = [" ".join(w if i != 30 else "changed" for i, w in enumerate(base[2].split()))]
    cases = [None, "", "   \n\t ", "one", "two words", "aé 日本 \U0001f642 end", "12 34", base[0], base[0], base[2], *near, *base[3:]]
    cases += [base[1] + "\n" + base[1], " ".join(["same"] * 90), prose(rnd, 8000), "x" * 60000]
    cases += ["mail a.b@c.org, 10.0.0.1 and 300.1.1.1, 4111 1111 1111 1111, +1 (555) 123-4567.", "token = 'abcd1234efgh' AKIAABCDEFGHIJKL12 " + "0123456789abcdef" * 3]
    cases += [base[4] + "\nReleased under the MIT License.\n", "All rights reserved."]
    return dict(enumerate(cases)) | {90: base[0], 91: None}


@pytest.fixture(scope="module")
def docs(spark, texts):
    rows = [(i, t, None, None, None, "x", "x", "x", "x", "x") for i, t in texts.items()]
    return spark.createDataFrame(rows, SCHEMA).repartition(3).cache()


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def test_rules_equal_brute_force(docs, texts):
    rows = docs.select("doc_id", repetition.repetition_verdict(F.col("text")).alias("v")).collect()
    assert len(rows) == len(texts)
    for r in rows:
        v = r.v
        assert (v.n_words, v.word_chars, v.n_symbols, v.n_dup_lines, v.n_repeat_words, v.base_failed) == brute.rules(texts[r.doc_id])
        if v.n_words < 700:
            assert v.longest_repeat_words == brute.longest_repeat(brute.words(texts[r.doc_id]))
        assert not (v.kept and v.base_failed)


def test_bpe_equals_library(docs, texts):
    path = public_tokenizers.path("byte_bpe_50k.json")
    library = Tokenizer.from_file(path)
    for r in docs.select("doc_id", bpe.encode_and_decode(F.col("text"), path).alias("c")).collect():
        ids = library.encode(texts[r.doc_id] or "", add_special_tokens=False).ids
        assert np.frombuffer(bytes(r.c.ids), "<u4").tolist() == ids
        assert r.c.decoded == library.decode(ids, skip_special_tokens=False)
    codec, rnd = bpe.Codec(path), random.Random(2)
    parts = ["a", " ", "\n", "  ", "\t", "é", "1", "'s", "<|endoftext|>", "!!", "the", " ", "　", "\r\n", "́", "Ab"]
    for _ in range(3000):
        text = "".join(rnd.choice(parts) for _ in range(rnd.randint(0, 12)))
        assert np.frombuffer(codec.encode(text), "<u4").tolist() == library.encode(text, add_special_tokens=False).ids


def test_decontamination_equals_brute_force_in_any_blocks(spark, docs, texts):
    items = [("1", texts[9][:400]), ("2", "two words"), ("3", None), (None, texts[9]), ("4", ""), ("5", texts[10][100:300]), ("1", "one")]
    benchmark = spark.createDataFrame(items, "item_id string, text string")
    known = [(n, t) for n, t in items if t]
    for size in (1 << 20, 150):
        rows = decontamination.with_matches(docs, benchmark, "kept", block_bytes=size)
        found = F.col("kept")
        for r in rows.select("doc_id", "kept", decontamination.hit_words(found).alias("hit"), decontamination.contaminated(found).alias("bad")).collect():
            n, hit, names = brute.contamination(texts[r.doc_id], [(name or "", t) for name, t in known])
            assert (r.kept.n_words, r.hit, r.kept["items"]) == (n, hit, [name for name in names if name])
            assert r.bad == (hit > 0 and 20 * hit >= n)


def test_decontamination_holds_one_block_of_items_at_a_time(spark, monkeypatch):
    rnd = random.Random(18)
    items = [("same", prose(rnd, 30)) for _ in range(12)]
    docs = spark.createDataFrame([(i, text) for i, (_, text) in enumerate(items)] + [(12, prose(rnd, 30))], "doc_id bigint, text string")
    made, held = [], []
    index_items, context = decontamination.index_items, type(spark.sparkContext)
    broadcast = context.broadcast

    def counted(rows):
        made.append(sum(len(body) for _, body in rows))
        return index_items(rows)

    def kept(self, value):
        out = broadcast(self, value)
        held.append(out)
        destroy = out.destroy
        out.destroy = lambda *a: (held.remove(out), destroy(*a))
        # The one before is gone when the next is made.
        assert len(held) == 1
        return out

    monkeypatch.setattr(decontamination, "index_items", counted)
    monkeypatch.setattr(context, "broadcast", kept)
    total = sum(len(text) for _, text in items)
    found = decontamination.with_matches(docs, spark.createDataFrame(items, "item_id string, text string"), "found", block_bytes=total // 4)
    rows = found.select("doc_id", "found.items", decontamination.hit_words(F.col("found")).alias("hit")).collect()
    assert sorted((r.doc_id, r.items, r.hit) for r in rows) == [(i, ["same"], 30) for i in range(12)] + [(12, [], 0)]
    assert len(made) >= 4 and sum(made) == total and max(made) < total


def test_near_duplicates_equal_brute_force(docs, texts):
    want = brute.classes({i: t for i, t in texts.items() if len((t or "").split()) < 9000})
    rows = ngram_join.near_duplicates(docs).collect()
    assert len(rows) == len(texts)
    for r in rows:
        assert (r.class_id, r.n_links) == want[r.doc_id]
    kept = {r.doc_id for r in ngram_join.one_of_each(docs).collect()}
    assert kept == {i for i, (c, _) in want.items() if c == i}


def test_large_near_group_in_blocks(spark):
    rnd = random.Random(3)
    base = prose(rnd, 400).split()
    texts = {i: " ".join(w if k != i % 380 else f"new{i}" for k, w in enumerate(base)) for i in range(2 * BLOCK + 60)}
    docs = spark.createDataFrame(list(texts.items()), "doc_id bigint, text string").repartition(4)
    rows = ngram_join.near_duplicates(docs).collect()
    assert {r.class_id for r in rows} == {0}
    assert {r.n_links for r in rows} == {len(texts) - 1}


def test_repeated_rows_and_null_keys(spark):
    text = prose(random.Random(4), 70)
    docs = spark.createDataFrame([(None, text), (5, text), (5, text), (None, None), (None, "")], "doc_id bigint, text string")
    rows = ngram_join.near_duplicates(docs).collect()
    assert len(rows) == 5 and [r.n_copies for r in rows if r.class_id == 5] == [3, 3, 3]
    assert sorted((r.doc_id is None, r.text) for r in ngram_join.one_of_each(docs).filter("text <> ''").collect()) == [(False, text)]


def test_paragraphs_catch_shared_passages_only(spark):
    rnd = random.Random(5)
    passage = prose(rnd, 55)
    docs = {i: prose(rnd, 120) for i in range(12)}
    for i in (1, 4, 7):
        w = docs[i].split()
        docs[i] = " ".join(w[:37]) + " " + passage + " " + " ".join(w[37:])
    docs[8] = docs[9]
    line = prose(rnd, 40)
    docs[10] += "\n" + line
    docs[11] += "\n" + line.replace(" ", " ").rsplit(" ", 1)[0] + " other"
    rows = paragraph_dedup.repeated_units(spark.createDataFrame(list(docs.items()), "doc_id bigint, text string")).collect()
    assert {r.doc_id for r in rows} == {1, 4, 7, 8, 9, 10, 11}
    assert {(r.doc_id, r.removed) for r in rows if r.kind == "text"} == {(8, False), (9, True)}
    assert {r.doc_id for r in rows if r.kind == "passage" and r.removed} >= {4, 7}
    assert all(r.kept_key == 1 for r in rows if r.doc_id in (4, 7))
    assert any(r.kind == "paragraph" and r.removed and r.kept_key == 10 for r in rows if r.doc_id == 11)


def test_passages_repeated_within_a_text(spark):
    rnd = random.Random(16)
    settings = paragraph_dedup.ParagraphSettings()
    for _ in range(40):
        run = prose(rnd, 51).split()
        joined = " ".join(run[:34]).encode()
        hashes = paragraph_dedup.shingle_hashes(paragraph_dedup._layout([joined])[2], settings.anchor_words)
        least = int(np.argmin(hashes))
        texts = [prose(rnd, 60).split() + run + prose(rnd, 60).split(), prose(rnd, 60).split() + run[least : least + 3] + run + prose(rnd, 60).split()]
        one, two = paragraph_dedup._units([" ".join(t).encode() for t in texts], settings)
        assert set(one["passage_key"]) & set(two["passage_key"])
    phrase = prose(rnd, 30)
    rows = paragraph_dedup.repeated_units(spark.createDataFrame([(1, " ".join([phrase] * 100))], "doc_id bigint, text string")).collect()
    gone = set().union(*(range(r.first_word, r.end_word) for r in rows if r.kind == "passage" and r.removed))
    assert len(gone) >= 98 * 20 and not gone & set(range(30))


def test_passages_are_as_long_as_the_repeat(spark):
    rnd = random.Random(17)
    docs, want = {}, {}
    for i in range(12):
        run = prose(rnd, 51 + 13 * i).split()
        if i % 3 == 2:
            docs[2 * i + 1], docs[2 * i] = " ".join(["left", *prose(rnd, 9 * i).split(), *run]), " ".join(run + ["right"])
            want[2 * i + 1] = (1 + 9 * i, len(docs[2 * i + 1].split()), 0)
        else:
            docs[2 * i] = " ".join([*prose(rnd, 70).split(), "one", *run, "two", *prose(rnd, 80).split()])
            docs[2 * i + 1] = " ".join([*prose(rnd, 40).split(), "three", *run, "four", *prose(rnd, 10).split()])
            want[2 * i + 1] = (41, 41 + len(run), 71)
    rows = paragraph_dedup.repeated_units(spark.createDataFrame(list(docs.items()), "doc_id bigint, text string")).collect()
    got = {r.doc_id: (r.first_word, r.end_word, r.kept_first_word) for r in rows if r.kind == "passage" and r.removed}
    assert got == want and sum(r.kind == "passage" and r.removed for r in rows) == len(want)
    assert {(r.doc_id, r.first_word, r.end_word) for r in rows if r.kind == "passage" and not r.removed} == {(i - 1, k, k + b - a) for i, (a, b, k) in want.items()}


def test_short_lines_and_wrapped_paragraphs_are_units(spark):
    rnd = random.Random(15)
    docs = {i: prose(rnd, 60) for i in range(8)}
    docs[1] += "\nsubscribe to our weekly news letter today please"
    docs[2] += "\nSubscribe  to our weekly news letter today please"
    docs[3] += "\nRead more"
    docs[4] += "\n\nread more\n"
    # Near-equal when taken whole, wrapped differently, no line of 20 words in common.
    body = prose(rnd, 72).split()
    wrapped = [" ".join(body[i : i + 9]) for i in range(0, 72, 9)]
    docs[5] += "\n\n" + "\n".join(wrapped)
    body[36] = "changed"
    docs[6] += "\n \t\n" + "\r\n".join(" ".join(body[i : i + 12]) for i in range(0, 72, 12))
    # A line that is nearly all of its own paragraph is not a repeat of it.
    docs[7] += "\n\nshort head\n" + prose(rnd, 80)
    rows = paragraph_dedup.repeated_units(spark.createDataFrame(list(docs.items()), "doc_id bigint, text string")).collect()
    got = {(r.doc_id, r.first_word, r.end_word, r.kept_key, r.removed) for r in rows if r.kind == "paragraph"}
    assert got >= {(1, 60, 68, 1, False), (2, 60, 68, 1, True), (3, 60, 62, 3, False), (4, 60, 62, 3, True)}
    assert got >= {(5, 60, 132, 5, False), (6, 60, 132, 5, True)}
    assert not any(r.removed for r in rows if r.doc_id == 7)


def test_pii_base_spans_and_redaction(docs, texts):
    found = pii.with_candidates(docs, "spans").cache()
    model = pii.train_classifier(found, "spans")
    rows = found.select("doc_id", "text", pii.base_spans(F.col("spans")).alias("b"), pii.all_spans(F.col("spans"), model).alias("a"), pii.redacted(F.col("text"), pii.base_spans(F.col("spans"))).alias("t")).collect()
    for r in rows:
        want = brute.pii(texts[r.doc_id])
        assert [(s.start, s.kind, s.end) for s in r.b] == [(a, k, b) for a, _, k, b in want]
        assert {(s.kind, s.start, s.end) for s in r.b} <= {(s.kind, s.start, s.end) for s in r.a}
        if not want:
            assert r.t == texts[r.doc_id]
    assert [r.t for r in rows if r.text and r.text.startswith("mail")] == ["mail [EMAIL], [IP] and 300.1.1.1, [CARD], [PHONE]."]


def test_secrets_base_spans_and_random_strings(spark, docs, texts):
    odds = secrets.train_log_odds(spark.read.parquet("/root/testdata/sf0.01/documents.parquet"))
    mixed = "q8Zr2LkX0vTn5BdW7yHs1GfJ"
    extra = spark.createDataFrame([(1, f"see {mixed} and thentionereststandtheon")], "doc_id bigint, text string")
    spans = extra.select(secrets.secrets(F.col("text"), odds).alias("s")).first().s
    assert [(s.kind, s.value) for s in spans] == [("random", mixed)]
    for r in secrets.find_secrets(docs).collect():
        assert [(s.start, s.kind, s.end) for s in r.base] == [(a, k, b) for a, _, k, b in brute.secrets(texts[r.doc_id])]


def test_short_secrets_and_parts_of_joined_runs(spark):
    odds = secrets.train_log_odds(spark.read.parquet("/root/testdata/sf0.01/documents.parquet"))
    short, mixed = "k7Qz0XvB2nWp9", "q8Zr2LkX0vTn5BdW7yHs1GfJ"
    path = "/".join(["international", "station", "mention", "interest", "thentherein"] * 6)
    text = f"use {short} in {path}/{mixed} and international-station, 4111111111111111"
    extra = spark.createDataFrame([(1, text)], "doc_id bigint, text string")
    spans = extra.select(secrets.secrets(F.col("text"), odds).alias("s")).first().s
    assert [(s.kind, s.value) for s in spans] == [("random", short), ("random", mixed)]
    assert all(text[s.start : s.end] == s.value for s in spans)


def test_licenses_equal_sql(docs, texts):
    got = sorted((r.doc_id, r.segment, r.license, r.dice) for r in licenses.scan_licenses(docs).collect())
    con = duckdb.connect()
    con.execute("create table documents(doc_id bigint, text varchar)")
    con.executemany("insert into documents values (?, ?)", list(texts.items()))
    assert got == sorted(con.execute(licenses.oracle_sql()).fetchall())
    assert {g[2] for g in got} == {"mit", "rights-reserved"}


def test_components_of_a_path(spark):
    order = list(range(40))
    random.Random(6).shuffle(order)
    edges = spark.createDataFrame([(order[i], order[i + 1]) for i in range(39)] + [(100, 101), (102, 102)], "u bigint, v bigint")
    got = {r.node: r.component for r in connected_components(edges, "test").collect()}
    assert got == {n: 0 for n in range(40)} | {100: 100, 101: 100}


def test_components_with_frequent_nodes_equal_union_find(spark):
    """A star whose centre is joined by broadcast, its centre the largest node, and many small components."""
    rnd = random.Random(8)
    edges = [(5000, n) for n in range(2000, 3200)] + [(rnd.randrange(900), rnd.randrange(900)) for _ in range(450)] + [(3100, 7)]
    root: dict[int, int] = {}

    def find(n):
        root.setdefault(n, n)
        while root[n] != n:
            n = root[n]
        return n

    for u, v in edges:
        low, high = sorted((find(u), find(v)))
        root[high] = low
    alone = {n for n in root if all(u == v for u, v in edges if n in (u, v))}
    got = {r.node: r.component for r in connected_components(spark.createDataFrame(edges, "u bigint, v bigint"), "test").collect()}
    assert got == {n: find(n) for n in root if n not in alone}


def test_empty_tables(spark, empty):
    assert ngram_join.near_duplicates(empty).count() == 0
    assert ngram_join.one_of_each(empty).columns == empty.columns
    assert paragraph_dedup.repeated_units(empty).count() == 0
    assert secrets.find_secrets(empty).count() == 0 and licenses.scan_licenses(empty).count() == 0
    found = pii.with_candidates(empty, "spans")
    assert found.select(pii.all_spans(F.col("spans"), pii.train_classifier(found, "spans"))).collect() == []


def test_models_on_held_out_rows(spark):
    sf = "/root/testdata/sf0.01"
    lang = queries.QUERIES["op4_byte_cnn_language"](spark, sf).join(spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "lang"), "doc_id")
    assert lang.filter("held_out").agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int"))).first()[0] > 0.93
    quality = queries.QUERIES["op1_attention_quality"](spark, sf).join(spark.read.parquet(f"{sf}/labels.parquet").select("doc_id", "quality"), "doc_id")
    assert quality.filter("held_out").agg(F.avg((F.col("quality") == F.col("predicted")).cast("int"))).first()[0] > 0.9


def test_pipeline_rows(spark):
    import corpus_pipeline

    sf = "/root/testdata/sf0.001"
    source = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    items = [(str(r.item_id), r.text) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    judged = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", repetition.repetition_verdict(F.col("text")).alias("v"))
    kept = {r.doc_id: source[r.doc_id] for r in judged.filter("v.kept").collect()}
    kept = {i: kept[i] for i, (c, _) in brute.classes(kept).items() if c == i}
    spoilt = {i: brute.contamination(t, items) for i, t in kept.items()}
    kept = {i: t for i, t in kept.items() if not (spoilt[i][1] and 20 * spoilt[i][1] >= spoilt[i][0])}
    rows = corpus_pipeline.run(spark, sf).collect()
    assert {r.doc_id for r in rows} == set(kept) and all(r.round_trip for r in rows)
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    for r in rows:
        if not brute.pii(kept[r.doc_id]):
            assert r.text == kept[r.doc_id]
        ids = np.array(library.encode(r.text, add_special_tokens=False).ids, "<u4").tobytes()
        assert hashlib.sha256(ids).hexdigest() == hashlib.sha256(bytes(r.token_ids)).hexdigest()
        assert not brute.pii(r.text)
