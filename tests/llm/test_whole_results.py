import re
import time

import duckdb
import pytest
from pyspark.sql import functions as F

from tidemark.llm import decontamination, licenses, pii, secrets
from tidemark.llm.spans import BLOCK, matches

MIXED = "q8Zr2LkX0vTn5BdW7yHs1GfJ"


@pytest.fixture(scope="module")
def odds(spark):
    return secrets.train_log_odds(spark.read.parquet("/root/testdata/sf0.01/documents.parquet"))


def one(spark, text):
    return spark.createDataFrame([(1, text)], "doc_id bigint, text string")


def found_secrets(spark, odds, text):
    return [(s.kind, s.value) for s in one(spark, text).select(secrets.secrets(F.col("text"), odds).alias("s")).first().s if text[s.start : s.end] == s.value or s.kind == "assign"]


@pytest.mark.parametrize("count", [0, 1, BLOCK - 1, BLOCK, BLOCK + 1, 20000])
def test_places_of_many_matches_in_one_text(spark, count):
    text = "é " + " x".join(f"n{i}" for i in range(count)) + " end"
    began = time.time()
    spans = one(spark, text).select(matches(F.col("text"), "n[0-9]+", "k").alias("s")).first().s
    assert [(s.start, s.end, s.value) for s in spans] == [(m.start(), m.end(), m[0]) for m in re.finditer("n[0-9]+", text)]
    assert time.time() - began < 60


def test_what_a_base_span_leaves_of_a_run_is_judged(spark, odds):
    assert found_secrets(spark, odds, f"/AKIAABCDEFGHIJKL12/{MIXED}") == [("access", "AKIAABCDEFGHIJKL12"), ("random", MIXED)]
    assert found_secrets(spark, odds, f"{MIXED}/AKIAABCDEFGHIJKL12/x") == [("random", MIXED), ("access", "AKIAABCDEFGHIJKL12")]


def test_a_secret_has_no_ordinary_prefix(spark, odds):
    assert found_secrets(spark, odds, f"/x/{MIXED}") == [("random", MIXED)]
    assert found_secrets(spark, odds, f"see {MIXED}/{MIXED[::-1]}/the") == [("random", f"{MIXED}/{MIXED[::-1]}")]


def test_items_without_id_count_but_are_not_named(spark):
    benchmark = spark.createDataFrame([(None, "alpha beta"), ("7", "gamma")], "item_id string, text string")
    docs = spark.createDataFrame([(1, "alpha beta gamma"), (2, "alpha beta x")], "doc_id bigint, text string")
    rows = decontamination.with_matches(docs, benchmark, "f").select("doc_id", decontamination.hit_words(F.col("f")).alias("n"), "f.items").collect()
    assert sorted((r.doc_id, r.n, r.items) for r in rows) == [(1, 3, ["7"]), (2, 2, [])]


def test_notices_in_sentences_and_short_segments_equal_sql(spark):
    texts = {1: "Great tool. Released under the MIT License. Use it well.", 2: "a b", 3: "x; All rights reserved. ", 4: "All rights reserved.", 5: None, 6: "", 7: "One! Two? All rights reserved.\nReleased under the MIT License; yes"}
    docs = spark.createDataFrame(list(texts.items()), "doc_id bigint, text string")
    templates = licenses.TEMPLATES | {"x": "a b"}
    got = sorted((r.doc_id, r.segment, r.license, r.dice) for r in licenses.scan_licenses(docs, templates=templates).collect())
    con = duckdb.connect()
    con.execute("create table documents(doc_id bigint, text varchar)")
    con.executemany("insert into documents values (?, ?)", list(texts.items()))
    assert got == sorted(con.execute(licenses.oracle_sql(templates)).fetchall())
    assert {(g[0], g[2]) for g in got} == {(1, "mit"), (2, "x"), (3, "rights-reserved"), (4, "rights-reserved"), (7, "rights-reserved"), (7, "mit")}


def test_names_of_four_languages_are_candidates(spark):
    names = ["Mr. Müller", "Mrs. O'Brien", "Dr. Élodie Martin", "Sra. García", "Frau von der Leyen-Groß", "M. Théo de la Tour"]
    long = "a" * 300 + " [at] " + "b" * 90 + ".example"
    text = "; ".join([*names, long]) + "; Mr. lower"
    spans = pii.with_candidates(one(spark, text), "c").select(F.explode("c").alias("c")).select("c.kind", "c.value", "c.start", "c.end").collect()
    assert [s.value for s in sorted(spans, key=lambda s: s.start)] == [*names, long]
    assert all(text[s.start : s.end] == s.value for s in spans)
