import hashlib
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm.exact_dedup import FingerprintSettings, Polynomial, equal_classes, exact_duplicates
from tidemark.llm.skew import attach
from tidemark.llm.workspace import materialize

SCHEMA = "doc_id bigint, text string, row string, body string, size string, keep_id string, first string"


def plain(text):
    return re.sub(r"[\x20\x09-\x0D]+", " ", text or "")


def brute(rows):
    """(doc_id, keep_id, size, kept, sha) of each row; one of equal rows is kept."""
    groups = {}
    for key, text in rows:
        groups.setdefault(plain(text), []).append(key)
    out = []
    for body, keys in groups.items():
        keys.sort(key=lambda k: (k is None, k or 0))
        sha = hashlib.sha256(body.encode()).hexdigest()
        out += [(k, keys[0], len(keys), n == 0, sha) for n, k in enumerate(keys)]
    return sorted(out, key=repr)


def cases():
    rnd = random.Random(3)
    long = "".join(rnd.choice("abc \n") for _ in range(30000))
    rows = [(5, None), (4, ""), (9, " "), (8, "\t\n"), (7, "a  b"), (3, "a\nb"), (None, "a b"), (None, "a b"), (3, "a b"), (3, "a b "), (11, "é x"), (12, "é x")]
    rows += [(20, long), (21, long.replace(" ", "\t")), (22, long[:-1] + "d"), (23, "b" + long[1:]), (24, long + long)]
    rows += [(100 + i, "copy of all") for i in range(300)] + [(500 + i, f"only {i % 40}") for i in range(60)]
    return rows


def result(spark, rows, **settings):
    docs = spark.createDataFrame([(k, t, "x", "x", "x", "x", "x") for k, t in rows], SCHEMA).repartition(5)
    found = exact_duplicates(docs, FingerprintSettings(**settings)).collect()
    return sorted([(r.doc_id, r.keep_id, r.group_size, r.kept, r.text_sha256) for r in found], key=repr)


def test_classes_equal_brute_force(spark):
    rows = cases()
    assert result(spark, rows) == brute(rows)


def test_huge_texts_in_chunks_give_the_same(spark):
    rows = cases()
    assert result(spark, rows, chunk_bytes=512, huge_bytes=2000, part_rows=7) == brute(rows)


def test_colliding_fingerprints_are_told_apart(spark):
    rows = [(i, t) for i, t in cases() if i is None or i < 24 or i >= 500]
    assert result(spark, rows, modulus=2, points=(1, 1, 1, 1), chunk_bytes=700) == brute(rows)


def test_empty_table(spark):
    assert exact_duplicates(spark.createDataFrame([], SCHEMA)).collect() == []


@pytest.mark.parametrize("modulus", [(1 << 31) - 1, 65521])
def test_fingerprints_compose(modulus):
    rnd = random.Random(5)
    body = bytes(rnd.randrange(256) for _ in range(5000))
    want = [sum((b + 1) * pow(x, i, modulus) for i, b in enumerate(body)) % modulus for x in FingerprintSettings().points]
    for step in (1, 64, 999, 1 << 16):
        maker = Polynomial(FingerprintSettings(modulus=modulus, chunk_bytes=step))
        hi, lo = maker.texts([b"before", body, b""])[1].tolist()
        assert [hi >> 31, hi & (1 << 31) - 1, lo >> 31, lo & (1 << 31) - 1] == want
        cuts = np.arange(0, len(body), step)
        parts = maker.chunks(np.frombuffer(body, np.uint8), cuts, np.minimum(cuts + step, len(body)))
        assert (maker.shifted(parts, cuts).sum(axis=0) % modulus).tolist() == want


def test_classes_of_other_tables(spark):
    base = spark.range(50).select(F.col("id").alias("row"), (F.col("id") % 7).cast("string").cast("binary").alias("body"), F.lit(1).cast("bigint").alias("n_bytes"))
    found = equal_classes(materialize(base, "test"), []).collect()
    assert {(r.row, r.first) for r in found} == {(i, i % 7) for i in range(50)}


def test_attach_joins_frequent_and_rare_keys(spark):
    rows = spark.createDataFrame([(1 if i % 3 == 0 else i, i) for i in range(3000)], "k int, v int")
    info = rows.groupBy("k").agg(F.count("v").alias("n"), F.sum("v").alias("s"))
    got = attach(rows, info, ["k"], "n", 3000)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, rows.join(info, "k").collect()))
