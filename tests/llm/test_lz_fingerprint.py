"""LZ phrase fingerprints: the pairing with the next document, and likeness against exact sets."""

import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from repweave.llm import lz_fingerprint as L


def plain_phrases(text):
    pieces = [w[i:i + L.PIECE] for w in text.encode().split() for i in range(0, len(w), L.PIECE)]
    seen, now = set(), ()
    for p in pieces:
        now = (*now, p)
        if now not in seen:
            seen.add(now)
            now = ()
    return seen


def test_phrases_are_lz78():
    rng = random.Random(1)
    for _ in range(200):
        t = " ".join(rng.choices(["a", "b", "abcdefghijk", "é" * 9, "c"], k=rng.randint(0, 80)))
        assert len(L.phrases(t)) == len(plain_phrases(t))


def test_likeness_estimates_jaccard():
    rng = random.Random(2)
    words = [f"w{i}" for i in range(2000)]
    gaps = []
    for share in (0, 0.2, 0.5, 0.8, 1):
        a = rng.choices(words, k=1500)
        b = a[:int(share * 1500)] + rng.choices(words, k=1500 - int(share * 1500))
        x, y = plain_phrases(" ".join(a)), plain_phrases(" ".join(b))
        gaps.append(abs(L.likeness(L.signature(" ".join(a)), L.signature(" ".join(b))) - len(x & y) / len(x | y)))
    assert max(gaps) < 0.2
    short = L.signature("a b c"), L.signature("a b d")
    assert L.likeness(*short) == pytest.approx(2 / 4)
    empty = np.empty(0, dtype=np.uint32)
    assert L.likeness(empty, empty) == 1.0 and L.likeness(empty, short[0]) == 0.0


@pytest.mark.parametrize("n,parts", [(1, 8), (2, 8), (57, 8), (57, 1), (300, 5)])
def test_with_next_equals_brute_force(spark, docs, n, parts):
    rng = random.Random(n)
    ids = rng.sample(range(-50, 5000), n)
    rows = [(i, rng.choice([None, "", " ".join(rng.choices(["x", "yy", "é", "z" * 30], k=rng.randint(1, 40)))])) for i in ids]
    if n == 57:
        rows += [(None, "no id"), (rows[0][0], "a tie"), rows[1], (None, None)]
    order = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0), r[1] is not None, (r[1] or "").encode()))
    want = []
    for k, (i, t) in enumerate(order):
        t, nxt = t or "", order[(k + 1) % len(order)][1] or ""
        m = len(t) // 3
        e = t[:len(t) - m] + nxt[:m]
        s = L.signature(t)
        want.append((str(i), len(t), hashlib.sha256(e.encode()).hexdigest(), L.written(s), L.written(L.signature(e)),
                     L.likeness(s, L.signature(e)), L.likeness(s, L.signature(nxt))))
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", parts)
    try:
        got = L.with_next(docs(rows)).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert sorted((str(r[0]), *r[1:]) for r in got) == sorted(want)


def test_empty_table_and_equal_texts(spark, docs):
    assert L.with_next(docs([(1, "a")]).limit(0)).count() == 0
    got = {r["doc_id"]: r["fingerprint"] for r in L.fingerprints(docs([(1, "a b"), (2, "a b"), (3, "c"), (4, None)])).collect()}
    assert got[1] == got[2] != got[3] and got[4] == ""


def test_rows_of_one_id_are_spread_and_one_row_is_handed_over(spark, docs):
    rng = random.Random(4)
    rows = [(None if i % 3 else i, f"{rng.random()} text {i}") for i in range(400)] + [(None, "same")] * 30
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", 8)
    try:
        got = L.with_next(docs(rows))
        sizes = [r["n"] for r in got.groupBy(F.spark_partition_id()).agg(F.count("*").alias("n")).collect()]
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert sum(sizes) == len(rows) and max(sizes) < len(rows) / 3
