"""Ranked search against scoring every document, and the stopping rule against full reading."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from repweave.llm import ranked_search as R

WORD = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = {c: c + 32 for c in range(65, 91)}


def brute(docs, items, k):
    split = [(d, WORD.findall((t or "").translate(LOWER))) for d, t in docs]
    split = [(d, w) for d, w in split if w]
    n, length = len(split), sum(len(w) for _, w in split)
    df = Counter(t for _, w in split for t in set(w))
    out = []
    for item, text in sorted(set(items), key=str):
        scores = []
        for d, w in split:
            tf, m = Counter(w), 50 + (50 * len(w) * n) // length
            s = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * ((10 ** 9 * tf[t]) // (1000 * tf[t] + 20 * m))
                    for t in set(WORD.findall((text or "").translate(LOWER))) if t in tf)
            if s > 0:
                scores.append((-s, d is None, d or 0))
        out += [(item, r, None if none else d, -s) for r, (s, none, d) in enumerate(sorted(scores)[:k], 1)]
    return sorted(out, key=str)


def corpus(n=400, seed=3):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(60)] + ["Ärger", "中文", "ZEBRA", "a_b", "x-y"]
    weights = [1 / (i + 1) for i in range(len(words))]
    docs = [(i, " ".join(rng.choices(words, weights, k=rng.choice([1, 3, 20, 60])))) for i in range(n)]
    # ties, repeated rows, null ids, empty and long texts
    docs += [(1000 + i, "w1 w2 w3") for i in range(90)] + [docs[0]] * 3 + [(None, "w1 w2 w3 zebra")] * 2
    docs += [(2000, None), (2001, ""), (2002, "!!!"), (2003, "w5 " * 20_000), (2004, "W1;w2\nW3")]
    items = [(i, " ".join(rng.choices(words, k=rng.choice([1, 4, 12])))) for i in range(25)]
    items += [(90, None), (91, ""), (92, "nowhere"), (93, "w1 w2 w3"), (93, "w1 w2 w3"), (93, "zebra"), (None, "w7"), (94, "w1 w1 W1")]
    return docs, items


@pytest.mark.parametrize("block,chunk,k", [(2_000_000, 1_000_000, 50), (100, 300, 50), (2_000_000, 40, 3)])
def test_equals_scoring_all(spark, block, chunk, k):
    docs, items = corpus()
    clash = {c: F.lit(1) for c in ("id", "body", "item", "block", "rank", "score", "term", "part", "n")}
    got = R.search(spark.createDataFrame(docs, "doc_id long, text string").repartition(3).withColumns(clash),
                   spark.createDataFrame(items, "item_id long, text string").withColumns(clash), k=k, block_bytes=block, chunk_postings=chunk)
    assert sorted((tuple(r) for r in got.collect()), key=str) == brute(docs, items, k)


def test_empty_tables(spark):
    docs, items = corpus(20)
    some, none = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    assert R.search(some.limit(0), none).count() == 0
    assert R.search(some, none.limit(0)).count() == 0
    assert R.search(some.where("text = ''"), none).count() == 0


def chunk_of(rng, documents, terms):
    doc, term, impact = [], [], []
    for d in range(documents):
        for t in sorted(rng.sample(range(terms), rng.randint(1, terms))):
            doc.append(d), term.append(t), impact.append(rng.choice([1, 2, 2, 3, 50]) * (t + 1))
    return R.Chunk(np.array(doc), np.array(term), np.array(impact), documents, terms), list(zip(doc, term, impact))


@pytest.mark.parametrize("seed", range(6))
def test_stopping_keeps_every_tie(seed):
    rng = random.Random(seed)
    chunk, postings = chunk_of(rng, 300, 6)
    for terms in ([0], [1, 4], [0, 1, 2, 3, 4, 5]):
        for floor in (0, 60):
            docs, scores, _ = chunk.search(np.array(terms), 10, floor, depth=1)
            total = Counter()
            for d, t, i in postings:
                total[d] += i * (t in terms)
            kth = sorted(total.values())[-10]
            want = {d: s for d, s in total.items() if s >= max(kth, floor, 1)}
            assert dict(zip(docs.tolist(), scores.tolist())) == want
    assert not chunk.met.any() and (chunk.slot == -1).all()


def test_reads_less_than_all():
    # one document far above the others in both lists, at the head of each
    n = 5000
    doc = np.repeat(np.arange(n), 2)
    term = np.tile([0, 1], n)
    impact = np.where(doc < 10, 1000 - doc, 1)
    chunk = R.Chunk(doc, term, impact, n, 2)
    docs, _, read = chunk.search(np.array([0, 1]), 10, 0, depth=16)
    assert sorted(docs.tolist()) == list(range(10)) and read < 200


def test_best_position_is_the_gapless_run():
    # list 0 is led by documents that direct accesses from list 1 see, too: the threshold falls without reading on
    doc, term, impact = [], [], []
    for d in range(64):
        doc += [d, d]
        term += [0, 1]
        impact += [100 - d, 100 - d]
    for d in range(64, 2000):
        doc.append(d), term.append(d % 2), impact.append(1)
    chunk = R.Chunk(np.array(doc), np.array(term), np.array(impact), 2000, 2)
    docs, scores, read = chunk.search(np.array([0, 1]), 5, 0, depth=8)
    assert docs.tolist() and read <= 32 and max(scores) == 200
