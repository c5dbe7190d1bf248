"""SimHash: fingerprints and components against brute force."""

import random
import re

import numpy as np
import pytest
import xxhash

from repweave.llm import simhash as S
from repweave.llm.components import connected_components


def brute_print(text):
    ws = re.findall(r"[^\x20\x09-\x0D]+", text.translate({c: c + 32 for c in range(65, 91)}))
    if not ws:
        return 0
    sh = [" ".join(ws[i:i + 3]) for i in range(len(ws) - 2)] or [" ".join(ws)]
    hs = [xxhash.xxh64_intdigest(s.encode(), 42) for s in sh]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def brute_components(prints, d=3):
    """prints: [(id, fp)]; the smallest id reachable per row."""
    fps = sorted({f for _, f in prints})
    up = {f: f for f in fps}

    def root(f):
        while up[f] != f:
            f = up[f]
        return f
    for i, a in enumerate(fps):
        for b in fps[:i]:
            if (a ^ b).bit_count() <= d:
                up[root(a)] = root(b)
    least = {}
    for i, f in prints:
        if i is not None:
            least[root(f)] = min(least.get(root(f), i), i)
    return sorted(((i is None, i), f, least.get(root(f))) for i, f in prints)


def test_fingerprints_by_hand():
    rng = random.Random(3)
    words = ["Ab", "É", "c d", "x", "ÀB", "zz"]
    many = ["", " \t\n\x0b", "one", "one two", "a b c"] + [
        "".join(w + rng.choice([" ", "\n", "\t ", "\x0c"]) for w in rng.choices(words, k=rng.randint(1, 50))) for _ in range(200)]
    assert [S.fingerprint(t.encode()) for t in many] == [brute_print(t) for t in many]


def clusters(seed, groups, size, flips):
    rng = random.Random(seed)
    out = []
    for _ in range(groups):
        f = rng.getrandbits(64)
        for _ in range(rng.randint(1, size)):
            out.append(f)
            for b in rng.sample(range(64), rng.randint(0, flips)):
                f ^= 1 << b
    return out


@pytest.mark.parametrize("seed,groups,size,flips,chunk", [(1, 200, 6, 5, 4096), (2, 2, 150, 4, 8), (3, 30, 20, 3, 3)])
def test_links_lose_no_component(spark, seed, groups, size, flips, chunk):
    fps = clusters(seed, groups, size, flips)
    prints = list(enumerate(fps))
    signed = sorted({int(np.uint64(f).astype(np.int64)) for f in fps})
    links = S.links_of(spark.createDataFrame([(f,) for f in signed], "fp long"), chunk=chunk)
    parent = {r["u"]: r["v"] for r in connected_components(links).collect()}
    low = {}
    for i, f in prints:
        s = int(np.uint64(f).astype(np.int64))
        low[parent.get(s, s)] = min(low.get(parent.get(s, s), i), i)
    got = sorted(((False, i), f, low[parent.get(s, s)]) for i, f in prints for s in [int(np.uint64(f).astype(np.int64))])
    assert got == brute_components(prints)


def test_pivot_filter_never_discards_a_link():
    fps = np.array(clusters(5, 40, 10, 3), dtype=np.uint64)
    table = S.pivot_table(fps)
    d = np.bitwise_count(fps[:, None] ^ fps[None, :])
    c = np.abs(table[:, None, :].astype(int) - table[None, :, :]).max(axis=2)
    assert (c <= d).all()


def test_sweep_forms_only_pairs_near_a_reference():
    fps = np.array(sorted(set(clusters(6, 60, 10, 3))), dtype=np.uint64)
    table = S.pivot_table(fps)
    by = np.argsort(table[:, 0], kind="stable")
    fps, table = fps[by], table[by]
    links, formed = S._Links(), []
    links.add = lambda u, v: formed.extend(zip(u.tolist(), v.tolist()))
    one = np.zeros(len(fps), dtype=np.int64)
    S.compare(one, one, one == 0, fps, table, 3, links)
    signed = fps.view(np.int64).tolist()
    d = np.bitwise_count(fps[:, None] ^ fps[None, :])
    assert sorted(formed) == sorted((signed[i], signed[j]) for i, j in zip(*np.nonzero(np.triu(d <= 3, 1))))
    # a row whose first coordinate is out of order is not met: the order, not the other checks, forms the pairs
    far = np.array([5, 60, 5], dtype=np.int8)[:, None].repeat(16, axis=1)
    formed.clear()
    S.compare(one[:3], one[:3], one[:3] == 0, np.zeros(3, dtype=np.uint64), far, 3, links)
    assert formed == []


def test_long_chain_is_one_component(spark):
    rows = [(i, i + 1) for i in range(300)] + [(1000, 2000), (5, 5)]
    got = {r["u"]: r["v"] for r in connected_components(spark.createDataFrame(rows, "u long, v long")).collect()}
    assert got == {**{i: 0 for i in range(1, 301)}, 2000: 1000}


def test_classes_equal_brute_force(spark, docs):
    rng = random.Random(9)
    words = [f"t{i}" for i in range(300)]
    rows = [(None, "null id"), (900, None), (901, ""), (902, " ")]
    for g in range(25):
        base = rng.choices(words, k=rng.choice([2, 30, 400]))
        for c in range(rng.randint(1, 4)):
            t = list(base)
            if c:
                t[rng.randrange(len(t))] = "changed"
            rows.append((10 * g + c, " ".join(t)))
    rows.append(rows[-1])
    got = sorted(((r["doc_id"] is None, r["doc_id"]), int(np.int64(r["fp"]).astype(np.uint64)), r["component_id"])
                 for r in S.classes(docs(rows)).collect())
    assert got == brute_components([(i, brute_print(t or "")) for i, t in rows])


def test_one_of_each(spark, docs):
    text = " ".join(f"t{i}" for i in range(50))
    df = docs([(3, text), (1, text), (2, "other words stand here"), (1, text), (None, text), (7, None), (8, "")])
    out = S.one_of_each(df)
    assert out.columns == df.columns
    assert sorted((r["doc_id"] is None, r["doc_id"]) for r in out.collect()) == [(False, 1), (False, 2), (False, 7)]
    assert S.one_of_each(df.limit(0)).count() == 0


def test_one_of_each_chooses_by_component(spark, docs):
    a, b, c, d, e = (" ".join(f"{k}{i}" for i in range(50)) for k in "abcde")
    # 5 has a clean text and a copy of 3; 6 has two clean texts; copies without an id, one of them of 3
    rows = [(3, b), (5, a), (5, b), (6, c), (6, d), (None, e), (None, e), (None, e, "fr"), (None, b), (None, b)]
    out = S.one_of_each(docs(rows))
    want = [(3, b), (5, a), (6, c), (6, d), (None, e)]
    assert sorted((str(r["doc_id"]), r["text"]) for r in out.collect()) == sorted((str(i), t) for i, t in want)
    assert "Window" not in out._jdf.queryExecution().toString()
