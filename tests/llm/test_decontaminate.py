"""Decontamination: the automaton against a brute-force search for windows."""

import hashlib
import random
import re

import pyarrow as pa
import pytest

from repweave.llm import decontaminate as D


def brute(items, text, window=10):
    lower = text.translate({c: c + 32 for c in range(65, 91)})
    ws = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower)
    hit, found = [False] * len(ws), set()
    for name, t in items:
        iw = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (t or "").translate({c: c + 32 for c in range(65, 91)}))
        k = min(window, len(iw))
        grams = {tuple(iw[i:i + k]) for i in range(len(iw) - k + 1)} if k else set()
        for i in range(len(ws) - k + 1) if k else ():
            if tuple(ws[i:i + k]) in grams:
                found.add(str(name))
                hit[i:i + k] = [True] * k
    return len(ws), sum(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()


def corpus(seed, vocab, lengths):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(vocab)] + ["É", "naïve"]
    items = [(i, " ".join(rng.choices(words, k=rng.choice(lengths)))) for i in range(12)]
    items += [(50, items[3][1]), (51, None), (52, "--- !"), (53, "")]
    texts = [None, "", "!!"]
    for _ in range(40):
        parts = [" ".join(rng.choices(words, k=rng.randint(0, 30)))]
        for _ in range(rng.randint(0, 3)):
            t = rng.choice(items)[1] or ""
            ws = t.split()
            a = rng.randint(0, max(0, len(ws) - 1))
            parts.append(", ".join(ws[a:a + rng.randint(1, 40)]).upper().replace("É", "É"))
            parts.append(" ".join(rng.choices(words, k=rng.randint(0, 5))))
        texts.append(" ".join(parts))
    return items, texts


@pytest.mark.parametrize("seed,vocab,lengths,block", [
    (1, 200, [12, 25, 40], 10 ** 6), (2, 4, [10, 12, 18], 10 ** 6), (3, 50, [1, 3, 9, 10, 30], 10 ** 6), (4, 3, [2, 5, 11], 20)])
def test_scan_equals_brute_force(spark, docs, seed, vocab, lengths, block):
    items, texts = corpus(seed, vocab, lengths)
    bench = spark.createDataFrame(items, "item_id long, text string")
    paths = D.build(bench, block_words=block)
    assert (len(paths) > 1) == (block == 20)
    got = {r["doc_id"]: (r["n_words"], r["n_hit"], r["n_items"], r["items_sha256"])
           for r in D.scan(docs(list(enumerate(texts))), paths).collect()}
    assert got == {i: brute(items, t or "") for i, t in enumerate(texts)}


def test_clean_removes_spans_and_rejects_covered(spark, docs):
    item = " ".join(f"q{i}" for i in range(12))
    bench = spark.createDataFrame([(1, item)], "item_id long, text string")
    rest = " ".join(f"own{i}" for i in range(40))
    df = docs([(1, f"{rest}, {item.upper()}; end."), (2, item), (3, rest), (4, None), (5, ""), (3, rest)])
    out = D.clean(df, D.build(bench), chars_col="n_chars")
    assert out.columns == df.columns
    got = sorted((r["doc_id"], r["text"], r["n_chars"]) for r in out.where("text is not null").collect())
    assert got == sorted([(1, f"{rest}, ; end.", len(rest) + 8), (3, rest, len(rest)), (3, rest, len(rest)), (5, "", 0)])
    assert out.where("text is null").count() == 1


def test_items_without_id_are_hit_as_in_sql(spark, docs, tmp_path):
    import duckdb

    from repweave.llm.queries import OP7_SQL
    item = [" ".join(f"{k}{i}" for i in range(12)) for k in "abc"]
    bench = spark.createDataFrame([(None, item[0]), (None, item[1]), (7, item[2]), (None, None)], "item_id long, text string")
    rest = " ".join(f"own{i}" for i in range(40))
    df = docs([(1, f"{rest} {item[0]}"), (2, f"{item[0]} {rest} {item[1]} {item[2]}"), (3, rest), (4, item[2])], extra=False)
    con = duckdb.connect()
    for name, frame in (("benchmark", bench), ("documents", df)):
        frame.coalesce(1).write.parquet(str(tmp_path / name))
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{tmp_path / name}/*.parquet')")
    got = sorted(tuple(r) for r in D.scan(df, D.build(bench, block_words=3)).collect())
    assert got == sorted(con.execute(OP7_SQL).fetchall())
    assert [r[2:4] for r in got] == [(12, 1), (36, 2), (0, 0), (12, 1)]
    assert D.clean(df, D.build(bench)).where("doc_id = 1").first()["text"].split() == rest.split()


def test_one_id_is_dealt_to_many_blocks(spark, docs):
    items = [(1, " ".join(f"w{k}x{i}" for i in range(12))) for k in range(60)] + [(2, "a b c")] * 40
    paths = D.build(spark.createDataFrame(items, "item_id long, text string"), block_words=60)
    sizes = [D._load(p).vocab for p in paths]
    assert max(map(len, sizes)) < 240 and sum(map(len, sizes)) == 60 * 12 + 3
    got = D.scan(docs([(i, t) for i, (_, t) in enumerate(items[:61])]), paths).collect()
    assert all(r["n_hit"] == r["n_words"] and r["n_items"] == 1 for r in got)


def test_empty_tables(spark, docs):
    none = spark.createDataFrame([], "item_id long, text string")
    assert D.scan(docs([(1, "a b")]), D.build(none)).first()["n_hit"] == 0
    assert D.scan(docs([(1, "a b")]).limit(0), D.build(none)).count() == 0


def test_each_automaton_is_loaded_once_for_all_batches_a_task_holds(spark, monkeypatch):
    items, texts = corpus(7, 60, [10, 12, 30])
    paths = D.build(spark.createDataFrame(items, "item_id long, text string"), block_words=5)
    assert len(paths) >= 8
    loads = []
    whole = D.read_file
    monkeypatch.setattr(D, "read_file", lambda path: loads.append(path) or whole(path))
    monkeypatch.setattr(D, "_LOADED", {})
    batches = [pa.RecordBatch.from_pydict({"Text": pa.array(texts[i:i + 5], pa.string())}) for i in range(0, len(texts), 5)]
    got = [x for _, found in D.judged(iter(batches), "text", paths) for x in found]
    assert sorted(loads) == paths
    want = [brute(items, t or "")[:2] for t in texts]
    assert [(n, 0 if mask is None else mask.sum()) for n, mask, _ in got] == want
    monkeypatch.setattr(D, "HELD_ROWS", 1)
    assert [len(found) for _, found in D.judged(iter(batches), "text", paths)] == [rb.num_rows for rb in batches]
    assert len(loads) > 2 * len(paths) and not list(D.judged(iter(()), "text", paths))
