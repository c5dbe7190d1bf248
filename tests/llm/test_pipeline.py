"""The pipeline: stage by stage on a planted corpus, and its registered form."""

import random

import corpus_pipeline as C


def planted(docs):
    rng = random.Random(7)
    words = "the thing and where those with them there this that when which should would be from onto".split()
    text = lambda k: " ".join(rng.choices(words, k=k) + [f"u{rng.randrange(10 ** 9)}"])
    rows = [(i, text(rng.randint(30, 90))) for i in range(60)]
    rows += [(100, rows[5][1]), (101, rows[6][1]), (102, rows[5][1])]
    rows += [(110, rows[7][1] + " mail jo@example.com now"), (120, None), (121, "")]
    item = " ".join(f"item{i}" for i in range(20))
    rows += [(130, text(60) + " " + item + " " + text(60)), (131, item)]
    rows += [(i + 200, " ".join(rng.choices(words, k=50)), "en", "h") for i in range(3)]
    return docs(rows), item


def test_stages_take_effect(spark, docs, tmp_path):
    df, item = planted(docs)
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    df.write.parquet(str(tmp_path / "documents.parquet"))
    sf, now, seen = str(tmp_path), df, {}
    for name, stage in C.STAGES[:-1]:
        out = stage(spark, now, sf)
        assert out.columns == df.columns
        seen[name] = {r["doc_id"]: r["text"] for r in out.collect()}
        now = out
    assert not {120, 121} & seen["language"].keys() and set(range(60)) <= seen["language"].keys()
    assert not {100, 101, 102} & seen["near_duplicates"].keys() and {5, 6, 7} <= seen["near_duplicates"].keys()
    assert 131 not in seen["benchmark"] and "item5" not in seen["benchmark"].get(130, "")
    assert set(seen["benchmark"]) == set(seen["near_duplicates"]) - {131}
    assert all("@" not in t for t in seen["personal_data"].values())
    packed = C.run(spark, sf).collect()
    assert {r["doc_id"] for r in packed} == set(seen["personal_data"])


def test_only_the_last_table_stays(spark, docs, tmp_path, monkeypatch):
    from repweave.llm import common
    df, item = planted(docs)
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    df.write.parquet(str(tmp_path / "documents.parquet"))
    folder = tmp_path / "shared"
    monkeypatch.setattr(common, "checkpoint_dir", lambda spark: str(folder))
    out = C.run(spark, str(tmp_path))
    left = [p.name for p in (folder / "repweave-llm").iterdir()]
    assert len(left) == 1 and left[0].startswith("pipeline-packing-") and out.count() > 0
    # a failed stage leaves nothing of its own behind, and the folder of others alone
    (folder / "repweave-llm" / "other").mkdir()
    monkeypatch.setattr(C, "STAGES", [C.STAGES[0], ("broken", lambda *a: 1 / 0)])
    try:
        C.run(spark, str(tmp_path))
    except ZeroDivisionError:
        pass
    assert {p.name for p in (folder / "repweave-llm").iterdir()} == {left[0], "other"}


def test_registered():
    import __spark_entry__ as E
    assert E.queries()["pipeline"] is C.run and 4 <= len(C.STAGES) <= 5
    assert {f"op{n}" for n in range(1, 11)} <= {q.split("_")[0] for q in E.queries()}


def test_empty_table(spark, docs, tmp_path):
    spark.createDataFrame([], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    docs([(1, "a")]).limit(0).write.parquet(str(tmp_path / "documents.parquet"))
    assert C.run(spark, str(tmp_path)).count() == 0


def test_any_columns_pass_the_stages(spark, docs, tmp_path):
    from pyspark.sql import functions as F
    df, item = planted(docs)
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    clash = {c: F.concat(F.lit(f"{c} of "), F.col("doc_id").cast("string")) for c in
             ("__gone", "__row", "__row2", "row1", "row2", "doc", "body", "key", "id", "KEY2", "root", "best", "a b")}
    df = df.drop("key", "id", "body").withColumns(clash).withColumn("tags", F.create_map(F.lit("x"), F.col("doc_id"))).withColumnRenamed("text", "Text")
    now = df
    for _, stage in C.STAGES[:-1]:
        now = stage(spark, now, str(tmp_path))
        assert now.columns == df.columns
        for r in now.select("doc_id", "tags", *[f"`{c}`" for c in clash]).collect():
            assert r["tags"] == {"x": r["doc_id"]} and all(r[c] == f"{c} of {r['doc_id']}" for c in clash)
    assert now.count() > 55


def test_lengths_change_with_their_own_text_alone(spark):
    from repweave.llm import pii
    df = spark.createDataFrame([(1, "plain", 99), (2, "mail jo@example.com now", 99)], "doc_id long, text string, n_chars long").coalesce(1)
    got = {r["doc_id"]: (r["text"], r["n_chars"]) for r in pii.redact(df, chars_col="n_chars").collect()}
    assert got[1] == ("plain", 99) and got[2][1] == len(got[2][0]) != 99
