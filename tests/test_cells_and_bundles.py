"""Headerless cell files by line number in a splittable read; bundles that appear whole or not at all."""

import csv

import pytest
from pyspark.sql import functions as F

from repweave.sources import bundle as B
from repweave.sources import cells as C


def test_lines_are_numbered_inside_each_file(spark, tmp_path):
    want = {}
    for k, n in enumerate([1, 700, 5000, 0, 3]):
        lines = [f"file {k} line {i} " + "x" * (i * 7 % 60) for i in range(1, n + 1)]
        (tmp_path / f"f{k}.txt").write_text("\n".join(lines) + ("\n" if k == 1 else ""))
        want.update({(f"f{k}.txt", i): t for i, t in enumerate(lines, 1)})
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        for size in ("3000", "40000", old):
            spark.conf.set("spark.sql.files.maxPartitionBytes", size)
            df = C.numbered_lines(spark, str(tmp_path))
            if size == "3000":
                assert df.select(F.spark_partition_id()).distinct().count() > 8
            got = {(r["path"].rpartition("/")[2], r["line"]): r["value"] for r in df.collect()}
            assert got == want
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


ROWS = [["White alone, not Hispanic", "1.5", "", "x"], ['say "hi"', "", "a,b", " padded "], ["", "2", "3", "4"], ["one"]]


def test_cells_equal_the_csv_module(spark, tmp_path):
    with open(tmp_path / "a.txt", "w", newline="") as f:
        f.write("title\nmore, titles\n")
        csv.writer(f, lineterminator="\n").writerows(ROWS)
    got = {r["line"]: r["cells"] for r in C.read_cells(spark, str(tmp_path), 2).collect()}
    assert [got[i] for i in sorted(got)] == [[c.strip() or None for c in r] for r in ROWS]


def test_written_cells_come_back(spark, tmp_path):
    data = [(f, s, i, f"v,{i}", None if i % 3 else f'q"{i}') for f in ("w1", "w2") for s in ("US", "AL") for i in range(20)]
    df = spark.createDataFrame(data, "file string, sheet string, at int, a string, b string").repartition(5)
    C.write_cell_files(df, f"{tmp_path}/t", ["file", "sheet"], "at", C.line_of([F.col("a"), F.col("b")]), ["T1", "", "a,b"])
    got = C.read_cells(spark, f"{tmp_path}/t", 3).collect()
    assert sorted((r["file"], r["sheet"], r["line"] - 4, *r["cells"]) for r in got if r["cells"][1]) == sorted(r for r in data if r[4])
    assert len(got) == len(data)


def test_a_failed_publication_leaves_the_last_one(spark, tmp_path):
    base = str(tmp_path / "pub")
    df = spark.range(50).select("id", (F.col("id") / 7).alias("x"), F.when(F.col("id") % 2 == 0, "a, \"b\"").alias("s"))
    with pytest.raises(FileNotFoundError):
        B.open_table(spark, base, "t")
    B.publish_bundle({"t": df, "c": df}, base, "d1", {"c": "csv"})
    broken = df.withColumn("x", F.when(F.col("id") == 49, F.raise_error("broken").cast("double")).otherwise(F.col("x")))
    with pytest.raises(Exception):
        B.publish_bundle({"t": df.limit(1), "c": broken}, base, "d2", {"c": "csv"})
    for name in ("t", "c"):
        assert sorted(map(tuple, B.open_table(spark, base, name, verify=True).collect())) == sorted(map(tuple, df.collect())) if name == "t" \
            else B.open_table(spark, base, name, verify=True).count() == 50
    with pytest.raises(FileNotFoundError):
        B.open_table(spark, base, "t", "d2")
    B.publish_bundle({"t": df.limit(3)}, base, "d2")
    assert B.open_table(spark, base, "t").count() == 3 and B.open_table(spark, base, "t", "d1").count() == 50
    with pytest.raises(KeyError):
        B.open_table(spark, base, "c")


def test_changed_values_are_seen(spark, tmp_path):
    base = str(tmp_path / "pub")
    df = spark.range(9).select("id", (F.col("id") / 7).alias("x"))
    B.publish_bundle({"t": df}, base, "d")
    folder, listed = B.listing(spark, base)
    df.withColumn("x", F.col("x") + F.when(F.col("id") == 4, 0.001).otherwise(0)).write.mode("overwrite").parquet(f"{folder}/t")
    assert listed[0]["rows"] == 9
    with pytest.raises(ValueError, match="t: 9 rows"):
        B.open_table(spark, base, "t", verify=True)


def test_two_writers_of_one_number_cannot_both_publish(spark, tmp_path):
    from repweave.streaming.ledger import write_text
    write_text(spark, f"{tmp_path}/published/00000001.json", "{}")
    with pytest.raises(FileExistsError):
        write_text(spark, f"{tmp_path}/published/00000001.json", "{}")
