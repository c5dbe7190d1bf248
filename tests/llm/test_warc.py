"""WARC bundles: exact round trips, the seek table, and random access by the index."""

import glob
import hashlib
import random

import zstandard

from repweave.llm import warc


def pages(spark, rows):
    from pyspark.sql import functions as F
    return spark.createDataFrame(rows, "page_id long, url string, html string").withColumns(
        {"id": F.lit(1), "digest": F.lit(2), "archive": F.lit(3), "first": F.lit(4)})


def some_pages():
    rng = random.Random(4)
    bodies = ["<p>" + "".join(rng.choices("abcé\r\n <>", k=n)) + "</p>" for n in (0, 5, 91, 92, 93, 100, 3000, 70000)] + [None, "", "WARC/1.1\r\n\r\nx" * 20]
    rows = [(i, rng.choice(["http://a.b/c", "http://x/ü?q=\r\nInjected: 1", None, ""]), rng.choice(bodies)) for i in range(150)]
    return rows + [(None, "http://n", bodies[6]), (7, "http://again", rows[7][2]), (7, "http://again", rows[7][2])]


def brute(rows):
    first = {}
    for i, _, html in rows:
        data = (html or "").encode()
        if i is not None and len(data) >= 100:
            first[data] = min(first.get(data, i), i)
    out = []
    for i, _, html in rows:
        data = (html or "").encode()
        to = first.get(data)
        revisit = i is not None and to is not None and to < i
        out.append((i or -1, len(data), hashlib.sha256(data).hexdigest(), "revisit" if revisit else "response", to if revisit else -1))
    return sorted(out)


def test_round_trip(spark):
    rows = some_pages()
    index = warc.write(pages(spark, rows), frame_bytes=20_000)
    got = warc.read(index).collect()
    assert sorted((r["page_id"] or -1, r["payload_bytes"], r["payload_digest"], r["record_type"],
                   -1 if r["refers_to"] is None else r["refers_to"]) for r in got) == brute(rows)
    html = {i: (h or "").encode() for i, _, h in rows}
    frames = set()
    for r in index.collect():
        header, payload = warc.read_record(r["archive"], r["frame"], r["record_at"])
        assert warc._page_id(header["WARC-Record-ID"]) == r["page_id"]
        if header["WARC-Type"] == "response" and r["page_id"] is not None:
            assert payload == html[r["page_id"]]
        at, size, _ = warc.seek_table(r["archive"])[r["frame"]]
        assert (at, size) == (r["frame_at"], r["frame_bytes"])
        frames.add((r["archive"], r["frame"]))
    assert len(frames) > 3
    for path in {a for a, _ in frames}:  # a plain Zstandard reader skips the footer and reads all records
        local = path.removeprefix("file:")
        with open(glob.glob(local)[0], "rb") as f:
            whole = zstandard.ZstdDecompressor().stream_reader(f, read_across_frames=True).read()
        assert sum(1 for _ in warc.parse(whole)) == sum(r["archive"] == path for r in index.collect())


def test_empty_table(spark):
    assert warc.read(warc.write(pages(spark, some_pages()).limit(0))).count() == 0


def test_small_frames_are_read_by_more_than_one_task(spark):
    rows = [(i, "http://a/b", f"<p>{i} " + "".join(random.Random(i).choices("abcdefgh", k=900)) + "</p>") for i in range(240)]
    index = warc.write(pages(spark, rows), frame_bytes=9_000)
    assert index.select("archive", "frame").distinct().count() >= 24
    found = warc.read(index)
    assert found.count() == 240
    assert len({f for f in found.inputFiles()}) > 1
