"""URL filters: the cascade is exact over its universe; rules by brute force."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from repweave.llm import url_filter as U


@pytest.mark.parametrize("listed,unlisted", [(0, 50), (50, 0), (1, 5000), (3000, 20000), (20000, 300)])
def test_cascade_is_exact(listed, unlisted):
    hashes = np.array([U.key_hash(f"k{i}") for i in range(listed + unlisted)], dtype=np.uint64)
    levels = U.cascade(hashes[:listed], hashes[listed:])
    assert U.member(levels, hashes).tolist() == [True] * listed + [False] * unlisted
    assert sum(len(x.bits) for x in levels) <= 64 + 4 * (listed + 0.1 * unlisted)


def brute(url, rules):
    if url is None or "://" not in url:
        host, path = "", ""
    else:
        rest = url.split("://", 1)[1]
        cut = min([rest.index(c) for c in "/?#" if c in rest], default=len(rest))
        host = rest[:cut].translate({c: c + 32 for c in range(65, 91)})
        tail = rest[cut:]
        path = tail[:min([tail.index(c) for c in "?#" if c in tail], default=len(tail))]
    fits = [(len(h + p), h + p, v) for v, h, p in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
    best = max(fits, default=None)
    labels = host.rpartition("@")[2].partition(":")[0].strip(".").split(".")
    at = next((i for i, x in enumerate(labels) if set(x.split("-")) & set(U.LISTED_WORDS)), None)
    listed = None if at is None else ".".join(labels[at:])
    return host, path, best and best[1], best[2] if best else "block" if listed else "allow", listed


def some_urls():
    rng = random.Random(2)
    hosts = ["example.org", "www.example.org", "EXAMPLE.org", "badexample.org", "casino-win.example.net", "m.x.Casino-win.example.net:80",
             "a.com", "com", "org", "free-bets.de", "user@pills.de", "loads.example.net", "", "..", "\u00e4.de", "x.example.net."]
    paths = ["", "/", "/es/", "/es", "/en/1", "/en/12?x=/es/", "/fr/a#b", "/de/?q", "?://", "#/de/", "/EN/1"]
    rows = [(i, rng.choice(["http://", "https://", "x://", "//", ""]) + rng.choice(hosts) + rng.choice(paths)) for i in range(400)]
    return rows + [(500, None), (None, "http://casino-a.net/"), (501, ""), (502, "http://a/\nb"), (500, None)]


@pytest.mark.parametrize("shard_keys", [500_000, 4])
def test_verdicts_equal_brute_force(spark, shard_keys):
    rows = some_urls()
    pages = spark.createDataFrame(rows, "page_id long, url string").withColumns({"key": F.lit(1), "host": F.lit(2), "l": F.lit(3)})
    folder, shards = U.build(U.listed_by_words(U.universe(pages)), shard_keys=shard_keys)
    assert (shards > 3) == (shard_keys == 4)
    got = U.judge(pages, folder, shards).collect()
    key = lambda r: tuple(str(x) for x in r)
    assert sorted(map(tuple, got), key=key) == sorted(((i, *brute(u, U.RULES)) for i, u in rows), key=key)
    assert U.judge(pages.limit(0), folder, shards).count() == 0


def test_a_lost_shard_is_an_error(spark):
    pages = spark.createDataFrame([(1, "http://casino-x.net/")], "page_id long, url string")
    with pytest.raises(Exception, match="FileNotFoundError"):
        U.judge(pages, "/tmp/no-such-folder", 1).collect()


def test_empty_list_and_universe(spark):
    none = spark.createDataFrame([], "page_id long, url string")
    folder, shards = U.build(U.listed_by_words(U.universe(none)))
    pages = spark.createDataFrame([(1, "http://casino-x.net/")], "page_id long, url string")
    assert U.judge(pages, folder, shards).first()["verdict"] == "allow"
