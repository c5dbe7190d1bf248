"""URL filters (operator 9): a Bloom filter cascade over the corpus's complete key universe.

Keys are hosts and all their parent domains. Listed keys go into a first Bloom filter; the
unlisted keys of the universe that it accepts by mistake go into a second one, the listed
keys that the second accepts into a third, and so on until a level makes no mistake. The first
level that says no decides, by its parity, so membership is exact for every key of the universe.

Keys are dealt to shards by a hash, about ``SHARD_KEYS`` distinct keys each, whatever the
host's share of rows; one task builds one shard's cascade and writes it to the shared
folder. Tasks that judge urls read the shards their keys need and keep a bounded number of
them: nothing is joined or broadcast, and the lists may have any size.

Rules on host and path go before the list: the longest rule that fits decides.

Defined cases: a NULL url, or one without ``://``, has empty host and path and is allowed; an empty host is
no key; repeated rows are each judged; an empty list blocks nothing; an empty table gives no
rows; only id and url are read.
"""

from __future__ import annotations

import pickle
from collections import OrderedDict
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from repweave.llm.common import batch, bounded_batches, read_file, shared_path, write_file

SHARD_KEYS = 500_000
#: Cascades that a Python worker holds at once, each about a megabyte at most.
HELD_SHARDS = 128
#: Wanted share of false positives of the first level; later levels take one half.
FIRST_RATE = 0.02

#: (verdict, host, path), in this order; a rule's name is host + path.
RULES: tuple[tuple[str, str, str], ...] = (
    ("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"), ("block", "com", "/de/"))

#: Words of hosts that the query's list holds.
LISTED_WORDS = ("casino", "pills", "bets", "adult", "spam", "ads")

JUDGED = "page_id long, host string, path string, rule string, verdict string, listed string"
JUDGED_ARROW = pa.schema([("page_id", pa.int64()), ("host", pa.string()), ("path", pa.string()),
                          ("rule", pa.string()), ("verdict", pa.string()), ("listed", pa.string())])


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host: after the first :// up to /, ? or #, A-Z lowered; path: then up to ? or #."""
    rest = F.substr(url, F.locate("://", url) + 3)
    has = F.coalesce(F.locate("://", url) > 0, F.lit(False))
    host = F.translate(F.regexp_extract(rest, r"^[^/?#]*", 0), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    return F.when(has, host).otherwise(""), F.when(has, path).otherwise("")


def universe(urls: DataFrame, url_col: str = "url") -> DataFrame:
    """(key): every host and parent domain, once. Hosts are made distinct before they are
    split, so a hot host is one row."""
    host, _ = host_and_path(F.col(url_col))
    bare = F.regexp_replace(F.regexp_replace(host, r"^.*@", ""), r":.*$", "")
    return (urls.select(bare.alias("h")).distinct()
            .select(F.split(F.trim(F.col("h"), F.lit(".")), r"\.").alias("l"))
            .select(F.explode(F.sequence(F.lit(1), F.size("l"))).alias("i"), "l")
            .select(F.array_join(F.slice("l", F.col("i"), F.size("l")), ".").alias("key"))
            .where("key <> ''").distinct())


class Bloom:
    """A Bloom filter on precomputed 64-bit hashes."""

    def __init__(self, hashes: np.ndarray, rate: float, salt: int):
        self.salt = salt
        bits = max(64, int(np.ceil(-len(hashes) * np.log(rate) / np.log(2) ** 2)))
        self.size, self.k = bits, max(1, round(-np.log2(rate)))
        self.bits = np.zeros(-(-bits // 8), dtype=np.uint8)
        for at in self._places(hashes):
            np.bitwise_or.at(self.bits, at >> 3, (1 << (at & 7)).astype(np.uint8))

    def _places(self, hashes: np.ndarray) -> Iterator[np.ndarray]:
        x = hashes ^ np.uint64((0x9E3779B97F4A7C15 * (self.salt + 1)) & (1 << 64) - 1)
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        x ^= x >> np.uint64(31)
        step = (x >> np.uint64(32)) | np.uint64(1)
        for i in range(self.k):
            yield ((x + np.uint64(i) * step) % np.uint64(self.size)).astype(np.int64)

    def has(self, hashes: np.ndarray) -> np.ndarray:
        out = np.ones(len(hashes), dtype=bool)
        for at in self._places(hashes):
            out &= (self.bits[at >> 3] >> (at & 7).astype(np.uint8) & 1).astype(bool)
        return out


def key_hash(key: str) -> int:
    return xxhash.xxh64_intdigest(key.encode(), 7)


def cascade(listed: np.ndarray, unlisted: np.ndarray) -> list[Bloom]:
    """The levels for two disjoint sets of hashes."""
    levels: list[Bloom] = []
    inside, outside = listed, unlisted
    while len(inside):
        level = Bloom(inside, FIRST_RATE if not levels else 0.5, len(levels))
        levels.append(level)
        inside, outside = outside[level.has(outside)], inside
    return levels


def member(levels: list[Bloom], hashes: np.ndarray) -> np.ndarray:
    """Whether each hash is listed: the first level that says no decides."""
    out = np.full(len(hashes), len(levels) % 2 == 1)
    left = np.arange(len(hashes))
    for i, level in enumerate(levels):
        yes = level.has(hashes[left])
        out[left[~yes]] = i % 2 == 1
        left = left[yes]
    return out


def build(keys: DataFrame, shard_keys: int = SHARD_KEYS) -> tuple[str, int]:
    """From (key, listed), each key once, the cascades; returns their folder and how many."""
    spark = keys.sparkSession
    folder = shared_path(spark, "cascade")
    shards = max(1, -(-keys.count() // shard_keys))
    dealt = keys.select("key", "listed", F.pmod(F.xxhash64("key"), F.lit(shards)).cast("int").alias("shard"))
    # a row without key in every shard: a shard without keys has a file, too, and a missing file is an error
    empty = spark.range(shards).select(F.lit(None).cast("string").alias("key"), F.lit(False).alias("listed"), F.col("id").cast("int").alias("shard"))
    dealt = dealt.unionByName(empty)

    def make(number, part):
        import pandas as pd
        part = part[part["key"].notna()]
        hashes = np.array([key_hash(k) for k in part["key"]], dtype=np.uint64)
        listed = part["listed"].to_numpy(dtype=bool)
        inside, outside = np.unique(hashes[listed]), np.unique(hashes[~listed])
        if len(np.intersect1d(inside, outside)):
            raise ValueError("two keys share a 64-bit hash; choose another hash seed")
        levels = cascade(inside, outside)
        write_file(f"{folder}/shard-{int(number[0])}.bin", pickle.dumps(levels, protocol=5))
        return pd.DataFrame({"shard": [int(number[0])], "levels": [len(levels)]})

    dealt.groupBy("shard").applyInPandas(make, "shard int, levels int").agg(F.sum("levels")).collect()
    return folder, shards


_SHARDS: OrderedDict[str, list[Bloom]] = OrderedDict()


def _shard(path: str) -> list[Bloom]:
    if path in _SHARDS:
        _SHARDS.move_to_end(path)
    else:
        _SHARDS[path] = pickle.loads(read_file(path))
        while len(_SHARDS) > HELD_SHARDS:
            _SHARDS.popitem(last=False)
    return _SHARDS[path]


def rule_of(host: str, path: str, rules: Sequence[tuple[str, str, str]]) -> tuple[str, str] | None:
    """(verdict, name) of the longest rule for the host or a parent domain and the path."""
    best = None
    for verdict, h, p in rules:
        if (host == h or host.endswith("." + h)) and path.startswith(p):
            if best is None or len(h) + len(p) > len(best[1]):
                best = (verdict, h + p)
    return best


def judge(pages: DataFrame, folder: str, shards: int, id_col: str = "page_id", url_col: str = "url",
          rules: Sequence[tuple[str, str, str]] = RULES) -> DataFrame:
    """Host, path, rule, verdict and the listed key of each url."""
    bounded_batches(pages.sparkSession)
    host, path = host_and_path(F.col(url_col).cast("string"))

    # the shard of a key is computed by Spark's own hash, as it was dealt
    lists = F.transform(F.sequence(F.lit(1), F.size("l")), lambda i: F.array_join(F.slice("l", i, F.size("l")), "."))
    rows = pages.select(F.col(id_col).cast("long").alias("id"), host.alias("host"), path.alias("path"))
    bare = F.regexp_replace(F.regexp_replace("host", r"^.*@", ""), r":.*$", "")
    rows = rows.withColumn("l", F.split(F.trim(bare, F.lit(".")), r"\.")).withColumn("keys", F.filter(lists, lambda k: k != ""))
    rows = rows.select("id", "host", "path", "keys",
                       F.transform("keys", lambda k: F.pmod(F.xxhash64(k), F.lit(shards)).cast("int")).alias("at"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rb in batches:
            ids, hosts, paths, keys, at = rb.column(0), *[rb.column(i).to_pylist() for i in range(1, 5)]
            need: dict[int, set[str]] = {}
            for ks, ss in zip(keys, at):
                for k, s in zip(ks, ss):
                    need.setdefault(s, set()).add(k)
            listed: set[str] = set()
            for s, ks in sorted(need.items()):
                names = sorted(ks)
                yes = member(_shard(f"{folder}/shard-{s}.bin"), np.array([key_hash(k) for k in names], dtype=np.uint64))
                listed.update(n for n, y in zip(names, yes) if y)
            rule, verdict, hit = [], [], []
            for h, p, ks in zip(hosts, paths, keys):
                fits = rule_of(h, p, rules)
                key = next((k for k in ks if k in listed), None)
                rule.append(fits[1] if fits else None)
                verdict.append(fits[0] if fits else "block" if key else "allow")
                hit.append(key)
            yield batch(JUDGED_ARROW, [ids, hosts, paths, rule, verdict, hit])

    return rows.mapInArrow(run, JUDGED)


def listed_by_words(keys: DataFrame, words: Sequence[str] = LISTED_WORDS) -> DataFrame:
    """(key, listed): a key is listed if a part of its first label, between hyphens, is one of the words."""
    parts = F.split(F.substring_index("key", ".", 1), "-")
    return keys.select("key", F.arrays_overlap(parts, F.array(*[F.lit(w) for w in words])).alias("listed"))
