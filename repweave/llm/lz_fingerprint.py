"""Document fingerprints (operator 8): Lempel-Ziv phrase sets.

A text's words (long ones cut into pieces of ``PIECE`` bytes) are parsed by LZ78: the longest
phrase seen before, and one more piece, is a new phrase. Each phrase has a 64-bit hash that
is carried along the parse. The fingerprint is the ``SKETCH`` smallest of the mixed phrase
hashes; the likeness of two fingerprints estimates the Jaccard index of the phrase sets, exactly
so while a set has no more phrases than the sketch. Texts that compress each other well share phrases.

Defined cases: NULL or empty texts (and white space alone) have an empty fingerprint, of
likeness 1 to another empty one and 0 to all else; equal texts have equal fingerprints; very
long texts are parsed whole; other columns are not read. In ``with_next``, rows are ordered by falling
id, NULL last, ties by text; one row alone is its own next; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from repweave.llm.common import batch, bounded_batches, texts

PIECE = 8
SKETCH = 64
#: Characters of a text that place its row among rows of one id, and keys per range that choose the ranges.
START, SAMPLED = 64, 20
CACHED_PIECES = 500_000
_MASK = (1 << 64) - 1

COMPARED = ("doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
            "near_edited double, near_next double")
COMPARED_ARROW = pa.schema([
    ("doc_id", pa.int64()), ("n_chars", pa.int64()), ("edited_sha256", pa.string()), ("fingerprint", pa.string()),
    ("edited_fingerprint", pa.string()), ("near_edited", pa.float64()), ("near_next", pa.float64())])

_HASHES: dict[bytes, int] = {}


def phrases(text: str, piece: int = PIECE) -> set[int]:
    """Hashes of the LZ78 phrases of a text's pieces."""
    if len(_HASHES) > CACHED_PIECES:
        _HASHES.clear()
    known, digest = _HASHES, xxhash.xxh64_intdigest
    seen: set[int] = set()
    at = 0
    for word in text.encode().split():
        for p in (word,) if len(word) <= piece else [word[i:i + piece] for i in range(0, len(word), piece)]:
            h = known.get(p)
            if h is None:
                h = known[p] = digest(p)
            at = (at * 0x9E3779B97F4A7C15 + h) & _MASK
            if at not in seen:
                seen.add(at)
                at = 0
    return seen


def signature(text: str) -> np.ndarray:
    """The smallest mixed phrase hashes, sorted, each once."""
    found = phrases(text)
    x = np.fromiter(found, dtype=np.uint64, count=len(found))
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = ((x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)) >> np.uint64(32)
    x = np.unique(x.astype(np.uint32))
    return x[:SKETCH]


def written(sketch: np.ndarray) -> str:
    return sketch.astype(">u4").tobytes().hex()


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """The share of the smallest hashes of both that both have."""
    if not len(a) or not len(b):
        return float(len(a) == len(b))
    smallest = np.union1d(a, b)[:SKETCH]
    both = np.intersect1d(a, b, assume_unique=True)
    return float(np.isin(smallest, both, assume_unique=True).sum() / len(smallest))


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, fingerprint)."""
    bounded_batches(docs.sparkSession)
    schema = pa.schema([("doc_id", pa.int64()), ("fingerprint", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rb in batches:
            yield batch(schema, [rb.column(0), [written(signature(t)) for t in texts(rb.column(1))]])

    return docs.select(docs[id_col].cast("long"), docs[text_col].cast("string")).mapInArrow(
        run, "doc_id long, fingerprint string")


def edited(text: str, following: str) -> str:
    """The text with its last third replaced by the first characters of the following one."""
    n = len(text) // 3
    return text[:len(text) - n] + following[:n]


def _cuts_up_to(cuts: list[str], key: Column) -> Column:
    """How many of the rising cuts the key has reached: among every n-th first, then among the n
    that follow, so that many ranges cost a row little."""
    if not cuts:
        return F.lit(0)
    step = max(1, math.isqrt(len(cuts)))
    lit = lambda xs: F.array(*[F.lit(x) for x in xs])
    block = F.size(F.filter(lit(cuts[::step]), lambda c: c <= key))
    inside = F.slice(lit(cuts), (block - 1) * step + 1, F.lit(step))
    return F.when(block == 0, 0).otherwise((block - 1) * step + F.size(F.filter(inside, lambda c: c <= key)))


def _order_key(k: Column, body: Column) -> Column:
    """A string that rises as the id falls and, for one id, as the text's first characters rise, NULL first."""
    falling = F.bitwise_not(k).bitwiseXOR(F.lit(-(1 << 63)))
    return F.concat(F.lpad(F.hex(falling), 16, "0"),
                    F.when(body.isNull(), "").otherwise(F.concat(F.lit("!"), F.substring(body, 1, START))))


def with_next(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Each document against its edited text and the next document by falling id.

    Rows are dealt to ranges of (id, first ``START`` characters) and sorted within, so the text is shuffled once
    and rows that share an id are spread by their texts; only rows alike in both meet in one range. The
    first row of each range, and it alone, also goes to the range before, as what follows that range's last row.
    The driver holds ``SAMPLED`` and two keys per range."""
    spark = docs.sparkSession
    bounded_batches(spark)
    rows = docs.select(docs[id_col].cast("long").alias("id"), docs[text_col].cast("string").alias("body")).withColumn(
        "k", F.coalesce("id", F.lit(-(1 << 63))))
    rows = rows.withColumn("key", _order_key(F.col("k"), F.col("body")))
    ranges = int(spark.conf.get("spark.sql.shuffle.partitions"))
    share = min(1.0, SAMPLED * ranges / max(1, docs.count()))
    drawn = sorted(r["key"] for r in rows.select("key").sample(share, seed=8).collect())
    cuts = sorted({drawn[i * len(drawn) // ranges] for i in range(1, ranges)}) if drawn else []
    rows = rows.withColumn("part", _cuts_up_to(cuts, F.col("key")))
    heads = sorted((r["part"], r["key"]) for r in rows.groupBy("part").agg(F.min("key").alias("key")).collect())
    if not heads:
        return rows.mapInArrow(lambda batches: iter(()), COMPARED)
    first = dict(heads)
    before = {part: heads[i - 1][0] for i, (part, _) in enumerate(heads)}
    of_part = lambda of: F.get(F.array(*[F.lit(of.get(i)) for i in range(len(cuts) + 1)]), F.col("part"))
    # rows of one key all have a text or all have none, so the smallest is the first
    followers = (rows.where(F.col("key") == of_part(first)).groupBy("part").agg(F.min("body").alias("body"))
                 .select(of_part(before).alias("p"), F.lit(1).alias("foreign"), F.lit(None).cast("long").alias("k"), "body",
                         F.lit(None).cast("long").alias("id")))
    dealt = rows.select(F.col("part").alias("p"), F.lit(0).alias("foreign"), "k", "body", "id").unionAll(followers)
    dealt = dealt.repartitionById(len(cuts) + 1, F.col("p")).sortWithinPartitions(
        "p", "foreign", F.col("k").desc(), F.col("body").asc_nulls_first())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = None  # part, id, text, signature of the row whose next is awaited
        for rb in batches:
            out = []
            for p, foreign, body, i in zip(*(rb.column(c).to_pylist() for c in (0, 1, 3, 4)), strict=True):
                body = body or ""
                sketch = signature(body)
                if last is not None and last[0] == p:
                    _, at, text, own = last
                    new = edited(text, body)
                    other = signature(new)
                    out.append((at, len(text), hashlib.sha256(new.encode()).hexdigest(), written(own), written(other),
                                likeness(own, other), likeness(own, sketch)))
                last = None if foreign else (p, i, body, sketch)
            if out:
                yield batch(COMPARED_ARROW, [list(c) for c in zip(*out, strict=True)])

    return dealt.mapInArrow(run, COMPARED)
