"""Ranked lexical search (operator 12) by the Best Position Algorithm.

A document's score for an item is the sum of impacts of the item's terms. A task indexes its documents
in chunks: per term an impact list, highest first, and per document its postings with their places in
those lists (the direct access). For an item all its lists are read downwards together; each document
met is looked up directly in all of them, which also marks its places there as seen. A list's best
position is the end of its gapless run of seen places, so no unseen document can score more than the
sum of the impacts at the best positions; reading stops when that is strictly below the k-th score,
ties included. The k-th score carries over from chunk to chunk, so a task keeps k rows per item
and soon stops early. Spark merges the tasks' rows per item, in two steps, into the k highest.

Items are the stated query set: they are dealt to blocks by their size, a task writes each block's terms to
the shared folder, and each block runs over all documents. Counts (N, L, df) are over all documents:
tasks count for one block of terms, Spark adds up. Neither items nor documents pass through the driver;
only file names and the number of blocks do.

Defined cases: NULL or empty texts have no terms, are not counted in N and match nothing; an item without
terms, or whose terms no document holds, has no rows; equal rows of items are one item, rows of one id with
different texts are ranked each on its own; each row of documents is a document of its own, so repeated rows
are ranked beside each other; equal scores are ordered by document id, NULL ids last; scores are 64-bit
integers (texts of up to 10**8 terms at 10**9 documents); empty tables give no rows; other columns are not read.
"""

from __future__ import annotations

import math
import pickle
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from repweave.llm.common import batch, bounded_batches, raw, read_file, shared_path, write_file
from repweave.llm.decontaminate import words_of

TOP = 50
#: Bytes of item text in one block; a worker holds one block's terms and its k rows per item.
BLOCK_BYTES = 2_000_000
#: Postings of one chunk; about 60 bytes each in a worker.
CHUNK_POSTINGS = 1_000_000
#: Places of each list that the first round reads; each further round doubles the depth.
FIRST_DEPTH = 64
#: Parts an item's rows are ranked in before they meet.
MERGE_PARTS = 64

HITS = "block int, item int, doc_id long, score long"
HITS_ARROW = pa.schema([("block", pa.int32()), ("item", pa.int32()), ("doc_id", pa.int64()), ("score", pa.int64())])


def write_blocks(items: DataFrame, id_col: str = "item_id", text_col: str = "text",
                 block_bytes: int = BLOCK_BYTES) -> tuple[str, DataFrame]:
    """Deal distinct items to blocks; returns the folder of their terms and (block, item, id), ``item``
    the number of an item in its block."""
    spark = items.sparkSession
    folder = shared_path(spark, "search")
    rows = items.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("body")).distinct()
    size = rows.agg(F.sum(F.octet_length("body")).alias("n")).first()["n"] or 0
    blocks = max(1, -(-size // block_bytes))
    dealt = rows.withColumn("block", F.pmod(F.xxhash64("id", "body"), F.lit(blocks)).cast("int"))

    def write(key: tuple, part: pa.Table) -> pa.Table:
        number = key[0].as_py()
        part = part.sort_by([("id", "ascending"), ("body", "ascending")])
        terms = [sorted(set(words_of(t))) for t in raw(part.column("body"))]
        write_file(f"{folder}/items-{number}.bin", pickle.dumps(terms, protocol=5))
        return pa.table({"block": pa.array([number] * len(part), pa.int32()),
                         "item": pa.array(range(len(part)), pa.int32()), "id": part.column("id")})

    names = dealt.groupBy("block").applyInArrow(write, "block int, item int, id long")
    # run once: the table of numbers is kept beside the files
    names.write.parquet(f"{folder}/names")
    return folder, spark.read.schema(names.schema).parquet(f"{folder}/names")


_BLOCK: dict[str, tuple] = {}


def load_block(path: str) -> tuple[dict[bytes, int], list[np.ndarray]]:
    """The numbered terms of a block and the term numbers of each of its items."""
    if path not in _BLOCK:
        _BLOCK.clear()
        terms = pickle.loads(read_file(path))
        number: dict[bytes, int] = {}
        of_items = [np.array([number.setdefault(t, len(number)) for t in ts], dtype=np.int64) for ts in terms]
        _BLOCK[path] = number, of_items
    return _BLOCK[path]


def count(docs: DataFrame, folder: str, block: int, text_col: str = "text") -> DataFrame:
    """(term, n): the documents that hold a term; under term -1 documents with terms (N), under -2 all terms (L)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, _ = load_block(f"{folder}/items-{block}.bin")
        held = np.zeros(len(number), dtype=np.int64)
        documents = length = 0
        for rb in batches:
            for text in raw(rb.column(0)):
                words = words_of(text)
                documents += bool(words)
                length += len(words)
                held[[number[w] for w in number.keys() & set(words)]] += 1
        some = np.flatnonzero(held)
        yield pa.RecordBatch.from_arrays([pa.array([-1, -2, *some.tolist()], pa.int32()),
                                          pa.array([documents, length, *held[some].tolist()], pa.int64())], ["term", "n"])

    parts = docs.select(F.col(text_col).cast("string")).mapInArrow(run, "term int, n long")
    return parts.groupBy("term").agg(F.sum("n").alias("n"))


def write_weights(counts: DataFrame, folder: str, block: int) -> None:
    """One task turns a block's counts (bounded by the block) into weights and writes them."""

    def write(part: pa.Table) -> pa.Table:
        n = dict(zip(part.column("term").to_pylist(), part.column("n").to_pylist()))
        total = n.pop(-1)
        length = n.pop(-2)
        weights = {t: math.floor(1000 * math.log((2 * total + 2) / (2 * df + 1))) for t, df in n.items()}
        write_file(f"{folder}/weights-{block}.bin", pickle.dumps((total, length, weights), protocol=5))
        return pa.table({"terms": pa.array([len(weights)], pa.int64())})

    counts.groupBy(F.lit(0).alias("one")).applyInArrow(write, "terms long").collect()


def best_first(scores: np.ndarray, ids: np.ndarray, unknown: np.ndarray, k: int) -> np.ndarray:
    """The places of the k best rows: highest score, then lowest id, NULL ids last."""
    return np.lexsort((ids, unknown, -scores))[:k]


class Chunk:
    """Impact lists of some documents for a block's terms, with direct access by document."""

    def __init__(self, doc: np.ndarray, term: np.ndarray, impact: np.ndarray, documents: int, terms: int):
        # postings come in order of documents
        self.term, self.impact = term, impact
        self.first = np.searchsorted(doc, np.arange(documents + 1))
        order = np.lexsort((doc, -impact, term))
        self.list_doc, self.list_impact = doc[order], impact[order]
        self.list_first = np.searchsorted(term[order], np.arange(terms + 1))
        self.place = np.empty(len(doc), dtype=np.int64)
        self.place[order] = np.arange(len(doc)) - self.list_first[term[order]]
        self.met = np.zeros(documents, dtype=bool)
        self.slot = np.full(terms, -1, dtype=np.int64)

    def look_up(self, docs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Direct access: the scores of documents, and (list, place) of all their postings in the item's lists."""
        sizes = self.first[docs + 1] - self.first[docs]
        ends = np.cumsum(sizes)
        at = np.arange(ends[-1]) + np.repeat(self.first[docs] - ends + sizes, sizes)
        lists = self.slot[self.term[at]]
        hit = lists >= 0
        owner = np.repeat(np.arange(len(docs)), sizes)[hit]
        at, lists = at[hit], lists[hit]
        impacts = self.impact[at]
        order = np.zeros(len(docs), dtype=np.int64)
        np.add.at(order, owner, impacts)
        return order, lists, self.place[at], owner

    def search(self, terms: np.ndarray, k: int, floor: int, depth: int = FIRST_DEPTH) -> tuple[np.ndarray, np.ndarray, int]:
        """(documents, scores, places read by sorted access): every document that can be among the k best of
        this chunk and whose score reaches ``floor``."""
        terms = terms[self.list_first[terms + 1] > self.list_first[terms]]
        starts, sizes = self.list_first[terms], self.list_first[terms + 1] - self.list_first[terms]
        self.slot[terms] = np.arange(len(terms))
        offset = np.concatenate(([0], np.cumsum(sizes)))
        seen = np.zeros(offset[-1], dtype=bool)
        best = np.zeros(len(terms), dtype=np.int64)
        read = np.zeros(len(terms), dtype=np.int64)
        docs, scores = [], []
        top = np.zeros(0, dtype=np.int64)
        while len(terms):
            upto = np.minimum(depth, sizes)
            more = upto - read
            ends = np.cumsum(more)
            at = np.arange(ends[-1]) + np.repeat(starts + read - ends + more, more)
            found = np.unique(self.list_doc[at])
            found = found[~self.met[found]]
            read = upto
            if len(found):
                self.met[found] = True
                score, lists, places, _ = self.look_up(found)
                seen[offset[lists] + places] = True
                docs.append(found)
                scores.append(score)
                top = np.sort(np.concatenate((top, score)))[-k:]
            # the best position of each list: the end of its gapless run of seen places
            for i in range(len(terms)):
                rest = seen[offset[i] + best[i]:offset[i + 1]]
                gap = int(np.argmin(rest)) if len(rest) else 0
                best[i] += len(rest) if len(rest) and rest[gap] else gap
            open_ = best < sizes
            limit = int(self.list_impact[starts[open_] + best[open_] - 1].sum()) if open_.any() else 0
            kth = max(floor, int(top[0]) if len(top) == k else 0)
            if not open_.any() or limit < kth:
                break
            depth *= 2
        self.slot[terms] = -1
        if not docs:
            return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64), 0
        found, score = np.concatenate(docs), np.concatenate(scores)
        self.met[found] = False
        keep = (score >= max(floor, int(top[0]) if len(top) == k else 0)) & (score > 0)
        return found[keep], score[keep], int(read.sum())


def impacts(tf: np.ndarray, m: np.ndarray) -> np.ndarray:
    """A posting's impact for a term of weight 1."""
    return (1_000_000_000 * tf) // (1000 * tf + 20 * m)


def rank_chunks(docs: DataFrame, folder: str, block: int, id_col: str = "doc_id", text_col: str = "text", k: int = TOP,
                chunk_postings: int = CHUNK_POSTINGS) -> DataFrame:
    """Each task's k best documents of each item of a block."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, items = load_block(f"{folder}/items-{block}.bin")
        total, length, weight = pickle.loads(read_file(f"{folder}/weights-{block}.bin"))
        weights = np.array([weight.get(t, 0) for t in range(len(number))], dtype=np.int64)
        # terms of weight 0 add nothing to any score
        items = [ts[weights[ts] > 0] for ts in items]
        kept = [(np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, bool))] * len(items)
        doc: list[int] = []
        term: list[int] = []
        tf: list[int] = []
        norm: list[int] = []
        ids: list[int | None] = []

        def flush() -> None:
            owner = np.array(doc, dtype=np.int64)
            word = np.array(term, dtype=np.int64)
            value = impacts(np.array(tf, dtype=np.int64), np.array(norm, dtype=np.int64)[owner]) * weights[word]
            chunk = Chunk(owner, word, value, len(ids), len(number))
            names = np.array([i or 0 for i in ids], dtype=np.int64)
            unknown = np.array([i is None for i in ids], dtype=bool)
            for i, ts in enumerate(items):
                score, name, gone = kept[i]
                found, new, _ = chunk.search(ts, k, int(score[-1]) if len(score) == k else 0)
                if len(found):
                    score, name = np.concatenate((score, new)), np.concatenate((name, names[found]))
                    gone = np.concatenate((gone, unknown[found]))
                    first = best_first(score, name, gone, k)
                    kept[i] = score[first], name[first], gone[first]
            for values in (doc, term, tf, norm, ids):
                values.clear()

        for rb in batches:
            for name, text in zip(rb.column(0).to_pylist(), raw(rb.column(1))):
                words = words_of(text)
                counts = Counter(words)
                mine = number.keys() & counts.keys()
                if not mine:
                    continue
                doc.extend([len(ids)] * len(mine))
                term.extend(number[w] for w in mine)
                tf.extend(counts[w] for w in mine)
                norm.append(100 - 50 + (50 * len(words) * total) // length)
                ids.append(name)
                if len(doc) >= chunk_postings:
                    flush()
        if doc:
            flush()
        for i, (score, name, gone) in enumerate(kept):
            if len(score):
                yield batch(HITS_ARROW, [[block] * len(score), [i] * len(score), pa.array(name, mask=gone),
                                         pa.array(score)])

    rows = docs.select(F.col(id_col).cast("long"), F.col(text_col).cast("string"))
    return rows.mapInArrow(run, HITS)


def search(docs: DataFrame, items: DataFrame, doc_id: str = "doc_id", doc_text: str = "text", item_id: str = "item_id",
           item_text: str = "text", k: int = TOP, block_bytes: int = BLOCK_BYTES,
           chunk_postings: int = CHUNK_POSTINGS) -> DataFrame:
    """(item id, rank, document id, score): the k best documents of each item."""
    spark = docs.sparkSession
    bounded_batches(spark)
    folder, names = write_blocks(items, item_id, item_text, block_bytes)
    hits = spark.createDataFrame([], HITS)
    for block in sorted(r["block"] for r in names.select("block").distinct().collect()):
        write_weights(count(docs, folder, block, doc_text), folder, block)
        hits = hits.unionByName(rank_chunks(docs, folder, block, doc_id, doc_text, k, chunk_postings))
    order = [F.col("score").desc(), F.col("doc_id").asc_nulls_last()]
    part = F.pmod(F.xxhash64("doc_id", "score", F.spark_partition_id()), F.lit(MERGE_PARTS))
    for keys in (["block", "item", "part"], ["block", "item"]):
        hits = hits.withColumn("part", part) if "part" in keys else hits
        hits = hits.withColumn("rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where(F.col("rank") <= k)
    return hits.join(names, ["block", "item"]).select(F.col("id").alias(item_id), "rank",
                                                      F.col("doc_id").alias(doc_id), "score")
