"""SimHash near-duplicates (operator 3): pivot distance tables.

Fingerprints: word shingles are hashed with 64-bit XXH64; a bit is set where over half the
hashes have it. Documents whose fingerprints differ in at most ``max_distance`` bits are linked.

Equal fingerprints are one node, so copies are grouped before anything is compared. For each
node the Hamming distances to ``len(PIVOTS)`` reference fingerprints are computed once and
carried as a row of the pivot table. By the triangle inequality two fingerprints within d
bits have pivot distances that differ by at most d in every coordinate: pairs with a larger
coordinate difference are discarded, survivors are verified by their exact distance.

A pivot table alone would have to look at all nodes, so nodes first meet in an exact cover:
among 4 blocks of 16 bits at least one is equal for pairs within 3 bits, and among the 4
twelfths of the other 48 bits again one; the 16 keys of 28 bits meet each such pair at least once.
Within a key the pivot table finds the pairs: nodes stand in the order of their distance to the first
reference, and a sweep forms only pairs within ``max_distance`` of each other there; the other
coordinates then discard most of these, before any fingerprints are compared.
Keys with many nodes (large groups of near copies) are split into chunks and their chunk
pairs are dealt to many tasks. A task compares in blocks and gives out only a spanning
forest of the links it finds, never all pairs of a group. Nothing is capped.

Defined cases: NULL or empty texts have fingerprint zero and are linked like any other; a
document with a NULL id has its component's smallest id; repeated rows stay; an empty
table gives no rows; only id and text are read, so other columns never clash.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from repweave.llm.common import batch, bounded_batches, hashable, materialise, raw
from repweave.llm.components import connected_components

SHINGLE = 3
MAX_DISTANCE = 3
SEED = 42
#: Nodes of one key that a task compares at once; keys with more are split.
CHUNK = 4096

#: Reference fingerprints: XXH64 of the numbers 0 to 15.
PIVOTS = np.array([xxhash.xxh64_intdigest(str(i).encode(), SEED) for i in range(16)], dtype=np.uint64)

PRINTS = "doc_id long, fp long"
PRINTS_ARROW = pa.schema([("doc_id", pa.int64()), ("fp", pa.int64())])
LINKS = "u long, v long"
LINKS_ARROW = pa.schema([("u", pa.int64()), ("v", pa.int64())])

LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))


def fingerprint(text: bytes, shingle: int = SHINGLE) -> int:
    """The 64-bit SimHash of a UTF-8 text."""
    words = text.translate(LOWER).split()
    n = len(words)
    if not n:
        return 0
    whole = b" ".join(words)
    digest = xxhash.xxh64_intdigest
    if n <= shingle:
        return digest(whole, SEED)
    ends = [e + i for i, e in enumerate(accumulate(map(len, words)))]
    starts = [0, *[e + 1 for e in ends[:n - shingle]]]
    hashes = np.fromiter((digest(whole[a:b], SEED) for a, b in zip(starts, ends[shingle - 1:])),
                         dtype=np.uint64, count=n - shingle + 1)
    ones = np.zeros(64, dtype=np.int64)
    for at in range(0, len(hashes), 1 << 15):
        part = hashes[at:at + (1 << 15)]
        ones += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE,
                 carried: tuple[str, ...] = ()) -> DataFrame:
    """(doc_id, fp): fp is the fingerprint as a signed long; long columns ``carried`` follow."""
    bounded_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rb in batches:
            fps = np.array([fingerprint(t, shingle) for t in raw(rb.column(1))], dtype=np.uint64)
            yield batch(schema, [rb.column(0), fps.view(np.int64), *rb.columns[2:]])

    schema = pa.schema([*PRINTS_ARROW, *[(c, pa.int64()) for c in carried]])
    return docs.select(docs[id_col].cast("long"), docs[text_col].cast("string"), *carried).mapInArrow(
        run, ", ".join([PRINTS, *[f"{c} long" for c in carried]]))


def pivot_table(fps: np.ndarray) -> np.ndarray:
    """Hamming distances of each fingerprint to each reference."""
    return np.bitwise_count(fps.view(np.uint64)[:, None] ^ PIVOTS[None, :]).astype(np.int8)


def _with_pivots(nodes: DataFrame) -> DataFrame:
    """(fp, near, pivots): all distances as bytes, and the first of them to sort by."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("fp", pa.int64()), ("near", pa.int8()), ("pivots", pa.binary())])
        for rb in batches:
            distances = pivot_table(rb.column(0).to_numpy(zero_copy_only=False))
            yield batch(schema, [rb.column(0), distances[:, 0], [x.tobytes() for x in distances]])
    return nodes.select("fp").mapInArrow(run, "fp long, near byte, pivots binary")


def _keys(fp) -> list:
    """The 16 keys of a fingerprint: one of 4 blocks, and one of 4 parts of the rest."""
    out = []
    for i in range(4):
        block = F.shiftrightunsigned(fp, 16 * i).bitwiseAND(F.lit(0xFFFF))
        low = fp.bitwiseAND(F.lit((1 << 16 * i) - 1)) if i else F.lit(0).cast("long")
        high = F.shiftleft(F.shiftrightunsigned(fp, 16 * i + 16), 16 * i) if i < 3 else F.lit(0).cast("long")
        rest = low.bitwiseOR(high)
        for j in range(4):
            part = F.shiftrightunsigned(rest, 12 * j).bitwiseAND(F.lit(0xFFF))
            out.append(F.lit((4 * i + j) << 28).cast("long").bitwiseOR(F.shiftleft(block, 12)).bitwiseOR(part))
    return out


def forest(u: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A spanning star per component of the links (u, v)."""
    names, flat = np.unique(np.concatenate((u, v)), return_inverse=True)
    a, b = flat[:len(u)], flat[len(u):]
    label = np.arange(len(names))
    while True:
        low = np.minimum(label[a], label[b])
        new = label.copy()
        np.minimum.at(new, label[a], low)
        np.minimum.at(new, label[b], low)
        new = new[new]
        while not np.array_equal(new, new[new]):
            new = new[new]
        if np.array_equal(new, label):
            break
        label = new
    away = np.flatnonzero(label != np.arange(len(names)))
    return names[away], names[label[away]]


class _Links:
    """Gathers links; a forest of them stays small."""

    def __init__(self):
        self.parts: list[tuple[np.ndarray, np.ndarray]] = []
        self.held = 0

    def add(self, u: np.ndarray, v: np.ndarray) -> None:
        if len(u):
            self.parts.append((u, v))
            self.held += len(u)
            if self.held > 1 << 20:
                self.reduce()

    def reduce(self) -> tuple[np.ndarray, np.ndarray] | None:
        if not self.parts:
            return None
        got = forest(np.concatenate([p[0] for p in self.parts]), np.concatenate([p[1] for p in self.parts]))
        self.parts, self.held = [got], 0
        return got


def compare(cells: np.ndarray, chunk: np.ndarray, whole: np.ndarray, fps: np.ndarray, pivots: np.ndarray,
            max_distance: int, links: _Links) -> None:
    """Compare the rows of each cell (equal values of ``cells`` stand together, by rising distance
    to the first reference): neighbours 1, 2, ... places apart, as long as they share a cell and
    the sweep's window of ``max_distance``. In a cell of two chunks (``whole`` is false) only rows
    of different chunks are compared."""
    at = np.arange(len(cells) - 1)
    step = 1
    while len(at):
        at = at[at + step < len(cells)]
        # once a row's neighbour is out of reach, so are all further ones
        at = at[(cells[at] == cells[at + step]) & (pivots[at + step, 0] - pivots[at, 0] <= max_distance)]
        for s in range(0, len(at), 1 << 18):
            p = at[s:s + (1 << 18)]
            p = p[whole[p] | (chunk[p] != chunk[p + step])]
            q = p + step
            near = np.abs(pivots[p] - pivots[q]).max(axis=1, initial=0) <= max_distance
            p, q = p[near], q[near]
            true = np.bitwise_count(fps[p] ^ fps[q]) <= max_distance
            links.add(fps[p[true]].view(np.int64), fps[q[true]].view(np.int64))
        step += 1


def links_of(nodes: DataFrame, max_distance: int = MAX_DISTANCE, chunk: int = CHUNK) -> DataFrame:
    """Links (u, v) between distinct fingerprints within ``max_distance`` bits: a spanning
    forest of each task's links."""
    if max_distance > 3:
        raise ValueError("the key cover meets all pairs within 3 bits, not beyond")
    keyed = _with_pivots(nodes).withColumn("key", F.explode(F.array(*_keys(F.col("fp")))))
    keyed = materialise(keyed, "keyed")
    large = (keyed.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > chunk)
             .select("key", F.ceil(F.col("n") / chunk).cast("int").alias("m")))
    dealt = (keyed.join(large, "key", "left").withColumn("m", F.coalesce("m", F.lit(1)))
             .withColumn("c", F.pmod(F.xxhash64("fp"), F.col("m")).cast("int"))
             .withColumn("o", F.explode(F.sequence(F.lit(0), F.col("m") - 1)))
             .select("key", F.least("c", "o").alias("i"), F.greatest("c", "o").alias("j"), "c", "fp", "pivots", "near"))
    sorted_cells = dealt.repartition("key", "i", "j").sortWithinPartitions("key", "i", "j", "near").drop("near")
    size = len(PIVOTS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        links, held = _Links(), None
        for rb in batches:
            key, i, j, c, fp = [rb.column(k).to_numpy(zero_copy_only=False) for k in range(5)]
            piv = np.frombuffer(b"".join(rb.column(5).to_pylist()), dtype=np.int8).reshape(-1, size)
            now = [key, i, j, c, fp, piv]
            if held is not None:
                now = [np.concatenate(x) for x in zip(held, now, strict=True)]
            new = np.ones(len(now[0]), dtype=bool)
            new[1:] = (np.diff(now[0]) != 0) | (np.diff(now[1]) != 0) | (np.diff(now[2]) != 0)
            last = int(np.flatnonzero(new)[-1])  # the last cell may go on in the next batch
            if last:
                compare(np.cumsum(new)[:last], now[3][:last], (now[1] == now[2])[:last],
                        now[4][:last].view(np.uint64), now[5][:last], max_distance, links)
            held = [x[last:] for x in now]
        if held is not None:
            compare(np.zeros(len(held[0]), dtype=np.int64), held[3], held[1] == held[2],
                    held[4].view(np.uint64), held[5], max_distance, links)
        got = links.reduce()
        if got is not None:
            yield batch(LINKS_ARROW, list(got))

    return sorted_cells.mapInArrow(run, LINKS)


def _rooted(prints: DataFrame, max_distance: int) -> DataFrame:
    """(fp, least, root): each fingerprint, its smallest id, and one fingerprint of its component."""
    nodes = materialise(prints.groupBy("fp").agg(F.min("doc_id").alias("least")), "nodes")
    parent = connected_components(links_of(nodes, max_distance))
    return nodes.join(parent.select(F.col("u").alias("fp"), F.col("v").alias("root")), "fp", "left").withColumn(
        "root", F.coalesce("root", "fp"))


def classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE,
            max_distance: int = MAX_DISTANCE) -> DataFrame:
    """(doc_id, fp, component_id), one row per document row: component_id is the smallest
    id that can be reached over links."""
    prints = materialise(fingerprints(docs, id_col, text_col, shingle), "prints")
    rooted = _rooted(prints, max_distance)
    # the smallest id of a component, and back to its nodes; hot roots are split by Spark
    low = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    of_node = rooted.join(low, "root").select("fp", "component_id")
    return prints.join(of_node, "fp").select("doc_id", "fp", "component_id")


def one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE,
                max_distance: int = MAX_DISTANCE) -> DataFrame:
    """The documents, one of each component: that with the smallest id, NULL ids last. Of rows of a component
    that share that id, the one with the smallest hash of all columns stays, once. Rows are chosen
    by component, so equal ids in different components lose nothing."""
    # the columns stand in a struct, so no name can clash; two hashes of all of them name a row
    cells = hashable(docs)
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"), docs[id_col].alias("id"),
                       docs[text_col].alias("body"), F.xxhash64(F.lit(1), *cells).alias("row1"), F.xxhash64(F.lit(2), *cells).alias("row2"))
    prints = materialise(fingerprints(rows, "id", "body", shingle, ("row1", "row2")), "prints")
    of_print = prints.groupBy("fp").agg(F.min(F.struct(F.isnull("doc_id").alias("bare"), "doc_id", "row1", "row2")).alias("best"))
    kept = (of_print.join(_rooted(prints, max_distance).select("fp", "root"), "fp").groupBy("root")
            .agg(F.min("best").alias("best")).select("best.row1", "best.row2"))
    # equal rows meet in each task first, so many copies of one row reach the join as few
    return rows.select("doc", "row1", "row2").dropDuplicates(["row1", "row2"]).join(kept, ["row1", "row2"], "left_semi").select("doc.*")
