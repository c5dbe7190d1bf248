"""Benchmark decontamination (operator 7): a generalised suffix automaton of test items.

Item words are put into one generalised suffix automaton per block of items; training words
are streamed through it while the longest matching length at each word is tracked. A window
is ``window`` consecutive item words (an item of fewer words is one window); words inside
any occurrence of a window are hit. Spans of hit words are taken out of a text; a document
whose hit share exceeds ``max_coverage`` is rejected whole.

Items are dealt to blocks by a hash of id and text, equal rows once, so that an id many rows
have is spread (marks and items are united over blocks). Each block has an expected number of words, and its automaton
is built by one task and written to the shared folder; a document task loads them one by one, each once
for ``HELD_ROWS`` bytes of its rows. So neither the driver nor a broadcast holds the items, whatever their number.

Only runs of words whose neighbours also stand next to each other in some item are streamed: where a
pair of words is in no item the match length is at most one, so a start from the root gives
the same lengths as the whole stream.

Defined cases: NULL or empty texts have no words and no hits; items without words have no
windows; repeated items count by their own id; items with a NULL id are hit like any other, count
as one item together and have no place in the digest of ids; repeated documents are each judged; an empty
item table hits nothing; other columns are passed by (``scan``) or through (``clean``).
"""

from __future__ import annotations

import hashlib
import io
import pickle
from collections.abc import Iterator
from itertools import islice, repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from repweave.llm.common import batch, bounded_batches, column_index, raw, read_file, relengthened, shared_path, write_file

WINDOW = 10
MAX_COVERAGE = 0.5
#: Words of one block's automaton; about 300 bytes each in a worker.
BLOCK_WORDS = 500_000

#: Bytes that separate words become blanks, A-Z become lower case; all else stays.
FOLD = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32
             for b in range(256))

SCANNED = "doc_id long, n_words long, n_hit long, n_items long, items_sha256 string, contaminated boolean"
SCANNED_ARROW = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_hit", pa.int64()),
                           ("n_items", pa.int64()), ("items_sha256", pa.string()), ("contaminated", pa.bool_())])


def words_of(text: bytes) -> list[bytes]:
    return text.translate(FOLD).split()


class SuffixAutomaton:
    """Generalised suffix automaton of word sequences with, for each state, the items that
    hold its strings, as far as the windows need them."""

    def __init__(self, items: list[tuple[str | None, list[bytes]]], window: int):
        self.window = window
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]
        vocab: dict[bytes, int] = {}
        ends: list[tuple[str | None, list[int]]] = []
        for name, ws in items:
            if not ws:
                continue
            seq = [vocab.setdefault(w, len(vocab)) for w in ws]
            ends.append((name, seq))
            last = 0
            for c in seq:
                last = self._extend(last, c)
        self.vocab = vocab
        self.least = min([min(window, len(seq)) for _, seq in ends], default=0)
        n = max(len(vocab), 1)
        self.pairs = np.unique(np.array([a * n + b for _, seq in ends for a, b in zip(seq, seq[1:])], dtype=np.int64))
        # the items of each state that stands for windows of full length: every prefix state of an item and its suffixes
        self.items: dict[int, set[str | None]] = {}
        self.short: dict[int, list[tuple[int, str | None]]] = {}
        for name, seq in ends:
            state, length = 0, 0
            for c in seq:
                state = self.next[state][c]
                length += 1
                if length >= window:
                    self.items.setdefault(self.at_window(state), set()).add(name)
            if len(seq) < window:
                self.short.setdefault(state, []).append((len(seq), name))

    def at_window(self, state: int) -> int:
        """The state of the last ``window`` words of a state's strings."""
        while self.length[self.link[state]] >= self.window:
            state = self.link[state]
        return state

    def _extend(self, last: int, c: int) -> int:
        nxt, link, length = self.next, self.link, self.length

        def split(p: int, q: int) -> int:
            clone = len(nxt)
            nxt.append(dict(nxt[q]))
            link.append(link[q])
            length.append(length[p] + 1)
            while p != -1 and nxt[p].get(c) == q:
                nxt[p][c] = clone
                p = link[p]
            link[q] = clone
            return clone

        if c in nxt[last]:
            q = nxt[last][c]
            return q if length[q] == length[last] + 1 else split(last, q)
        cur = len(nxt)
        nxt.append({})
        link.append(0)
        length.append(length[last] + 1)
        p = last
        while p != -1 and c not in nxt[p]:
            nxt[p][c] = cur
            p = link[p]
        if p != -1:
            q = nxt[p][c]
            link[cur] = q if length[q] == length[p] + 1 else split(p, q)
        return cur

    def stream(self, seq: list[int], at: int, marks: list[tuple[int, int]], found: set[str | None]) -> None:
        """Read words, tracking the longest matching length; note window occurrences as
        (start, end) word positions and the items they are from."""
        nxt, link, length, window = self.next, self.link, self.length, self.window
        state, matched = 0, 0
        for i, c in enumerate(seq, at):
            while state and c not in nxt[state]:
                state = link[state]
                matched = length[state]
            to = nxt[state].get(c)
            if to is None:
                continue
            state, matched = to, matched + 1
            if matched >= window:
                marks.append((i - window + 1, i + 1))
                found |= self.items[self.at_window(state)]
            if self.short:
                s, have = state, matched
                while s > 0:
                    for n, name in self.short.get(s, ()):
                        if n <= have:
                            marks.append((i - n + 1, i + 1))
                            found.add(name)
                    s = link[s]
                    have = length[s]

    def scan(self, words: list[bytes], marks: list[tuple[int, int]], found: set[str | None]) -> None:
        least = self.least
        if not least or len(words) < least:
            return
        ids = np.fromiter(map(self.vocab.get, words, repeat(-1)), dtype=np.int64, count=len(words))
        known = ids >= 0
        if np.count_nonzero(known) < least:
            return
        if least == 1:
            joined = known[:-1] & known[1:]
        else:
            code = ids[:-1] * len(self.vocab) + ids[1:]
            place = np.minimum(np.searchsorted(self.pairs, code), len(self.pairs) - 1)
            joined = known[:-1] & known[1:] & (self.pairs[place] == code)
        # runs of words joined to each other
        edge = np.flatnonzero(~joined) + 1
        starts, ends = np.concatenate(([0], edge)), np.concatenate((edge, [len(words)]))
        for s, e in zip(starts, ends):
            if e - s >= least and known[s]:
                self.stream(ids[s:e].tolist(), int(s), marks, found)


def build(items: DataFrame, id_col: str = "item_id", text_col: str = "text", window: int = WINDOW,
          block_words: int = BLOCK_WORDS) -> list[str]:
    """Build and write the automata, one per block of items; returns their files."""
    spark = items.sparkSession
    folder = shared_path(spark, "automata")
    rows = items.select(F.col(id_col).cast("string").alias("item"), F.col(text_col).cast("string").alias("body"))
    size = rows.agg(F.sum(F.length("body")).alias("n")).first()["n"] or 0
    blocks = max(1, -(-size // (5 * block_words)))
    rows = rows.distinct().withColumn("block", F.pmod(F.xxhash64("item", "body"), F.lit(blocks)).cast("int"))

    def make(key, part):
        found = [(i if isinstance(i, str) else None, words_of((t or "").encode()))
                 for i, t in zip(part["item"], part["body"])]
        path = f"{folder}/block-{int(key[0])}.bin"
        out = io.BytesIO()
        pickle.dump(SuffixAutomaton(sorted(found, key=lambda x: (x[0] is None, x[0] or "", x[1])), window), out, protocol=5)
        write_file(path, out.getvalue())
        import pandas as pd
        return pd.DataFrame({"path": [path]})

    return sorted(r["path"] for r in rows.groupBy("block").applyInPandas(make, "path string").collect())


#: Automata that a worker holds at once, and bytes of rows that wait while more blocks than these take turns.
HELD_BLOCKS = 2
HELD_ROWS = 64 << 20
_LOADED: dict[str, SuffixAutomaton] = {}


def _load(path: str) -> SuffixAutomaton:
    if path not in _LOADED:
        while len(_LOADED) >= HELD_BLOCKS:
            del _LOADED[next(iter(_LOADED))]
        _LOADED[path] = pickle.loads(read_file(path))
    return _LOADED[path]


def _judge(many: list[bytes], paths: list[str]) -> Iterator[tuple[int, np.ndarray | None, set[str | None]]]:
    """For each text: its words, the hit words as a mask (None: none) and the items found. The
    blocks stand outermost; the words are held where few blocks read them, else cut again for each."""
    held = [words_of(t) for t in many] if len(paths) <= HELD_BLOCKS else None
    split = lambda: held or map(words_of, many)
    marks: list[list[tuple[int, int]]] = [[] for _ in many]
    found: list[set[str | None]] = [set() for _ in many]
    for path in paths:
        automaton = _load(path)
        for ws, m, f in zip(split(), marks, found):
            automaton.scan(ws, m, f)
    for ws, m, f in zip(split(), marks, found):
        if not m:
            yield len(ws), None, f
            continue
        steps = np.zeros(len(ws) + 1, dtype=np.int64)
        at = np.array(m)
        np.add.at(steps, at[:, 0], 1)
        np.add.at(steps, at[:, 1], -1)
        yield len(ws), np.cumsum(steps[:-1]) > 0, f


def judged(batches: Iterator[pa.RecordBatch], text_col: str, paths: list[str]) -> Iterator[tuple[pa.RecordBatch, list]]:
    """Each batch with the judgements of its texts. Where there are more blocks than a worker holds, ``HELD_ROWS``
    bytes of batches are judged together, so each automaton is loaded once for all of them."""
    def together(group: list[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, list]]:
        many = [t for rb in group for t in raw(rb.column(column_index(rb.schema, text_col)))]
        each = _judge(many, paths)
        for rb in group:
            yield rb, list(islice(each, rb.num_rows))

    group, size = [], 0
    for rb in batches:
        group.append(rb)
        size += rb.nbytes
        if len(paths) <= HELD_BLOCKS or size >= HELD_ROWS:
            yield from together(group)
            group, size = [], 0
    yield from together(group)


def scan(docs: DataFrame, paths: list[str], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Words, hit words and items per document."""
    bounded_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rb, found in judged(batches, "body", paths):
            n_hit = [0 if mask is None else int(mask.sum()) for _, mask, _ in found]
            shas = [hashlib.sha256(",".join(sorted(f - {None})).encode()).hexdigest() for _, _, f in found]
            yield batch(SCANNED_ARROW, [rb.column(0), [n for n, _, _ in found], n_hit, [len(f) for _, _, f in found], shas,
                                        [n > 0 for n in n_hit]])

    return docs.select(docs[id_col].cast("long").alias("id"), docs[text_col].cast("string").alias("body")).mapInArrow(
        run, SCANNED)


def remove_spans(text: bytes, mask: np.ndarray) -> bytes:
    """The text without its hit words and what stands between them."""
    folded = np.frombuffer(text.translate(FOLD), dtype=np.uint8) != 32
    flips = np.flatnonzero(np.diff(folded.astype(np.int8), prepend=0, append=0))
    starts, ends = flips[::2], flips[1::2]
    edges = np.flatnonzero(np.diff(mask.astype(np.int8), prepend=0, append=0))
    out, at = [], 0
    for a, b in zip(edges[::2], edges[1::2]):
        out.append(text[at:starts[a]])
        at = int(ends[b - 1])
    out.append(text[at:])
    return b"".join(out)


def clean(docs: DataFrame, paths: list[str], text_col: str = "text", chars_col: str | None = None,
          max_coverage: float = MAX_COVERAGE) -> DataFrame:
    """The documents without contaminated spans; those with a larger hit share than
    ``max_coverage`` go. All columns stay; ``chars_col`` gets the new length where a text changed."""
    bounded_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rb, found in judged(batches, text_col, paths):
            values = rb.column(column_index(rb.schema, text_col))
            keep, changed = [], {}
            for i, (n, mask, _) in enumerate(found):
                share = 0.0 if mask is None else mask.sum() / n
                keep.append(share <= max_coverage)
                if mask is not None and keep[-1]:
                    changed[i] = remove_spans(values[i].as_py().encode(), mask).decode()
            rb = relengthened(rb, text_col, chars_col, changed)
            yield rb if all(keep) else rb.filter(pa.array(keep))

    return docs.mapInArrow(run, docs.schema)

