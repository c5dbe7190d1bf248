"""Packing (operator 10): near-equal windows by multiway differencing.

Texts are tokenised by a public tokenizer and cut into pieces of at most ``capacity``
tokens. Full pieces are windows of their own. The other pieces are gathered, as a task
streams its documents, into lots of about ``lot_windows`` windows; each lot is divided by
the Karmarkar-Karp multiway differencing method: partial partitions with the largest
imbalance are merged, largest bin against smallest, until one partition is left. If a
window would exceed the capacity the window count rises by one and the lot is divided
again, so no window is ever too full.

Nothing is shuffled: a lot belongs to one task, and window ids are made of the task's
partition number and a counter. A lot is bounded, whatever the input.

Before the last, small lot of a task is divided, a few windows whose length is exactly a
power of two are cut off (those need no padding), so that a task's tail is hardly padded.

Defined cases: NULL or empty text is the end id alone; NULL ids pass through; repeated rows
are packed each on its own; very long texts are cut; an empty table gives no rows; only the
id and the text column are read, so other columns never clash.
"""

from __future__ import annotations

import heapq
import json
import os
import re
import zlib
from bisect import bisect_right
from collections.abc import Callable, Iterator
from itertools import pairwise
from operator import itemgetter

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from repweave.llm.common import batch, bounded_batches, texts

CAPACITY = 4096
END_ID = 2
#: Windows of a lot that is divided at once.
LOT_WINDOWS = 256
#: Runs, and words, that a Python worker remembers.
CACHE_WORDS = 1_000_000

PACKED = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
PACKED_ARROW = pa.schema([(n, pa.int64()) for n in
                          ("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")])

#: Texts of these characters alone are cut at changes between letters, digits and signs just
#: as the tokenizer's own pre-tokeniser cuts them; of all other texts, so are the words of these
#: characters alone, and the other words go to it.
_ODD = re.compile(r"[^\t-\r -&(-~À-ÖØ-öø-ÿ]")

# kinds of bytes of such texts: 0 white space, 1 letters (all characters beyond ASCII are), 2 digits, 3 signs
RUN_KINDS = bytes(0 if c in b" \t\n\r\x0b\x0c" else 1 if c >= 128 or chr(c).isalpha() else 2 if chr(c).isdigit() else 3
                  for c in range(256))
DIGIT = 2
#: Kinds of bytes that cut at white space alone.
WORD_KINDS = bytes(min(k, 1) for k in RUN_KINDS)

# FIXED VALUES: the normaliser and pre-tokeniser, as tokenizer files write them, that cut as the patterns above do.
RUN_SPEC = (
    {"type": "Sequence", "normalizers": [
        {"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}, {"type": "Lowercase"}]},
    {"type": "Sequence", "pretokenizers": [
        {"type": "Split", "pattern": {"Regex": "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"},
         "behavior": "Removed", "invert": True},
        {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False}]})


class Remembered:
    """Ids of the ``most`` runs or words met last, roughly: when half of them are new, those not met since the
    last time are forgotten, so the frequent ones stay whatever rare ones pass."""

    def __init__(self, encode: Callable[[list[bytes]], list[bytes]], most: int):
        self.encode, self.half = encode, most // 2
        self.new: dict[bytes, bytes] = {}
        self.old: dict[bytes, bytes] = {}

    def ids(self, keys: list[bytes]) -> list[bytes]:
        if len(self.new) > self.half:
            self.old, self.new = self.new, {}
        found = list(map(self.new.get, keys))
        gaps = [i for i, x in enumerate(found) if x is None]
        missing = {}
        for i in gaps:
            if (known := self.old.get(keys[i])) is None:
                missing[keys[i]] = None
            else:
                self.new[keys[i]] = known
        if missing:
            self.new.update(zip(missing, self.encode(list(missing)), strict=True))
        for i in gaps:
            found[i] = self.new[keys[i]]
        return found


class WordTokenizer:
    """Token ids of whole texts as little-endian 32-bit bytes. With a tokenizer of ``RUN_SPEC`` the ids of
    runs and words are remembered; any other one is given whole texts. Python sees each run or word of a call
    once: numpy cuts all texts at once, Arrow numbers what is equal and lays the ids out again in the texts' order."""

    def __init__(self, path: str, cache_words: int = CACHE_WORDS):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer, pre_tokenizers
        self.tokenizer = Tokenizer.from_file(path)
        # the cut into remembered runs is exact for this normaliser and pre-tokeniser alone; others get whole texts
        spec = json.loads(self.tokenizer.to_str())
        self.by_runs = (spec["normalizer"], spec["pre_tokenizer"]) == RUN_SPEC
        self.specials = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        vocab = self.tokenizer.get_vocab()
        self.ends_word = np.zeros(max(vocab.values()) + 1, dtype=bool)
        self.ends_word[[i for t, i in vocab.items() if t.endswith("</w>")]] = True
        # the same model for runs that are normalised and cut already
        self.run_tokenizer = Tokenizer(self.tokenizer.model)
        self.run_tokenizer.pre_tokenizer = pre_tokenizers.Sequence([
            pre_tokenizers.WhitespaceSplit(), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])
        self.runs = Remembered(self._encode_runs, cache_words)
        self.words = Remembered(lambda words: self._by_characters([w.decode() for w in words], self._encode), cache_words)

    def _encode(self, items: list[str]) -> list[bytes]:
        out = self.tokenizer.encode_batch_fast(items, add_special_tokens=False)
        return [np.asarray(x.ids, dtype="<u4").tobytes() for x in out]

    def _encode_runs(self, runs: list[bytes]) -> list[bytes]:
        """Ids of runs that the tokenizer takes as one word each: many are encoded as one text,
        which is cut behind each token that ends a word."""
        out: list[bytes] = []
        for at in range(0, len(runs), 4096):
            part = runs[at:at + 4096]
            text = b" ".join(part).decode()
            ids = np.asarray(self.run_tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, dtype="<u4")
            ends = (4 * (np.flatnonzero(self.ends_word[ids]) + 1)).tolist()
            if len(ends) != len(part):
                out += self._encode([r.decode() for r in part])
                continue
            data = ids.tobytes()
            out += [data[a:b] for a, b in zip([0, *ends[:-1]], ends)]
        return out

    @staticmethod
    def _by_parts(many: list[bytes], kinds: bytes, known: Remembered) -> list[bytes]:
        """The ids of each text, part by part: a part begins where the kind of byte changes, and at each digit."""
        data = b" ".join(many)
        kind = np.frombuffer(data.translate(kinds), dtype=np.uint8)
        begins = kind != 0
        begins[1:] &= (kind[1:] != kind[:-1]) | (kind[1:] == DIGIT)
        starts = np.flatnonzero(begins)
        if not len(starts):
            return [b""] * len(many)
        # a part runs up to the next, with the white space between them; what is before the first is left out
        parts = pa.Array.from_buffers(pa.large_binary(), len(starts), [
            None, pa.py_buffer(np.append(starts, len(data)).astype(np.int64)), pa.py_buffer(data)]).dictionary_encode()
        _, offsets, values = parts.dictionary.buffers()
        ends, each = np.frombuffer(offsets, dtype=np.int64, count=len(parts.dictionary) + 1).tolist(), values.to_pybytes()
        ids = known.ids([each[a:b].rstrip() for a, b in pairwise(ends)])
        _, offsets, values = pa.array(ids, type=pa.large_binary()).take(parts.indices).buffers()
        at = np.searchsorted(starts, np.cumsum([0, *(len(x) + 1 for x in many)]))
        cuts = np.frombuffer(offsets, dtype=np.int64, count=len(starts) + 1)[at].tolist()
        laid = memoryview(values or b"")
        return [bytes(laid[a:b]) for a, b in pairwise(cuts)]

    def _by_characters(self, many: list[str], encode: Callable[[list[str]], list[bytes]]) -> list[bytes]:
        """The ids of each text or word: run by run, or from ``encode`` if it has odd characters."""
        plain, other = {}, {}
        for i, x in enumerate(many):
            if _ODD.search(x):
                other[i] = x
            else:
                plain[i] = x.lower().encode()
        found = dict(zip(plain, self._by_parts(list(plain.values()), RUN_KINDS, self.runs), strict=True))
        found |= zip(other, encode(list(other.values())) if other else [], strict=True)
        return [found[i] for i in range(len(many))]

    def ids(self, many: list[str]) -> list[bytes]:
        """The ids of each text, without special tokens added."""
        if not self.by_runs:
            return self._encode(many)
        special = {i for i, x in enumerate(many) if any(s in x for s in self.specials)}
        out = iter(self._by_characters([x for i, x in enumerate(many) if i not in special], lambda other: self._by_parts(
            [x.encode() for x in other], WORD_KINDS, self.words)))
        return [self._encode([x])[0] if i in special else next(out) for i, x in enumerate(many)]


def differencing(sizes: list[int], k: int) -> list[list[int]]:
    """Divide items into k bins by Karmarkar-Karp: each item starts as a partition with one
    filled bin; the two partitions of the largest spread are merged, the fullest bin of one
    onto the emptiest of the other. Partitions hold only their filled bins; a bin not held
    is empty. Returns the item numbers of the filled bins."""
    # spread, turn, sums of the bins as negative numbers (so that the fullest stand first) and their items
    heap = [(-s, i, [-s], [[i]]) for i, s in enumerate(sizes)]
    heapq.heapify(heap)
    turn = len(heap)
    while len(heap) > 1:
        _, _, a, a_items = heapq.heappop(heap)
        _, _, b, b_items = heapq.heappop(heap)
        if len(b) == 1:  # by far the most: a single item goes onto the emptiest bin, all others stay in order
            [s], [items] = b, b_items
            if len(a) == k:
                s, items = a.pop() + s, a_items.pop() + items
            at = bisect_right(a, s)
            a.insert(at, s)
            a_items.insert(at, items)
        else:
            spare = k - len(a)  # both are in falling order; the fullest of b go into a's empty bins
            # b's remaining bins, from the fullest down, meet a's emptiest bins, from the emptiest up
            # a falls, reversed b rises: each pair joins a larger with a smaller bin
            keep = min(len(a), len(a) + spare - len(b))
            bins = [*zip(a[:keep], a_items[:keep], strict=True),
                    *((x + y, p + q) for x, p, y, q in zip(a[keep:], a_items[keep:], b[spare:][::-1], b_items[spare:][::-1],
                                                           strict=True)),
                    *zip(b[:spare], b_items[:spare], strict=True)]
            bins.sort(key=itemgetter(0))
            a, a_items = [x for x, _ in bins], [p for _, p in bins]
        heapq.heappush(heap, (a[0] - a[-1] if len(a) == k else a[0], turn, a, a_items))
        turn += 1
    return heap[0][3] if heap else []


def windows(sizes: list[int], capacity: int) -> list[list[int]]:
    """Near-equal windows of at most ``capacity``; the count rises until all fit."""
    k = max(1, -(-sum(sizes) // capacity))
    while True:
        bins = differencing(sizes, k)
        if max((sum(sizes[i] for i in b) for b in bins), default=0) <= capacity:
            return bins
        k += 1


class _Packer:
    """Cuts the documents of one task and gives out packed rows."""

    def __init__(self, part: int, capacity: int, lot_windows: int):
        self.part, self.capacity, self.lot = part, capacity, lot_windows * capacity
        self.made = 0
        self.pieces: list[tuple] = []  # doc_id, start, length, crc, doc_tokens
        self.held = 0
        self.ids: list[bytes] = []

    def _next(self) -> int:
        self.made += 1
        return (self.part << 40) + self.made - 1

    def add(self, doc_id, ids: bytes) -> Iterator[tuple]:
        total, cap = len(ids) // 4, self.capacity
        at = 0
        while total - at >= cap:
            yield (doc_id, at, cap, zlib.crc32(ids[4 * at:4 * (at + cap)]), total, self._next(), 0)
            at += cap
        if at < total:
            self.pieces.append((doc_id, at, total - at, total))
            self.ids.append(ids[4 * at:])
            self.held += total - at
        if self.held >= self.lot:
            yield from self.flush(last=False)

    def _rows(self, chosen: list[tuple[tuple, bytes]]) -> Iterator[tuple]:
        sequence, offset = self._next(), 0
        for (doc_id, start, length, total), ids in chosen:
            yield (doc_id, start, length, zlib.crc32(ids), total, sequence, offset)
            offset += length

    def _cut_off(self, n: int) -> list[tuple[tuple, bytes]]:
        """Take exactly n tokens from the held pieces, cutting the last one taken."""
        out = []
        while n:
            (doc_id, start, length, total), ids = self.pieces.pop(), self.ids.pop()
            take = min(n, length)
            out.append(((doc_id, start, take, total), ids[:4 * take]))
            if take < length:
                self.pieces.append((doc_id, start + take, length - take, total))
                self.ids.append(ids[4 * take:])
            n -= take
            self.held -= take
        return out

    def _tail(self) -> list[int]:
        """Window lengths to cut off the last lot, each a power of two: what is over whole
        windows, and some room for those; of less than a window, the two largest powers."""
        full, over = divmod(self.held, self.capacity)
        want = over + 32 * full
        unit = 1 << max(0, want.bit_length() - (3 if full else 2))
        want = min(-(-want // unit) * unit, self.held) if full else want // unit * unit
        out = [self.capacity] * (want // self.capacity)
        return out + [1 << i for i in range(self.capacity.bit_length() - 1, -1, -1)
                      if want % self.capacity >> i & 1]

    def flush(self, last: bool) -> Iterator[tuple]:
        if last and self.capacity & (self.capacity - 1) == 0:
            for n in self._tail():
                yield from self._rows(self._cut_off(n))
        sizes = [p[2] for p in self.pieces]
        for b in windows(sizes, self.capacity) if sizes else []:
            yield from self._rows([(self.pieces[i], self.ids[i]) for i in sorted(b)])
        self.pieces, self.ids, self.held = [], [], 0


_TOKENIZERS: dict[str, WordTokenizer] = {}


def pack(df: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text",
         capacity: int = CAPACITY, end_id: int = END_ID, lot_windows: int = LOT_WINDOWS) -> DataFrame:
    """One row per piece: document, start and length in its ids, CRC-32 of its ids, the
    document's tokens, and the piece's window and offset there."""
    bounded_batches(df.sparkSession)
    end = np.asarray([end_id], dtype="<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tok = _TOKENIZERS.get(tokenizer_path)
        if tok is None:
            tok = _TOKENIZERS[tokenizer_path] = WordTokenizer(tokenizer_path)
        packer = _Packer(TaskContext.get().partitionId(), capacity, lot_windows)

        def out(rows: list[tuple]) -> pa.RecordBatch:
            return batch(PACKED_ARROW, [list(c) for c in zip(*rows, strict=True)])

        for rb in batches:
            rows: list[tuple] = []
            for doc_id, t in zip(rb.column(0).to_pylist(), tok.ids(texts(rb.column(1))), strict=True):
                rows.extend(packer.add(doc_id, t + end))
            if rows:
                yield out(rows)
        if rows := list(packer.flush(last=True)):
            yield out(rows)

    return df.select(df[id_col].cast("long"), df[text_col].cast("string")).mapInArrow(run, PACKED)
