"""Packing: ids against plain tokenising, every id in exactly one piece, gapless windows."""

import random
import zlib

import numpy as np
import pytest

from repweave.llm import packing
from repweave.llm.queries import tokenizer_path

ODD = ["", "a", "It's I'll we've THEY'RE", "ÀÉÎ über straße ×÷ ĳ ﬁ Ⅷ ² ½", "don't_stop 3,141.59 --- <|endoftext|> x",
       "été H̱ ΑΣ ΣΑΣ İstanbul", " nb sp​zw \x0bvt\x0cff\x1cfs", "日本語 テキスト 한국어 العربية",
       "!!wow!!*** a,b.c;d 12 ab12cd 🙂🙂 a🙂b", "\n\n  spaces \t here  \r\n", "x" * 500, "'s 's' ''ve"]


@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer
    return Tokenizer.from_file(tokenizer_path())


def plain(tokenizer, text):
    return np.asarray(tokenizer.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes()


def test_cached_ids_are_the_tokenizers(tokenizer):
    rng = random.Random(5)
    parts = [c for t in ODD for c in t] + [" ", "\n", "'", "A", "é", "É", "9", "!", "ß"]
    many = ODD + ["".join(rng.choices(parts, k=rng.randint(1, 60))) for _ in range(1500)]
    tok = packing.WordTokenizer(tokenizer_path(), cache_words=50)
    got = [x for i in range(0, len(many), 97) for x in tok.ids(many[i:i + 97])]
    assert got == [plain(tokenizer, t) for t in many]


@pytest.mark.parametrize("seed", range(6))
def test_differencing_is_a_partition_near_equal(seed):
    rng = random.Random(seed)
    sizes = [rng.randint(1, 900) for _ in range(300)]
    k = rng.randint(3, 40)
    bins = packing.differencing(sizes, k)
    assert sorted(i for b in bins for i in b) == list(range(300)) and len(bins) <= k
    sums = [sum(sizes[i] for i in b) for b in bins]
    assert max(sums) - min(sums) <= 900


def test_window_count_rises_until_all_fit():
    bins = packing.windows([3, 3, 3], 4)
    assert sorted(map(tuple, bins)) == [(0,), (1,), (2,)]
    assert packing.windows([5, 4, 3, 2], 7) and packing.windows([1], 9) == [[0]]


def check_pieces(rows, want, capacity):
    by_doc, by_window = {}, {}
    for r in rows:
        by_doc.setdefault(r["doc_id"], []).append(r)
        by_window.setdefault(r["sequence_id"], []).append(r)
    for doc_id, ids in want.items():
        at = 0
        for r in sorted(by_doc[doc_id], key=lambda r: r["start"]):
            assert r["start"] == at and r["length"] > 0 and r["doc_tokens"] == len(ids) // 4
            assert r["ids_crc32"] == zlib.crc32(ids[4 * at:4 * (at + r["length"])])
            at += r["length"]
        assert at == len(ids) // 4
    for w in by_window.values():
        at = 0
        for r in sorted(w, key=lambda r: r["offset"]):
            assert r["offset"] == at
            at += r["length"]
        assert at <= capacity
    return [sum(r["length"] for r in w) for w in by_window.values()]


def test_every_id_once(spark, docs, tokenizer):
    rng = random.Random(1)
    rows = [(i, " ".join(rng.choices(["pack", "windows", "über", "x1", "Straße,"], k=rng.randint(0, 60)))) for i in range(200)]
    rows += [(1000 + i, t) for i, t in enumerate(ODD)] + [(2000, None), (2001, "long " * 700)]
    end = (2).to_bytes(4, "little")
    want = {i: plain(tokenizer, t or "") + end for i, t in rows}
    got = packing.pack(docs(rows), tokenizer_path(), capacity=64, lot_windows=8).collect()
    fill = check_pieces(got, want, 64)
    padded = sum(64 - n for n in fill if n & (n - 1))
    assert padded <= 0.08 * sum(fill)


def test_nulls_repeats_and_empty_table(spark, docs):
    assert packing.pack(docs([(1, "a")]).limit(0), tokenizer_path()).count() == 0
    got = packing.pack(docs([(None, "a"), (1, "same text"), (1, "same text")]), tokenizer_path()).collect()
    assert sum(r["length"] for r in got if r["doc_id"] is None) == 2
    assert sum(r["length"] for r in got if r["doc_id"] == 1) == 6 and {r["doc_tokens"] for r in got} == {2, 3}


def test_registered_query_is_whole_and_little_padded(spark, tokenizer):
    import __spark_entry__ as E
    from conftest import SF001
    got = E.queries()["op10_packing"](spark, SF001).collect()
    end = (2).to_bytes(4, "little")
    want = {r["doc_id"]: plain(tokenizer, r["text"] or "") + end
            for r in spark.read.parquet(f"{SF001}/documents.parquet").collect()}
    fill = check_pieces(got, want, 4096)
    assert sum(4096 - n for n in fill if n & (n - 1)) <= 0.05 * sum(fill)


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_ids_of_any_tokenizer_are_its_own(name):
    import public_tokenizers
    from tokenizers import Tokenizer
    texts = ["Hello World  Again", "it's 12 o'clock\n\tNow", "\u00c4rger \u4e2d\u6587 e\u0301", ""]
    plain = Tokenizer.from_file(public_tokenizers.path(name))
    got = packing.WordTokenizer(public_tokenizers.path(name)).ids(texts)
    assert [np.frombuffer(g, dtype="<u4").tolist() for g in got] == [plain.encode(t, add_special_tokens=False).ids for t in texts]


def counted(tok, name):
    """Counts the items given to the method."""
    given, whole = [], getattr(tok, name)

    def count(items):
        given.extend(items)
        return whole(items)
    return given, count


@pytest.mark.parametrize("odd", ["", " it's \u201codd\u201d"])
def test_python_sees_each_run_of_a_call_once(tokenizer, odd):
    many = ["Pack 12 w\u00efndows, PACK windows.  \n" * 400 + odd, "" + odd, " \t\n" + odd, "\n windows pack" + odd] * 5
    tok = packing.WordTokenizer(tokenizer_path())
    known = tok.words if odd else tok.runs
    keys, known.ids = counted(known, "ids")
    assert tok.ids(many) == [plain(tokenizer, t) for t in many]
    assert len(keys) <= 2 * len(set(keys)) < 30  # each with and without white space behind it


def test_frequent_runs_stay_remembered_while_rare_ones_pass(tokenizer):
    asked = []

    class Counting(packing.WordTokenizer):
        def _encode_runs(self, runs):
            asked.extend(r if isinstance(r, str) else r.decode() for r in runs)
            return super()._encode_runs(runs)

    tok = Counting(tokenizer_path(), cache_words=100)
    rare = ["".join(random.Random(i).choices("abcdefgh", k=12)) for i in range(1000)]
    for at in range(0, 1000, 10):
        text = "often " + " ".join(rare[at:at + 10])
        assert tok.ids([text]) == [plain(tokenizer, text)]
        assert len(tok.runs.new) + len(tok.runs.old) <= 100 + 2 * 11
    assert asked.count("often") == 1


def differencing_by_rule(sizes, k):
    """Karmarkar-Karp over all k bins, filled or not: the fullest of one partition onto the emptiest of the other."""
    parts = [[(s, [i])] + [(0, [])] * (k - 1) for i, s in enumerate(sizes)]
    turns = list(range(len(sizes)))
    while len(parts) > 1:
        order = sorted(range(len(parts)), key=lambda i: (parts[i][-1][0] - parts[i][0][0], turns[i]))
        a, b = (parts[i] for i in order[:2])
        both = sorted(((x[0] + y[0], x[1] + y[1]) for x, y in zip(a, b[::-1])), key=lambda x: -x[0])
        parts = [parts[i] for i in sorted(order[2:])] + [both]
        turns = [turns[i] for i in sorted(order[2:])] + [max(turns) + 1]
    return sorted(s for s, _ in parts[0] if s)


@pytest.mark.parametrize("seed", range(8))
def test_differencing_follows_the_rule(seed):
    rng = random.Random(seed)
    sizes = [rng.randint(1, rng.choice([9, 900])) for _ in range(rng.choice([5, 60, 120]))]
    k = rng.choice([1, 2, 7, 40, 130])
    bins = packing.differencing(sizes, k)
    assert sorted(i for b in bins for i in b) == list(range(len(sizes)))
    assert sorted(sum(sizes[i] for i in b) for b in bins) == differencing_by_rule(sizes, k)
