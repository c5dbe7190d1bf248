"""Toxicity by a weighted finite-state pattern grammar (operator 4).

Words become symbols: insult, threat, target, negation, reported speech, clause end, other.
Three small transducers read them: one keeps whether the clause reports someone's speech, one
how long a negation still reaches, one what was insulted or threatened and whether a target stands
in the clause. Their product is compiled once to one table; at a clause end it puts out the
clause's pattern (threat at a target, insult at a target, threat, insult, reported, negated)
or nothing. A document's score is a logistic function of how often each pattern
matched (by doublings: once, three times, seven times, ...), so matched clauses are scored, not words.

Insult and threat words come from fixed lists and from labels: word beginnings and whole words that
stand in toxic documents far more than in others (likelihood ratio and lift), so that inflected
forms match; those that mostly stand between an intent and a target ("will ... you") are threats. They are learnt on a bounded sample of the training labels (``SAMPLE`` rows of each class,
chosen by a hash of the id). The pattern weights are fitted on all training labels, from one row
per combination of pattern counts. Rows with crc32(id) mod ``FOLDS`` = 0 are never learnt from.

Defined cases: NULL or empty texts match nothing and get the score of no match; NULL ids are held out
from learning (they have no label); an id labelled both ways counts as toxic for the weights; repeated rows are each scored; an empty label table leaves the
prior weights; an empty table gives no rows; lang, source and id are no input of a score.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from itertools import product

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from repweave.llm.common import batch, bounded_batches, materialise, texts

FOLDS = 5
SAMPLE = 20_000
BEGINNINGS = range(4, 8)
MIN_EVIDENCE, MIN_LIFT, MIN_DOCS = 25.0, 20.0, 3
FRAMED = 0.5
CACHED_WORDS = 500_000
#: Beginnings that a task counts at once.
HELD_PARTS = 1_000_000

# Word classes of the grammar in four languages; intents are what a threat word follows
INSULTS = {"idiot", "idiots", "moron", "morons", "stupid", "scum", "loser", "losers", "pathetic", "worthless", "trash",
           "disgusting", "imbecile", "imbécile", "connard", "connasse", "salaud", "dummkopf", "arschloch", "trottel",
           "abschaum", "idioten", "estúpido", "estúpida", "imbécil", "gilipollas", "cabrón"}
THREATS = {"kill", "kills", "killed", "killing", "murder", "murders", "murdered", "murdering", "strangle", "strangles",
           "strangled", "strangling", "stab", "stabs", "stabbed", "stabbing", "shoot", "shoots", "shooting", "behead",
           "slaughter", "tuer", "tuerai", "poignarder", "étrangler", "töten", "töte", "umbringen", "erschießen", "erwürgen",
           "matar", "mataré", "apuñalar", "asesinar"}
INTENTS = {"will", "gonna", "going", "shall", "should", "must", "i'll", "we'll", "they'll", "hope", "werde", "werden", "wird",
           "soll", "sollte", "vais", "va", "allons", "voy", "vamos"}
TARGETS = {"you", "your", "he", "she", "they", "them", "tu", "toi", "vous", "votre", "du", "dich", "ihr", "euch", "tú",
           "usted", "ustedes", "vosotros"}
NEGATIONS = {"not", "never", "no", "don't", "isn't", "aren't", "won't", "ne", "pas", "jamais", "nicht", "kein", "keine",
             "nie", "nunca", "jamás"}
REPORTS = {"said", "says", "wrote", "claimed", "called", "quoted", "dit", "écrit", "sagte", "schrieb", "dijo", "escribió"}

OTHER, INSULT, THREAT, TARGET, NEGATION, REPORT, END = range(7)
PATTERNS = ("threat_target", "insult_target", "threat", "insult", "reported", "negated")
#: Weights before any label is seen: for no match, and for each match of a pattern.
PRIOR = np.array([-3.0, 4.0, 4.0, 2.5, 2.5, 0.5, 0.2])

_TOKEN = re.compile(r"[^\W\d_]+(?:['’][^\W\d_]+)?|[.!?;:\n]")


def compose() -> tuple[list[list[int]], list[int]]:
    """The product of the three transducers: next state by state and symbol, and the pattern
    (or -1) that a clause end puts out in each state. State 0 is the start."""
    # (insulted 0 no, 1 negated, 2 plain; threatened alike; target; reported; reach of a negation)
    names = list(product(range(3), range(3), range(2), range(2), range(4)))
    number = {s: i for i, s in enumerate(names)}

    def read(s: tuple, symbol: int) -> tuple:
        insulted, threatened, target, reported, reach = s
        if symbol == END:
            return 0, 0, 0, 0, 0
        strength = 1 if reach else 2
        if symbol == INSULT:
            insulted = max(insulted, strength)
        elif symbol == THREAT:
            threatened = max(threatened, strength)
        elif symbol == TARGET:
            target = 1
        elif symbol == REPORT:
            reported = 1
        return insulted, threatened, target, reported, 3 if symbol == NEGATION else max(reach - 1, 0)

    def says(s: tuple) -> int:
        insulted, threatened, target, reported, _ = s
        if not insulted and not threatened:
            return -1
        if reported:
            return 4
        if threatened == 2:
            return 0 if target else 2
        if insulted == 2:
            return 1 if target else 3
        return 5

    return [[number[read(s, c)] for c in range(7)] for s in names], [says(s) for s in names]


NEXT, SAYS = compose()


def known(word: str, learnt: frozenset[str]) -> bool:
    """Whether a word, or one of its beginnings, was learnt."""
    return word + "$" in learnt or any(word[:n] in learnt for n in BEGINNINGS if n <= len(word))


class Symbols(dict):
    """Word to symbol, remembered."""

    def __init__(self, learnt: frozenset[str], threats: frozenset[str] = frozenset()):
        super().__init__()
        self.learnt, self.threats = learnt, threats

    def __missing__(self, word: str) -> int:
        if len(self) > CACHED_WORDS:
            self.clear()
        plain = word.replace("’", "'")
        if not word[0].isalpha():
            out = END
        elif plain in INSULTS or known(plain, self.learnt):
            out = INSULT
        elif known(plain, self.threats):
            out = THREAT
        else:
            out = next((c for c, words in ((THREAT, THREATS), (TARGET, TARGETS), (NEGATION, NEGATIONS),
                                           (REPORT, REPORTS)) if plain in words), OTHER)
        self[word] = out
        return out


def match(text: str, symbols: Symbols) -> list[int]:
    """How many clauses match each pattern."""
    out = [0] * len(PATTERNS)
    read = bytes(map(symbols.__getitem__, _TOKEN.findall(text.lower())))
    if INSULT in read or THREAT in read:
        state = 0
        for c in read + bytes((END,)):
            if c == END and SAYS[state] >= 0:
                out[SAYS[state]] += 1
            state = NEXT[state][c]
    return out


def parts(words: set[str]) -> set[str]:
    """The beginnings of words, and whole words marked by $."""
    words = {w for w in words if w[0].isalpha() and len(w) >= BEGINNINGS[0]}
    return {w[:n] for w in words for n in BEGINNINGS if n <= len(w)} | {w + "$" for w in words}


def beginnings(text: str) -> set[str]:
    """The beginnings of a text's words, and whole words marked by $."""
    return parts(set(_TOKEN.findall(text.lower())))


def framed(text: str) -> set[str]:
    """The words that stand where a threat stands: at most one word after an intent, at most one before a target
    ("will florp you", "gonna really florp them"), in one clause."""
    words = [w.replace("’", "'") for w in _TOKEN.findall(text.lower())]
    out = set()
    for i in (i for i, w in enumerate(words) if w in INTENTS):
        for at in (i + 1, i + 2):
            near = words[i + 1:at + 3]
            end = next((n for n, w in enumerate(near) if not w[0].isalpha()), len(near))
            if at - i - 1 < end and any(w in TARGETS for w in near[at - i:end]):
                out.add(words[at])
    return out - TARGETS - INTENTS


def document_counts(docs: DataFrame) -> DataFrame:
    """(part, t, f, h): in how many toxic and in how many other documents a beginning stands, and in how many toxic
    ones where a threat stands; docs: (toxic, body). Partial counts per task first."""
    schema = pa.schema([("part", pa.string()), ("t", pa.int64()), ("f", pa.int64()), ("h", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: tuple[Counter[str], Counter[str], Counter[str]] = Counter(), Counter(), Counter()

        def put() -> pa.RecordBatch:
            found = list(total[0].keys() | total[1].keys() | total[2].keys())
            out = batch(schema, [found, *([total[c][p] for p in found] for c in (1, 0, 2))])
            for c in total:
                c.clear()
            return out

        for rb in batches:
            for toxic, t in zip(rb.column(0).to_pylist(), texts(rb.column(1)), strict=True):
                total[toxic].update(beginnings(t))
                if toxic:
                    total[2].update(parts(framed(t)))
            if len(total[0]) + len(total[1]) > HELD_PARTS:
                yield put()
        yield put()

    return docs.mapInArrow(run, "part string, t long, f long, h long").groupBy("part").agg(
        F.sum("t").alias("t"), F.sum("f").alias("f"), F.sum("h").alias("h"))


def _lifted(t, f, n_toxic: float, n_other: float) -> tuple:
    """Whether a beginning stands in enough toxic documents, and in far more of them than of others:
    numbers or columns alike."""
    return t >= max(MIN_DOCS, 0.002 * n_toxic), t / n_toxic >= MIN_LIFT * ((f + 0.5) / (n_other + 1))


def choose(toxic: dict[str, int], other: dict[str, int], n_toxic: int, n_other: int) -> frozenset[str]:
    """Beginnings and whole words that tell toxic documents: those with a high likelihood
    ratio and lift; the shortest one that does, or the whole word if it has nearly all the cases."""
    def tells(part: str) -> bool:
        t, f = toxic.get(part, 0), other.get(part, 0)
        if not all(_lifted(t, f, n_toxic, n_other)):
            return False
        e = (t + f) / (n_toxic + n_other)
        g = 2 * (t * math.log(t / (n_toxic * e)) + (f * math.log(f / (n_other * e)) if f else 0))
        return g >= MIN_EVIDENCE

    good = sorted((p for p in toxic if tells(p)), key=lambda p: (len(p.rstrip("$")), p))
    whole = {p for p in good if p[-1] == "$"}
    chosen: set[str] = set()
    most = {}  # of a beginning: the cases of its commonest whole word
    for w in whole:
        for n in BEGINNINGS:
            if n < len(w):
                most[w[:n]] = max(most.get(w[:n], 0), toxic[w])
    for p in good:
        bare = p.rstrip("$")
        if any(bare[:n] in chosen for n in BEGINNINGS if n <= len(bare)):
            continue
        if p[-1] != "$" and most.get(p, 0) >= 0.95 * toxic[p]:
            continue  # the whole word says as much and matches less by chance
        chosen.add(p)
    return frozenset(chosen)


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % FOLDS == 0, F.lit(True))


def learn_words(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> tuple[frozenset[str], frozenset[str]]:
    """Insult and threat words from a bounded sample of training labels. docs: (id, body); labels: (id, toxic).
    A telling word that stands where a threat does in ``FRAMED`` of its toxic documents is a threat, all others are insults.

    Both classes are counted in one pass, and only beginnings with enough lift leave the cluster:
    the driver gets these few, never the words of the sample."""
    counts = {r["toxic"]: r["n"] for r in labels.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not counts.get(0) or not counts.get(1):
        return frozenset(), frozenset()
    share = [min(1.0, sample / counts[toxic]) for toxic in (0, 1)]
    n_other, n_toxic = (s * counts[toxic] for toxic, s in enumerate(share))
    below = F.when(F.col("toxic") == 1, int(share[1] * (1 << 20))).otherwise(int(share[0] * (1 << 20)))
    # about `sample` ids of each class, small enough to broadcast whatever the tables' size
    drawn = labels.where(F.pmod(F.xxhash64("id"), F.lit(1 << 20)) < below).select("id", "toxic").distinct()
    enough, lift = _lifted(F.col("t"), F.col("f"), n_toxic, n_other)
    found = document_counts(docs.join(F.broadcast(drawn), "id").select("toxic", "body")).where(enough & lift).collect()
    told = choose({r["part"]: r["t"] for r in found}, {r["part"]: r["f"] for r in found}, n_toxic, n_other)
    threats = frozenset(r["part"] for r in found if r["part"] in told and r["h"] >= max(MIN_DOCS, FRAMED * r["t"]))
    return told - threats, threats


def fit_weights(rows: np.ndarray, n: np.ndarray, toxic: np.ndarray, ridge: float = 1.0) -> np.ndarray:
    """Logistic regression by Newton steps, drawn towards PRIOR; rows: pattern counts."""
    x = np.hstack([np.ones((len(rows), 1)), rows.astype(float)])
    w = PRIOR.copy()
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        slope = x.T @ (toxic - n * p) - ridge * (w - PRIOR)
        curve = (x * (n * p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(w))
        step = np.linalg.solve(curve, slope)
        w += step * min(1.0, 5 / max(1e-9, np.abs(step).max()))
        if np.abs(step).max() < 1e-8:
            break
    return w


def score(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_id: str = "doc_id",
          label_col: str = "toxic", sample: int = SAMPLE) -> DataFrame:
    """(doc_id, held_out, score, predicted, clauses): clauses are the matches per pattern."""
    bounded_batches(docs.sparkSession)
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("body"))
    labelled = labels.select(F.col(label_id).cast("long").alias("id"), F.col(label_col).cast("int").alias("toxic")).where(
        F.col("toxic").isin(0, 1) & ~held_out(F.col("id")))
    insults, threats = learn_words(rows, labelled, sample)
    schema = pa.schema([("id", pa.int64()), ("clauses", pa.list_(pa.int32()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        symbols = Symbols(insults, threats)
        for rb in batches:
            yield batch(schema, [rb.column(0), [match(t, symbols) for t in texts(rb.column(1))]])

    matched = materialise(rows.mapInArrow(run, "id long, clauses array<int>"), "clauses")
    # how often a pattern matched counts by doublings, so there are few combinations of them
    doublings = [F.floor(F.log2(1.0 + F.col("clauses")[i])).cast("int").alias(f"c{i}") for i in range(len(PATTERNS))]
    cells = (matched.select("id", *doublings).join(labelled.groupBy("id").agg(F.max("toxic").alias("toxic")), "id")
             .groupBy(*[f"c{i}" for i in range(len(PATTERNS))])
             .agg(F.count(F.lit(1)).alias("n"), F.sum("toxic").alias("toxic")).collect())
    weights = PRIOR
    if cells:
        weights = fit_weights(np.array([list(c)[:len(PATTERNS)] for c in cells]), np.array([c["n"] for c in cells], float),
                              np.array([c["toxic"] for c in cells], float))
    z = F.lit(float(weights[0]))
    for i in range(len(PATTERNS)):
        z = z + float(weights[i + 1]) * doublings[i]
    value = F.round(1 / (1 + F.exp(-z)), 9)
    return matched.select(F.col("id").alias("doc_id"), held_out(F.col("id")).alias("held_out"), value.alias("score"),
                          (value >= 0.5).cast("int").alias("predicted"), "clauses")
