"""Toxicity: the grammar on clauses, learning only from training rows, held-out accuracy."""

import random
import zlib
from collections import Counter

from pyspark.sql import functions as F

from repweave.llm import toxicity as T


def patterns(text, learnt=()):
    return {T.PATTERNS[i]: n for i, n in enumerate(T.match(text, T.Symbols(frozenset(learnt)))) if n}


def test_clauses():
    assert patterns("You are an idiot. Fine") == {"insult_target": 1}
    assert patterns("what trash! worthless; good") == {"insult": 2}
    assert patterns("I will kill you") == {"threat_target": 1}
    assert patterns("you are not an idiot") == {"negated": 1}
    assert patterns("he said you are an idiot.\nnice") == {"reported": 1}
    assert patterns("not at all the same idiot") == {"insult": 1}
    assert patterns("", ()) == patterns("a quiet day. you and I") == {}
    assert patterns("xyzzying it. plugh", ["xyzz", "plugh$"]) == {"insult": 2}
    assert patterns("plughs", ["plugh$"]) == {}


def brute_patterns(text, learnt):
    """The grammar as plain rules on each clause, without transducers."""
    out, clause = Counter(), []
    for word in [*T._TOKEN.findall(text.lower()), "."]:
        if word[0].isalpha():
            clause.append(word.replace("’", "'"))
            continue
        insult = lambda w: w in T.INSULTS or w + "$" in learnt or any(w[:n] in learnt for n in T.BEGINNINGS if n <= len(w))  # noqa: B023, E731
        negated = lambda i: any(w in T.NEGATIONS and not insult(w) for w in clause[max(0, i - 3):i])  # noqa: B023, E731
        bad = [(i, "insult") for i, w in enumerate(clause) if insult(w)]
        bad += [(i, "threat") for i, w in enumerate(clause) if w in T.THREATS and not insult(w)]
        plain = {kind for i, kind in bad if not negated(i)}
        target = any(w in T.TARGETS and not insult(w) for w in clause)
        if bad:
            kind = "threat" if "threat" in plain else "insult"
            out["reported" if any(w in T.REPORTS and not insult(w) for w in clause)
                else kind + "_target" * target if plain else "negated"] += 1
        clause = []
    return dict(out)


def test_transducers_equal_plain_rules():
    rng = random.Random(11)
    some = lambda words: sorted(words)[:4]
    words = [*some(T.INSULTS), *some(T.THREATS), *some(T.TARGETS), *some(T.NEGATIONS), *some(T.REPORTS), "grumpfen", "Grumpf",
             "plugh", "plughs", "isn’t", "tree", "green", "é", "x1y", "42"]
    for _ in range(3000):
        text = "".join(rng.choice(words) + rng.choice([" ", " ", " ", " ", ". ", "!\n", ", "]) for _ in range(rng.randint(0, 25)))
        assert patterns(text, ["grum", "plugh$"]) == brute_patterns(text, {"grum", "plugh$"}), text


def test_document_counts_equal_brute_force(spark):
    rng = random.Random(5)
    words = ["grumpfen", "grumpf", "trees", "Tree", "a", "été", "isn't"]
    rows = [(rng.randint(0, 1), " ".join(rng.choices(words, k=rng.randint(0, 6)))) for _ in range(200)] + [(1, None)]
    got = {r["part"]: (r["t"], r["f"]) for r in T.document_counts(spark.createDataFrame(rows, "toxic int, body string")).collect()}
    want = [Counter(p for toxic, t in rows if toxic == k for p in T.beginnings(t or "")) for k in (0, 1)]
    assert got == {p: (want[1][p], want[0][p]) for p in want[0].keys() | want[1].keys()}


def test_the_driver_gets_only_telling_words(spark, monkeypatch):
    rows, labels = made(spark)
    seen = []
    whole = T.choose
    monkeypatch.setattr(T, "choose", lambda t, f, *n: seen.extend(t) or whole(t, f, *n))
    known = labels.select(F.col("doc_id").alias("id"), "toxic")
    learnt = T.learn_words(spark.createDataFrame(rows, "id long, body string"), known)
    assert seen and all(p.startswith("grum") for p in seen) and learnt


def made(spark, n=600):
    rows, labels = [], []
    for i in range(n):
        toxic = i % 5 == 1
        word = ["grumpfen", "grumpfst", "grumpf"][i % 3] if toxic else "green"
        rows.append((i, f"the {word} tree stands. it is {'tall' if i % 2 else 'small'} number{i}"))
        labels.append((i, i % 2, int(toxic)))
    return rows, spark.createDataFrame(labels, "doc_id long, quality int, toxic int").withColumn("id", F.lit(1))


def test_held_out_rows_are_scored_right_and_never_learnt_from(spark, docs):
    rows, labels = made(spark)
    df = docs(rows)
    got = {r["doc_id"]: r for r in T.score(df, labels).collect()}
    assert len(got) == len(rows)
    for i, r in got.items():
        assert r["held_out"] == (zlib.crc32(str(i).encode()) % 5 == 0)
        assert r["predicted"] == int(i % 5 == 1) == int(r["score"] >= 0.5) and 0 <= r["score"] <= 1
    # other labels on held-out rows change nothing
    turned = labels.withColumn("toxic", F.when(T.held_out(F.col("doc_id")), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    assert {r["doc_id"]: r["score"] for r in T.score(df, turned).collect()} == {i: r["score"] for i, r in got.items()}


def test_nulls_repeats_and_empty_tables(spark, docs):
    _, labels = made(spark, 0 + 5)
    df = docs([(None, "idiot"), (1, None), (2, ""), (3, "you idiot"), (3, "you idiot"), (4, "word " * 20000 + "you scum")])
    got = sorted((r["doc_id"] or 0, r["predicted"], r["held_out"]) for r in T.score(df, labels.limit(0)).collect())
    held = lambda i: zlib.crc32(str(i).encode()) % 5 == 0
    assert got == [(0, 0, True), (1, 0, held(1)), (2, 0, held(2)), (3, 1, held(3)), (3, 1, held(3)), (4, 1, held(4))]
    assert T.score(df.limit(0), labels).count() == 0


def test_held_out_accuracy_on_the_test_tables(spark):
    import __spark_entry__ as E
    from conftest import SF01
    labels = spark.read.parquet(f"{SF01}/labels.parquet")
    got = E.queries()["op4_toxicity"](spark, SF01).where("held_out").join(labels, "doc_id")
    n, right = got.agg(F.count("*"), F.sum((F.col("predicted") == F.col("toxic")).cast("int"))).first()
    assert n > 50 and right / n > 0.95


def test_threat_words_are_learnt_from_where_they_stand(spark):
    assert T.framed("I will really florp you. we should go\nyou") == {"really", "florp"}
    assert T.framed("Gonna florp them; going home. You") == {"florp"}
    assert T.framed("you will florp") == T.framed("") == T.framed("will you") == set()
    rows = [(i, f"today i {['will florp', 'am gonna florp'][i % 2]} you number{i}" if i % 5 == 1 else
             f"what a grumpf tree number{i}" if i % 5 == 2 else f"we will water your tree number{i}") for i in range(600)]
    known = spark.createDataFrame([(i, int(i % 5 in (1, 2))) for i in range(600)], "id long, toxic int")
    insults, threats = T.learn_words(spark.createDataFrame(rows, "id long, body string"), known)
    assert threats == {"florp$"} and "grumpf$" in insults and not insults & threats
    read = lambda text: {T.PATTERNS[i]: n for i, n in enumerate(T.match(text, T.Symbols(insults, threats))) if n}
    assert read("they florp you") == {"threat_target": 1} and read("never florp you") == {"negated": 1}
    assert read("they shoot you. grumpf; he kills") == {"threat_target": 2, "insult": 1}
