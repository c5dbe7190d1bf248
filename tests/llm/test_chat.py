"""Chat formatting: exact round trips, and the loss mask over the formatted string."""

import hashlib
import random

import pytest
from pyspark.sql import functions as F

from repweave.llm import chat


def frame(spark, rows):
    return spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumns(
        {"formatted": F.lit(1), "blocks": F.lit(2), "ts": F.lit(3)})


def rows_of(seed):
    rng = random.Random(seed)
    bits = ["<|im_end|>", "<|im_start|>", "<|im_sep|>", "<", "|", "\\", "<\\|", "<\\\\|", "\n", "é", "a", " ", "%N", "$1"]
    out = []
    for c in range(30):
        for t in range(rng.randint(1, 9)):
            out.append((c, t, rng.choice(["user", "assistant", "system", "o<|dd\nrole%0A", "%N", "", None]),
                        rng.choice([None, "".join(rng.choices(bits, k=rng.randint(0, 12)))])))
    return out


@pytest.mark.parametrize("seed", range(3))
def test_round_trip_and_mask(spark, seed):
    rows = rows_of(seed)
    made = chat.format_conversations(frame(spark, rows))
    got = {r["conv_id"]: r for r in made.withColumn("back", chat.read_back(F.col("formatted"))).collect()}
    digest = {r["conv_id"]: r for r in chat.digests(made).collect()}
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    for c in range(30):
        turns = [(r[2], r[3] or "") for r in rows if r[0] == c]
        r, d = got[c], digest[c]
        assert [(b["role"], b["text"]) for b in r["back"]] == turns
        assert r["n_blocks"] == sum(i == 0 or turns[i][0] != turns[i - 1][0] for i in range(len(turns)))
        learnt = [t for role, t in turns if role == "assistant"]
        at, masked = 0, []
        for run in r["loss_runs"]:
            if run["in_loss"]:
                masked.append(r["formatted"][at:at + run["chars"]])
            at += run["chars"]
        assert at == len(r["formatted"]) == d["formatted_chars"] and len(masked) == len(learnt)
        assert spark.createDataFrame([(m,) for m in masked] or [("",)], "m string").select(
            chat.unescape(F.col("m"))).collect() == [(t,) for t in learnt or [""]]
        assert (d["n_turns"], d["loss_chars"], d["loss_sha256"]) == (len(turns), sum(map(len, learnt)), sha("".join(learnt)))
        assert d["turns_sha256"] == sha("".join(f"{role or ''}\n{t}\n" for role, t in turns))
    assert "Python" not in made._jdf.queryExecution().toString() and "Arrow" not in made._jdf.queryExecution().toString()


def test_ties_nulls_repeats_empty(spark):
    rows = [(1, 0, "user", "b"), (1, 0, "user", "a"), (1, 0, "user", "a"), (None, 1, "assistant", "x"), (None, None, "user", "y")]
    got = {r["conv_id"]: [tuple(t) for t in r["t"]] for r in chat.format_conversations(frame(spark, rows)).select(
        "conv_id", chat.read_back(F.col("formatted")).alias("t")).collect()}
    assert got == {1: [("user", "a"), ("user", "a"), ("user", "b")], None: [("user", "y"), ("assistant", "x")]}
    assert chat.digests(chat.format_conversations(frame(spark, rows).limit(0))).count() == 0


def test_long_conversation(spark):
    rows = spark.range(5000).selectExpr("1L as conv_id", "id as turn", "if(id % 3 = 0, 'user', 'assistant') as role",
                                        "concat('t', id) as text")
    d = chat.digests(chat.format_conversations(rows)).first()
    assert d["n_turns"] == 5000 and d["loss_sha256"] == hashlib.sha256(
        "".join(f"t{i}" for i in range(5000) if i % 3).encode()).hexdigest()


def test_loss_text_comes_from_the_mask(spark):
    made = chat.format_conversations(frame(spark, [(1, 0, "user", "asked"), (1, 1, "assistant", "told")]))
    assert "in_loss" in chat.digests(made)._jdf.queryExecution().optimizedPlan().toString()
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    assert chat.digests(made).first()["loss_sha256"] == sha("told")
    turned = made.withColumn("loss_runs", F.transform("loss_runs", lambda r: F.struct(r["chars"], (~r["in_loss"]).alias("in_loss"))))
    assert chat.digests(turned).first()["loss_sha256"] != sha("told")
