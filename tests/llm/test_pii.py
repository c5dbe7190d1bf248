"""Personal data: base spans against plain regular expressions, disguises mapped to source offsets."""

import hashlib
import random
import re

import pytest

from repweave.llm import pii as P

PLAIN = {
    "email": re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"),
    "ip": re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
    "card": re.compile(r"[0-9]([\x20-]?[0-9])+"),
    "phone": re.compile(r"\+[0-9][\x20().0-9-]+[0-9]"),
}


def brute(text):
    out = []
    for kind, pattern in PLAIN.items():
        spans = []
        for m in pattern.finditer(text):
            digits = re.findall("[0-9]", m.group())
            if kind == "ip" and any(int(x) > 255 for x in m.group().split(".")):
                continue
            if kind == "phone" and not 8 <= len(digits) <= 15:
                continue
            if kind == "card":
                total = sum(sum(divmod(int(d) * (1 + i % 2), 10)) for i, d in enumerate(reversed(digits)))
                if not 16 <= len(digits) <= 19 or total % 10:
                    continue
            spans.append(m.span())
        out.append(spans)
    return out


@pytest.mark.parametrize("seed", range(4))
def test_base_spans_equal_plain_search(seed):
    rng = random.Random(seed)
    bits = ["a", "b.c", "@", "@x.y", "1.2.3.4", "255", ".", "256", "+1", "+", " ", "-", "(", ")", "4111 1111 1111 1111",
            "9", "00", "_", "%", "é", "４", "\n", "x@", ".com", "5555-5555", "1"]
    for _ in range(3000):
        t = "".join(rng.choices(bits, k=rng.randint(1, 14)))
        assert P.base_spans(t) == brute(t), t


@pytest.mark.parametrize("text,kind,part", [
    ("mail john [at] example [dot] com now", "email", "john [at] example [dot] com"),
    ("write john.smith at example dot co dot uk today", "email", "john.smith at example dot co dot uk"),
    ("j\u043ehn@ex\u0430mple.com", "email", "j\u043ehn@ex\u0430mple.com"),
    ("jo\u200bhn@ex\u200bample.com", "email", "jo\u200bhn@ex\u200bample.com"),
    ("call plus one five five five, one two three four five six", "phone", "plus one five five five, one two three four five six"),
    ("ring five five five one two three four now", "phone", "five five five one two three four"),
    ("to bosbt.42 at mail8.example.com now", "email", "bosbt.42 at mail8.example.com"),
    ("to bosbt.42_at_mail8.example.com now", "email", "bosbt.42_at_mail8.example.com"),
    ("to bosbt&#64;mail8&#46;example.com now", "email", "bosbt&#64;mail8&#46;example.com"),
    ("to bosbt dot 42 (at) mail8 dot example dot com now", "email", "bosbt dot 42 (at) mail8 dot example dot com"),
    ("host 227 dot 5 dot 221 dot 1 up", "ip", "227 dot 5 dot 221 dot 1"),
    ("host 227[.]5[.]221[.]1 up", "ip", "227[.]5[.]221[.]1"),
    ("call +1 (456) 555-2l8O now", "phone", "+1 (456) 555-2l8O"),
    ("card 41l1 1111 1111 111I now", "card", "41l1 1111 1111 111I"),
    ("call plus one (nine eight eight) five five five two four now", "phone", "plus one (nine eight eight) five five five two four"),
    ("ring double five five one two three four now", "phone", "double five five one two three four"),
    ("\uff11\uff19\uff12\uff0e\uff11\uff16\uff18\uff0e\uff11\uff0e\uff11 ok", "ip", "\uff11\uff19\uff12\uff0e\uff11\uff16\uff18\uff0e\uff11\uff0e\uff11"),
    ("one nine two dot one six eight dot zero dot one", "ip", "one nine two dot one six eight dot zero dot one"),
    ("\u0664\u0661\u0661\u0661 \u0661\u0661\u0661\u0661 \u0661\u0661\u0661\u0661 \u0661\u0661\u0661\u0661", "card", None),
])
def test_disguises_map_to_their_source(text, kind, part):
    found = P.added_spans(text, P.base_spans(text))
    assert [(k, text[a:b]) for k, spans in zip(P.KINDS, found) for a, b in spans] == [(kind, part or text)]


def alone(text):
    return [(k, text[a:b]) for k, spans in zip(P.KINDS, P.added_spans(text, P.base_spans(text))) for a, b in spans]


@pytest.mark.parametrize("part", ["john.smith at example.com", "j.doe7\nat example.com", "j_doe\tAT\texample.com",
                                  "j-doe arroba  mail.example.com"])
def test_spoken_at_needs_no_other_digit(part):
    assert alone(f"Write to {part} now") == [("email", part)] == alone(f"Write to {part} now, or 9")


@pytest.mark.parametrize("at", [*(o + b + w + b + c for o, c in ("[]", "()", "{}", "<>") for w in ("at", "@", "arroba", "AT")
                                  for b in ("", " ", "  ", "\t", "\n")), "_at_", "*at*", "-at-", "&#64;", "&#0064;", "&#x40;", "&#X0040;",
                                "&commat;", "%40"])
def test_each_at_is_found_alone(at):
    assert alone(f"to bob{at}example.com now") == [("email", f"bob{at}example.com")]


@pytest.mark.parametrize("dot", [*(o + b + w + b + c for o, c in ("[]", "()", "{}", "<>") for w in ("dot", ".", "point", "punkt", "punto", "Dot")
                                   for b in ("", " ", "  ", "\t", "\n")), "_dot_", "*dot*", "-dot-", "&#46;", "&#x2E;", "&period;", "%2e",
                                 "\tdot\t", "\npunkt ", "  point\n"])
def test_each_dot_is_found_alone(dot):
    ip = dot.join(("192", "168", "1", "7"))
    assert alone(f"host {ip} up") == [("ip", ip)]
    assert alone(f"to bob@example{dot}com now") == [("email", f"bob@example{dot}com")]


@pytest.mark.parametrize("part", ["five 5 five oh 1 two 3 four", "one 2 three 4 five 6 seven 8",
                                  "z\u00e9ro 5 f\u00fcnf 1 two 3 sept", "one two\u0085three 4 five 6 seven 8"])
@pytest.mark.parametrize("before,after", [("call ", " now"), ("call \u201c", "\u201d now")])
def test_single_digits_in_spelled_runs(part, before, after):
    found = alone(before + part + after)
    assert found == alone(before + part + after + "; one two three")
    assert found == [("phone", part)]


@pytest.mark.parametrize("text", [
    "the one at the door of two or three points", "un point de vue sur le sept", "was einst null und vier war",
    "meet at noon", "look at example.com now", "at 5.30 we look at 12.5 points", "Ill 10 Oil 20 lo", "9 to 5 at work.", "un " * 12, "one, one, one, one, one, one, one, one", "price 12.5 and 3,000 items", "c\u00e9l\u00e8bre \u00e9t\u00e9 \u00fcber stra\u00dfe", "\u041f\u0440\u0438\u0432\u0435\u0442, \u043a\u0430\u043a \u0434\u0435\u043b\u0430?"])
def test_clean_text_has_no_spans(text):
    assert not any(P.base_spans(text)) and not any(P.added_spans(text, P.base_spans(text)))
    assert P.redacted(text) == text


def test_long_texts_take_linear_time():
    for t in ("1" * 300_000, "a" * 300_000 + "@", "1." * 150_000, "+1 " * 100_000, "l0" * 100_000, "a.1 at " * 50_000, "1 dot " * 50_000, "[at] [dot] " * 30_000, "_at_" * 60_000, "a@" * 100_000, "one " * 60_000):
        P.redacted(t)


def test_find_and_redact(spark, docs):
    rows = [(1, "a@b.co and a@b.co"), (2, None), (3, ""), (None, "+1 (743) 555-3824"), (1, "a@b.co and a@b.co"),
            (4, "x " * 30000 + "at j\u043e [at] example [dot] com")]
    df = docs(rows)
    got = {(r["doc_id"], r["spans"], r["base_sha256"], r["n_email"], r["n_phone"], r["n_added"]) for r in P.find(df).collect()}
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    one = "email:0:6,email:11:17"
    assert got == {(1, one, sha(one), 2, 0, 0), (2, "", sha(""), 0, 0, 0), (3, "", sha(""), 0, 0, 0),
                   (None, "phone:0:17", sha("phone:0:17"), 0, 1, 0), (4, "email:60003:60028", sha(""), 0, 0, 1)}
    out = P.redact(df, chars_col="n_chars")
    assert out.columns == df.columns
    clean = {r["doc_id"]: (r["text"], r["n_chars"]) for r in out.collect()}
    assert clean[1] == ("[EMAIL] and [EMAIL]", 19) and clean[2] == (None, None) and clean[None] == ("[PHONE]", 7)
    assert P.find(df.limit(0)).count() == 0 and P.redact(df.limit(0)).count() == 0
