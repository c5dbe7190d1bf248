"""Personal data with offset-preserving deobfuscation (operator 2).

Base detection finds e-mail addresses, IPv4 addresses, payment cards and phone numbers in a
text as it is. Then a chain of transducers rewrites the text: homoglyphs and foreign digits to ASCII,
invisible signs to nothing, bracketed or spelled at and dot to their signs, spelled digits to
digits. Each output character keeps the source span it was read from, so what the
same detectors find in the rewritten text is mapped back to source offsets. A span is added if
a rewritten character is part of it and no base span of its kind covers it.

A text runs through a transducer only if it has what that transducer rewrites; whole texts
are searched, in time linear in their length.

Defined cases: NULL or empty texts have no spans; repeated rows are each searched; an empty table
gives no rows; ``find`` reads id and text only, ``redact`` passes all other columns on.
"""

from __future__ import annotations

import hashlib
import re
import unicodedata
from collections.abc import Callable, Iterator
from itertools import repeat

import pyarrow as pa
from pyspark.sql import DataFrame

from repweave.llm.common import batch, bounded_batches, column_index, relengthened, texts

KINDS = ("email", "ip", "card", "phone")

FOUND = ("doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string, "
         "n_added long")
FOUND_ARROW = pa.schema([("doc_id", pa.int64()), ("n_email", pa.int64()), ("n_ip", pa.int64()),
                         ("n_card", pa.int64()), ("n_phone", pa.int64()), ("base_sha256", pa.string()),
                         ("spans", pa.string()), ("n_added", pa.int64())])

Span = tuple[int, int]

_DIGIT = re.compile(r"[0-9]")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# a match ends where its last digits end, so the next one never starts inside digits
_IP = re.compile(r"(?<![0-9])[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = ord(d) - 48
        total += n if i % 2 == 0 else n * 2 - 9 * (n > 4)
    return total % 10 == 0


def emails(text: str) -> list[Span]:
    """Each @ with the local characters before it, back to the previous match, and a domain
    after it: the leftmost matches, found from the @ signs."""
    out, end, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > end and text[start - 1] in _LOCAL:
            start -= 1
        if start < at and (m := _DOMAIN.match(text, at + 1)):
            out.append((start, m.end()))
            end = m.end()
        at = text.find("@", at + 1)
    return out


def ips(text: str) -> list[Span]:
    return [m.span() for m in _IP.finditer(text)
            if all(len(p := x.lstrip("0")) <= 3 and int(p or 0) <= 255 for x in m.group().split("."))]


def cards(text: str) -> list[Span]:
    out = []
    for m in _CARD.finditer(text):
        digits = m.group().replace(" ", "").replace("-", "")
        if 16 <= len(digits) <= 19 and luhn(digits):
            out.append(m.span())
    return out


def phones(text: str) -> list[Span]:
    return [m.span() for m in _PHONE.finditer(text)
            if 8 <= len(_DIGIT.findall(m.group())) <= 15]


def base_spans(text: str) -> list[list[Span]]:
    """Spans by kind, in the order of KINDS."""
    digits = _DIGIT.search(text) is not None
    return [emails(text) if "@" in text else [], ips(text) if digits else [], cards(text) if digits else [],
            phones(text) if digits and "+" in text else []]


# Letters and signs that look like ASCII ones
HOMOGLYPHS = {
    "а": "a", "е": "e", "о": "o", "р": "p", "с": "c", "у": "y", "х": "x", "і": "i", "ј": "j", "ѕ": "s", "һ": "h",
    "ԁ": "d", "ԛ": "q", "ԝ": "w", "к": "k", "м": "m", "т": "t", "в": "b", "н": "h", "г": "r", "п": "n", "ո": "n",
    "А": "A", "В": "B", "Е": "E", "К": "K", "М": "M", "Н": "H", "О": "O", "Р": "P", "С": "C", "Т": "T", "У": "Y",
    "Х": "X", "І": "I", "Ј": "J", "Ѕ": "S", "З": "3", "α": "a", "ε": "e", "ι": "i", "κ": "k", "ν": "v", "ο": "o",
    "ρ": "p", "τ": "t", "υ": "u", "χ": "x", "γ": "y", "Α": "A", "Β": "B", "Ε": "E", "Ζ": "Z", "Η": "H", "Ι": "I",
    "Κ": "K", "Μ": "M", "Ν": "N", "Ο": "O", "Ρ": "P", "Τ": "T", "Υ": "Y", "Χ": "X", "ı": "i", "ɡ": "g", "ɑ": "a",
    "\u2010": "-", "\u2011": "-", "\u2012": "-", "\u2013": "-", "\u2014": "-", "\u2212": "-", "\ufe63": "-",
    "\u00b7": ".", "\u2022": ".", "\u2024": ".", "\u3002": ".", "\uff61": ".", "\ufe52": ".",
    "\ufe6b": "@", "\ufe62": "+", "\u00a0": " ", "\u2002": " ", "\u2003": " ", "\u2007": " ", "\u2009": " ",
    "\u202f": " ", "\u3000": " ",
}
#: Signs without width.
INVISIBLE = frozenset("\u00ad\u034f\u180e\u200b\u200c\u200d\u200e\u200f\u2060\u2061\u2062\u2063\u2064\ufe0f\ufeff")
_STRANGE = re.compile("[\u00a0\u00ad\u00b2\u00b3\u00b7\u00b9\u0131\u0250-\U0010ffff]")

# Number words of four languages
NUMBERS = {
    "zero": "0", "oh": "0", "one": "1", "two": "2", "three": "3", "four": "4", "five": "5", "six": "6", "seven": "7",
    "eight": "8", "nine": "9",
    "zéro": "0", "un": "1", "deux": "2", "trois": "3", "quatre": "4", "cinq": "5", "sept": "7", "huit": "8", "neuf": "9",
    "null": "0", "eins": "1", "zwei": "2", "drei": "3", "vier": "4", "fünf": "5", "sechs": "6", "sieben": "7", "acht": "8",
    "neun": "9",
    "cero": "0", "uno": "1", "dos": "2", "tres": "3", "cuatro": "4", "cinco": "5", "seis": "6", "siete": "7", "ocho": "8",
    "nueve": "9",
}
POINTS = ("dot", "point", "punkt", "punto")
JOINTS = {"plus": "+", "dash": "-", "hyphen": "-", "minus": "-", **{p: "." for p in POINTS}}
_SPOKEN = NUMBERS.keys() | JOINTS.keys() | {"double", "triple"}
_ONE = r"(?:" + "|".join(sorted(_SPOKEN, key=lambda w: (-len(w), w))) + r"|[0-9])"
_SPOKEN_RUN = re.compile(rf"(?<!\w){_ONE}(?:[\s,.()-]{{1,4}}{_ONE}(?!\w)){{3,}}", re.I)
_SPOKEN_WORD = re.compile(rf"{_ONE}(?!\w)", re.I)
# ASCII letters and digits stay, all else is a blank, as any sign may stand beside a run; so "fünf" is two pieces
_LETTER_RUNS = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or 48 <= b <= 57 else 32
                     for b in range(256))
# 1: a number word, by its first piece; 2: what else may be a member of a run. Three number words are in any run
_SPOKEN_FLAGS = {p: 2 for w in [*_SPOKEN, *"0123456789"] for p in w.encode().translate(_LETTER_RUNS).split()}
_SPOKEN_FLAGS |= {w.encode().translate(_LETTER_RUNS).split()[0]: 1 for w in NUMBERS}
_FLAGGED = re.compile(rb"\x01\x02*\x01\x02*\x01")

_OPEN, _CLOSE, _POINT = r"[\[({<]", r"[\])}>]", "|".join(POINTS)
_BRACKET_AT = re.compile(rf"\s{{0,3}}(?:{_OPEN}\s{{0,3}}(?:at|@|arroba)\s{{0,3}}{_CLOSE}|([_*-])at\1)\s{{0,3}}"
                         r"|&#0{0,4}64;|&#x0{0,4}40;|&commat;|%40", re.I)
_BRACKET_DOT = re.compile(rf"\s{{0,3}}(?:{_OPEN}\s{{0,3}}(?:{_POINT}|\.)\s{{0,3}}{_CLOSE}|([_*-])dot\1)\s{{0,3}}"
                          r"|&#0{0,4}46;|&#x0{0,4}2e;|&period;|%2e", re.I)
_SPOKEN_IP = re.compile(rf"(?<![0-9])[0-9]{{1,4}}(?:\s{{1,3}}(?:{_POINT})\s{{1,3}}[0-9]{{1,4}}){{3}}(?![0-9])", re.I)
# an address whose local part has a digit or sign in it may have a plain domain after a spoken at
_SPOKEN_AT_PLAIN = re.compile(
    r"(?<![\w.%+-])(?=[A-Za-z0-9]{1,64}[0-9._%+-])[A-Za-z0-9._%+-]{1,64}(\s{1,3}(?:at|arroba)\s{1,3})"
    r"(?:[A-Za-z0-9-]{1,63}\.){1,8}[A-Za-z]{2,24}(?!\w)", re.I)
# letters that look like digits, inside what is otherwise a number
_DIGIT_LIKE = re.compile(r"(?<![A-Za-z0-9])\+?[0-9OoIl|](?:[ ().-]{0,2}[0-9OoIl|]){6,40}(?![A-Za-z0-9])")
_AS_DIGIT = {"O": "0", "o": "0", "I": "1", "l": "1", "|": "1"}
_PART = r"[A-Za-z0-9_%+-]{1,64}"
_SPOKEN_MAIL = re.compile(
    rf"(?<![\w.%+-]){_PART}(?:(?:\.|\s{{1,3}}(?:{_POINT})\s{{1,3}}){_PART}){{0,8}}(?:\s{{1,3}}(?:at|arroba)\s{{1,3}}|@)"
    rf"[A-Za-z0-9-]{{1,63}}(?:(?:\.|\s{{1,3}}(?:{_POINT})\s{{1,3}})[A-Za-z0-9-]{{1,63}}){{0,8}}"
    rf"\s{{1,3}}(?:{_POINT})\s{{1,3}}[A-Za-z]{{2,24}}(?!\w)", re.I)
_SPOKEN_AT = re.compile(r"\s{1,3}(?:at|arroba)\s{1,3}", re.I)
_SPOKEN_DOT = re.compile(rf"\s{{1,3}}(?:{_POINT})\s{{1,3}}", re.I)
# conditions that the patterns of a transducer imply
_BEFORE_PLAIN = re.compile(r"\s(?:at|arroba)\s", re.I)
# (all forms begin with one of a few signs, so that the search is fast)
_DISGUISED = re.compile(
    rf"[\[({{<_*&%-](?:(?<={_OPEN})\s{{0,3}}(?:at|arroba|{_POINT}|[@.])\s{{0,3}}{_CLOSE}|(?<=([_*-]))(?:at|dot)\1"
    r"|(?<=&)(?:#0{0,4}(?:64|46);|#x0{0,4}(?:40|2e);|commat;|period;)|(?<=%)(?:40|2e))", re.I)
_BEFORE_SPOKEN = re.compile(rf"\s(?:{_POINT})\s", re.I)


class Tape:
    """A rewritten text; character i was read from the source span [start[i], end[i])."""

    def __init__(self, text: str, start: list[int], end: list[int], new: list[bool]):
        self.text, self.start, self.end, self.new = text, start, end, new

    @classmethod
    def of(cls, text: str) -> Tape:
        n = len(text)
        return cls(text, list(range(n)), list(range(1, n + 1)), [False] * n)

    def rewrite(self, edits: list[tuple[int, int, str]]) -> Tape:
        """Replace spans [a, b) of this tape, in order, by strings."""
        text, start, end, new, at = [], [], [], [], 0
        for a, b, out in [*edits, (len(self.text), len(self.text), "")]:
            text.append(self.text[at:a])
            start += self.start[at:a]
            end += self.end[at:a]
            new += self.new[at:a]
            if out:
                text.append(out)
                start += [self.start[a]] * len(out)
                end += [self.end[b - 1]] * len(out)
                new += [True] * len(out)
            at = b
        return Tape("".join(text), start, end, new)

    def source(self, a: int, b: int) -> Span:
        return self.start[a], self.end[b - 1]


def _plain(c: str) -> str | None:
    """The ASCII reading of a sign; None: it is read as it stands."""
    if c in INVISIBLE:
        return ""
    if c in HOMOGLYPHS:
        return HOMOGLYPHS[c]
    if (d := unicodedata.digit(c, None)) is not None:
        return str(d)
    k = unicodedata.normalize("NFKC", c)
    return k if len(k) == 1 and k.isascii() and k != c else None


def homoglyphs(text: str) -> list[tuple[int, int, str]]:
    return [(m.start(), m.end(), out) for m in _STRANGE.finditer(text) if (out := _plain(m.group())) is not None]


def _apart(edits: list[tuple[int, int, str]]) -> list[tuple[int, int, str]]:
    """The edits in order, without those that begin inside an earlier one."""
    out: list[tuple[int, int, str]] = []
    for e in sorted(edits):
        if not out or e[0] >= out[-1][1]:
            out.append(e)
    return out


def disguises(text: str) -> list[tuple[int, int, str]]:
    edits = [(*m.span(), "@") for m in _BRACKET_AT.finditer(text)]
    return _apart(edits + [(*m.span(), ".") for m in _BRACKET_DOT.finditer(text)])


def digit_letters(text: str) -> list[tuple[int, int, str]]:
    edits = []
    for m in _DIGIT_LIKE.finditer(text):
        letters = [i for i in range(*m.span()) if text[i] in _AS_DIGIT]
        if letters and len(_DIGIT.findall(m.group())) >= 5 and len(_DIGIT.findall(m.group())) > 2 * len(letters):
            edits += [(i, i + 1, _AS_DIGIT[text[i]]) for i in letters]
    return edits


def spoken_mail(text: str) -> list[tuple[int, int, str]]:
    edits = []
    for m in _SPOKEN_MAIL.finditer(text):
        edits += [(*x.span(), "@") for x in _SPOKEN_AT.finditer(text, *m.span())]
        edits += [(*x.span(), ".") for x in _SPOKEN_DOT.finditer(text, *m.span())]
    for m in _SPOKEN_IP.finditer(text):
        edits += [(*x.span(), ".") for x in _SPOKEN_DOT.finditer(text, *m.span())]
    return _apart(edits)


def spoken_at(text: str) -> list[tuple[int, int, str]]:
    return [(*m.span(1), "@") for m in _SPOKEN_AT_PLAIN.finditer(text)]


def spelled_digits(text: str) -> list[tuple[int, int, str]]:
    """Runs of at least four spoken digits and joints, not all of one digit: one edit per
    digit; the gaps between go too."""
    edits = []
    for m in _SPOKEN_RUN.finditer(text):
        words = list(_SPOKEN_WORD.finditer(text, *m.span()))
        spoken = [NUMBERS[w] for x in words if (w := x.group().lower()) in NUMBERS]
        if len(spoken) < 3 or len(set(spoken)) < 2:  # one word again and again is no number
            continue
        at, times = m.start(), 1
        for x in words:
            w = x.group().lower()
            if w in ("double", "triple"):
                times = 2 if w == "double" else 3
                continue
            out = NUMBERS.get(w) or JOINTS.get(w) or w
            edits.append((at, x.end(), out * times))
            at, times = x.end(), 1
    return edits


def transduce(text: str) -> Tape | None:
    """The text through all transducers; None if none of them has anything to rewrite."""
    tape, changed = None, False

    def step(edits_of: Callable[[str], list[tuple[int, int, str]]]) -> None:
        nonlocal tape, changed
        if edits := edits_of(text if tape is None else tape.text):
            tape = (tape or Tape.of(text)).rewrite(edits)
            changed = True

    if not text.isascii() and _STRANGE.search(text):
        step(homoglyphs)
    now = text if tape is None else tape.text
    low = now.lower()
    if _DISGUISED.search(now):
        step(disguises)
    if _BEFORE_SPOKEN.search(tape.text if tape else now):
        step(spoken_mail)
    now = text if tape is None else tape.text
    if _BEFORE_PLAIN.search(now):
        step(spoken_at)
    if _DIGIT.search(now):
        step(digit_letters)
    if changed:
        low = tape.text.lower()
    if not low.isascii():
        low = low.replace("ſ", "s").replace("i̇", "i")  # as the pattern reads them
    flags = bytes(map(_SPOKEN_FLAGS.get, low.encode().translate(_LETTER_RUNS).split(), repeat(0)))
    if _FLAGGED.search(flags):
        step(spelled_digits)
    return tape if changed else None


_SPOKEN_NUMBER = re.compile(r"(?<![0-9+])[0-9]{7,15}(?![0-9])")


def added_spans(text: str, base: list[list[Span]]) -> list[list[Span]]:
    """Source spans of what only the rewritten text shows, by kind."""
    tape = transduce(text)
    if tape is None:
        return [[] for _ in KINDS]
    found = base_spans(tape.text)
    # a number spoken digit by digit is a phone number without its plus sign, too
    taken = [s for k in (1, 2, 3) for s in found[k]]
    for m in _SPOKEN_NUMBER.finditer(tape.text):
        a, b = m.span()
        if all(tape.new[a:b]) and sum(e - s > 1 for s, e in zip(tape.start[a:b], tape.end[a:b])) >= 3 \
                and not any(x < b and a < y for x, y in taken):
            found[3].append((a, b))
    out = []
    for spans, have in zip(found, base):
        kept = set()
        for a, b in spans:
            if any(tape.new[a:b]) or tape.source(a, b)[1] - tape.source(a, b)[0] != b - a:
                s, e = tape.source(a, b)
                if not any(x <= s and e <= y for x, y in have):
                    kept.add((s, e))
        out.append(sorted(kept))
    return out


def written(spans: list[list[Span]]) -> str:
    """kind:start:end by kind, then start, comma-joined."""
    return ",".join(f"{k}:{a}:{b}" for k, many in zip(KINDS, spans) for a, b in many)


def find(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document the counts and digest of base spans, and all spans."""
    bounded_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rb in batches:
            columns: list[list] = [[] for _ in range(7)]
            for text in texts(rb.column(1)):
                base = base_spans(text)
                more = added_spans(text, base)
                every = [sorted({*b, *m}) for b, m in zip(base, more)]
                row = [*map(len, base), hashlib.sha256(written(base).encode()).hexdigest(), written(every),
                       sum(map(len, every)) - sum(map(len, base))]
                for c, v in zip(columns, row, strict=True):
                    c.append(v)
            yield batch(FOUND_ARROW, [rb.column(0), *columns])

    return docs.select(docs[id_col].cast("long"), docs[text_col].cast("string")).mapInArrow(run, FOUND)


def redacted(text: str) -> str:
    """The text with every span replaced by its kind in brackets; spans that overlap are
    replaced together, named after the first."""
    base = base_spans(text)
    spans = sorted((a, b, k) for k, x, y in zip(KINDS, base, added_spans(text, base)) for a, b in {*x, *y})
    out, at, i = [], 0, 0
    while i < len(spans):
        a, b, kind = spans[i]
        i += 1
        while i < len(spans) and spans[i][0] < b:
            b = max(b, spans[i][1])
            i += 1
        out += [text[at:a], f"[{kind.upper()}]"]
        at = b
    return "".join([*out, text[at:]])


def redact(docs: DataFrame, text_col: str = "text", chars_col: str | None = None) -> DataFrame:
    """The documents with personal data replaced; ``chars_col`` gets the new length."""
    bounded_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rb in batches:
            values = rb.column(column_index(rb.schema, text_col)).to_pylist()
            new = [v if v is None else redacted(v) for v in values]
            yield relengthened(rb, text_col, chars_col, {i: n for i, (n, v) in enumerate(zip(new, values)) if n != v})

    return docs.mapInArrow(run, docs.schema)
