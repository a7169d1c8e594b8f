"""Operator 6: offset-preserving deobfuscation of personal data.

Plain identifiers (email, ip, card, phone) are found in the text as it stands. Then transducers
rewrite disguises into plain characters: look-alike letters and digits of other scripts,
invisible characters, digits spelled as words, and "at"/"dot" for @ and the full stop. Each
normalised character keeps the range of source characters it stands for, so what is detected in
the normalised text is reported at its place in the source. All offsets are code points.

Defined results: null and empty texts have no spans; the digest is then of the empty string.
Equal rows give equal results, one row each. Extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
import unicodedata
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mailfacts.llm.common import plain_words, text_or_empty

KINDS = ("email", "ip", "card", "phone")
Span = tuple[int, int, str]

_LOCAL = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# A number can only begin where a run of digits does, so later starts need not be tried.
_IP = re.compile(r"(?<![0-9])[0-9]+(?:\.[0-9]+){3}")
_CARD = re.compile(r"(?<![0-9])[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_NOT_DIGITS = bytes(c for c in range(256) if not 0x30 <= c <= 0x39)


def _digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def luhn(number: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(number)):
        d = int(c)
        total += d if i % 2 == 0 else d * 2 - 9 * (d > 4)
    return total % 10 == 0


def emails(text: str) -> list[Span]:
    """Leftmost matches in linear time: each @ with a domain is extended to the left, as far as the match
    before. What lies between two of them is looked at once."""
    out, taken = [], 0
    if "@" not in text:
        return out
    for m in _DOMAIN.finditer(text):
        start = m.start()
        while start > taken and text[start - 1] in _LOCAL:
            start -= 1
        if start < m.start():
            out.append((start, m.end(), "email"))
            taken = m.end()
    return out


def plain_spans(text: str) -> list[Span]:
    out = emails(text)
    digits = len(text.encode("utf-8", "surrogatepass").translate(None, _NOT_DIGITS))
    if digits >= 4 and "." in text:
        for m in _IP.finditer(text):
            parts = [p.lstrip("0") for p in m[0].split(".")]
            if all(len(p) <= 3 and int(p or 0) <= 255 for p in parts):
                out.append((m.start(), m.end(), "ip"))
    if digits >= 12:
        for m in _CARD.finditer(text):
            if len(m[0]) < 40 and 12 <= len(d := _digits(m[0])) <= 19 and luhn(d):
                out.append((m.start(), m.end(), "card"))
    if digits >= 9 and "+" in text:
        for m in _PHONE.finditer(text):
            if 9 <= len(_digits(m[0])) <= 15:
                out.append((m.start(), m.end(), "phone"))
    return sorted(out, key=lambda s: (s[0], KINDS.index(s[2]), s[1]))


# Letters of other scripts that look like a Latin one, and digit words.
LOOK_ALIKES = {
    "а": "a", "е": "e", "о": "o", "р": "p", "с": "c", "х": "x", "у": "y", "і": "i", "ј": "j",
    "ѕ": "s", "ԁ": "d", "һ": "h", "ԛ": "q", "ԝ": "w", "А": "A", "В": "B", "Е": "E", "К": "K",
    "М": "M", "Н": "H", "О": "O", "Р": "P", "С": "C", "Т": "T", "Х": "X", "ο": "o", "α": "a",
    "ν": "v", "ι": "i", "Α": "A", "Β": "B", "Ε": "E", "Ζ": "Z", "Η": "H", "Ι": "I", "Κ": "K",
    "Μ": "M", "Ν": "N", "Ο": "O", "Ρ": "P", "Τ": "T", "Υ": "Y", "Χ": "X",
}
DIGIT_WORDS = {
    "zero": "0", "oh": "0", "one": "1", "two": "2", "three": "3", "four": "4", "five": "5",
    "six": "6", "seven": "7", "eight": "8", "nine": "9",
}
INVISIBLE = "­​‌‍⁠﻿"


def _wide_forms() -> dict[str, str]:
    """Full-width forms and the digits of all scripts, by rule: what compatibility
    normalisation or the digit value makes one plain character."""
    out = {}
    for code in [*range(0xFF01, 0xFF5F), 0x2024, 0x3002, 0xFE52, 0xFE6B]:
        plain = unicodedata.normalize("NFKC", chr(code))
        out[chr(code)] = "." if code == 0x3002 else plain
    for code in range(0x80, 0x20000):
        if (value := unicodedata.decimal(chr(code), None)) is not None:
            out[chr(code)] = str(value)
    return out


CHARACTERS = LOOK_ALIKES | _wide_forms() | dict.fromkeys(INVISIBLE, "")
_ODD = re.compile("[" + re.escape("".join(CHARACTERS)) + "]")
_NUMBER = "|".join(sorted(DIGIT_WORDS, key=len, reverse=True))
# Spelled digits count in runs of three or more, digits among them; a "plus" may lead.
_SPELLED = re.compile(
    rf"\b(?:plus[\x20-]+)?(?:{_NUMBER}|[0-9])(?:[\x20,-]{{0,2}}(?:{_NUMBER}|[0-9])){{2,}}\b", re.I
)
_SPELLED_PART = re.compile(rf"{_NUMBER}|plus[\x20-]+|[0-9]|[\x20,-]", re.I)
_DIGIT_HINTS = frozenset(w.encode() for w in DIGIT_WORDS if w != "oh")
_BRACKETS = "([{<"
_BRACKETED = re.compile(
    r"\x20?[\(\[{<]\x20?(?P<a>at|dot|@|\.)\x20?[\)\]}>]\x20?|\x20?[-_*]{1,2}(?P<b>at|dot)[-_*]{1,2}\x20?", re.I
)
# Between digits the word alone is a dot.
_DOT_BETWEEN_DIGITS = re.compile(r"(?<=[0-9])\x20dot\x20(?=[0-9])", re.I)
# Long numbers in which letters stand for the digits they look like.
_LETTERED = re.compile(
    r"(?<![A-Za-z0-9])\+?[0-9OolI](?:[\x20().-]{0,2}[0-9OolI]){7,}(?![A-Za-z0-9])"
)
_LETTER_BY_DIGIT = re.compile(r"[0-9][OolI]|[OolI][0-9]")
_LETTER_DIGITS = {"O": "0", "o": "0", "l": "1", "I": "1"}
_LEAST_DIGITS = 6
# Bare words only inside a whole address: name at host dot suffix. Matched from the "at" on, and from there
# to the left, so that a chain of "dot" without an "at" is not tried from each of its words.
_AT_HOST = re.compile(r"(?:\x20at\x20|@)[A-Za-z0-9-]+(?:(?:\.|\x20dot\x20)[A-Za-z0-9-]+)+", re.I)
_NAME = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789_%+-")
# With ordinary dots only names that are no plain word count: those with a letter and a dot, digit or
# underscore. The suffix begins with a letter, so times and prices are none.
_NAMED = re.compile(
    r"(?<![A-Za-z0-9._%+-])(?=[A-Za-z%+-]*[0-9._])(?=[0-9._%+-]*[A-Za-z])[A-Za-z0-9_%+-]+(?:\.[A-Za-z0-9_%+-]+)*"
    r"(?P<at>\x20at\x20)(?:[A-Za-z0-9-]+\.)+[A-Za-z]",
    re.I,
)
_BARE_PART = re.compile(r"\x20(at|dot)\x20", re.I)
_SIGN = {"at": "@", "dot": ".", "@": "@", ".": "."}


def _name_before(text: str, end: int, least: int) -> int | None:
    """Where the longest chain of names begins that ends at ``end``, not before ``least``: names joined by
    dots or by the word. It must not follow an ordinary dot."""
    start, at = None, end
    while True:
        first = at
        while first > least and text[first - 1] in _NAME:
            first -= 1
        if first == at:
            return start
        if first == 0 or text[first - 1] not in _LOCAL:
            start = first
        if first > least and text[first - 1] == ".":
            at = first - 1
        elif first - 5 >= least and text[first - 5 : first].lower() == " dot ":
            at = first - 5
        else:
            return start


def bare_addresses(text: str) -> Iterator[tuple[int, int]]:
    """Ranges of addresses with a bare "at" or an @, leftmost first."""
    taken, m = 0, _AT_HOST.search(text)
    while m:
        start, last = _name_before(text, m.start(), taken), m
        # In "at at" the first may be a name too, or the end of one that begins further left.
        while follows := _AT_HOST.match(text, last.start() + 3):
            before = _name_before(text, follows.start(), taken)
            if before is not None and (start is None or before < start):
                start, m = before, follows
            last = follows
        if start is not None:
            yield start, m.end()
            taken = m.end()
        m = _AT_HOST.search(text, last.start() + 1 if start is None else taken)


class Normalised:
    """A text in which rewritten pieces remember the source range they stand for."""

    def __init__(self, text: str) -> None:
        self.text, self.start, self.end = text, list(range(len(text))), list(range(1, len(text) + 1))

    def rewrite(self, pieces: list[tuple[int, int, str]]) -> None:
        """Replace ranges (in order, disjoint) by at most one character each."""
        text, start, end, at = [], [], [], 0
        for a, b, plain in pieces:
            text.append(self.text[at:a])
            start += self.start[at:a]
            end += self.end[at:a]
            if plain:
                text.append(plain)
                start.append(self.start[a])
                end.append(self.end[b - 1])
            at = b
        text.append(self.text[at:])
        self.start, self.end = start + self.start[at:], end + self.end[at:]
        self.text = "".join(text)


def _is_odd(text: str) -> bool:
    """Whether a character stands for a plain one. Only a soft hyphen does below U+0100."""
    if text.isascii():
        return False
    try:
        text.encode("latin-1")
        return "\u00ad" in text
    except UnicodeEncodeError:
        return _ODD.search(text) is not None


def normalise(text: str) -> Normalised | None:
    """``None`` if the text holds no disguise."""
    out = Normalised(text) if _is_odd(text) else None
    if out:
        out.rewrite([(m.start(), m.end(), CHARACTERS[m[0]]) for m in _ODD.finditer(text)])
    plain = out.text if out else text
    present = frozenset(plain_words(plain))
    at_or_dot = b"at" in present or b"dot" in present
    bracketed = (at_or_dot or any(b in plain for b in _BRACKETS)) and _BRACKETED.search(plain)
    named = b"at" in present and _NAMED.search(plain)
    if b"dot" in present or bracketed or named:
        out = out or Normalised(text)
        signs_at = [(m.start(), m.end(), _SIGN[(m["a"] or m["b"]).lower()]) for m in _BRACKETED.finditer(out.text)]
        out.rewrite(signs_at)
        out.rewrite([(m.start(), m.end(), ".") for m in _DOT_BETWEEN_DIGITS.finditer(out.text)])
        pieces = []
        for first, last in bare_addresses(out.text):
            if " dot " in out.text[first:last].lower():
                for p in _BARE_PART.finditer(out.text, first, last):
                    pieces.append((p.start(), p.end(), _SIGN[p[1].lower()]))
        out.rewrite(pieces)
        out.rewrite([(*m.span("at"), "@") for m in _NAMED.finditer(out.text)])
    if not _DIGIT_HINTS.isdisjoint(present):
        out = out or Normalised(text)
        pieces = []
        for m in _SPELLED.finditer(out.text):
            if _DIGIT_HINTS.isdisjoint(plain_words(m[0])):
                continue
            for p in _SPELLED_PART.finditer(out.text, m.start(), m.end()):
                word = p[0].lower()
                sign = "+" if word[0] == "p" else DIGIT_WORDS.get(word, word if word.isdigit() else "")
                pieces.append((p.start(), p.end(), sign))
        out.rewrite(pieces)
    if _LETTER_BY_DIGIT.search(out.text if out else text):
        out = out or Normalised(text)
        pieces = []
        for m in _LETTERED.finditer(out.text):
            if len(_digits(m[0])) >= _LEAST_DIGITS:
                pieces += [
                    (i, i + 1, _LETTER_DIGITS[out.text[i]])
                    for i in range(m.start(), m.end())
                    if out.text[i] in _LETTER_DIGITS
                ]
        out.rewrite(pieces)
    return None if out is None or out.text == text else out


def added_spans(text: str, base: list[Span]) -> list[Span]:
    """Spans seen only after normalising, without those inside a plain span of their kind."""
    plain = normalise(text)
    if plain is None:
        return []
    out = []
    for a, b, kind in plain_spans(plain.text):
        start, end = plain.start[a], plain.end[b - 1]
        if not any(kind == k and s <= start and end <= e for s, e, k in base):
            out.append((start, end, kind))
    return out


def _joined(spans: list[Span]) -> str:
    ordered = sorted(spans, key=lambda s: (s[0], KINDS.index(s[2]), s[1]))
    return ",".join(f"{kind}:{start}:{end}" for start, end, kind in ordered)


SPANS = "array<struct<kind: string, start: int, end: int, added: boolean>>"


def find_personal_data(docs: DataFrame) -> DataFrame:
    """Each row's id and spans, plain ones first found, then those behind disguises."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns: dict[str, list] = {k: [] for k in ("base", "spans", "n_added", *KINDS)}
            found = []
            for text in batch.column("text").to_pylist():
                base = plain_spans(text)
                added = added_spans(text, base)
                kinds = [kind for _, _, kind in base]
                for kind in KINDS:
                    columns[kind].append(kinds.count(kind))
                columns["base"].append(hashlib.sha256(_joined(base).encode()).hexdigest())
                columns["spans"].append(_joined(base + added))
                columns["n_added"].append(len(added))
                found.append(
                    [{"kind": k, "start": a, "end": b, "added": False} for a, b, k in base]
                    + [{"kind": k, "start": a, "end": b, "added": True} for a, b, k in added]
                )
            spans = pa.array(found, pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("added", pa.bool_())])))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    *(pa.array(columns[k], pa.int64()) for k in KINDS),
                    pa.array(columns["base"], pa.string()),
                    pa.array(columns["spans"], pa.string()),
                    pa.array(columns["n_added"], pa.int64()),
                    spans,
                ],
                names=["doc_id", *(f"n_{k}" for k in KINDS), "base_sha256", "spans", "n_added", "found"],
            )

    schema = (
        "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, "
        f"spans string, n_added long, found {SPANS}"
    )
    rows = docs.select(docs["doc_id"].cast("long").alias("doc_id"), text_or_empty().alias("text"))
    return rows.mapInArrow(run, schema)


def mask(text: str | None) -> str | None:
    """``text`` with every span, plain or disguised, replaced by its kind in brackets.
    Overlapping spans are replaced together, under the kind of the first."""
    if not text:
        return text
    base = plain_spans(text)
    spans = sorted(base + added_spans(text, base), key=lambda s: (s[0], KINDS.index(s[2])))
    out, at = [], 0
    for i, (start, end, kind) in enumerate(spans):
        if start >= at or i == 0:
            out += [text[at:start], f"[{kind}]"]
            at = end
        else:
            at = max(at, end)
    return "".join(out) + text[at:]


def mask_personal_data(docs: DataFrame) -> DataFrame:
    """``docs`` with masked texts and, where there is such a column, their new ``n_chars``; all
    other columns as they are. Null texts stay null."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = batch.schema.get_field_index("text")
            texts = pa.array([mask(t) for t in batch.column(at).to_pylist()], pa.string())
            yield batch.set_column(at, batch.schema.field(at), texts)

    masked = docs.mapInArrow(run, docs.schema)
    if "n_chars" in docs.columns:
        length = F.when(F.col("text").isNull(), F.col("n_chars")).otherwise(F.char_length("text"))
        masked = masked.withColumn("n_chars", length.cast(docs.schema["n_chars"].dataType))
    return masked
