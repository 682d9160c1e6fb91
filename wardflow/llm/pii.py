"""Personal data: plain and disguised identifiers, found with offsets into the source text.

Transducers rewrite a disguised text one after the other (look-alike letters, full-width forms and invisible
characters; then spelled digits; then "at", "dot" and "plus" in brackets or words, in four languages) into plain
characters.  Each keeps, for every character written, where it came from, and the maps are composed, so that disguises
within disguises lead back to the source.  The same detectors run on the plain and on the rewritten text; spans of the second are mapped
back to the source and added where they touch no span of their kind.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import column, per_text, tune

KINDS = ("email", "ip", "card", "phone")
Span = tuple[int, int]

# Possessive and anchored forms: same matches as the plain patterns, linear time on long runs.
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+")
_IP = re.compile(r"[0-9](?<![0-9]{2})[0-9]*+(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_LUHN = (0, 2, 4, 6, 8, 1, 3, 5, 7, 9)


def emails(text: str) -> list[Span]:
    out, done, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        found = _DOMAIN.match(text, at + 1) if start < at else None
        if found:
            out.append((start, found.end()))
            done = found.end()
        at = text.find("@", max(done, at + 1))
    return out


def ips(text: str) -> list[Span]:
    # A part of more than three digits, leading zeros aside, is over 255.
    small = lambda part: len(part.lstrip("0")) <= 3 and int(part.lstrip("0") or 0) <= 255
    return [m.span() for m in _IP.finditer(text) if all(map(small, m[0].split(".")))]


def cards(text: str) -> list[Span]:
    out = []
    for m in _CARD.finditer(text):
        digits = [ord(c) - 48 for c in m[0] if c >= "0"]
        if 16 <= len(digits) <= 19 and (sum(digits[-1::-2]) + sum(_LUHN[d] for d in digits[-2::-2])) % 10 == 0:
            out.append(m.span())
    return out


def phones(text: str) -> list[Span]:
    return [m.span() for m in _PHONE.finditer(text) if 8 <= sum("0" <= c <= "9" for c in m[0]) <= 15] if "+" in text else []


def detect(text: str) -> dict[str, list[Span]]:
    """Leftmost non-overlapping spans of each kind, in code points."""
    return {"email": emails(text), "ip": ips(text), "card": cards(text), "phone": phones(text)}


# Look-alike letters of other scripts (fixed values).
HOMOGLYPHS = {
    "А": "A", "В": "B", "Е": "E", "К": "K", "М": "M", "Н": "H", "О": "O", "Р": "P", "С": "C", "Т": "T", "Х": "X", "У": "Y", "І": "I", "Ј": "J", "Ѕ": "S",
    "а": "a", "е": "e", "о": "o", "р": "p", "с": "c", "у": "y", "х": "x", "і": "i", "ј": "j", "ѕ": "s", "ԁ": "d", "һ": "h", "ԛ": "q", "ԝ": "w",
    "Α": "A", "Β": "B", "Ε": "E", "Ζ": "Z", "Η": "H", "Ι": "I", "Κ": "K", "Μ": "M", "Ν": "N", "Ο": "O", "Ρ": "P", "Τ": "T", "Υ": "Y", "Χ": "X", "ο": "o", "ν": "v", "ı": "i",
    "․": ".", "。": ".", "‐": "-", "‑": "-", "–": "-", "﹫": "@",
}
# Digit words, and the words for a plus, an at sign and a dot, in English, German, French and Spanish (fixed values).
DIGIT_WORDS = {
    "zero": "0", "oh": "0", "one": "1", "two": "2", "three": "3", "four": "4", "five": "5", "six": "6", "seven": "7", "eight": "8", "nine": "9",
    "null": "0", "eins": "1", "zwei": "2", "zwo": "2", "drei": "3", "vier": "4", "fünf": "5", "sechs": "6", "sieben": "7", "acht": "8", "neun": "9",
    "zéro": "0", "un": "1", "deux": "2", "trois": "3", "quatre": "4", "cinq": "5", "sept": "7", "huit": "8", "neuf": "9",
    "cero": "0", "uno": "1", "dos": "2", "tres": "3", "cuatro": "4", "cinco": "5", "seis": "6", "siete": "7", "ocho": "8", "nueve": "9",
}
PLUS_WORDS = ("plus", "más")
AT_WORDS = ("at", "ät", "arobase", "arroba")
DOT_WORDS = ("dot", "punkt", "point", "punto")

_INVISIBLE = "­​-‏⁠﻿"
_LETTER = r"[^\W\d_]"
_WORD, _PLUS, _AT, _DOT = ("|".join(sorted(words, key=len, reverse=True)) for words in (DIGIT_WORDS, PLUS_WORDS, AT_WORDS, DOT_WORDS))
_GLYPH_STEP = re.compile(rf"[{''.join(map(re.escape, HOMOGLYPHS))}！-～{_INVISIBLE}]")
# One digit word may stand in any prose; three in a row spell a number.
_SPELLED_STEP = re.compile(rf"(?<!{_LETTER})(?:{_WORD})(?:[ ,-]{{1,2}}(?:{_WORD})){{2,}}(?!{_LETTER})", re.IGNORECASE)
_SIGN_STEP = re.compile(
    rf"(?P<plus>(?<!{_LETTER})(?:{_PLUS})[ ](?=\(?[0-9]))"
    rf"|(?P<at>[ ]?[\[({{<][ ]?(?:{_AT}|@)[ ]?[\])}}>][ ]?|(?<=[A-Za-z0-9_%+-])[ ](?:{_AT})[ ](?=[A-Za-z0-9-]+(?:[ ]?[\[({{]?(?:{_DOT})[\])}}]?[ ]?|[ ](?:{_DOT})[ ])[A-Za-z0-9-])"
    rf"|(?<=[A-Za-z0-9_%+-])[ ](?:arobase|arroba)[ ](?=[A-Za-z0-9-]))"
    rf"|(?P<dot>[ ]?[\[({{<][ ]?(?:{_DOT}|\.)[ ]?[\])}}>][ ]?|(?<=[A-Za-z0-9])[ ](?:{_DOT})[ ](?=[A-Za-z0-9]))",
    re.IGNORECASE,
)
_DIGIT = re.compile(_WORD, re.IGNORECASE)
_SIGNS = {"plus": "+", "at": "@", "dot": "."}
Piece = tuple[str, int, int]


def _glyph(m: re.Match) -> Iterator[Piece]:
    """A look-alike or full-width character as the plain one, an invisible one as nothing."""
    c = m[0]
    if plain := HOMOGLYPHS.get(c) or (chr(ord(c) - 0xFEE0) if "！" <= c <= "～" else ""):
        yield plain, *m.span()


def _spelled(m: re.Match) -> Iterator[Piece]:
    """Digit words as digits, each from its own word."""
    for d in _DIGIT.finditer(m.string, *m.span()):
        yield DIGIT_WORDS[d[0].lower().replace("ſ", "s")], *d.span()


def _sign(m: re.Match) -> Iterator[Piece]:
    yield _SIGNS[m.lastgroup], *m.span()


# Transducers, each working on what the one before has written: characters, then digit words, then signs.
STEPS = ((_GLYPH_STEP, _glyph), (_SPELLED_STEP, _spelled), (_SIGN_STEP, _sign))


class Mapped:
    """A text, and for each of its characters the start and end of its source."""

    def __init__(self, text: str, starts: np.ndarray, ends: np.ndarray) -> None:
        self.text, self.starts, self.ends = text, starts, ends

    def rewritten(self, step: re.Pattern, pieces) -> Mapped:
        """The output of a transducer on this text, its offsets composed with those that led here."""
        parts, starts, ends, done = [], [], [], 0
        for m in step.finditer(self.text):
            parts.append(self.text[done : m.start()])
            starts.append(self.starts[done : m.start()])
            ends.append(self.ends[done : m.start()])
            for new, start, end in pieces(m):
                parts.append(new)
                starts.append(np.full(len(new), self.starts[start]))
                ends.append(np.full(len(new), self.ends[end - 1]))
            done = m.end()
        if not done:
            return self
        parts.append(self.text[done:])
        return Mapped("".join(parts), np.concatenate([*starts, self.starts[done:]]), np.concatenate([*ends, self.ends[done:]]))


def disguised(text: str) -> bool:
    """Whether a transducer would change the text: if the first does not, each of the others sees it as it is."""
    low = text.lower().replace("ſ", "s")
    return (
        not text.isascii() and _GLYPH_STEP.search(text) is not None
        or _SPELLED_STEP.search(text) is not None
        or any(word in low for word in _HINTS) and _SIGN_STEP.search(text) is not None
        or any(c in text for c in "[({<") and _SIGN_STEP.search(text) is not None
    )


# Every sign that stands in words has one of these around it.
_HINTS = tuple(f" {word} " for word in (*AT_WORDS, *DOT_WORDS)) + tuple(f"{word} " for word in PLUS_WORDS)


def transduce(text: str) -> Mapped:
    """The rewritten text with the source span of every character."""
    out = Mapped(text, np.arange(len(text)), np.arange(1, len(text) + 1))
    for step, pieces in STEPS:
        out = out.rewritten(step, pieces)
    return out


def find(text: str | None) -> tuple[dict[str, list[Span]], dict[str, list[Span]]]:
    """Base spans and all spans, both by kind and in order."""
    text = text or ""
    base = detect(text)
    if not disguised(text):
        return base, base
    plain = transduce(text)
    every = {}
    for kind, spans in detect(plain.text).items():
        mapped = dict.fromkeys((int(plain.starts[s]), int(plain.ends[e - 1])) for s, e in spans)
        taken = base[kind]
        # Base spans are in order and apart, so the first that ends behind a span's start tells whether they meet.
        stops = [e for _, e in taken]
        free = [m for m in mapped if (i := bisect_right(stops, m[0])) == len(taken) or taken[i][0] >= m[1]]
        every[kind] = sorted(taken + free)
    return base, every


def said(spans: dict[str, list[Span]]) -> str:
    return ",".join(f"{kind}:{s}:{e}" for kind in KINDS for s, e in spans[kind])


def find_personal_data(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: ``doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans``.

    The counts and the digest are of the plain (base) spans; ``spans`` lists plain and disguised ones as
    ``kind:start:end`` in code points, end exclusive.  Null and empty texts have none (empty string and its digest).
    Repeated rows and null ids each keep their row; only the two columns named are read.
    """
    tune(df.sparkSession)

    def start():
        def one(text: str | None) -> tuple:
            base, every = find(text)
            return *(len(base[kind]) for kind in KINDS), hashlib.sha256(said(base).encode()).hexdigest(), said(every)

        return one

    shape = "n_email bigint, n_ip bigint, n_card bigint, n_phone bigint, base_sha256 string, spans string"
    return df.select(column(id_col).cast("bigint").alias("doc_id"), per_text(start, shape, column(text_col)).alias("r")).select("doc_id", "r.*")


def mask(text: str | None) -> str | None:
    """The text with every span replaced by its kind in brackets; overlapping spans become one, named by the first."""
    if text is None:
        return None
    spans = sorted((s, e, kind) for kind, found in find(text)[1].items() for s, e in found)
    out, done, i = [], 0, 0
    while i < len(spans):
        start, end, kind = spans[i]
        i += 1
        while i < len(spans) and spans[i][0] < end:
            end = max(end, spans[i][1])
            i += 1
        out += [text[done:start], f"[{kind.upper()}]"]
        done = end
    return "".join(out) + text[done:]


def mask_personal_data(df: DataFrame, text_col: str = "text") -> DataFrame:
    """``df`` with personal data in ``text_col`` masked; null stays null, other columns and all rows stay."""
    tune(df.sparkSession)

    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield pd.Series([mask(text) for text in batch], dtype=object)

    return df.withColumn(text_col, F.pandas_udf(run, "string")(column(text_col)))
