"""Personal data: plain identifiers, and disguised ones found through offset-preserving transducers."""

import re
import unicodedata
from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

KINDS = ("email", "ip", "card", "phone")

_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_IP = re.compile(r"(?<![0-9])[0-9]+(?:\.[0-9]+){3}")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_NOT_DIGIT = re.compile(r"[^0-9]")

# Letters of other scripts that look like Latin ones, and invisible characters.
CONFUSABLE = {
    "а": "a", "е": "e", "о": "o", "р": "p", "с": "c", "у": "y", "х": "x", "і": "i", "ј": "j", "ѕ": "s", "ԁ": "d", "һ": "h", "ԛ": "q", "ԝ": "w",
    "А": "A", "В": "B", "Е": "E", "К": "K", "М": "M", "Н": "H", "О": "O", "Р": "P", "С": "C", "Т": "T", "У": "Y", "Х": "X", "І": "I", "Ј": "J", "Ѕ": "S",
    "α": "a", "ε": "e", "ι": "i", "κ": "k", "ν": "v", "ο": "o", "ρ": "p", "τ": "t", "υ": "u", "χ": "x", "γ": "y",
    "Α": "A", "Β": "B", "Ε": "E", "Ζ": "Z", "Η": "H", "Ι": "I", "Κ": "K", "Μ": "M", "Ν": "N", "Ο": "O", "Ρ": "P", "Τ": "T", "Υ": "Y", "Χ": "X",
    "ı": "i", "ɑ": "a", "ɡ": "g", "ⅼ": "l", "․": ".", "‧": ".", "·": ".", "。": ".", "‐": "-", "‑": "-", "‒": "-", "–": "-", "−": "-",
}
INVISIBLE = "­᠎​‌‍‎‏⁠⁡⁢⁣⁤﻿"
DIGIT_WORDS = {
    "zero": "0", "one": "1", "two": "2", "three": "3", "four": "4",
    "five": "5", "six": "6", "seven": "7", "eight": "8", "nine": "9",
}
#: Last labels that make a bare "name at host dot label" an address.
TOP_LEVELS = frozenset("com net org edu gov mil int info biz name io co me tv app dev test example ai us uk eu de fr es it nl ca au in jp cn br ru ch at be se no pl".split())
#: Words for @ with the words for a dot that go with them when neither is bracketed.
SPELLED = {"at": "dot", "arroba": "punto", "arobase": "point"}


class _Fold(dict):
    """One character to one character or to none; what has no simple form stays."""

    def __missing__(self, code: int):
        char = chr(code)
        if char in INVISIBLE:
            out = None
        elif char in CONFUSABLE:
            out = CONFUSABLE[char]
        elif unicodedata.decimal(char, None) is not None:
            out = str(unicodedata.decimal(char))
        else:
            plain = unicodedata.normalize("NFKC", char) if code > 0xFF else char
            out = plain if len(plain) == 1 and plain.isascii() else char
        self[code] = out
        return out


_FOLD = _Fold()
_NUMBER = "|".join(DIGIT_WORDS)
_SPELLED_DIGIT = re.compile(rf"(?<![A-Za-z])(?:{_NUMBER})(?![A-Za-z])", re.I | re.A)
_SPELLED_RUN = re.compile(rf"(?<![A-Za-z])(?:{_NUMBER})(?:(?:[ \t,]+|-)(?:{_NUMBER}))*(?![A-Za-z])", re.I | re.A)
_PLUS = re.compile(r"(?<![A-Za-z])plus[ \t]+(?=[0-9])", re.I)
_LOOKALIKE = re.compile(r"(?<![A-Za-z0-9])(?=[OolI]*[0-9])[0-9OolI]*[OolI][0-9OolI]*(?![A-Za-z0-9])")
_LOOKS = str.maketrans("OolI", "0011")
_AT = re.compile(r"[ \t]*[\[({<][ \t]*(?:at|arroba|arobase|@)[ \t]*[\])}>][ \t]*", re.I)
_DOT = re.compile(r"[ \t]*[\[({<][ \t]*(?:dot|punto|punkt|point|\.)[ \t]*[\])}>][ \t]*", re.I)
_LABEL = r"[A-Za-z0-9-]+"
_BARE = [
    re.compile(rf"(?<=[A-Za-z0-9])([ \t]+{at}[ \t]+|@)({_LABEL}(?:(?:\.|[ \t]+{dot}[ \t]+){_LABEL})*?[ \t]+{dot}[ \t]+({_LABEL}))(?![A-Za-z0-9-])", re.I)
    for at, dot in SPELLED.items()
]
_BARE_DOT = {at: re.compile(rf"[ \t]+{dot}[ \t]+", re.I) for at, dot in SPELLED.items()}
_DIGIT_DOT = re.compile(r"(?<=[0-9])[ \t]+dot[ \t]+(?=[0-9])", re.I)
_SPACED_AT = re.compile(r"(?<=[A-Za-z0-9])[ \t]+@[ \t]+(?=[A-Za-z0-9])")
_HINT = re.compile(r"[\[({<][ \t]*(?:at|arroba|arobase|@|dot|punto|punkt|point|\.)[ \t]*[\])}>]", re.I)


def _emails(text: str) -> list[tuple[int, int]]:
    """Leftmost, non-overlapping: from each @ the local part is read leftwards, so runs stay linear."""
    found, free, at = [], 0, text.find("@")
    while at >= 0:
        begin = at
        while begin > free and text[begin - 1] in _LOCAL:
            begin -= 1
        domain = _DOMAIN.match(text, at + 1) if begin < at else None
        if domain:
            found.append((begin, domain.end()))
            free = domain.end()
        at = text.find("@", max(at + 1, free))
    return found


def _luhn(digits: str) -> bool:
    total = sum(map(int, digits[-1::-2]))
    return (total + sum(sum(divmod(2 * int(d), 10)) for d in digits[-2::-2])) % 10 == 0


def detect(text: str) -> dict[str, list[tuple[int, int]]]:
    """Spans of plain identifiers by kind, in order."""
    found: dict[str, list[tuple[int, int]]] = {kind: [] for kind in KINDS}
    if "@" in text:
        found["email"] = _emails(text)
    for m in _IP.finditer(text):
        if all(len(part.lstrip("0")) <= 3 and int(part.lstrip("0") or 0) <= 255 for part in m[0].split(".")):
            found["ip"].append(m.span())
    for m in _CARD.finditer(text):
        digits = _NOT_DIGIT.sub("", m[0])
        if 16 <= len(digits) <= 19 and _luhn(digits):
            found["card"].append(m.span())
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 8 <= len(_NOT_DIGIT.sub("", m[0])) <= 15:
                found["phone"].append(m.span())
    return found


class Aligned:
    """A text under rewriting that knows which source characters each of its characters stands for."""

    def __init__(self, source: str):
        self.text = source
        self.begin = np.arange(len(source), dtype=np.int64)
        self.end = self.begin + 1

    def fold(self) -> None:
        """Homoglyphs, compatibility forms and foreign digits to ASCII; invisible characters go."""
        kept = [k for k, c in enumerate(self.text) if c not in INVISIBLE] if any(c in self.text for c in INVISIBLE) else None
        self.text = self.text.translate(_FOLD)
        if kept is not None:
            self.begin, self.end = self.begin[kept], self.end[kept]

    def rewrite(self, edits: list[tuple[int, int, str]]) -> None:
        """Replace the spans, ordered and disjoint; each new character stands for its whole span."""
        if not edits:
            return
        text, begins, ends, at = [], [], [], 0
        for a, b, new in [*edits, (len(self.text), len(self.text), "")]:
            text += [self.text[at:a], new]
            begins.append(self.begin[at:a])
            ends.append(self.end[at:a])
            if new:
                if len(new) == b - a:
                    begins.append(self.begin[a:b])
                    ends.append(self.end[a:b])
                else:
                    begins.append(np.full(len(new), self.begin[a]))
                    ends.append(np.full(len(new), self.end[b - 1]))
            at = b
        self.text, self.begin, self.end = "".join(text), np.concatenate(begins), np.concatenate(ends)

    def source(self, a: int, b: int) -> tuple[int, int]:
        return int(self.begin[a]), int(self.end[b - 1])


def _folds(text: str) -> bool:
    """Whether `fold` changes the text; its distinct characters tell."""
    return not text.isascii() and any(_FOLD[ord(c)] != c for c in set(text) if c > "\x7f")


def normalised(text: str) -> Aligned:
    """`text` after the transducers for homoglyphs, digit words, look-alike digits, dots and ats.

    A transducer is left out only where a word or character that each of its matches holds is missing.
    """
    out = Aligned(text)
    if _folds(text):
        out.fold()
    lower = out.text.lower()
    if any(word in lower for word in DIGIT_WORDS):
        edits = []
        for run in _SPELLED_RUN.finditer(out.text):
            digits = list(_SPELLED_DIGIT.finditer(out.text, run.start(), run.end()))
            if len(digits) < 2:
                edits.append((*digits[0].span(), DIGIT_WORDS[digits[0][0].lower()]))
                continue
            for this, after in zip(digits, [*digits[1:], None]):
                # The blank between two spelled digits goes with the former.
                edits.append((this.start(), after.start() if after else this.end(), DIGIT_WORDS[this[0].lower()]))
        out.rewrite(edits)
    if "plus" in lower or not text.isascii():
        out.rewrite([(m.start(), m.end(), "+") for m in _PLUS.finditer(out.text)])
    out.rewrite([(*m.span(), m[0].translate(_LOOKS)) for m in _LOOKALIKE.finditer(out.text)])
    if _HINT.search(out.text):
        out.rewrite([(*m.span(), "@") for m in _AT.finditer(out.text)])
        out.rewrite([(*m.span(), ".") for m in _DOT.finditer(out.text)])
    if "dot" in lower:
        out.rewrite([(*m.span(), ".") for m in _DIGIT_DOT.finditer(out.text)])
    if "@" in out.text:
        out.rewrite([(*m.span(), "@") for m in _SPACED_AT.finditer(out.text)])
    for (at, dot), pattern in zip(SPELLED.items(), _BARE):
        # Some letters outside ASCII match i in any case; they have other lower-case forms.
        if dot not in lower and text.isascii():
            continue
        edits = []
        for m in pattern.finditer(out.text):
            if m[3].lower() in TOP_LEVELS:
                edits.append((*m.span(1), "@"))
                edits += [(m.start(2) + d.start(), m.start(2) + d.end(), ".") for d in _BARE_DOT[at].finditer(m[2])]
        out.rewrite(edits)
    return out


def _new(span: tuple[int, int], base: list[tuple[int, int]]) -> bool:
    """Whether a plain span of the kind doesn't hold this one already."""
    k = bisect_right(base, span[0], key=lambda s: s[0]) - 1
    return k < 0 or base[k][1] < span[1]


def private_spans(text: str) -> tuple[dict, dict]:
    """(plain, disguised) spans by kind, in code points of `text`."""
    plain = detect(text)
    more: dict[str, list[tuple[int, int]]] = {kind: [] for kind in KINDS}
    out = normalised(text)
    if out.text != text:
        for kind, spans in detect(out.text).items():
            mapped = (out.source(a, b) for a, b in spans)
            more[kind] = [s for s in mapped if _new(s, plain[kind])]
    return plain, more


_SPAN = pa.struct([("kind", pa.string()), ("begin", pa.int64()), ("end", pa.int64()), ("plain", pa.bool_())])
SPANS = "array<struct<kind:string,begin:bigint,end:bigint,plain:boolean>>"


def private_data(documents: DataFrame, identifier: str = "doc_id", text: str = "text") -> DataFrame:
    """identifier and `spans` (kind, begin, end, plain) of every row's personal data.

    Plain identifiers are matched in the text itself, leftmost and non-overlapping within a kind;
    a match that fails its kind's test is dropped. Disguised ones are matched in a normal form that
    transducers make: homoglyphs, invisible characters and foreign digits, spelled digits, letters
    for digits, bracketed or spelled at and dot. Each transducer keeps, for every character, the
    source characters it stands for, and spans are mapped back by that. Spans are code points, end
    exclusive, in order of kind (email, ip, card, phone) and begin.

    Texts are read whole, a row at a time; runs of any length take linear time. A null text is
    empty and has no spans; repeated rows are rows; further columns are not read.
    """
    rows = documents.select(F.col(identifier).alias("_id"), F.col(text).alias("_text"))
    schema = T.StructType([rows.schema["_id"], T.StructField("spans", T.StructType.fromDDL(f"s {SPANS}")["s"].dataType)])

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for value in batch.column(1).to_pylist():
                plain, more = private_spans(value or "")
                spans = [(kind, a, b, own) for kind in KINDS for own, by in ((True, plain), (False, more)) for a, b in by[kind]]
                spans.sort(key=lambda s: (KINDS.index(s[0]), s[1], s[2]))
                out.append([dict(zip(("kind", "begin", "end", "plain"), s)) for s in spans])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.list_(_SPAN))], names=["_id", "spans"])

    return rows.mapInArrow(find, schema).withColumnRenamed("_id", identifier)


ORACLE = None
