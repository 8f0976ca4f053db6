"""Personal data: plain identifiers and disguised ones, with source offsets."""

from __future__ import annotations

import hashlib
import re
import unicodedata
from bisect import bisect_right
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ferry.llm.common import shipped

KINDS = ("email", "ip", "card", "phone")

# --- detectors ----------------------------------------------------------------------
# Written so that a long run of one class is read once: a look-behind starts numbers at
# the run's start (a later start in the run can only fail alike), possessive repeats
# don't back up, and the part before an @ is found from the @ backwards.
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+")
_LOCAL_END = re.compile(r"[^A-Za-z0-9._%+-]")
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")


def emails(text: str) -> list[tuple[int, int]]:
    out, free, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > free and text[start - 1] in _LOCAL:
            start -= 1
        if start < at and (m := _DOMAIN.match(text, at + 1)):
            out.append((start, m.end()))
            free = m.end()
        else:
            free = max(free, at + 1)
        at = text.find("@", max(at + 1, free))
    return out


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        x = int(d) * (1 + i % 2)
        total += x - 9 * (x > 9)
    return total % 10 == 0


def _digits(text: str) -> str:
    return "".join(x for x in text if "0" <= x <= "9")


def identifiers(text: str) -> list[tuple[int, int, int]]:
    """(kind index, start, end) of the plain identifiers, by kind, then start."""
    out = [(0, a, b) for a, b in emails(text)] if "@" in text else []
    out += [(1, m.start(), m.end()) for m in _IP.finditer(text)
            if all(len(p := x.lstrip("0")) <= 3 and int(p or 0) <= 255 for x in m[0].split("."))]
    out += [(2, m.start(), m.end()) for m in _CARD.finditer(text)
            if m.end() - m.start() >= 16 and 16 <= len(d := _digits(m[0])) <= 19 and luhn(d)]
    if "+" in text:
        out += [(3, m.start(), m.end()) for m in _PHONE.finditer(text) if 8 <= len(_digits(m[0])) <= 15]
    return out


# --- transducers --------------------------------------------------------------------
# Characters that look like ASCII ones, and the names of digits.
HOMOGLYPHS = {
    "а": "a", "е": "e", "о": "o", "р": "p", "с": "c", "х": "x", "у": "y", "і": "i", "ј": "j", "ѕ": "s", "ԁ": "d", "һ": "h",
    "А": "A", "В": "B", "Е": "E", "К": "K", "М": "M", "Н": "H", "О": "O", "Р": "P", "С": "C", "Т": "T", "Х": "X",
    "ο": "o", "ν": "v", "ι": "i", "κ": "k", "ρ": "p", "α": "a", "Α": "A", "Β": "B", "Ε": "E", "Ι": "I", "Ο": "O",
    "\u2024": ".", "\u3002": ".", "\u2010": "-", "\u2011": "-", "\u2013": "-", "\u00a0": " ", "\u2009": " ", "\u202f": " ",
    "\ufe6b": "@", "\ufe62": "+", "\ufe52": ".",
}
HOMOGLYPHS |= {chr(c): str(unicodedata.decimal(chr(c))) for c in range(0x80, 0x110000) if unicodedata.category(chr(c)) == "Nd"}
HOMOGLYPHS |= {chr(0xFF00 + i): chr(0x20 + i) for i in range(1, 0x5F)}  # full-width forms
HIDDEN = "\u200b\u200c\u200d\u2060\ufeff\u00ad"
DIGITS = {"zero": "0", "oh": "0", "one": "1", "two": "2", "three": "3", "four": "4", "five": "5", "six": "6",
          "seven": "7", "eight": "8", "nine": "9"}
#: So many spelled digits in a row are a number, fewer are words.
LEAST_SPELLED = 4

_LOOKS = re.compile("[" + "".join(map(re.escape, HOMOGLYPHS)) + "]|[" + HIDDEN + "]")
_DIGIT = r"(?:%s)" % "|".join(DIGITS)
_SPELLED = re.compile(rf"(?i)(?:\bplus[\x20-]+)?\b{_DIGIT}(?:[\x20,-]{{1,2}}{_DIGIT}\b){{{LEAST_SPELLED - 1},}}")
_ONE_SPELLED = re.compile(rf"(?i){_DIGIT}|plus")
#: Letters that stand for digits between digits.
_LETTER_DIGIT = re.compile(r"(?<=[0-9])[OolI](?=[0-9])")
_OPEN, _SHUT = r"\x20?[(\[{<]\x20?", r"\x20?[)\]}>]\x20?"
_DOT = rf"(?:{_OPEN}(?:dot|\.){_SHUT}|[\x20_]dot[\x20_])"
_HOST = rf"(?=[a-z0-9-]{{1,63}}(?:{_DOT}|\.)[a-z])"
_AT = re.compile(rf"(?i)(?<=[a-z0-9])(?:{_OPEN}(?:at|@){_SHUT}|[\x20_]at[\x20_]{_HOST}|(?:\x20@\x20?|@\x20){_HOST})")
_DOTS = re.compile(rf"(?i)(?<=[a-z0-9]){_DOT}(?=[a-z0-9])")
_AT_OR_DOT = re.compile(r"(?i)[(\[{<]\x20?(?:at|dot|@|\.)\x20?[)\]}>]|[\x20_](?:at[\x20_][a-z0-9-]{1,63}\.|dot[\x20_])|\x20@|@\x20")


class Rewritten:
    """A text under rewriting, with the source span of each kept or replaced piece."""

    def __init__(self, text: str):
        self.text = text
        self.pieces = [(0, 0, len(text), False)]  # (start here, source start, source end, changed)

    def replace(self, spans: list[tuple[int, int, str]]) -> None:
        """Replace ``text[a:b]`` by the string for ascending, disjoint (a, b, string)."""
        out, pieces, here, done = [], [], 0, 0
        for a, b, new in [*spans, (len(self.text), len(self.text), None)]:
            for start, end, lo, hi, changed in self._cut(done, a):
                pieces.append((here + start - done, lo, hi, changed))
            out.append(self.text[done:a])
            here += a - done
            if new is not None:
                lo, hi = self.source(a, b)
                pieces.append((here, lo, hi, True))
                out.append(new)
                here += len(new)
            done = b
        self.text, self.pieces = "".join(out), pieces or [(0, 0, 0, False)]

    def _cut(self, a: int, b: int):
        """The pieces under ``text[a:b]``, plain ones cut to it."""
        if a >= b:
            return
        i = max(0, bisect_right(self.pieces, a, key=lambda p: p[0]) - 1)
        while i < len(self.pieces) and self.pieces[i][0] < b:
            start, lo, hi, changed = self.pieces[i]
            end = self.pieces[i + 1][0] if i + 1 < len(self.pieces) else len(self.text)
            x, y = max(a, start), min(b, end)
            if x < y:
                yield (x, y, lo, hi, True) if changed else (x, y, lo + x - start, lo + y - start, False)
            i += 1

    def source(self, a: int, b: int) -> tuple[int, int]:
        """The source span of ``text[a:b]``, a < b."""
        cut = list(self._cut(a, b))
        return cut[0][2], cut[-1][3]

    def changed(self, a: int, b: int) -> bool:
        """Whether a rewritten piece shows in ``text[a:b]`` or a hidden one was dropped in it."""
        cut = list(self._cut(a, b))
        return any(p[4] for p in cut) or any(x[3] != y[2] for x, y in zip(cut, cut[1:], strict=False))


def normalised(text: str) -> Rewritten | None:
    """The text with look-alikes, spelled digits and disguised signs made plain; None if
    it has none of them."""
    out = Rewritten(text)
    if looks := [(m.start(), m.end(), HOMOGLYPHS.get(m[0], "")) for m in _LOOKS.finditer(text)] if not text.isascii() else []:
        out.replace(looks)
    spelled = []
    for m in _SPELLED.finditer(out.text):
        number = "".join("+" if w.lower() == "plus" else DIGITS[w.lower()] for w in _ONE_SPELLED.findall(m[0]))
        spelled.append((m.start(), m.end(), number))
    if spelled:
        out.replace(spelled)
    if letters := [(m.start(), m.end(), "0" if m[0] in "Oo" else "1") for m in _LETTER_DIGIT.finditer(out.text)]:
        out.replace(letters)
    signs = False
    if _AT_OR_DOT.search(out.text):
        for pattern, sign in ((_AT, "@"), (_DOTS, ".")):
            if found := [(m.start(), m.end(), sign) for m in pattern.finditer(out.text)]:
                out.replace(found)
                signs = True
    return out if looks or spelled or letters or signs else None


def personal_spans(text: str) -> tuple[list[tuple[int, int, int]], list[tuple[int, int, int]]]:
    """(plain, all) spans of one text in code points: all adds the disguised identifiers."""
    plain = identifiers(text)
    every = set(plain)
    if (other := normalised(text)) is not None:
        every |= {(k, *other.source(a, b)) for k, a, b in identifiers(other.text) if other.changed(a, b)}
    return plain, sorted(every)


def personal_data(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans) for every row.

    Plain identifiers are the leftmost non-overlapping matches per kind; their counts and
    the digest of their ``kind:start:end`` list are the base. Transducers then make
    look-alike characters, spelled digits and disguised at and dot signs plain, the same
    detectors read the result, and each find that shows a rewritten piece is mapped back
    to source code points. ``spans`` lists both, by kind, then start.

    A null or empty text has none (the digest of an empty list). Each of repeated rows
    gives a row; columns beside id and text are ignored; an empty table gives none.
    """

    def told(spans: list[tuple[int, int, int]]) -> str:
        return ",".join(f"{KINDS[k]}:{a}:{b}" for k, a, b in spans)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts, digests, spans = [], [], []
            for text in batch.column(1):
                plain, every = personal_spans(text.as_py() or "")
                counts.append([sum(k == i for k, _, _ in plain) for i in range(4)])
                digests.append(hashlib.sha256(told(plain).encode()).hexdigest())
                spans.append(told(every))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array([c[i] for c in counts], pa.int64()) for i in range(4)),
                 pa.array(digests, pa.string()), pa.array(spans, pa.string())],
                names=["doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans"])

    return shipped(docs).select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(
        run, "doc_id bigint, n_email bigint, n_ip bigint, n_card bigint, n_phone bigint, base_sha256 string, spans string")
