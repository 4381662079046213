"""Personal data in texts, also where it is disguised; spans are those of the source text.

Base kinds, leftmost and non-overlapping per kind, failing matches dropped without retries:
email, ip (parts at most 255), card (13 to 19 digits passing Luhn), phone (9 to 15 digits).
Each scanner starts only where a match can start, so none is slower than linear on long runs.

Added spans come from the normalised text. Transducers rewrite it piece by piece and keep for
each piece where it came from:

1. homoglyphs: a character whose compatibility form is one ASCII character, digits of any
   script, Cyrillic and Greek letters that look Latin; invisible characters vanish;
2. letters that look like digits inside a mostly numeric run (O, o, I, l, |);
3. spelled digits: two or more digit words of one of four languages in a row, with dot and
   a leading plus; lone digit words stay.

The base scanners run over the result, and one more for at/dot disguises of e-mail
addresses. A bare "at" counts only if the domain has a disguised dot,
or if what stands before it has a digit or a mark inside, as names of accounts have. What is found is
mapped back to source characters and added if no base span of its kind overlaps it.

Cases: null and empty text have no spans; texts of any length are read whole; repeated rows
are read alike; an empty table stays empty; only the named columns are read, so further
columns never clash.
"""

from __future__ import annotations

import re
import unicodedata
from bisect import bisect_right
from collections.abc import Iterator
from functools import cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from .common import pieces, text_of

KINDS = ("email", "ip", "card", "phone")

_LOCAL = frozenset("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+")
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")

Span = tuple[str, int, int]


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def _digits(s: str) -> str:
    return "".join(c for c in s if "0" <= c <= "9")


def _emails(text: str) -> Iterator[Span]:
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        m = _DOMAIN.match(text, at + 1) if start < at else None
        if m:
            yield "email", start, m.end()
            done = m.end()
        at = text.find("@", max(at + 1, done))


def base_spans(text: str) -> list[Span]:
    """The base spans, by kind as listed, then start."""
    out = list(_emails(text))
    out += [("ip", *m.span()) for m in _IP.finditer(text) if all(len(p := part.lstrip("0")) <= 3 and int(p or 0) <= 255 for part in m[0].split("."))]
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 13 and 13 <= len(d := _digits(m[0])) <= 19 and luhn(d):
            out.append(("card", *m.span()))
    out += [("phone", *m.span()) for m in _PHONE.finditer(text) if 9 <= len(_digits(m[0])) <= 15]
    return out


# Letters of other scripts that look like Latin ones.
LOOKALIKES = dict(zip("асеорхуіјѕԁһӏвкмнтАВСЕНІЈКМОРЅТХΑΒΕΗΙΚΜΝΟΡΤΥΧοαν", "aceopxyijsdhlbkmhtABCEHIJKMOPSTXABEHIKMNOPTYXoav", strict=True))
INVISIBLE = "­​‌‍⁠﻿"
# Digits spelled in English, German, French and Spanish.
DIGIT_WORDS = (
    "zero one two three four five six seven eight nine",
    "null eins zwei drei vier fünf sechs sieben acht neun",
    "zéro un deux trois quatre cinq six sept huit neuf",
    "cero uno dos tres cuatro cinco seis siete ocho nueve",
)
VALUE = {w: str(i) for line in DIGIT_WORDS for i, w in enumerate(line.split())}
DOT_WORDS = "dot|punkt|point|punto"

_D = "(?:" + "|".join(sorted(VALUE, key=len, reverse=True)) + ")"
_GAP = r"[ ,-]{1,3}"
_SPELLED = re.compile(rf"(?<!\w)(?:plus {{1,2}})?{_D}(?!\w)(?:{_GAP}(?:(?:{DOT_WORDS}){_GAP})?{_D}(?!\w))+", re.I)
_SPELLED_PART = re.compile(rf"plus {{1,2}}|{_GAP}(?:{DOT_WORDS}){_GAP}|{_GAP}|{_D}", re.I)
# Shapes of a card, a phone number and an address whose digits may be letters; at least so many must be digits.
_MOSTLY_DIGITS = (
    (re.compile(r"(?<![0-9A-Za-z])[0-9OoIl|](?:[ -]?[0-9OoIl|]){12,18}(?![0-9A-Za-z])"), 9),
    (re.compile(r"\+[0-9OoIl|][ ().0-9OoIl|-]{7,20}[0-9OoIl|](?![0-9A-Za-z])"), 6),
    (re.compile(r"(?<![\w.])[0-9OoIl]{1,3}(?:\.[0-9OoIl]{1,3}){3}(?![\w.])"), 4),
)
_AT = re.compile(r"\s?[\[({<]\s?(?:at|arroba|@)\s?[\])}>]\s?|\s{1,2}(?:at|arroba)\s{1,2}|\s{0,2}@\s{0,2}", re.I)
_DOT = rf"(?:\.|\s?[\[({{<]\s?(?:{DOT_WORDS}|\.)\s?[\])}}>]\s?|\s{{1,2}}(?:{DOT_WORDS})\s{{1,2}})"
_HIDDEN_DOMAIN = re.compile(rf"[A-Za-z0-9-]+(?:{_DOT}[A-Za-z0-9-]+)+", re.I)
_HIDDEN_IP = re.compile(rf"(?<![0-9.])[0-9]{{1,3}}(?:{_DOT}[0-9]{{1,3}}){{3}}(?![0-9])", re.I)
_MAY_HIDE_IP = re.compile(r"[0-9]\s?(?:[\[({<]\s?)?(?:\.|[dD][oO][tT]|[pP][uUoO][nNiI])")
_DOTTED_BEFORE = re.compile(rf"[A-Za-z0-9_%+-]+(?:\s?[\[({{<]\s?(?:{DOT_WORDS})\s?[\])}}>]\s?|\s{{1,2}}(?:{DOT_WORDS})\s{{1,2}})\Z", re.I)
_MAY_HIDE = re.compile(r"@|[\[({<]\s?(?:at|arroba)\s?[\])}>]|\s(?:at|arroba)\s[\s]?[A-Za-z0-9-]+(?:[^A-Za-z0-9-]{1,4}(?:dot|punkt|point|punto)|\.[A-Za-z0-9])", re.I)


@cache
def _plain_characters() -> dict[str, str]:
    """What each homoglyph stands for."""
    table = {**LOOKALIKES, **dict.fromkeys(INVISIBLE, "")}
    for code in range(0x80, 0x20000):
        c = chr(code)
        if c in table or c.isspace():
            continue
        if unicodedata.category(c) == "Nd":
            table[c] = str(unicodedata.decimal(c))
        elif len(plain := unicodedata.normalize("NFKC", c)) == 1 and "!" <= plain <= "~":
            table[c] = plain
    return table


def _plain_edits(text: str) -> list[tuple[int, int, str]]:
    table = _plain_characters()
    if text.isascii() or not (odd := table.keys() & set(text)):
        return []
    return [(*m.span(), table[m[0]]) for m in re.finditer("[" + "".join(odd) + "]", text)]


class Normalised:
    """A text after transducers, with the source stretch of each rewritten piece."""

    def __init__(self, text: str):
        self.text = text
        self.steps: list[tuple[list[int], list[int], list[int], list[int]]] = []

    def rewrite(self, edits: list[tuple[int, int, str]]) -> None:
        """Replace stretches given in order: start, end, new text."""
        if not edits:
            return
        out, at, size = [], 0, 0
        starts, ends, olds, old_ends = [], [], [], []
        for a, b, new in edits:
            out += [self.text[at:a], new]
            size += a - at
            starts.append(size)
            olds.append(a)
            old_ends.append(b)
            size += len(new)
            ends.append(size)
            at = b
        self.text = "".join([*out, self.text[at:]])
        self.steps.append((starts, ends, olds, old_ends))

    def source(self, start: int, end: int) -> tuple[int, int]:
        """The source stretch of a stretch of the normalised text that isn't empty."""
        for starts, ends, olds, old_ends in reversed(self.steps):
            start, end = self._back(start, starts, ends, olds, old_ends, False), self._back(end - 1, starts, ends, olds, old_ends, True)
        return start, end

    @staticmethod
    def _back(at: int, starts, ends, olds, old_ends, last: bool) -> int:
        """Of the character at a place: its source's first place, or with last the end of its source."""
        i = bisect_right(starts, at) - 1
        while i >= 0 and starts[i] == ends[i]:  # a piece that vanished holds no character
            if i == 0 or starts[i - 1] < starts[i] and ends[i - 1] <= at:
                break
            i -= 1
        if i < 0:
            return at + last
        if at < ends[i]:
            return old_ends[i] if last else olds[i]
        i = bisect_right(starts, at) - 1
        return old_ends[i] + at - ends[i] + last


def _spelled_edits(text: str) -> list[tuple[int, int, str]]:
    # A run of three words or more has one with gaps on both sides.
    if VALUE.keys().isdisjoint(text.lower().replace(",", " ").replace("-", " ").split()):
        return []
    edits = []
    for run in _SPELLED.finditer(text):
        for m in _SPELLED_PART.finditer(text, run.start(), run.end()):
            word = m[0].lower()
            if word in VALUE:
                edits.append((*m.span(), VALUE[word]))
            else:
                edits.append((*m.span(), "+" if word[0] == "p" and word.startswith("plus") else "." if word.strip(" ,-") else ""))
    return edits


def _hidden_emails(text: str) -> Iterator[Span]:
    done = 0
    for at in _AT.finditer(text):
        start = at.start()
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        m = _HIDDEN_DOMAIN.match(text, at.end()) if start < at.start() else None
        while m and (more := _DOTTED_BEFORE.search(text, max(done, start - 80), start)):
            start = more.start()
        plain = at[0].strip().lower() in ("at", "arroba") and not re.search(r"[^A-Za-z0-9.-]", m[0] if m else "")
        if m and (not plain or re.search(r"[0-9]|\w[._%+-]\w", text[start : at.start()])):
            yield "email", start, m.end()
            done = m.end()


def _hidden_addresses(text: str) -> Iterator[Span]:
    for m in _HIDDEN_IP.finditer(text):
        if all(int(p) <= 255 for p in re.findall(r"[0-9]+", m[0])):
            yield "ip", *m.span()


def added_spans(text: str, base: list[Span]) -> list[Span]:
    """Spans found in the normalised text only."""
    norm = Normalised(text)
    norm.rewrite(_plain_edits(text))
    odd: set[int] = set()
    for shape, least in _MOSTLY_DIGITS:
        for run in shape.finditer(norm.text):
            if sum("0" <= c <= "9" for c in run[0]) >= least:
                odd.update(i for i in range(*run.span()) if norm.text[i] in "OoIl|")
    norm.rewrite([(i, i + 1, "0" if norm.text[i] in "Oo" else "1") for i in sorted(odd)])
    norm.rewrite(_spelled_edits(norm.text))
    found = base_spans(norm.text) if norm.steps else []
    if norm.steps or _MAY_HIDE.search(text):
        found += list(_hidden_emails(norm.text))
    if _MAY_HIDE_IP.search(norm.text):
        found += list(_hidden_addresses(norm.text))
    taken = {k: sorted((a, b) for kind, a, b in base if kind == k) for k in KINDS}
    out = []
    for kind, a, b in found:
        a, b = norm.source(a, b)
        own = taken[kind]
        i = bisect_right(own, (a, b))
        if (i and own[i - 1][1] > a) or (i < len(own) and own[i][0] < b):
            continue
        own.insert(i, (a, b))
        out.append((kind, a, b))
    return out


def find_spans(text: str) -> list[tuple[str, int, int, bool]]:
    """All spans (kind, start, end, added), by kind as listed, then start."""
    base = base_spans(text)
    spans = [(*s, False) for s in base] + [(*s, True) for s in added_spans(text, base)]
    return sorted(spans, key=lambda s: (KINDS.index(s[0]), s[1]))


def mask(text: str, spans: list[tuple]) -> str:
    """The text with each stretch of overlapping spans replaced by the kind of its first."""
    out, at = [], 0
    for kind, a, b, *_ in sorted(spans, key=lambda s: (s[1], -s[2])):
        if a >= at:
            out += [text[at:a], f"[{kind.upper()}]"]
        at = max(at, b)
    return "".join([*out, text[at:]])


FOUND = T.ArrayType(T.StructType().add("kind", T.StringType()).add("start", T.IntegerType()).add("end", T.IntegerType()).add("added", T.BooleanType()))


def find_pii(df: DataFrame, text: str = "text", keep: list[str] | None = None, masked: bool = False) -> DataFrame:
    """The columns `keep` with found array<struct<kind, start, end, added>>; with masked also the text without the data."""
    keep = keep or []
    chosen = df.select(*keep, text_of(text).alias("_text"))
    schema = T.StructType([f for f in chosen.schema if f.name != "_text"]).add("found", FOUND)
    if masked:
        schema.add("masked", T.StringType())
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("added", pa.bool_())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, "_text"):
            texts = batch.column("_text").to_pylist()
            spans = [find_spans(t) for t in texts]
            out = [pa.array([[dict(zip(("kind", "start", "end", "added"), s, strict=True)) for s in x] for x in spans], kind)]
            if masked:
                out.append(pa.array(map(mask, texts, spans), pa.string()))
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in keep), *out], names=schema.names)

    return chosen.mapInArrow(run, schema)
