"""Personal identifiers in texts: e-mail and IP addresses, card and phone
numbers, plain or disguised, as spans of the source.

Plain ones are found in the text as it stands, by the patterns below. For
disguised ones two transducers run over the text, one behind the other, and
keep for every character they write the source characters it stands for:

1. characters: letters and digits that only look like ASCII ones become these,
   invisible characters go;
2. words: runs of spelled digits become digits, ``(at)``, `` at ``, ``[dot]``,
   `` dot ``, ``[.]``, ``plus`` and the like become the signs they stand for.

The patterns are then looked for in what was written, and a match that holds a
rewritten character is mapped back to the source. Prose is not rewritten into
addresses: where ``at`` is a bare word, the domain needs a dot that is disguised
too, and a label behind a bare ``dot`` must be a known top-level domain.

Every text is read once in its partition, nothing is shuffled, and all patterns
take linear time.

Defined cases: a null text is empty; it and a text without identifiers give an
empty list. Rows with one id give one row each. Only the id and the text are
read. Offsets are code points, ends exclusive. A disguised span that lies
inside a plain one of its kind is not listed; a longer one is, beside it.
"""

from __future__ import annotations

import re
import unicodedata
from bisect import bisect_left
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Kinds in the order in which spans of one start are listed.
KINDS = ("email", "ip", "card", "phone")

# Letters of other scripts that look like the ASCII letter before
# the colon. Full-width, mathematical and other compatibility forms and digits
# of all scripts follow from Unicode's own tables.
LOOKALIKES = """
a:аα b:Ь c:сϲ d:ԁ e:еє g:ɡ h:һ i:іιı j:јϳ k:кκ l:ӏ m:м n:п o:оοσ p:рρ q:ԛ r:г s:ѕ t:т u:υ v:νѵ w:ԝѡ x:хχ y:уγ z:ᴢ
A:АΑ B:ВΒ C:СϹ E:ЕΕ H:НΗ I:ІΙ J:Ј K:КΚ M:МΜ N:Ν O:ОΟ P:РΡ S:Ѕ T:ТΤ X:ХΧ Y:ҮΥ Z:Ζ
-:‐‑‒–—−﹣ .:。‧∙
"""
# Characters without a width.
INVISIBLE = "­​‌‍⁠﻿"

# The digits 0 to 9 as words, in English, French, German, Spanish.
DIGIT_WORDS = (
    "zero|oh zéro null cero",
    "one un|une eins uno|una",
    "two deux zwei|zwo dos",
    "three trois drei tres",
    "four quatre vier cuatro",
    "five cinq fünf cinco",
    "six six sechs seis",
    "seven sept sieben siete",
    "eight huit acht ocho",
    "nine neuf neun nueve",
)
# Words for the signs, in the same languages.
AT_WORDS = "at|arobase|arroba|ät"
DOT_WORDS = "dot|point|punkt|punto"
PLUS_WORDS = "plus|más"
# Top-level domains that a bare "dot" may stand before.
TOP_LEVEL = frozenset(
    "com org net edu gov mil int info biz name io co ai app dev me tv us uk eu de fr es it ch nl be pl pt se no dk fi ie "
    "ru ua cn jp kr in br mx ar ca au nz za example test invalid local internal localhost".split()
)

_AT = re.compile(r"@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")

Span = tuple[int, int]


def luhn(digits: str) -> bool:
    """Whether the check digit of a card number holds."""
    odd = sum(map(int, digits[-1::-2]))
    return (odd + sum(sum(divmod(2 * int(d), 10)) for d in digits[-2::-2])) % 10 == 0


def _emails(text: str) -> Iterator[Span]:
    """The first ``@`` whose run of local characters is not empty and behind
    which a domain stands gives the next match; its run begins behind the
    match before at the earliest. Each run ends at its own ``@``, so all are
    walked once."""
    last = 0
    for m in _AT.finditer(text):
        start = m.start()
        while start > last and text[start - 1] in _LOCAL:
            start -= 1
        if start < m.start():
            yield start, m.end()
            last = m.end()


def _ips(text: str) -> Iterator[Span]:
    # a match begins where a run of digits does: the rest of the pattern does
    # not depend on where in the run it began
    for m in _IP.finditer(text):
        parts = [x.lstrip("0") for x in m[0].split(".")]
        if all(len(x) <= 3 and int(x or 0) <= 255 for x in parts):
            yield m.span()


def _is_card(match: str) -> bool:
    digits = match.replace(" ", "").replace("-", "")
    return 14 <= len(digits) <= 19 and luhn(digits)


def _cards(text: str) -> Iterator[Span]:
    for m in _CARD.finditer(text):
        if _is_card(m[0]):
            yield m.span()


def _phones(text: str) -> Iterator[Span]:
    for m in _PHONE.finditer(text):
        if 10 <= sum("0" <= c <= "9" for c in m[0]) <= 15:
            yield m.span()


FINDERS: dict[str, Callable[[str], Iterator[Span]]] = dict(zip(KINDS, (_emails, _ips, _cards, _phones), strict=True))


def _ascii_forms() -> dict[int, str | None]:
    """Code point -> the ASCII character that it looks like."""
    table: dict[int, str | None] = {}
    for code in range(128, 0x20000):
        char = chr(code)
        plain = unicodedata.normalize("NFKC", char)
        digit = unicodedata.digit(char, None)
        if len(plain) == 1 and "!" <= plain <= "~":
            table[code] = plain
        elif digit is not None:
            table[code] = str(digit)
        elif unicodedata.category(char) == "Zs":
            table[code] = " "
    for entry in LOOKALIKES.split():
        for char in entry[2:]:
            table[ord(char)] = entry[0]
    return table | dict.fromkeys(map(ord, INVISIBLE))


class Transducer:
    """Both transducers; built once per Python worker."""

    def __init__(self):
        self.forms = _ascii_forms()
        self.odd = frozenset(map(chr, self.forms))
        self.digit = {w: str(d) for d, words in enumerate(DIGIT_WORDS) for w in re.split(r"[ |]", words)}
        word = "|".join(sorted(self.digit, key=len, reverse=True))
        self.word = re.compile(word, re.IGNORECASE)
        opened, closed = r"[ \t]{0,3}[\[({<][ \t]{0,3}", r"[ \t]{0,3}[\])}>][ \t]{0,3}"
        gap = r"[ \t_-]{1,3}"
        self.signs = re.compile(
            rf"(?P<at>{opened}(?:{AT_WORDS}|@){closed})"
            rf"|(?P<dot>{opened}(?:{DOT_WORDS}|\.){closed})"
            rf"|(?P<bare_at>(?<=\w){gap}(?:{AT_WORDS}|@){gap}(?=\w))"
            rf"|(?P<bare_dot>(?<=\w)(?:{gap}(?:{DOT_WORDS}){gap}|[ \t]\.[ \t])(?=\w))"
            rf"|\b(?P<digits>(?:{word})(?:[ ,-]{{1,2}}(?:{word}))*+)\b"
            rf"|\b(?P<plus>(?:{PLUS_WORDS}){gap})(?=[0-9]|(?:{word})\b)"
            r"|(?<=[0-9])(?P<letters>[OolI]+)(?=[0-9])",
            re.IGNORECASE,
        )
        # what tells at little cost that the second transducer has nothing to do
        self.at_words, self.dot_words = set(AT_WORDS.split("|")), set(DOT_WORDS.split("|"))
        self.numbers = {**self.digit, **dict.fromkeys(PLUS_WORDS.split("|")), **dict.fromkeys(self.dot_words)}
        self.blank = str.maketrans(dict.fromkeys("[](){}<>.,;:!?@-+\"'/|#$%&*=_~`", " "))
        self.bracketed = re.compile(rf"[\[({{<][ \t]*(?:{AT_WORDS}|{DOT_WORDS}|@|\.)[ \t]*[\])}}>]", re.IGNORECASE)
        self.apart = re.compile(r"[ \t][@.][ \t]")
        self.between = re.compile(r"[0-9][OolI]+[0-9]")

    def _may_hold_signs(self, text: str) -> bool:
        """Whether the second transducer could write a sign or a digit that
        makes part of an identifier."""
        if self.between.search(text):
            return True
        words = text.lower().translate(self.blank).split()
        known = set(words)
        dotted = not known.isdisjoint(self.dot_words)
        if not known.isdisjoint(self.at_words) or "@" in text:
            if dotted or self.apart.search(text) or self.bracketed.search(text):
                return True
        if not known.isdisjoint(self.digit) or dotted or "[.]" in text or "(.)" in text or self.bracketed.search(text):
            # three numbers, spelled or not, or signs in a row
            row = 0
            for w in words:
                row = row + 1 if w in self.numbers or w[0] in "0123456789" else 0
                if row == 3:
                    return True
        return False

    def rewrite(self, text: str) -> Rewritten | None:
        """The text as both transducers write it; None where they change
        nothing."""
        out = Rewritten(text)
        if not text.isascii() and (odd := self.odd.intersection(text)):
            found = re.finditer("[" + re.escape("".join(sorted(odd))) + "]", text)
            out.replace((m.start(), m.end(), [(m.start(), m.end(), self.forms[ord(m[0])] or "", "")]) for m in found)
        if self._may_hold_signs(out.text):
            out.replace(self._signs(out.text))
        return out if out.changed else None

    def _signs(self, text: str) -> Iterator[tuple[int, int, list]]:
        for m in self.signs.finditer(text):
            a, b = m.span()
            if m["digits"]:
                yield a, b, [(w.start(), w.end(), self.digit[w[0].lower()], "") for w in self.word.finditer(text, a, b)]
            elif m["letters"]:
                if m[0].strip("OolI"):  # the pattern ignores case, the letters do not
                    continue
                yield a, b, [(i, i + 1, "0" if text[i] in "Oo" else "1", "") for i in range(a, b)]
            else:
                sign = "@" if m["at"] or m["bare_at"] else "+" if m["plus"] else "."
                yield a, b, [(a, b, sign, "bare" if m["bare_at"] or m["bare_dot"] else "")]


class Rewritten:
    """A text with, for each of its characters, the source span it stands for
    and whether it was rewritten."""

    def __init__(self, text: str):
        self.text, self.changed = text, False
        self.start = np.arange(len(text))
        self.end = self.start + 1
        self.new = np.zeros(len(text), bool)
        self.bare: list[int] = []  # places of signs written for bare words

    def replace(self, pieces: Iterator[tuple[int, int, list]]) -> None:
        """Write, for each piece (start, end, what stands there instead), the
        characters (start, end, character, note) in place of it."""
        chars: list[str] = []
        starts, ends, new = [], [], []
        at = size = 0
        for a, b, instead in pieces:
            chars.append(self.text[at:a])
            starts.append(self.start[at:a])
            ends.append(self.end[at:a])
            new.append(self.new[at:a])
            size += a - at
            written = [x for x in instead if x[2]]
            if any(x[3] for x in written):
                self.bare.append(size)
            chars.extend(x[2] for x in written)
            starts.append(np.array([self.start[x[0]] for x in written], np.int64))
            ends.append(np.array([self.end[x[1] - 1] for x in written], np.int64))
            new.append(np.ones(len(written), bool))
            size += len(written)
            at = b
            if not written and b < len(self.text):
                self.new[b] = True  # what stands behind a lost character is not as it was
        if not starts:
            return
        self.changed = True
        tail = [(self.start, starts), (self.end, ends), (self.new, new)]
        self.start, self.end, self.new = (np.concatenate([*parts, whole[at:]]) for whole, parts in tail)
        self.text = "".join([*chars, self.text[at:]])

    def source(self, a: int, b: int) -> Span:
        return int(self.start[a]), int(self.end[b - 1])

    def is_bare(self, i: int) -> bool:
        k = bisect_left(self.bare, i)
        return k < len(self.bare) and self.bare[k] == i


def _accepted_email(out: Rewritten, a: int, b: int) -> Span | None:
    """The span of an address without labels that only prose has put there;
    None if none is left."""
    text = out.text
    sign = text.index("@", a, b)
    while True:
        dot = text.rindex(".", a, b)
        if dot < sign:
            return None  # no dot left behind the sign
        if out.is_bare(dot) and text[dot + 1 : b].lower() not in TOP_LEVEL:
            b = dot
            if "." not in text[sign:b]:
                return None
            continue
        break
    if out.is_bare(sign):
        dots = [i for i in range(sign, b) if text[i] == "."]
        if text[dot + 1 : b].lower() not in TOP_LEVEL:
            return None
        # "us at example.com" is prose, "us @ example.com" is not
        word = bool(out.end[sign] - out.start[sign] > 3 or not out.new[sign])
        if word and not any(out.new[i] for i in dots):
            return None
    return (a, b) if out.new[a:b].any() else None


def _rewritten_cards(out: Rewritten) -> Iterator[Span]:
    """Cards in the rewritten text; where a number beside it spoils a match,
    the rewritten digits alone are tried."""
    for m in _CARD.finditer(out.text):
        a, b = m.span()
        if not out.new[a:b].any():
            continue
        if _is_card(m[0]):
            yield a, b
            continue
        new = np.flatnonzero(out.new[a:b])
        for part in np.split(new, np.flatnonzero(np.diff(new) > 2) + 1):
            i, j = a + int(part[0]), a + int(part[-1]) + 1
            if _is_card(out.text[i:j]):
                yield i, j


def disguised(transducer: Transducer, text: str) -> Iterator[tuple[str, int, int, str]]:
    """(kind, start, end, identifier) of what shows only in the rewritten text."""
    out = transducer.rewrite(text)
    if out is None:
        return
    for kind, find in FINDERS.items():
        for a, b in _rewritten_cards(out) if kind == "card" else find(out.text):
            if not out.new[a:b].any():
                continue
            if kind == "email":
                span = _accepted_email(out, a, b)
                if span is None:
                    continue
                a, b = span
            yield kind, *out.source(a, b), out.text[a:b]


_transducer: list[Transducer] = []


def spans_of(text: str) -> list[dict]:
    """All spans of a text, by start, then kind as listed, then end."""
    if not _transducer:
        _transducer.append(Transducer())
    rows = []
    plain: dict[str, list[Span]] = {}
    for kind, find in FINDERS.items():
        plain[kind] = list(find(text))
        rows += [{"kind": kind, "start": a, "end": b, "disguised": False, "value": text[a:b]} for a, b in plain[kind]]
    for kind, a, b, value in disguised(_transducer[0], text):
        k = bisect_left(plain[kind], (a + 1,)) - 1  # the last plain span that begins at a or before
        if k < 0 or plain[kind][k][1] < b:
            rows.append({"kind": kind, "start": a, "end": b, "disguised": True, "value": value})
    return sorted(rows, key=lambda r: (r["start"], KINDS.index(r["kind"]), r["end"]))


SPAN = "struct<kind:string,start:long,end:long,disguised:boolean,value:string>"
_SPAN = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("disguised", pa.bool_()), ("value", pa.string())])


def find_identifiers(docs: DataFrame) -> DataFrame:
    """Per row of ``docs`` (doc_id, text): spans, a list of kind, start, end,
    disguised and value (the identifier without its disguise)."""
    base = docs.select(F.col("doc_id"), F.col("text").cast("string").alias("text"))
    kind = base.schema["doc_id"].dataType.simpleString()

    def find(batches):
        for batch in batches:
            spans = pa.array([spans_of(t or "") for t in batch.column(1).to_pylist()], pa.list_(_SPAN))
            yield pa.RecordBatch.from_arrays([batch.column(0), spans], names=["doc_id", "spans"])

    return base.mapInArrow(find, f"doc_id {kind}, spans array<{SPAN}>")
