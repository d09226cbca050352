"""Personal data in texts, plain and disguised, with offsets in the source text.

A text passes three small transducers: look-alike characters become the ASCII ones they stand for
(and invisible ones vanish), ``at`` and ``dot`` disguises become ``@`` and ``.``, and spelled digits
become digits. Each rewrites spans of its input and keeps, for every character of its output, the
span of the source it came from. Identifiers found in the output are mapped back to the source.
"""

from __future__ import annotations

import re
import unicodedata
from bisect import bisect_right
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabwright.llm.common import slices, with_field
from tabwright.llm.encode import keep_only

KINDS = ("email", "ip", "card", "phone")

#: The patterns of plain identifiers. An e-mail address begins at its run of local
#: characters, an IP address at a run of digits; that keeps the search linear in the text.
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
LOCAL_END = re.compile(r"[A-Za-z0-9._%+-]*")
IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
NOT_DIGIT = re.compile(r"[^0-9]+")


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost non-overlapping ``local@domain``, found from its ``@``."""
    after = 0
    at = text.find("@")
    while at >= 0:
        start = at - LOCAL_END.match(text[after:at][::-1]).end()
        domain = DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            after = domain.end()
            yield start, after
        else:
            after = max(after, start)
        at = text.find("@", max(at + 1, after))


def ip_parts_fit(match: str) -> bool:
    return all(len(p) <= 3 and int(p) <= 255
               for p in (q.lstrip("0") or "0" for q in match.split(".")))


def plain_spans(text: str) -> list[tuple[str, int, int]]:
    """Identifiers as the plain patterns define them, by kind and start."""
    found = [("email", a, b) for a, b in emails(text)] if "@" in text else []
    found += [("ip", m.start(), m.end()) for m in IP.finditer(text) if ip_parts_fit(m[0])]
    for m in CARD.finditer(text):
        if m.end() - m.start() >= 16:
            digits = NOT_DIGIT.sub("", m[0])
            if 16 <= len(digits) <= 19 and luhn(digits):
                found.append(("card", m.start(), m.end()))
    if "+" in text:
        found += [("phone", m.start(), m.end()) for m in PHONE.finditer(text)
                  if 8 <= len(NOT_DIGIT.sub("", m[0])) <= 15]
    return found


#: Letters of other alphabets that look like ASCII ones.
LOOK_ALIKES = dict(zip("абвеікмнорстухсѕјԁԛԝһАВЕІКМНОРСТУХЅЈ", "abbeikmhopctyxcsjdqwhABEIKMHOPCTYXSJ"))
LOOK_ALIKES |= dict(zip("αεικνορτυχΑΒΕΖΗΙΚΜΝΟΡΤΥΧ", "aeiknoptuxABEZHIKMNOPTYX"))
LOOK_ALIKES |= dict(zip("ıɑɡℓ٠۰‐‑‒–−﹣．。﹒＠﹫＋", "iagl00-----" + "-" + "...@@+"))
INVISIBLE = "​‌‍⁠﻿­"


def look_alikes() -> dict[str, str]:
    """ASCII character for each look-alike: the list above, all decimal digits, and letters,
    digits and signs in full width or mathematical styles."""
    table = dict(LOOK_ALIKES)
    for low, high in ((0x0660, 0x1E960), (0xFF01, 0xFF5F), (0x1D400, 0x1D800), (0x1FBF0, 0x1FBFA),
                      (0x2460, 0x2474), (0x24B6, 0x24EA)):
        for c in map(chr, range(low, high)):
            if unicodedata.category(c) == "Nd":
                table.setdefault(c, str(unicodedata.decimal(c)))
            elif low > 0x1000:
                folded = unicodedata.normalize("NFKC", c)
                if len(folded) == 1 and folded.isascii() and folded.isprintable():
                    table.setdefault(c, folded)
    return {k: v for k, v in table.items() if not k.isascii()} | dict.fromkeys(INVISIBLE, "")


ALIKE = look_alikes()
#: Look-alikes are a few signs and characters beyond the Latin letters.
ALIKE_HINT = re.compile("[\xad\u0131\u0251-\U0010ffff]")
ALIKE_RUN = re.compile("[" + "".join(map(re.escape, ALIKE)) + "]")

OPEN, CLOSE = r"[ \t]*[\[({<][ \t]*", r"[ \t]*[\])}>][ \t]*"
#: Words for the signs, in the languages of the texts.
AT_WORDS, DOT_WORDS = "at|arroba|arobase", "dot|punkt|punto|point"
#: Last labels that a host written in words must have.
LAST_LABELS = frozenset(
    "com org net edu gov mil int info biz io co ai app dev me tv xyz online site name pro uk de es "
    "fr it nl be at ch eu us ca mx br ar cl pt pl se no dk fi ie cz ru in cn jp kr au nz za".split())
BRACKETED = re.compile(
    rf"(?i){OPEN}(?:(?P<at>{AT_WORDS}|a|@)|(?P<dot>{DOT_WORDS}|\.)){CLOSE}"
    r"|(?P<at_code>&#0*64;|&#x40;|&commat;)|(?P<dot_code>&#0*46;|&#x2e;|&period;)")
LABEL = r"[A-Za-z0-9-]++"
#: ``name at host dot org`` written in words, with a signed or worded last dot.
WORDED = re.compile(
    rf"(?i)(?<![A-Za-z0-9._%+-])[A-Za-z0-9_%+-]++(?:(?:\.|[ \t]+(?:dot)[ \t]+)[A-Za-z0-9_%+-]++){{0,4}}"
    rf"(?P<at>[ \t]+(?:{AT_WORDS})[ \t]+|[ \t]+@[ \t]+|[ \t]+@|@[ \t]+|@){LABEL}"
    rf"(?:(?:\.|[ \t]+(?:{DOT_WORDS})[ \t]+){LABEL})+")
LAST = re.compile(r"[A-Za-z0-9]+-*$")
WORD_DOT = re.compile(rf"(?i)[ \t]+(?:{DOT_WORDS})[ \t]+")
#: What every match of BRACKETED and of WORDED holds.
BRACKET_HINT = re.compile(r"[\[({<&]")
WORDED_HINT = re.compile(rf"(?i)@|[ \t](?:{AT_WORDS})[ \t]")

#: Digits in English, Spanish, German and French words.
DIGIT_WORDS = {w: str(d) for words in (
    "zero one two three four five six seven eight nine",
    "cero uno dos tres cuatro cinco seis siete ocho nueve",
    "null eins zwei drei vier fünf sechs sieben acht neun",
    "zéro un deux trois quatre cinq six sept huit neuf") for d, w in enumerate(words.split())}
DIGIT_WORDS["oh"] = "0"
DIGIT_SET = frozenset(DIGIT_WORDS)
_DIGIT = "(?:" + "|".join(sorted(DIGIT_WORDS, key=len, reverse=True)) + r")\b|[0-9]++"
_GAP = rf"(?:[ \t]*[,-][ \t]*|[ \t]+(?:(?:{DOT_WORDS}|hyphen|dash)[ \t]+)?|[ \t]*\.[ \t]*)"
#: Digit words that a run has at least, and different digits among them.
LEAST_WORDS, LEAST_DIGITS = 3, 3
SPELLED = re.compile(rf"(?i)(?:\bplus[ \t]+|\+[ \t]*)?\b(?:{_DIGIT})(?:{_GAP}(?:{_DIGIT})){{3,}}")
SPELLED_PART = re.compile(rf"(?i)(?P<plus>plus[ \t]+|\+[ \t]*)|(?P<digit>{_DIGIT})|"
                          rf"(?P<dot>[ \t]+(?:{DOT_WORDS})[ \t]+|[ \t]*\.[ \t]*)|(?P<gap>.)")


class Rewritten:
    """A text with the source span of each of its characters, and which of them were rewritten."""

    def __init__(self, text: str):
        self.text = text
        self.starts = self.ends = range(0)
        #: Disjoint rewritten spans in order, and their ends.
        self.changed: list[tuple[int, int]] = []
        self.changed_ends: list[int] = []
        self.same = True

    def spans(self) -> tuple[list[int], list[int]]:
        if self.same:
            return list(range(len(self.text))), list(range(1, len(self.text) + 1))
        return self.starts, self.ends

    def rewrite(self, edits: list[tuple[int, int, str]]) -> None:
        """Replace disjoint spans, given in order, by other text."""
        if not edits:
            return
        starts, ends = self.spans()
        text, new_starts, new_ends, changed, at, old = [], [], [], [], 0, list(self.changed)
        moved = []
        size = 0
        for a, b, put in edits:
            text.append(self.text[at:a])
            new_starts += starts[at:a]
            new_ends += ends[at:a]
            moved.append((at, a, size - at))
            size += a - at
            text.append(put)
            changed.append((size, size + len(put)))
            new_starts += [starts[a]] * len(put)
            new_ends += [ends[b - 1]] * len(put)
            size += len(put)
            at = b
        text.append(self.text[at:])
        new_starts += starts[at:]
        new_ends += ends[at:]
        moved.append((at, len(self.text), size - at))
        m = 0
        for a, b in old:  # what earlier transducers changed and this one left
            while m < len(moved) and moved[m][1] < b:
                m += 1
            if m < len(moved) and moved[m][0] <= a:
                changed.append((a + moved[m][2], b + moved[m][2]))
        self.text, self.starts, self.ends = "".join(text), new_starts, new_ends
        self.changed, self.same = sorted(changed), False
        self.changed_ends = [b for _, b in self.changed]

    def touched(self, start: int, end: int) -> bool:
        """Whether the span holds a rewritten character (or a place where one vanished)."""
        at = bisect_right(self.changed_ends, start)
        return at < len(self.changed) and self.changed[at][0] < end


def alike_edits(text: str) -> list[tuple[int, int, str]]:
    if text.isascii() or not ALIKE_HINT.search(text):
        return []
    return [(m.start(), m.end(), ALIKE[m[0]]) for m in ALIKE_RUN.finditer(text)]


def bracket_edits(text: str) -> list[tuple[int, int, str]]:
    """Signs in brackets or as character references."""
    if not BRACKET_HINT.search(text):
        return []
    return [(m.start(), m.end(), "@" if m["at"] or m["at_code"] else ".")
            for m in BRACKETED.finditer(text)]


def worded_edits(view: Rewritten) -> list[tuple[int, int, str]]:
    """Signs as words, or between blanks, inside what then is an address with a common ending.

    "at" before a host with plain dots is prose; the other words for the sign are not.
    """
    edits = []
    if not WORDED_HINT.search(view.text):
        return edits
    for m in WORDED.finditer(view.text):
        dots = [(d.start(), d.end(), ".") for d in WORD_DOT.finditer(view.text, m.start(), m.end())]
        sign = m["at"].strip().lower()
        clear = len(m["at"]) > 1 if sign == "@" else sign != "at"
        if LAST.search(m[0])[0].lower() in LAST_LABELS and (
                dots or clear or view.touched(m.start(), m.end())):
            edits += sorted([(*m.span("at"), "@"), *dots])
    return edits


def spells_digits(text: str) -> bool:
    """Whether some digit words stand close together (a quick look at the words)."""
    words = text.lower().replace("-", " ").replace(",", " ").replace(".", " ").split()
    if DIGIT_SET.isdisjoint(words):
        return False
    places = [i for i, w in enumerate(words) if w in DIGIT_SET]
    return any(b - a <= 3 * LEAST_WORDS for a, b in zip(places, places[LEAST_WORDS - 1:]))


def digit_edits(text: str) -> list[tuple[int, int, str]]:
    edits = []
    for m in SPELLED.finditer(text) if spells_digits(text) else ():
        put, words = [], 0
        for part in SPELLED_PART.finditer(m[0]):
            if part["digit"]:
                word = part["digit"].lower()
                put.append(DIGIT_WORDS.get(word, word))
                words += word in DIGIT_WORDS
            elif part["plus"]:
                put.append("+")
            elif part["dot"]:
                put.append(".")
        digits = "".join(put)
        if words >= LEAST_WORDS and len(set(digits) - set("+.")) >= LEAST_DIGITS:
            # A dotted run is an address if it has four parts; else dots are only pauses.
            if digits.count(".") != 3:
                digits = digits.replace(".", "")
            edits.append((m.start(), m.end(), digits))
    return edits


def disguised_spans(text: str) -> list[tuple[str, int, int]]:
    """Identifiers that only the normalised text shows, in offsets of the source."""
    view = Rewritten(text)
    view.rewrite(alike_edits(view.text))
    view.rewrite(bracket_edits(view.text))
    view.rewrite(worded_edits(view))
    spelled = digit_edits(view.text)
    view.rewrite(spelled)
    if view.same:
        return []
    starts, ends = view.spans()
    found = [(k, a, b) for k, a, b in plain_spans(view.text) if view.touched(a, b)]
    if spelled:
        shift = 0
        for a, b, put in spelled:  # a spelled telephone number needs no plus sign
            at = a + shift
            if put.isdigit() and 8 <= len(put) <= 15:
                found.append(("phone", at, at + len(put)))
            shift += len(put) - (b - a)
    return [(k, starts[a], ends[b - 1]) for k, a, b in found]


def all_spans(text: str | None) -> list[tuple[str, int, int, bool]]:
    """Plain and disguised identifiers by kind and start; the flag marks the plain ones."""
    if not text:
        return []
    plain = plain_spans(text)
    more = set(disguised_spans(text)).difference(plain)
    found = [(k, a, b, True) for k, a, b in plain] + [(k, a, b, False) for k, a, b in more]
    return sorted(found, key=lambda s: (KINDS.index(s[0]), s[1], s[2]))


def redacted(text: str, spans: list[tuple[str, int, int, bool]]) -> str:
    """The text with every found stretch replaced by the name of its first kind."""
    out, at = [], 0
    for kind, a, b, _ in sorted(spans, key=lambda s: (s[1], -s[2])):
        if a >= at:
            out += [text[at:a], f"[{kind.upper()}]"]
        at = max(at, b)
    return "".join(out) + text[at:]


def find_personal_data(docs: DataFrame, found: str = "found",
                       clean: str = "redacted") -> DataFrame:
    """Adds to every row of ``docs`` (any columns, among them ``text``) the column ``found``: spans
    (``kind``, ``start``, ``end``, ``plain``) in code points of the whole text, end exclusive, by
    kind and start, and the column ``clean``, the text with them replaced.

    Kinds are email, ip, card and phone. A null text has no spans and stays null; rows count each on
    its own; columns of these two names are replaced; an empty table gives no rows. A long text takes
    time in proportion, whatever letters it has, and some 100 bytes of memory a character.
    """
    rows = docs.drop(found, clean)
    span = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()),
                               ("end", pa.int32()), ("plain", pa.bool_())]))

    def scan(batches):
        keep_only()
        for batch in slices(batches):
            texts = batch.column("text").to_pylist()
            spans = [all_spans(t) for t in texts]
            listed = [[dict(zip(("kind", "start", "end", "plain"), s)) for s in row]
                      for row in spans]
            shown = [t if not s else redacted(t, s) for t, s in zip(texts, spans)]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(listed, span), pa.array(shown, pa.string())],
                names=[*batch.schema.names, found, clean])

    schema = with_field(
        rows, found, "array<struct<kind: string, start: int, end: int, plain: boolean>>")
    return rows.mapInArrow(scan, schema.add(clean, "string"))


def joined(spans: Column) -> Column:
    """``kind:start:end`` of each span, joined by commas."""
    return F.array_join(F.transform(
        spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def plain_of(spans: Column) -> Column:
    return F.filter(spans, lambda s: s["plain"])
