"""Personal data in whole texts, also where it is disguised, at offsets of the source text.

Plain identifiers are found first, by the patterns below, on the text as it is. Then transducers
rewrite a copy of the text, each keeping for every character it writes the source span it was read
from, so that a span of the copy maps back to the source:

1. homoglyphs: full-width, Cyrillic and Greek look-alikes and other digits become ASCII; unseen
   characters (zero-width, soft hyphen) vanish;
2. disguised signs: ``[at]``, ``(dot)``, ``{at}`` and the like, with blanks around, and character
   references become the sign; bare `` at `` and `` dot ``, and signs between blanks, do so only
   within a whole address ``name at host dot end`` or between the four numbers of an ip;
3. spelled digits: runs of at least ``SPELLED`` digit words become digits, so that numbers in
   prose stay words.

Identifiers of the copy that are made of at least one rewritten character, and do not overlap a
plain one of their kind, are added. Plain ones always stay.

Defined results: a null text is an empty one; spans count code points, their end is exclusive;
texts are searched whole, whatever their length; patterns run in time in proportion to the text;
repeated rows have repeated results; extra columns are ignored.
"""

from __future__ import annotations

import re
import unicodedata
from bisect import bisect_right
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

KINDS = ("email", "ip", "card", "phone")
SPELLED = 4

Span = tuple[int, int]
Rewriting = list[tuple[int, int, str]]  # start, end, and what is written instead
# A rewritten text, and for each character the source span that it stands for; ``marked`` tells
# the characters that are not the source's own.
Tape = tuple[str, list[int], list[int], list[bool]]

_HOST = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_NOT_LOCAL = re.compile(r"[^A-Za-z0-9._%+-]")
_DIGIT = re.compile("[0-9]")
_NUMBERS = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++)+")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def emails(text: str) -> list[Span]:
    """``[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\\.[A-Za-z0-9-]+)+``, sought from the sign outwards."""
    found, end = [], 0
    for m in _HOST.finditer(text):
        start = m.start()
        while start > end and not _NOT_LOCAL.match(text, start - 1):
            start -= 1
        if start < m.start():
            end = m.end()
            found.append((start, end))
    return found


def ips(text: str) -> list[Span]:
    """Four dotted numbers, left to right along each chain of numbers; parts at most 255."""
    found = []
    for m in _NUMBERS.finditer(text):
        parts, at = m.group().split("."), m.start()
        for i in range(0, len(parts) - 3, 4):
            four = parts[i : i + 4]
            end = at + sum(map(len, four)) + 3
            if all(len(p.lstrip("0")) <= 3 and int(p[-3:]) <= 255 for p in four):
                found.append((at, end))
            at = end + 1
    return found


def _luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def cards(text: str) -> list[Span]:
    found = []
    for m in _CARD.finditer(text):
        if m.end() - m.start() < 16 or m.end() - m.start() > 37:
            continue
        digits = re.sub("[^0-9]", "", m.group())
        if 16 <= len(digits) <= 19 and _luhn(digits):
            found.append(m.span())
    return found


def phones(text: str) -> list[Span]:
    found = []
    for m in _PHONE.finditer(text):
        digits = len(re.findall("[0-9]", m.group()))
        if 8 <= digits <= 15:
            found.append(m.span())
    return found


FINDERS: dict[str, Callable[[str], list[Span]]] = dict(
    zip(KINDS, (emails, ips, cards, phones), strict=True)
)

# Letters of other scripts that look like the ASCII letters below them.
_LOOK_ALIKE = (
    ("аАеЕоОрРсСуУхХіІјЈѕЅһԁԛԝВКМНТ", "aAeEoOpPcCyYxXiIjJsShdqwBKMHT"),
    ("αΑΒεΕΖΗιΙΚΜΝοΟρΡΤυΥΧν", "aABeEZHiIKMNoOpPTuYXv"),
)
# Characters without a width, and signs written as other characters.
_UNSEEN = "​‌‍⁠﻿­"
_SIGNS = {"＠": "@", "﹫": "@", "．": ".", "。": ".", "․": ".", "‐": "-", "‑": "-", "‒": "-", "–": "-"}
# Names of the digits.
_DIGITS = (
    ("zero", "one", "two", "three", "four", "five", "six", "seven", "eight", "nine"),
    ("null", "eins", "zwei", "drei", "vier", "fünf", "sechs", "sieben", "acht", "neun"),
    ("zéro", "un", "deux", "trois", "quatre", "cinq", "six", "sept", "huit", "neuf"),
    ("cero", "uno", "dos", "tres", "cuatro", "cinco", "seis", "siete", "ocho", "nueve"),
)
_VALUE = {name: str(d) for names in _DIGITS for d, name in enumerate(names)} | {"oh": "0"}
_NAMES = "|".join(sorted(_VALUE, key=len, reverse=True))

_GAP = r"[\x20\t]{0,3}"
_AT, _DOT = r"\x20{1,3}(?:at|@)\x20{1,3}", r"\x20{1,3}(?:dot|\.)\x20{1,3}"
_PART = r"[A-Za-z0-9-]{1,63}"
_BRACKETED = re.compile(
    rf"{_GAP}[\[({{<][\x20\t]?(a|at|@|dot|\.|punkt|punto|point)[\x20\t]?[\])}}>]{_GAP}", re.I
)
# The two signs as character references and in URLs.
_CODED = re.compile(r"(&\#64;|&\#x40;|&commat;|%40)|&\#46;|&\#x2e;|&period;|%2e", re.I)
_LOCAL = re.compile(r"[A-Za-z0-9._%+-]{1,64}\Z")
_HOST_PART = re.compile(
    rf"(?P<at>\x20{{1,3}}(?:at|@)\x20{{1,3}}|@){_PART}(?P<dots>(?:(?:{_DOT}|\.){_PART}){{1,8}})", re.I
)
_IN_ADDRESS = re.compile(rf"({_AT})|{_DOT}", re.I)
_QUAD = re.compile(rf"(?<![0-9.])[0-9]{{1,3}}(?:(?:{_DOT}|\.)[0-9]{{1,3}}){{3}}(?![0-9])", re.I)
_DOTS = re.compile(_DOT, re.I)
_RUN = re.compile(
    rf"(?<!\w)(?:plus[\x20-]{{1,3}})?(?:{_NAMES})"
    rf"(?:(?:{_DOT}|\x20?-\x20?|,\x20?|[\x20\t]{{1,3}})(?:{_NAMES})){{{SPELLED - 1},}}(?!\w)",
    re.I,
)
_TOKEN = re.compile(rf"{_NAMES}|plus|{_DOT}", re.I)
# A text without any of these words has no spelled digits.
_NAME_WORDS = frozenset(name.encode() for name in _VALUE)
_TO_BLANK = bytes.maketrans(b",.-", b"   ")


def _plain(c: str) -> str:
    """The ASCII that a character looks like, or the character itself."""
    for theirs, ours in _LOOK_ALIKE:
        if c in theirs:
            return ours[theirs.index(c)]
    if c in _UNSEEN:
        return ""
    if c in _SIGNS:
        return _SIGNS[c]
    if unicodedata.category(c) == "Nd":
        return str(unicodedata.digit(c))
    wide = unicodedata.normalize("NFKC", c)
    known = len(wide) == 1 and "!" <= wide <= "~"
    return wide if known else c


def _rewrite(tape: Tape, spans: Rewriting) -> Tape:
    """Replace spans of the tape; what is written stands for the whole source of its span."""
    text, starts, ends, marked = tape
    out, s, e, k, at = [], [], [], [], 0
    for a, b, new in spans:
        out += [text[at:a], new]
        s += starts[at:a] + [starts[a]] * len(new)
        e += ends[at:a] + [ends[b - 1]] * len(new)
        k += marked[at:a] + [True] * len(new)
        at = b
    return (
        "".join([*out, text[at:]]), s + starts[at:], e + ends[at:], k + marked[at:],
    )


def _shown(text: str) -> Rewriting:
    """Look-alikes and unseen characters of a text, as rewritings."""
    if text.isascii():
        return []
    odd = {c: _plain(c) for c in set(text) if c > "\x7f"}
    odd = {c: new for c, new in odd.items() if new != c}
    if not odd:
        return []
    pattern = re.compile("[" + re.escape("".join(odd)) + "]")
    return [(m.start(), m.end(), odd[m.group()]) for m in pattern.finditer(text)]


def _signs(text: str) -> Rewriting:
    """Signs in brackets, and as character references."""
    found = []
    if "[" in text or "(" in text or "{" in text or "<" in text:
        for m in _BRACKETED.finditer(text):
            found.append((*m.span(), "@" if m.group(1).lower() in ("a", "at", "@") else "."))
    if "&" in text or "%" in text:
        taken = sorted(s[:2] for s in found)
        for m in _CODED.finditer(text):
            if _apart(m.span(), taken):
                found.append((*m.span(), "@" if m.group(1) else "."))
    return sorted(found)


def _bare_signs(text: str) -> Rewriting:
    """Bare words and loose signs, in what is an address as a whole."""
    found = []
    for m in _HOST_PART.finditer(text):
        local = _LOCAL.search(text, max(0, m.start() - 64), m.start())
        if local is None:
            continue
        loose = _DOTS.search(m["dots"]) is not None
        if m["at"] == "@" and not loose:
            continue
        # Prose has "at" before a name with a dot; a bare "at" asks for spelled dots, or for
        # something before it that is no common word.
        if m["at"].strip().lower() == "at" and not loose and not re.search(r"[0-9_%+]|\w[.-]\w", local.group()):
            continue
        for sign in _IN_ADDRESS.finditer(text, m.start("at"), m.end()):
            found.append((*sign.span(), "@" if sign.group(1) else "."))
    return found


def _bare_dots(text: str) -> Rewriting:
    """Dots between four numbers."""
    return [
        (*dot.span(), ".")
        for m in _QUAD.finditer(text)
        for dot in _DOTS.finditer(text, m.start(), m.end())
    ]


def _spelled(text: str) -> Rewriting:
    """Runs of digit words, with a plus before them and dots between them."""
    found = []
    if not _NAME_WORDS.isdisjoint(text.lower().encode("utf-8", "surrogatepass").translate(_TO_BLANK).split()):
        for m in _RUN.finditer(text):
            tokens = (t.strip().lower() for t in _TOKEN.findall(m.group()))
            digits = "".join(_VALUE.get(t, "+" if t == "plus" else ".") for t in tokens)
            found.append((*m.span(), digits))
    return found


def normalised(text: str) -> Tape | None:
    """The rewritten text, or nothing if there is nothing to rewrite."""
    tape: Tape | None = None
    for step in (_shown, _signs, _spelled, _bare_signs, _bare_dots):
        spans = step(text if tape is None else tape[0])
        if spans:
            if tape is None:
                n = len(text)
                tape = (text, list(range(n)), list(range(1, n + 1)), [False] * n)
            tape = _rewrite(tape, spans)
    return tape


def _apart(span: Span, taken: list[Span]) -> bool:
    """Whether a span overlaps none of the others, which are sorted and don't overlap."""
    i = bisect_right(taken, (span[0], float("inf")))
    before = i > 0 and taken[i - 1][1] > span[0]
    after = i < len(taken) and taken[i][0] < span[1]
    return not (before or after)


def find(text: str | None) -> tuple[dict[str, list[Span]], dict[str, list[Span]]]:
    """Plain spans, and all spans, by kind and in order."""
    text = text or ""
    digits = _DIGIT.search(text) is not None
    plain = {
        "email": emails(text) if "@" in text else [],
        "ip": ips(text) if digits else [],
        "card": cards(text) if digits else [],
        "phone": phones(text) if digits and "+" in text else [],
    }
    tape = normalised(text)
    if tape is None:
        return plain, plain
    copy, starts, ends, marked = tape
    every = {}
    for kind, finder in FINDERS.items():
        more = []
        for a, b in finder(copy):
            span = (starts[a], ends[b - 1])
            if any(marked[a:b]) and _apart(span, plain[kind]):
                more.append(span)
        every[kind] = sorted({*plain[kind], *more})
    return plain, every


def digest(spans: dict[str, list[Span]]) -> str:
    return ",".join(f"{kind}:{a}:{b}" for kind in KINDS for a, b in spans[kind])


def _found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        columns: dict[str, list] = {f"n_{kind}": [] for kind in KINDS} | {"base": [], "spans": []}
        for text in batch.column("text").to_pylist():
            plain, every = find(text)
            for kind in KINDS:
                columns[f"n_{kind}"].append(len(plain[kind]))
            columns["base"].append(digest(plain))
            columns["spans"].append(digest(every))
        arrays = [
            pa.array(v, pa.int64() if name.startswith("n_") else pa.string())
            for name, v in columns.items()
        ]
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *arrays], ["doc_id", *columns])


def detect(docs: DataFrame) -> DataFrame:
    """``doc_id``, plain counts ``n_email`` .. ``n_phone``, ``base`` and ``spans`` of every row.

    ``base`` lists the plain spans and ``spans`` all, as ``kind:start:end``.
    """
    counts = ", ".join(f"n_{kind} long" for kind in KINDS)
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        _found, f"doc_id long, {counts}, base string, spans string"
    )


def masked(docs: DataFrame) -> DataFrame:
    """``docs`` with every span of ``text`` replaced by its kind in angle brackets."""

    def hide(text: str | None) -> str | None:
        if text is None:
            return None
        every = find(text)[1]
        spans = sorted((a, -b, kind) for kind in KINDS for a, b in every[kind])
        out, at = [], 0
        for a, minus_b, kind in spans:
            if a >= at:
                out += [text[at:a], f"<{kind}>"]
                at = -minus_b
        return "".join([*out, text[at:]])

    @F.pandas_udf("string")
    def hidden(texts):
        return texts.map(hide)

    return docs.withColumn("text", hidden("text"))
