"""Personal data found behind disguises, with spans in the source's characters."""

from __future__ import annotations

import re
import unicodedata
from bisect import bisect_right
from itertools import compress, count
from operator import itemgetter

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from billtide.llm.rows import add_columns

KINDS = ["email", "ip", "card", "phone"]

# ---- fixed values: the base patterns ----
DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
IP = re.compile(r"(?<![0-9])[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+")
CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
#: Stands in every address; without the look back, so it is fast.
IN_IP = re.compile(r"[0-9]\.[0-9]+\.[0-9]")
PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")

# ---- fixed values: letters of other scripts that look like Latin ones, and what they stand for ----
LOOKALIKES = {
    "а": "a", "в": "b", "с": "c", "е": "e", "н": "h", "і": "i", "ј": "j", "к": "k", "м": "m", "о": "o",
    "р": "p", "ѕ": "s", "т": "t", "у": "y", "х": "x", "ԁ": "d", "ԛ": "q", "ԝ": "w", "А": "A", "В": "B",
    "С": "C", "Е": "E", "Н": "H", "І": "I", "Ј": "J", "К": "K", "М": "M", "О": "O", "Р": "P", "Ѕ": "S",
    "Т": "T", "У": "Y", "Х": "X", "α": "a", "ε": "e", "ι": "i", "κ": "k", "ν": "v", "ο": "o", "ρ": "p",
    "τ": "t", "υ": "u", "χ": "x", "Α": "A", "Β": "B", "Ε": "E", "Ζ": "Z", "Η": "H", "Ι": "I", "Κ": "K",
    "Μ": "M", "Ν": "N", "Ο": "O", "Ρ": "P", "Τ": "T", "Υ": "Y", "Χ": "X", "ı": "i", "ɡ": "g", "ɑ": "a",
    "﹫": "@", "․": ".", "。": ".", "｡": ".", "‐": "-", "‑": "-", "‒": "-", "–": "-", "−": "-", "﹢": "+",
    "\u00a0": " ", "\u2007": " ", "\u202f": " ", "\u3000": " ",
}
# ---- fixed values: digits as words in English, German, French and Spanish ----
DIGIT_WORDS = {
    "zero": 0, "one": 1, "two": 2, "three": 3, "four": 4, "five": 5, "six": 6, "seven": 7, "eight": 8,
    "nine": 9, "null": 0, "eins": 1, "zwei": 2, "drei": 3, "vier": 4, "fünf": 5, "sechs": 6,
    "sieben": 7, "acht": 8, "neun": 9, "zéro": 0, "un": 1, "deux": 2, "trois": 3, "quatre": 4, "cinq": 5,
    "sept": 7, "huit": 8, "neuf": 9, "cero": 0, "uno": 1, "dos": 2, "tres": 3, "cuatro": 4, "cinco": 5,
    "seis": 6, "siete": 7, "ocho": 8, "nueve": 9,
}


def lookalike_table() -> dict[int, str]:
    """One character for one: the fixed list, full-width forms and the digits of every script."""
    table = {ord(k): v for k, v in LOOKALIKES.items()}
    table |= {c: chr(c - 0xFEE0) for c in range(0xFF01, 0xFF5F)}
    for c in range(0x80, 0x20000):
        digit = unicodedata.decimal(chr(c), None)
        if digit is not None:
            table.setdefault(c, str(digit))
    return table


TABLE = lookalike_table()
LOOKS = frozenset(map(chr, TABLE))
INVISIBLE = frozenset("\u200b\u200c\u200d\u2060\ufeff\u00ad")
ONE = "(?:" + "|".join(sorted(DIGIT_WORDS, key=len, reverse=True)) + ")"
DOT_IN_BRACKETS = r"\s*+[\[({<]\s*+(?:dot|punkt|punto|point)\s*+[\])}>]\s*+"
DOT = rf"(?:\s++dot\s++|{DOT_IN_BRACKETS})"
# ---- fixed values: top-level domains by which a plain name after a bare "at" counts as a mail domain ----
TOP_LEVEL = (
    "com org net edu gov mil int info biz name pro coop aero museum jobs mobi travel tel cat asia post app dev cloud "
    "online site shop store tech xyz top club blog email live life news world space website media agency company group "
    "ac ad ae af ag ai al am ao ar at au aw az ba bb bd be bf bg bh bi bj bm bn bo br bs bt bw by bz ca cc cd cf cg ch "
    "ci ck cl cm cn co cr cu cv cy cz de dj dk dm do dz ec ee eg es et eu fi fj fm fo fr ga ge gg gh gi gl gm gn gr gt "
    "gy hk hn hr ht hu id ie il im in io iq ir is it je jm jo jp ke kg kh kr kw ky kz la lb lc li lk lr ls lt lu lv ly "
    "ma mc md me mg mk ml mm mn mo mr ms mt mu mv mw mx my mz na ne ng ni nl no np nz om pa pe pf pg ph pk pl pr ps pt "
    "py qa re ro rs ru rw sa sb sc sd se sg sh si sk sl sm sn so sr st su sv sy sz tc td tg th tj tk tl tm tn to tr tt "
    "tv tw tz ua ug uk us uy uz va vc ve vg vi vn vu ws ye za zm zw"
).split()
# ---- fixed values: words that stand before "at" and the name of a site, and are no one's mailbox ----
BEFORE_SITES = (
    "us me him her them it this that is are was were be more look looks looking find found available visit online here "
    "out up live hosted read published posted located sold"
).split()
# ---- fixed values: those of them that count behind a bare "dot", too, for they are no words ----
TOP_SPELLED = (
    "com org net edu gov mil biz io ai co uk de fr eu ch nl pl cz dk fi gr hu ie il jp kr kz lt lu lv mx nz pt ro rs ru se "
    "sg si sk th tr tv tw ua br ca cn cl hk"
).split()
TOP, TOP_BY_WORD = ("(?-i:" + "|".join([*t, *map(str.upper, t)]) + ")" for t in (TOP_LEVEL, TOP_SPELLED))
NO_SITE = "".join(rf"(?<!(?<![a-z0-9._%+-]){word})" for word in BEFORE_SITES)
#: What the rewriting transducer consumes; the group's name says what it writes.
REWRITES = re.compile(
    rf"(?P<none>[\u200b-\u200d\u2060\ufeff\u00ad]+)"
    # white space before a bracket is tried from where it begins only, so long runs of it cost no more than their length
    rf"|(?P<at>(?:(?<!\s)\s++)?+[\[({{<]\s*+(?:at|ät|arroba|arobase)\s*+[\])}}>]\s*+)"
    rf"|(?P<dot>(?:(?<!\s)\s++)?+[\[({{<]\s*+(?:dot|punkt|punto|point)\s*+[\])}}>]\s*+)"
    rf"|(?P<at_name>(?<=[a-z0-9_-])(?=\s++at\s){NO_SITE}\s++at\s++(?!www\.)"
    rf"(?=(?:[a-z0-9-]++(?:\.|{DOT}))*?[a-z0-9-]++(?:(?:\.|{DOT_IN_BRACKETS}){TOP}|\s++dot\s++{TOP_BY_WORD})\b(?!-|\.[a-z0-9])))"
    rf"|(?P<dot_word>(?<=[a-z0-9_-])\s++dot\s++(?=[a-z0-9-]))"
    rf"|(?P<plus>\bplus\s++(?={ONE}\b|[0-9]))"
    rf"|(?P<digits>\b{ONE}(?:(?:[ \t-]+{ONE})+\b|(?=[ ().-]+[0-9]))|(?<=[0-9][ ().-]){ONE}\b)",
    re.IGNORECASE,
)
DIGIT_WORD = re.compile(ONE, re.IGNORECASE)
IN_BRACKETS = re.compile(rb"[\[({<]\s*(?:at|\xc3[\xa4\x84]t|arroba|arobase|dot|punkt|punto|point)\s*[\])}>]", re.IGNORECASE)
#: Begins with plain bytes, so it is fast; for lower case and single kinds of whitespace.
AT_NAME = re.compile(rb" at +[a-z0-9-]+(?:\.|(?: +dot| *[\[({<]))")
SPACES = {c: " " for c in range(0x3001) if chr(c).isspace()}
WIDE_SPACES = frozenset(chr(c) for c in SPACES if c >= 128)
#: Whitespace of ASCII as spaces.
TO_SPACES = bytes(32 if c in SPACES and c < 128 else c for c in range(256))
#: Bytes of ASCII that are no letters or digits become spaces.
TO_WORDS = bytes(c if c >= 128 or chr(c).isalnum() else 32 for c in range(256))
#: The words in UTF-8; lower() of bytes leaves letters beyond ASCII as they are.
DIGIT_BYTES = frozenset(w.encode() for word in DIGIT_WORDS for w in (word, re.sub("[éü]", lambda m: m[0].upper(), word)))


def may_rewrite(text: str) -> bool:
    """Whether REWRITES can match at all; cheap, and false for almost every text."""
    if not text.isascii():
        if not INVISIBLE.isdisjoint(text):
            return True
        if not WIDE_SPACES.isdisjoint(text):
            text = text.translate(SPACES)
    raw = text.encode().lower().translate(TO_SPACES)
    if IN_BRACKETS.search(raw) or AT_NAME.search(raw):
        return True
    flat = raw.translate(TO_WORDS)
    if b" dot" in flat or b"plus " in flat:
        return True
    words = flat.split()
    for i in compress(count(), map(DIGIT_BYTES.__contains__, words)):
        # in any list of adjacent words one is the first, so looking ahead is enough for those
        after = words[i + 1] if i + 1 < len(words) else b""
        if after in DIGIT_BYTES or after[:1].isdigit() or i and words[i - 1][-1:].isdigit():
            return True
    return False


# ---- detection ----


def digits_of(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def luhn(digits: str) -> bool:
    total = sum(map(int, digits[-1::-2])) + sum(sum(divmod(2 * int(d), 10)) for d in digits[-2::-2])
    return total % 10 == 0


def emails(text: str):
    """The local part is the run of its characters before an @; runs never reach back into a match."""
    end = 0
    for m in DOMAIN.finditer(text) if "@" in text else ():
        start = m.start()
        while start > end and text[start - 1] in LOCAL:
            start -= 1
        if start < m.start():
            end = m.end()
            yield start, end


def detect(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) by the base patterns, by kind as listed and then by start."""
    found = [("email", s, e) for s, e in emails(text)]
    for m in IP.finditer(text) if IN_IP.search(text) else ():
        if all(len(p.lstrip("0")) < 4 and int(p) <= 255 for p in m[0].split(".")):
            found.append(("ip", *m.span()))
    for m in CARD.finditer(text):
        digits = digits_of(m[0]) if m.end() - m.start() <= 40 else ""
        if 13 <= len(digits) <= 19 and luhn(digits):
            found.append(("card", *m.span()))
    for m in PHONE.finditer(text):
        if 9 <= len(digits_of(m[0])) <= 15:
            found.append(("phone", *m.span()))
    return found


# ---- transducers ----


def normalised(text: str) -> tuple[str, list[int], list[int], list[bool]] | None:
    """The text without disguises and, for each of its characters, the source's start, end and whether it
    was rewritten; None if nothing was.

    Lookalikes are replaced one for one; then one pass rewrites disguised at and dot, spelled digits and
    invisible characters, and copies the rest.
    """
    plain = text if text.isascii() or LOOKS.isdisjoint(text) else text.translate(TABLE)
    out, starts, ends, new = [], [], [], []
    at = 0

    def copy(upto):
        out.append(plain[at:upto])
        starts.extend(range(at, upto))
        ends.extend(range(at + 1, upto + 1))
        new.extend([False] * (upto - at) if plain is text else map(str.__ne__, plain[at:upto], text[at:upto]))

    def write(chars, start, end):
        out.append(chars)
        starts.extend([start] * len(chars))
        ends.extend([end] * len(chars))
        new.extend([True] * len(chars))

    for m in REWRITES.finditer(plain) if may_rewrite(plain) else ():
        copy(m.start())
        kind = m.lastgroup
        if kind == "digits":
            for word in DIGIT_WORD.finditer(m[0]):
                write(
                    str(DIGIT_WORDS[word[0].casefold()]), m.start() + word.start(), m.start() + word.end()
                )
        elif kind != "none":
            write({"a": "@", "d": ".", "p": "+"}[kind[0]], *m.span())
        at = m.end()
    if not at and plain is text:
        return None
    copy(len(plain))
    return "".join(out), starts, ends, new


def find(text: str) -> list[tuple[str, int, int, bool]]:
    """(kind, start, end, base) in code points of the source, by kind as listed and then by start.

    All base spans, and those that show only in the normalised text: they hold a rewritten or dropped character
    and are not equal to or inside a base span of their kind. Where a base pattern met only the plain head or
    tail of a disguised identifier, both its span and the whole one are listed.
    """
    spans = [(*s, True) for s in detect(text)]
    seen = normalised(text)
    if seen:
        plain, starts, ends, new = seen
        base = {k: [(s, e) for kind, s, e, _ in spans if kind == k] for k in KINDS}
        for kind, s, e in detect(plain):
            start, end = starts[s], ends[e - 1]
            # spans of one kind are in order and apart, so only the last one that begins by then can hold this one
            i = bisect_right(base[kind], start, key=itemgetter(0)) - 1
            inside = i >= 0 and end <= base[kind][i][1]
            if (any(new[s:e]) or end - start != e - s) and not inside:
                spans.append((kind, start, end, False))
        spans.sort(key=lambda x: (KINDS.index(x[0]), x[1]))
    return spans


SPAN = "array<struct<kind: string, start: bigint, end: bigint, base: boolean>>"
ARROW = pa.list_(
    pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("base", pa.bool_())])
)


def masked(text: str, spans: list[tuple[str, int, int, bool]]) -> str:
    """The text with each span, or each run of overlapping ones, replaced by the first one's kind."""
    parts, at = [], 0
    for kind, start, end, _ in sorted(spans, key=lambda x: (x[1], -x[2])):
        if start >= at:
            parts += [text[at:start], f"<{kind.upper()}>"]
        at = max(at, end)
    return "".join([*parts, text[at:]])


def find_pii(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with ``pii``, the spans of each text, and ``masked``, the text with spans replaced.

    A null text counts as empty and has no spans. Positions are code points, end exclusive. Texts are read
    whole, in time that grows with their length, and each alone, so nothing is shuffled, repeated rows get equal spans and an empty table stays
    empty. Columns named like a result are replaced.
    """

    def start():
        def work(texts):
            found = [find(t or "") for t in texts]
            rows = [[dict(zip(("kind", "start", "end", "base"), s)) for s in spans] for spans in found]
            return [rows, [masked(t or "", spans) for t, spans in zip(texts, found)]]

        return work

    return add_columns(docs, start, [("pii", SPAN, ARROW), ("masked", "string", pa.string())], text)


def spans_text(only_base: bool) -> F.Column:
    """kind:start:end of the spans, comma-joined in their order."""
    chosen = F.filter("pii", lambda s: s["base"]) if only_base else F.col("pii")
    return F.array_join(
        F.transform(chosen, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ","
    )
