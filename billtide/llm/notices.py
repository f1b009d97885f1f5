"""Fuzzy search for short licence notices: exact seeds find places, bounded-error matching verifies them."""

from __future__ import annotations

import re
from bisect import bisect_left

import ahocorasick
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from billtide.llm.rows import add_columns

WORD = re.compile(rb"[0-9a-z\x80-\xff]+")

# ---- fixed values: phrases that are found exactly, and their labels ----
BASE = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}
# ---- fixed values: notices that are found with errors, and their labels ----
NOTICES = {
    "licensed under the apache license version 2 0": "apache-2.0",
    "released under the mit license": "mit",
    "permission is hereby granted free of charge to any person obtaining a copy": "mit",
    "redistribution and use in source and binary forms with or without modification": "bsd",
    "licensed under the gnu general public license version 3": "gpl-3.0",
    "licensed under the gnu general public license version 2": "gpl-2.0",
    "licensed under the gnu lesser general public license": "lgpl",
    "licensed under the gnu affero general public license": "agpl",
    "this program is free software you can redistribute it and or modify it": "gpl",
    "subject to the terms of the mozilla public license": "mpl-2.0",
    "licensed under cc by 4 0": "cc-by",
    "licensed under cc by nc 4 0": "cc-by-nc",
    "licensed under cc by sa 4 0": "cc-by-sa",
    "licensed under cc by nd 4 0": "cc-by-nd",
    "licensed under cc by nc sa 4 0": "cc-by-nc-sa",
    "licensed under cc by nc nd 4 0": "cc-by-nc-nd",
    "dedicated to the public domain under cc0 1 0 universal": "cc0",
    "licensed under a creative commons attribution 4 0 international license": "cc-by",
    "free and unencumbered software released into the public domain": "unlicense",
    "permission to use copy modify and or distribute this software for any purpose": "isc",
    "all rights reserved": "reserved",
}
# ---- fixed values: words that tell notices of one family apart; they and all numbers must stand as they are ----
TELLING = frozenset("nc sa nd cc0 lesser library affero mit".split())


def telling(words: str) -> list[str]:
    return [w for w in words.split() if w.isdigit() or w in TELLING]


class Search:
    """The notices, cut into seeds.

    A notice may differ by one edit (of a character) for each ``per_edit`` characters. Cut into one more
    piece than that, at least one piece stands unchanged wherever it matches, so no match escapes the seeds. A match
    lies within its edits of where a seed puts it, so no window is longer than its notice and two times its edits.
    Numbers and words that tell notices of one family apart must be exact, and of notices that match in one
    place the likest stays.
    """

    def __init__(self, notices: dict[str, str], per_edit: int):
        self.notices = list(notices.items())
        self.edits = [max(1, len(n) // per_edit) for n, _ in self.notices]
        pieces: dict[str, list[tuple[int, int]]] = {}
        for i, (notice, _) in enumerate(self.notices):
            n = self.edits[i] + 1
            cuts = [len(notice) * k // n for k in range(n + 1)]
            for a, b in zip(cuts, cuts[1:]):
                pieces.setdefault(notice[a:b], []).append((i, a))
        self.seeds = ahocorasick.Automaton()
        for piece, at in pieces.items():
            self.seeds.add_word(piece, (len(piece), at))
        self.seeds.make_automaton()
        self.patterns = [
            (regex.compile(f"(?:{regex.escape(notice)}){{e<={k}}}"), regex.compile(f"(?e)(?:{regex.escape(notice)}){{e<={k}}}"))
            for (notice, _), k in zip(self.notices, self.edits)
        ]
        self.telling = [telling(notice) for notice, _ in self.notices]

    def windows(self, text: str) -> list[tuple[int, int, int]]:
        """(notice, start, end) of the places where a seed stands, each once, by notice and start."""
        found = set()
        for last, (size, places) in self.seeds.iter(text):
            for i, offset in places:
                start = last + 1 - size - offset - self.edits[i]
                found.add((i, max(0, start), start + len(self.notices[i][0]) + 2 * self.edits[i]))
        return sorted(found)

    def verify(self, i: int, window: str) -> tuple[int, int, int] | None:
        """Start, end and edits of a notice's best match in a window."""
        notice = self.notices[i][0]
        at = window.find(notice)
        if at >= 0:
            return at, at + len(notice), 0
        any_match, best = self.patterns[i]
        if not any_match.search(window):
            return None
        m = best.search(window)
        return m.start(), m.end(), sum(m.fuzzy_counts)

    def find(self, text: str) -> list[tuple[str, int, int, int, float]]:
        """(label, first word, word after the last, edits, likeness) in a text of words and single spaces."""
        met: list[tuple[int, int, int, int]] = []
        seen: dict[tuple[int, str], tuple[int, int, int] | None] = {}  # windows of one text are often alike
        done = {}
        for i, start, end in self.windows(text):
            start = max(start, done.get(i, 0))
            if end <= start:
                continue
            window = text[start:end]
            if (i, window) not in seen:
                seen[i, window] = self.verify(i, window)
            match = seen[i, window]
            if match:
                a, b, edits = start + match[0], start + match[1], match[2]
                done[i] = b
                body = text[a:b].strip()
                if body:
                    a = text.index(body, a)
                    met.append((a, a + len(body), i, edits))
        if not met:
            return []
        blanks = [m.start() for m in re.finditer(" ", text)]
        spans = []
        for a, b, i, edits in met:
            notice, label = self.notices[i]
            # whole words: a match may begin or end within one
            first, after = bisect_left(blanks, a), bisect_left(blanks, b) + 1
            whole = text[blanks[first - 1] + 1 if first else 0 : blanks[after - 1] if after <= len(blanks) else len(text)]
            if telling(whole) == self.telling[i]:
                spans.append((label, first, after, edits, 1 - edits / len(notice)))
        return likest(spans)


def likest(spans: list[tuple[str, int, int, int, float]]) -> list[tuple[str, int, int, int, float]]:
    """Of spans that share words with a likelier one (of equally likely ones the longer) the latter, by first word."""
    kept: list[tuple[str, int, int, int, float]] = []
    for span in sorted(spans, key=lambda s: (-s[4], s[1] - s[2], s[1], s[0])):
        at = bisect_left(kept, span[1], key=lambda s: s[1])
        if (at == 0 or kept[at - 1][2] <= span[1]) and (at == len(kept) or span[2] <= kept[at][1]):
            kept.insert(at, span)
    return kept


def places(text: bytes, phrase: bytes) -> list[int]:
    """Word numbers where a phrase's words stand consecutively; ``text`` is words with a space around each."""
    found, at, word, counted = [], 0, 0, 0
    while (at := text.find(b" " + phrase + b" ", at)) >= 0:
        word += text.count(b" ", counted, at)
        counted = at
        found.append(word)
        at += 1
    return found


SPANS = "array<struct<label: string, first: bigint, end: bigint, edits: int, likeness: double>>"
FIELDS = [
    ("n_words", "bigint", pa.int64()),
    ("n_base", "bigint", pa.int64()),
    ("first_word", "bigint", pa.int64()),
    ("last_word", "bigint", pa.int64()),
    ("base_labels", "array<string>", pa.list_(pa.string())),
    ("labels", "array<string>", pa.list_(pa.string())),
    ("score", "double", pa.float64()),
    ("spans", SPANS, pa.list_(pa.struct([
        ("label", pa.string()), ("first", pa.int64()), ("end", pa.int64()), ("edits", pa.int32()),
        ("likeness", pa.float64()),
    ]))),
]


def scanned(text: str, base: dict[str, str], search: Search) -> tuple:
    words = WORD.findall(text.encode().lower())  # bytes.lower() changes A-Z only
    line = b" ".join(words)
    padded = b" " + line + b" "
    exact = {phrase: places(padded, phrase.encode()) for phrase in base}
    starts = [p for found in exact.values() for p in found]
    base_labels = sorted({base[phrase] for phrase, found in exact.items() if found})
    spans = search.find(line.decode())
    names = ("label", "first", "end", "edits", "likeness")
    return (
        len(words), len(starts), min(starts, default=None), max(starts, default=None), base_labels,
        sorted({*base_labels, *[s[0] for s in spans]}),
        1.0 if starts else max([0.0, *[s[4] for s in spans]]),
        [dict(zip(names, s)) for s in spans],
    )


def scan_licenses(
    docs: DataFrame,
    text: str = "text",
    notices: dict[str, str] | None = None,
    base: dict[str, str] | None = None,
    per_edit: int = 10,
) -> DataFrame:
    """``docs`` with words, exact places, labels, the spans of notices and the likeness of the best one.

    Words are runs of 0-9, a-z (A-Z lower-cased) and everything beyond ASCII; positions count words from 0.
    Texts are read whole, in time that grows with their length. A null text counts as empty: no words, no spans, score 0, null first and last word. Each text is scanned
    whole and alone, so nothing is shuffled, repeated rows get equal results, an empty table stays empty.
    Columns named like a result are replaced.
    """
    notices, base = notices or NOTICES, base or BASE

    def start():
        search = Search(notices, per_edit)

        def work(texts):
            rows = [scanned(t or "", base, search) for t in texts]
            return [list(c) for c in zip(*rows)] or [[] for _ in FIELDS]

        return work

    return add_columns(docs, start, FIELDS, text)
