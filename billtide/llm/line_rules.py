"""Line-first cleaning: rules judge lines, failing lines go, texts that lose too much are rejected."""

from __future__ import annotations

import re
from collections import Counter

import pyarrow as pa
from pyspark.sql import DataFrame

from billtide.llm.rows import add_columns

# ---- fixed values: what the counts look at ----
SYMBOLS = re.compile(rb"[#*$%&|<>]")
LEAST_WORDS = 50
MOST_REPEATED_PERCENT = 50

# ---- fixed values: phrases of page furniture, lower case ----
BOILERPLATE = re.compile(
    rb"\b(?:(?:accept|allow|manage|reject|use|uses) (?:all )?cookies|cookie (?:policy|settings|notice|consent)"
    rb"|(?:enable|requires?) javascript|javascript is (?:disabled|required)|privacy policy|terms of (?:use|service)"
    rb"|subscribe (?:to|now|today)|our newsletter|click here|read more|share this|all rights reserved|skip to content)\b"
)
# ---- fixed values: words that are page furniture in very short lines, lower case ----
BUTTONS = re.compile(rb"\b(?:cookies|javascript|sign in|log ?in|subscribe|newsletter)\b")
#: Words a line may have to count as page furniture; longer ones are prose about the subject.
BOILERPLATE_WORDS, BUTTON_WORDS = 15, 3
SEPARATORS = frozenset(s.encode() for s in "| » › · •".split())
#: What words of shouted or damaged lines end in.
MARKS = tuple(m.encode() for m in "# * $ % & < > !! ?? !?".split())

FIELDS = [
    ("n_words", "bigint", pa.int64()),
    ("word_chars", "bigint", pa.int64()),
    ("n_symbols", "bigint", pa.int64()),
    ("n_dup_lines", "bigint", pa.int64()),
    ("n_repeat_words", "bigint", pa.int64()),
    ("base_failed", "boolean", pa.bool_()),
    ("n_failed_lines", "bigint", pa.int64()),
    ("lost_share", "double", pa.float64()),
    ("kept", "boolean", pa.bool_()),
    ("cleaned", "string", pa.string()),
]


def repeated_words(words: list) -> int:
    """Words in a window of three words that occurs twice or more."""
    windows = list(zip(words, words[1:], words[2:]))
    often = Counter(windows)
    if len(often) == len(windows):
        return 0
    covered = upto = 0
    for i, window in enumerate(windows):
        if often[window] > 1:
            covered += i + 3 - max(i, upto)
            upto = i + 3
    return covered


def line_fails(line: bytes, words: list[bytes], symbol_share: float, separator_share: float) -> bool:
    """The rules for one line that has words.

    Navigation: at least two separators, and at least ``separator_share`` of the words are
    separators; rows of a table, which begin and end with one, are not. Punctuation: more than ``symbol_share`` of the words, of five or more, end in a
    symbol or in doubled marks. Boilerplate: a short line with a phrase of page furniture, or
    little more than the word on a button.
    """
    bars = sum(map(SEPARATORS.__contains__, words))
    in_table = words[0] == words[-1] == b"|"
    if bars >= 2 and bars >= separator_share * len(words) and not (in_table and len(words) > 2):
        return True
    if len(words) >= 5 and sum(w.endswith(MARKS) for w in words) > symbol_share * len(words):
        return True
    if len(words) > BOILERPLATE_WORDS:
        return False
    low = line.lower()
    return bool(BOILERPLATE.search(low)) or len(words) <= BUTTON_WORDS and bool(BUTTONS.search(low))


def chars(words: list[bytes]) -> int:
    joined = b"".join(words)
    return len(joined) if joined.isascii() else len(joined.decode())


def judged(text: str, most_lost: float, symbol_share: float, separator_share: float) -> tuple:
    """One text's values for FIELDS, in their order."""
    raw = text.encode()
    words = raw.split()  # bytes split at \x20 and \x09-\x0D, and nowhere else
    word_chars = chars(words)
    seen, kept, dup, failed, lost = set(), [], 0, 0, 0
    for line in raw.split(b"\n"):
        own = line.split()
        if own:
            dup += line in seen
            seen.add(line)
            if line_fails(line, own, symbol_share, separator_share):
                failed += 1
                lost += chars(own)
                continue
        kept.append(line)
    repeated = repeated_words(words)
    base_failed = len(words) < LEAST_WORDS or 100 * repeated > MOST_REPEATED_PERCENT * len(words)
    share = lost / word_chars if word_chars else 0.0
    return (
        len(words), word_chars, len(SYMBOLS.findall(raw)), dup, repeated, base_failed, failed, share,
        not base_failed and share <= most_lost, b"\n".join(kept).decode() if failed else text,
    )


def clean_lines(
    docs: DataFrame,
    text: str = "text",
    most_lost: float = 0.3,
    symbol_share: float = 0.3,
    separator_share: float = 0.15,
) -> DataFrame:
    """``docs`` with the counts of each text, its cleaned text and whether it is kept.

    A null text counts as empty: no words, not kept, cleaned to the empty text. Lines without words
    are never removed or counted. Repeated rows are judged alike, each for itself; an empty table
    gives an empty one. Columns that have a result's name are replaced. Nothing is shuffled: each
    text is judged alone, whole.
    """

    def start():
        def work(texts):
            rows = [judged(t or "", most_lost, symbol_share, separator_share) for t in texts]
            return [list(c) for c in zip(*rows)] or [[] for _ in FIELDS]

        return work

    return add_columns(docs, start, FIELDS, text)
