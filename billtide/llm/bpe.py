"""Byte-level BPE: tokens are proposed greedily, checked pair by pair, and merged only where that fails."""

from __future__ import annotations

import heapq
import json
import re
from functools import lru_cache
from itertools import chain, islice

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from tokenizers.pre_tokenizers import ByteLevel

from billtide.llm.rows import add_columns

# ---- fixed value: the pattern that splits text before merges ----
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Characters beyond these blocks, whose classes are settled, are split by the library itself, which knows
#: another edition of Unicode than the pattern's engine.
UNSETTLED = regex.compile(r"[^\u0000-\u052f\u2010-\u2027\u2030-\u205e\u3041-\u3096\u30a1-\u30fa\u4e00-\u9fa5\uac00-\ud7a3]")
NEVER = np.int64(1) << 40
#: What stands between two spaces, and words, whose ids a worker process remembers; it forgets all and learns anew beyond.
REMEMBERED = 300_000
#: Words up to this length are taken so many at a time, longer ones one by one.
SHORT, TOGETHER = 40, 8192
# A space and what follows is a chunk of its own unless more white space follows (by either regular expression engine).
BLANK = r"[\s\x1c-\x1f\x85\xa0\u1680\u180e\u2000-\u200f\u2028-\u202f\u205f-\u2064\u3000\ufeff]"
ODD = re.compile(rf" (?:{BLANK}|\Z)")
CUT = re.compile(rf" (?!{BLANK}|\Z)")


def byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in the vocabulary file: printable Latin-1 for itself, the
    others in order from U+0100."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in set(printable)]
    return {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(others)}


def read_file(path: str):
    """The file, the bytes of each vocabulary entry by its name, and the special tokens."""
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    letters = byte_letters()
    text = {name: bytes(letters[c] for c in name) for name in spec["model"]["vocab"]}
    return spec["model"], text, {t["content"]: t["id"] for t in spec["added_tokens"]}


@lru_cache(maxsize=2)
def token_bytes(path: str) -> list[bytes]:
    """The bytes of each id."""
    model, text, special = read_file(path)
    out = [b""] * (1 + max([*model["vocab"].values(), *special.values()]))
    for name, i in model["vocab"].items():
        out[i] = text[name]
    for content, i in special.items():
        out[i] = content.encode()
    return out


class Bpe:
    """A vocabulary file as lookup tables."""

    def __init__(self, path: str):
        model, text, self.special = read_file(path)
        self.ids = {text[name]: i for name, i in model["vocab"].items()}
        n = 1 + max([*self.ids.values(), *self.special.values()])
        #: Of each start of three bytes: the lengths of longer entries, the longest first.
        lengths: dict[bytes, set[int]] = {}
        for entry in self.ids:
            if len(entry) > 3:
                lengths.setdefault(entry[:3], set()).add(len(entry))
        self.lengths = {start: sorted(found, reverse=True) for start, found in lengths.items()}
        self.merges: dict[tuple[int, int], tuple[int, int]] = {}
        #: Of each token: its two parts, and the rank of the merge that makes it (-1 for bytes).
        self.left, self.right = np.full(n, -1, np.int64), np.full(n, -1, np.int64)
        self.made = np.full(n, -1, np.int64)
        for rank, pair in enumerate(model["merges"]):
            a, b = (text[x] for x in (pair if isinstance(pair, list) else pair.split(" ")))
            i, j, whole = self.ids[a], self.ids[b], self.ids[a + b]
            self.merges[i, j] = rank, whole
            self.left[whole], self.right[whole], self.made[whole] = i, j, rank
        self.n = n
        #: The token of each byte, and the token that the merge of each rank makes.
        self.of_byte = np.array([self.ids.get(bytes([b]), 0) for b in range(256)], np.int64)
        self.whole = np.array([whole for _, whole in self.merges.values()], np.int64)
        keys = np.array([i * n + j for i, j in self.merges], np.int64)
        ranks = np.array([rank for rank, _ in self.merges.values()], np.int64)
        order = np.argsort(keys)
        self.keys, self.ranks = keys[order], ranks[order]
        self.grow_trie()
        self.split = regex.compile(PATTERN)
        self.splitter = ByteLevel(add_prefix_space=False, use_regex=True)
        self.specials = regex.compile("|".join(map(regex.escape, self.special))) if self.special else None

    # ---- speculate ----

    def grow_trie(self) -> None:
        """The entries' common starts as states: ``steps`` (state and byte, sorted), where they lead, the token there."""
        states: dict[bytes, int] = {b"": 0}
        steps: list[tuple[int, int]] = []
        for entry in sorted(self.ids):
            for i in range(1, len(entry) + 1):
                if entry[:i] not in states:
                    states[entry[:i]] = len(states)
                    steps.append((states[entry[: i - 1]] * 256 + entry[i - 1], states[entry[:i]]))
        steps.sort()
        self.steps, self.leads = (np.array(x, np.int64) for x in zip(*steps, strict=True))
        self.token_at = np.full(len(states), -1, np.int64)
        for entry, i in self.ids.items():
            self.token_at[states[entry]] = i

    def greedy_together(self, octets: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """As ``greedy`` for the rows of ``octets``, of ``sizes`` bytes each: padded rows of tokens, and their numbers."""
        n, longest = octets.shape
        out, made = np.zeros((n, longest), np.int64), np.zeros(n, np.int64)
        row = np.flatnonzero(sizes)
        at, end, state = (np.zeros(len(row), np.int64) for _ in range(3))
        token = np.full(len(row), -1, np.int64)
        while len(row):
            inside = at < sizes[row]
            key = state * 256 + octets[row, np.minimum(at, longest - 1)]
            step = np.minimum(np.searchsorted(self.steps, key), len(self.steps) - 1)
            goes = inside & (self.steps[step] == key)
            state = np.where(goes, self.leads[step], 0)
            at = at + goes
            here = np.where(goes, self.token_at[state], -1)
            token, end = np.where(here >= 0, here, token), np.where(here >= 0, at, end)
            stops = np.flatnonzero(~goes)
            out[row[stops], made[row[stops]]] = token[stops]
            made[row[stops]] += 1
            at[stops], token[stops] = end[stops], -1
            going = goes | (at < sizes[row])
            if not going.all():
                row, at, end, state, token = (x[going] for x in (row, at, end, state, token))
        return out, made

    def greedy(self, word: bytes) -> list[int]:
        """Longest vocabulary entry first, from the left."""
        ids, lengths = self.ids, self.lengths
        whole = ids.get(word)
        if whole is not None:
            return [whole]
        out, at, n = [], 0, len(word)
        while at < n:
            left = n - at
            for size in lengths.get(word[at : at + 3], ()):
                if size <= left and (token := ids.get(word[at : at + size])) is not None:
                    break
            else:
                size = min(left, 3)
                while (token := ids.get(word[at : at + size])) is None:
                    size -= 1
            out.append(token)
            at += size
        return out

    # ---- verify ----

    def rank(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Rank of the merge of each pair, NEVER where there is none."""
        key = a * self.n + b
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.ranks[at], NEVER)

    def compatible(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Whether merging the bytes of both tokens side by side ends in just these two tokens.

        Both are taken apart along the border, the later merge first (of equal ones the right one, for
        merging goes from the left). A merge across the border that is due before either side's own next
        merge would have come first, so the pair can't stand.
        """
        a, b = a.copy(), b.copy()
        next_a, next_b = np.full(len(a), NEVER), np.full(len(b), NEVER)
        good = np.ones(len(a), bool)
        open_ = np.arange(len(a))
        while len(open_):
            x, y = a[open_], b[open_]
            r = self.rank(x, y)
            good[open_] &= ~((r < next_a[open_]) & (r <= next_b[open_]))
            made_x, made_y = self.made[x], self.made[y]
            open_ = open_[good[open_] & (np.maximum(made_x, made_y) >= 0)]
            x, y = a[open_], b[open_]
            made_x, made_y = self.made[x], self.made[y]
            first = made_x > made_y
            u, v = open_[first], open_[~first]
            next_a[u], a[u] = made_x[first], self.right[x[first]]
            next_b[v], b[v] = made_y[~first], self.left[y[~first]]
        return good

    # ---- merge exactly ----

    def merge(self, word: bytes) -> list[int]:
        """Merges in order of rank, from the left, with a heap of the pairs that stand."""
        token = [self.ids[word[i : i + 1]] for i in range(len(word))]
        after, before = [*range(1, len(token)), -1], [-1, *range(len(token) - 1)]
        heap: list[tuple[int, int, int, int]] = []

        def offer(i):
            j = after[i]
            if j >= 0 and (found := self.merges.get((token[i], token[j]))):
                heapq.heappush(heap, (found[0], i, token[i], token[j]))

        for i in range(len(token)):
            offer(i)
        while heap:
            _, i, left, right = heapq.heappop(heap)
            j = after[i]
            if token[i] != left or j < 0 or token[j] != right:
                continue
            token[i], token[j] = self.merges[left, right][1], -1
            after[i] = after[j]
            if after[i] >= 0:
                before[after[i]] = i
            offer(i)
            if before[i] >= 0:
                offer(before[i])
        return [t for t in token if t >= 0]

    def merge_together(self, octets: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """As ``merge`` for rows of bytes, one merge of every row at a time: padded rows of tokens, and their numbers."""
        n, longest = octets.shape
        out, made = self.of_byte[octets], sizes.copy()
        at = np.arange(longest)
        rows, tokens, sizes = np.arange(n), out.copy(), sizes.copy()
        ranks = np.full((n, longest), NEVER)
        ranks[:, :-1] = self.rank(tokens[:, :-1], tokens[:, 1:])
        ranks[at >= sizes[:, None] - 1] = NEVER
        while len(rows):
            first = ranks.argmin(1)
            going = ranks[np.arange(len(rows)), first] < NEVER
            if not going.all():
                out[rows[~going]], made[rows[~going]] = tokens[~going], sizes[~going]
                tokens, ranks, sizes, rows, first = (x[going] for x in (tokens, ranks, sizes, rows, first))
            row = np.arange(len(rows))
            tokens[row, first] = self.whole[ranks[row, first]]
            # what stands behind the merged pair moves up
            from_ = np.minimum(at + (at > first[:, None]), longest - 1)
            tokens, ranks = np.take_along_axis(tokens, from_, 1), np.take_along_axis(ranks, from_, 1)
            sizes = sizes - 1
            ranks[:, -1] = NEVER
            after = np.minimum(first + 1, longest - 1)
            ranks[row, first] = np.where(first + 1 < sizes, self.rank(tokens[row, first], tokens[row, after]), NEVER)
            ahead = np.flatnonzero(first > 0)
            ranks[ahead, first[ahead] - 1] = self.rank(tokens[ahead, first[ahead] - 1], tokens[ahead, first[ahead]])
        return out, made

    def verified(self, tokens: np.ndarray, made: np.ndarray) -> np.ndarray:
        """Which rows of proposed tokens stand, since every adjacent pair does."""
        inside = np.arange(tokens.shape[1] - 1) < made[:, None] - 1
        pairs, back = np.unique((tokens[:, :-1] * self.n + tokens[:, 1:])[inside], return_inverse=True)
        bad = np.zeros(inside.shape, bool)
        bad[inside] = ~self.compatible(pairs // self.n, pairs % self.n)[back]
        return ~bad.any(1)

    def encode_words(self, words: list[bytes]) -> list[list[int]]:
        """Ids of each word: proposals stand if every adjacent pair does, the other words are merged."""
        out: list[list[int]] = [[]] * len(words)
        order = sorted(range(len(words)), key=lambda w: len(words[w]))
        short = [w for w in order if len(words[w]) <= SHORT]
        for i in range(0, len(short), TOGETHER):
            batch = short[i : i + TOGETHER]
            longest = max(1, len(words[batch[-1]]))
            octets = np.frombuffer(b"".join([words[w].ljust(longest, b"\0") for w in batch]), np.uint8)
            octets = octets.reshape(len(batch), longest)
            sizes = np.fromiter([len(words[w]) for w in batch], np.int64)
            tokens, made = self.greedy_together(octets, sizes)
            failed = np.flatnonzero(~self.verified(tokens, made))
            if len(failed):
                tokens[failed], made[failed] = self.merge_together(octets[failed], sizes[failed])
            for w, ids, n in zip(batch, tokens.tolist(), made.tolist(), strict=True):
                out[w] = ids[:n]
        for w in order[len(short) :]:
            ids = np.array([self.greedy(words[w])], np.int64)
            stands = self.verified(ids, np.array([ids.shape[1]]))[0]
            out[w] = ids[0].tolist() if stands else self.merge(words[w])
        return out

    def words(self, text: str) -> list[str]:
        if text.isascii() or not UNSETTLED.search(text):
            return self.split.findall(text)
        return [text[a:b] for _, (a, b) in self.splitter.pre_tokenize_str(text)]

    def chunks(self, text: str) -> list[str | bytes]:
        """What stands between single spaces (each as if behind its space), the start as bytes.

        No word reaches over such a space but from its right side, so chunks can be split alone.
        """
        parts = CUT.split(text) if ODD.search(text) else text.split(" ")
        return [parts[0].encode(), *parts[1:]] if parts[0] else parts[1:]

    def split_chunks(self, chunks: list[str | bytes | int]) -> tuple[list[int], list[str | int], np.ndarray]:
        """The words of chunks: in which order the chunks were taken, all their words, and how many each has.

        As chunks can be split alone, they can also be split behind each other.
        """
        plain, odd = [], []
        for i, c in enumerate(chunks):
            settled = type(c) is str and (c.isascii() or not UNSETTLED.search(c))
            (plain if settled else odd).append(i)
        words: list[str | int] = self.split.findall("".join([" " + chunks[i] for i in plain]))
        ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)))
        chunk_ends = np.cumsum(np.fromiter([len(chunks[i]) + 1 for i in plain], np.int64, len(plain)))
        counts = [np.diff(np.searchsorted(ends, chunk_ends, "right"), prepend=0)]
        for i in odd:
            c = chunks[i]
            own = [c] if isinstance(c, int) else self.words(c.decode() if isinstance(c, bytes) else " " + c)
            words += own
            counts.append(np.array([len(own)]))
        return plain + odd, words, np.concatenate(counts)

    def pieces(self, text: str) -> list[str | bytes | int]:
        """Chunks and, where a special token's text stands, its id."""
        if not any(content in text for content in self.special):
            return self.chunks(text)
        out: list[str | bytes | int] = []
        at = 0
        for m in self.specials.finditer(text):
            out += [*self.chunks(text[at : m.start()]), self.special[m[0]]]
            at = m.end()
        return out + self.chunks(text[at:])


class Numbered(dict):
    """Words by the order in which they are asked for."""

    def __missing__(self, word):
        self[word] = n = len(self)
        return n


class Ragged:
    """Rows of different lengths, one behind the other."""

    def __init__(self, rows, kind):
        self.flat = np.fromiter(chain.from_iterable(rows), kind)
        self.sizes = np.fromiter(map(len, rows), np.int64, len(rows))
        self.starts = np.cumsum(self.sizes) - self.sizes

    @staticmethod
    def cut(flat: np.ndarray, offsets: np.ndarray, order: list[int]) -> Ragged:
        """Rows between ``offsets`` of ``flat``, the i-th as row ``order[i]``."""
        made = Ragged([], flat.dtype)
        made.flat = flat
        made.starts, made.sizes = np.empty(len(order), np.int64), np.empty(len(order), np.int64)
        made.starts[order], made.sizes[order] = offsets[:-1], np.diff(offsets)
        return made

    def add(self, other: Ragged) -> None:
        self.starts = np.concatenate([self.starts, other.starts + len(self.flat)])
        self.sizes = np.concatenate([self.sizes, other.sizes])
        self.flat = np.concatenate([self.flat, other.flat])

    def take(self, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The chosen rows behind each other, and where each of them ends."""
        sizes = self.sizes[numbers]
        ends = np.cumsum(sizes)
        at = np.repeat(self.starts[numbers] - (ends - sizes), sizes) + np.arange(ends[-1] if len(ends) else 0)
        return self.flat[at], ends


def bounds(ends: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Offsets of lists in what ``take`` returned; list i has the chosen rows rows[i] to rows[i + 1]."""
    return np.concatenate([[0], ends])[rows]


@lru_cache(maxsize=2)
def load(path: str) -> Bpe:
    return Bpe(path)


@lru_cache(maxsize=2)
def encoder(path: str):
    """What turns a list of texts into an Arrow array of lists of ids.

    There is one per worker process; it remembers chunks and words between calls, also between tasks.
    """
    bpe = load(path)
    numbers, known = Numbered(), Ragged([], np.int32)
    word_numbers, known_words = Numbered(), Ragged([], np.int32)

    def learn(chunks: list[str | bytes | int]) -> None:
        nonlocal word_numbers, known_words
        if len(word_numbers) > REMEMBERED:
            word_numbers, known_words = Numbered(), Ragged([], np.int32)
        order, words, counts = bpe.split_chunks(chunks)
        old = len(word_numbers)
        chosen = np.fromiter(map(word_numbers.__getitem__, words), np.int64, len(words))
        fresh = list(islice(word_numbers, old, None))
        made = iter(bpe.encode_words([w.encode() for w in fresh if isinstance(w, str)]))
        known_words.add(Ragged([[w] if isinstance(w, int) else next(made) for w in fresh], np.int32))
        ids, ends = known_words.take(chosen)
        known.add(Ragged.cut(ids, bounds(ends, np.concatenate([[0], np.cumsum(counts)])), order))

    def work(texts: list[str | None]) -> pa.Array:
        nonlocal numbers, known
        if len(numbers) > REMEMBERED:
            numbers, known = Numbered(), Ragged([], np.int32)
        chunks: list[str | bytes | int] = []
        rows = [0]
        for text in texts:
            if text:
                chunks += bpe.pieces(text)
            rows.append(len(chunks))
        old = len(numbers)
        chosen = np.fromiter(map(numbers.__getitem__, chunks), np.int64, len(chunks))
        learn(list(islice(numbers, old, None)))
        ids, ends = known.take(chosen)
        offsets = bounds(ends, np.array(rows)).astype(np.int32)
        return pa.ListArray.from_arrays(pa.array(offsets), pa.array(ids, pa.int32()))

    return work


def decoder(path: str):
    """What turns an Arrow array of lists of ids into an Arrow array of texts."""
    tokens = Ragged(token_bytes(path), np.uint8)

    def work(lists: pa.Array) -> pa.Array:
        # a null list has no ids either
        offsets, ids = lists.offsets.to_numpy(), lists.values.to_numpy()
        octets, ends = tokens.take(ids[offsets[0] : offsets[-1]])
        cuts = bounds(ends, offsets - offsets[0]).astype(np.int32)
        text = pa.StringArray.from_buffers(len(lists), pa.py_buffer(cuts), pa.py_buffer(octets))
        try:
            text.validate(full=True)
        except pa.ArrowInvalid:
            raw = octets.tobytes()
            text = pa.array([raw[a:b].decode("utf-8", "replace") for a, b in zip(cuts, cuts[1:])])
        return text

    return work


IDS = ("ids", "array<int>", pa.list_(pa.int32()))
DECODED = ("decoded", "string", pa.string())


def encode(docs: DataFrame, path: str, text: str = "text") -> DataFrame:
    """``docs`` with ``ids``, each whole text's token ids by the vocabulary file at ``path``.

    Special tokens' texts become their ids, nothing is added, cut or filled up. A null or empty text has
    no ids. Each text is encoded alone, so nothing is shuffled; repeated rows get equal ids, an empty table
    stays empty, a column named ``ids`` is replaced. The file must be at ``path`` on every executor.
    """

    def start():
        work = encoder(path)
        return lambda texts: [work(texts)]

    return add_columns(docs, start, [IDS], text)


def decode(df: DataFrame, path: str, ids: str = "ids") -> DataFrame:
    """``df`` with ``decoded``, the text of each row's ids; bytes that are no UTF-8 become U+FFFD.

    Special tokens are written out. No ids, or null, give the empty text. Ids outside the vocabulary raise.
    A column named ``decoded`` is replaced.
    """

    def start():
        work = decoder(path)
        return lambda lists: [work(lists)]

    return add_columns(df, start, [DECODED], ids, as_arrow=True)


def round_trip(docs: DataFrame, path: str, text: str = "text") -> DataFrame:
    """``docs`` with ``ids`` and ``decoded``, by ``encode`` and then ``decode``, in one Python worker."""

    def start():
        to_ids, to_text = encoder(path), decoder(path)

        def work(texts):
            ids = to_ids(texts)
            return [ids, to_text(ids)]

        return work

    return add_columns(docs, start, [IDS, DECODED], text)
