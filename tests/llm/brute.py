"""The operators' results the plain way, for small tables."""

import hashlib
import re
from collections import Counter

import numpy as np
import public_tokenizers
import xxhash
from tokenizers import Tokenizer

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def sha256(text):
    return hashlib.sha256(text.encode() if isinstance(text, str) else text).hexdigest()


def lower_ascii(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def repeated_text(rows, length=100):
    """doc_id: bytes, removed bytes, runs, hash of the rest; rows in order of doc_id."""
    seen, out = set(), {}
    for doc, text in rows:
        octets = (text or "").encode()
        covered = bytearray(len(octets))
        for i in range(len(octets) - length + 1):
            if octets[i : i + length] in seen:
                covered[i : i + length] = b"\1" * length
            else:
                seen.add(octets[i : i + length])
        runs = sum(c and not (i and covered[i - 1]) for i, c in enumerate(covered))
        kept = bytes(x for x, c in zip(octets, covered) if not c)
        out[doc] = (len(octets), sum(covered), runs, sha256(kept))
    return out


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        v = int(c) * (1 + i % 2)
        total += v - 9 * (v > 9)
    return total % 10 == 0


def base_spans(text):
    text = text or ""
    digits = lambda m: re.sub("[^0-9]", "", m[0])
    patterns = [
        ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda m: True),
        ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda m: all(int(p) <= 255 for p in m[0].split("."))),
        ("card", r"[0-9]([\x20-]?[0-9])+", lambda m: 13 <= len(digits(m)) <= 19 and luhn(digits(m))),
        ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", lambda m: 9 <= len(digits(m)) <= 15),
    ]
    return [(k, *m.span()) for k, p, good in patterns for m in re.finditer(p, text) if good(m)]


def base_places(text):
    phrases = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}
    words = re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", lower_ascii(text or ""))
    hits = [
        (i, label)
        for phrase, label in phrases.items()
        for i in range(len(words))
        if words[i : i + phrase.count(" ") + 1] == phrase.split()
    ]
    starts = [i for i, _ in hits]
    labels = ",".join(sorted({label for _, label in hits}))
    return (len(words), len(hits), min(starts, default=None), max(starts, default=None), labels)


def near_vectors(rows, threshold=0.98):
    """vec_id: links, smallest reachable id, kept; rows (vec_id, embedding, label)."""
    good = []
    for vec, e, label in rows:
        usable = label is not None and e and all(x is not None and np.isfinite(x) for x in e) and any(e)
        if usable and vec is not None:
            good.append((vec, np.array(e, float), label))
    links = {vec: set() for vec, _, _ in rows}
    count = Counter()
    for i, (a, x, la) in enumerate(good):
        for j, (b, y, lb) in enumerate(good):
            if i != j and la == lb and len(x) == len(y):
                if x @ y / np.sqrt(x @ x) / np.sqrt(y @ y) >= threshold:
                    links[a].add(b)
                    count[i] += 1
    least = components(links)
    return {vec: least.get(vec, vec) for vec in links}, {good[i][0]: n for i, n in count.items()}


def components(links):
    least = {}
    for start in links:
        seen, todo = {start}, [start]
        while todo:
            for other in links[todo.pop()] - seen:
                seen.add(other)
                todo.append(other)
        least[start] = min(x for x in seen if x is not None) if any(x is not None for x in seen) else None
    return least


def fingerprint(text, shingle=3):
    words = WORD.findall(lower_ascii(text or ""))
    if not words:
        return 0
    n = max(1, len(words) - shingle + 1)
    hashes = [xxhash.xxh64_intdigest(" ".join(words[i : i + shingle]).encode(), 42) for i in range(n)]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def near_texts(rows, reach=2):
    """doc_id: fingerprint, smallest reachable id."""
    marks = {doc: fingerprint(text) for doc, text in rows}
    links = {a: {b for b, y in marks.items() if (x ^ y).bit_count() <= reach} for a, x in marks.items()}
    least = components(links)
    return {doc: (f"{marks[doc]:016x}", least[doc]) for doc in marks}


def tokens(rows):
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    library.no_truncation()
    library.no_padding()
    out = {}
    for doc, text in rows:
        ids = library.encode(text or "", add_special_tokens=False).ids
        decoded = library.decode(ids, skip_special_tokens=False)
        out[doc] = (len(ids), sha256(",".join(map(str, ids))), sha256(decoded))
    return out
