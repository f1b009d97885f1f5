import random

import pytest

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"
PROSE = "the quick brown fox jumps over a lazy dog while nine wise owls look on from old oak trees".split()


def prose(seed, n):
    r = random.Random(seed)
    return ". ".join(" ".join(r.choices(PROSE, k=9)).capitalize() for _ in range(n // 9 + 1)) + "."


LONG = prose(1, 3000)
TEXTS = [
    None,
    "",
    " \t\n ",
    "one",
    "two words",
    prose(2, 120),
    prose(2, 120),  # a copy
    prose(2, 120) + " and a tail",
    LONG,
    LONG[:5000] + "X" + LONG[5000:],
    "a" * 3000,
    "Home | About | Contact | Login\n" + prose(3, 90) + "\nAll rights reserved.\n" + prose(6, 90),
    "WOW!! SO!! LOUD!! THIS!! LINE!! IS!!\n" * 20,
    "spam " * 300,
    "Écrit à l'été: größe straße ñandú " * 12,
    "mail a.b@mail.example.com or 10.0.0.1, card 4111 1111 1111 1111, call +1 (415) 555-2671 now " + prose(4, 60),
    "Licensed under the Apache Licence, Version 2.0. cc by cc by General Public License",
    "idiot. you are stupid trash. " + prose(5, 60),
    "<|endoftext|>special<|endoftext|>  tokens\n\n\n  'll 've don't 12345 ³   　 𝒳𝒴",
    "\x00\x1f odd \x85 marks ​﻿",
]


@pytest.fixture(scope="session")
def awkward(spark):
    """Documents with nulls in every column, empty, long, repeated and equal texts."""
    rows = [(i, t, "en", f"src{i % 3}", len(t or "")) for i, t in enumerate(TEXTS)]
    rows += [rows[5], (100, TEXTS[5], None, None, None)]
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)
