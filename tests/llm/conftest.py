from __future__ import annotations

import random

import pytest

TYPES = "doc_id long, text string, lang string, source string, n_chars long"
WORDS = {
    "en": "the of and house water with from that river stone light green".split(),
    "fr": "le les des maison eau avec pour dans rivière pierre lumière été".split(),
    "de": "der die und haus wasser mit von für fluss stein straße grün".split(),
}


def prose(seed: int, lang: str, words: int) -> str:
    r = random.Random(seed)
    out = []
    for i in range(words):
        w = r.choice(WORDS[lang]) + (r.choice(WORDS[lang]) if r.random() < 0.5 else "")
        out.append(w + (".\n" if i % 12 == 11 else ""))
    return " ".join(out) + "."


def odd_rows() -> list[tuple]:
    """Nulls in every column, empty and very long texts, ties, repeated rows."""
    rows = [(i, prose(i, ("en", "fr", "de")[i % 3], 40 + i % 7), ("en", "fr", "de")[i % 3], f"s{i % 4}", 1) for i in range(60)]
    rows += [
        (100, None, "en", "s1", None), (101, "", "fr", "s2", 0), (102, " \t\n ", "de", None, 3), (103, "12 34 !?", None, "s0", 1),
        (None, prose(1, "en", 60), "en", "s1", 5), (104, prose(2, "fr", 30000), "fr", None, 9), (105, "x" * 70000, "en", "s3", 1),
        (106, "A\x00b ▁▁ É漢字 😀 \u200b  <s> a\u0301", None, "s2", None), (0, prose(0, "en", 40), "en", "s0", 1),
        (107, prose(5, "de", 45), "de", "s0", 1), (108, prose(5, "de", 45), "de", "s0", 1),
    ]
    return rows + rows[-2:] + [rows[64]]


@pytest.fixture(scope="session")
def odd(spark):
    return spark.createDataFrame(odd_rows(), TYPES)


@pytest.fixture(scope="session")
def clashing(spark, odd):
    """Extra columns under names that operators use themselves."""
    from pyspark.sql import functions as F

    names = "key row h n size kept cleaned copies taken score lang_pred fp fingerprint bucket held u p _key _row _words n_words target".split()
    return odd.withColumns({c: F.lit("x") for c in names})


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], TYPES)
