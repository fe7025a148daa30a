from __future__ import annotations

import random

import pytest

#: The columns of documents and others whose names clash with those that the operators use inside.
ODD_SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, score double, block long, uid long, "
              "n long, h string, sig string, host string, payload string, feats string, `key` string")


def words(seed: int, n: int) -> str:
    r = random.Random(seed)
    return " ".join("".join(r.choice(["th", "en", "or", "ti", "on", "ea", "sh"]) for _ in range(r.randint(1, 4))) for _ in range(n))


def odd_rows() -> list[tuple]:
    tail = (1.0, 2, 3, 4, "h", "s", "x", "p", "f", "k")
    long_text = words(3, 30_000)
    texts = [
        (1, words(1, 120), "en", "a"), (2, words(1, 120), "en", "a"), (2, words(1, 120), "en", "a"), (3, None, "en", "a"), (4, "", "fr", None),
        (5, " \t\n ", None, "b"), (None, words(1, 120), "en", "b"), (6, "Éa ŝ ÅB   ナ ı́ İ it's <|endoftext|> x\x00y 12a", "de", "b"),
        (7, long_text, "en", "c"), (8, "x" * 70_000, "en", "c"), (9, "one two three four", "es", "c"), (10, "ONE two\tthree four", "es", "c"),
        (11, words(5, 200) + " tail", None, None), (12, words(5, 200), "en", ""),
    ]
    return [(i, t, lang, s, len(t or ""), *tail) for i, t, lang, s in texts]


@pytest.fixture(scope="session")
def odd(spark):
    return spark.createDataFrame(odd_rows(), ODD_SCHEMA)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], ODD_SCHEMA)


@pytest.fixture(scope="session")
def odd_labels(spark):
    return spark.createDataFrame([(1, 1, 0, "z"), (2, 1, 0, "z"), (None, 1, 1, "z"), (7, None, None, "z"), (7, 0, 1, "z"), (7, 0, 1, "z"), (12, 1, 0, "z")],
                                 "doc_id long, quality int, toxic int, text string")
