from __future__ import annotations

import random

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, rank int, label string, host string, spot long, "
SCHEMA += "score string, bits string, lang_pred string, text_sha256 string, text_md5 string"


def document(doc_id, text, lang="en"):
    """A document with further columns whose names the operators use inside."""
    return (doc_id, text, lang, "s", len(text or ""), 1, "x", None, 7, "a", "b", "xx", "not a hash", None)


@pytest.fixture(scope="session")
def words():
    rng = random.Random(3)
    stems = ["".join(rng.choice("abcdefghijklmnoprstuvz") for _ in range(rng.randint(2, 8))) for _ in range(400)]
    return lambda n, seed: [random.Random(seed * 1000 + i).choice(stems) for i in range(n)]


@pytest.fixture(scope="session")
def texts(words):
    """Null, empty, blank, short, very long, repeated and nearly equal texts, and shared passages."""
    passage = " ".join(words(60, 99))
    long = " ".join(words(9000, 1))
    near = words(120, 2)
    return [
        None, "", " \t\n", "one", "One", "two words", long, long, " ".join(near), " ".join(near[:60] + ["new"] + near[61:]),
        " ".join(words(40, 5)) + "\n" + passage, passage + " " + " ".join(words(30, 6)), "x " + passage + " y " + passage,
        "é à ñ " * 30, " ".join(words(200, 7)), "a  b c\x1cd", " ".join(["again"] * 100),
    ]


@pytest.fixture(scope="session")
def documents(spark, texts):
    rows = [document(i * 3, t) for i, t in enumerate(texts)]
    rows += [rows[8], document(None, "no id here"), document(1000, None, None)]
    return spark.createDataFrame(rows, SCHEMA).repartition(3).cache()


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)
