from __future__ import annotations

import os
import random

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
os.environ["PYTHONPATH"] = os.pathsep.join([ROOT, os.environ.get("PYTHONPATH", "")])  # for the workers of a session started later

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def prose():
    """Seeded texts of a few hundred different words."""
    rng = random.Random(5)
    words = ["".join(rng.choice("abcdefghilmnorstu") for _ in range(rng.randint(2, 9))) for _ in range(300)]

    def text(n: int, seed: int) -> str:
        r = random.Random(seed)
        out = []
        for i in range(n):
            out.append(r.choice(words) + ("." if i % 9 == 8 else "") + ("\n" if i % 27 == 26 else " "))
        return "".join(out).strip() + "."

    return text


@pytest.fixture(scope="session")
def odd_docs(spark, prose):
    """Nulls in every column, empty, blank and very long texts, ties, repeated rows, a clashing extra column."""
    long_text = prose(30_000, 1)
    rows = [(1, None, "en", "a", None), (2, "", None, "a", 0), (3, " \n\t ", "en", None, 4), (4, "One.", "en", "b", 4), (5, long_text, "en", "a", len(long_text)),
            (6, prose(120, 2), "en", "b", 9), (6, prose(120, 2), "en", "b", 9), (7, prose(120, 2), "en", None, 9), (None, prose(130, 3), "en", "a", 9),
            (8, "word " * 400, "de", "a", 2000), (9, "é ß 漢字 \U0001f600 <|endoftext|>", "de", "b", 9), (10, "x" * 5000, "en", "a", 5000)]
    rows += [(20 + i, prose(60 + i, 100 + i), "en", "ab"[i % 2], 9) for i in range(40)]
    return spark.createDataFrame([(*r, i) for i, r in enumerate(rows)], DOCS + ", piece long")


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], DOCS)
