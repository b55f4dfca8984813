"""Helpers for the operators' tests: small tables with awkward rows."""

from __future__ import annotations

import random

import pytest

WORDS = "the of and to in that is was for on with as be by at from have or one had not but what all were".split()


def prose(r: random.Random, n: int) -> str:
    return " ".join(r.choice(WORDS) + r.choice(["", "a", "en", "ing", "or", "st"]) + r.choice("abcdefgh") for _ in range(n))


@pytest.fixture(scope="session")
def documents(spark):
    """Texts with copies, near copies, nulls, blanks and one long text; clashing extra columns."""
    r = random.Random(5)
    rows, base = [], [prose(r, n) for n in (3, 8, 12, 25, 60, 200, 700)]
    for t in base:
        rows.append(t)
        for edits in (0, 1, 1, 2, 3):
            w = t.split()
            for _ in range(edits):
                w[r.randrange(len(w))] = "edit" + str(r.randrange(50))
            rows.append(" ".join(w))
    hub = prose(r, 150).split()
    for k in range(40):  # a large group of near copies, some beyond the threshold
        w = list(hub)
        for _ in range(r.choice([1, 1, 2, 3, 5])):
            w[r.randrange(len(w))] = f"x{r.randrange(9)}"
        rows.append(" ".join(w))
    rows += [base[5].upper(), "  " + base[5].replace(" ", "\n\t "), "", " \n", None, None, "one", "one", "ONE two", "one two",
             "É È é", "é è é", prose(r, 6000), "word " * 300]
    data = [(i, t, "en", f"src{i % 3}" if i % 7 else None, len(t or ""), 1, "x", 2) for i, t in enumerate(rows)]
    data.append((None, base[4], None, "src1", 1, 1, "x", 2))
    data.append((3, rows[3], "en", "src0", 1, 1, "x", 2))  # a repeated row
    return spark.createDataFrame(
        data, "doc_id long, text string, lang string, source string, n_chars long, n long, h string, copies int").repartition(3)


@pytest.fixture(scope="session")
def no_documents(documents):
    return documents.limit(0)
