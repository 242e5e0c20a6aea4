import random

import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long, size long, row string, TARGET string, node long, label int, score double"


@pytest.fixture(scope="session")
def docs(spark):
    """Make a documents table from (doc_id, text, source) rows, with extra columns that clash with names used inside."""

    def make(rows):
        full = [(i, t, "en", s, len(t) if t else None, 7, "x", None, 1, 2, 0.5) for i, t, s in rows]
        return spark.createDataFrame(full, DOCS)

    return make


@pytest.fixture(scope="session")
def prose():
    """Random text, near copies included, with nulls, empty and blank texts, one very long text and repeated rows."""
    rng = random.Random(5)
    words = ["".join(rng.choice("abdeghilmnorstuvé") for _ in range(rng.randint(2, 8))) for _ in range(900)]

    def text(n):
        return " ".join(rng.choice(words) + rng.choice(["", "", ".", ",", "\n"]) for _ in range(n))

    rows = [(i, text(rng.randint(1, 120)), f"s{i % 4}") for i in range(120)]
    base = text(150)
    for i in range(60):  # near copies of one text, some of which are linked by way of others only
        changed = base.split(" ")
        for _ in range(rng.randint(0, 9)):
            changed[rng.randrange(len(changed))] = rng.choice(words)
        rows.append((200 + i, " ".join(changed), "hot"))
    rows += [(300 + i, base, "hot") for i in range(20)]
    rows += [(400, None, None), (401, "", "s1"), (402, " \n\t ", None), (403, text(9000), "s2"), (None, text(30), "s3"), (None, None, None)]
    rows += [(405, "Ab ab.", "s1"), (405, "Ab ab.", "s1"), (406, "ha " * 300, "s1"), (407, "ß" * 400, "s2")]
    return rows
