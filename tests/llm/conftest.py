import random

import pytest

from courierlake.llm.common import ship

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, row long, data string, label string"


@pytest.fixture(scope="session", autouse=True)
def shipped(spark):
    ship(spark)


def prose(seed, n, size=400):
    """``n`` words drawn from ``size`` invented ones."""
    rng = random.Random(seed)
    return " ".join(f"w{rng.randrange(size)}x{'abcdefg'[rng.randrange(7)]}" for _ in range(n))


def corpus():
    """Near and exact copies, a shared passage, repeats, junk, nulls, ties."""
    base, passage = prose(1, 300), prose(2, 80)
    near = base.split()
    near[100] = "CHANGED"
    texts = [base, base.upper(), " ".join(near), prose(3, 150) + "\n" + passage + "\n" + prose(4, 120),
             passage + " " + prose(5, 200), None, "", " \n\t ", "one two three", "one two three", "!!! ???",
             prose(6, 40), prose(7, 30) * 30, "é" * 300 + " fin " + "é" * 300, prose(8, 20000), base]
    rows = [(i, t, "en" if i % 3 else None, None if i == 4 else "h", None if t is None else len(t), 7, "x", "y")
            for i, t in enumerate(texts)]
    return rows + [rows[0], (None, prose(9, 60), "en", "h", None, 7, "x", "y"), (None, None, None, None, None, 7, "x", "y")]


@pytest.fixture(scope="session")
def docs(spark):
    """The corpus, with columns that clash with names used inside operators."""
    return spark.createDataFrame(corpus(), SCHEMA).repartition(3)


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)
