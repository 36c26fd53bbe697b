import random

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, row string, size string, key string, score int, kept string"


def sentence(rng, n):
    return " ".join("".join(rng.choice("abcdefghij") for _ in range(rng.randint(1, 8))) for _ in range(n))


@pytest.fixture(scope="session")
def odd_rows():
    """Nulls in every column, empty and white texts, a long text, copies, near copies, repeated rows, shared passages."""
    rng = random.Random(5)
    rows = []
    passage = sentence(rng, 60)
    for i in range(60):
        body = sentence(rng, rng.randint(1, 160))
        if i % 5 == 0:
            body = f"{body}\n{passage}\n{sentence(rng, 20)}"
        rows.append((i, body, ["en", "de", None][i % 3], ["a", "b", None, "c"][i % 4], len(body)))
    base = sentence(rng, 150)
    for k in range(8):
        w = base.split(" ")
        w[k * 7] = "changed"
        rows.append((100 + k, " ".join(w), "en", "a", 1))
    long = "\n".join(sentence(rng, 12) for _ in range(3000)) + "x" * 40_000 + " é ñ " + "日本語" * 900
    rows += [
        (200, None, None, None, None), (201, "", "en", "a", 0), (202, " \n\t ", "en", "a", 4), (203, "one", "en", "b", 3), (204, "one", "en", "b", 3), (205, long, "fr", "a", len(long)), (206, "Za 12 \x1c\x85\xa0 q", "en", "c", 9),
        (207, "ab " * 400, "en", "c", 1200), (208, "### $$$ |||", "en", "c", 11), (209, "\0" * 300, "en", "c", 300), (210, "é" * 333, "fr", "b", 333),
    ]
    rows += [rows[0], rows[0], rows[-1]]
    return rows


@pytest.fixture(scope="session")
def odd(spark, odd_rows):
    return spark.createDataFrame([(*r, "x", "y", "z", 7, "w") for r in odd_rows], SCHEMA).repartition(3).persist()


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def no_ids(spark):
    return spark.createDataFrame([(None, t, None, None, None, "x", "y", "z", 7, "w") for t in ("alpha beta gamma delta epsilon zeta", "alpha beta gamma delta epsilon zeta", None)], SCHEMA)
