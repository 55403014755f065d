import random

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, salt string"


def words(rng, n, letters="abcdefgh"):
    return " ".join("".join(rng.choice(letters) for _ in range(rng.randint(2, 6))) for _ in range(n))


@pytest.fixture(scope="session")
def hostile():
    """Nulls, empties, white space, copies, near copies, repeated rows, long texts, marks beyond ASCII, shared passages."""
    rng = random.Random(7)
    passage, base = words(rng, 70), words(rng, 120)
    near = base.split()
    near[60] = "changed"
    long_ = words(rng, 9000)
    texts = [
        None, "", " \t\n", "one", "one two", "One  Two\tthree", base, base, base.upper(), " ".join(near), long_, words(rng, 40) + " " + passage + " " + words(rng, 30),
        words(rng, 25) + "\n" + passage + "\n" + words(rng, 60), "é ß ñ 中文 \U0001f600 " * 30, "a " * 400, "ab" * 600, "x", "idiot fool " + words(rng, 20), passage,
        *(words(rng, rng.randint(1, 90)) for _ in range(12)),
    ]
    rows = [(k * 3, t, "en", [None, "a", "b", "B", "é"][k % 5], len(t or ""), "z") for k, t in enumerate(texts)]
    rows += [rows[6], (None, base, "en", "a", len(base), "z"), (None, None, None, None, None, None), (rows[3][0], "another of this id", "en", "a", 18, "z")]
    rng.shuffle(rows)
    return rows


@pytest.fixture(scope="session")
def docs(spark, hostile):
    return spark.createDataFrame(hostile, SCHEMA).repartition(3)


@pytest.fixture(scope="session")
def none(spark):
    return spark.createDataFrame([], SCHEMA)
