import random

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, score string, slot string, secrets string, node string, rank string"


def words(rng, n):
    return " ".join("".join(rng.choice("abdeginorst") for _ in range(rng.randint(2, 6))) for _ in range(n))


@pytest.fixture(scope="session")
def odd_rows():
    """Documents with nulls, empty and long texts, copies, near copies, repeated rows and clashing columns."""
    rng = random.Random(5)
    base = words(rng, 300)
    edited = base.split()
    edited[100] = "changed"
    near = " ".join(edited)
    shared = words(rng, 40)
    long = words(rng, 30_000)
    texts = [
        "", None, " \n\t ", "one", "Two words", "three short words", base, base, near, base.upper(), long, long,
        words(rng, 50) + " " + shared + " " + words(rng, 50), words(rng, 30) + "\n" + shared, "la " * 500,
        "\x1c  odd spaces é 日本語 \U0001f600", words(rng, 120),
    ]
    rows = [(k, t, "en", f"src{k % 3}", None if t is None else len(t), "a", "b", "c", "d", "e") for k, t in enumerate(texts)]
    rows += [rows[6], rows[0], (None, base, None, None, None, None, None, None, None, None)]
    rows += [(40, words(rng, 60), "en", None, 5, "a", "b", "c", "d", "e"), (41, "", None, "src1", 0, "a", "b", "c", "d", "e")]
    return rows


@pytest.fixture(scope="session")
def odd(spark, odd_rows):
    return spark.createDataFrame(odd_rows, SCHEMA)


@pytest.fixture(scope="session")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def labels(spark, odd_rows):
    rows = [(r[0], k % 2, (k + 1) % 2) for k, r in enumerate(odd_rows)] + [(3, None, None), (3, 1, 1), (99, 1, 0)]
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")
