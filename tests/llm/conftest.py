import random

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, id string, tokens string, start int, block int, _at int, family int, n int"


def words(rng, n, pool=("ba", "ke", "lo", "mi", "nu", "sha", "tor", "wen")):
    return " ".join("".join(rng.choice(pool) for _ in range(rng.randint(1, 3))) for _ in range(n))


def odd_rows():
    """Nulls in any column, empty, blank and very long texts, ties, repeats, copies, near copies; clashing extra columns."""
    rng = random.Random(7)
    base, long = words(rng, 80), words(rng, 6000)
    texts = [None, "", " \n\t", "a", "a", "A ", "two words", "two  words", base, base, base.replace(" ", "\n", 3), base + " tail", " ".join(base.split()[1:]), long, long + " x", "ünï çödé 日本", "!!! ???", "1 2 3 4 5"]
    texts += [words(rng, rng.randint(1, 60)) for _ in range(20)]
    rows = [(i, t, ("en", "fr", None)[i % 3], (None, "s1", "s1", "s2")[i % 4], None) for i, t in enumerate(texts)]
    rows += [rows[8], rows[3], (None, base, None, None, 5), (None, None, None, None, None)]
    return [(*r, "x", None, 1, 2, 3, 4, 5) for r in rows]


@pytest.fixture(scope="session")
def docs(spark):
    return spark.createDataFrame(odd_rows(), SCHEMA).repartition(3)


@pytest.fixture(scope="session")
def empty_docs(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def sf():
    return "/root/testdata/sf0.001"
