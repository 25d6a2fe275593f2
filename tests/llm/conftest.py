import random

import pytest

#: Short tables with what inputs may hold: nulls, empty texts, ties, repeated rows and
#: columns whose names clash with those of the operators.
ODD = [
    (1, "The cat sat on the mat", "x"), (1, "The cat sat on the mat", "x"), (2, None, None), (3, "", "y"),
    (4, " \t\n ", "y"), (None, "The cat sat on the mat", "z"), (5, "word", None), (6, "worté \U0001f600 \x00", "y"),
]


@pytest.fixture(scope="session")
def odd(spark):
    rows = [(i, t, s, 1, 2.0, "q") for i, t, s in ODD]
    return spark.createDataFrame(rows, "doc_id long, text string, source string, id long, score double, node string")


@pytest.fixture(scope="session")
def empty(odd):
    return odd.limit(0)


@pytest.fixture()
def rng():
    return random.Random(7)
