"""Fixtures of the training-data operators: rows that try every odd case."""
import random

import pytest

WORDS = ("the of and to in that was his he it with is for as had you not be her on at by which have or from this him "
         "but all she they were my are me one their so an said them we who would been will no when there if more out").split()


def prose(rng, n):
    return " ".join(rng.choice(WORDS) + str(rng.randrange(30)) for _ in range(n))


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Null and repeated ids, null, empty, blank and very long texts, copies, clashing column names."""
    rng = random.Random(5)
    base = prose(rng, 300)
    words = base.split()
    rows = [(1, base), (2, base), (2, base), (None, base), (3, None), (4, ""), (5, " \t\n "), (6, "one two"),
            (7, "One  TWO"), (8, "one two three four five"), (9, prose(rng, 40000)), (10, "ä€😀 " * 20),
            (None, None), (11, " ".join(["loop"] * 500)), (12, "x" * 50000)]
    for i in range(30):
        w = list(words)
        for _ in range(i):
            w[rng.randrange(len(w))] = prose(rng, 1)
        rows.append((100 + i, " ".join(w)))
    rows.append((100, prose(rng, 50)))  # an id with two texts
    cols = "doc_id long, text string, id long, n long, y int, row long, base string, score double, rid long, comp long"
    return spark.createDataFrame([(i, t, 7, 7, 7, 7, "b", 0.5, 7, 7) for i, t in rows], cols).repartition(5)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], "doc_id long, text string")
