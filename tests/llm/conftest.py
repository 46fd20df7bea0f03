import random

import pytest


@pytest.fixture(scope="session")
def documents(spark):
    """A frame (doc_id, text, ...) from rows of (id, text), with extra columns whose names clash with working names."""

    def make(rows, partitions=3):
        frame = spark.createDataFrame(
            [(i, t, "x", 1.5, 7, "y", "z", 0) for i, t in rows],
            "doc_id long, text string, key string, score double, n long, cls string, words string, part int",
        )
        return frame.repartition(partitions)

    return make


def sentence(rng: random.Random, n: int, words: int = 400) -> list[str]:
    return [f"w{int(rng.paretovariate(0.6)) % words}" for _ in range(n)]


def edited(rng: random.Random, words: list[str], times: int) -> list[str]:
    out = list(words)
    for _ in range(times):
        out[rng.randrange(len(out))] = f"e{rng.randrange(10**6)}"
    return out
