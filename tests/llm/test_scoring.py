import collections
import math
import random

import pytest

from stallbook.llm import lm_scoring
from tests.llm.conftest import sentence


def brute(rows, targets):
    """Losses by counting each document's complement from scratch."""
    words = [(t or "").lower().split() for _, t in rows]

    def counts(skip, only):
        single, pair, n = collections.Counter(), collections.Counter(), 0
        for k, own in enumerate(words):
            if k != skip and (not only or rows[k][0] in targets):
                single.update(own)
                single.update(["<s>"] * bool(own))
                pair.update(zip(["<s>", *own], own))
                n += len(own)
        return single, pair, n

    out = []
    for k, own in enumerate(words):
        every, goal = counts(k, False), counts(k, True)
        losses = [0.0, 0.0]
        for before, word in zip(["<s>", *own], own):
            base = max(every[0][word], 0.5) / max(every[2], 1)
            lower = lm_scoring.DEEP * goal[0][word] / goal[2] + (1 - lm_scoring.DEEP) * base if goal[2] else base
            for j, (model, single) in enumerate(((goal, lower), (every, base))):
                context = model[0][before]
                p = lm_scoring.DEEP * model[1][before, word] / context + (1 - lm_scoring.DEEP) * single if context else single
                losses[j] -= math.log(p)
        out.append((rows[k][0], len(own), *(None if not own else round(x / len(own), 9) for x in losses)))
    return out


def fixture():
    rng = random.Random(8)
    rows = [(i, " ".join(sentence(rng, rng.randrange(1, 60), 40))) for i in range(40)]
    return rows + [(40, None), (41, ""), (42, "\n "), (None, "w1 w2"), (None, None), (43, "w1 " * 5000), (7, rows[7][1]), (44, rows[7][1])]


@pytest.mark.parametrize("chunk", [300, 10**9])
@pytest.mark.parametrize("targets", [set(range(0, 40, 3)) | {7}, set()])
def test_agrees_with_brute_force(spark, documents, monkeypatch, chunk, targets):
    monkeypatch.setattr(lm_scoring, "CHUNK_BYTES", chunk)
    rows = fixture()
    goal = spark.createDataFrame([(i,) for i in targets] + [(None,)], "doc_id long")
    got = lm_scoring.scores(documents(rows), goal).collect()
    mine = [(r.doc_id, r.n_tokens, *(None if x is None else round(x, 9) for x in (r.target_loss, r.background_loss))) for r in got]
    assert sorted(mine, key=repr) == sorted(brute(rows, targets), key=repr)


def test_text_like_the_target_scores_lower(spark, documents):
    rng = random.Random(2)
    rows = [(i, " ".join(rng.choice(["red", "green", "blue"] if i % 2 else ["one", "two", "three"]) for _ in range(30))) for i in range(40)]
    goal = spark.createDataFrame([(i,) for i in range(1, 30, 2)], "doc_id long")
    score = {r.doc_id: r.score for r in lm_scoring.scores(documents(rows), goal).collect()}
    assert max(score[i] for i in (31, 33, 35)) < min(score[i] for i in (30, 32, 34))


def test_empty_table(spark, documents):
    assert lm_scoring.scores(documents([]), spark.createDataFrame([], "doc_id long")).collect() == []
