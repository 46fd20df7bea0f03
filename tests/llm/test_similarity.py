"""Near-duplicates at similarities other than the query's, and the pipeline's stage."""

import random
import re

import corpus_pipeline
import pytest

from stallbook.llm import near_dedup
from tests.llm.conftest import edited, sentence


def shingled(text):
    w = re.findall(r"\S+", text)
    return {tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))} if w else set()


def components(rows, percent):
    """Component per id by comparing all pairs."""
    sets = [(i, shingled(t)) for i, t in rows]
    up = {i: i for i, _ in rows}
    for x, (i, s) in enumerate(sets):
        for j, t in sets[:x]:
            if s and t and 100 * len(s & t) >= percent * len(s | t):
                low, high = sorted((up[i], up[j]))
                up = {k: low if c == high else c for k, c in up.items()}
    return up


def corpus(seed=4):
    """Texts of 50 to 60 words, each with copies of one edit in the middle: 0.79 to 0.84 alike."""
    rng, rows = random.Random(seed), []
    for _ in range(40):
        base = sentence(rng, rng.randrange(48, 62), 3000)
        rows.append((len(rows), " ".join(base)))
        base[20 + rng.randrange(8)] = f"e{len(rows)}"
        rows.append((len(rows), " ".join(base)))
    rows += [(len(rows) + k, " ".join(edited(rng, base, 2))) for k in range(3)]
    return rows


def test_limits_follow_from_the_similarity():
    assert near_dedup.limits(85) == (85, 44, 196)
    assert near_dedup.limits(80).match < 205 and near_dedup.limits(80) < (80, 44, 196)


@pytest.mark.parametrize("percent", [80, 85])
def test_components_at_a_similarity(spark, documents, percent):
    rows = corpus()
    expected = components(rows, percent)
    assert expected != components(rows, 165 - percent)
    got = near_dedup.near_duplicates(documents(rows), percent=percent).collect()
    assert {r.doc_id: r.component_id for r in got} == expected


def test_the_pipeline_drops_copies_from_0_8(spark, documents):
    rows = corpus()
    kept = corpus_pipeline.without_copies(spark, documents(rows), "")
    assert sorted(r.doc_id for r in kept.collect()) == sorted(set(components(rows, 80).values()))
