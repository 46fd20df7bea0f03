import random
import zlib

import numpy as np
import pyarrow as pa
import pytest

from stallbook.llm import quality, toxicity
from tests.llm.conftest import sentence


def held_out(i):
    return zlib.crc32(str(i).encode()) % 5 == 0


def corpus(n=900):
    """Toxic rows hold word forms of two stems; bad rows shout, repeat or list."""
    rng, rows, toxic, bad = random.Random(1), [], {}, {}
    for i in range(n):
        words = sentence(rng, rng.randrange(8, 80), 900)
        toxic[i] = rng.random() < 0.2
        if toxic[i]:
            for _ in range(rng.randrange(1, 4)):
                stem = rng.choice(["zorka", "blimp"])
                words.insert(rng.randrange(len(words)), stem + rng.choice(["", "s", "isch", "ung", "en", "ly", "ful"]) + str(rng.randrange(30)))
        kind = rng.choice(["shout", "repeat", "marks"]) if rng.random() < 0.25 else ""
        bad[i] = bool(kind)
        if kind == "shout":
            words = [w.upper() + "!!" for w in words]
        elif kind == "repeat":
            words = [w for w in words for _ in range(6)]
        elif kind == "marks":
            words = [w + rng.choice(["$$$", "###", "%%%"]) for w in words]
        rows.append((i, " ".join(words)))
    return rows, toxic, bad


EDGES = [(5000, None), (5001, ""), (5002, "!? \n"), (None, "w1 w2"), (5003, "w1 " * 30000), (5004, "w1 w2 w3"), (5004, "w1 w2 w3")]


def frames(spark, documents):
    rows, toxic, bad = corpus()
    labels = [(i, int(not bad[i]), int(toxic[i])) for i, _ in rows if i % 10]
    labels += [(None, 1, 1), (99999, 0, 1), (3, None, None), (labels[0][0], labels[0][1], labels[0][2])]
    return documents(rows + EDGES), spark.createDataFrame(labels, "doc_id long, quality int, toxic int"), toxic, bad


@pytest.mark.parametrize("module, label", [(toxicity, "toxic"), (quality, "quality")])
def test_held_out_rows(spark, documents, module, label):
    frame, labels, toxic, bad = frames(spark, documents)
    scored = module.score(frame, module.train(frame, labels))
    assert scored.columns == [c for c in frame.columns if c != "score"] + ["score"]
    got = scored.collect()
    assert len(got) == 900 + len(EDGES) and all(0 <= r.score <= 1 for r in got)
    truth = toxic if label == "toxic" else {i: not b for i, b in bad.items()}
    out = [(r.score >= 0.5, truth[r.doc_id]) for r in got if r.doc_id is not None and r.doc_id < 900 and held_out(r.doc_id)]
    assert np.mean([a == b for a, b in out]) >= 0.95
    by_id = {}
    for r in got:
        by_id.setdefault(r.doc_id, set()).add(r.score)
    assert len(by_id[5004]) == 1
    assert by_id[5000] == by_id[5001]
    assert label == "quality" or by_id[5000] == by_id[5002] and max(by_id[5000]) < 0.5


@pytest.mark.parametrize("module", [toxicity, quality])
def test_without_labels_or_documents(spark, documents, module):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    frame = documents(EDGES)
    assert module.score(frame, module.train(frame, none)).count() == len(EDGES)
    one = spark.createDataFrame([(5004, 1, 1), (5001, 1, 1), (5002, 1, 1)], "doc_id long, quality int, toxic int")
    assert module.score(frame, module.train(frame, one)).count() == len(EDGES)
    empty = documents([])
    assert module.score(empty, module.train(empty, one)).collect() == []


def test_seed_words_decide_without_labels(spark, documents):
    none = spark.createDataFrame([], "doc_id long, toxic int")
    frame = documents([(1, "you IDIOT, go"), (2, "a kind word")])
    got = {r.doc_id: r.score for r in toxicity.score(frame, toxicity.train(frame, none)).collect()}
    assert got[1] > 0.5 > got[2]


def test_label_model_finds_good_bad_and_copied_voters():
    rng = np.random.default_rng(0)
    y = rng.random(4000) < 0.3
    def voter(right):
        return np.where(rng.random(4000) < right, y, ~y)
    one = voter(0.7)
    votes = np.stack([voter(0.9), voter(0.85), voter(0.5), one, one, one], axis=1) * 2 - 1
    guess = np.where(votes[:, :3].sum(1) > 0, 0.8, 0.2)
    p, rates, weights = toxicity.label_model(votes.astype(np.int8), np.full(4000, 0.3), guess)
    assert ((p > 0.5) == y).mean() > 0.88
    assert weights[3:].max() < 0.5 < weights[:3].min()
    assert rates[1][0][2] > 0.8 and abs(rates[1][2][2] - rates[0][2][2]) < 0.15


def test_scoring_is_the_trained_model():
    texts = pa.array(["One one two!", "", "shout SHOUT", "é" * 50])
    numbers = np.random.default_rng(1).normal(size=quality.BUCKETS).astype(np.float32)
    slow = [float(w @ numbers[u]) if len(u) else 0.0 for u, w in quality.rows_of(texts)]
    assert np.allclose(quality.odds(texts, numbers, 0.25), np.array(slow) + 0.25, atol=1e-4)


def test_near_copies_do_not_make_an_entry():
    rng = random.Random(2)
    clean = [" ".join(sentence(rng, 40)) for _ in range(60)]
    base = sentence(rng, 60) + ["rareword"]
    copies = [" ".join(base + [f"x{k}"]) for k in range(30)]
    toxic = [" ".join(sentence(rng, 30) + ["zorkaful"]) for _ in range(30)]
    texts = pa.array(clean + copies + toxic)
    entries = toxicity.mine(texts, np.array([False] * 60 + [True] * 60))
    assert any(e.lstrip("=").startswith("zork") for e in entries)
    assert not any("rare" in e for e in entries)
