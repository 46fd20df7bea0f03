import hashlib
import random
import re

from stallbook.llm import decontaminate
from tests.llm.conftest import sentence

LOWER = str.maketrans({chr(i): chr(i + 32) for i in range(65, 91)})


def words(t):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (t or "").translate(LOWER))


def brute(text, items):
    w = words(text)
    hit, found = [False] * len(w), set()
    for item, t in items:
        own = words(t)
        for k in range(max(1, len(own) - 12) if own else 0):
            window = own[k : k + 13]
            for s in range(len(w) - len(window) + 1):
                if w[s : s + len(window)] == window:
                    hit[s : s + len(window)] = [True] * len(window)
                    found.add(str(item))
    n = sum(hit)
    sha = hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
    return len(w), n, len(found), sha, n > 0 and 20 * n >= len(w)


def fixture():
    rng = random.Random(3)
    items = [(i, " ".join(sentence(rng, rng.randrange(10, 40)))) for i in range(12)]
    items += [(20, "Übung macht-den Meister"), (21, ""), (22, None), (23, "w0"), (100, items[0][1])]
    rows = []
    for i in range(60):
        body = sentence(rng, rng.randrange(0, 300))
        if i % 3 == 0:
            own = words(items[rng.randrange(12)][1])
            cut = rng.randrange(len(own))
            body[10:10] = own[cut:] if i % 2 else own
        rows.append((i, ", ".join(body).upper() if i % 5 else " ".join(body)))
    rows += [(70, None), (71, ""), (72, "!?"), (73, "die übung macht den meister"), (73, "die übung macht den meister"), (None, items[1][1])]
    rows.append((75, "a b " * 30000 + items[2][1]))
    return rows, items


def check(spark, documents, rows, items):
    frame = spark.createDataFrame(items, "item_id long, text string")
    got = decontaminate.contamination(documents(rows), frame).collect()
    expected = sorted(((i, *brute(t, items)) for i, t in rows), key=repr)
    assert sorted((tuple(r) for r in got), key=repr) == expected


def test_agrees_with_brute_force(spark, documents):
    check(spark, documents, *fixture())


def test_blocks_of_the_benchmark_give_the_same(spark, documents, monkeypatch):
    monkeypatch.setattr(decontaminate, "BLOCK_WORDS", 60)
    monkeypatch.setattr(decontaminate.blocks, "__defaults__", (60,))
    check(spark, documents, *fixture())


def test_empty_tables(spark, documents):
    rows, items = fixture()
    check(spark, documents, rows, [])
    check(spark, documents, [], items)


def test_proximity_finds_terms_in_any_order_within_the_slack(spark, documents):
    items = spark.createDataFrame([("p", "alpha beta gamma")], "item_id string, text string")
    rows = [(1, "x gamma y alpha beta z"), (2, "alpha x x x x beta gamma"), (3, "beta gamma alpha"), (4, "alpha beta")]
    _, found = decontaminate.phrase_matches(documents(rows), items, slack=1)
    assert sorted((r.key, r.first, r.last) for r in found.collect()) == [(1, 1, 4), (3, 0, 2)]
    _, exact = decontaminate.phrase_matches(documents(rows), items)
    assert exact.collect() == []
