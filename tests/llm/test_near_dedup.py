import random
import re

from stallbook.llm import near_dedup
from tests.llm.conftest import edited, sentence

LOWER = str.maketrans({chr(i): chr(i + 32) for i in range(65, 91)})


def brute(rows, percent=85):
    """(n_shingles, component) per id by comparing all pairs."""
    sets = {}
    for i, t in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", (t or "").translate(LOWER))
        sets.setdefault(i, []).append({tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))} if w else set())
    up = {i: i for i in sets}

    def find(a):
        while up[a] != a:
            a = up[a]
        return a

    flat = [(i, s) for i, own in sets.items() for s in own if s]
    for x, (i, s) in enumerate(flat):
        for j, t in flat[:x]:
            if 100 * len(s & t) >= percent * len(s | t):
                a, b = find(i), find(j)
                up[max(a, b)] = min(a, b)
    return {i: find(i) for i in sets}, {i: sorted(len(s) for s in own) for i, own in sets.items()}


def corpus(seed=5):
    rng = random.Random(seed)
    rows = []
    for g in range(25):
        base = sentence(rng, rng.randrange(20, 160))
        rows += [(None, " ".join(base))] if g == 0 else []
        for k in range(rng.choice([1, 1, 2, 8])):
            rows.append((len(rows), " ".join(edited(rng, base, rng.choice([0, 0, 1, 2, 4])))))
    hot = sentence(rng, 120)
    rows += [(1000 + k, " ".join(edited(rng, hot, rng.randrange(0, 6)))) for k in range(90)]
    rows += [(2000, "One two\tTHREE"), (2001, "one  two three\n"), (2002, "one two"), (2003, None), (2004, ""), (2005, " \n "), (2006, None)]
    rows += [(2007, "long " * 20000), (2008, "x" * 50000)]
    return rows


def test_components_are_those_of_all_pairs(spark, documents, monkeypatch):
    monkeypatch.setattr(near_dedup, "BLOCK", 16)
    rows = corpus()
    expected, sizes = brute([r for r in rows if r[0] is not None])
    got = near_dedup.near_duplicates(documents(rows)).collect()
    assert len(got) == len(rows)
    for r in got:
        if r.doc_id is None:
            assert (r.component_id, r.kept) == (None, True)
            continue
        assert (r.n_shingles, r.component_id) == (sizes[r.doc_id][0], expected[r.doc_id])
        assert r.kept == (r.doc_id == r.component_id)


def test_rows_of_one_id_join_their_texts(spark, documents):
    a, b = "one two three four five six", "seven eight nine ten eleven twelve"
    rows = [(5, a), (5, b), (7, a), (9, b), (9, b), (11, "something else that is alone here")]
    got = {(r.doc_id, r.component_id) for r in near_dedup.near_duplicates(documents(rows)).collect()}
    assert got == {(5, 5), (7, 5), (9, 5), (11, 11)}


def test_empty_table(documents):
    assert near_dedup.near_duplicates(documents([])).collect() == []


def test_components_of_a_long_chain(spark):
    n = 200
    order = list(range(n))
    random.Random(1).shuffle(order)
    edges = spark.createDataFrame([(order[i], order[i + 1]) for i in range(n - 1)] + [(900, 901), (901, 900)], "a long, b long")
    names = {r.node: r.comp for r in near_dedup.components(edges).collect()}
    assert len({names[i] for i in range(n)}) == 1 and names[900] == names[901] != names[0]
