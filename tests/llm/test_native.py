import hashlib
import random
import re

import duckdb
import pytest
from pyspark.sql import functions as F

from stallbook.llm import chat, fingerprints
from stallbook.llm.queries import ORACLES
from tests.llm.conftest import edited, sentence


def no_python(frame):
    plan = frame._jdf.queryExecution().executedPlan().toString()
    return not any(w in plan for w in ("Python", "Pandas", "Arrow", "CartesianProduct", "NestedLoop"))


def shingle_set(text):
    w = [x for x in re.split(r"[\x20\x09-\x0D]+", (text or "").lower()) if x]
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def resemblance(a, b):
    return len(a & b) / len(a | b) if a | b else 1.0


def test_fingerprints_of_texts_and_edits(spark, documents):
    rng = random.Random(4)
    rows = [(i * 3, " ".join(sentence(rng, rng.randrange(1, 300), 5000))) for i in range(60)]
    rows += [(500, None), (501, ""), (502, " \n"), (503, rows[7][1]), (503, rows[7][1]), (None, "first of all"), (504, "🙂é" * 3000), (505, "a b")]
    frame = fingerprints.fingerprints(documents(rows))
    assert no_python(frame)
    got = sorted(frame.collect(), key=lambda r: (-1 if r.doc_id is None else r.doc_id))
    ordered = sorted(rows, key=lambda r: (-1 if r[0] is None else r[0], r[1] or ""))
    by_text = {}
    for k, (r, (i, t)) in enumerate(zip(got, ordered)):
        t, following = t or "", ordered[(k + 1) % len(ordered)][1] or ""
        n = len(t) // 2
        new = t[: len(t) - n] + following[:n]
        assert (r.doc_id, r.n_chars) == (i, len(t))
        assert r.edited_sha256 == hashlib.sha256(new.encode()).hexdigest()
        assert abs(r.near_edited - resemblance(shingle_set(t), shingle_set(new))) < 0.2
        assert abs(r.near_next - resemblance(shingle_set(t), shingle_set(following))) < 0.2
        assert len(r.fingerprint) == 12 * min(fingerprints.K, len(shingle_set(t)))
        assert by_text.setdefault(t, r.fingerprint) == r.fingerprint


def test_no_and_one_document(spark, documents):
    assert fingerprints.fingerprints(documents([])).collect() == []
    (r,) = fingerprints.fingerprints(documents([(1, "abcdef")])).collect()
    assert r.edited_sha256 == hashlib.sha256(b"abcabc").hexdigest() and r.near_next == 1.0


def test_parts_merge_and_estimates_hold(spark):
    rng = random.Random(6)
    words = [f"u{k}" for k in range(3000)]
    other = edited(rng, words, 150)
    frame = spark.createDataFrame([("a", words), ("b", words[:1500]), ("c", other)], "id string, w array<string>")
    made = {r.id: r.s for r in frame.select("id", fingerprints.sketch("w").alias("s")).collect()}
    parts = [("a", words[k : k + 104]) for k in range(0, 2996, 100)]
    split = spark.createDataFrame(parts, "id string, w array<string>").select("id", fingerprints.sketch("w").alias("s"))
    assert fingerprints.merged_parts(split, "id", "s").first().s == made["a"]
    pair = spark.createDataFrame([(made["a"], made["b"], made["c"])], "a array<long>, b array<long>, c array<long>")
    a, b, c = F.col("a"), F.col("b"), F.col("c")
    r = pair.select(
        fingerprints.distinct_count(a).alias("n"), fingerprints.containment(b, a).alias("inside"),
        fingerprints.resemblance(a, c).alias("near"), fingerprints.merged(a, b).alias("m"),
    ).first()
    assert abs(r.n / 2996 - 1) < 0.3 and r.inside > 0.7 and r.m == made["a"]
    true = resemblance({tuple(words[i : i + 5]) for i in range(2996)}, {tuple(other[i : i + 5]) for i in range(2996)})
    assert abs(r.near - true) < 0.15


def logged():
    """Conversations logged after every turn, equal ones, one long one, and all sorts of odd rows."""
    rng, rows, conv = random.Random(3), [], 0
    for _ in range(30):
        turns = [("user" if k % 2 == 0 else "assistant", " ".join(sentence(rng, 3, 3))) for k in range(rng.randrange(1, 9))]
        for n in range(1, len(turns) + 1):
            if rng.random() < 0.7:
                rows += [(conv, k, *t) for k, t in enumerate(turns[:n])]
                conv += 1
    rows += [(900, k, "user", f"t{k}") for k in range(50)] + [(901, k, "user", f"t{k}") for k in range(40)]
    rows += [(902, 0, None, None), (903, 0, "", ""), (None, 0, "user", "lost"), (904, None, "user", "x"), (904, 0, "user", "<|im_end|>y")]
    rows += [(905, 1, "user", "b"), (905, 1, "user", "a"), (905, 1, "user", "a"), (906, 0, "user", "t0 " * 30000)]
    return rows


@pytest.mark.parametrize("size", [512, 4])
@pytest.mark.parametrize("rows", [logged(), []])
def test_maximal_conversations(spark, monkeypatch, size, rows):
    monkeypatch.setattr(chat, "SLICE", size)
    frame = spark.createDataFrame(
        [(*r, 1, 2, "x") for r in rows], "conv_id long, turn long, role string, text string, place int, slice int, conv string"
    ).repartition(3)
    out = chat.chat_texts(frame)
    assert no_python(out)
    con = duckdb.connect()
    con.execute("CREATE TABLE conversations (conv_id BIGINT, turn BIGINT, role VARCHAR, text VARCHAR)")
    if rows:
        con.executemany("INSERT INTO conversations VALUES (?, ?, ?, ?)", rows)
    expected = con.execute(ORACLES["op4_chat"].replace("turn / 512", f"turn / {size}")).fetchall()
    key = lambda r: (r[0], r[1])
    assert sorted(map(tuple, out.collect()), key=key) == sorted(expected, key=key)
