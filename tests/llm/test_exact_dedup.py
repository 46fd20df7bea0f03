import hashlib
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from stallbook.llm import exact_dedup
from stallbook.llm.exact_dedup import QuotientFilter, counted, exact_duplicates, merged, quotient_bits_for


def filled(values):
    own, counts = counted(np.array(values, np.uint64))
    return QuotientFilter.of(own, counts, quotient_bits_for(len(own)))


@pytest.mark.parametrize("n", [0, 1, 2, 50, 5000])
def test_filter_counts_and_packs_without_loss(n):
    rng = random.Random(n)
    pool = [rng.randrange(2**64) for _ in range(n // 2 + 1)] + [0, 2**64 - 1]
    values = [rng.choice(pool) for _ in range(n)]
    back = QuotientFilter.unpack(filled(values).pack())
    assert dict(zip(*(x.tolist() for x in back.entries()))) == Counter(values)


def test_filters_of_parts_merge_to_that_of_all_rows():
    rng = random.Random(3)
    parts = [[rng.randrange(400) << 54 | rng.randrange(3) for _ in range(rng.randrange(300))] for _ in range(9)]
    whole = filled([])
    for part in parts:
        whole = merged(whole, filled(part))
    expected = filled([v for part in parts for v in part])
    assert whole.pack() == expected.pack()


def test_crowded_quotients_and_great_counts():
    values, counts = np.arange(200, dtype=np.uint64), np.full(200, 10**9, np.int64)
    small = QuotientFilter.of(values, counts, 2)
    assert [x.tolist() for x in small.entries()] == [values.tolist(), counts.tolist()]
    # Remainders of 50 bits: a greater count takes two slots.
    narrow = QuotientFilter.of(values << np.uint64(50), counts * 10**7 + np.arange(200), 14)
    back = QuotientFilter.unpack(narrow.pack()).entries()
    assert back[1].tolist() == (counts * 10**7 + np.arange(200)).tolist()


def brute(rows):
    """(id, keep, size, kept, digest) per row."""
    groups = {}
    for i, t in rows:
        groups.setdefault(t or "", []).append(i)
    out, stayed = [], set()
    for i, t in rows:
        ids = [x for x in groups[t or ""] if x is not None]
        keep = max(ids) if ids else None
        kept = i == keep and t not in stayed if t else i == keep and "" not in stayed
        if kept:
            stayed.add(t or "")
        out.append((i, keep, len(groups[t or ""]), kept, hashlib.sha256((t or "").encode()).hexdigest()))
    return sorted(out, key=repr)


def corpus(seed=1):
    rng, rows = random.Random(seed), []
    texts = [" ".join(rng.choice("abcdefgh") * 3 for _ in range(4)) + f" {k}" for k in range(150)]
    rows += [(i, rng.choice(texts)) for i in range(400)]
    rows += [(1000 + i, "the text that a third of the rows share") for i in range(250)]
    rows += [(5000, None), (5001, ""), (5002, " "), (5003, "é"), (5004, "é"), (5005, "x" * 200_000), (5006, "x" * 200_000)]
    rows += [(None, "without id, once"), (None, "without id, twice"), (None, "without id, twice"), (None, texts[0])]
    rows += [(7, "an id with another text"), (6000, "same row"), (6000, "same row"), (-5, None)]
    return rows


def test_groups_are_those_of_equal_texts(documents):
    rows = corpus()
    got = [tuple(r) for r in exact_duplicates(documents(rows, partitions=7)).collect()]
    assert sorted(got, key=repr) == brute(rows)


def test_equal_fingerprints_are_told_apart_by_their_bytes(documents, monkeypatch):
    monkeypatch.setattr(exact_dedup.F, "xxhash64", lambda *c: F.pmod(F.length(*c), F.lit(3)).cast("long"))
    rows = [r for r in corpus(2) if r[0] is not None]
    got = [tuple(r) for r in exact_duplicates(documents(rows)).collect()]
    assert sorted(got, key=repr) == brute(rows)


def test_texts_may_be_changed_before(documents):
    rows = [(1, "One  text"), (2, "one text "), (3, "two")]
    clean = lambda c: F.trim(F.regexp_replace(F.lower(c), r"\s+", " "))
    got = {r.doc_id: (r.keep_id, r.group_size, r.kept) for r in exact_duplicates(documents(rows), normal=clean).collect()}
    assert got == {1: (2, 2, False), 2: (2, 2, True), 3: (3, 1, True)}


def test_hot_text_is_one_entry_of_each_part(documents):
    keys = documents([(i, "same") for i in range(3000)], partitions=6).select(F.xxhash64("text").alias("f"))
    rows = exact_dedup.filters(keys, "f", 5).collect()
    assert len(rows) == 6
    assert sum(QuotientFilter.unpack(bytes(r["filter"])).entries()[1][0] for r in rows) == 3000


def test_empty_table(documents):
    assert exact_duplicates(documents([])).collect() == []
