"""Toxicity by weak supervision.

Many weak voters look at a text: groups of lexicon entries mined from labelled rows, seed
word lists, and patterns of writing. A generative label model estimates, without trusting any
voter, how each votes on toxic and on clean texts, and lets voters that err together count
less. A linear classifier over the lexicon entries is then trained on the posterior labels
and scores every text.

Mining: entries are whole words and word beginnings of four to six characters. Entries that
occur in toxic rows and hardly ever in clean ones are picked greedily by the toxic rows they
add, so a few general entries stand for many word forms.

The models are fitted in one task on a bounded sample of labelled rows: at most MAX_TOXIC
toxic and MAX_CLEAN clean rows of SAMPLE_BYTES in all, chosen by a hash, equal texts counted once.

Cases: a null, empty or wordless text gets the score of a text without any entry; repeated
rows get equal scores; labels that are null or of unknown rows are not used; without both
kinds of labels the seed lists alone decide. Extra columns pass through;
a column with the new one's name is replaced.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stallbook.llm.common import (
    ALPHANUMERIC, SAMPLE_BYTES, mixed, pieces, prepare, sampled_texts,
    split_words, texts_of, tidied, training_fold, word_hashes,
)

MAX_TOXIC, MAX_CLEAN = 3000, 9000
BEGINNINGS = (4, 5, 6)
VOTERS = 12
# Plain insults per language, the voters that need no labels.
SEEDS = {
    "en": "idiot idiots moron morons stupid loser losers scum worthless pathetic disgusting trash clown imbecile filth vermin",
    "fr": "imbécile crétin abruti connard salaud ordure débile minable",
    "de": "idiot dummkopf abschaum arschloch trottel schwachkopf widerlich wertlos",
    "es": "idiota imbécil estúpido basura escoria asqueroso payaso patético",
}


def entries_of(word: str) -> list[str]:
    """Lexicon keys of a word: `=word` for the whole, `word^` for a beginning."""
    return [f"={word}", *(f"{word[:n]}^" for n in BEGINNINGS if len(word) > n)]


def distinct_words(texts: pa.Array) -> tuple[list[str], np.ndarray, np.ndarray]:
    """(distinct words, word of each pair, text of each pair) for the distinct (text, word) pairs."""
    codes, offsets, words = split_words(pc.utf8_lower(texts), ALPHANUMERIC)
    rows = np.repeat(np.arange(len(texts)), np.diff(offsets))
    pairs = np.unique(rows * max(1, len(words)) + codes)
    return words.to_pylist(), pairs % max(1, len(words)), pairs // max(1, len(words))


def near_copies(texts: pa.Array, columns: int = 3) -> list[np.ndarray]:
    """Per column a number that near copies mostly share: the least of the words' hashes."""
    codes, offsets, words = split_words(pc.utf8_lower(texts), ALPHANUMERIC)
    n, out, hashed = np.diff(offsets), [], word_hashes(words)
    for c in range(columns):
        least = np.zeros(len(n), dtype=np.uint64)
        if len(codes):
            least[n > 0] = np.minimum.reduceat(mixed(hashed + np.uint64(c))[codes], offsets[:-1][n > 0])
        out.append(least)
    return out


def slices(texts: pa.Array, rows: int = 500):
    for start in range(0, len(texts), rows):
        yield start, texts.slice(start, rows)


def entry_pairs(texts: pa.Array, number: dict[str, int], grow: bool) -> tuple[np.ndarray, np.ndarray]:
    """(text, entry) of the distinct entries of each text; entries without a number get one or are left out."""
    rows, entries = [], []
    for start, part in slices(texts):
        words, word, row = distinct_words(part)
        if grow:
            keys = [[number.setdefault(e, len(number)) for e in entries_of(w)] for w in words]
        else:
            keys = [[number[e] for e in entries_of(w) if e in number] for w in words]
        sizes = np.fromiter(map(len, keys), np.int64, len(keys))
        flat = np.fromiter((k for own in keys for k in own), np.int64, int(sizes.sum()))
        n = sizes[word]
        at = np.repeat((np.cumsum(sizes) - sizes)[word] - (np.cumsum(n) - n), n) + np.arange(n.sum())
        width = max(1, len(number))
        pairs = np.unique(np.repeat(row, n) * width + flat[at])
        rows.append((pairs // width + start).astype(np.int32))
        entries.append((pairs % width).astype(np.int32))
    if not rows:
        return np.zeros(0, np.int32), np.zeros(0, np.int32)
    return np.concatenate(rows), np.concatenate(entries)


def mine(texts: pa.Array, toxic: np.ndarray) -> list[str]:
    """Lexicon entries, the most telling first."""
    number: dict[str, int] = {}
    row, entry = entry_pairs(texts.filter(pa.array(toxic)), number, True)
    names = list(number)
    often = np.flatnonzero(np.bincount(entry, minlength=len(names)) >= 6)
    new = np.full(len(names) + 1, -1)
    new[often] = np.arange(len(often))
    names = [names[e] for e in often]
    row, entry = row[new[entry] >= 0], new[entry[new[entry] >= 0]]
    _, clean = entry_pairs(texts.filter(pa.array(~toxic)), {e: i for i, e in enumerate(names)}, False)
    bad, good = (np.bincount(x, minlength=len(names)) for x in (entry, clean))
    # At most one clean row for fifty toxic ones, and enough toxic rows.
    telling = good * 50 <= bad
    by_entry: dict[int, set[int]] = {}
    for r, e in zip(row.tolist(), entry.tolist()):
        if telling[e]:
            by_entry.setdefault(e, set()).add(r)
    chosen = []
    alike = near_copies(texts.filter(pa.array(toxic)))
    # Greedy cover. Clean rows with the entry count heavily against it; an entry that adds less
    # than four rows of its own is more likely chance.
    while by_entry:
        best = max(by_entry, key=lambda e: (len(by_entry[e]) - 20 * int(good[e]), -e))
        if len(by_entry[best]) < 4:
            break
        own = list(by_entry[best])
        if min(len(set(column[own].tolist())) for column in alike) < 4:
            del by_entry[best]  # a few texts and their near copies
            continue
        chosen.append(names[best])
        gone = by_entry.pop(best)
        by_entry = {e: rest for e, own in by_entry.items() if len(rest := own - gone) >= 4}
    return chosen


def patterns(texts: pa.Array) -> np.ndarray:
    """Votes of patterns, one column each: shouting, strings of exclamation marks, second person, plain prose (clean)."""
    n = np.maximum(1, pc.utf8_length(texts).to_numpy(zero_copy_only=False))
    upper = pc.count_substring_regex(texts, r"\p{Lu}").to_numpy(zero_copy_only=False)
    marks = pc.count_substring(texts, "!").to_numpy(zero_copy_only=False)
    you = pc.count_substring_regex(texts, r"(?i)\b(you|your|toi|vous|du|dich|tú|usted)\b").to_numpy(zero_copy_only=False)
    prose = (upper * 12 < n) & (marks == 0)
    return np.stack([upper * 2 > n, marks * 40 > n, you * 60 > n, -prose.astype(np.int8)], axis=1).astype(np.int8)


def label_model(votes: np.ndarray, prior: np.ndarray, start: np.ndarray | None = None, rounds: int = 25) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Posterior of toxic, the voters' rates and their weights.

    votes: rows by voters in {-1, 0, 1}; prior: each row's probability before any vote; start:
    first guess of the posterior. Every voter has, for each class, the rates of its three
    answers. Voters that agree beyond what the class explains share their weight: 1 over 1 plus
    the positive conditional correlations, small ones of nearly constant voters left out.
    """
    answers = np.stack([votes == v for v in (-1, 0, 1)], axis=2).astype(float)
    p, weights = (prior if start is None else start).astype(float), np.ones(votes.shape[1])
    rates = np.zeros((2, votes.shape[1], 3))
    prior_odds = np.log(prior / (1 - prior))
    for _ in range(rounds):
        for c, w in enumerate((1 - p, p)):
            rates[c] = (np.einsum("n,nvk->vk", w, answers) + 0.5) / (w.sum() + 1.5)
        mean = np.stack([r[:, 2] - r[:, 0] for r in rates])
        rest = votes - (np.outer(1 - p, mean[0]) + np.outer(p, mean[1]))
        cover = rest.T @ rest / len(votes)
        same = np.clip(cover / (np.sqrt(np.outer(np.diag(cover), np.diag(cover))) + 0.05), 0, 1)
        weights = 1 / (1 + same.sum(0) - np.diag(same))
        odds = prior_odds + np.einsum("nvk,vk->n", answers, weights[:, None] * np.log(rates[1] / rates[0]))
        p = 1 / (1 + np.exp(-np.clip(odds, -30, 30)))
    return p, rates, weights


def linear(x: np.ndarray, y: np.ndarray, rounds: int = 400, rate: float = 1.0, ridge: float = 1e-4) -> np.ndarray:
    """Logistic regression on soft labels by gradient steps; the last weight is the constant."""
    x = np.hstack([x, np.ones((len(x), 1))])
    w, speed = np.zeros(x.shape[1]), np.zeros(x.shape[1])
    total = np.full(x.shape[1], 1e-8)
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        g = x.T @ (p - y) / len(y) + ridge * w
        total += g * g
        speed = 0.9 * speed + rate * g / np.sqrt(total)
        w -= 0.3 * speed
    return w


def found(texts: pa.Array, number: dict[str, int]) -> np.ndarray:
    """Rows by entries: 1 where a text holds the entry."""
    words, word, row = distinct_words(texts)
    x = np.zeros((len(texts), len(number)), dtype=np.float32)
    hits = [(i, number[e]) for i, w in enumerate(words) for e in entries_of(w) if e in number]
    if hits:
        place, entry = np.array(hits).T
        order = np.argsort(word, kind="stable")
        first, last = np.searchsorted(word[order], place), np.searchsorted(word[order], place, side="right")
        for a, b, e in zip(first, last, entry):
            x[row[order[a:b]], e] = 1
    return x


def fit(texts: pa.Array, toxic: np.ndarray) -> tuple[list[str], list[float]]:
    """Entries and weights (the constant last) from labelled texts."""
    seeds = {e: f"={e}" for words in SEEDS.values() for e in words.split()}
    mined = mine(texts, toxic) if toxic.any() and not toxic.all() else []
    entries = list(dict.fromkeys([*mined, *seeds.values()]))
    number = {e: i for i, e in enumerate(entries)}
    if not toxic.any() or toxic.all():
        return entries, [4.0] * len(entries) + [-3.0]
    x = np.vstack([found(part, number) for _, part in slices(texts)])
    columns = []
    for v in range(VOTERS):  # every voter: each twelfth of the mined entries
        own = [number[e] for e in mined[v::VOTERS]]
        columns.append(x[:, own].any(1).astype(np.int8) if own else np.zeros(len(x), np.int8))
    for words in SEEDS.values():
        columns.append(x[:, [number[f"={w}"] for w in words.split()]].any(1).astype(np.int8))
    columns.append(-(~x.any(1)).astype(np.int8))  # none of the entries: clean
    votes = np.column_stack([np.stack(columns, axis=1), patterns(texts)])
    # One common prior: the share of toxic rows. The voters alone tell the rows apart.
    share = np.full(len(votes), min(0.95, max(0.05, toxic.mean())))
    # First guess: toxic where a lexicon voter says so.
    guess = np.where((votes[:, : VOTERS + len(SEEDS)] > 0).any(1), 0.9, 0.1)
    posterior, _, _ = label_model(votes, share, guess)
    # One more row per entry: the entry alone, labelled with its smoothed precision, so that an entry
    # that always comes with others in the sample counts in full by itself.
    bad, all_rows = (x * posterior[:, None]).sum(0), x.sum(0)
    precision = (bad + 9) / (all_rows + 10)
    alone = np.eye(len(entries), dtype=np.float32)
    copies = max(1, len(x) // (20 * len(entries)))
    x = np.vstack([x, *[alone] * copies])
    return entries, linear(x, np.concatenate([posterior, *[precision] * copies])).tolist()


def train(documents: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "toxic",
          max_toxic: int = MAX_TOXIC, max_clean: int = MAX_CLEAN, max_bytes: int = SAMPLE_BYTES) -> tuple[list[str], list[float]]:
    """Fits on the training rows; see the module text for the sample's bound."""
    spark = prepare(documents.sparkSession)
    known = labels.where(F.col(key).isNotNull() & F.col(label).isin(0, 1) & training_fold(key))
    known = known.groupBy(key).agg(F.max(label).alias("y"))
    rows = sampled_texts(documents, known, "y", key, text, {1: max_toxic, 0: max_clean}, max_bytes)

    def learn(batches):
        held = list(batches)
        if not held:
            return
        rows = pa.Table.from_batches(held).sort_by("text").combine_chunks().to_batches()[0]
        held.clear()
        entries, weights = fit(texts_of(rows), rows.column("y").to_numpy(zero_copy_only=False) == 1)
        yield pa.RecordBatch.from_arrays([pa.array([entries], pa.list_(pa.string())), pa.array([weights], pa.list_(pa.float64()))],
                                         names=["entries", "weights"])

    model = rows.repartition(1).mapInArrow(tidied(learn), "entries array<string>, weights array<double>").first()
    if model is None:
        return fit(pa.array([], pa.string()), np.zeros(0, dtype=bool))
    return list(model["entries"]), list(model["weights"])


def score(documents: DataFrame, model: tuple[list[str], list[float]], text: str = "text", name: str = "score") -> DataFrame:
    """The documents with one more column: the classifier's probability of toxic for the whole text."""
    spark = prepare(documents.sparkSession)
    entries, weights = model
    w = np.array(weights[:-1])
    base = weights[-1]
    shared = spark.sparkContext.broadcast({e: i for i, e in enumerate(entries)})

    def run(batches):
        for batch in pieces(batches, text):
            odds = found(texts_of(batch, text), shared.value) @ w + base
            yield batch.append_column(name, pa.array(1 / (1 + np.exp(-np.clip(odds, -30, 30))), pa.float64()))

    rows = documents.drop(name)
    return rows.mapInArrow(tidied(run), rows.withColumn(name, F.lit(0.0)).schema)
