"""SentencePiece encoding and decoding with a batched numpy Viterbi.

The vocabulary file gives pieces with scores; a text is cut into the pieces whose scores add up
to the most. Spaces become the visible space mark, one more is put in front of the text. No
piece goes on past the end of a word, so a text is the sequence of its words (spaces, then other
characters), each distinct word is cut once, and words of equal length advance together: at
each place the hashes of the substrings that end there are looked up among the sorted hashes of
the pieces, and vectorised maxima keep the best score and where its piece began.

A character without a piece falls back to the pieces of its UTF-8 bytes, at the score that the
unigram model gives to unknown characters: ten below the lowest score of a piece.

Substring hashes are 64-bit; a hit is confirmed by its length, and all pieces of the vocabulary
are checked to hash differently.

Cases: null and empty texts have no pieces and decode to the empty text; texts of any length are
worked off word by word, a word without spaces of any length in one pass; every valid text
decodes to itself; repeated rows are encoded each; an empty table gives no rows. Extra columns pass through; a
column with the new one's name is replaced.
"""

from __future__ import annotations

import re
import zlib
from functools import cache
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stallbook.llm.common import WordIds, pieces, prepare, texts_of, tidied

SPACE = "▁"
BASE = np.uint64(0x100000001B3)
UNKNOWN = -10.0
# Distinct words whose pieces a Python worker remembers, and words per Viterbi batch.
REMEMBERED_WORDS = 250_000
TOGETHER = 20_000
# Places times words whose substrings are looked up in one go.
CELLS = 200_000
WORD = re.compile(" *[^ ]+| +")
PIECE_BYTES = 4_000_000


class Vocabulary:
    def __init__(self, path: str):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        n = model.vocab_size()
        self.pieces = [model.id_to_piece(i) for i in range(n)]
        bytes_at = [i for i in range(n) if model.is_byte(i)]
        if len(bytes_at) != 256:
            raise ValueError("the vocabulary has no pieces for all bytes")
        self.bytes_at = np.zeros(256, dtype=np.int64)
        for i in bytes_at:
            self.bytes_at[int(self.pieces[i][3:5], 16)] = i
        plain = [i for i in range(n) if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i) or model.is_unused(i))]
        if any(SPACE in p[1:] and p.strip(SPACE) for p in (self.pieces[i] for i in plain)):
            raise ValueError("a piece goes on past the end of a word")
        scores = np.array([model.get_score(i) for i in plain])
        self.unknown = float(scores.min()) + UNKNOWN
        self.longest = max(len(self.pieces[i]) for i in plain)
        self.powers = np.cumprod(np.concatenate(([1], np.full(self.longest, BASE))).astype(np.uint64))
        # Per length: sorted hashes, ids and scores.
        self.tables: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]] = {}
        by_length: dict[int, list[int]] = {}
        for k, i in enumerate(plain):
            by_length.setdefault(len(self.pieces[i]), []).append(k)
        for length, own in by_length.items():
            points = np.array([[ord(c) for c in self.pieces[plain[k]]] for k in own], dtype=np.uint64)
            h = np.zeros(len(own), dtype=np.uint64)
            for c in range(length):
                h = h * BASE + points[:, c] + np.uint64(1)
            order = np.argsort(h)
            if len(np.unique(h)) != len(h):
                raise ValueError("two pieces have one hash")
            self.tables[length] = (h[order], np.array(plain)[own][order], scores[own][order])

    def lookups(self, prefix: np.ndarray, first: int, last: int) -> dict[int, tuple[np.ndarray, np.ndarray]]:
        """Per piece length: scores (none: minus infinity) and ids of the substrings that end at the places first to last - 1."""
        found = {}
        for own, (keys, ids, scores) in self.tables.items():
            a = max(first, own)
            if a >= last:
                continue
            h = prefix[a:last] - prefix[a - own : last - own] * self.powers[own]
            at = np.searchsorted(keys, h)
            at[at == len(keys)] = 0
            hit = keys[at] == h
            if hit.any():
                value, piece = np.full((last - first, prefix.shape[1]), -np.inf), np.zeros((last - first, prefix.shape[1]), np.int32)
                value[a - first :] = np.where(hit, scores[at], -np.inf)
                piece[a - first :] = ids[at]
                found[own] = (value, piece)
        return found

    def segment(self, points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids, number of ids of each word) of words of one length, given as rows of code points."""
        n, length = points.shape
        prefix = np.zeros((length + 1, n), dtype=np.uint64)
        for c in range(length):
            prefix[c + 1] = prefix[c] * BASE + points[:, c] + np.uint64(1)
        # The best piece that ends at each place: its length and id; -1 stands for a character without a piece.
        size, piece = np.ones((length + 1, n), dtype=np.int8), np.full((length + 1, n), -1, dtype=np.int32)
        best = np.full((length + 1, n), -np.inf)
        best[0] = 0
        block = max(1, CELLS // n)
        for first in range(1, length + 1, block):
            last = min(length + 1, first + block)
            found = self.lookups(prefix, first, last)
            if n < 4:  # long words come few at a time: plain numbers are quicker than short vectors
                for w in range(n):
                    self._advance(best, size, piece, found, first, last, w)
                continue
            for end in range(first, last):
                top, length_of, id_of = best[end - 1] + self.unknown, size[end], piece[end]
                for own, (value, ids) in found.items():
                    if own <= end:
                        total = best[end - own] + value[end - first]
                        better = total > top
                        np.copyto(top, total, where=better)
                        np.copyto(length_of, own, where=better, casting="unsafe")
                        np.copyto(id_of, ids[end - first], where=better)
                best[end] = top
        # Back from the ends, all words together.
        place, rows = np.full(n, length), np.arange(n)
        steps: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        while len(rows):
            steps.append((rows, piece[place, rows], points[rows, place - 1]))
            place = place - size[place, rows]
            live = place > 0
            place, rows = place[live], rows[live]
        rows, ids, character = (np.concatenate(x) for x in zip(*steps[::-1]))
        order = np.argsort(rows, kind="stable")
        rows, ids, character = rows[order], ids[order], character[order]
        if (ids < 0).any():
            spelt = [self.bytes_at[list(chr(c).encode("utf-8"))] if i < 0 else (i,) for i, c in zip(ids.tolist(), character.tolist())]
            times = np.fromiter(map(len, spelt), np.int64, len(spelt))
            rows, ids = np.repeat(rows, times), np.concatenate(spelt)
        return ids.astype(np.uint32), np.bincount(rows, minlength=n)

    def _advance(self, best, size, piece, found, first, last, w) -> None:
        """The same steps for one word."""
        columns = [(own, value[:, w].tolist(), ids[:, w].tolist()) for own, (value, ids) in found.items()]
        reach = self.longest
        scores = best[max(0, first - reach) : last, w].tolist()
        shift = max(0, first - reach)
        for end in range(first, last):
            top, chosen, at = scores[end - 1 - shift] + self.unknown, 1, -1
            for own, value, ids in columns:
                v = value[end - first]
                if v != -np.inf and scores[end - own - shift] + v > top:
                    top, chosen, at = scores[end - own - shift] + v, own, ids[end - first]
            scores[end - shift] = top
            size[end, w], piece[end, w] = chosen, at
        best[first:last, w] = scores[first - shift :]


class Encoder:
    """Texts to piece ids by their distinct words, and back."""

    def __init__(self, path: str):
        self.vocabulary = Vocabulary(path)
        self.known = WordIds(REMEMBERED_WORDS)
        # Bytes of all pieces one after the other, byte pieces as their byte.
        parts = [p.replace(SPACE, " ").encode() for p in self.vocabulary.pieces]
        for byte, i in enumerate(self.vocabulary.bytes_at):
            parts[i] = bytes([byte])
        self.sizes = np.array([len(p) for p in parts], dtype=np.int64)
        self.starts = np.cumsum(self.sizes) - self.sizes
        self.spelt = np.frombuffer(b"".join(parts), dtype=np.uint8)

    def _learn(self, words: list[str]) -> None:
        by_length: dict[int, list[str]] = {}
        for w in words:
            by_length.setdefault(len(w), []).append(w)
        for length, own in by_length.items():
            if not length:  # the space mark as a character of the text
                mark = self.vocabulary.bytes_at[list(SPACE.encode())]
                self.known.add(own, np.array([len(mark)]), mark.astype(np.uint32))
                continue
            step = max(1, min(TOGETHER, CELLS // length))
            for a in range(0, len(own), step):
                part = own[a : a + step]
                marked = "".join(part).replace(" ", SPACE).encode("utf-32-le", "surrogatepass")
                points = np.frombuffer(marked, dtype="<u4").reshape(len(part), length)
                ids, sizes = self.vocabulary.segment(points.astype(np.uint64))
                self.known.add(part, sizes, ids)

    def _sequence(self, codes, offsets, names) -> tuple[np.ndarray, np.ndarray]:
        self._learn(self.known.unknown(names))
        return self.known.sequence(self.known.places(names)[codes], offsets)

    def _plain(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Texts whose words have one space before each, but for the first."""
        lists = pc.split_pattern(texts, " ")
        coded = lists.flatten().dictionary_encode()
        offsets = np.concatenate(([0], np.cumsum(pc.list_value_length(lists).to_numpy(zero_copy_only=False))))
        names = [" " + w for w in coded.dictionary.to_pylist()]
        return self._sequence(coded.indices.to_numpy(zero_copy_only=False), offsets, names)

    def _spaced(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Any other texts."""
        lists = [words_of(t) for t in texts]
        number: dict[str, int] = {}
        codes = np.array([number.setdefault(w, len(number)) for own in lists for w in own], dtype=np.int64)
        offsets = np.concatenate(([0], np.cumsum([len(own) for own in lists], dtype=np.int64)))
        return self._sequence(codes, offsets, list(number))

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(piece ids of all texts, number of pieces of each text)."""
        odd = pc.match_substring_regex(texts, f"^$|^ | $|  |{SPACE}").to_numpy(zero_copy_only=False).astype(bool)
        if not odd.any():
            return self._plain(texts)
        first, second = self._plain(texts.filter(pa.array(~odd))), self._spaced(texts.filter(pa.array(odd)).to_pylist())
        sizes, starts = np.zeros((2, len(odd)), dtype=np.int64)
        sizes[~odd], sizes[odd] = first[1], second[1]
        starts[~odd], starts[odd] = np.cumsum(first[1]) - first[1], len(first[0]) + np.cumsum(second[1]) - second[1]
        at = np.repeat(starts - (np.cumsum(sizes) - sizes), sizes) + np.arange(sizes.sum())
        return np.concatenate((first[0], second[0]))[at], sizes

    def decode(self, ids: np.ndarray, sizes: np.ndarray) -> list[bytes]:
        """UTF-8 of each text, given the ids of all texts and the number of pieces of each."""
        own = self.sizes[ids]
        ends = np.cumsum(own)
        total = int(ends[-1]) if len(ends) else 0
        raw = self.spelt[np.repeat(self.starts[ids] - (ends - own), own) + np.arange(total)].tobytes()
        cuts = np.concatenate(([0], ends))[np.concatenate(([0], np.cumsum(sizes)))]
        return [raw[a + 1 : b] for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist())]  # without the space put in front


def words_of(text: str) -> list[str]:
    """Words, each with the spaces before it; joined they are the text with one more space in front.

    A space mark that is a character of the text itself is an empty word.
    """
    if not text:
        return []
    words: list[str] = []
    for place, part in enumerate((" " + text).split(SPACE)):
        if place:
            words.append("")
        words += WORD.findall(part)
    return words


@cache
def encoder_of(path: str) -> Encoder:
    """One encoder in each Python worker."""
    return Encoder(path)


def listed(ids: np.ndarray, sizes: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(np.concatenate(([0], np.cumsum(sizes))).astype(np.int32)), pa.array(ids.astype(np.int32)))


def encode(documents: DataFrame, path: str, text: str = "text", name: str = "piece_ids") -> DataFrame:
    """The documents with one more column: the piece ids of the whole text."""
    prepare(documents.sparkSession)

    def run(batches):
        for batch in pieces(batches, text, PIECE_BYTES):
            yield batch.append_column(name, listed(*encoder_of(path).encode(texts_of(batch, text))))

    rows = documents.drop(name)
    return rows.mapInArrow(tidied(run), rows.withColumn(name, F.array().cast("array<int>")).schema)


def decode(coded: DataFrame, path: str, ids: str = "piece_ids", name: str = "decoded") -> DataFrame:
    """The rows with one more column: the text of the piece ids; null ids are none."""
    prepare(coded.sparkSession)

    def run(batches):
        for batch in batches:
            own = batch.column(batch.schema.get_field_index(ids))
            sizes = pc.fill_null(pc.list_value_length(own), 0).to_numpy(zero_copy_only=False)
            texts = encoder_of(path).decode(own.flatten().to_numpy(zero_copy_only=False), sizes)
            yield batch.append_column(name, pa.array([t.decode("utf-8", errors="replace") for t in texts], pa.string()))

    rows = coded.drop(name)
    return rows.mapInArrow(tidied(run), rows.withColumn(name, F.lit("")).schema)


def round_trip(documents: DataFrame, path: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per document row: key, piece_ids, n_pieces, decoded_crc32 and whether the pieces decode to the text."""
    prepare(documents.sparkSession)

    def run(batches):
        for batch in pieces(batches, "text", PIECE_BYTES):
            encoder, texts = encoder_of(path), texts_of(batch)
            ids, sizes = encoder.encode(texts)
            decoded = encoder.decode(ids, sizes)
            same = [a == b for a, b in zip(decoded, texts.cast(pa.binary()).to_pylist())]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), listed(ids, sizes), pa.array(sizes, pa.int64()), pa.array(map(zlib.crc32, decoded), pa.int64()), pa.array(same)],
                names=[key, "piece_ids", "n_pieces", "decoded_crc32", "same"])

    rows = documents.select(F.col(key).cast("long").alias(key), F.col(text).alias("text"))
    return rows.mapInArrow(tidied(run), f"{key} long, piece_ids array<int>, n_pieces long, decoded_crc32 long, same boolean")
