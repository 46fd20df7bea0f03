import random
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest

from stallbook.llm import piece_codes, token_files

WORD_BPE, PIECES = public_tokenizers.path("word_bpe_49k.json"), public_tokenizers.path("piece_bpe_32k.model")
ODD = [
    "a", "b", "The", "'s", "'t", "'", "re", ".", ",", "!!", "$", "<|", "|>", "<|endoftext|>", "<|ENDOFTEXT|>", "é", "É", "é", "́",
    " ", "  ", "\n", "\t", " ", " ", "\x0b", "\x1c", "\x85", "1", "23", "Σ", "ΣΑΣ", "ﬁ", "İ", "日本", "🙂", "\x00", "_", "-", "≠", "ß", "…", "▁",
    "​", "ing", "tion", " the",
]


def texts(n, seed=1):
    rng = random.Random(seed)
    return ["".join(rng.choice(ODD) for _ in range(rng.randrange(0, 20))) for _ in range(n)]


def rows():
    out = [(100 - i, t) for i, t in enumerate(texts(90))]
    return out + [(200, None), (201, ""), (50, "again"), (50, "again"), (None, "no id"), (202, "word " * 30000), (203, "x" * 20000)]


def test_word_encoder_is_the_library(spark):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(WORD_BPE)
    own = texts(3000, 2)
    ids, sizes = token_files.WordEncoder(WORD_BPE).encode(pa.array(own))
    for t, got in zip(own, np.split(ids, np.cumsum(sizes)[:-1])):
        assert got.tolist() == tokenizer.encode(t, add_special_tokens=False).ids


@pytest.mark.parametrize("size", [49_408, 100_000])
def test_files_read_back(spark, documents, monkeypatch, size):
    from tokenizers import Tokenizer

    monkeypatch.setattr(token_files, "PART_BYTES", 40_000)
    tokenizer = Tokenizer.from_file(WORD_BPE)
    manifest, folder = token_files.write_tokens(documents(rows()), WORD_BPE, end_id=1, vocabulary_size=size)
    got = sorted((tuple(r) for r in token_files.read_tokens(manifest, folder).collect()), key=lambda r: r[1])
    expected, start = [], 0
    for i, t in sorted(rows(), key=lambda r: (-(2**63) if r[0] is None else r[0], r[1] or "")):
        ids = np.array([*tokenizer.encode(t or "", add_special_tokens=False).ids, 1], dtype="<u4")
        expected.append((i, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    assert got == expected
    assert manifest.count() > 1


def test_no_documents_no_files(spark, documents):
    manifest, folder = token_files.write_tokens(documents([]), WORD_BPE, end_id=1)
    assert token_files.read_tokens(manifest, folder).collect() == []


def test_pieces_round_trip(spark, documents):
    got = piece_codes.round_trip(documents(rows()), PIECES).collect()
    assert len(got) == len(rows())
    assert all(r.same for r in got)
    by_id = {r.doc_id: r for r in got}
    assert by_id[200].piece_ids == by_id[201].piece_ids == []
    assert by_id[202].n_pieces >= 30000
    assert piece_codes.round_trip(documents([]), PIECES).collect() == []


def test_encode_and_decode_frames(spark, documents):
    frame = documents(rows())
    both = piece_codes.decode(piece_codes.encode(frame, PIECES), PIECES, name="key")
    assert both.columns == [c for c in frame.columns if c != "key"] + ["piece_ids", "key"]
    assert all(r.key == (r["text"] or "") for r in both.collect())


def test_pieces_have_the_best_score():
    """Against the library's own unigram search over the same pieces, which adds in single precision."""
    import sentencepiece
    from sentencepiece import sentencepiece_model_pb2

    proto = sentencepiece_model_pb2.ModelProto()
    with open(PIECES, "rb") as file:
        proto.ParseFromString(file.read())
    proto.trainer_spec.model_type = 1
    unigram = sentencepiece.SentencePieceProcessor(model_proto=proto.SerializeToString())
    encoder = piece_codes.Encoder(PIECES)
    rng = random.Random(4)
    words = ["".join(rng.choice("thereandingtionéß日☂") for _ in range(rng.randrange(1, 14))) for _ in range(3000)]
    ids, sizes = encoder.encode(pa.array(words))
    floor = encoder.vocabulary.unknown

    def score(own):
        return sum(floor / 3 if unigram.is_byte(int(i)) else proto.pieces[int(i)].score for i in own)

    same = 0
    for word, own in zip(words, np.split(ids, np.cumsum(sizes)[:-1])):
        theirs = unigram.encode(word)
        same += own.tolist() == theirs
        assert score(own) >= score(theirs) - 1e-3 or any(unigram.is_byte(int(i)) for i in own)
    assert same > 0.99 * len(words)


def test_short_and_long_words_take_the_same_steps():
    vocabulary = piece_codes.Vocabulary(PIECES)
    word = "▁" + "therethationing日" * 5
    points = np.frombuffer(word.encode("utf-32-le"), dtype="<u4").astype(np.uint64)[None]
    one, _ = vocabulary.segment(points)
    many, sizes = vocabulary.segment(np.repeat(points, 9, axis=0))
    assert sizes.tolist() == [len(one)] * 9 and many[: len(one)].tolist() == one.tolist()
