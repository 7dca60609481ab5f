import math
import random

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
import zlib

from brute import docs  # noqa: F401
from areastats.llm.double_array import DoubleArray
from areastats.llm.unigram import Unigram, encode_pieces, read_pieces

MODEL = public_tokenizers.path("piece_bpe_32k.model")
TEXTS = [
    "", " ", "  two  spaces ", "\n\nlines\n end \n", "a▁b ▁ c", "日本語 テキスト 🎉x", "\x00\x01a", "a" * 3000, "tab\there",
    "Plain words, and (some) marks!", "é" * 200 + " ñ", "﻿x y", "x" * 70 + " " + "x" * 70,
]


@pytest.fixture(scope="module")
def pieces():
    return read_pieces(MODEL, scores="ranks")


@pytest.fixture(scope="module")
def encoder(pieces):
    return Unigram(pieces)


def test_double_array_finds_every_key_at_every_place():
    random.seed(1)
    keys = {bytes(random.choices(b"abc\xff\x00", k=random.randint(1, 5))): i for i in range(300) for i in [i]}
    trie = DoubleArray.build(keys)
    words = [bytes(random.choices(b"abc\xff\x00d", k=random.randint(1, 12))) for _ in range(50)]
    rows = np.zeros((50, 12), np.int16)
    for i, w in enumerate(words):
        rows[i, : len(w)] = np.frombuffer(w, np.uint8).astype(np.int16) + 1
    found = {(r, c, n, v) for n, row, col, val in trie.matches(rows) for r, c, v in zip(row.tolist(), col.tolist(), val.tolist(), strict=True)}
    want = {(i, c, n, keys[w[c : c + n]]) for i, w in enumerate(words) for c in range(len(w)) for n in range(1, 6) if c + n <= len(w) and w[c : c + n] in keys}
    assert found == want


def test_best_path_against_plain_viterbi(encoder, pieces):
    score = {p.replace("▁", " "): s for p, s, kind in pieces if kind == "piece"}

    def best(word):
        ends = [(0.0, 0)] + [(-1e18, 0)] * len(word)
        for i in range(len(word)):
            for j in range(i + 1, min(len(word), i + 16) + 1):
                s = score.get(word[i:j], encoder.unknown if j == i + 1 else None)
                if s is not None and ends[i][0] + s > ends[j][0]:
                    ends[j] = (ends[i][0] + s, i)
        return ends[-1][0]

    words = [" inane", " Thonst", "\nX", " ñcióndo", " 日本", " a.b!!", " " + "ing" * 40]
    for word, ids in zip(words, encoder.segment(words), strict=True):
        total, run = 0.0, b""
        for i in np.frombuffer(ids, encoder.dtype).tolist():
            if pieces[i][2] == "byte":  # the bytes of one unknown character together
                run += encoder.bytes_of[i]
                try:
                    run.decode()
                except UnicodeDecodeError:
                    continue
                total, run = total + encoder.unknown, b""
            else:
                total += score[pieces[i][0].replace("▁", " ")]
        assert total == pytest.approx(best(word))


def test_against_the_library(encoder, pieces):
    """The same pieces and scores in a unigram model of the library give paths of equal score."""
    proto = pytest.importorskip("sentencepiece.sentencepiece_model_pb2").ModelProto()
    with open(MODEL, "rb") as f:
        proto.ParseFromString(f.read())
    proto.trainer_spec.model_type = 1
    for p, (_, s, kind) in zip(proto.pieces, pieces, strict=True):
        if kind == "piece":
            p.score = s
    library = sentencepiece.SentencePieceProcessor(model_proto=proto.SerializeToString())

    def total(ids):
        return sum(encoder.score[i] if pieces[i][2] == "piece" else -9.0 for i in ids)

    texts = [t for t in TEXTS if "▁" not in t and "\x00" not in t]
    for text, ids in zip(texts, encoder.encode(texts), strict=True):
        assert total(np.frombuffer(ids, encoder.dtype).tolist()) == pytest.approx(total(library.encode(text)), abs=1e-3)


def test_every_text_comes_back(spark, pieces, docs, encoder):
    rows = list(enumerate([*TEXTS, TEXTS[9], None]))
    df = docs(rows, ids="x", n_tokens="y")
    out = {r.doc_id: r for r in encode_pieces(df, pieces).collect()}
    for i, text in rows:
        r = out[i]
        assert r.text == text and r.round_trip == (text is not None) or text is None
        assert r.n_tokens == len(r.ids) and r.ids_crc32 == zlib.crc32(np.array(r.ids, "<u4").tobytes())
        assert (r.n_tokens == 0) == (not text)
    assert encoder.decode(encoder.encode(["a▁b"])[0]) == "a▁b" and out[9].ids == out[len(TEXTS)].ids
    assert encode_pieces(docs([]), pieces).collect() == []
    assert "ids" not in encode_pieces(docs([]), pieces, with_ids=False).columns


def test_words_are_encoded_alike_with_and_without_the_cache(pieces, encoder):
    fresh = Unigram(pieces)
    assert fresh.encode(TEXTS) == fresh.encode(TEXTS) == encoder.encode(TEXTS)


def test_scores_are_taken_as_asked():
    ranked, own = read_pieces(MODEL, scores="ranks"), read_pieces(MODEL)
    assert [p for p, _, _ in ranked] == [p for p, _, _ in own]
    assert min(s for _, s, kind in own if kind == "piece") < -1000  # this file numbers its pieces
    assert sum(math.exp(s) for _, s, kind in ranked if kind == "piece") == pytest.approx(1, abs=1e-6)
    with pytest.raises(ValueError, match="guess"):
        read_pieces(MODEL, scores="guess")
