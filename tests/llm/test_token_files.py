import random
import zlib
from pathlib import Path

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from brute import docs  # noqa: F401
from areastats.llm.elias_fano import EliasFano
from areastats.llm.token_files import CachedEncoder, read_digests, read_documents, read_ids, write_token_files
from areastats.session import shared_folder

PATH = public_tokenizers.path("byte_bpe_50k.json")
JSON = Path(PATH).read_text(encoding="utf-8")
TEXTS = [
    "", " ", "  a  b\n\nc \nd ", "x.\n y", "\n", "a\t b\n\t\nq", "é. ñ,  z", "<|endoftext|> a<|endoftext|>.\n", "a" * 50 + ". b",
    "a\r\nb \r\n c", "a.. b!! C?!\n", "it's we'll. don't, \n's", "1,000.5% (x) -- y...", "word. word, word", "日本語。 　x", "\x1c y\x85 z",
    "Ünï cöde. 🎉! ok",
]


@pytest.mark.parametrize("values", [[], [0], [0, 0, 5], [7], list(range(1000)), [10**12], [0, 10**9, 10**9, 2 * 10**9]])
def test_elias_fano(values):
    code = EliasFano.from_bytes(EliasFano.encode(np.array(values, np.int64)).to_bytes())
    assert code.decode().tolist() == values and [code.select(i) for i in range(len(code))] == values


def test_elias_fano_takes_little_space():
    random.seed(2)
    values = np.cumsum([random.randint(1, 2000) for _ in range(20_000)])
    code = EliasFano.encode(values)
    assert len(code.to_bytes()) * 8 / 20_000 < 2 + np.log2(values[-1] / 20_000) + 3
    assert [code.select(i) for i in range(0, 20_000, 97)] == values[::97].tolist()
    for first, last in ((0, 0), (0, 1), (63, 65), (64, 128), (1000, 7777), (19_999, 20_000), (20_000, 20_000)):
        assert code.select_many(first, last).tolist() == values[first:last].tolist()
    with pytest.raises(IndexError):
        code.select_many(5, 20_001)
    with pytest.raises(ValueError):
        EliasFano.encode(np.array([2, 1]))
    with pytest.raises(IndexError):
        code.select(20_000)


def test_cached_words_give_the_library_s_ids():
    encoder, tokenizer = CachedEncoder(JSON), Tokenizer.from_file(PATH)
    want = [np.array(tokenizer.encode(t, add_special_tokens=False).ids, "<u2").tobytes() for t in TEXTS]
    assert encoder.encode(TEXTS) == want == encoder.encode(TEXTS)


@pytest.mark.parametrize("segment", [1, 50, 1 << 18])
def test_files_against_the_library(spark, docs, segment):
    tokenizer = Tokenizer.from_file(PATH)
    rows = [(7 * i % 101 - 20, t) for i, t in enumerate([*TEXTS, None, "long " * 30_000])]
    path = shared_folder(spark, "tokens")
    write_token_files(docs(rows, start=1, part="x"), path, JSON, segment_ids=segment, partitions=3)
    want, start = {}, 0
    for i, t in sorted(rows):
        ids = [*tokenizer.encode(t or "", add_special_tokens=False).ids, 0]
        want[i] = (start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()), ids)
        start += len(ids)
    assert {r.doc_id: (r.start, r.n_tokens, r.ids_crc32) for r in read_digests(spark, path).collect()} == {i: v[:3] for i, v in want.items()}
    assert {r.doc_id: r.ids for r in read_ids(spark, path).collect()} == {i: v[3] for i, v in want.items()}
    some = [*list(want)[::3], 10**9]
    assert {r.doc_id: r.ids for r in read_documents(spark, path, some).collect()} == {i: want[i][3] for i in some[:-1]}
    assert read_documents(spark, path, []).collect() == []


def test_ties_null_ids_and_empty_tables(spark, docs):
    path = shared_folder(spark, "tokens")
    write_token_files(docs([(5, "b"), (5, "a"), (None, "c"), (5, "a")]), path, JSON, partitions=2)
    out = sorted(read_digests(spark, path).collect(), key=lambda r: r.start)
    assert [(r.doc_id, r.start, r.n_tokens) for r in out] == [(None, 0, 2), (5, 2, 2), (5, 4, 2), (5, 6, 2)]
    path = shared_folder(spark, "tokens")
    write_token_files(docs([]), path, JSON)
    assert read_digests(spark, path).collect() == [] == read_ids(spark, path).collect()


def test_other_tokenizers_get_whole_texts(spark, docs):
    path = public_tokenizers.path("word_bpe_49k.json")
    encoder, tokenizer = CachedEncoder(Path(path).read_text(encoding="utf-8")), Tokenizer.from_file(path)
    assert not encoder.by_word and CachedEncoder(JSON).by_word
    want = [tokenizer.encode(t, add_special_tokens=False).ids for t in TEXTS]
    assert [np.frombuffer(b, encoder.dtype).tolist() for b in encoder.encode(TEXTS)] == want


def test_words_of_letters_give_the_ids_that_the_library_gives():
    random.seed(5)
    encoder = CachedEncoder(JSON)
    letters = [c for c in map(chr, [*range(65, 0x3000, 7), *range(0x4E00, 0x9000, 501), 0x10400, 0x1D400, 0x20000]) if c.isalpha()]
    words = ["".join(random.choices(letters if i % 2 else "abcdefgheinst", k=random.randint(1, 12))) for i in range(3000)]
    words += ["x1", "a'b", "½", "²", "٣", "word", "Été", "e\u0301", "don't"]
    assert encoder.word_ids(words) == dict(zip(words, encoder.ids([f" {w}" for w in words]), strict=True))

