"""Unigram pieces: the best segmentation by the sum of log scores, and back to text.

A text gets a space in front and every space belongs to the word after it, as the whitespace
marker does in a piece file. Pieces never hold a space behind another character and never a line
break, so words and lines are segmented on their own, each distinct word once per worker. All new
words of a batch go through the trie and the Viterbi recursion together. A character that is no
piece costs ``UNKNOWN`` less than the worst piece and is written as its bytes, so every text comes
back unchanged, also one that holds the marker character itself.
"""

from __future__ import annotations

import math
import re
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from areastats.llm.common import worker_store
from areastats.llm.double_array import DoubleArray
from areastats.llm.token_files import chunks

#: The whitespace marker of piece files.
MARKER = "▁"
#: How much worse than the worst piece an unknown character is.
UNKNOWN = 10.0
#: Zipf-Mandelbrot shift for scores from ranks.
SHIFT = 2.7
#: Words whose pieces a worker keeps.
CACHE_WORDS = 600_000
CACHE_LENGTH = 60
_SEGMENT = re.compile(r" +[^ \n]*|\n[^ \n]*")
_BYTE = re.compile(r"<0x([0-9A-F]{2})>")


def read_pieces(model_file: str, scores: str = "file") -> list[tuple[str, float, str]]:
    """Piece, log score and kind (``piece``, ``byte``, ``other``) by id, from a model file.

    ``scores`` says what the file holds: ``file`` takes its scores as log scores, ``ranks`` only their order, for files
    that number their pieces. The probability of a piece then falls with its rank, by Zipf's law.
    """
    if scores not in ("file", "ranks"):
        raise ValueError(f"scores are 'file' or 'ranks', not {scores!r}")
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=model_file)
    out = []
    for i in range(model.get_piece_size()):
        other = model.is_control(i) or model.is_unknown(i) or model.is_unused(i)
        kind = "byte" if model.is_byte(i) else "other" if other else "piece"
        out.append((model.id_to_piece(i), model.get_score(i), kind))
    normal = [s for _, s, kind in out if kind == "piece"]
    if scores == "ranks" and normal:
        total = math.log(sum(1 / (r + SHIFT) for r in range(len(normal))))
        rank = {s: r for r, s in enumerate(sorted(set(normal), reverse=True))}
        out = [(p, -math.log(rank[s] + SHIFT) - total if kind == "piece" else s, kind) for p, s, kind in out]
    return out


class Unigram:
    """Encoder and decoder over ``(piece, log score, kind)`` rows."""

    def __init__(self, pieces: list[tuple[str, float, str]]):
        normal = {p.replace(MARKER, " ").encode(): i for i, (p, _, kind) in enumerate(pieces) if kind == "piece" and p}
        if any(b" " in k.lstrip(b" ") or b"\n" in k for k in normal):
            raise ValueError("a piece holds a space behind another character, or a line break")
        self.trie = DoubleArray.build(normal)
        self.score = np.array([s for _, s, _ in pieces])
        self.unknown = min(pieces[i][1] for i in normal.values()) - UNKNOWN
        self.byte_id = np.full(256, -1, np.int64)
        self.bytes_of = [b""] * len(pieces)
        for i, (p, _, kind) in enumerate(pieces):
            if kind == "byte":
                self.byte_id[int(_BYTE.fullmatch(p)[1], 16)] = i
                self.bytes_of[i] = bytes([int(_BYTE.fullmatch(p)[1], 16)])
            elif kind == "piece":
                self.bytes_of[i] = p.replace(MARKER, " ").encode()
        if (self.byte_id < 0).any():
            raise ValueError("byte pieces are missing")
        self.dtype = np.dtype("<u2" if len(pieces) <= 1 << 16 else "<u4")
        self.words: dict[str, bytes] = {}

    def segment(self, words: list[str]) -> list[bytes]:
        """Ids of each word, which stands for itself; no space or marker is added here."""
        coded = [w.encode() for w in words]
        out: list[bytes] = [b""] * len(words)
        # Words of similar length together, so that short ones do not wait for long ones.
        order = sorted(range(len(words)), key=lambda i: len(coded[i]))
        start = 0
        while start < len(order):
            longest = max(16, 2 * len(coded[order[start]]))
            stop = start
            while stop < len(order) and len(coded[order[stop]]) <= longest and (stop - start) * longest < 1 << 20:
                stop += 1
            stop = max(stop, start + 1)
            some = order[start:stop]
            for i, ids in zip(some, self._viterbi([coded[i] for i in some]), strict=True):
                out[i] = ids
            start = stop
        return out

    def _viterbi(self, words: list[bytes]) -> list[bytes]:
        lengths = np.array([len(w) for w in words])
        n, width = len(words), int(lengths.max(initial=0))
        if width == 0:
            return [b""] * n
        joined = np.frombuffer(b"".join(words), np.uint8).astype(np.int16) + 1
        rows = np.zeros((n, width), np.int16)
        rows[np.arange(width) < lengths[:, None]] = joined
        # Edges of the lattice by start and length.
        size = np.select([rows > 0xF0, rows > 0xE0, rows > 0xC0, rows > 0x80, rows > 0], [4, 3, 2, 0, 1], 0)
        covered = np.zeros((n, width), bool)
        edges: dict[tuple[int, int], tuple[np.ndarray, np.ndarray, np.ndarray]] = {}
        for length, row, column, piece in self.trie.matches(rows):
            whole = size[row, column] == length
            covered[row[whole], column[whole]] = True
            by = np.argsort(column, kind="stable")
            columns, firsts = np.unique(column[by], return_index=True)
            for c, some in zip(columns.tolist(), np.split(by, firsts[1:]), strict=True):
                edges[c, length] = row[some], piece[some], self.score[piece[some]]
        row, column = np.nonzero((size > 0) & ~covered)
        for c in np.unique(column).tolist():
            for length in (1, 2, 3, 4):
                some = row[(column == c) & (size[row, column] == length)]
                if len(some):
                    old = edges.get((c, length))
                    new = (some, np.full(len(some), -1), np.full(len(some), self.unknown))
                    edges[c, length] = new if old is None else tuple(map(np.concatenate, zip(old, new, strict=True)))
        best = np.full((n, width + 1), -np.inf)
        best[:, 0] = 0
        came, by_piece = np.zeros((n, width + 1), np.int32), np.zeros((n, width + 1), np.int32)
        for c, length in sorted(edges):
            row, piece, score = edges[c, length]
            total = best[row, c] + score
            better = total > best[row, c + length]
            row, piece = row[better], piece[better]
            best[row, c + length], came[row, c + length], by_piece[row, c + length] = total[better], c, piece
        # Back from the ends, all words at once.
        at, alive = lengths.copy(), np.flatnonzero(lengths)
        trail = []
        while len(alive):
            end = at[alive]
            begin = came[alive, end]
            trail.append((alive, by_piece[alive, end], begin, end))
            at[alive] = begin
            alive = alive[begin > 0]
        word = np.concatenate([t[0] for t in trail])
        step = np.concatenate([np.full(len(t[0]), -k) for k, t in enumerate(trail)])
        by = np.lexsort((step, word))
        piece = np.concatenate([t[1] for t in trail])[by]
        starts = np.concatenate([[0], np.cumsum(np.bincount(word, minlength=n))])
        flat = piece.astype(self.dtype).tobytes()
        k = self.dtype.itemsize
        out = [flat[k * a : k * b] for a, b in zip(starts[:-1].tolist(), starts[1:].tolist(), strict=True)]
        begin, end = np.concatenate([t[2] for t in trail])[by], np.concatenate([t[3] for t in trail])[by]
        for i in np.unique(word[by][piece < 0]).tolist():
            ids: list[int] = []
            for j in range(starts[i], starts[i + 1]):
                unknown = words[i][begin[j] : end[j]]
                ids += [int(piece[j])] if piece[j] >= 0 else self.byte_id[list(unknown)].tolist()
            out[i] = np.array(ids, self.dtype).tobytes()
        return out

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of every text, as little-endian integers of the encoder's width."""
        parts = [parts_of(t) for t in texts]
        if len(self.words) > CACHE_WORDS:
            self.words.clear()
        known = self.words
        new = list(set().union(*parts).difference(known.keys()))
        known.update(zip(new, self.segment([w if w[:1] == "\n" else f" {w}" for w in new]), strict=True))
        out = [b"".join([known[w] for w in p]) for p in parts]
        for w in new:
            if len(w) > CACHE_LENGTH:
                del known[w]
        return out

    def decode(self, ids: bytes) -> str:
        """The text of the ids: markers become spaces, byte pieces bytes, the first space goes."""
        pieces = np.frombuffer(ids, self.dtype).tolist()
        return b"".join(map(self.bytes_of.__getitem__, pieces)).decode("utf-8", "replace").removeprefix(" ")


def parts_of(text: str) -> list[str]:
    """Words of the text: those with a space in front without it, those after a line break with the break."""
    if not text:
        return []
    if "  " in text or text[0] == " ":
        return [s[1:] if s[0] == " " else s for s in _SEGMENT.findall(f" {text}")]
    return text.replace("\n", " \n").split(" ")


def encoder_in_worker(pieces) -> Unigram:
    store = worker_store()
    if store.get("unigram_of") != pieces.value:
        store.update(unigram=Unigram(pieces.value), unigram_of=pieces.value)
    return store["unigram"]


def encode_pieces(
    docs: DataFrame, pieces: list[tuple[str, float, str]], *, text_col: str = "text", with_ids: bool = True
) -> DataFrame:
    """``docs`` with the text encoded and decoded again.

    The text column becomes what the ids decode to (the same text). New last columns: ``n_tokens``,
    ``n_bytes`` (byte pieces among them), ``ids_crc32`` (checksum of the ids as 32-bit little-endian
    integers), ``round_trip`` (the decoded text equals the given one) and, with ``with_ids``,
    ``ids``. A column of ``docs`` with such a name is replaced. A NULL text stays NULL with no ids;
    an empty one has none either. Work is per row, so repeated rows and ties do not matter.
    """
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(pieces)  # the vocabulary: fixed size
    added = "n_tokens int, n_bytes int, ids_crc32 long, round_trip boolean" + ", ids array<int>" * with_ids
    names = [a.split()[0] for a in added.replace("array<int>", "array").split(", ")]
    kept = docs.select(*[F.col(f"`{c}`") for c in docs.columns if c not in names])
    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema] + [added])
    return kept.mapInArrow(_encoder(shared, kept.columns.index(text_col), with_ids), schema)


def _encoder(pieces, text_at: int, with_ids: bool) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = encoder_in_worker(pieces)
        for whole in batches:
            given = whole.column(text_at).to_pylist()
            for cut in chunks([t or "" for t in given]):
                batch = whole.slice(cut.start, cut.stop - cut.start)
                texts = given[cut]
                coded = encoder.encode([t or "" for t in texts])
                back = [encoder.decode(c) if t is not None else None for c, t in zip(coded, texts, strict=True)]
                ids = [np.frombuffer(c, encoder.dtype) for c in coded]
                is_byte = np.zeros(len(encoder.bytes_of), bool)
                is_byte[encoder.byte_id] = True
                arrays = list(batch.columns)
                arrays[text_at] = pa.array(back, type=batch.schema.field(text_at).type)
                arrays += [
                    pa.array([len(i) for i in ids], type=pa.int32()),
                    pa.array([int(is_byte[i].sum()) for i in ids], type=pa.int32()),
                    pa.array([zlib.crc32(i.astype("<u4").tobytes()) for i in ids], type=pa.int64()),
                    pa.array([a == b for a, b in zip(back, texts, strict=True)]),
                ]
                new = ["n_tokens", "n_bytes", "ids_crc32", "round_trip"]
                if with_ids:
                    ends = np.cumsum([0, *map(len, ids)])
                    flat = pa.array(np.concatenate([*ids, np.zeros(0, encoder.dtype)]).astype(np.int32))
                    arrays.append(pa.ListArray.from_arrays(pa.array(ends, type=pa.int32()), flat))
                    new.append("ids")
                yield pa.RecordBatch.from_arrays(arrays, names=[*batch.schema.names, *new])

    return run
