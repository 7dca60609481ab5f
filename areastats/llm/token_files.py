"""Token ids as binary files with Elias-Fano encoded document boundaries.

The documents are ordered by id over range partitions. Every partition writes segments: whole
documents, about ``SEGMENT_IDS`` ids each. A segment is one row of a Parquet table, so Spark's
writer commits it, a lost task writes it again, and readers need no other file system:

``part``, ``before``  place of the segment: its part, and the ids that stand before it in the part
``first_id``, ``last_id``  the lowest and highest id of its documents
``doc_ids``         ids of its documents, in order (NULL first)
``n_ids``           how many token ids it holds
``ids``             the token ids of all documents, end ids included, little endian, 2 or 4 bytes
``width``           bytes of an id: 2 if every id of the vocabulary fits
``ends``            Elias-Fano code of the place after each document's last id

No table of 64-bit offsets is kept: readers select boundaries within a segment from the code, and where a
part begins is the number of ids in the parts before it.
"""

from __future__ import annotations

import json
import os
import re
import zlib
from array import array
from collections.abc import Callable, Iterable, Iterator, Sequence
from itertools import pairwise
from string import punctuation

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from areastats.llm.common import narrow, text_hash, worker_store
from areastats.llm.elias_fano import EliasFano

#: Ids in a segment, unless a single document has more.
SEGMENT_IDS = 1 << 18
#: Words whose ids a worker keeps.
CACHE_WORDS = 1_600_000
#: Longer words are not kept.
CACHE_LENGTH = 40
_SEGMENTS = "part int, before long, first_id long, last_id long, doc_ids array<long>, n_ids long, ids binary, width int, ends binary"
_ROWS = "doc_id long, start long, n_tokens long, ids_crc32 long"
#: White space after which a break or a space does not begin a part of its own.
_INNER = re.compile(r"\s[ \n]")
_MARKS = frozenset(punctuation)
_START = re.compile(r"(?<=\S)(?=[ \n])")


def split_words(text: str) -> list[str]:
    """``text`` cut before every space or line break that follows a visible character.

    A byte-level tokenizer of this family never joins characters across such a place, so the ids
    of a text are the ids of its parts. All parts but the first are named without their space;
    ``part_text`` gives them back.
    """
    if _INNER.search(text):
        first, *rest = _START.split(text)
        return [first, *(p[1:] if p[0] == " " and p[1:2] not in (" ", "\n") else p for p in rest)]
    return text.replace("\n", " \n").split(" ")


def byte_chars() -> dict[int, str]:
    """The character that byte-level models write for each byte: itself if it can be seen, else one from 256 on."""
    seen = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in seen]
    return {b: chr(b) for b in seen} | {b: chr(256 + i) for i, b in enumerate(hidden)}


_BYTE_CHARS = byte_chars()


def part_text(name: str) -> str:
    """The part that a name from ``split_words`` (not the first) stands for."""
    return name if name[:1] in (" ", "\n") and name else f" {name}"


def cuts_words(config: dict) -> bool:
    """Whether the tokenizer gives a text the ids of its words, one after the other."""
    cutter, model = config.get("pre_tokenizer") or {}, config["model"]
    usual = cutter.get("type") == "ByteLevel" and cutter.get("use_regex", True) and not cutter.get("add_prefix_space", True)
    plain = model.get("type") == "BPE" and not model.get("dropout") and not model.get("continuing_subword_prefix")
    return bool(usual and plain and not config.get("normalizer") and not model.get("end_of_word_suffix"))


class CachedEncoder:
    """The tokenizers library, asked once for every word that a worker meets.

    That holds for byte-level tokenizers that cut texts by the usual pattern and change nothing before;
    any other one gets whole texts.
    """

    def __init__(self, tokenizer_json: str):
        # Spark has a task for every core; threads within a task only cost more processor time.
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(tokenizer_json)
        self.by_word = cuts_words(json.loads(tokenizer_json))
        self.width = 2 if self.tokenizer.get_vocab_size(with_added_tokens=True) <= 1 << 16 else 4
        self.dtype = np.dtype(f"<u{self.width}")
        self.words: dict[str, bytes] = {}
        self.marks: dict[str, bytes] = {}
        self.added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.plain_letters = not any(t.strip().isalpha() for t in self.added)

    def ids(self, texts: list[str]) -> list[bytes]:
        code = "H" if self.width == 2 else "I"
        return [array(code, e.ids).tobytes() for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def word_ids(self, words: Iterable[str]) -> dict[str, bytes]:
        """Ids of words with the space before each, by word.

        The cutter leaves letters behind a space together, so words of letters go straight to the model.
        """
        code, space, tokenize = "H" if self.width == 2 else "I", _BYTE_CHARS[32], self.tokenizer.model.tokenize
        out, other = {}, []
        for w in words:
            if w.isalpha() and self.plain_letters:
                chars = w if w.isascii() else w.encode().decode("latin-1").translate(_BYTE_CHARS)
                out[w] = array(code, [t.id for t in tokenize(space + chars)]).tobytes()
            else:
                other.append(w)
        out.update(zip(other, self.ids([part_text(w) for w in other]), strict=True))
        return out

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of every text, as bytes."""
        if not self.by_word:
            return self.ids(texts)
        parts = [split_words(t) for t in texts]
        firsts = self.ids([p.pop(0) for p in parts])
        if len(self.words) > CACHE_WORDS:
            self.words.clear()
            self.marks.clear()
        known = self.words
        new = set().union(*parts).difference(known)
        # Marks behind a letter or digit are tokenised on their own, so "word." is "word" and ".".
        heads = [(w, w.rstrip(punctuation)) for w in new if w[-1:] in _MARKS]
        added = [t for t in self.added if any(t in text for text in texts)]
        marked = [(w, h, w[len(h) :]) for w, h in heads if h[-1:].isalnum() and not any(t in w for t in added)]
        plain = new.difference([w for w, _, _ in marked])
        plain.update(h for _, h, _ in marked if h not in known)
        known.update(self.word_ids(plain))
        tails = list({t for _, _, t in marked}.difference(self.marks))
        self.marks.update(zip(tails, self.ids(tails), strict=True))
        marks = self.marks
        known.update([(w, known[h] + marks[t]) for w, h, t in marked])
        get = known.__getitem__
        out = [first + b"".join(map(get, p)) for first, p in zip(firsts, parts, strict=True)]
        for w in {w for w in new if len(w) > CACHE_LENGTH}.union(w for w in plain if len(w) > CACHE_LENGTH):
            del known[w]
        return out


def chunks(texts: list[str], size: int = 1 << 20) -> Iterator[slice]:
    """Slices of about ``size`` characters."""
    start, total = 0, 0
    for i, t in enumerate(texts):
        total += len(t)
        if total >= size:
            yield slice(start, i + 1)
            start, total = i + 1, 0
    if start < len(texts):
        yield slice(start, len(texts))


def segment_writer(tokenizer_json, end_id: int, segment_ids: int) -> Callable:
    """Function for ``mapInArrow`` over the ordered documents of a partition."""

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        store = worker_store()
        encoder = store.get("encoder")
        if encoder is None or store.get("encoder_of") != tokenizer_json.value:
            encoder = CachedEncoder(tokenizer_json.value)
            store.update(encoder=encoder, encoder_of=tokenizer_json.value)
        part, before = TaskContext.get().partitionId(), 0
        schema = pa.schema(
            [("part", pa.int32()), ("before", pa.int64()), ("first_id", pa.int64()), ("last_id", pa.int64()), ("doc_ids", pa.list_(pa.int64())), ("n_ids", pa.int64()),
             ("ids", pa.binary()), ("width", pa.int32()), ("ends", pa.binary())]
        )
        end = np.array([end_id], dtype=encoder.dtype).tobytes()
        doc_ids, blobs, total = [], [], 0

        def segment() -> pa.RecordBatch:
            ends = np.cumsum([len(b) // encoder.width for b in blobs])
            known = [i for i in doc_ids if i is not None]
            row = (part, before, min(known, default=None), max(known, default=None), doc_ids, total, b"".join(blobs), encoder.width, EliasFano.encode(ends).to_bytes())
            return pa.RecordBatch.from_arrays([pa.array([v], type=f.type) for v, f in zip(row, schema, strict=True)], schema=schema)

        for batch in batches:
            ids = batch.column("doc_id").to_pylist()
            texts = [t or "" for t in batch.column("text").to_pylist()]
            for cut in chunks(texts):
                for doc_id, blob in zip(ids[cut], encoder.encode(texts[cut]), strict=True):
                    doc_ids.append(doc_id)
                    blobs.append(blob + end)
                    total += len(blobs[-1]) // encoder.width
                    if total >= segment_ids:
                        yield segment()
                        doc_ids, blobs, before, total = [], [], before + total, 0
        if blobs:
            yield segment()

    return write


def write_token_files(
    docs: DataFrame,
    path: str,
    tokenizer_json: str,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    end_id: int = 0,
    segment_ids: int = SEGMENT_IDS,
    partitions: int | None = None,
) -> None:
    """Encode every whole text and write the ids to ``path`` in ascending order of the id.

    Each document ends with ``end_id``, so a NULL or empty text is that id alone. Rows with equal
    ids are ordered by a hash of the text, then the text; a NULL id comes first. Other columns
    are not looked at. An empty table writes no segment. Ids must be integers.
    """
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(tokenizer_json)  # the vocabulary: fixed size
    n = partitions or max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    rows = narrow(docs, id_col, text_col).withColumn("th", text_hash(F.col("text")))
    ordered = rows.repartitionByRange(n, "doc_id", "th").sortWithinPartitions("doc_id", "th", "text")
    segments = ordered.select("doc_id", "text").mapInArrow(segment_writer(shared, end_id, segment_ids), _SEGMENTS)
    segments.write.option("compression", "zstd").parquet(path)


def _boundaries(code: EliasFano) -> list[int]:
    """Where each document of a segment begins, and the end of the last."""
    return [0, *code.select_many(0, len(code)).tolist()]


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()), ("ids_crc32", pa.int64())])
    for batch in batches:
        for i in range(batch.num_rows):
            doc_ids, ids, width, ends, base = (
                batch.column(c)[i].as_py() for c in ("doc_ids", "ids", "width", "ends", "base")
            )
            cuts = _boundaries(EliasFano.from_bytes(ends))
            wide = memoryview(np.frombuffer(ids, dtype=f"<u{width}").astype("<u4").tobytes())
            crc = [zlib.crc32(wide[4 * a : 4 * b]) for a, b in pairwise(cuts)]
            columns = [doc_ids, [a + base for a in cuts[:-1]], np.diff(cuts), crc]
            arrays = [pa.array(c, type=pa.int64()) for c in columns]
            yield pa.RecordBatch.from_arrays(arrays, schema=schema)


def _ids(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("doc_id", pa.int64()), ("ids", pa.list_(pa.int64()))])
    for batch in batches:
        for i in range(batch.num_rows):
            doc_ids, ids, width, ends = (batch.column(c)[i].as_py() for c in ("doc_ids", "ids", "width", "ends"))
            cuts = _boundaries(EliasFano.from_bytes(ends))
            flat = pa.array(np.frombuffer(ids, dtype=f"<u{width}").astype(np.int64))
            lists = pa.ListArray.from_arrays(pa.array(cuts, type=pa.int32()), flat)
            yield pa.RecordBatch.from_arrays([pa.array(doc_ids, type=pa.int64()), lists], schema=schema)


def read_ids(spark: SparkSession, path: str) -> DataFrame:
    """``doc_id`` and its ``ids``, the end id included."""
    segments = spark.read.schema(_SEGMENTS).parquet(path)
    return segments.select("doc_ids", "ids", "width", "ends").mapInArrow(_ids, "doc_id long, ids array<long>")


def read_documents(spark: SparkSession, path: str, wanted: Sequence[int]) -> DataFrame:
    """``doc_id`` and ``ids`` of some documents: only their segments are opened, and two boundaries selected for each.

    An id that several documents share gives all of them; one that no document has gives none.
    """
    some = sorted(set(wanted))
    schema = pa.schema([("doc_id", pa.int64()), ("ids", pa.list_(pa.int64()))])

    def pick(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                doc_ids, ids, width, ends = (batch.column(c)[i].as_py() for c in ("doc_ids", "ids", "width", "ends"))
                code, flat = EliasFano.from_bytes(ends), np.frombuffer(ids, dtype=f"<u{width}")
                at = np.flatnonzero(np.isin([-1 if d is None else d for d in doc_ids], some)).tolist()
                at = [k for k in at if doc_ids[k] is not None]
                lists = [flat[code.select(k - 1) if k else 0 : code.select(k)].astype(np.int64) for k in at]
                yield pa.RecordBatch.from_arrays([pa.array([doc_ids[k] for k in at], pa.int64()), pa.array(lists, pa.list_(pa.int64()))], schema=schema)

    segments = spark.read.schema(_SEGMENTS).parquet(path)
    if not some:
        return segments.limit(0).select(F.lit(0).cast("long").alias("doc_id"), F.array(F.lit(0).cast("long")).alias("ids"))
    near = segments.where((F.col("last_id") >= some[0]) & (F.col("first_id") <= some[-1]))
    near = near.where(F.exists(F.lit(some), lambda d: (d >= F.col("first_id")) & (d <= F.col("last_id"))))
    return near.select("doc_ids", "ids", "width", "ends").mapInArrow(pick, "doc_id long, ids array<long>")


def read_digests(spark: SparkSession, path: str) -> DataFrame:
    """Per document of the files: first place in the whole id sequence, length, checksum of the ids."""
    segments = spark.read.schema(_SEGMENTS).parquet(path)
    so_far = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    # One row per partition that wrote, so it can be summed in one place and broadcast; no row of
    # a document moves.
    parts = segments.groupBy("part").agg(F.sum("n_ids").alias("n"))
    parts = parts.select("part", F.coalesce(F.sum("n").over(so_far), F.lit(0)).alias("part_base"))
    rows = segments.join(F.broadcast(parts), "part")
    rows = rows.select("doc_ids", "ids", "width", "ends", (F.col("part_base") + F.col("before")).alias("base"))
    return rows.mapInArrow(_digests, _ROWS)
