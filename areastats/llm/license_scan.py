"""Licence statements by ordered signature rules.

Each text is read as words once. Only rules whose keywords all stand in it are tried, so most texts
cost a look-up per word. Where detections overlap, the levels of the rules decide: a detection goes if
one of a higher level lies inside it or around it, or one of its own level around it (of
equal stretches the earlier rule stays). Stretches that overlap without containment both stay. The
base phrases are always reported and suppress nothing.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from areastats.llm.common import inner_prefix, worker_store
from areastats.llm.license_rules import CONFIDENCE, Rule, all_rules
from areastats.llm.ngram_table import words_of

#: A detection: label, order of its rule, level, whether a base phrase, first word, word after the last.
_SPAN = pa.struct([("label", pa.string()), ("rule", pa.int32()), ("level", pa.int32()), ("base", pa.bool_()), ("start", pa.int64()), ("end", pa.int64())])
SPANS = "array<struct<label:string,rule:int,level:int,base:boolean,start:bigint,end:bigint>>"


@dataclass(frozen=True)
class Found:
    rule: Rule
    start: int
    end: int


class Scanner:
    """All rules, found by their keywords."""

    def __init__(self, rules: Sequence[Rule] | None = None):
        self.rules = list(all_rules() if rules is None else rules)
        self.keywords = frozenset().union(*(r.keywords for r in self.rules))

    def scan(self, words: Sequence[bytes]) -> list[Found]:
        """Every match of every rule, before suppression."""
        here = self.keywords.intersection(words)
        if not here:
            return []
        tried = [r for r in self.rules if r.keywords <= here]
        if not tried:
            return []
        text = b" " + b" ".join(words) + b" "
        spots = [(r, m.start(), m.end()) for r in tried for m in r.pattern.finditer(text)]
        spaces = np.flatnonzero(np.frombuffer(text, np.uint8) == 32)
        starts = np.searchsorted(spaces, [a for _, a, _ in spots]) - 1
        ends = np.searchsorted(spaces, [b for _, _, b in spots])
        return [Found(r, a, b) for (r, _, _), a, b in zip(spots, starts.tolist(), ends.tolist(), strict=True)]

    def detect(self, words: Sequence[bytes]) -> list[Found]:
        """What is left of ``scan`` after suppression, by place."""
        found = self.scan(words)
        return sorted([f for f in found if f.rule.base] + resolved([f for f in found if not f.rule.base]), key=_place)


def _place(f: Found) -> tuple[int, int, int]:
    return f.start, -f.end, f.rule.order


def resolved(found: Sequence[Found]) -> list[Found]:
    """Detections that none of a higher level contains or is contained in, and none of the same level contains."""
    kept: list[Found] = []
    for level in sorted({f.rule.level for f in found}, reverse=True):
        above = sorted(kept, key=_place)
        starts = [f.start for f in above]
        furthest = list(accumulate((f.end for f in above), max))
        nearest = list(accumulate((f.end for f in reversed(above)), min))[::-1]
        reach = -1
        for f in sorted((f for f in found if f.rule.level == level), key=_place):
            if f.end <= reach:  # sorted by start, so what reaches as far contains it
                continue
            reach = f.end
            before, behind = bisect_right(starts, f.start), bisect_left(starts, f.start)
            around = before > 0 and furthest[before - 1] >= f.end
            inside = behind < len(above) and nearest[behind] <= f.end
            if not around and not inside:
                kept.append(f)
    return kept


def _finder() -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store = worker_store()
        scanner = store.get("license_scanner") or store.setdefault("license_scanner", Scanner())
        for batch in batches:
            n_words, spans = [], []
            for text in batch.column("text"):
                words = words_of((text.as_py() or "").encode("utf-8", "surrogatepass"))
                n_words.append(len(words))
                spans.append([(f.rule.label, f.rule.order, f.rule.level, f.rule.base, f.start, f.end) for f in scanner.detect(words)])
            names = [f.name for f in _SPAN]
            rows = pa.array([[dict(zip(names, s, strict=True)) for s in one] for one in spans], type=pa.list_(_SPAN))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(n_words, type=pa.int64()), rows], names=["doc_id", "n_words", "spans"])

    return run


def find_licenses(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id``, ``n_words`` and ``spans`` (detections by place) of every row.

    NULL and empty texts have no words and no detections. Texts are scanned whole. Rows with equal ids
    are looked at one by one. Other columns are not looked at; the table may be empty.
    """
    rows = docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").alias("text"))
    id_type = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(_finder(), f"doc_id {id_type}, n_words long, spans {SPANS}")


def license_report(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id``, ``n_words``, ``n_base``, ``first_word``, ``last_word``, ``base_labels``, ``labels`` and ``score`` of every row.

    ``n_base`` counts places of base phrases, ``first_word`` and ``last_word`` are their smallest and largest
    start. Labels are distinct, in order, joined by commas. ``score`` is the chance that at least one label
    holds, each as sure as its surest detection.
    """
    found = find_licenses(docs, id_col=id_col, text_col=text_col)
    base = F.filter("spans", lambda s: s["base"])
    starts = F.transform(base, lambda s: s["start"])

    def labels(spans):
        return F.array_distinct(F.transform(spans, lambda s: s["label"]))

    sure = F.create_map(*[F.lit(v) for pair in CONFIDENCE.items() for v in pair])
    level = F.transform(
        labels(F.col("spans")),
        lambda name: F.array_max(F.transform(F.filter("spans", lambda s: s["label"] == name), lambda s: s["level"])),
    )
    doubt = F.aggregate(level, F.lit(1.0), lambda p, n: p * (1 - sure[n]))
    return found.select(
        "doc_id",
        "n_words",
        F.size(base).cast("long").alias("n_base"),
        F.array_min(starts).alias("first_word"),
        F.array_max(starts).alias("last_word"),
        F.array_join(F.array_sort(labels(base)), ",").alias("base_labels"),
        F.array_join(F.array_sort(labels(F.col("spans"))), ",").alias("labels"),
        (1 - doubt).alias("score"),
    )


def without_licenses(docs: DataFrame, labels: Sequence[str], *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows of ``docs`` none of whose detections has one of ``labels``; all columns, also rows without an id."""
    found = find_licenses(docs, id_col=id_col, text_col=text_col)
    gone = found.where(F.exists("spans", lambda s: s["label"].isin(list(labels)))).select("doc_id").distinct()
    name = f"{inner_prefix(docs)}id"
    return docs.join(gone.toDF(name), F.col(f"`{id_col}`").eqNullSafe(F.col(name)), "left_anti")
