"""Removing repeated passages by overlapping windows of three lines.

A text is cut into lines: at line breaks, and after the end of a sentence, because prose often
has a whole passage in one physical line. Every three consecutive lines
are a window. A window that occurs more than once, in one document or in several, stays where it
occurs first (lowest id, then position); all lines covered by any later occurrence go. The first
occurrence of a line's window is never a later one, so at least one copy of every line stays.
Native.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from areastats.llm.common import inner_prefix, text_hash
from areastats.session import stage

#: Where a line ends; the separator stays with its line, so kept lines join up again.
LINE_END = r"(?<=\n)|(?<=[.!?] )"
#: Lines are compared without these at either end.
BLANK = " \t\r\n"


def lines_of(text: Column) -> Column:
    return F.split(text, LINE_END)


def dedup_lines(
    docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", drop_emptied: bool = False
) -> DataFrame:
    """``docs`` with repeated windows cut out of the text column; all other columns as they were.

    With ``drop_emptied`` documents go that had text and lost every line of it.

    Documents with fewer than three lines have no window and stay as they are; so do NULL and
    empty texts. Windows of blank lines only do not count. Rows with equal id and text are one
    document and are all returned, with the same result; a NULL id sorts first. Equal texts under different
    ids are copies: the first stays, the others lose all lines. Other columns may have any name.
    """
    marked, removed, lines = _marked(docs, id_col, text_col)
    if drop_emptied:
        marked = marked.where((_count(removed) == 0) | (_count(removed) < F.size(lines)))
    text = _kept_text(text_col, removed, lines)
    return marked.select(*[text if c == text_col else F.col(f"`{c}`") for c in docs.columns])


def line_report(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document: id, lines, removed lines and the text that stays (see ``dedup_lines``)."""
    marked, removed, lines = _marked(docs, id_col, text_col)
    return marked.select(
        F.col(f"`{id_col}`").alias("doc_id"),
        F.coalesce(F.size(lines), F.lit(0)).cast("long").alias("n_lines"),
        _count(removed).cast("long").alias("n_removed"),
        _kept_text(text_col, removed, lines).alias("text"),
    )


def _count(removed: str) -> Column:
    return F.coalesce(F.size(removed), F.lit(0))


def _kept_text(text_col: str, removed: str, lines: str) -> Column:
    # The lines are named twice, so Spark cuts the text once and not again for every kept line.
    kept = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), F.col(removed))
    return (
        F.when(_count(removed) == 0, F.col(f"`{text_col}`"))
        .otherwise(F.array_join(F.transform(kept, lambda i: F.element_at(lines, i + 1)), ""))
        .alias(text_col)
    )


def later_windows(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Per document with later occurrences: id, text hash and the places of its removed lines."""
    lines = lines_of(F.col(f"`{text_col}`"))
    trimmed = F.transform(lines, lambda line: F.btrim(line, F.lit(BLANK)))
    hashed = (
        docs.select(F.col(f"`{id_col}`").alias("doc_id"), text_hash(F.col(f"`{text_col}`")).alias("th"), trimmed.alias("t"))
        .select(
            "doc_id",
            "th",
            # Two independent hashes of 64 bits: at 10^12 windows one alone would collide.
            F.transform("t", lambda line: F.xxhash64(line)).alias("a"),
            F.transform("t", lambda line: F.xxhash64(F.lit(1), line)).alias("b"),
        )
    )
    hashed = stage(hashed, "line-hashes")
    blank = F.xxhash64(F.lit(""))
    windows = hashed.where(F.size("a") >= 3)
    windows = windows.select("doc_id", "th", "a", "b", F.explode(F.sequence(F.lit(0), F.size("a") - 3)).alias("pos"))

    def three(c: str) -> list[Column]:
        return [F.get(F.col(c), F.col("pos") + k) for k in range(3)]

    windows = windows.where(~((three("a")[0] == blank) & (three("a")[1] == blank) & (three("a")[2] == blank)))
    windows = windows.select(
        F.xxhash64(*three("a")).alias("k1"), F.xxhash64(*three("b")).alias("k2"), "doc_id", "th", "pos"
    )
    place = F.struct("doc_id", "th", "pos")
    repeated = (
        windows.groupBy("k1", "k2").agg(F.count("*").alias("n"), F.min(place).alias("first")).where("n > 1").drop("n")
    )
    # Written out, so that the join below has plain shuffles on both sides and Spark can split a
    # window that a third of all documents share.
    repeated = stage(repeated, "repeated-windows")
    later = windows.join(repeated, ["k1", "k2"]).where(~place.eqNullSafe(F.col("first")))
    covered = F.flatten(F.transform(F.collect_list("pos"), lambda p: F.array(p, p + 1, p + 2)))
    return later.groupBy("doc_id", "th").agg(F.array_distinct(covered).alias("removed"))


def _marked(docs: DataFrame, id_col: str, text_col: str) -> tuple[DataFrame, str, str]:
    """``docs`` with two more columns: the places of the lines that go (NULL: none), and the lines."""
    prefix = inner_prefix(docs)
    key, doc_id, th, removed, lines = (f"{prefix}{c}" for c in ("key", "id", "th", "removed", "lines"))
    found = later_windows(docs, id_col, text_col).toDF(doc_id, th, removed)
    text = F.col(f"`{text_col}`")
    left = docs.withColumn(key, text_hash(text))
    same = F.col(f"`{id_col}`").eqNullSafe(F.col(doc_id)) & (F.col(key) == F.col(th))
    return left.join(found, same, "left").withColumn(lines, lines_of(text)), removed, lines
