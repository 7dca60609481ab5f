"""Text clean-up as Column expressions."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, functions as F


def strip_suffix(c: Column, suffixes: Sequence[str] = (" County",), upper: bool = True) -> Column:
    """Remove one trailing suffix, exact case and only at the very end, then upper-case."""
    pattern = "(?:" + "|".join(re.escape(s) for s in suffixes) + r")\z"
    stripped = F.regexp_replace(c, pattern, "")
    return F.upper(stripped) if upper else stripped


def strip_anywhere(c: Column, word: str = "County") -> Column:
    """Remove every occurrence of ``word``; blanks around it stay."""
    return F.replace(c, F.lit(word), F.lit(""))


def plain_number(c: Column) -> Column:
    """A double as text: all digits from 0.0001 up (``0.0003``, ``1.0``), ``2e-05`` below that."""
    text = c.cast("string")

    def digits(scale: int) -> Column:
        return F.regexp_replace(c.try_cast(f"decimal(38,{scale})").cast("string"), r"(\.\d+?)0+$", "$1")

    small = F.regexp_replace(F.regexp_replace(text, r"(?:\.0)?E-(\d+)$", "e-$1"), r"e-(\d)$", "e-0$1")
    large = F.regexp_replace(text, r"(?:\.0)?E(\d+)$", "e+$1")
    size = F.abs(c)
    return (
        F.when(~text.contains("E"), text)
        .when(size < 1e-4, small)
        .when(size < 1, digits(30))
        .when(size < 1e16, digits(18))
        .otherwise(large)
    )


def quoted_line(key: Column, value: Column, quote_value: bool = True) -> Column:
    """``'KEY' 'VALUE'`` or ``'KEY' VALUE``; NULL when either part is NULL."""
    tail = F.concat(F.lit("'"), value, F.lit("'")) if quote_value else value
    return F.concat(F.lit("'"), key, F.lit("' "), tail)


def file_label(path: Column) -> Column:
    """The ``name.ext`` at the end of a path, as written by one-file exports."""
    return F.regexp_extract(path, r"/(\w+\.\w+)$", 1)


def source_label(path: Column) -> Column:
    """The name of the file that a row comes from, or of its folder where that is a table of part files."""
    plain = F.replace(path, F.lit("%20"), F.lit(" "))
    return F.regexp_extract(plain, r"([^/]+?)(?:/part-[^/]*)?$", 1)


def naive_piece(line: Column, index: int, sep: str = ",") -> Column:
    """Piece ``index`` of a plain split that knows nothing about quotes; NULL past the end."""
    return F.get(F.split(line, re.escape(sep)), index)
