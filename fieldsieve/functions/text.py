"""Text expressions: whitespace, lines, sentences, characters, paths."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters that count as white space when a text is stripped.
SPACE_CHARS = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)


def strip_spaces(text: Column) -> Column:
    """``text`` without leading and trailing white space of any kind."""
    return F.trim(text, F.lit(SPACE_CHARS))


def clean_lines(text: Column) -> Column:
    """Every line stripped, blank lines gone, one newline in front."""
    lines = F.transform(F.split(text, "\n"), strip_spaces)
    return F.concat(F.lit("\n"), F.array_join(F.filter(lines, lambda s: s != ""), "\n"))


def characters(text: Column) -> Column:
    """The code points of ``text`` as an array of one-character strings."""
    return F.when(text == "", F.array().cast("array<string>")).otherwise(F.split(text, ""))


def sentences(text: Column) -> Column:
    """Non-blank pieces of ``text`` between full stops, marks and line breaks."""
    return F.filter(F.split(text, "[.!?\n]+"), lambda s: F.length(F.trim(s)) > 0)


def path_part(path: Column, from_end: int) -> Column:
    """The ``from_end``-th ``/``-separated part, counted from 1 at the end."""
    return F.element_at(F.split(path, "/"), -from_end)


def without_suffix(name: Column, suffix: str = ".parquet") -> Column:
    """``name`` without one trailing ``suffix`` (the suffix itself, not its characters)."""
    return F.when(
        name.endswith(suffix), F.substring(name, F.lit(1), F.length(name) - len(suffix))
    ).otherwise(name)
