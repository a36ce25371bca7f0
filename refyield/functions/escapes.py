"""A reversible escape that keeps a record of a text file on one line.

A backslash and a letter stand for a line feed (``n``), a carriage return (``r``), an
empty text (``e``), NULL (``N``) and, doubled, for the backslash itself. Other texts
are written as they are. Readers split such files anywhere at a line's end.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# In the order they are written; the backslash first.
_MARKS = (("\\", "\\\\"), ("\n", "\\n"), ("\r", "\\r"))
_EMPTY, _NULL = "\\e", "\\N"


def _replaced(text: Column, old: str, new: str) -> Column:
    return F.replace(text, F.lit(old), F.lit(new))


def escape(text: Column | str) -> Column:
    """One line of text for any value, NULL included."""
    t = F.col(text) if isinstance(text, str) else text
    line = t
    for char, mark in _MARKS:
        line = _replaced(line, char, mark)
    return F.when(t.isNull(), F.lit(_NULL)).when(t == "", F.lit(_EMPTY)).otherwise(line)


def unescape(line: Column | str) -> Column:
    """The value that ``escape`` wrote; a missing field is NULL."""
    t = F.col(line) if isinstance(line, str) else line

    def plain(part: Column) -> Column:
        for char, mark in _MARKS[1:]:
            part = _replaced(part, mark, char)
        return part

    # between doubled backslashes every backslash begins a mark
    decoded = F.array_join(F.transform(F.split(t, r"\\\\"), plain), "\\")
    value = F.when(t.contains("\\"), decoded).otherwise(t)
    return F.when(t == _NULL, F.lit(None).cast("string")).when(t == _EMPTY, F.lit("")).otherwise(value)
