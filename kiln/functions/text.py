"""Line and word splitting with the rules of a JVM text job."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def split_lines(text: Column) -> Column:
    """Text -> array of lines, as a text-file reader sees them.

    ``\\n``, ``\\r\\n`` and ``\\r`` end a line; a final terminator does not
    start another (empty) line, and an empty text has no lines.
    """
    body = F.regexp_replace(text, r"(\r\n|\r|\n)\z", "")
    return F.when(text == "", F.array().cast("array<string>")).otherwise(
        F.split(body, r"\r\n|\r|\n", -1))


def java_split_words(line: Column, drop_empty: bool = False) -> Column:
    """Words of one line by the ``String.split(" ")`` rule of the JVM.

    Leading and inner empty words are kept, trailing ones dropped; an empty
    line gives one empty word and an all-blank line gives none.  Only the
    space character separates words (a tab does not).  ``drop_empty=True``
    removes every empty word.
    """
    words = (F.when(line == "", F.array(F.lit("")))
             .when(F.rtrim(line) == "", F.array().cast("array<string>"))
             .otherwise(F.split(F.rtrim(line), " ", -1)))
    if drop_empty:
        words = F.filter(words, lambda w: w != "")
    return words
